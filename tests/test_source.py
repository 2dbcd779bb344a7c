from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from rawstrata.contracts import resolve_entity_schema, text_schema
from rawstrata.operators.quality import corrupt_rows
from rawstrata.sources.delimited import load_entity_data, read_source_csv, resolve_source_path

SCHEMA = text_schema("source_record_id customer_id _corrupt_record")
HEADER = "source_record_id,customer_id\n"


@pytest.fixture
def scan(spark, tmp_path):
    def run(text, header=HEADER):
        path = tmp_path / "extract.csv"
        path.write_bytes((header + text).encode())
        return [tuple(row) for row in read_source_csv(spark, SCHEMA, path).collect()]

    return run


def test_path_names_batch_and_entity(tmp_path):
    assert resolve_source_path(tmp_path, "B7", "order") == f"{tmp_path}/B7/order_B7.csv"
    assert resolve_source_path("s3a://in/x/", "B7", "order") == "s3a://in/x/B7/order_B7.csv"


def test_header_is_skipped_and_columns_bind_by_position(scan):
    assert scan("r1,c1\n") == [("r1", "c1", None)]
    assert scan("r1,c1\n", header="x,y\n") == [("r1", "c1", None)]


def test_quoted_line_break_stays_in_the_value(scan):
    assert scan('r1,"one\ntwo"\n') == [("r1", "one\ntwo", None)]


def test_surplus_and_missing_fields_keep_the_raw_line(scan):
    assert scan("r1,c1,extra\nr2\nr3,c3\n") == [
        ("r1", "c1", "r1,c1,extra"),
        ("r2", None, "r2"),
        ("r3", "c3", None),
    ]


def test_empty_fields_are_null_and_other_text_is_kept(scan):
    rows = scan('r1,\nr2,""\nr3,NULL\nr4,  x \n\nr5,-19.99\n')
    assert [value for _, value, _ in rows] == [None, None, "NULL", "  x ", "-19.99"]


def test_byte_order_mark_and_crlf(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes(b"\xef\xbb\xbfsource_record_id,customer_id\r\nr1,c1\r\nr2,c2\r\n")
    rows = read_source_csv(spark, SCHEMA, path).collect()
    assert [tuple(row) for row in rows] == [("r1", "c1", None), ("r2", "c2", None)]


def test_doubled_quotes_are_not_an_escape(scan):
    assert scan('r1,"a ""b"" c"\n') == [("r1", '"a ""b"" c"', None)]
    assert scan('r1,"a \\"b\\" c"\n') == [("r1", 'a "b" c', None)]


def test_missing_extract_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_entity_data(spark, tmp_path, "B001", "customer")


def test_unknown_entity(spark, tmp_path):
    with pytest.raises(KeyError):
        load_entity_data(spark, tmp_path, "B001", "nothing")


@pytest.mark.parametrize("as_folder", [False, True])
def test_entity_loads_from_a_file_or_a_folder_of_parts(spark, tmp_path, as_folder):
    columns = resolve_entity_schema("category").names[:-1]
    header = ",".join(columns)
    target = tmp_path / "B001" / "category_B001.csv"
    parts = [target / "part-0.csv", target / "part-1.csv"] if as_folder else [target]
    for number, part in enumerate(parts):
        part.parent.mkdir(parents=True, exist_ok=True)
        part.write_text(f"{header}\nr{number},{','.join('v' * len(columns[1:]))}\n")
    loaded = load_entity_data(spark, tmp_path, "B001", "category")
    assert loaded.columns == [*columns, "_corrupt_record"]
    assert sorted(row.source_record_id for row in loaded.collect()) == [
        f"r{number}" for number in range(len(parts))
    ]
    assert corrupt_rows(loaded).collect() == []


PAIR = text_schema("h1 h2 _corrupt_record")


def content(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture
def small_splits(spark):
    before = {}
    for name, value in (("maxPartitionBytes", "64"), ("openCostInBytes", "0")):
        key = f"spark.sql.files.{name}"
        before[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_an_extract_of_one_line_records_is_read_in_splits(spark, tmp_path, small_splits):
    folder = tmp_path / "extract.csv"
    folder.mkdir()
    for n, end in enumerate(["\n", "\r\n"]):
        rows = [f'{i},"a, ""b"" {n}"' if i % 3 else f"{i},x,y" if i % 2 else f"{i}" for i in range(100)]
        (folder / f"part-{n}.csv").write_bytes((end.join(["h1,h2", *rows, ""])).encode())
    whole = read_source_csv(spark, PAIR, folder)
    split = read_source_csv(spark, PAIR, folder, records_span_lines=False)
    assert content(whole) == content(split) and whole.count() == 200
    assert whole.rdd.getNumPartitions() == 2
    assert split.rdd.getNumPartitions() > 10


def test_part_files_of_records_that_span_lines_are_tasks_of_their_own(spark, tmp_path, small_splits):
    rows = spark.range(60).selectExpr("CAST(id AS string) AS h1", "concat('a\n\"', id, '\"') AS h2")
    folder = str(tmp_path / "extract.csv")
    rows.repartition(6).write.options(header=True).csv(folder)
    scanned = read_source_csv(spark, PAIR, folder)
    assert scanned.rdd.getNumPartitions() == 6
    assert {(r.h1, r.h2) for r in scanned.collect()} == {(str(i), f'a\n"{i}"') for i in range(60)}


def test_folder_of_plain_and_compressed_files(spark, tmp_path):
    folder = tmp_path / "extract.csv"
    spark.createDataFrame([("z", "zipped\ntext")], "h1 string, h2 string").write.options(
        header=True, compression="gzip"
    ).csv(str(folder))
    (folder / "plain.csv").write_text("h1,h2\n" + "4,5\n" * 100 + '6,"\n"\n')
    got = content(read_source_csv(spark, PAIR, folder))
    assert got == {("z", "zipped\ntext", None): 1, ("4", "5", None): 100, ("6", "\n", None): 1}


@pytest.mark.parametrize("span", [True, False])
def test_names_patterns_and_folders_never_change_the_rows(spark, tmp_path, span):
    """Names that look like patterns, folders that look like partitions, and patterns."""
    folder = tmp_path / "extract.csv"
    (folder / "day=1").mkdir(parents=True)
    (folder / "part-[1].csv").write_text("h1,h2\n1,x\n")
    (folder / "part-1.csv").write_text("h1,h2\n2,3\n")
    (folder / "day=1" / "{a,b}*.csv").write_text("h1,h2\n4,5\n" + "6,7\n" * 40)
    (folder / "_notes").write_text("not,data\n")
    rows = read_source_csv(spark, PAIR, folder, records_span_lines=span)
    assert rows.columns == PAIR.names
    assert content(rows) == {
        ("1", "x", None): 1, ("2", "3", None): 1, ("4", "5", None): 1, ("6", "7", None): 40
    }
    some = read_source_csv(spark, PAIR, tmp_path / "*.csv" / "part-*", records_span_lines=span)
    assert content(some) == {("1", "x", None): 1, ("2", "3", None): 1}
    (tmp_path / "empty.csv").mkdir()
    assert read_source_csv(spark, PAIR, tmp_path / "empty.csv", records_span_lines=span).count() == 0
