import subprocess
import sys
from pathlib import Path

import pytest

from rawstrata import session
from rawstrata.session import scratch_path, scratch_root, sized_shuffles, staged

GIGA = 1024**3


def test_scratch_is_the_configured_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    assert root == (configured or spark.sparkContext.getCheckpointDir())
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(path.startswith(f"{root}/rawstrata/x-") for path in paths)


class _Unconfigured:
    """A session without the setting, on a cluster."""

    class conf:  # noqa: N801
        get = staticmethod(lambda name, default: default)

    class sparkContext:  # noqa: N801
        master = "spark://somewhere"
        getCheckpointDir = staticmethod(lambda: None)


@pytest.mark.parametrize("master", ["spark://somewhere", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_the_shared_folder(master, monkeypatch):
    monkeypatch.setattr(_Unconfigured.sparkContext, "master", master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Unconfigured)


def test_staged_rows_are_read_back_and_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y bigint")
    with staged(df, "rows") as scan:
        assert scan.dtypes == df.dtypes
        assert sorted(row.y for row in scan.collect()) == [1, 2]
        assert len(list((tmp_path / "rawstrata").iterdir())) == 1
    with pytest.raises(ZeroDivisionError), staged(df, "rows"):
        1 / 0
    assert not list((tmp_path / "rawstrata").iterdir())


def test_shuffles_grow_with_the_input_and_return(spark):
    name = session.SHUFFLE_PARTITIONS
    configured = spark.conf.get(name)
    with sized_shuffles(spark, 100 * GIGA):
        assert int(spark.conf.get(name)) == 801
    with sized_shuffles(spark, 10**15):
        assert int(spark.conf.get(name)) > 10**15 // session.BYTES_PER_SHUFFLE_PARTITION
    with sized_shuffles(spark, 10):
        assert spark.conf.get(name) == configured
    with pytest.raises(ZeroDivisionError), sized_shuffles(spark, 100 * GIGA):
        1 / 0
    assert spark.conf.get(name) == configured


def test_what_an_application_leaves_goes_at_its_end(tmp_path):
    code = """
from pyspark.sql import SparkSession
from rawstrata.session import scratch_path
settings = {"spark.ui.enabled": "false", "spark.checkpoint.dir": r"%s"}
spark = SparkSession.builder.master("local[1]").config(map=settings).getOrCreate()
spark.range(3).write.parquet(scratch_path(spark, "kept"))
raise RuntimeError("a job that failed")
""" % tmp_path
    root = str(Path(__file__).resolve().parents[1])
    ended = subprocess.run(
        [sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300
    )
    assert "a job that failed" in ended.stderr
    assert list((tmp_path / "rawstrata").iterdir()) == []
