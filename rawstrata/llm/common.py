"""Tables, shared intermediate results and small helpers the operators have in common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.session import scratch_path
from rawstrata.sources import storage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(storage.child(sf_dir, f"{name}.parquet"))


class Workspace:
    """Tables written to the shared folder, so that a lost executor costs a re-read.

    ``drop`` removes what later steps no longer read; a result returned lazily keeps the
    tables it scans.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.label = label
        self._paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.mode("errorifexists").parquet(path)
        held = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(held)] = path
        self._held = [*getattr(self, "_held", []), held]  # ids stay unique while held
        return held

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self._paths.pop(id(frame), None)
            if path:
                storage.delete(self.spark, path)


BITMAP_BITS = 1 << 23


def likely_among(rows: DataFrame, wanted: DataFrame, hash_col: str) -> DataFrame:
    """The rows whose hash may be among the wanted ones, and few others: a filter to put before
    a join that would else shuffle all rows.

    The wanted hashes set bits of one bitmap of ``BITMAP_BITS`` bits, kept in pieces. It is
    1 MB at most however many are wanted, so it is broadcast; once it is full it filters
    nothing, and the join behind it is as right as before.
    """
    marked = _marked(rows, wanted, hash_col, "inner")
    return marked.filter("_likely").select(*rows.columns)


def apart(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose doc_id may be among those of ``ids``, and the rows whose surely is not. A
    join that concerns few rows then shuffles few, and the others pass by."""
    return apart_by(rows, F.xxhash64("doc_id"), ids.select(F.xxhash64("doc_id").alias("h")))


def apart_by(rows: DataFrame, hashed: Column, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``apart``, by the rows' hash and a frame of the wanted ones, ``h``."""
    keyed = rows.select(F.struct("*").alias("row"), hashed.alias("h"))
    marked = _marked(keyed, wanted, "h", "left")
    likely = F.coalesce("_likely", F.lit(False))
    return marked.filter(likely).select("row.*"), marked.filter(~likely).select("row.*")


def _marked(rows: DataFrame, wanted: DataFrame, hash_col: str, how: str) -> DataFrame:
    bit = F.pmod(F.col(hash_col), F.lit(BITMAP_BITS))
    pieces = (
        wanted.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.call_function("shiftright", byte.cast("int"), (place % 8).cast("int")) % 2 == 1
    joined = rows.join(F.broadcast(pieces), F.bitmap_bucket_number(bit) == F.col("piece"), how)
    return joined.withColumn("_likely", is_set)


FOLDS = 5


def fold(id_col: str) -> Column:
    """0 for held-out documents, 1 to 4 for those whose labels may be learned."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS, F.lit(1))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, *, label: str, id_col: str, text_col: str, most: int
) -> DataFrame:
    """(doc_id, fold, text, label): whole texts of at most ``most`` labelled documents that are
    not held out, chosen by a hash of the id. Contradicting labels of one id count by majority,
    a draw as 1."""
    chosen = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("double").alias("label"))
        .dropna()
        .filter(fold("doc_id") != 0)
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Bound: ``most`` rows of 16 bytes.
    return texts.join(F.broadcast(chosen), "doc_id").select(
        "doc_id", fold("doc_id").alias("fold"), "text", "label"
    )
