"""Exact top-k inner products from an impact-ordered, score-at-a-time index.

Index: vectors become whole numbers, floor(1024 x), and are dealt into blocks of
``BLOCK`` rows by a hash. In a block each dimension's postings are sorted by value and cut
into ``SEGMENTS`` segments; a segment keeps its places, its least and its largest value.
Blocks are rows of a shared table, each with its vectors and its segments' places, both as narrow
whole numbers: an executor that is lost costs a re-read, and no search sorts anything.

Search: for a query, a segment's impact is the most it can add above the least its dimension
adds anywhere in the block. Segments of all dimensions are processed by descending impact,
adding the least each surely brings to the accumulators of its places. After every round the
sum of the largest impacts left bounds what any place can still gain. A place whose bound
lies below the k-th best sure score cannot be a member; processing stops when few enough
places are left, which is a proof for all others, or when no segment is left. The places
left are rescored exactly with their whole vectors.

Queries are packed into batches and up to ``GROUP`` batches into a group; a group meets a block by
a join on the block's number, one row per pair, so a block is sent once for many queries, and gives
back k rows per query and block. There are so many groups that all cores have work. The best k of
all are taken per query by a window with a rank limit, which Spark applies before the shuffle as well.

Special cases: a null id, a null vector, or one that holds null or a non-finite component
takes no part; vectors are compared within the same length; repeated rows are candidates as
often as they occur, and a query that repeats is asked once; candidates with the query's id
are left out; ties go to the smaller id; fewer candidates than k give fewer rows; an empty table gives an empty result; other columns are ignored.
A score that does not fit 64 bits raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, table

K = 10
SCALE = 1024
BLOCK = 16_384  # vectors of a block
BATCH = 128  # queries of a batch
SEGMENTS = 16
ROUNDS = 12  # bound checks while segments are processed
FEW = 8  # places per wanted result at which rescoring is cheaper than going on
GROUP = 64  # batches that are sent to a block together, at most
TASKS_A_CORE = 4

RESULT = "query_id long, vec_id long, score long"
INDEX = "block long, size long, length int, ids array<long>, width int, packed binary, places binary"
BATCHES = "block long, size long, length int, ids array<long>, packed binary"


def whole_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the vectors that take part, in whole numbers."""
    finite = F.forall(
        vector_col,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    scaled = F.transform(
        vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("long")
    )
    return (
        df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
        .select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))
    )


def dealt(size: int, rows: int) -> Column:
    """Number of the group a row is dealt to, ``size`` rows on average, by a hash of its id and
    its place in the written table: rows of one id are dealt apart."""
    return F.pmod(F.xxhash64("vec_id", "row"), F.lit(max(1, -(-rows // size))).cast("long"))


def packed(rows: pd.DataFrame) -> np.ndarray:
    """The vectors of some rows as one matrix."""
    return np.array(rows["v"].tolist(), dtype=np.int64).reshape(len(rows), -1)


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold them all."""
    most = int(np.abs(matrix).max(initial=0))
    for kind in (np.int16, np.int32):
        if most <= np.iinfo(kind).max:
            return matrix.astype(kind)
    return matrix


def _grouped(vectors: DataFrame, rows: int, size: int, pack, schema: str) -> DataFrame:
    return (
        vectors.select(
            "vec_id", "v", F.size("v").alias("length"), dealt(size, rows).alias("block")
        )
        .groupBy("block", "length")
        .applyInPandas(pack, schema)
    )


def build_blocks(vectors: DataFrame, rows: int, block: int = BLOCK) -> DataFrame:
    """The index: blocks of vectors of one length, each a row with ids, vectors and segments."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        matrix = packed(part)
        held = narrow(matrix)
        return pd.DataFrame(
            {
                "block": [part["block"].iloc[0]],
                "size": [len(part)],
                "length": [part["length"].iloc[0]],
                "ids": [part["vec_id"].to_numpy()],
                "width": [held.itemsize],
                "packed": [held.tobytes()],
                "places": [narrow(postings(matrix)).tobytes()],
            }
        )

    return _grouped(vectors, rows, block, pack, INDEX)


def build_batches(queries: DataFrame, rows: int, batch: int = BATCH) -> DataFrame:
    """Batches of queries of one length."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "block": [part["block"].iloc[0]],
                "size": [len(part)],
                "length": [part["length"].iloc[0]],
                "ids": [part["vec_id"].to_numpy()],
                "packed": [packed(part).tobytes()],
            }
        )

    return _grouped(queries, rows, batch, pack, BATCHES)


def postings(matrix: np.ndarray) -> np.ndarray:
    """Places of a block's vectors by rising value, a row for each dimension."""
    return np.argsort(matrix, axis=0, kind="stable").T.copy()


class ImpactIndex:
    """The segments of one block, impact-ordered for any query."""

    def __init__(self, matrix: np.ndarray, places: np.ndarray | None = None, segments: int = SEGMENTS):
        self.matrix = matrix
        self.largest = int(np.abs(matrix).max(initial=0))
        size, length = matrix.shape
        order = postings(matrix) if places is None else places
        cuts = np.linspace(0, size, min(segments, size) + 1).astype(np.int64)
        self.places, self.dims, low, high = [], [], [], []
        for d in range(length):
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                held = order[d, a:b]
                self.places.append(held)
                self.dims.append(d)
                low.append(matrix[held[0], d])
                high.append(matrix[held[-1], d])
        self.dims = np.array(self.dims, dtype=np.int64)
        self.low, self.high = np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)

    def exact(self, query: np.ndarray) -> bool:
        """Whether all bounds are exact as floating-point numbers."""
        most = int(np.abs(query).max()) * self.largest
        return 4 * most * self.matrix.shape[1] < 1 << 52

    def candidates(self, query: np.ndarray, k: int) -> np.ndarray:
        """Places of which it is not proven that k others score higher."""
        size, length = self.matrix.shape
        if size <= k * FEW or not length or not self.exact(query):
            return np.arange(size)
        weight = query[self.dims]
        least = np.minimum(weight * self.low, weight * self.high)
        most = np.maximum(weight * self.low, weight * self.high)
        floor = np.full(length, np.iinfo(np.int64).max)
        np.minimum.at(floor, self.dims, least)
        sure, impact = least - floor[self.dims], most - floor[self.dims]
        order = np.argsort(-impact, kind="stable")
        # One accumulator holds both sums: what a place surely has, and how much more it may
        # have from the same segments. Whole numbers below 2**52 are exact in either part.
        gains = sure + 1j * (impact - sure)
        sums = np.zeros(size, dtype=complex)
        left = np.arange(size)
        for part in np.array_split(np.arange(len(order)), ROUNDS):
            for s in order[part].tolist():
                sums[self.places[s]] += gains[s]
            after = order[part[-1] + 1 :] if len(part) else order
            rest = np.zeros(length, dtype=np.int64)
            np.maximum.at(rest, self.dims[after], impact[after])
            kth = np.partition(sums.real, size - k)[size - k]
            left = np.flatnonzero(sums.real + sums.imag + rest.sum() >= kth)
            if len(left) <= k * FEW:
                break
        return left


def search_block(
    ids: np.ndarray, index: ImpactIndex, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[pd.DataFrame]:
    most = index.largest * int(np.abs(queries).max(initial=0))
    if most * index.matrix.shape[1] >= 1 << 62:
        raise OverflowError("inner products of these vectors do not fit 64 bits")
    found = []
    for query_id, query in zip(query_ids, queries, strict=True):
        # one more than k: the query itself may be among the best
        own = int(np.count_nonzero(ids == query_id))
        places = index.candidates(query, min(k + own, len(ids)))
        scores = index.matrix[places] @ query
        keep = ids[places] != query_id
        places, scores = places[keep], scores[keep]
        best = np.lexsort((ids[places], -scores))[:k]
        found.append((np.full(len(best), query_id), ids[places][best], scores[best]))
    if found:
        a, b, c = (np.concatenate(x) for x in zip(*found, strict=True))
        yield pd.DataFrame({"query_id": a, "vec_id": b, "score": c})


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    batch: int = BATCH,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for every query."""
    spark = vectors.sparkSession
    work = Workspace(spark, "top_k")
    numbered = F.monotonically_increasing_id().alias("row")
    whole = work.write(whole_vectors(vectors, id_col, vector_col).select("*", numbered), "whole")
    blocks = work.write(build_blocks(whole, whole.count(), block), "blocks")
    work.drop(whole)
    asked = whole_vectors(queries, id_col, vector_col).dropDuplicates(["vec_id", "v"])
    asked = work.write(asked.select("*", numbered), "queries")
    batches = work.write(build_batches(asked, asked.count(), batch), "batches")
    work.drop(asked)

    n_blocks, n_batches = blocks.count(), batches.count()
    wanted = TASKS_A_CORE * spark.sparkContext.defaultParallelism
    groups = max(1, -(-n_batches // GROUP), min(n_batches, -(-wanted // max(1, n_blocks))))
    in_group = F.pmod(F.col("block"), F.lit(groups))
    grouped = batches.groupBy("length", in_group.alias("group")).agg(
        F.collect_list(F.struct("ids", "packed")).alias("batches")  # about GROUP of them at most
    )
    # Each group is sent to each block of its length: one row per pair, joined by block.
    numbers = blocks.select("length", "block")
    sent = grouped.join(numbers, "length")
    pairs = (
        blocks.join(sent, ["length", "block"])
        .repartitionById(
            max(1, min(n_blocks * groups, 8 * wanted)),
            F.pmod(F.col("block") * groups + F.col("group"), F.lit(max(1, min(n_blocks * groups, 8 * wanted)))).cast("int"),
        )
        .select("length", "ids", "width", "packed", "places", "batches")
    )

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples(index=False):
                size = len(row.ids)
                matrix = np.frombuffer(row.packed, dtype=f"i{row.width}").reshape(size, row.length)
                kind = np.int16 if size - 1 <= np.iinfo(np.int16).max else np.int32
                places = np.frombuffer(row.places, dtype=kind).reshape(row.length, size)
                index = ImpactIndex(matrix.astype(np.int64), places)
                for one in row.batches:
                    ids = np.asarray(one["ids"])
                    asked = np.frombuffer(one["packed"], dtype=np.int64)
                    yield from search_block(
                        np.asarray(row.ids), index, ids, asked.reshape(len(ids), row.length), k
                    )

    found = pairs.mapInPandas(search, RESULT)
    ranked = found.selectExpr(
        "query_id",
        "CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank",
        "vec_id",
        "score",
    )
    return ranked.filter(F.col("rank") <= k)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v) q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
