"""Resampling towards a target: hashed n-gram weights, then parallel sorting by regular sampling.

Features are all runs of 1 to 2 words, each hashed into one of ``BUCKETS`` buckets. A first pass
counts the buckets of the documents and of the target texts; the counts give one array of gains,
which a second pass adds up over every document's features. Gumbel noise drawn from the id makes
the highest scores a sample without replacement in proportion to exp(weight / 1000).

Ranks come from parallel sorting by regular sampling. Every task of the second pass sorts the
rows it scored: its run. Rows at regular places of the runs give splitters, which cut the order
into segments of about ``SEGMENT_ROWS`` rows; the segments are exchanged and merged by local
sorts, counted, and the counts before a segment are added to the places in it. Equal scores and
ids are told apart by run and place, so any number of repeated rows splits into segments too.

What reaches the driver is bounded: ``BUCKETS`` counts, ``SAMPLES`` sampled rows for each
segment, one count per segment.

Special cases: a null or wordless text has no features and weight 0; a null id has the noise of
the text ``7:`` and comes after other ids on a tie; rows with equal ids are ranked row by row,
equal rows among themselves in any order; an empty table gives no rows, without target texts
every target count is 0; columns other than the named ones are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, table
from rawstrata.llm.words import Words, slices, split_words

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
SEGMENT_ROWS = 1 << 22
SAMPLES = 32  # of the rows in a segment

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[0x00:0x30] = SEPARATOR[0x3A:0x61] = SEPARATOR[0x7B:0x80] = True
SHORT = 40  # bytes of a word that are hashed for all words at once

_POLYNOMIAL = 0xEDB88320
_START = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(_POLYNOMIAL), out >> 1).astype(np.uint32)
    return out


_TABLE = _crc_table()


def _after_words(words: Words, states: np.ndarray) -> np.ndarray:
    """The registers of CRC-32 after each word's bytes, from a register for each word."""
    sizes = words.ends - words.starts
    order = np.argsort(-np.minimum(sizes, SHORT), kind="stable")
    starts, held = words.starts[order], states[order]
    # as_many[j]: words of more than j bytes, which come first in this order
    as_many = len(sizes) - np.cumsum(np.bincount(np.minimum(sizes, SHORT), minlength=SHORT + 1))
    for j in range(SHORT):
        n = int(as_many[j])
        if not n:
            break
        byte = words.data[starts[:n] + j]
        held[:n] = _TABLE[(held[:n] ^ byte) & 255] ^ (held[:n] >> 8)
    out = np.empty_like(held)
    out[order] = held
    for i in np.flatnonzero(sizes > SHORT):
        rest = words.data[words.starts[i] + SHORT : words.ends[i]].tobytes()
        out[i] = zlib.crc32(rest, int(~out[i])) ^ 0xFFFFFFFF
    return out


def feature_buckets(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words, of the pairs (word, next word), and which pairs are of one text."""
    single = _after_words(words, np.full(len(words.starts), _START))
    following = words._replace(starts=words.starts[1:], ends=words.ends[1:])
    blank = _TABLE[(single[:-1] ^ 0x20) & 255] ^ (single[:-1] >> 8)
    double = _after_words(following, blank)
    paired = np.ones(len(double), dtype=bool)
    begins = words.first[1:-1]
    paired[begins[(begins > 0) & (begins <= len(double))] - 1] = False
    return (~single % buckets).astype(np.int64), (~double % buckets).astype(np.int64), paired


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, part in slices(batch["text"]):
                words = split_words(part, lower=True, blank=SEPARATOR)
                single, double, paired = feature_buckets(words, buckets)
                counts += np.bincount(single, minlength=buckets)
                counts += np.bincount(double[paired], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    found = (
        texts.select(F.col(text_col).alias("text"))
        .mapInArrow(run, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most ``buckets`` rows
    )
    out = np.zeros(buckets, dtype=np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of every bucket: floor(1000 ln(target share / source share)), each count one more."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(
                1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n)))
            )
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(drawn[:8], 16) + 0.5) / 4294967296)))


def scored_batch(ids: pa.Array, texts: pa.Array, gain: np.ndarray, seed: int) -> pa.RecordBatch:
    """n_words, n_features, weight and score of every text."""
    n_words, n_features, weights = [], [], []
    for _, part in slices(texts):
        words = split_words(part, lower=True, blank=SEPARATOR)
        single, double, paired = feature_buckets(words, len(gain))
        sums = np.zeros(len(single) + 1, dtype=np.int64)
        np.cumsum(gain[single], out=sums[1:])
        pairs = np.zeros(len(single) + 1, dtype=np.int64)  # pairs that begin before a word
        if len(double):
            np.cumsum(np.where(paired, gain[double], 0), out=pairs[1:-1])
            pairs[-1] = pairs[-2]
        first, last = words.first[:-1], words.first[1:]
        count = last - first
        features = count + np.maximum(count - 1, 0)
        total = sums[last] - sums[first] + pairs[last] - pairs[first]
        n_words.append(count)
        n_features.append(features)
        weights.append(total // np.maximum(features, 1))
    weight = np.concatenate([np.empty(0, np.int64), *weights])
    drawn = np.array([noise(i, seed) for i in ids.to_pylist()], dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(np.concatenate([np.empty(0, np.int64), *n_words])),
            pa.array(np.concatenate([np.empty(0, np.int64), *n_features])),
            pa.array(weight),
            pa.array(weight + drawn),
        ],
        names=["doc_id", "n_words", "n_features", "weight", "score"],
    )


def score(
    docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield scored_batch(batch["doc_id"], batch["text"], gain, seed)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def _order() -> tuple[Column, Column]:
    return F.desc("score"), F.asc_nulls_last("doc_id")


def _with_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the task and the rows in it."""
    run, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(n, run)), pa.array(np.arange(place, place + n))],
            names=[*batch.schema.names, "run", "place"],
        )
        place += n


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """What rows are ordered by, one column per row, the last line first in weight."""
    ids = batch["doc_id"]
    return np.stack(
        [
            np.asarray(batch["place"]),
            np.asarray(batch["run"]),
            np.asarray(ids.fill_null(0)),
            np.asarray(ids.is_null()).astype(np.int64),
            -np.asarray(batch["score"]),
        ]
    )


def regular_splitters(runs: DataFrame, rows: int, segments: int) -> np.ndarray:
    """Keys that cut the order into ``segments`` parts, from rows at regular places of the runs.

    The places of run r begin at a share of the stride that differs from run to run, so short
    runs are sampled at the same rate as long ones.
    """
    stride = max(1, rows // (segments * SAMPLES))
    offset = F.pmod(F.col("run") * 0x9E3779B1, F.lit(stride))
    drawn = (
        runs.filter(F.pmod(F.col("place") + offset, F.lit(stride)) == 0)
        .select("place", "run", "doc_id", "score")
        .toArrow()  # about segments x SAMPLES rows
    )
    if segments < 2 or not drawn.num_rows:
        return np.empty((5, 0), dtype=np.int64)
    keys = _keys(drawn.combine_chunks().to_batches()[0])
    keys = keys[:, np.lexsort(keys)]
    return keys[:, np.arange(1, segments) * keys.shape[1] // segments]


def ranked(rows: DataFrame, work: Workspace) -> DataFrame:
    """The rows with ``rank``, from 1 in the order of descending score and ascending id."""
    runs = work.write(
        rows.sortWithinPartitions(*_order()).mapInArrow(
            _with_run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", run long, place long"
        ),
        "runs",
    )
    total = runs.count()
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = max(least, -(-total // SEGMENT_ROWS))
    splitters = regular_splitters(runs, total, segments)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = splitters.shape[1]
        for batch in batches:
            order = np.lexsort(np.concatenate([splitters, _keys(batch)], axis=1))
            passed = np.cumsum(order < m)
            segment = np.empty(len(order), dtype=np.int32)
            segment[order] = passed
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(segment[m:])], names=[*batch.schema.names, "segment"]
            )

    def count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places in the segments, which follow one another in a task."""
        current, reached = -1, 0
        for batch in batches:
            segment = np.asarray(batch["segment"])
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1, [len(segment)]])
            at = np.empty(len(segment), dtype=np.int64)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if segment[a] != current:
                    current, reached = segment[a], 0
                at[a:b] = np.arange(reached + 1, reached + b - a + 1)
                reached += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=[*batch.schema.names, "at"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema) + ", segment int"
    merged = work.write(
        runs.mapInArrow(assign, ddl)
        .repartitionById(segments, "segment")
        .sortWithinPartitions("segment", *_order(), "run", "place")
        .mapInArrow(count_on, f"{ddl}, at long"),
        "segments",
    )
    work.drop(runs)
    counts = {r.segment: r.n for r in merged.groupBy("segment").agg(F.max("at").alias("n")).collect()}
    before = np.cumsum([0] + [counts.get(s, 0) for s in range(segments)])
    prefix = rows.sparkSession.createDataFrame(
        [(s, int(before[s])) for s in range(segments)], "segment int, before long"
    )
    # Bound: one row per segment.
    return merged.join(F.broadcast(prefix), "segment").select(
        *rows.columns, (F.col("before") + F.col("at")).alias("rank")
    )


def resampling_weights(docs: DataFrame, target: DataFrame, *, text_col: str, buckets: int) -> np.ndarray:
    """The gains of the buckets, for documents and target texts alike in ``text_col``."""
    return gains(
        bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets)
    )


def draw(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; the rank is null unless
    the row is among the ``percent`` of those with enough words that are drawn."""
    work = Workspace(docs.sparkSession, "resampling")
    gain = resampling_weights(docs, target, text_col=text_col, buckets=buckets)
    scored = work.write(score(docs, gain, id_col=id_col, text_col=text_col, seed=seed), "scored")
    enough = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * enough.count() // 100
    placed = ranked(enough, work).withColumn("rank", F.expr(f"CASE WHEN rank <= {drawn} THEN rank END"))
    others = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(others)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of ``docs`` that are drawn, whole and each once.

    Only the score and id of the last drawn row are kept of the ranking: another pass over the
    texts takes the rows up to it, so no text is shuffled. Rows that equal the last one in both
    come together.
    """
    gain = resampling_weights(docs, target, text_col=text_col, buckets=buckets)
    work = Workspace(docs.sparkSession, "resampling")
    enough = score(docs, gain, id_col=id_col, text_col=text_col, seed=seed).filter(
        F.col("n_words") >= least_words
    )
    enough = work.write(enough, "scored")
    drawn = percent * enough.count() // 100
    last = ranked(enough, work).filter(F.col("rank") == drawn).first()
    if last is None:
        return docs.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = scored_batch(batch["id"], batch["text"], gain, seed)
            scores = np.asarray(rows["score"])
            ids = [math.inf if i is None else i for i in batch["id"].to_pylist()]
            end = math.inf if last.doc_id is None else last.doc_id
            before = np.array([i <= end for i in ids], dtype=bool)
            taken = (scores > last.score) | ((scores == last.score) & before)
            taken &= np.asarray(rows["n_words"]) >= least_words
            yield batch.select(["row"]).filter(pa.array(taken))

    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    row_only = rows.select("row").schema
    return rows.mapInArrow(run, row_only).select("row.*")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return draw(docs, target).drop("n_words")


SQL = rf"""
WITH RECURSIVE steps(i, k, v) AS (
    SELECT i, 0, i FROM range(256) r(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, {_POLYNOMIAL}) ELSE v >> 1 END
    FROM steps WHERE k < 8
), crc AS (
    SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8
), texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS id, doc_id, text FROM documents
    UNION ALL
    SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), split AS (
    SELECT kind, id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM texts
), words AS (
    SELECT kind, id, unnest(w) AS a, unnest(list_append(w[2:], NULL)) AS b FROM split
), features AS (
    SELECT kind, id, a AS feature FROM words
    UNION ALL
    SELECT kind, id, a || ' ' || b FROM words WHERE b IS NOT NULL
), counted AS (
    SELECT kind, id, feature, count(*) AS n FROM features GROUP BY ALL
), hashed AS (
    SELECT feature, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(
            range(1, octet_length(encode(feature)) + 1),
            lambda j: ('0x' || substr(hex(encode(feature)), 2 * j - 1, 2))::BIGINT)),
        lambda acc, y: xor(t[(xor(acc, y) & 255) + 1], acc >> 8))) % {BUCKETS} AS bucket
    FROM (SELECT DISTINCT feature FROM counted), crc
), in_bucket AS (
    SELECT kind, id, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL
), totals AS (
    SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::BIGINT AS s,
           coalesce(sum(n) FILTER (kind = 'b'), 0)::BIGINT AS t
    FROM in_bucket GROUP BY bucket
), gain AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM totals) + {BUCKETS}))::DOUBLE
        / ((s + 1) * ((SELECT sum(t) FROM totals) + {BUCKETS}))::DOUBLE))::BIGINT AS g
    FROM totals
), weighed AS (
    SELECT id, floor(sum(n * g)::DECIMAL(38, 0) / sum(n))::BIGINT AS weight, sum(n)::BIGINT AS n
    FROM in_bucket JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY id
), scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((
            ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE
        ) / 4294967296)))::BIGINT AS score
    FROM split LEFT JOIN weighed USING (id) WHERE kind = 'd'
), placed AS (
    SELECT *, CASE WHEN n_words >= {LEAST_WORDS} THEN row_number() OVER (
        PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) END AS place
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (
    SELECT {PERCENT} * count(*) // 100 FROM scored WHERE n_words >= {LEAST_WORDS}
) THEN place END AS rank
FROM placed
"""
