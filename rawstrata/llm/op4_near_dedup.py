"""Near-duplicates by a chosen-path set similarity join over minwise tokens.

Every text becomes its set of word shingles (64-bit hashes) and a signature of ``TOKENS``
minwise tokens. Texts with equal sets form a class, which goes on as one.

Chosen path: a tree's node is a set of classes. A node picks coordinates by its own hash,
1 / similarity of them on average, and every class follows each picked coordinate to the child
named by its token there; two classes stay together with a chance of their similarity per
coordinate. Nodes of at most ``LEAF`` classes, and those that remain at ``DEPTH``, are compared
exhaustively by signature, generously enough that a pair over the threshold is missed with a
chance of about 1e-5. ``TREES`` independent trees bring the chance that a pair just
at the threshold shares a compared node to over 0.999.

What that connects is then compared exactly: the whole sets of each connected group, in tasks of
bounded size, with numpy over the group's vocabulary. Exact links give the components. Shingles
stand for their texts by 64-bit hashes throughout, and equal sets are told by 128 bits of them.

Only signatures, ids and, for texts with a candidate partner, one text per class are shuffled.
Nodes and groups of any size are dealt into bounded parts (see ``graph.spanning_links``); no
pairs of a whole group are emitted, and components are joined tables, never on the driver.

Special cases: a text without words, or none, has an empty set, is its own component and linked
with nothing; fewer words than a shingle make one shingle; a row without id takes the component
of its set's class (null if no row of the class has an id); rows that repeat an id are one
vertex; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, likely_among, table
from rawstrata.llm.graph import Linker, components, spanning_links
from rawstrata.llm.words import mix, shingle_sets

WORDS = 5
PERCENT = 80  # similarity in percent from which two sets are linked

TOKENS = 64
TREES = 12
LEAF = 200
DEPTH = 5
PART_CLASSES = 4096  # classes compared by signature in one task
PART_SHINGLES = 1_500_000  # shingles compared exactly in one task
CAUTION = 4.5  # standard deviations below the threshold that a signature may lie

_MULTIPLIERS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SECOND = np.uint64(0xD1B54A32D192ED03)
_ROWS_AT_ONCE = 1 << 14


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least of ``TOKENS`` hash functions over a set: multiply, take the high bits."""
    out = np.full(TOKENS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(shingles), _ROWS_AT_ONCE):
        part = shingles[at : at + _ROWS_AT_ONCE, None] * _MULTIPLIERS
        out = np.minimum(out, (part.min(axis=0) >> np.uint64(32)).astype(np.uint32))
    return out


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, n, h1, h2, tokens): set size, its 128-bit hash, the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, tokens = [], [], [], []
            for _, found in shingle_sets(batch["text"], words):
                n.append(len(found))
                h1.append(int(mix(found).sum(dtype=np.uint64).view(np.int64)))
                h2.append(int(mix(found ^ _SECOND).sum(dtype=np.uint64).view(np.int64)))
                tokens.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(n, pa.int64()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.array(tokens, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n", "h1", "h2", "tokens"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"),
    ).mapInArrow(run, "doc_id long, text_hash long, n long, h1 long, h2 long, tokens binary")


def _token(at: str) -> str:
    """SQL: a token of the signature as text; four bytes each."""
    return f"hex(substring(tokens, 4 * ({at}) + 1, 4))"


def children(rows: DataFrame, percent: int) -> DataFrame:
    """(node, rep) of the children: every row follows the coordinates its node picks."""
    more = 100 * 100 // percent - 100  # chance of a second coordinate, in percent
    picked = (
        f"filter(array(pmod(xxhash64(node, 'first'), {TOKENS}), CASE WHEN"
        f" pmod(xxhash64(node, 'more'), 100) < {more} THEN pmod(xxhash64(node, 'second'), {TOKENS}) END),"
        " j -> j IS NOT NULL)"
    )
    child = f"transform(array_distinct({picked}), j -> xxhash64(node, j, {_token('CAST(j AS INT)')}))"
    return rows.select(F.explode(F.expr(child)).alias("node"), "rep")


def compared_nodes(classes: DataFrame, percent: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Written rows (group, rep) and sizes (group, n) of all trees' nodes that are compared."""
    tree = F.explode(F.sequence(F.lit(1), F.lit(TREES)))
    rows = classes.select(tree.alias("tree"), "rep", "tokens")
    rows = rows.select(F.xxhash64(F.lit("root"), "tree").alias("node"), "rep", "tokens")
    done: list[tuple[DataFrame, DataFrame]] = []
    held: list[DataFrame] = []
    tokens = classes.select("rep", "tokens")
    for depth in range(1, DEPTH + 1):
        level = work.write(children(rows, percent), f"level{depth}")
        counted = work.write(
            level.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"), f"nodes{depth}"
        )
        held += [level, counted]
        final = counted if depth == DEPTH else counted.filter(F.col("n") <= LEAF)
        done.append((level.join(final.select("node"), "node"), final))
        large = counted.filter(F.col("n") > LEAF)
        if depth == DEPTH or large.isEmpty():
            break
        rows = level.join(large.select("node"), "node").join(tokens, "rep").distinct()
    members, sizes = done[0]
    for more, more_sizes in done[1:]:
        members, sizes = members.union(more), sizes.union(more_sizes)
    # Read by every later step; the levels are not, so they go before anything else is written.
    members = work.write(members.withColumnRenamed("node", "group"), "members")
    sizes = work.write(sizes.withColumnRenamed("node", "group"), "sizes")
    work.drop(*held)
    return members, sizes


def by_signature(percent: int) -> Linker:
    j = percent / 100
    least = TOKENS * j - CAUTION * np.sqrt(TOKENS * j * (1 - j))

    def link(payloads: pa.ChunkedArray):
        tokens = np.frombuffer(b"".join(payloads.to_pylist()), dtype=np.uint32)
        tokens = tokens.reshape(-1, TOKENS)
        return np.arange(len(tokens)), lambda i: (tokens == tokens[i]).sum(axis=1) >= least

    return link


def by_sets(words: int, percent: int) -> Linker:
    """Exact comparison. Central texts, with many of the group's frequent shingles, go first."""

    def link(payloads: pa.ChunkedArray):
        sets = [found for _, found in shingle_sets(payloads.combine_chunks(), words)]
        sizes = np.array([len(s) for s in sets])
        first = np.concatenate([[0], np.cumsum(sizes)])
        vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
        frequency = np.bincount(ids, minlength=len(vocabulary))
        order = np.argsort(-(np.add.reduceat(frequency[ids], first[:-1]) / sizes), kind="stable")

        def linked(i: int) -> np.ndarray:
            mark = np.zeros(len(vocabulary), dtype=np.int64)
            mark[ids[first[i] : first[i + 1]]] = 1
            both = np.add.reduceat(mark[ids], first[:-1])
            return 100 * both >= percent * (sizes + sizes[i] - both)

        return order, linked

    return link


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_classes: int = PART_CLASSES,
    part_shingles: int = PART_SHINGLES,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    work = Workspace(docs.sparkSession, "near_duplicates")
    held = work.write(sketches(docs, words, id_col, text_col), "sketches")
    key = ["n", "h1", "h2"]
    classes = work.write(
        held.groupBy(*key)
        .agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("one"),
            F.min("tokens").alias("tokens"),
        )
        .select(*key, F.col("one.doc_id").alias("rep"), F.col("one.text_hash").alias("text_hash"), "tokens"),
        "classes",
    )
    alive = classes.filter("n > 0 AND rep IS NOT NULL")

    members, sizes = compared_nodes(alive, percent, work)
    tokens = alive.select(F.col("rep").alias("member"), F.col("tokens").alias("payload"))
    candidates = spanning_links(
        members.withColumnRenamed("rep", "member"),
        sizes.select("group", F.ceil(F.col("n") / part_classes).alias("chunks")),
        tokens,
        by_signature(percent),
        work,
    )
    grouped = components(candidates, work)
    work.drop(members, sizes)

    inside = work.write(
        alive.join(grouped, alive.rep == grouped.id).select(
            F.col("component").alias("group"), F.col("rep").alias("member"), "text_hash", "n"
        ),
        "inside",
    )
    texts = docs.select(
        F.col(id_col).cast("long").alias("member"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("payload"),
    )
    links = spanning_links(
        inside.drop("n"),
        inside.groupBy("group").agg(F.ceil(F.sum("n") / part_shingles).alias("chunks")),
        likely_among(texts, inside.select("text_hash"), "text_hash"),
        by_sets(words, percent),
        work,
    )
    final = components(links, work)
    named = classes.join(final, classes.rep == final.id, "left").select(
        *key, F.coalesce("component", "rep").alias("component_id")
    )
    # A set's class, but for empty sets: they are linked with nothing.
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return held.join(named, key).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * common >= 85 * (nx.n + ny.n - common)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""
