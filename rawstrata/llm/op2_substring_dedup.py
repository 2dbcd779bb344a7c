"""Substring near-duplicates by collinear chaining of shared k-mer seeds.

Seeds: hashes of ``SEED`` consecutive words, thinned by winnowing: of every ``WINDOW``
consecutive ones the least is kept, so any exact run of SEED + WINDOW - 1 words that two texts
share gives both the same seed. A seed that recurs at once, as in a run of one word, carries
the number of its turn, so the n-th of a run meets the n-th.

Shared seeds: a first pass over the texts deals four bytes of every seed to hash partitions and
finds those met twice. A bitmap of them, ``MOST_BITS`` bits at most, then keeps the seeds that one
document alone holds out of the shuffle; it never rejects a shared seed. The second pass makes the
seeds that remain and, where all seeds of a stretch are shared, long seeds: hashes of the
``LONG_SEED`` words from a seed on. Any exact run of ``LEAST_WORDS`` words that two texts share
holds one whole.

Join: rows are sorted by seed, document and place, and a seed in several documents is matched with
its occurrence in the smallest of their ids (its owner), so a passage that thousands share gives
one match per occurrence, never a pair of all. Where the parts of a passage have owners of their
own, its long seeds are owned by the first document that holds the parts together, and they match
all along. What can still be missed: a passage of which all long seeds have owners that share at
least ``LONG_SEED`` but fewer than ``LEAST_WORDS`` words with it. A seed met in more than ``HOT``
places is dealt to ``SALTS`` tasks by document: each finds the owner among its documents, and these
owners are matched with the smallest of them in a second step, so no task holds a hot seed alone.

Chains: the matches of a (document, owner) pair, ordered by place, are chained so that both
places rise. A match scores ``SEED``, and a gap costs ``GAP_COST`` per word skipped on either
side, less than a match earns for any gap within a chain. The best predecessor is a prefix maximum
over owner places, kept in a Fenwick tree, so a pair of m matches takes m log m steps. Chains are
cut where a gap exceeds ``MOST_GAP`` words between seeds.

Alignment: the words around each chain are fetched from both texts and aligned: equal runs and
stretches of the same length place by place, other gaps by edit distance, the ends as
far as the score does not drop. Passages of at least ``LEAST_WORDS`` words with a share of at
least ``LEAST_IDENTITY`` equal words are returned. Words are compared by 32 bits of a hash.

Special cases: null ids and null texts take no part; texts shorter than a passage have no
chains; whole copies are passages as long as the text; repeated rows of one id are one
document, compared by its first row, and not reported against themselves; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.llm.bitmap import bitmap
from rawstrata.llm.common import Workspace, apart_by, table
from rawstrata.llm.graph import runs
from rawstrata.llm.words import hash_shingles, hash_words, mix, slices, split_words

SEED = 5
WINDOW = 5
LEAST_WORDS = 50
LEAST_IDENTITY = 0.8
LONG_SEED = LEAST_WORDS - WINDOW + 1  # the first seed of a run begins in its first window
LONG_STEP = 7  # words between the matches of a long seed

MOST_GAP = 30  # words without a seed inside a chain, on either side
GAP_COST = 0.99 * SEED / (2 * (MOST_GAP + SEED))  # a gap that no chain is cut at pays
MARGIN = 40  # words beside a chain that the alignment may take in
LEAST_CHAIN = 16  # words a chain spans before it is aligned
LOAD = 200  # chains whose words are cut from a text at once

BYTES_A_PART = 1 << 25  # of text whose seeds are dealt to one hash partition
LEAST_PARTS, MOST_PARTS = 256, 1 << 16
BITS_EACH = 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # of a bitmap, 32 MB
HOT = 1 << 17  # places of a seed above which it is dealt to several tasks
SALTS = 64


class Seeds(NamedTuple):
    """Winnowed shingles of texts in text order, and the words they were taken from."""

    words: np.ndarray  # hashes of all words
    first: np.ndarray  # the number of each text's first word, as in Words
    text: np.ndarray
    place: np.ndarray
    hashes: np.ndarray


def winnowed(texts: pa.Array) -> Seeds:
    words = split_words(texts, lower=True)
    each = hash_words(words)
    hashes = hash_shingles(each, SEED)
    # A shingle belongs to the text its first word is in, if its last word is there too.
    counts = np.maximum(np.diff(words.first) - SEED + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(begin[-1]) - begin[text]
    hashes = hashes[words.first[text] + place]
    chosen = np.zeros(len(hashes), dtype=bool)
    starts = len(hashes) - WINDOW + 1
    if starts > 0:
        least = hashes[:starts].copy()
        for o in range(1, WINDOW):
            np.minimum(least, hashes[o : o + starts], out=least)
        whole = text[:starts] == text[WINDOW - 1 :]  # the window lies in one text
        for o in range(WINDOW):
            chosen[o : o + starts] |= whole & (hashes[o : o + starts] == least)
    at = np.flatnonzero(chosen)
    return Seeds(each, words.first, text[at], place[at], hashes[at])


def seeds_of(found: Seeds, passes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place, key, hash, whether long) of the short seeds that pass, and of the long ones
    of stretches where all pass. The hash is that of the short seed itself, or at the long one's
    beginning, without a turn: no key is in more places than its hash."""
    at = np.flatnonzero(passes)
    order, begins = _runs(found.text[at], found.place[at], found.hashes[at])
    at = at[order]
    index = np.arange(len(at))
    turn = index - np.maximum.accumulate(np.where(begins, index, 0))
    key = mix(found.hashes[at] + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    long_at, long_key = long_seeds(found, passes)
    both = np.concatenate([at, long_at])
    return (
        found.text[both],
        found.place[both],
        np.concatenate([key, long_key]),
        found.hashes[both],
        np.repeat([False, True], [len(at), len(long_at)]),
    )


def _runs(text: np.ndarray, place: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by text, key and place, and where a run of one key that recurs at once begins."""
    order = np.lexsort((place, keys, text))
    text, place, keys = text[order], place[order], keys[order]
    begins = np.ones(len(order), dtype=bool)
    begins[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
    begins[1:] |= np.diff(place) > MOST_GAP
    return order, begins


def long_seeds(found: Seeds, passes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds, by number, from which on the ``LONG_SEED`` words are a key, and that key: where
    the text has as many words and every seed of them may be shared; of those that recur at once,
    the first.

    Of a run that two texts share, the seeds in its last window may have been chosen for what
    follows it, so the last window of the words does not count.
    """
    if not len(found.text):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    whole = found.first[found.text] + found.place + LONG_SEED <= found.first[found.text + 1]
    code = found.text.astype(np.int64) << 32 | found.place
    stop = np.searchsorted(code, code + LONG_SEED - SEED - WINDOW + 1, "right")
    failed = np.concatenate([[0], np.cumsum(~passes)])
    at = np.flatnonzero(whole & (failed[stop] == failed[:-1]))
    word = found.first[found.text[at]] + found.place[at]
    key = np.full(len(at), LONG_SEED, dtype=np.uint64)
    for j in range(LONG_SEED):
        key = mix(key + found.words[word + j])
    order, begins = _runs(found.text[at], found.place[at], key)
    return at[order][begins], key[order][begins]


PRINT_BITS = 32


def _shift(parts: int) -> int:
    """Bits below those of a hash that name its partition and its fingerprint there."""
    return 64 - PRINT_BITS - parts.bit_length() + 1


def shared_seeds(docs: DataFrame, parts: int) -> DataFrame:
    """(hash, hot): the leading bits of all seeds' hashes that two documents may hold, and
    whether more than ``HOT`` places may hold it.

    Every task deals the fingerprints of a slice's seeds to the partitions, packed, once per
    text; those it met itself more often come apart, with their numbers.
    """
    shift = np.uint64(_shift(parts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch["text"]):
                found = winnowed(texts)
                order = np.lexsort((found.hashes, found.text))
                text, keys = found.text[order], found.hashes[order]
                once = np.ones(len(keys), dtype=bool)
                once[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
                keys, counts = np.unique(keys[once] >> shift, return_counts=True)
                part = (keys >> np.uint64(PRINT_BITS)).astype(np.int32)
                prints = keys.astype(np.uint32)
                begins = np.flatnonzero(np.diff(part, prepend=-1))
                ends = np.append(begins, len(part))[1:]
                ones, more = [], []
                for a, b in zip(begins, ends, strict=True):
                    single = counts[a:b] == 1
                    ones.append(prints[a:b][single].tobytes())
                    met = counts[a:b][~single].astype(np.uint32)
                    more.append(prints[a:b][~single].tobytes() + met.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[begins]), pa.array(ones, pa.binary()), pa.array(more, pa.binary())],
                    names=["part", "ones", "more"],
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in runs(batches, ["part"]):
            prints, counts = [], []
            for ones, more in zip(pack["ones"].to_pylist(), pack["more"].to_pylist(), strict=True):
                single = np.frombuffer(ones, dtype=np.uint32)
                both = np.frombuffer(more, dtype=np.uint32).reshape(2, -1)
                prints += [single, both[0]]
                counts += [np.ones(len(single), dtype=np.int64), both[1].astype(np.int64)]
            prints, counts = np.concatenate(prints), np.concatenate(counts)
            order = np.argsort(prints)
            prints, counts = prints[order], counts[order]
            begins = np.flatnonzero(np.diff(prints.astype(np.int64), prepend=-1))
            met = np.add.reduceat(counts, begins)
            held = prints[begins][met > 1].astype(np.uint64)
            held |= np.uint64(pack["part"][0].as_py()) << np.uint64(PRINT_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.view(np.int64)), pa.array(met[met > 1] > HOT)], names=["hash", "hot"]
            )

    return (
        docs.select("text")
        .mapInArrow(deal, "part int, ones binary, more binary")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(gather, "hash long, hot boolean")
    )


def seeds(docs: DataFrame, shared, hot, parts: int) -> DataFrame:
    """(key, salt, doc, place, long) of the seeds that may be shared; a hot one has a salt of its
    document, others -1."""
    shift = np.uint64(_shift(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch["doc_id"])
            for start, texts in slices(batch["text"]):
                found = winnowed(texts)
                text, place, key, hashes, is_long = seeds_of(found, shared.value(found.hashes >> shift))
                doc = ids[start + text]
                salt = (mix(doc.view(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
                salt[~hot.value(hashes >> shift)] = -1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(salt),
                        pa.array(doc, pa.int64()),
                        pa.array(place.astype(np.int32)),
                        pa.array(is_long),
                    ],
                    names=["key", "salt", "doc", "place", "long"],
                )

    return docs.mapInArrow(run, "key long, salt int, doc long, place int, long boolean")


MATCH = "doc long, ref long, place int, ref_place int, long boolean"


def _owned(batches: Iterator[pa.RecordBatch], owners_too: bool) -> Iterator[pa.RecordBatch]:
    """Matches of rows sorted by key, salt, document and place with the first of their key and
    salt; with ``owners_too``, the owners that have a salt come as rows matched with none."""
    last: tuple[int, int] | None = None
    owner = owner_place = 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, salt, doc, place = (np.asarray(batch[c]) for c in ("key", "salt", "doc", "place"))
        begins = np.ones(n, dtype=bool)
        begins[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        begins[0] = last != (int(key[0]), int(salt[0]))
        index = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
        ref = np.where(index >= 0, doc[index], owner)
        ref_place = np.where(index >= 0, place[index], owner_place)
        last, owner, owner_place = (int(key[-1]), int(salt[-1])), int(ref[-1]), int(ref_place[-1])
        taken = doc != ref
        if owners_too:
            taken |= begins & (salt >= 0)
        at = pa.array(np.flatnonzero(taken))
        out = pa.RecordBatch.from_arrays(
            [batch["key"], batch["doc"], pa.array(ref), batch["place"], pa.array(ref_place), batch["long"]],
            names=["key", "doc", "ref", "place", "ref_place", "long"],
        )
        yield out.take(at)


def owned_matches(found: DataFrame, any_hot: bool, work: Workspace) -> DataFrame:
    """(doc, ref, place, ref_place, long): every occurrence of a seed with its owner's."""

    def sorted_rows(rows: DataFrame, *by: str) -> DataFrame:
        return rows.repartition(*by).sortWithinPartitions(*by, "doc", "place")

    matched = sorted_rows(found, "key", "salt").mapInArrow(
        lambda batches: _owned(batches, any_hot), f"key long, {MATCH}"
    )
    if not any_hot:
        return matched.drop("key")
    matched = work.write(matched, "matched")
    owners = matched.filter("doc = ref").select("key", F.lit(0).alias("salt"), "doc", "place", "long")
    among_owners = sorted_rows(owners, "key", "salt").mapInArrow(
        lambda batches: _owned(batches, False), f"key long, {MATCH}"
    )
    return matched.filter("doc <> ref").unionByName(among_owners).drop("key")


class Fenwick:
    """Prefix maxima of (score, number) over places 1 to size."""

    def __init__(self, size: int):
        self.size = size
        self.score = [float("-inf")] * (size + 1)
        self.number = [-1] * (size + 1)

    def best(self, place: int) -> tuple[float, int]:
        score, number = float("-inf"), -1
        while place > 0:
            if self.score[place] > score:
                score, number = self.score[place], self.number[place]
            place &= place - 1
        return score, number

    def put(self, place: int, score: float, number: int) -> None:
        while place <= self.size:
            if score > self.score[place]:
                self.score[place], self.number[place] = score, number
            place += place & -place


def chain(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Index arrays of the chains of matches (x, y), best first, each match in one at most.

    Where all matches run in step (the next one equally far on both sides) the search would chain
    them all between gaps beyond the limit, so they are cut there without it.
    """
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    dx, dy = np.diff(x), np.diff(y)
    if ((dx > 0) & (dx == dy)).all():
        found = [np.arange(len(x))]
    else:
        found = search(x, y)
    out = []
    for members in found:
        gap = np.maximum(np.diff(x[members]), np.diff(y[members])) > MOST_GAP + SEED
        out += [order[part] for part in np.split(members, np.flatnonzero(gap) + 1)]
    return out


def search(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    places, rank = np.unique(y, return_inverse=True)
    tree = Fenwick(len(places))
    ranks, xs, ys = (rank + 1).tolist(), x.tolist(), y.tolist()
    size = len(xs)
    score, before = [0.0] * size, [-1] * size
    waiting: list[int] = []  # of the same x: entered when x has passed
    for i in range(size):
        if waiting and xs[waiting[0]] != xs[i]:
            for j in waiting:
                tree.put(ranks[j], score[j] + GAP_COST * (xs[j] + ys[j]), j)
            waiting = []
        best, j = tree.best(ranks[i] - 1)
        best -= GAP_COST * (xs[i] + ys[i])
        score[i] = SEED
        if best > 0:
            score[i], before[i] = SEED + best, j
        waiting.append(i)
    used = [False] * size
    found = []
    for i in sorted(range(size), key=lambda i: -score[i]):
        members = []
        while i >= 0 and not used[i]:
            used[i] = True
            members.append(i)
            i = before[i]
        if members:
            found.append(np.array(members[::-1]))
    return found


def along(x: np.ndarray, y: np.ndarray, is_long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matches of a pair, a long one as several in step from its first to its last place,
    where no short one is near."""
    if not is_long.any():
        return x, y

    def code(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.unique(((y.astype(np.int64) - x) << 32) + x)

    step = np.arange(0, LONG_SEED - SEED + 1, LONG_STEP)
    points = code(*((at[is_long][:, None] + step).ravel() for at in (x, y)))
    x, y = x[~is_long], y[~is_long]
    held = np.concatenate([[-(1 << 63)], code(x, y), [(1 << 63) - 1]])
    after = np.searchsorted(held, points)
    near = (held[after] < points + SEED) | (held[after - 1] > points - SEED)
    points = points[~near]
    more = points & 0xFFFFFFFF
    return np.concatenate([x, more]), np.concatenate([y, more + (points >> 32)])


def chains(matches: DataFrame) -> DataFrame:
    """(doc, ref, x, y): places of the chains' matches, as int32 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, bytes, bytes]] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc", "ref", "x", "y"],
            )

        for pair in runs(batches, ["doc", "ref"]):
            x, y = along(*(np.asarray(pair[c]) for c in ("place", "ref_place", "long")))
            if len(x) < 2:  # one seed alone is no chain
                continue
            if int(x.max()) - int(x.min()) + SEED < LEAST_CHAIN:
                continue
            doc, ref = pair["doc"][0].as_py(), pair["ref"][0].as_py()
            for members in chain(x, y):
                if x[members[-1]] - x[members[0]] + SEED >= LEAST_CHAIN:
                    out.append(
                        (doc, ref, x[members].astype(np.int32).tobytes(), y[members].astype(np.int32).tobytes())
                    )
            if len(out) >= 1000:
                yield batch_of()
                out.clear()
        if out:
            yield batch_of()

    return (
        matches.repartition("doc", "ref")
        .sortWithinPartitions("doc", "ref", "place")
        .mapInArrow(run, "doc long, ref long, x binary, y binary")
    )


def excerpts(docs: DataFrame, chained: DataFrame) -> DataFrame:
    """(chain, side, low, words): word hashes from ``low`` on, around each chain in both texts.

    The cuts asked of a text are grouped, at most about ``LOAD`` together, so a text that is
    the owner of very many chains is joined with several rows instead of one endless one.
    """
    wanted = chained.select(
        "chain",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("doc").alias("doc_id"), F.col("x0").alias("a"), F.col("x1").alias("b")),
                F.struct(F.lit(1).alias("side"), F.col("ref").alias("doc_id"), F.col("y0").alias("a"), F.col("y1").alias("b")),
            )
        ).alias("w"),
    ).select("chain", "w.*")
    loads = wanted.groupBy("doc_id").agg(F.ceil(F.count("*") / LOAD).alias("loads"))
    asked = (
        wanted.join(loads, "doc_id")
        .groupBy("doc_id", F.pmod(F.xxhash64("chain", "side"), "loads").alias("load"))
        .agg(F.collect_list(F.struct("chain", "side", "a", "b")).alias("cuts"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch["text"]):
                words = split_words(texts, lower=True)
                hashes = hash_words(words)
                rows = []
                for i, cuts in enumerate(batch["cuts"].slice(start, len(texts)).to_pylist()):
                    mine = hashes[words.first[i] : words.first[i + 1]]
                    for cut in cuts:
                        low = max(0, cut["a"] - MARGIN)
                        part = mine[low : cut["b"] + SEED + MARGIN]
                        rows.append((cut["chain"], cut["side"], low, (part >> np.uint64(32)).astype(np.uint32).tobytes()))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["chain", "side", "low", "words"],
                )

    # Only texts that have chains are shuffled.
    ids = chained.select(F.explode(F.array("doc", "ref")).alias("doc_id"))
    likely, _ = apart_by(docs, F.xxhash64("doc_id"), ids.select(F.xxhash64("doc_id").alias("h")))
    return (
        likely.join(asked, "doc_id")
        .select("text", "cuts")
        .mapInArrow(run, "chain long, side int, low int, words binary")
    )


def edit_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words in a best alignment of two short stretches (longest common subsequence)."""
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for word in a:
        step = np.maximum(row[1:], row[:-1] + (b == word))
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


def extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two stretches agree from their start, and the equal words on the way: 1 per
    equal word, -2 per other, given up 8 below the best."""
    size = min(len(a), len(b))
    if not size:
        return 0, 0
    equal = a[:size] == b[:size]
    score = np.cumsum(np.where(equal, 1, -2))
    high = np.maximum.accumulate(np.maximum(score, 0))
    fallen = np.flatnonzero(high - score > 8)
    stop = int(fallen[0]) if len(fallen) else size
    if not stop or score[:stop].max() <= 0:
        return 0, 0
    best = int(np.argmax(score[:stop])) + 1
    return best, int(equal[:best].sum())


def align(
    x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray
) -> tuple[int, int, int, int, int]:
    """(start, end, start, end, equal words) of the passage that a chain of seeds lies in."""
    left, left_equal = extend(a[: x[0]][::-1], b[: y[0]][::-1])
    end_a, end_b = int(x[-1]) + SEED, int(y[-1]) + SEED
    right, right_equal = extend(a[end_a:], b[end_b:])
    equal = left_equal + right_equal
    if end_a - x[0] == end_b - y[0] and (a[x[0] : end_a] == b[y[0] : end_b]).all():
        equal += end_a - int(x[0])
    else:
        at_a, at_b = int(x[0]), int(y[0])
        for stop_a, stop_b in [*zip(x[1:].tolist(), y[1:].tolist(), strict=True), (end_a, end_b)]:
            part_a, part_b = a[at_a:stop_a], b[at_b:stop_b]
            if len(part_a) == len(part_b):
                equal += int((part_a == part_b).sum())
            else:
                equal += edit_matches(part_a, part_b)
            at_a, at_b = stop_a, stop_b
    return int(x[0]) - left, end_a + right, int(y[0]) - left, end_b + right, equal


RESULT = (
    "doc_id long, ref_doc_id long, start int, end int, ref_start int, ref_end int, "
    "equal_words int, identity double"
)


def passages(chained: DataFrame, cuts: DataFrame, least_words: int, least_identity: float) -> DataFrame:
    """Align every chain with the two excerpts, which come first within its rows."""
    none = F.lit(None)
    rows = cuts.select(
        "chain", "side", "low", "words", none.cast("long").alias("doc"), none.cast("long").alias("ref"),
        none.cast("binary").alias("x"), none.cast("binary").alias("y"),
    ).union(
        chained.select(
            "chain", F.lit(2).alias("side"), none.cast("int").alias("low"), none.cast("binary").alias("words"),
            "doc", "ref", "x", "y",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 2 + [pa.int32()] * 5 + [pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

        for group in runs(batches, ["chain"]):
            sides: dict[int, dict] = {}
            for row in group.to_pylist():
                sides.setdefault(row["side"], row)  # of a repeated id, the first row
            if len(sides) < 3:
                continue
            low_a, low_b, held = sides[0]["low"], sides[1]["low"], sides[2]
            a, b = (np.frombuffer(sides[s]["words"], dtype=np.uint32) for s in (0, 1))
            x = np.frombuffer(held["x"], dtype=np.int32) - low_a
            y = np.frombuffer(held["y"], dtype=np.int32) - low_b
            if x[-1] + SEED > len(a) or y[-1] + SEED > len(b):
                continue  # a repeated id whose rows differ
            start, end, ref_start, ref_end, equal = align(x, y, a, b)
            size = max(end - start, ref_end - ref_start)
            if min(end - start, ref_end - ref_start) >= least_words and equal >= least_identity * size:
                out.append(
                    (held["doc"], held["ref"], start + low_a, end + low_a,
                     ref_start + low_b, ref_end + low_b, equal, equal / size)
                )
            if len(out) >= 1000:
                yield batch_of()
                out.clear()
        if out:
            yield batch_of()

    return (
        rows.repartition("chain")
        .sortWithinPartitions("chain", "side", "low")
        .mapInArrow(run, RESULT)
    )


def _likely_seeds(texts: DataFrame, work: Workspace) -> tuple[DataFrame, bool]:
    """The rows of :func:`seeds`, and whether any has a salt."""
    spark = texts.sparkSession
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = LEAST_PARTS
    while parts < MOST_PARTS and parts * BYTES_A_PART < size:
        parts *= 2
    shared = work.write(shared_seeds(texts, parts), "shared")
    n, n_hot = shared.agg(F.count("*"), F.count_if("hot")).first()
    sizes = {"bits_each": BITS_EACH, "least": LEAST_BITS, "most": MOST_BITS}
    bitmaps = [
        spark.sparkContext.broadcast(bitmap(rows, count, **sizes))
        for rows, count in ((shared, n), (shared.filter("hot"), n_hot))
    ]
    work.drop(shared)
    return seeds(texts, *bitmaps, parts), n_hot > 0


def repeated_passages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    least_identity: float = LEAST_IDENTITY,
) -> DataFrame:
    """One row per passage of a document that repeats in one of smaller id, places in words."""
    work = Workspace(docs.sparkSession, "substring_dedup")
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).dropna()
    matches = owned_matches(*_likely_seeds(texts, work), work)
    chained = work.write(
        chains(matches).select(
            F.monotonically_increasing_id().alias("chain"), "doc", "ref", "x", "y"
        ),
        "chains",
    )

    def place(column: str, last: bool) -> Column:
        """A place from the little-endian bytes of the first or last match."""
        at = F.length(column) - 3 if last else F.lit(1)
        four = [F.hex(F.substring(F.col(column), at + i, F.lit(1))) for i in (3, 2, 1, 0)]
        return F.conv(F.concat(*four), 16, 10).cast("int")

    bounded = chained.select(
        "chain", "doc", "ref", place("x", False).alias("x0"), place("x", True).alias("x1"),
        place("y", False).alias("y0"), place("y", True).alias("y1"),
    )
    return passages(chained, excerpts(texts, bounded), least_words, least_identity)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
