"""Phrase collocations: Misra-Gries summaries find the candidates, a second pass counts them.

Everything is per language. Words are counted first, which gives n and the frequent words; a
phrase with a rarer word cannot be frequent, so the next passes leave such phrases out.

First pass over phrases: every task counts the phrases of a unit of text and deals their hashes
to hash partitions. For every partition the masses arrive before the counts, so its summary
knows its capacity, mass / threshold + 1, from the start. Folding a count into a full summary
subtracts the (capacity + 1)-th largest counter from all (the merge of Misra-Gries summaries).
Each subtraction of c takes c from more than ``capacity`` counters, so all of them together stay
below the threshold: a frequent phrase always keeps a counter. What survives is every phrase
whose counter plus the summary's error reaches the threshold; equal hashes only add survivors.

Second pass: phrases that may have survived (a bitmap of at most ``MOST_BITS`` bits says so,
never wrongly no) are counted by their text, exactly, first in every task and then by hash
partition, and those below the threshold go.

Special cases: a null text counts as empty, a null language as ``und``; ids are not used, so
nulls and repeated rows need no care (a repeated row counts again); an empty table, or one
without frequent phrases, gives no rows; columns other than the named ones are ignored. A text
longer than a unit is cut between two pieces, which changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rawstrata.llm.bitmap import Bitmap, bitmap
from rawstrata.llm.common import Workspace, table
from rawstrata.llm.words import Words, hash_words, mix, raw_bytes, split_words

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
NO_LANGUAGE = "und"

UNIT_BYTES = 4 << 20  # of text counted at once in a task
MASS_A_PART = 1 << 26  # occurrences dealt to one hash partition, as far as MOST_PARTS lets
LEAST_PARTS, MOST_PARTS = 256, 1 << 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # of a bitmap, 32 MB
BITS_EACH = 64
SALTS = 16  # of words that many phrases begin or end with

CUT = np.zeros(256, dtype=bool)
CUT[list(b".,;:!?\n\x0b\x0c\r")] = True
SEPARATOR = CUT.copy()
SEPARATOR[[0x20, 0x09]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
FINGERPRINT_BITS = 32


class Unit(NamedTuple):
    """Words in text order: ``ids`` of (language, word), equal ``piece`` for words of a piece."""

    ids: np.ndarray
    piece: np.ndarray
    languages: pa.Array
    words: pa.Array
    language_of: np.ndarray  # of every id
    word_of: np.ndarray
    hashes: np.ndarray


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0, 1, ... for equal keys, and the distinct keys."""
    found = pa.array(keys).dictionary_encode()
    return np.asarray(found.indices), np.asarray(found.dictionary)


def _hashes(texts: pa.Array) -> np.ndarray:
    data, offsets = raw_bytes(texts)
    return hash_words(Words(data, offsets, offsets[:-1], offsets[1:], offsets))


def _cut_long(texts: pa.Array, languages: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Texts longer than a unit in several, cut after the first delimiter beyond a unit."""
    sizes = np.asarray(pc.binary_length(texts).fill_null(0))
    if not (sizes > UNIT_BYTES).any():
        return texts, languages
    out, held = [], []
    for text, language, size in zip(texts.to_pylist(), languages.to_pylist(), sizes, strict=True):
        if size <= UNIT_BYTES:
            out.append(text)
            held.append(language)
            continue
        raw = text.encode()
        cuts = np.flatnonzero(CUT[np.frombuffer(raw, dtype=np.uint8)])
        start = 0
        while start < len(raw):
            at = int(np.searchsorted(cuts, start + UNIT_BYTES))
            stop = int(cuts[at]) + 1 if at < len(cuts) else len(raw)
            out.append(raw[start:stop].decode())
            held.append(language)
            start = stop
    return pa.array(out, pa.large_string()), pa.array(held, pa.large_string())


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[Unit]:
    """Consecutive rows of (lang, text), about ``UNIT_BYTES`` at a time."""
    texts, languages, size = [], [], 0
    for batch in batches:
        text, language = _cut_long(
            batch["text"].cast(pa.large_string()),
            batch["lang"].cast(pa.large_string()).fill_null(NO_LANGUAGE),
        )
        done = 0
        ends = np.cumsum(np.asarray(pc.binary_length(text).fill_null(0), dtype=np.int64))
        while done < len(text):
            before = int(ends[done - 1]) if done else 0
            stop = int(np.searchsorted(ends, before + UNIT_BYTES - size, "right"))
            stop = min(len(text), max(stop, done if size else done + 1))
            texts.append(text.slice(done, stop - done))
            languages.append(language.slice(done, stop - done))
            size += (int(ends[stop - 1]) if stop else 0) - before
            done = stop
            if done < len(text):
                yield unit(pa.concat_arrays(texts), pa.concat_arrays(languages))
                texts, languages, size = [], [], 0
    if texts:
        yield unit(pa.concat_arrays(texts), pa.concat_arrays(languages))


def unit(texts: pa.Array, languages: pa.Array) -> Unit:
    words = split_words(texts, lower=True, blank=SEPARATOR)
    cuts = np.zeros(len(words.data) + 1, dtype=np.int64)
    np.cumsum(CUT[words.data], out=cuts[1:])
    text = np.repeat(np.arange(len(texts)), np.diff(words.first))
    piece = cuts[words.starts] + text
    sizes = np.zeros(len(words.starts) + 1, dtype=np.int64)
    np.cumsum(words.ends - words.starts, out=sizes[1:])
    packed = words.data[~SEPARATOR[words.data]]
    held = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(sizes), pa.py_buffer(packed)]
    ).dictionary_encode()
    spoken = languages.dictionary_encode()
    known = max(1, len(held.dictionary))
    language = np.asarray(spoken.indices)[text].astype(np.int64)
    ids, keys = _named(language * known + np.asarray(held.indices))
    language_of, word_of = keys // known, keys % known
    dictionary = held.dictionary.view(pa.large_string())
    return Unit(
        ids,
        piece,
        spoken.dictionary,
        dictionary,
        language_of,
        word_of,
        mix(_hashes(dictionary)[word_of] + mix(_hashes(spoken.dictionary))[language_of] * _ODD),
    )


class Phrases(NamedTuple):
    """Distinct phrases of one length in a unit."""

    size: int
    hashes: np.ndarray
    counts: np.ndarray
    places: np.ndarray  # of one occurrence of each, among the words looked at


def frequent_only(held: Unit, frequent: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """Ids and pieces of the frequent words; a word left out ends a piece."""
    ok = frequent(held.hashes)[held.ids]
    return held.ids[ok], (held.piece + np.cumsum(~ok))[ok]


def phrases(
    ids: np.ndarray, piece: np.ndarray, hashes: np.ndarray, longest: int, wanted=None
) -> Iterator[Phrases]:
    """Phrases of 2 to ``longest`` words with their counts, a length at a time.

    ``wanted`` tells by its hash whether a phrase can matter; one that cannot is in no longer
    phrase that can. Phrases are told apart by numbers of their words and never by hashes.
    """
    known = len(hashes)
    place = np.arange(len(ids))
    current, current_hashes = ids.astype(np.int64), hashes
    for size in range(2, longest + 1):
        # place[i] begins a phrase one word shorter; so must the next place
        follows = np.zeros(len(place), dtype=bool)
        follows[:-1] = place[1:] == place[:-1] + 1
        last = place + size - 1
        follows &= last < len(ids)
        follows[follows] = piece[last[follows]] == piece[place[follows]]
        place, prefix = place[follows], current[follows]
        ending = ids[place + size - 1]
        current, keys = _named(prefix * known + ending)
        current_hashes = mix(
            current_hashes[keys // known] * _ODD + hashes[keys % known] + np.uint64(size)
        )
        if wanted is not None:
            ok = wanted(current_hashes)
            number = np.cumsum(ok) - 1
            kept = ok[current]
            place, current = place[kept], number[current[kept]]
            current_hashes = current_hashes[ok]
        current = current.astype(np.int64)
        first = np.zeros(len(current_hashes), dtype=np.int64)
        first[current] = place
        yield Phrases(size, current_hashes, np.bincount(current, minlength=len(first)), first)


HELD_ROWS = 1 << 18  # of counts a task adds up before it hands them on


def added_up(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with equal keys as one, their ``f`` added up, as far as a task's memory lets."""
    held: list[pa.RecordBatch] = []
    for part in parts:
        held.append(part)
        if sum(len(p) for p in held) >= HELD_ROWS:
            table = _together(held, keys)
            held = table.to_batches()
            if len(table) >= HELD_ROWS // 2:
                yield from held
                held = []
    if held:
        yield from _together(held, keys).to_batches()


def _together(parts: list[pa.RecordBatch], keys: list[str]) -> pa.Table:
    added = pa.Table.from_batches(parts).group_by(keys).aggregate([("f", "sum")])
    return added.rename_columns([*keys, "f"]).combine_chunks()


def _text_of(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )


def word_counts(docs: DataFrame, least: int, work: Workspace) -> DataFrame:
    """(lang, word, f, hash) of the frequent words, and a row without word for all words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in units(batches):
            counts = np.bincount(held.ids, minlength=len(held.hashes))
            every = np.bincount(held.language_of, counts, len(held.languages)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([held.languages.take(pa.array(held.language_of)), held.languages]),
                    pa.concat_arrays(
                        [held.words.take(pa.array(held.word_of)), pa.nulls(len(every), pa.large_string())]
                    ),
                    pa.array(np.concatenate([counts, every])),
                    pa.array(np.concatenate([held.hashes, np.zeros(len(every), np.uint64)]).view(np.int64)),
                ],
                names=["lang", "word", "f", "hash"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from added_up(each(batches), ["lang", "word", "hash"])

    counted = (
        docs.mapInArrow(run, "lang string, word string, hash long, f long")
        .groupBy("lang", "word")
        .agg(F.sum("f").alias("f"), F.first("hash").alias("hash"))
    )
    return work.write(counted.filter((F.col("f") >= least) | F.col("word").isNull()), "words")


def dealt_counts(docs: DataFrame, frequent, longest: int, parts: int) -> DataFrame:
    """Counts of the phrases of every unit, by hash partition: (part, mass) rows without
    fingerprints, and rows with the fingerprints of phrases found once, and more often."""
    shift = np.uint64(64 - FINGERPRINT_BITS - parts.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in units(batches):
            ids, piece = frequent_only(held, frequent.value)
            found = list(phrases(ids, piece, held.hashes, longest))
            keys = np.concatenate([x.hashes for x in found]) >> shift
            counts = np.concatenate([x.counts for x in found])
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            part = (keys >> np.uint64(FINGERPRINT_BITS)).astype(np.int32)
            prints = keys.astype(np.uint32)
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(begins, len(part))[1:]
            ones, more, mass = [], [], []
            for a, b in zip(begins, ends, strict=True):
                n, p = counts[a:b], prints[a:b]
                once = n == 1
                ones.append(p[once].tobytes())
                # counts above 32 bits cannot come from one unit
                more.append(p[~once].tobytes() + n[~once].astype(np.uint32).tobytes())
                mass.append(int(n.sum()))
            of = pa.array(part[begins])
            none = pa.nulls(len(of), pa.binary())
            names = ["part", "mass", "ones", "more"]
            yield pa.RecordBatch.from_arrays([of, pa.array(mass, pa.int64()), none, none], names=names)
            yield pa.RecordBatch.from_arrays(
                [of, pa.nulls(len(of), pa.int64()), pa.array(ones, pa.binary()), pa.array(more, pa.binary())],
                names=names,
            )

    return docs.mapInArrow(run, "part int, mass long, ones binary, more binary")


class Summary:
    """A Misra-Gries summary of fingerprints: counters at most ``error`` too low."""

    def __init__(self, mass: int, threshold: int):
        self.threshold = threshold
        self.capacity = mass // threshold + 1
        self.error = 0
        self.keys = np.empty(0, dtype=np.uint32)
        self.counts = np.empty(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > max(self.capacity, 1 << 18):
            self.fold()

    def fold(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        begins = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
        self.keys = keys[begins]
        self.counts = np.add.reduceat(counts, begins) if len(begins) else counts
        if len(self.keys) > self.capacity:
            at = len(self.keys) - self.capacity - 1
            taken = int(np.partition(self.counts, at)[at])
            self.error += taken
            ok = self.counts > taken
            self.keys, self.counts = self.keys[ok], self.counts[ok] - taken

    def survivors(self) -> np.ndarray:
        self.fold()
        return self.keys[self.counts + self.error >= self.threshold]


def surviving(dealt: DataFrame, threshold: int, parts: int) -> DataFrame:
    """``hash`` of all phrases that can reach the threshold: the leading bits of theirs."""
    shift = 64 - FINGERPRINT_BITS - parts.bit_length() + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def ended() -> pa.RecordBatch:
            keys = summary.survivors().astype(np.uint64) if summary else np.empty(0, np.uint64)
            if part is not None:
                keys |= np.uint64(part) << np.uint64(FINGERPRINT_BITS)
            return pa.RecordBatch.from_arrays([pa.array((keys << np.uint64(shift)).view(np.int64))], names=["hash"])

        for batch in batches:
            for at, more_mass, ones, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != part:
                    yield ended()
                    part, mass, summary = at, 0, None
                if ones is None:
                    mass += more_mass
                    continue
                summary = summary or Summary(mass, threshold)
                once = np.frombuffer(ones, dtype=np.uint32)
                summary.add(once, np.ones(len(once), dtype=np.int64))
                both = np.frombuffer(more, dtype=np.uint32).reshape(2, -1)
                summary.add(both[0], both[1].astype(np.int64))
        yield ended()

    return (
        dealt.repartition("part")
        .sortWithinPartitions("part", F.col("ones").isNotNull())
        .mapInArrow(run, "hash long")
    )


def phrase_counts(docs: DataFrame, frequent, likely, longest: int, least: int, parts: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of 2 to ``longest`` words found ``least`` times."""
    shift = np.uint64(64 - FINGERPRINT_BITS - parts.bit_length() + 1)
    columns = ["lang", "phrase", "size", "f"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in units(batches):
            ids, piece = frequent_only(held, frequent.value)
            survived = likely.value
            for found in phrases(ids, piece, held.hashes, longest, lambda h: survived(h >> shift)):
                texts = [
                    held.words.take(pa.array(held.word_of[ids[found.places + j]]))
                    for j in range(found.size)
                ]
                blank = pa.scalar(" ", pa.large_string())
                part = (found.hashes >> shift >> np.uint64(FINGERPRINT_BITS)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part),
                        held.languages.take(pa.array(held.language_of[ids[found.places]])),
                        pc.binary_join_element_wise(*texts, blank),
                        pa.array(np.full(len(found.counts), found.size, dtype=np.int32)),
                        pa.array(found.counts),
                    ],
                    names=["part", *columns],
                )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of a task, packed by hash partition."""
        for added in added_up(each(batches), ["part", *columns[:3]]):
            order = np.argsort(np.asarray(added["part"]), kind="stable")
            added = added.take(pa.array(order))
            part = np.asarray(added["part"])
            begins = np.flatnonzero(np.diff(part, prepend=-1))
            offsets = pa.array(np.append(begins, len(part)).astype(np.int32))
            packed = [pa.ListArray.from_arrays(offsets, added[c].cast(t)) for c, t in PACKED.items()]
            yield pa.RecordBatch.from_arrays([pa.array(part[begins]), *packed], names=["part", *columns])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of every partition, whose packs follow one another."""

        def unpacked() -> Iterator[tuple[int, pa.RecordBatch]]:
            for batch in batches:
                for i in range(batch.num_rows):
                    one = [batch[c].slice(i, 1).flatten() for c in columns]
                    yield batch["part"][i].as_py(), pa.RecordBatch.from_arrays(one, names=columns)

        for _, packs in groupby(unpacked(), key=lambda found: found[0]):
            held, rows = [], 0
            for _, pack in packs:
                held.append(pack)
                rows += len(pack)
                if rows >= HELD_ROWS:
                    held = _together(held, columns[:3]).to_batches()
                    rows = sum(len(b) for b in held) // 2  # what stays does not count twice
            every = _together(held, columns[:3])
            yield from every.filter(pc.field("f") >= least).combine_chunks().to_batches()

    return (
        docs.mapInArrow(
            deal, "part int, lang array<string>, phrase array<string>, size array<int>, f array<long>"
        )
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(add, "lang string, phrase string, size int, f long")
    )


PACKED = {"lang": pa.string(), "phrase": pa.string(), "size": pa.int32(), "f": pa.int64()}


def _bitmap_sizes() -> dict[str, int]:
    return {"bits_each": BITS_EACH, "least": LEAST_BITS, "most": MOST_BITS}


def frequent_phrases(
    docs: DataFrame,
    work: Workspace,
    *,
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
    lang_col: str = "lang",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f) of frequent words, with a row without word for n, and (lang, phrase,
    size, f) of frequent phrases. All counts are exact."""
    spark = docs.sparkSession
    texts = _text_of(docs, lang_col, text_col)
    words = word_counts(texts, least, work)
    n_words, mass = words.selectExpr(
        "count(word)", "coalesce(sum(f) FILTER (WHERE word IS NULL), 0)"
    ).first()
    parts = LEAST_PARTS
    while parts < MOST_PARTS and parts * MASS_A_PART < mass * (longest - 1):
        parts *= 2
    frequent = spark.sparkContext.broadcast(
        bitmap(words.filter("word IS NOT NULL"), n_words, **_bitmap_sizes())
    )
    survivors = work.write(
        surviving(dealt_counts(texts, frequent, longest, parts), least, parts), "survivors"
    )
    shift = 64 - FINGERPRINT_BITS - parts.bit_length() + 1
    leading = survivors.select(F.shiftrightunsigned("hash", shift).alias("hash"))
    likely = spark.sparkContext.broadcast(bitmap(leading, survivors.count(), **_bitmap_sizes()))
    found = work.write(phrase_counts(texts, frequent, likely, longest, least, parts), "phrases")
    work.drop(survivors)
    return words, found


def _salt(phrase: str) -> Column:
    return F.pmod(F.hash(phrase), F.lit(SALTS))


def scored(words: DataFrame, found: DataFrame, *, contained_percent: int = 100) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score): each phrase by its lowest-scoring cut. Phrases
    that lie in a longer one with at least that share of their count are left out.

    A word many phrases begin or end with, and a language, meet their phrases in ``SALTS`` parts.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    n = words.filter("word IS NULL").select("lang", F.col("f").alias("n"), every)
    counts = words.filter("word IS NOT NULL").select("lang", F.col("word").alias("part"), "f", every)
    counts = counts.unionByName(
        found.select("lang", F.col("phrase").alias("part"), "f", F.lit(0).alias("salt"))
    )
    with_n = found.withColumn("salt", _salt("phrase")).join(n, ["lang", "salt"]).drop("salt")
    cuts = with_n.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cuts = cuts.withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
    for part, name, one in (("first", "l", F.col("k") == 1), ("rest", "r", F.col("k") == F.col("size") - 1)):
        side = counts.select("lang", F.col("part").alias(part), F.col("f").alias(name), "salt")
        cuts = cuts.withColumn("salt", F.when(one, _salt("phrase")).otherwise(0))
        cuts = cuts.join(side, ["lang", part, "salt"]).drop("salt")
    whole = "DECIMAL(19, 0)"
    exact = F.expr(f"CAST(1000 * (CAST(f AS {whole}) * CAST(n AS {whole})) AS DECIMAL(38, 0))"
                   f" div (CAST(l AS {whole}) * CAST(r AS {whole}))")  # fmt: skip
    # A longer candidate with enough of the count has one of one word more with enough of it.
    inside = found.filter("size > 2").select(
        "lang",
        F.explode(
            F.expr("array(substring_index(phrase, ' ', size - 1), substring_index(phrase, ' ', 1 - size))")
        ).alias("phrase"),
        F.col("f").alias("longer"),
    )
    cut = F.struct(exact.alias("score"), "k", "l", "r")
    rows = cuts.select("lang", "phrase", "size", F.col("f").alias("a"), "n", cut.alias("cut"))
    rows = rows.unionByName(inside, allowMissingColumns=True)
    return (
        rows.groupBy("lang", "phrase")
        .agg(*(F.max(c).alias(c) for c in ("size", "a", "n", "longer")), F.min("cut").alias("cut"))
        .filter(F.coalesce(100 * F.col("longer"), F.lit(0)) < contained_percent * F.col("a"))
        .select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def best(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of every language with their rank. Every task first keeps only as many of
    its own, so a language's rows never meet whole."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, n = None, 0
        for batch in batches:
            kept = []
            for at, lang in enumerate(batch["lang"].to_pylist()):
                if lang != language:
                    language, n = lang, 0
                n += 1
                if n <= top:
                    kept.append(at)
            yield batch.take(pa.array(kept, pa.int64()))

    own = rows.sortWithinPartitions("lang", *order).mapInArrow(first_of_each, rows.schema)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return own.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    *,
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
    top: int = TOP,
    contained_percent: int = 100,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """lang, rank, phrase, size, a, l, r, n, score of every language's best phrases."""
    work = Workspace(docs.sparkSession, "collocations")
    words, found = frequent_phrases(
        docs, work, longest=longest, least=least, lang_col=lang_col, text_col=text_col
    )
    return best(scored(words, found, contained_percent=contained_percent), top)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("size")


SQL = rf"""
WITH split AS (
    SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, unnest(string_split_regex(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM split
), found AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
        lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM pieces, range(1, {LONGEST + 1}) s(size) WHERE len(w) >= size
), counts AS (
    SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM found GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= {LEAST_COUNT}
), cuts AS (
    SELECT c.lang, c.phrase, c.size, c.f AS a, n, k, x.f AS l, y.f AS r, 1000 * c.f * n // (x.f * y.f) AS score
    FROM candidates c JOIN totals USING (lang), range(1, {LONGEST}) p(k), counts x, counts y
    WHERE k < c.size AND x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
    AND y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longer
    FROM candidates, range(2, {LONGEST}) q(s), range(1, {LONGEST}) p(i)
    WHERE s < size AND i + s - 1 <= size GROUP BY ALL
), kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
    WHERE longer IS NULL OR 100 * longer < 100 * a
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
    score::BIGINT AS score
FROM placed WHERE rank <= {TOP}
"""
