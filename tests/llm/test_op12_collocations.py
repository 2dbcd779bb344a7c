import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rawstrata.llm import op12_collocations as op12


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower)]


def brute_counts(rows, longest=5):
    counts = Counter()
    for lang, text in rows:
        for words in pieces(text):
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    return counts


def brute(rows, least, top, longest=5):
    counts = brute_counts(rows, longest)
    n = Counter()
    for (lang, phrase), f in counts.items():
        n[lang] += f * (len(phrase) == 1)
    found = {}
    for (lang, phrase), f in counts.items():
        if len(phrase) > 1 and f >= least:
            scores = []
            for k in range(1, len(phrase)):
                l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                scores.append((1000 * f * n[lang] // (l * r), k, l, r))
            found[lang, phrase] = (f, *min(scores))
    out = set()
    for lang in n:
        kept = []
        for (of, phrase), (a, score, _, l, r) in found.items():
            longer = any(
                other_lang == lang and len(other) > len(phrase) and f >= a
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                for (other_lang, other), (f, *_) in found.items()
            )
            if of == lang and not longer:
                kept.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def result(docs, **options):
    rows = op12.collocations(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    found = [tuple(r) for r in rows.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.fixture
def rows():
    draw = random.Random(5)
    out = []
    for i in range(200):
        words = [draw.choice("abcdefghij") * draw.randint(1, 2) for _ in range(draw.randint(0, 40))]
        words += ["New", "york", "City", "hall", "of", "ünï"] * draw.randint(0, 2)
        text = "".join(w + draw.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for w in words)
        out.append((["en", "de", None][min(2, i % 5)], text))
    return [*out, ("en", None), ("fr", ""), ("fr", " \t,, "), ("en", "a b c d e " * 300)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, rank int").repartition(3)


def test_equals_brute_force(spark, rows):
    docs = frame(spark, rows)
    for least, top in ((4, 1000), (30, 7)):
        assert result(docs, least=least, top=top) == brute(rows, least, top)


def test_units_and_parts_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(op12, "UNIT_BYTES", 64)  # also cuts the long text between pieces
    monkeypatch.setattr(op12, "LEAST_BITS", 64)  # filters that let nearly all pass
    monkeypatch.setattr(op12, "MOST_BITS", 64)
    assert result(frame(spark, rows), least=12, top=50) == brute(rows, 12, 50)


def test_long_texts_are_cut_between_pieces():
    text = "aa bb. " * 9 + "x" * 100 + " y " + "cc dd\n" * 9
    held = pa.array([text, "short"], pa.large_string())
    old, op12.UNIT_BYTES = op12.UNIT_BYTES, 20
    try:
        cut, _ = op12._cut_long(held, pa.array(["en", "de"], pa.large_string()))
    finally:
        op12.UNIT_BYTES = old
    assert "".join(cut.to_pylist()) == text + "short" and len(cut) > 5
    assert [p for t in cut.to_pylist()[:-1] for p in pieces(t) if p] == [p for p in pieces(text) if p]


@pytest.mark.parametrize("threshold", [3, 10, 40])
def test_no_frequent_key_is_lost(threshold):
    draw = np.random.default_rng(threshold)
    stream = np.concatenate([draw.zipf(1.2, 60_000) % 50_000, np.arange(40_000)]).astype(np.uint32)
    draw.shuffle(stream)
    summary = op12.Summary(len(stream), threshold)
    for part in np.array_split(stream, 40):
        keys, counts = np.unique(part, return_counts=True)
        summary.add(keys, counts)
        summary.fold()
        assert len(summary.keys) <= summary.capacity == len(stream) // threshold + 1
    assert 0 < summary.error < threshold
    keys, counts = np.unique(stream, return_counts=True)
    assert set(keys[counts >= threshold]) <= set(summary.survivors())


def test_full_summaries_lose_no_phrase(spark, rows):
    """One partition, so that its summary overflows."""
    docs = frame(spark, rows).select("lang", "text")
    frequent = spark.sparkContext.broadcast(op12.Bitmap(64, np.full(8, 255, dtype=np.uint8)))
    dealt = op12.dealt_counts(docs, frequent, 5, 1)
    kept = {r.hash & 0xFFFFFFFF00000000 for r in op12.surviving(dealt, 25, 1).collect()}
    held = next(op12.units(iter(docs.toArrow().to_batches())))
    want = {}
    for found in op12.phrases(held.ids, held.piece, held.hashes, 5):
        want |= dict(zip((found.hashes >> np.uint64(32)).tolist(), found.counts.tolist(), strict=True))
    assert {h << 32 for h, n in want.items() if n >= 25} <= kept
    assert len(kept) < len(want)


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    words = spark.createDataFrame(
        [("en", "a", big), ("en", "b", 2 * big), ("en", None, 9 * big)], "lang string, word string, f long"
    )
    found = spark.createDataFrame([("en", "a b", 2, big - 1)], "lang string, phrase string, size int, f long")
    row = op12.scored(words, found).first()
    assert row.score == 1000 * (big - 1) * 9 * big // (big * 2 * big)


def test_hot_language_is_cut_down_in_every_task(spark):
    rows = spark.range(5000).selectExpr("'en' AS lang", "concat('p', id) AS phrase", "id % 7 AS a", "id % 11 AS score")
    got = [r.phrase for r in op12.best(rows, 30).orderBy("rank").collect()]
    want = sorted(range(5000), key=lambda i: (-(i % 11), -(i % 7), f"p{i}"))[:30]
    assert got == [f"p{i}" for i in want]


def test_no_rows(spark, odd_documents):
    empty = spark.createDataFrame([], "lang string, text string")
    assert result(empty) == set()
    rows = [(r.lang, r.text) for r in odd_documents.collect()]
    assert result(odd_documents, least=3, top=40) == brute(rows, 3, 40)
