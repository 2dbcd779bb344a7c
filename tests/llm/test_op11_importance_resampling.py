import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from rawstrata.llm import op11_importance_resampling as op11
from rawstrata.llm.common import Workspace
from rawstrata.llm.words import split_words


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features_of(text):
    words = words_of(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def brute(docs, target, percent=25, least=20, seed=7, buckets=10_000):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features_of(t))

    s, t = count(text for _, text in docs), count(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
            for b in (zlib.crc32(f.encode()) % buckets for f in features_of(text))
        ]
        weight = sum(gains) // len(gains) if gains else 0
        drawn = f"{seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(drawn.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc_id, len(words_of(text)), len(gains), weight, score))
    order = sorted(
        (r for r in rows if r[1] >= least),
        key=lambda r: (-r[4], math.inf if r[0] is None else r[0]),
    )
    held = Counter(r for r in rows if r[1] < least)
    out = Counter({(*r, None): n for r, n in held.items()})
    most = percent * len(order) // 100
    out.update((*r, i + 1 if i < most else None) for i, r in enumerate(order))
    return out


COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


def drawn(docs, target, **options):
    return Counter(tuple(r) for r in op11.draw(docs, target, **options).select(*COLUMNS).collect())


def test_buckets_of_all_kinds_of_words():
    texts = ["Ünï a1-B2 " + "x" * 70 + " y", "", None, "é", "one two one two", "z" * 40 + " " + "w" * 41]
    words = split_words(pa.array(texts), lower=True, blank=op11.SEPARATOR)
    single, double, paired = op11.feature_buckets(words, 997)
    want = [zlib.crc32(f.encode()) % 997 for t in texts for f in words_of(t)]
    assert single.tolist() == want
    pairs = [f for t in texts for f in features_of(t) if " " in f]
    assert double[paired].tolist() == [zlib.crc32(f.encode()) % 997 for f in pairs]


def test_draw_equals_brute_force(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    rows += [(100 + i, f"alpha beta{i % 7} gamma{i % 3} " * (5 + i % 9)) for i in range(300)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rank int")
    target = ["gamma1 alpha", None, "", "Weather of this WEEK " * 30]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    assert drawn(docs, frame) == brute(rows, target)
    assert drawn(docs, frame, percent=100, least_words=0) == brute(rows, target, 100, 0)


def test_repeated_rows_get_ranks_of_their_own(spark):
    rows = [(7, "a b c d e f g h i j k l m n o p q r s t u")] * 400 + [(i, "v w " * 12) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("a b",)], "text string")
    assert drawn(docs, target, percent=100) == brute(rows, ["a b"], 100)


def test_segments_split_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(op11, "SEGMENT_ROWS", 50)
    rows = spark.range(1000).selectExpr("7L AS doc_id", "0L AS score").repartition(6)
    work = Workspace(spark, "test_segments")
    runs = work.write(rows.mapInArrow(op11._with_run, "doc_id long, score long, run long, place long"), "runs")
    splitters = op11.regular_splitters(runs, 1000, 20)
    assert len(np.unique(splitters, axis=1).T) == 19
    ranks = [r.rank for r in op11.ranked(rows, work).collect()]
    assert sorted(ranks) == list(range(1, 1001))


def test_resample_returns_whole_rows(spark):
    rows = [(i, f"alpha beta{i % 7} gamma{i % 3} " * (5 + i % 9), "x") for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, None, "y")], "doc_id long, text string, row string")
    target = spark.createDataFrame([("gamma1 alpha",)], "text string")
    found = op11.draw(docs, target).filter("rank IS NOT NULL").collect()
    kept = op11.resample(docs, target)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {rows[r.doc_id] for r in found}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert op11.draw(docs, docs).count() == 0
    assert op11.resample(docs, some).count() == 0
    assert drawn(some, docs, percent=100) == brute([(1, "a b c " * 10)], [], 100)
