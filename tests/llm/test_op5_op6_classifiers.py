import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rawstrata.llm import op5_toxicity, op6_quality_classifier
from rawstrata.llm.common import fold
from rawstrata.llm.words import split_words


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        calm = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(draw.randrange(20, 200))]
        toxic, quality = int(i % 4 == 0), int(i % 5 != 0)
        if toxic:
            for _ in range(4):
                calm[draw.randrange(len(calm))] = draw.choice(["moronic", "moron!", "m0ron", "Stupidly", "stupid"])
        if not quality:
            at = draw.randrange(max(1, len(calm) - 15))
            calm[at : at + 15] = ["###$$$ |"] * 15
        rows.append((i, " ".join(calm)))
        if i % 9:
            labels.append((i, quality, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string").cache()
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out_accuracy(scored, labels, label, threshold):
    joined = scored.join(labels, "doc_id").filter(fold("doc_id") == 0)
    right = (F.col("score") >= threshold).cast("int") == F.col(label)
    return joined.agg(F.avg(right.cast("int"))).first()[0]


def test_toxicity_on_documents_held_out(corpus):
    docs, labels = corpus
    scored = op5_toxicity.fit(docs, labels)(docs)
    assert scored.count() == 900
    assert held_out_accuracy(scored, labels, "toxic", 0.5) > 0.95


def test_quality_on_documents_held_out(corpus):
    docs, labels = corpus
    model = op6_quality_classifier.fit(docs, labels)
    scored = op6_quality_classifier.score(docs, model)
    assert scored.count() == 900
    assert held_out_accuracy(scored, labels, "quality", 0.3) > 0.95


def test_attention_lies_on_the_passage_that_decides(corpus):
    docs, labels = corpus
    model = op6_quality_classifier.fit(docs, labels)
    junk = " ".join(["calm words here again"] * 32 + ["###$$$ |"] * 32 + ["some other calm words"] * 32)
    frame = docs.sparkSession.createDataFrame([(1, junk)], "doc_id long, text string")
    assert op6_quality_classifier.score(frame, model).first().top_passage in (2, 3)


def test_held_out_labels_are_not_learned(corpus):
    """Turning the labels of held-out documents around changes no score."""
    docs, labels = corpus
    held = fold("doc_id") == 0
    turned = labels.select(
        "doc_id", *[F.when(held, 1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")]
    )
    some = docs.limit(50)
    for a, b in zip(*[op5_toxicity.fit(docs, x)(some).sort("doc_id").collect() for x in (labels, turned)], strict=True):
        assert a.score == pytest.approx(b.score)
    for a, b in zip(
        *[
            op6_quality_classifier.score(some, op6_quality_classifier.fit(docs, x)).sort("doc_id").collect()
            for x in (labels, turned)
        ],
        strict=True,
    ):
        assert a.score == pytest.approx(b.score)


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(1, 1, 0), (2, 0, 1), (2, None, None), (None, 1, 1), (8, 0, 1), (6, 1, 0)]])
def test_odd_rows(odd_documents, labels, rows):
    given = labels(rows)
    quality = op6_quality_classifier.score(odd_documents, op6_quality_classifier.fit(odd_documents, given))
    toxic = op5_toxicity.fit(odd_documents, given)(odd_documents.select("doc_id", "text"))
    for scored in (quality, toxic):
        got = scored.collect()
        assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    empty = odd_documents.limit(0)
    assert op6_quality_classifier.score(empty, op6_quality_classifier.fit(empty, given)).count() == 0
    assert op5_toxicity.fit(empty, given)(empty.select("doc_id", "text")).count() == 0


def odd_texts(count):
    draw = random.Random(12)
    alphabet = ["a", "Be", "STOP", "you", "m0r0n", "!", "?!", "x.", "#|#", "12", "é", "(du)", "a\nb", "$tu-pid"]
    texts = ["".join(draw.choice(alphabet) + draw.choice([" ", "\n", "  "]) for _ in range(draw.randrange(0, 150))) for _ in range(count)]
    return [*texts, "", " \n", None, "one", "word " * 64, "word " * 65]


def naive_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def naive_passage(text, words, starts):
    """The passage's features, one by one, in bytes as the operator counts them."""
    n = len(words)
    if not n:
        return [0.0] * 14
    raw = [w.encode() for w in words]
    size = sum(map(len, raw))
    span = (text or "").encode()[starts[0] : starts[-1] + len(raw[-1])]

    def count(members):
        return sum(b in members for b in span)

    upper, lower = (sum(bytes([b]).isalpha() and getattr(bytes([b]), kind)() for b in span) for kind in ("isupper", "islower"))
    foreign = sum(b >= 128 for b in span)
    return [
        math.log1p(n), size / n, upper / (upper + lower + foreign + 1), count(b"0123456789") / size,
        count(b"#*$%&|<>=+~^{}[]\\_@/") / n, count(b"|") / n, count(b"!") / n, count(b".,;:?") / n,
        count(b"\n") / n, foreign / size, len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, sum(len(w) <= 3 for w in raw) / n, 1.0,
    ]


def test_passages_equal_a_plain_count():
    texts = odd_texts(40)
    x, first = op6_quality_classifier.passages(pa.array(texts))
    for i, text in enumerate(texts):
        found = list(re.finditer(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
        words, starts = naive_words(text), [m.start() for m in found]
        want = [
            naive_passage(text, words[a : a + 64], starts[a : a + 64])
            for a in range(0, max(1, len(words)), 64)
        ]
        assert np.allclose(x[first[i] : first[i + 1]], want)


def test_attention_equals_plain_sums():
    x, first = op6_quality_classifier.passages(pa.array(odd_texts(20)))
    model = op6_quality_classifier.AttentionModel(x.mean(0), x.std(0) + 1e-6)
    score, weight = model.score(x, first)
    p = model.weights
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        hidden, logits = [], []
        for row in x[a:b]:
            row = [min(8, max(-8, (v - m) / s)) for v, m, s in zip(row, model.mean, model.scale, strict=True)]
            h = [math.tanh(sum(v * w for v, w in zip(row, p["encode"][:, j], strict=True)) + p["bias"][j]) for j in range(16)]
            gate = 0.0
            for g in range(8):
                v = math.tanh(sum(h[j] * p["V"][j, g] for j in range(16)))
                u = 1 / (1 + math.exp(-sum(h[j] * p["U"][j, g] for j in range(16))))
                gate += p["w"][g] * v * u
            hidden.append(h)
            logits.append(math.exp(gate))
        share = [e / sum(logits) for e in logits]
        assert np.allclose(weight[a:b], share)
        z = [sum(s * h[j] for s, h in zip(share, hidden, strict=True)) for j in range(16)]
        logit = sum(z[j] * p["classify"][j] for j in range(16)) + p["offset"][0]
        assert score[i] == pytest.approx(1 / (1 + math.exp(-logit)))


def test_gradient_equals_differences():
    draw = np.random.default_rng(2)
    x, first = op6_quality_classifier.passages(pa.array(odd_texts(12)))
    model = op6_quality_classifier.AttentionModel(x.mean(0), x.std(0) + 1e-6)
    label = draw.integers(0, 2, len(first) - 1).astype(float)

    def loss():
        s = model.score(x, first)[0]
        return -np.mean(label * np.log(s) + (1 - label) * np.log(1 - s))

    found = model.gradient(model.forward(x, first), first, label)
    for name, w in model.weights.items():
        for _ in range(4):
            at = tuple(draw.integers(0, n) for n in w.shape)
            held, step = w[at], 1e-5
            w[at] = held + step
            high = loss()
            w[at] = held - step
            low = loss()
            w[at] = held
            assert found[name][at] == pytest.approx((high - low) / (2 * step), abs=1e-6)


def test_long_labelled_documents_are_learned(spark):
    """Documents of far more than 64 passages alone, which must not leave the sample empty."""
    calm, junk = "calm words here again ", "###$$$ | "
    rows = [(i, (calm * 1200) + (junk * 900 if i % 2 else calm * 225)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    given = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    scored = op6_quality_classifier.score(docs, op6_quality_classifier.fit(docs, given))
    assert held_out_accuracy(scored, given, "quality", 0.5) == 1.0
    few = op6_quality_classifier.fit(docs, given, most_passages=90 * 9)
    assert few.constant is None or 0 <= few.constant <= 1
    assert op6_quality_classifier.fit(docs, given, most_passages=10).constant == 0.5


def naive_toxic(text, weights, person):
    """The features of one text, word by word."""
    out = dict.fromkeys(op5_toxicity.FEATURES, 0.0)
    words = [w.encode() for w in naive_words(text)]
    if not words:
        return out
    letter = {*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)}
    n = len(words)
    table = bytes(op5_toxicity._PLAIN.tolist())
    plain, weight, is_person, odd, capitals = [], [], [], 0, 0
    for w in words:
        at = [i for i, b in enumerate(w) if b in letter]
        inner = w[at[0] : at[-1] + 1] if at else w
        held = inner.translate(table)
        plain.append(held)
        weight.append(max([weights.get((held[:k], k), 0.0) for k in op5_toxicity.BEGINNINGS] + [weights.get((held, 0), 0.0)]))
        is_person.append(held in person)
        letters = sum(b in letter for b in inner)
        odd += letters >= 2 and letters < len(inner)
        upper, every = sum(65 <= b <= 90 for b in w), sum(b in letter for b in w)
        capitals += upper >= 2 and upper == every
    strong, fair, weak = ([w >= 4 for w in weight], [w >= 2 for w in weight], [w > 0 for w in weight])
    near = [any(is_person[max(0, i - 5) : i + 6]) for i in range(n)]
    raw = (text or "").encode()
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    inside = raw[spans[0][0] : spans[-1][1]]
    all_upper = sum(65 <= b <= 90 for w in words for b in w)
    all_letters = sum(b in letter for w in words for b in w)
    values = [
        math.log1p(n), sum(map(len, words)) / n, sum(weight) / n, max(weight),
        min(sum(strong), 50), sum(strong) / n, min(sum(fair), 50), sum(fair) / n,
        min(sum(weak), 50), sum(weak) / n,
        sum(a and b for a, b in zip(fair, near, strict=True)) / max(1, sum(fair)), sum(is_person) / n,
        all_upper / (all_letters + 1), capitals / n,
        sum(b in b"!?" for b in inside) / n, sum(b in b"!?.,;:'\"()-" for b in inside) / n, odd / n,
    ]
    return dict(zip(op5_toxicity.FEATURES, values, strict=True))


def test_toxicity_features_equal_a_plain_count():
    texts = odd_texts(60)
    entries = {("moron", 5): 4.5, ("stup", 4): 2.5, ("stop", 0): 1.0, ("be", 0): 3.0}
    keys, weights, plain = [], [], {}
    for (text, limit), weight in entries.items():
        words = split_words(pa.array([text]))
        every = dict(zip((*op5_toxicity.BEGINNINGS, 0), op5_toxicity.keys_of(words), strict=True))
        keys.append(every[limit][0])
        weights.append(weight)
        plain[text.encode(), limit] = weight
        if limit:  # words shorter than a limit have the key of all of themselves under it
            assert len(text) >= limit
    lexicon = op5_toxicity.Lexicon(np.array(keys, dtype=np.uint64), np.array(weights))
    person = {w.encode() for w in op5_toxicity.SECOND_PERSON}
    got = op5_toxicity.features(pa.array(texts), lexicon, op5_toxicity._person_keys())
    for i, text in enumerate(texts):
        want = naive_toxic(text, plain, person)
        assert dict(zip(op5_toxicity.FEATURES, got[i], strict=True)) == pytest.approx(want), text
