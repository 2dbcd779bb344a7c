import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as pipeline
from rawstrata.llm import op6_quality_classifier, op7_sentencepiece


@pytest.fixture
def sf_dir(spark, tmp_path):
    draw = random.Random(1)
    words = {"en": "abcdefg", "de": "hijklmn", "fr": "opqrstu"}
    rows, labels = [], []
    for i in range(200):
        lang = ["en", "en", "en", "de", "fr"][i % 5]
        text = ["".join(draw.choice(words[lang]) for _ in range(4)) for _ in range(90)]
        if i % 10 == 1:
            text[:60] = ["###$$$ |"] * 60
        if i % 10 == 2:
            text[40:40] = ["token", "=", f'"{draw.getrandbits(160):040x}"']
        if i % 10 == 3:
            text[40:40] = ["order", str(draw.randrange(10**15, 10**16))]
        rows.append([i, " ".join(text), lang, f"s{i % 2}", 0])
        labels.append((i, int(i % 10 != 1), 0))
    for i in range(20):  # near copies of clean documents
        text = rows[i * 10][1].split()
        text[50] = "changed"
        rows.append([300 + i, " ".join(text), rows[i * 10][2], "s0", 0])
    for r in rows:
        r[4] = len(r[1])
    spark.createDataFrame(
        [tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    return str(tmp_path)


def test_every_stage_and_the_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    clean = {i for i in range(200) if i % 10 != 1}

    kept = pipeline.quality(spark, docs, sf_dir).cache()
    assert kept.columns == columns
    assert {r.doc_id for r in kept.collect()} == clean | set(range(300, 320))

    single = pipeline.near_duplicates(spark, kept, sf_dir).cache()
    assert single.columns == columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(clean)

    redacted = pipeline.secrets(spark, single, sf_dir).cache()
    assert redacted.columns == columns
    for r in redacted.collect():
        assert ("<SECRET>" in r.text) == (r.doc_id % 10 == 2) and r.n_chars == len(r.text)

    mixed = pipeline.mixing(spark, redacted, sf_dir).cache()
    assert mixed.columns == columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) == clean
    words = Counter()
    for r in mixed.collect():
        words[r.lang] += len(r.text.split())
    plain = Counter()
    for r in redacted.collect():
        plain[r.lang] += len(r.text.split())
    wanted = np.array([plain[x] ** 0.7 for x in sorted(plain)])
    got = np.array([words[x] for x in sorted(words)], float)
    assert np.allclose(got / got.sum(), wanted / wanted.sum(), atol=0.05)

    encoded = pipeline.sentencepiece(spark, mixed, sf_dir)
    assert all(r.restored for r in encoded.collect())
    texts = {r.doc_id: r.text for r in redacted.collect()}
    for r in op7_sentencepiece.decode(encoded).collect():
        assert r.text == texts[r.doc_id]

    rows = pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in rows) == copies


def test_stage_names():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "near_dedup", "secret_scan", "mixing", "sentencepiece",
    ]


def test_odd_rows(spark, odd_documents, labels, tmp_path):
    labels([(1, 1, 0), (6, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (odd_documents, odd_documents.limit(0)):
        docs = rows
        for name, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == rows.columns, name
        docs = docs.cache()
        ids = {r.doc_id for r in docs.collect()}
        assert ids == ({1, 3, 4, 5, 6, 7, 8} if rows is odd_documents else set())
        assert pipeline.sentencepiece(spark, docs, str(tmp_path)).count() == docs.count()


def test_rows_without_id(spark, documents):
    """They lose secrets and near copies as rows with an id do."""
    draw = random.Random(3)

    def text(secret=False):
        words = ["".join(draw.choice("abcdefg") for _ in range(5)) for _ in range(80)]
        if secret:
            words[40:40] = ["token", "=", f'"{draw.getrandbits(160):040x}"']
        else:
            words[40:40] = ["order", str(draw.randrange(10**15, 10**16))]
        return " ".join(words)

    def copy(of):
        return of.rsplit(" ", 1)[0] + " changed"

    with_id, leaky, clean = text(), text(secret=True), text()
    rows = [(5, with_id), (None, copy(with_id)), (None, leaky), (None, copy(leaky)), (None, clean)]
    rows += [(None, clean), (None, None), (7, text(secret=True))]
    rows += [(10 + i, text(secret=i % 2 == 0)) for i in range(40)]
    docs = documents([(i, t, "en", "a", len(t or "")) for i, t in rows])

    single = pipeline.near_duplicates(spark, docs, "")
    got = [r.text for r in single.collect() if r.doc_id is None]
    assert len(got) == 3 and {None, clean} < set(got) and {leaky, copy(leaky)} & set(got)
    ids = sorted(r.doc_id for r in single.collect() if r.doc_id is not None)
    assert ids == [5, 7, *range(10, 50)]

    redacted = pipeline.secrets(spark, docs, "").collect()
    assert len(redacted) == len(rows)
    assert sum("<SECRET>" in (r.text or "") for r in redacted) == 23
    for r in redacted:
        assert "token = \"<SECRET>" in r.text if "token" in (r.text or "") else r.text != ""
        assert r.n_chars == len(r.text or "")


def test_a_classifier_that_rejects_nothing_keeps_all(spark, odd_documents):
    model = op6_quality_classifier.AttentionModel(np.zeros(14), np.ones(14), 0.3)
    assert op6_quality_classifier.keep(odd_documents, model).count() == 10
