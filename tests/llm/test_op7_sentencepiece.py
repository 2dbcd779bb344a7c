from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rawstrata.llm import op7_sentencepiece as op

MODEL = op.read_model(op.MODEL)
ENCODER = op.Encoder(MODEL)
SCORES = {text: (score, i) for text, score, i in ENCODER.vocabulary.pieces}


def ids_of(text):
    return np.frombuffer(ENCODER.encode(text), dtype=np.int32).tolist()


def best_score(text):
    """By trying all segmentations, from the end; an uncovered character is one unknown."""

    @lru_cache(maxsize=None)
    def rest(at):
        if at == len(text):
            return 0.0
        found = []
        if text[at] not in SCORES:
            found.append(ENCODER.unknown_score + rest(at + 1))
        for end in range(at + 1, min(len(text), at + 48) + 1):
            if text[at:end] in SCORES:
                found.append(SCORES[text[at:end]][0] + rest(end))
        return max(found)

    return rest(0)


def score_of(ids, text):
    """Of a segmentation; each uncovered character of the text counts once."""
    held = {i: score for score, i in SCORES.values()}
    unknown = sum(c not in SCORES for c in text)
    return sum(held.get(i, 0.0) for i in ids) + unknown * ENCODER.unknown_score


@given(st.text(alphabet="the cat sono\n日é🎉x", max_size=24))
@settings(max_examples=200, deadline=None)
def test_segmentation_has_the_best_score(text):
    if text:
        marked = (" " + text).replace(" ", op.MARK)
        assert score_of(ids_of(text), marked) == pytest.approx(best_score(marked))


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_round_trip(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODER.decode(ids_of(text)) == text


def test_cutting_changes_nothing():
    whole = op.Encoder(MODEL)
    whole.chunks = op.re.compile(r"[^▁]+|▁").findall
    for text in ("hello  world\nagain and  again", "  lead", "trail  \n\n x", "a" * 300):
        assert whole.encode(text) == ENCODER.encode(text)


def test_odd_rows_and_frames(odd_documents):
    encoded = op.encode(odd_documents)
    rows = encoded.collect()
    assert len(rows) == 10 and all(r.restored is not False for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].ids is None and by_id[3].restored is None and by_id[4].ids == []
    decoded = {r.doc_id: r.text for r in op.decode(encoded).collect()}
    assert decoded == {r.doc_id: r.text for r in odd_documents.collect()}
    assert op.encode(odd_documents.limit(0)).count() == 0


def test_the_cache_stays_bounded_within_one_text(monkeypatch):
    encoder = op.Encoder(op.read_model(op.MODEL))
    monkeypatch.setattr(op, "CACHE_ENTRIES", 50)
    text = " ".join(f"w{i}" for i in range(400))
    ids = np.frombuffer(encoder.encode(text), np.int32).tolist()
    assert len(encoder) <= 50 and encoder.decode(ids) == text
    assert ids == np.frombuffer(op.Encoder(op.read_model(op.MODEL)).encode(text), np.int32).tolist()
