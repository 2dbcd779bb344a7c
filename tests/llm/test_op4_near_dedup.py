import random

import pytest

from rawstrata.llm import op4_near_dedup as op


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return {(i, len(s), label[i], label[i] == i) for i, s in sets.items()}


def corpus(draw, families):
    """Families of texts with ever more words changed; similarities lie on both sides."""
    rows = []
    for _ in range(families):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.randrange(5, 120))]
        for _ in range(draw.randrange(1, 14)):
            text = list(base)
            for _ in range(draw.randrange(0, 5)):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(documents, size, percent):
    rows = corpus(random.Random(size), 50)
    frame = documents([(i, t, "en", "a", 0) for i, t in rows])
    got = {tuple(r) for r in op.near_duplicates(frame, words=size, percent=percent).collect()}
    assert got == brute(rows, size, percent)


def test_large_groups_in_small_parts(documents, monkeypatch):
    """Deep trees and groups of several parts, with bounds far below their sizes."""
    monkeypatch.setattr(op, "LEAF", 10)
    draw = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for _ in range(160):
        text = list(base)
        for _ in range(draw.randrange(0, 7)):
            text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
        rows.append((len(rows), " ".join(text)))
    frame = documents([(i, t, "en", "a", 0) for i, t in rows])
    got = op.near_duplicates(frame, words=3, percent=85, part_classes=25, part_shingles=3000)
    assert {tuple(r) for r in got.collect()} == brute(rows, 3, 85)


def test_odd_rows(odd_documents):
    got = [tuple(r) for r in op.near_duplicates(odd_documents).collect()]
    by_id = {i: (n, c, k) for i, n, c, k in got}
    assert len(got) == 10
    assert by_id[2][1:] == (1, False) and by_id[1][1:] == (1, True)
    assert by_id[None][1:] == (1, False)
    assert [by_id[i] for i in (3, 4, 5)] == [(0, 3, True), (0, 4, True), (0, 5, True)]
    assert by_id[6] == (1, 6, True) and by_id[7] == (1, 7, True)
    assert op.near_duplicates(odd_documents.limit(0)).count() == 0
