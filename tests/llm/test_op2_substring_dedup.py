import random

from rawstrata.llm import op2_substring_dedup as op


def words(draw, count):
    return ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(count)]


def found(documents, texts):
    frame = documents([(i, t, "en", "a", 0) for i, t in texts.items()])
    return op.repeated_passages(frame).collect()


def test_exact_and_fuzzy_passages(documents):
    draw = random.Random(1)
    passage = words(draw, 90)
    fuzzy = list(passage)
    del fuzzy[40]
    fuzzy[70:70] = ["extra", "words"]
    fuzzy[20] = "other"
    texts = {
        1: words(draw, 100) + passage + words(draw, 100),
        2: words(draw, 30) + passage,
        3: fuzzy + words(draw, 200),
        4: words(draw, 300),
        5: passage[:45] + words(draw, 60),  # too short a passage
    }
    rows = {r.doc_id: r for r in found(documents, {i: " ".join(t) for i, t in texts.items()})}
    assert set(rows) == {2, 3} and {r.ref_doc_id for r in rows.values()} == {1}
    two, three = rows[2], rows[3]
    assert (two.start, two.end, two.ref_start, two.ref_end) == (30, 120, 100, 190)
    assert two.identity == 1.0 and two.equal_words == 90
    assert three.start == 0 and three.end == 91 and three.equal_words == 88


def test_whole_copies_and_runs_within_a_text(documents):
    draw = random.Random(2)
    text = " ".join(words(draw, 80))
    rows = found(documents, {i: text for i in range(1, 40)})
    assert sorted(r.doc_id for r in rows) == list(range(2, 40))
    assert {(r.ref_doc_id, r.start, r.end) for r in rows} == {(1, 0, 80)}


def test_every_shared_run_of_fifty_words_is_found(documents):
    """Against brute force over all runs of 50 words."""
    draw = random.Random(4)
    pool = [words(draw, draw.randrange(50, 90)) for _ in range(6)]
    texts = {}
    for i in range(40):
        text = []
        for _ in range(3):
            text += words(draw, draw.randrange(10, 60))
            if draw.random() < 0.4:
                text += draw.choice(pool)
        texts[i] = " ".join(text)
    seen = {}
    for i, text in texts.items():
        w = text.split()
        for j in range(len(w) - 49):
            seen.setdefault(tuple(w[j : j + 50]), set()).add(i)
    shared = [s for s in seen.values() if len(s) > 1]
    assert {r.doc_id for r in found(documents, texts)} == {i for s in shared for i in s - {min(s)}}


def test_passages_whose_parts_have_other_owners(documents):
    """Nested and recombined passages against brute force over all runs of 50 words."""
    draw = random.Random(6)
    phrases = [words(draw, 25) for _ in range(8)]
    texts = {i: words(draw, 30) + p + words(draw, 30) for i, p in enumerate(phrases)}
    for i in range(8, 60):
        text = words(draw, 20)
        for _ in range(draw.randrange(1, 4)):
            for p in draw.sample(phrases, draw.randrange(1, 4)):
                text += p
            text += words(draw, draw.randrange(10, 40))
        texts[i] = text
    joined = phrases[0] + phrases[1] + phrases[2]
    texts[60], texts[61] = words(draw, 40) + joined, joined + words(draw, 40)
    seen = {}
    for i, text in texts.items():
        for j in range(len(text) - 49):
            seen.setdefault(tuple(text[j : j + 50]), set()).add(i)
    shared = [s for s in seen.values() if len(s) > 1]
    rows = found(documents, {i: " ".join(t) for i, t in texts.items()})
    want = {i for s in shared for i in s - {min(s)}}
    assert {61} < want and {r.doc_id for r in rows} == want


def test_odd_rows(odd_documents):
    rows = op.repeated_passages(odd_documents).collect()
    assert {(r.doc_id, r.ref_doc_id) for r in rows} == {(2, 1)}
    assert op.repeated_passages(odd_documents.limit(0)).count() == 0


def test_chaining_prefers_collinear_matches():
    import numpy as np

    x = np.array([0, 6, 12, 18, 24, 12])
    y = np.array([50, 56, 62, 68, 74, 3])
    best = op.chain(x, y)[0]
    assert sorted(best.tolist()) == [0, 1, 2, 3, 4]


def test_prefix_maxima():
    draw = random.Random(5)
    tree, held = op.Fenwick(30), {}
    for number in range(200):
        place, score = draw.randrange(1, 31), draw.random()
        tree.put(place, score, number)
        held[place] = max(held.get(place, (-1.0, -1)), (score, number))
        top = draw.randrange(0, 31)
        want = max((v for p, v in held.items() if p <= top), default=(float("-inf"), -1))
        assert tree.best(top) == want


def test_matches_in_step_are_chained_as_the_search_would():
    import numpy as np

    draw = random.Random(7)
    for _ in range(300):
        x = np.cumsum([draw.randrange(1, 45) for _ in range(draw.randrange(1, 30))])
        y = x + draw.randrange(0, 500)
        short = op.chain(x, y)
        found = op.search(x, y)
        cut = []
        for members in found:
            gap = np.diff(x[members]) > op.MOST_GAP + op.SEED
            cut += np.split(members, np.flatnonzero(gap) + 1)
        assert sorted(c.tolist() for c in short) == sorted(c.tolist() for c in cut)


def test_an_unrelated_match_changes_no_chain():
    import numpy as np

    near = op.chain(np.array([0, 30]), np.array([0, 30]))
    more = op.chain(np.array([0, 30, 500]), np.array([0, 30, 100]))
    assert [c.tolist() for c in near] == [[0, 1]]
    assert sorted(c.tolist() for c in more) == [[0, 1], [2]]


def test_recall_by_identity(documents):
    """Passages with words replaced at random, 150 pairs of each kind, each of words of its own."""
    draw = random.Random(8)
    texts, kind = {}, {}
    for size in (60, 150):
        for identity in (0.80, 0.85, 0.90, 0.95):
            for _ in range(150):
                n = len(texts)
                passage = words(draw, size)
                changed = list(passage)
                for i in draw.sample(range(size), round((1 - identity) * size)):
                    changed[i] = words(draw, 1)[0]
                texts[n] = " ".join(words(draw, 60) + passage + words(draw, 60))
                texts[n + 1] = " ".join(words(draw, 40) + changed + words(draw, 40))
                kind[n + 1] = (size, identity)
    hits = dict.fromkeys(kind.values(), 0)
    pairs = {(r.doc_id, r.ref_doc_id) for r in found(documents, texts)}
    for doc, ref in pairs:
        assert ref == doc - 1
        hits[kind[doc]] += 1
    recall = {k: n / 150 for k, n in hits.items()}
    for (_, identity), share in recall.items():
        if identity >= 0.85:
            assert share >= 0.9
    assert recall[60, 0.8] >= 0.6 and recall[150, 0.8] >= 0.9


def test_hot_seeds_are_matched_in_two_steps(documents, monkeypatch):
    """Every seed met twice counts as hot, and the results stay."""
    draw = random.Random(9)
    passage = words(draw, 70)
    texts = {i: " ".join(words(draw, 30) + passage + words(draw, 30)) for i in range(1, 60)}
    texts |= {i: " ".join(words(draw, 90)) for i in range(60, 70)}
    plain = {(r.doc_id, r.start, r.end) for r in found(documents, texts)}
    monkeypatch.setattr(op, "HOT", 1)
    monkeypatch.setattr(op, "SALTS", 5)
    salted = found(documents, texts)
    assert {(r.doc_id, r.start, r.end) for r in salted} == plain and len(plain) == 58
    refs = {r.ref_doc_id for r in salted}
    assert 1 < len(refs) <= 5 and all(r.ref_doc_id < r.doc_id for r in salted)


def test_a_full_bitmap_changes_nothing(documents, monkeypatch):
    draw = random.Random(10)
    passage = words(draw, 55)
    texts = {i: " ".join(words(draw, 80) + passage * (i % 2) + words(draw, 80)) for i in range(12)}
    want = {(r.doc_id, r.ref_doc_id, r.start, r.end) for r in found(documents, texts)}
    monkeypatch.setattr(op, "LEAST_BITS", 64)
    monkeypatch.setattr(op, "MOST_BITS", 64)
    assert {(r.doc_id, r.ref_doc_id, r.start, r.end) for r in found(documents, texts)} == want
    assert {d for d, *_ in want} == {3, 5, 7, 9, 11}
