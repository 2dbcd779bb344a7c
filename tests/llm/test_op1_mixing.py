import numpy as np
import pytest

from rawstrata.llm import op1_mixing as op


@pytest.fixture
def corpus(spark):
    draw = np.random.default_rng(1)
    vocabulary = {d: [f"{d}{i}" for i in range(40)] for d in ("aa", "bb", "cc")}
    rows = []
    for i in range(120):
        d = ["aa", "aa", "aa", "aa", "bb", "cc"][i % 6]
        words = draw.choice(vocabulary[d], 30 + i)
        if i % 10 == 0:
            words = np.concatenate([words, draw.choice(vocabulary["cc"], 64)])
        rows.append((i, " ".join(words), d))
    return spark.createDataFrame(rows, "doc_id long, text string, domain string")


def totals(rows):
    return sum(r.rate * r.n_words * np.array(r.posterior) for r in rows)


@pytest.mark.parametrize("least", [0.0, 0.2])
def test_rates_meet_the_targets(corpus, least):
    weights = {"aa": 0.3, "bb": 0.3, "cc": 0.4}
    rows = op.mix(corpus, corpus, weights=weights, least_rate=least).collect()
    got = totals(rows)
    assert np.allclose(got / got.sum(), [0.3, 0.3, 0.4], atol=1e-3)
    assert min(r.rate for r in rows) >= least
    assert np.isclose(got.sum(), sum(r.n_words for r in rows), rtol=1e-3)


def test_no_document_is_thinned_when_none_may_be(corpus):
    rows = op.mix(corpus, corpus, least_rate=1.0, no_less=True).collect()
    assert min(r.rate for r in rows) >= 1.0
    share = totals(rows) / totals(rows).sum()
    plain = sum(r.n_words * np.array(r.posterior) for r in rows)
    assert np.allclose(share, plain**0.7 / (plain**0.7).sum(), atol=0.02)


def dense(n, p, target, least, ridge, steps=60_000):
    """Plain accelerated projected gradient on the same least squares problem, all in memory."""
    a = (np.sqrt(n)[:, None] * p).T
    whiten = np.linalg.inv(np.linalg.cholesky(a @ a.T))
    a, target = whiten @ a, whiten @ target
    low, start = np.sqrt(n) * least, np.sqrt(n) * max(1.0, least)
    s, y, t = start.copy(), start.copy(), 1.0
    for _ in range(steps):
        new = np.maximum(low, y - (a.T @ (a @ y - target) + ridge * (y - start)) / (1 + ridge))
        if (y - new) @ (new - s) > 0:
            t = 1.0
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        s, y, t = new, new + (t - 1) / after * (new - s), after
    return s / np.sqrt(n)


@pytest.mark.parametrize(
    "weights, least, ridge, reached",
    [
        ({"aa": 0.3, "bb": 0.3, "cc": 0.4}, 0.0, 1e-3, True),
        ({"aa": 0.05, "bb": 0.05, "cc": 0.9}, 0.0, 1e-3, True),  # rates end at zero
        ({"aa": 0.2, "bb": 0.4, "cc": 0.4}, 0.9, 1e-3, False),  # aa cannot shrink so far
        ({"bb": 0.5, "cc": 0.5}, 0.5, 1e-2, False),
    ],
)
def test_rates_are_those_of_a_dense_descent(corpus, weights, least, ridge, reached):
    """Where the projection binds, with targets that can be met and that cannot."""
    result = op.mix(corpus, corpus, weights=weights, least_rate=least, ridge=ridge)
    rows = sorted(result.collect(), key=lambda r: r.doc_id)
    n = np.array([r.n_words for r in rows], float)
    p = np.array([r.posterior for r in rows])
    target = np.array([weights.get(d, 0.0) for d in ("aa", "bb", "cc")]) * n.sum()
    rates = np.array([r.rate for r in rows])
    assert np.allclose(dense(n, p, target, least, ridge), rates, atol=1e-6)
    gap = np.abs(totals(rows) - target).max() / target.sum()
    assert np.isclose(gap, rows[0].residual, atol=1e-9)
    assert (gap < 0.01) == reached
    if weights["cc"] == 0.9 or not reached:
        assert (rates <= least + 1e-12).any()


def test_a_small_ridge_meets_targets_closely_and_in_few_passes(corpus, spark):
    work = op.Workspace(spark, "test_mixing")
    for weights, least, no_less in (
        ({"aa": 0.05, "bb": 0.05, "cc": 0.9}, 0.0, False),
        (None, 1.0, True),
    ):
        solved = op.solve(
            corpus, corpus, work, weights=weights, least_rate=least, no_less=no_less, ridge=1e-8
        )
        assert solved.residual < 1e-6 and solved.passes < 60


def test_missed_targets_are_warned_of(corpus):
    with pytest.warns(UserWarning, match="miss the targets"):
        op.mix(corpus, corpus, weights={"bb": 0.5, "cc": 0.5}, least_rate=0.5)


def test_rare_domains_are_pooled(corpus, monkeypatch):
    monkeypatch.setattr(op, "MOST_DOMAINS", 2)
    found = {r.domain for r in op.mix(corpus, corpus).collect()}
    assert found == {"aa", op.OTHERS}


def test_a_mixed_text_belongs_to_both(corpus):
    rows = {r.doc_id: r for r in op.mix(corpus, corpus).collect()}
    assert 0.1 < rows[0].posterior[2] < 0.9 and rows[1].posterior[0] > 0.99


def test_odd_rows(odd_documents, spark):
    labelled = odd_documents.selectExpr("doc_id", "text", "lang AS domain")
    rows = op.mix(odd_documents, labelled).collect()
    assert len(rows) == 10 and all(np.isfinite(r.rate) and r.rate >= 0 for r in rows)
    assert all(np.isclose(sum(r.posterior), 1) for r in rows)
    assert op.mix(odd_documents.limit(0), labelled).count() == 0
    assert {r.rate for r in op.mix(odd_documents, labelled.limit(0)).collect()} == {1.0}
