"""Mixing to target weights with soft membership in domains.

A classifier learned from a labelled table gives every document its posterior over domains:
multinomial Bayes over hashed words judges each passage of ``PASSAGE`` words, and the passages'
posteriors, weighted by words, are averaged, so a text in two languages belongs to both.

Rates: with n_i words and posterior p_i, find rates r_i >= ``least_rate`` whose expected totals
sum_i r_i n_i p_i are the targets, by projected-gradient least squares:

    minimise  |totals - targets|^2 / 2  +  ridge * sum_i n_i (r_i - start)^2 / 2

the residual in the norm of G^-1, G = sum_i n_i p_i p_i'. The ridge makes the optimum unique, also
where no rates meet the targets, and keeps rates near their start, 1 or the least rate if that is
more. The projection is lazy: the gradient steps are added up in the few numbers z, and the rates
are the projection r_i = max(least_rate, start - p_i . z) of the start moved by all of them. A step
is scaled by the curvature of the rates that are free to move, so steps become exact once these
no longer change; one that does not lower the objective's dual enough is halved, so every step
makes progress and the iteration ends at the optimum, in some ten passes.

It stops when the gradient is below ``TOLERANCE`` of all wanted words: at the optimum, whether
or not the targets can be met. What is then left is returned as ``residual``, the largest gap as a
share of all wanted words; a gap above ``REACHED`` is warned of, and not reaching the optimum in
``MOST_PASSES`` passes is an error.

Each pass is one aggregation of as many numbers as domains squared, and tasks compute rates from z:
nothing per document is gathered or rewritten. There are at most ``MOST_DOMAINS`` domains; of more,
those with the fewest labelled documents become one, ``OTHERS``.

Special cases: a text without words, or none, has the prior as its posterior, and weighs
nothing; rows without id are mixed like others; repeated rows weigh as often as they occur;
targets of domains that no document belongs to are spread over the others in proportion; a
table without words, or without labelled rows, gives rate max(1, least_rate) to every row; other
columns are ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rawstrata.llm.common import Workspace, fold, table
from rawstrata.llm.words import hash_words, slices, split_words

PASSAGE = 64
BUCKETS = 1 << 14
MOST_DOCUMENTS = 4000  # labelled documents the classifier is learned from
SMOOTHING = 0.1
EXPONENT = 0.7  # default targets: shares of words to this power
MOST_DOMAINS = 256
OTHERS = "(others)"

RIDGE = 1e-5
TOLERANCE = 1e-9
REACHED = 1e-3
MOST_PASSES = 200
ROOM = 0.05  # by which a corpus of which nothing may be left out grows beyond the least

_MASK = np.uint64(BUCKETS - 1)


class DomainModel:
    """Log probabilities of hashed words by domain."""

    def __init__(self, domains: list[str], counts: np.ndarray, prior: np.ndarray):
        self.domains = domains
        self.prior = prior
        smooth = counts + SMOOTHING
        self.log = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.copy()

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of words of every text, and its posterior."""
        words = split_words(texts, lower=True)
        count = np.diff(words.first)
        out = np.tile(self.prior, (len(count), 1))
        full = np.flatnonzero(count)
        if not len(full):
            return count, out
        per_text = -(-count[full] // PASSAGE)
        first = np.concatenate([[0], np.cumsum(per_text)])
        text = np.repeat(full, per_text)
        begin = words.first[text] + (np.arange(first[-1]) - np.repeat(first[:-1], per_text)) * PASSAGE
        sizes = np.diff(np.append(begin, words.first[-1]))
        bucket = (hash_words(words) & _MASK).astype(np.int64)
        logs = np.add.reduceat(self.log[bucket], begin, axis=0) + np.log(self.prior)
        logs = np.exp(logs - logs.max(axis=1, keepdims=True))
        share = logs / logs.sum(axis=1, keepdims=True)
        out[full] = np.add.reduceat(share * sizes[:, None], first[:-1], axis=0) / count[full, None]
        return count, out


def fit(
    docs: DataFrame,
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_documents: int = MOST_DOCUMENTS,
) -> DomainModel | None:
    """Learn from the texts of (doc_id, domain): word counts are summed per domain and bucket."""
    most = labelled.groupBy("domain").agg(F.countDistinct("doc_id").alias("n")).dropna()
    names = [r.domain for r in most.orderBy(F.desc("n"), "domain").limit(MOST_DOMAINS).collect()]
    if most.count() > MOST_DOMAINS:
        named = F.when(F.col("domain").isin(names[:-1]), F.col("domain"))
        labelled = labelled.dropna(subset=["domain"]).withColumn("domain", F.coalesce(named, F.lit(OTHERS)))
    few = (
        labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "domain")
        .dropna()
        .distinct()
        .orderBy(F.xxhash64("doc_id", "domain"), "doc_id")
        .limit(most_documents)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Bound: ``most_documents`` rows of an id and a name.
    chosen = texts.filter("text IS NOT NULL").join(F.broadcast(few), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch["text"]):
                words = split_words(texts, lower=True)
                bucket = (hash_words(words) & _MASK).astype(np.int64)
                domain = np.array(batch["domain"].slice(start, len(texts)).to_pylist(), dtype=object)
                for name in sorted(set(domain.tolist())):
                    mine = np.repeat(domain == name, np.diff(words.first))
                    n = np.bincount(bucket[mine], minlength=BUCKETS)
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                        names=["domain", "bucket", "n"],
                    )

    rows = (
        chosen.select("text", "domain")
        .mapInArrow(count, "domain string, bucket long, n long")
        .groupBy("domain", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most domains x BUCKETS rows
    )
    domains = sorted({r.domain for r in rows})
    if not domains:
        return None
    counts = np.zeros((len(domains), BUCKETS))
    for r in rows:
        counts[domains.index(r.domain), r.bucket] = r.n
    weight = counts.sum(axis=1) + 1
    return DomainModel(domains, counts, weight / weight.sum())


def memberships(docs: DataFrame, model: DomainModel, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, posterior), the posterior in the order of the model's domains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch["text"]):
                count, share = model.posteriors(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, len(texts)),
                        pa.array(count.astype(np.int64)),
                        pa.FixedSizeListArray.from_arrays(share.ravel(), share.shape[1]).cast(
                            pa.list_(pa.float64())
                        ),
                    ],
                    names=["doc_id", "n_words", "posterior"],
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, n_words long, posterior array<double>")


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    share = batch["posterior"]
    values = np.asarray(share.flatten(), dtype=float).reshape(len(share), -1)
    return np.asarray(batch["n_words"], dtype=float), values


class Solution(NamedTuple):
    """Rates as a function of posteriors, and how near they come to the targets."""

    model: DomainModel
    members: DataFrame
    z: np.ndarray
    start: float
    least_rate: float
    residual: float
    passes: int

    def rates(self, share: np.ndarray) -> np.ndarray:
        return np.maximum(self.least_rate, self.start - share @ self.z)


class Pass(NamedTuple):
    """What one pass over the memberships adds up."""

    totals: np.ndarray  # expected words of every domain
    free: np.ndarray  # sum n p p' of the rates that may move
    dual: float  # sum n phi(start - p . z), phi' the projection


def _pass(members: DataFrame, z: np.ndarray, start: float, least_rate: float) -> Pass:
    size = len(z)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + size * size + 1)
        for batch in batches:
            if batch.num_rows:
                n, share = _matrix(batch)
                moved = start - share @ z
                rate = np.maximum(least_rate, moved)
                sums[:size] += (rate * n) @ share
                free = n * (moved >= least_rate)
                sums[size:-1] += ((share * free[:, None]).T @ share).ravel()
                sums[-1] += (n * (rate * moved - rate * rate / 2)).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums))), pa.array(sums)], names=["place", "value"]
        )

    rows = (
        members.select("n_words", "posterior")
        .mapInArrow(run, "place long, value double")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
        .collect()  # domains + domains squared + 1 rows
    )
    out = np.zeros(size + size * size + 1)
    for r in rows:
        out[r.place] = r.value
    return Pass(out[:size], out[size:-1].reshape(size, size), float(out[-1]))


def targets_of(
    totals: np.ndarray, domains: list[str], weights: dict[str, float] | None, no_less: bool
) -> np.ndarray:
    """Words wanted of every domain. Without weights, shares to the power ``EXPONENT``. The sum
    is that of the corpus, or with ``no_less`` a little more than the least at which no domain
    shrinks, since documents of other domains share in the words of each."""
    share = totals / totals.sum()
    wanted = share**EXPONENT if weights is None else np.array([weights.get(d, 0.0) for d in domains])
    wanted = np.where(share > 0, wanted, 0.0)
    if wanted.sum() <= 0:
        wanted = share.copy()
    wanted /= wanted.sum()
    positive = wanted > 0
    if not no_less:
        return wanted * totals.sum()
    return wanted * float((totals[positive] / wanted[positive]).max()) * (1 + ROOM)


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    *,
    weights: dict[str, float] | None = None,
    least_rate: float = 0.0,
    no_less: bool = False,
    ridge: float = RIDGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, domain (the likeliest), posterior, rate, residual (the same in all rows).

    ``labelled`` has (doc_id, domain) of some of the documents. ``weights`` are the domains' target shares.
    """
    work = Workspace(docs.sparkSession, "mixing")
    solved = solve(
        docs, labelled, work, weights=weights, least_rate=least_rate, no_less=no_less,
        ridge=ridge, id_col=id_col, text_col=text_col,
    )
    if solved is None:
        return docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.lit(0).cast("long").alias("n_words"),
            F.lit(None).cast("string").alias("domain"),
            F.lit(None).cast("array<double>").alias("posterior"),
            F.lit(max(1.0, least_rate)).alias("rate"),
            F.lit(0.0).alias("residual"),
        )
    # Tasks get the solution without the frame.
    members, solution = solved.members, solved._replace(members=None)
    model = solution.model

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.domains, dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, share = _matrix(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["n_words"],
                    pa.array(names[share.argmax(axis=1)], pa.string()),
                    batch["posterior"],
                    pa.array(solution.rates(share)),
                    pa.array(np.full(len(share), solution.residual)),
                ],
                names=["doc_id", "n_words", "domain", "posterior", "rate", "residual"],
            )

    return members.mapInArrow(
        rates,
        "doc_id long, n_words long, domain string, posterior array<double>, rate double, residual double",
    )


def solve(
    docs: DataFrame,
    labelled: DataFrame,
    work: Workspace,
    *,
    weights: dict[str, float] | None = None,
    least_rate: float = 0.0,
    no_less: bool = False,
    ridge: float = RIDGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Solution | None:
    """The rates that come nearest to the targets. None without labelled rows."""
    model = fit(docs, labelled, id_col=id_col, text_col=text_col)
    if model is None:
        return None
    members = work.write(memberships(docs, model, id_col, text_col), "members")
    z = np.zeros(len(model.domains))
    start = max(1.0, least_rate)
    now = _pass(members, z, start, least_rate)
    solution = Solution(model, members, z, start, least_rate, 0.0, 1)
    if now.totals.sum() <= 0:
        return solution
    targets = targets_of(now.totals / start, model.domains, weights, no_less)
    # Where the start is the least rate, all rates are free at z = 0: this is G.
    whole, passes = now.free, 1

    def dual(at: Pass, z: np.ndarray) -> float:
        return at.dual + z @ targets + ridge / 2 * z @ whole @ z

    while True:
        gradient = now.totals - targets - ridge * whole @ z
        if np.abs(gradient).max() <= TOLERANCE * targets.sum():
            break
        # Domains no document belongs to have no curvature: the pseudo-inverse leaves them alone.
        step = np.linalg.pinv(now.free + ridge * whole, hermitian=True) @ gradient
        size = 1.0
        while True:
            if passes >= MOST_PASSES:
                raise RuntimeError(f"No optimum of the mixing rates in {passes} passes")
            then = _pass(members, z + size * step, start, least_rate)
            passes += 1
            enough = dual(now, z) - 1e-4 * size * (gradient @ step)
            if dual(then, z + size * step) <= enough + 1e-12 * abs(enough):
                break
            size /= 2
        z, now = z + size * step, then
    residual = float(np.abs(now.totals - targets).max() / targets.sum())
    if residual > REACHED:
        warnings.warn(
            f"Mixing rates miss the targets by up to {residual:.2%} of all words", UserWarning, stacklevel=2
        )
    return solution._replace(z=z, residual=residual, passes=passes)


def with_rates(
    docs: DataFrame,
    labelled: DataFrame,
    rate_col: str,
    *,
    weights: dict[str, float] | None = None,
    least_rate: float = 0.0,
    no_less: bool = False,
    ridge: float = RIDGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents, all columns, with their rates: one pass that recomputes each text's
    posterior, so nothing is joined by id."""
    work = Workspace(docs.sparkSession, "mixing")
    solved = solve(
        docs, labelled, work, weights=weights, least_rate=least_rate, no_less=no_less,
        ridge=ridge, id_col=id_col, text_col=text_col,
    )
    if solved is None:
        return docs.withColumn(rate_col, F.lit(max(1.0, least_rate)))
    work.drop(solved.members)
    solution = solved._replace(members=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch[text_col]):
                _, share = solution.model.posteriors(texts)
                rows = batch.slice(start, len(texts))
                yield rows.append_column(rate_col, pa.array(solution.rates(share)))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(rate_col, T.DoubleType())]))


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain): the labelled documents of good quality that are not held out, with their
    language as domain."""
    good = labels.filter("quality = 1").select("doc_id").distinct()
    narrow = docs.select("doc_id", F.col("lang").alias("domain")).filter(fold("doc_id") != 0)
    return narrow.join(good, "doc_id", "left_semi")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, labelled_languages(docs, table(spark, sf_dir, "labels")))
