"""Toxicity: gradient-boosted trees over dense features of whole texts, isotonic calibration.

A lexicon is learned first: words, and word beginnings of a few lengths, whose share among
toxic documents is surely higher than among the others. Look-alike characters (0 for o, 1
for i, $ for s ...) are mapped back before a word is looked up. Features: densities of
lexicon words by weight, their nearness to second-person words, capitals, punctuation, and
words with other characters between letters. Spark's gradient-boosted trees are fitted on
them, and an isotonic regression turns the trees' scores into probabilities.

The labels that may be learned are split by document: folds 1 and 2 give the lexicon, 3 the
trees, 4 the calibration, so no step sees scores fitted to its own rows. At most
``MOST_DOCUMENTS`` labelled documents are used, and at most ``MOST_ENTRIES`` lexicon entries,
which go to the tasks. Scoring is one pass over all texts.

Special cases: a text without words, or none, has all features zero and is scored like any
other; a row without id is scored and not held out; repeated rows are scored row by row;
without labels of both kinds among the trees' rows, every score is the share of label 1 (0
without any label); columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, fold, labelled_sample, table
from rawstrata.llm.words import BLANK, LOWER, Words, hash_words, mix, slices, split_words

MOST_DOCUMENTS = 20_000
MOST_ENTRIES = 4000
LEAST_TOXIC = 3  # toxic documents a lexicon entry needs
LEAST_Z = 3.0
THRESHOLD = 0.5

TREES = 30
TREE_DEPTH = 4

BEGINNINGS = (4, 5, 6, 7, 8, 9)  # bytes
WHOLE = 1 << 20
NEAR = 5  # words

# Second-person words of the languages at hand.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer "
    "tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros"
).split()
# Characters written for letters that look alike.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[list(b"!?.,;:'\"()-")] = True
_SHOUT = np.zeros(256, dtype=bool)
_SHOUT[list(b"!?")] = True
_PLAIN = LOWER.copy()
for _odd, _letter in LOOK_ALIKE.items():
    _PLAIN[ord(_odd)] = ord(_letter)

FEATURES = (
    "log_words word_bytes weight_density weight_most strong_count strong_density fair_count "
    "fair_density weak_count weak_density near_person person_rate capitals capital_words "
    "shouts punctuation obfuscated"
).split()


def keys_of(words: Words) -> list[np.ndarray]:
    """Lexicon keys of every word: of itself, and of each of its beginnings."""
    limits = (*BEGINNINGS, WHOLE)
    return [
        mix(h ^ np.uint64(limit))
        for h, limit in zip(hash_words(words, limits), limits, strict=True)
    ]


def plain_words(texts: pa.Array) -> Words:
    """Words in lower case without marks around them and with look-alikes mapped back."""
    words = split_words(texts)
    letters = np.flatnonzero(_LETTER[words.data])
    size = len(words.data)
    # first and last letter of each word; a word without letters keeps its ends
    after = np.append(letters, size)[np.searchsorted(letters, words.starts, "left")]
    place = np.searchsorted(letters, words.ends, "left") - 1
    before = np.where(place >= 0, letters[np.maximum(place, 0)] if len(letters) else 0, -1)
    has = (after < words.ends) & (before >= words.starts)
    return words._replace(
        data=_PLAIN[words.data],
        starts=np.where(has, after, words.starts),
        ends=np.where(has, before + 1, words.ends),
    )


def _person_keys() -> np.ndarray:
    return np.sort(hash_words(split_words(pa.array([" ".join(SECOND_PERSON)]))))


class Lexicon:
    """Weights of keys; a table of bits answers most misses."""

    BITS = 1 << 20

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.seen = np.zeros(self.BITS, dtype=bool)
        self.seen[(keys & np.uint64(self.BITS - 1)).astype(np.int64)] = True

    def weigh(self, keys: np.ndarray, best: np.ndarray) -> None:
        """Raise ``best`` to the weights of the keys that are in the lexicon."""
        if not len(self.keys):
            return
        hit = np.flatnonzero(self.seen[(keys & np.uint64(self.BITS - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[hit]), len(self.keys) - 1)
        found = self.keys[at] == keys[hit]
        best[hit[found]] = np.maximum(best[hit[found]], self.weights[at[found]])


def features(texts: pa.Array, lexicon: Lexicon, person: np.ndarray) -> np.ndarray:
    words, plain = split_words(texts), plain_words(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    count = np.diff(words.first)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    n = count[full].astype(float)
    a, b = words.first[full], words.first[full + 1]

    def summed(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1)
        np.cumsum(values, out=sums[1:])
        return sums[stop] - sums[start]

    weight = np.zeros(len(words.starts))
    for keys in keys_of(plain):
        lexicon.weigh(keys, weight)
    whole = hash_words(plain)
    at = np.minimum(np.searchsorted(person, whole), len(person) - 1)
    is_person = person[at] == whole
    sums = np.concatenate([[0], np.cumsum(is_person)])
    place = np.arange(len(weight))
    text = np.repeat(full, count[full])
    low = np.maximum(place - NEAR, words.first[text])
    high = np.minimum(place + NEAR + 1, words.first[text + 1])
    near = (sums[high] - sums[low]) > 0

    def byte_sums(held: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return summed(held[words.data], start, stop)

    upper = byte_sums(_UPPER, words.starts, words.ends)
    letters = byte_sums(_LETTER, words.starts, words.ends)
    inner = plain.ends - plain.starts
    inner_letters = byte_sums(_LETTER, plain.starts, plain.ends)
    odd = (inner_letters >= 2) & (inner_letters < inner)
    strong, fair, weak = weight >= 4, weight >= 2, weight > 0
    total = [summed(x, a, b) for x in (strong, fair, weak)]
    out[full] = np.stack(
        [
            np.log1p(n),
            summed(words.ends - words.starts, a, b) / n,
            summed(weight, a, b) / n,
            np.maximum.reduceat(weight, a),
            np.minimum(total[0], 50), total[0] / n,
            np.minimum(total[1], 50), total[1] / n,
            np.minimum(total[2], 50), total[2] / n,
            summed(fair & near, a, b) / np.maximum(total[1], 1),
            summed(is_person, a, b) / n,
            summed(upper, a, b) / (summed(letters, a, b) + 1),
            summed((upper >= 2) & (upper == letters), a, b) / n,
            byte_sums(_SHOUT, words.starts[a], words.ends[b - 1]) / n,
            byte_sums(_PUNCT, words.starts[a], words.ends[b - 1]) / n,
            summed(odd, a, b) / n,
        ],
        axis=1,
    )
    return out


def learn_lexicon(sample: DataFrame, toxic: int, others: int) -> Lexicon:
    """Entries whose share among toxic documents is surely higher, weighted by log odds.

    Documents are counted per key, in numpy within a batch and by a grouped sum beyond.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch["label"])
            for start, texts in slices(batch["text"]):
                words = plain_words(texts)
                every = keys_of(words)
                seen = []
                for i in range(len(texts)):
                    run = slice(words.first[i], words.first[i + 1])
                    seen.append(np.unique(np.concatenate([keys[run] for keys in every])))
                sizes = [len(x) for x in seen]
                keys, place = np.unique(np.concatenate(seen), return_inverse=True)
                marks = np.repeat(label[start : start + len(texts)], sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.bincount(place, marks, len(keys))),
                        pa.array(np.bincount(place, 1 - marks, len(keys))),
                    ],
                    names=["key", "toxic", "other"],
                )

    here, there = F.col("toxic") + 0.5, F.col("other") + 0.5
    odds = F.log(here / (toxic + 1.0)) - F.log(there / (others + 1.0))
    entries = (
        sample.select("text", "label")
        .mapInArrow(count, "key long, toxic double, other double")
        .groupBy("key")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(F.col("toxic") >= LEAST_TOXIC)
        .select("key", odds.alias("weight"), (odds / F.sqrt(1 / here + 1 / there)).alias("z"))
        .filter(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "key")
        .limit(MOST_ENTRIES)
        .collect()  # at most MOST_ENTRIES rows
    )
    return Lexicon(
        np.array([e.key for e in entries], dtype=np.int64).view(np.uint64),
        np.array([e.weight for e in entries], dtype=float),
    )


def featured(docs: DataFrame, lexicon: Lexicon, *carried: str) -> DataFrame:
    """The carried columns and ``features``, an array of doubles, of every row's text."""
    person = _person_keys()
    schema = ", ".join(f"{c} {dict(docs.dtypes)[c]}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch["text"]):
                x = features(texts, lexicon, person)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch[c].slice(start, len(texts)) for c in carried],
                        pa.FixedSizeListArray.from_arrays(x.ravel(), len(FEATURES)).cast(
                            pa.list_(pa.float64())
                        ),
                    ],
                    names=[*carried, "features"],
                )

    return docs.select(*carried, "text").mapInArrow(run, f"{schema}, features array<double>")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_documents: int = MOST_DOCUMENTS,
) -> Callable[[DataFrame], DataFrame]:
    """Learn lexicon, trees and calibration; the result adds ``score`` to rows with ``text``.

    Carried along are doc_id and what else is named ``doc_id`` only; see ``score``.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    sample = work.write(
        labelled_sample(
            docs, labels, label=label, id_col=id_col, text_col=text_col, most=most_documents
        ),
        "sample",
    )
    sizes = {
        (r.fold, r.label): r.n
        for r in sample.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()
    }
    first = sample.filter(F.col("fold") <= 2)
    lexicon = learn_lexicon(
        first,
        sum(n for (f, y), n in sizes.items() if f <= 2 and y == 1),
        sum(n for (f, y), n in sizes.items() if f <= 2 and y == 0),
    )
    rows = work.write(featured(sample, lexicon, "doc_id", "fold", "label"), "features")
    work.drop(sample)
    if not (sizes.get((3, 0.0)) and sizes.get((3, 1.0))):
        every = sum(sizes.values())
        share = sum(n for (_, y), n in sizes.items() if y == 1) / every if every else 0.0
        return lambda df: df.select("doc_id", F.lit(share).alias("score"))

    def vectors(df: DataFrame) -> DataFrame:
        return df.withColumn("features", array_to_vector("features"))

    grown = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=TREE_DEPTH,
        minInstancesPerNode=3, stepSize=0.2, seed=11,
    ).fit(vectors(rows.filter(F.col("fold") == 3)))

    def raw(df: DataFrame) -> DataFrame:
        scored = grown.transform(vectors(df))
        return scored.withColumn("raw", vector_to_array("probability")[1])

    # Enough rows of both kinds calibrate; a shortage leaves the trees' own probability.
    if not (sizes.get((4, 0.0)) and sizes.get((4, 1.0))):
        return lambda df: raw(featured(df, lexicon, "doc_id")).select(
            "doc_id", F.col("raw").alias("score")
        )
    calibrated = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
        raw(rows.filter(F.col("fold") == 4))
    )
    return lambda df: calibrated.transform(raw(featured(df, lexicon, "doc_id"))).select(
        "doc_id", F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("score")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text")).select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
