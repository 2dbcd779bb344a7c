"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded: counts of its
whole text become a dense vector, and a learned layer turns that into its representation h.
Gated attention gives each passage a weight, softmax over w . (tanh(V h) * sigmoid(U h)), and
the weighted sum of the representations is what the document is scored by. Encoder,
attention and classifier are learned together, from document labels alone.

Training takes at most ``MOST_DOCUMENTS`` labelled documents, whole, in the order of a hash of their
ids, as far as they have ``MOST_PASSAGES`` passages together: long ones have the same chance as
short ones, and what the driver gathers is bounded. (One document beyond that bound alone, 13
million words, is left out.) The model is a few hundred numbers.
Scoring is one pass over all whole texts, vectorised over the passages of a slice.

Special cases: a text without words, or none, is a bag with one passage of zeros; a row without
id is scored and not held out; repeated rows are scored row by row; without labels of both
kinds every score is the share of label 1 (0.5 without any label); columns other than the
named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, fold, labelled_sample, table
from rawstrata.llm.words import hash_words, slices, split_words

PASSAGE = 64
MOST_DOCUMENTS = 4000
MOST_PASSAGES = 200_000
THRESHOLD = 0.3

HIDDEN = 16
GATES = 8
STEPS = 150
RATE = 0.03
DECAY = 1e-4

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>=+~^{}[]\\_@/",
    "bar": b"|",
    "shout": b"!",
    "stop": b".,;:?",
    "line": b"\n",
    "foreign": bytes(range(128, 256)),
}
FEATURES = 14


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of the first passage of every text."""
    words = split_words(texts)
    per_text = np.maximum(1, -(-np.diff(words.first) // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per_text)])
    text = np.repeat(np.arange(len(per_text)), per_text)
    begin = words.first[text] + (np.arange(first[-1]) - first[text]) * PASSAGE
    end = np.minimum(begin + PASSAGE, words.first[text + 1])
    count = end - begin
    out = np.zeros((len(text), FEATURES))
    full = count > 0
    if not full.any():
        return out, first
    a, b = begin[full], end[full]
    low, high = words.starts[a], words.ends[b - 1]
    n = count[full].astype(float)

    def summed(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum(values, out=sums[1:])
        return (sums[stop] - sums[start]).astype(float)

    of = {}
    for name, members in CLASSES.items():
        held = np.zeros(256, dtype=bool)
        held[list(members)] = True
        of[name] = summed(held[words.data], low, high)
    sizes = words.ends - words.starts
    size = summed(sizes, a, b)
    hashes = hash_words(words)
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[a] = False
    place = np.repeat(np.arange(len(a)), b - a)  # passages cover all words in order
    bits = np.uint64(max(1, int(len(a)).bit_length()))
    keys = (place.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits)
    keys.sort()
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[fresh] >> (np.uint64(64) - bits)).astype(np.int64), minlength=len(a))
    letters = of["upper"] + of["lower"] + of["foreign"]
    out[full] = np.stack(
        [
            np.log1p(n),
            size / n,
            of["upper"] / (letters + 1),
            of["digit"] / size,
            of["symbol"] / n,
            of["bar"] / n,
            of["shout"] / n,
            of["stop"] / n,
            of["line"] / n,
            of["foreign"] / size,
            distinct / n,
            summed(again, a, b) / n,
            summed(sizes <= 3, a, b) / n,
            np.ones(len(n)),  # has words
        ],
        axis=1,
    )
    return out, first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class AttentionModel:
    """Encoder, gated attention and classifier. Documents are runs of passage rows."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, constant: float | None = None):
        self.mean, self.scale, self.constant = mean, scale, constant
        draw = np.random.default_rng(7)

        def layer(*shape: int) -> np.ndarray:
            return draw.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.weights = {
            "encode": layer(FEATURES, HIDDEN),
            "bias": np.zeros(HIDDEN),
            "V": layer(HIDDEN, GATES),
            "U": layer(HIDDEN, GATES),
            "w": layer(GATES),
            "classify": layer(HIDDEN),
            "offset": np.zeros(1),
        }

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["encode"] + p["bias"])
        v, u = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        logits = (v * u) @ p["w"]
        starts, sizes = first[:-1], np.diff(first)
        logits = np.exp(logits - np.repeat(np.maximum.reduceat(logits, starts), sizes))
        weight = logits / np.repeat(np.add.reduceat(logits, starts), sizes)
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        score = sigmoid(z @ p["classify"] + p["offset"][0])
        return {"x": x, "h": h, "v": v, "u": u, "weight": weight, "z": z, "score": score}

    def gradient(
        self, s: dict[str, np.ndarray], first: np.ndarray, label: np.ndarray
    ) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, sizes = self.weights, np.diff(first)
        error = (s["score"] - label) / len(label)
        spread = np.repeat(error, sizes)
        to_h = s["weight"][:, None] * spread[:, None] * p["classify"]
        gain = spread * (s["h"] @ p["classify"])
        mean_gain = np.repeat(np.add.reduceat(s["weight"] * gain, first[:-1]), sizes)
        to_logit = s["weight"] * (gain - mean_gain)
        to_gate = to_logit[:, None] * p["w"]
        to_v = to_gate * s["u"] * (1 - s["v"] ** 2)
        to_u = to_gate * s["v"] * s["u"] * (1 - s["u"])
        to_h += to_v @ p["V"].T + to_u @ p["U"].T
        to_code = to_h * (1 - s["h"] ** 2)
        return {
            "encode": s["x"].T @ to_code,
            "bias": to_code.sum(0),
            "V": s["h"].T @ to_v,
            "U": s["h"].T @ to_u,
            "w": (s["v"] * s["u"]).T @ to_logit,
            "classify": s["z"].T @ error,
            "offset": np.array([error.sum()]),
        }

    def learn(self, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> None:
        """Adam on the whole sample."""
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, STEPS + 1):
            found = self.gradient(self.forward(x, first), first, label)
            for k, w in self.weights.items():
                g = found[k] + DECAY * w
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w -= RATE * (mean[k] / (1 - 0.9**step)) / (
                    np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                )

    def score(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of every document and the weights of its passages."""
        if self.constant is not None:
            sizes = np.diff(first)
            return np.full(len(sizes), self.constant), np.repeat(1 / sizes, sizes)
        found = self.forward(x, first)
        return found["score"], found["weight"]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_documents: int = MOST_DOCUMENTS,
    most_passages: int = MOST_PASSAGES,
) -> AttentionModel:
    sample = labelled_sample(
        docs, labels, label=label, id_col=id_col, text_col=text_col, most=most_documents
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch["text"]):
                x, first = passages(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.diff(first)),
                        pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                        batch["label"].slice(start, len(texts)),
                        batch["doc_id"].slice(start, len(texts)),
                    ],
                    names=["n", "x", "label", "doc_id"],
                )

    work = Workspace(docs.sparkSession, "quality_classifier")
    encoded = work.write(
        sample.select(F.col("doc_id").cast("long"), "text", "label").mapInArrow(
            encode, "n long, x binary, label double, doc_id long"
        ),
        "encoded",
    )
    hashed = encoded.filter(F.col("n") <= most_passages).withColumn("hash", F.xxhash64("doc_id"))
    sizes = hashed.groupBy("hash").agg(F.sum("n").alias("n")).orderBy("hash")
    reached, last = 0, None
    for r in sizes.collect():  # two numbers for each of MOST_DOCUMENTS
        reached += r.n
        if reached > most_passages:
            break
        last = r.hash
    taken = hashed.filter(F.col("hash") <= F.lit(last).cast("long"))
    rows = taken.select("x", "label", "doc_id").collect()
    work.drop(encoded)
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    target = np.array([r.label for r in rows])
    if len(set(target.tolist())) < 2:
        share = float(target.mean()) if len(target) else 0.5
        return AttentionModel(np.zeros(FEATURES), np.ones(FEATURES), share)
    bags = [np.frombuffer(r.x).reshape(-1, FEATURES) for r in rows]
    x = np.concatenate(bags)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = AttentionModel(x.mean(0), x.std(0) + 1e-6)
    model.learn(x, first, target)
    return model


def score(
    docs: DataFrame, model: AttentionModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, score, n_passages, top_passage (the one of greatest weight, from 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch["text"]):
                x, first = passages(texts)
                scores, weight = model.score(x, first)
                top = [int(np.argmax(weight[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, len(texts)),
                        pa.array(scores),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.array(top, pa.int64()),
                    ],
                    names=["doc_id", "score", "n_passages", "top_passage"],
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, score double, n_passages long, top_passage long")


def keep(
    docs: DataFrame, model: AttentionModel, *, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose text scores at least the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch[text_col]):
                scores, _ = model.score(*passages(texts))
                yield batch.slice(start, len(texts)).filter(pa.array(scores >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        (fold("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_passages",
        "top_passage",
    )
