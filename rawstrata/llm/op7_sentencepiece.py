"""SentencePiece encoding by an Aho-Corasick automaton and a single-pass Viterbi, and decoding.

The automaton holds every ordinary piece. One pass over a text reports, at each position,
all pieces that end there (longest first, following output links); each relaxes the best
score of its end from that of its start, so the best segmentation by summed piece scores
stands at the end of the pass. A tie keeps the longer last piece. A character no piece
covers costs ``UNKNOWN_PENALTY`` below the worst score and becomes its UTF-8 bytes' pieces.

Pieces of the installed vocabularies never continue across "word, blank" and never hold a
line break, so cutting a text there changes no segmentation; chunks repeat a lot and are
kept in a cache per task. For a vocabulary without that property whole texts are segmented.

The segmentation is the one with the best score. For a model trained by merges the scores
are merge ranks, so ids can differ from that library's merge order; decoding restores the
text either way.

Special cases: a null text gives null ids and an empty one no ids; the marker character U+2581
in a text is encoded by its bytes, so that it is not read back as a blank; rows are encoded
one by one, so ids may be null or repeated; columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from rawstrata.llm.common import table
from rawstrata.llm.words import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for a blank in pieces
UNKNOWN_PENALTY = 10.0
CACHE_ENTRIES = 400_000
NEWLINE = "\n"
WORST = float("-inf")


class Vocabulary:
    """Pieces of a model: texts, scores, bytes."""

    def __init__(self, model: bytes):
        held = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.unknown = held.unk_id()
        self.pieces: list[tuple[str, float, int]] = []
        self.byte_ids: dict[int, int] = {}
        self.texts: list[bytes] = []  # of every id, decoded
        for i in range(held.get_piece_size()):
            text = held.id_to_piece(i)
            if held.is_byte(i):
                self.byte_ids[int(text[3:-1], 16)] = i
                self.texts.append(bytes([int(text[3:-1], 16)]))
            elif held.is_control(i) or held.is_unknown(i) or held.is_unused(i):
                self.texts.append(b"")
            else:
                self.pieces.append((text, held.get_score(i), i))
                self.texts.append(text.replace(MARK, " ").encode())
        # A leading blank is added by such models; seen from outside, by its effect.
        self.prefix = bool(self.pieces) and held.decode(held.encode("a")) == "a" and (
            held.id_to_piece(held.encode("a")[0]).startswith(MARK)
        )
        self.cuttable = not any(
            NEWLINE in text or MARK in text.lstrip(MARK) for text, _, _ in self.pieces
        )


class Encoder(dict):
    """Ids of chunks, as the bytes of an int32 array; a missing chunk is segmented."""

    def __init__(self, model: bytes):
        super().__init__()
        self.vocabulary = v = Vocabulary(model)
        self.automaton = ahocorasick.Automaton()
        self.single = set()
        for text, score, i in v.pieces:
            self.automaton.add_word(text, (len(text), score, i))
            if len(text) == 1:
                self.single.add(text)
        self.matches = lambda chunk: ()
        if v.pieces:
            self.automaton.make_automaton()
            self.matches = self.automaton.iter
        self.unknown_score = min((s for _, s, _ in v.pieces), default=0.0) - UNKNOWN_PENALTY
        cut = r"\n| *[^ \n▁]+| +|▁" if v.cuttable else r"[^▁]+|▁"
        self.chunks = re.compile(cut).findall
        self.fallback = np.array(
            [v.byte_ids.get(b, v.unknown) for b in range(256)], dtype=np.int32
        )

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:  # also within one text of very many chunks
            self.clear()
        marked = chunk.replace(" ", MARK)
        ids = [-1] if chunk == MARK else self.segment(marked)
        if min(ids) < 0:
            ids = self.with_bytes(ids, marked)
        self[chunk] = found = array("i", ids).tobytes()
        return found

    def with_bytes(self, ids: list[int], chunk: str) -> list[int]:
        """Replace -1 - p, an uncovered character at place p, by the pieces of its bytes."""
        out: list[int] = []
        for i in ids:
            out.extend(self.fallback[list(chunk[-1 - i].encode())].tolist() if i < 0 else [i])
        return out

    def segment(self, chunk: str) -> list[int]:
        """The best segmentation; -1 - p for a character at place p that no piece covers."""
        size = len(chunk)
        best = [WORST] * (size + 1)
        best[0] = 0.0
        lengths, pieces = [0] * (size + 1), [0] * (size + 1)
        known = self.single.issuperset(chunk)
        passed = 0
        for end, (length, score, piece) in self.matches(chunk):
            if not known:
                passed = self.pass_unknown(chunk, passed, end, best, lengths, pieces)
            end += 1
            score += best[end - length]
            if score > best[end]:
                best[end] = score
                lengths[end] = length
                pieces[end] = piece
        if not known:
            self.pass_unknown(chunk, passed, size, best, lengths, pieces)
        ids = []
        while size:
            ids.append(pieces[size])
            size -= lengths[size]
        ids.reverse()
        return ids

    def pass_unknown(
        self,
        chunk: str,
        start: int,
        stop: int,
        best: list[float],
        lengths: list[int],
        pieces: list[int],
    ) -> int:
        """Step over the uncovered characters at places start to stop - 1."""
        for p in range(start, stop):
            if chunk[p] not in self.single:
                score = best[p] + self.unknown_score
                if score > best[p + 1]:
                    best[p + 1], lengths[p + 1], pieces[p + 1] = score, 1, -1 - p
        return max(start, stop)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.vocabulary.prefix:
            text = " " + text
        return b"".join(map(self.__getitem__, self.chunks(text)))

    def decode(self, ids: list[int]) -> str:
        texts = self.vocabulary.texts
        found = b"".join([texts[i] for i in ids]).decode("utf-8", "replace")
        return found[1:] if self.vocabulary.prefix and found.startswith(" ") else found


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame,
    *,
    model_path: str = MODEL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_pieces, ids, restored (whether decoding the ids gives the text back)."""
    model = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            for start, texts in slices(batch["text"]):
                parts, restored, valid = [], [], []
                for text in texts.to_pylist():
                    ids = b"" if text is None else encoder.encode(text)
                    parts.append(ids)
                    valid.append(text is not None)
                    restored.append(
                        None
                        if text is None
                        else encoder.decode(np.frombuffer(ids, np.int32).tolist()) == text
                    )
                sizes = np.array([len(x) // 4 for x in parts], dtype=np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(parts), np.int32))
                valid = np.array(valid, dtype=bool)
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets, mask=np.append(~valid, False)), values
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(start, len(texts)),
                        pa.array(sizes, mask=~valid),
                        ids,
                        pa.array(restored, pa.bool_()),
                    ],
                    names=["doc_id", "n_pieces", "ids", "restored"],
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, n_pieces int, ids array<int>, restored boolean")


def decode(
    encoded: DataFrame, *, model_path: str = MODEL, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """doc_id, text: the texts that lists of ids stand for; null ids give a null text."""
    model = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            texts = [
                None if ids is None else encoder.decode(ids) for ids in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    return encoded.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")
    ).mapInArrow(run, "doc_id long, text string")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
