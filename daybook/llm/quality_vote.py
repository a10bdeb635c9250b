"""Quality classifier: labelled neighbours in a latent-semantic space vote.

Terms of a text are its UTF-8 byte n-grams of ``SIZES``, hashed to ``COLUMNS`` columns, and its pairs
of neighbouring words, told apart by whether the two are equal and by a class of the second (a text that
repeats itself has terms of its own so; letters have the same n-grams either way).  A text is the vector
of ``log(1 + count) * idf``, of length one.  The latent space is spanned by the first ``RANK`` right
singular vectors of the labelled texts' vectors (randomised range finder with power iterations);
projected there and scaled to length one again, the labelled vectors are broadcast, every text is
multiplied with all of them in blocks (exact cosines, no index), and its ``NEIGHBOURS`` nearest, with all that
tie with the last of them, vote with the weight ``cosine ** SHARPNESS``.

Scale: document frequencies are counted over all documents.  The classifier is fitted on at most
``LEARNED`` labelled rows, those first by a hash of their id (documented bound; the fewer, the
less recall on rare kinds of text), so what is collected and broadcast is at most ``LEARNED``
vectors whatever the corpus.  Texts are scanned twice and never shuffled, but for the learned ones;
they are worked through ``TEXTS`` at a time, long ones in pieces of ``BLOCK`` bytes.

Defined cases: null text is empty; a text without any term, or with no neighbour of positive cosine,
gets the share of label 1 among the learned rows; without learned rows every score is 0.5; labels other
than 0 and 1 and without id are left out, of several labels of one id the greatest counts, and of
several texts the first in order; rows are scored each, repeated or not; rows without ``doc_id`` are not
held out and cannot be learned; words over ``2 * BLOCK`` bytes count in pieces; extra columns are
ignored by :func:`classify` and pass through :func:`predict`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import shingles
from daybook.llm.common import Scratch, packed, text_or_empty, written

SIZES = (2, 3)
COLUMNS = 1 << 12
#: Classes of words in the terms of word pairs, and how much more than an n-gram such a term weighs.
CLASSES = 16
PAIR_WEIGHT = 3.0
WIDTH = COLUMNS + 2 * CLASSES

LEARNED = 8192
RANK = 64
POWERS = 4
NEIGHBOURS = 15
SHARPNESS = 4
SEED = 1
TEXTS = 256
BLOCK = 1 << 18
#: Fixed value: the contract's threshold.
GOOD = 0.3

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def _pieces(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about ``BLOCK`` bytes, at blanks where there are any."""
    at = 0
    while at < len(raw):
        to = min(at + BLOCK, len(raw))
        if to < len(raw):
            blank = np.flatnonzero(_SPACES[raw[to: to + BLOCK]])
            to = min(to + (int(blank[0]) if len(blank) else BLOCK), len(raw))
        yield at, to
        at = to


def term_counts(text: bytes) -> np.ndarray:
    """Counts of the terms of one text, by column."""
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(WIDTH, np.int64)
    shift = np.uint32(32 - COLUMNS.bit_length() + 1)
    before = np.zeros(0, np.uint64)
    for at, to in _pieces(raw):
        codes = raw[at: to + max(SIZES) - 1].astype(np.uint32)
        h = codes
        for n in range(2, max(SIZES) + 1):
            if len(codes) < n:
                break
            h = (h[: len(codes) - n + 1] * np.uint32(0x01000193)) ^ codes[n - 1:]
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(2654435761)
            if n in SIZES:
                out[:COLUMNS] += np.bincount(mixed[: to - at] >> shift, minlength=COLUMNS)
        words, _ = shingles.word_hashes(raw[at:to], np.array([0, to - at]))
        words = np.append(before, words)
        if len(words) > 1:
            place = (words[1:] % np.uint64(CLASSES)).astype(np.int64) + CLASSES * (words[1:] == words[:-1])
            out[COLUMNS:] += np.bincount(place, minlength=2 * CLASSES)
        before = words[-1:]
    return out


def _texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[np.ndarray]:
    """Counts of the batch's texts, ``TEXTS`` rows at a time."""
    texts = batch.column(name).cast(pa.large_binary())
    for i in range(0, len(texts), TEXTS):
        yield np.stack([term_counts(t.as_py()) for t in texts[i:i + TEXTS]])


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(WIDTH + 1, np.int64)
    for batch in batches:
        for counts in _texts(batch):
            held[:-1] += (counts > 0).sum(axis=0)
            held[-1] += len(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1)), pa.array(held)], ["col", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, label and the non-zero counts of each text, as bytes."""
    for batch in batches:
        cols, counts = [], []
        for part in _texts(batch):
            for row in part:
                full = np.flatnonzero(row)
                cols.append(full.astype(np.uint16).tobytes())
                counts.append(row[full].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(cols, pa.binary()), pa.array(counts, pa.binary())],
                                         ["doc_id", "label", "cols", "counts"])


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


@dataclass
class Model:
    """``weight`` per column, ``space`` (columns x rank), the learned ``vectors`` and their ``labels``."""

    weight: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts).astype(np.float32) * self.weight)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(self.weighted(counts) @ self.space)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Votes of the nearest learned vectors on each row of ``counts``."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosines = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        last = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, -k]
        row, who = np.nonzero((cosines >= last[:, None]) & (cosines > 0))
        votes = cosines[row, who].astype(np.float64) ** SHARPNESS
        total = np.bincount(row, votes, len(counts))
        good = np.bincount(row, votes * self.labels[who], len(counts))
        out = np.full(len(counts), self.labels.mean())
        np.divide(good, total, out=out, where=total > 0)
        return np.clip(np.round(out, 6), 0.0, 1.0)


def span(x: np.ndarray, rank: int) -> np.ndarray:
    """The first right singular vectors of ``x``, as columns."""
    rank = min(rank, *x.shape)
    start = np.random.default_rng(SEED).standard_normal((len(x), min(rank + 16, *x.shape))).astype(np.float32)
    basis = np.linalg.qr(x.T @ start)[0]
    for _ in range(POWERS):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    return basis @ np.linalg.svd(x @ basis, full_matrices=False)[2].T[:, :rank]


def train(docs: DataFrame, labels: DataFrame, learned: int = LEARNED) -> Model:
    """Document frequencies from the ``text`` of all ``docs``; space and vectors from at most
    ``learned`` rows of ``labels`` (doc_id, label 0 or 1)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    seen = rows.select("text").mapInArrow(_presence, "col long, n long").groupBy("col").agg(F.sum("n").alias("n")).toArrow()
    present = np.zeros(WIDTH + 1)
    present[seen.column("col").to_numpy()] = seen.column("n").to_numpy()
    weight = np.log((1 + present[-1]) / (1 + present[:-1]))
    weight[COLUMNS:] *= PAIR_WEIGHT
    marks = (labels.filter("doc_id is not null and label in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("label").cast("int").alias("label")).join(rows.select("doc_id"), "doc_id", "left_semi"))
    with Scratch(docs.sparkSession):
        chosen = written(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(learned), "learned-ids")
        # At most ``learned`` rows of two numbers.
        texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
        got = texts.mapInArrow(_sparse, "doc_id long, label int, cols binary, counts binary").toArrow().sort_by("doc_id")
    x = np.zeros((got.num_rows, WIDTH), np.float32)
    for i, (cols, counts) in enumerate(zip(got.column("cols"), got.column("counts"))):
        x[i, np.frombuffer(cols.as_py(), np.uint16)] = np.frombuffer(counts.as_py(), np.float32)
    model = Model(weight.astype(np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32),
                  got.column("label").to_numpy().astype(np.float64))
    if len(x):
        model.space = span(model.weighted(x), RANK).astype(np.float32)
        model.vectors = model.latent(x)
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shared.value.scores(counts) for counts in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(values) if values else np.zeros(0))], ["row", "score"])

    rows = packed(docs, "text").withColumn("text", text_or_empty())
    return rows.mapInArrow(score, rows.select("row", F.lit(0.0).alias("score")).schema)


def held_out(doc_id: Column) -> Column:
    """True for the fold whose labels are never learned."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, learned: int = LEARNED) -> DataFrame:
    """``doc_id, held_out, score, predicted``, learned from ``labels`` (doc_id, label) outside the
    held-out fold."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))), learned)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                        (F.col("score") >= GOOD).cast("int").alias("predicted"))
