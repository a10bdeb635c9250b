"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased code points; every run of characters of each size in ``SIZES`` (windows never
span two documents) is hashed to one of ``BUCKETS`` columns.  Training sums the columns per
language in each task and adds up the tasks' sums; the model is the matrix of log probabilities
with add-``ALPHA`` smoothing and the log prior.  Scoring is a sparse product in numpy: the rows of
the matrix that a batch's n-grams name are summed per document, and a document's score is the
posterior of the best language.

Scale: the matrix has ``BUCKETS x languages`` floats whatever the corpus, so it is collected and
broadcast; what tasks send is at most that many counts each, added up per (language, block of
columns).  Documents are only scanned, never shuffled.  Very long texts are worked through in
pieces of ``BLOCK`` characters that overlap by the n-gram size, so memory per task is bounded.

Defined cases: null text, or text without any letter: ``und`` with score 0; no training rows: every
text is ``und``; ties go to the language that sorts first; repeated rows count once each in
training; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 15
ALPHA = 0.5
BLOCK = 1 << 18
MAX_LANGUAGES = 4096
UNKNOWN = "und"

_MULTIPLIERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917), np.uint32(668265263))


def _columns(codes: np.ndarray) -> list[np.ndarray]:
    """For each n-gram size, the hashed column of the n-gram that starts at each code point."""
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    out, h = [], np.zeros(len(codes), np.uint32)
    for size in range(1, max(SIZES) + 1):
        if len(codes) < size:
            break
        h = (h[: len(codes) - size + 1] ^ codes[size - 1:]) * _MULTIPLIERS[(size - 1) % 4] + np.uint32(size)
        if size in SIZES:
            mixed = h ^ (h >> np.uint32(15))
            out.append(((mixed * np.uint32(2654435761)) >> shift).astype(np.int32))
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _blocks(codes: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(code points, number of n-gram starts that belong to the block)."""
    for at in range(0, max(len(codes), 1), BLOCK):
        yield codes[at: at + BLOCK + max(SIZES) - 1], min(BLOCK, len(codes) - at)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            if lang not in sums:
                sums[lang] = np.zeros(BUCKETS, np.int64)
                docs[lang] = 0
            docs[lang] += 1
            for codes, own in _blocks(_codes(text.as_py())):
                for cols in _columns(codes):
                    sums[lang] += np.bincount(cols[:own], minlength=BUCKETS)
    for lang, counts in sums.items():
        full = np.flatnonzero(counts)
        # Column -1 carries the number of documents.
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * (len(full) + 1)), pa.array(np.append(full, -1).astype(np.int32)),
            pa.array(np.append(counts[full], docs[lang]).astype(np.int64))], ["lang", "col", "n"])


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log prior, ``BUCKETS x languages`` log probabilities) from columns text and lang."""
    rows = (labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
            .filter(F.col("text").isNotNull() & F.col("lang").isNotNull()))
    sums = rows.mapInArrow(_count, "lang string, col int, n long").groupBy("lang", "col").agg(F.sum("n").alias("n"))
    # At most BUCKETS + 1 rows per language.
    got = sums.toArrow()
    langs = sorted(set(got.column("lang").to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is lang a language column?")
    counts, docs = np.zeros((BUCKETS, len(langs))), np.zeros(len(langs))
    index = {lang: i for i, lang in enumerate(langs)}
    col, n = got.column("col").to_numpy(), got.column("n").to_numpy()
    row = np.array([index[x] for x in got.column("lang").to_pylist()], int)
    counts[col[col >= 0], row[col >= 0]] = n[col >= 0]
    docs[row[col < 0]] = n[col < 0]
    smooth = counts + ALPHA
    return langs, np.log(docs / max(docs.sum(), 1)) if langs else docs, np.log(smooth / smooth.sum(axis=0, keepdims=True))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    langs, prior, logp = model.value
    for batch in batches:
        best, score = [], []
        for text in batch.column("text"):
            text = text.as_py()
            if not langs or text is None or not any(map(str.isalpha, text)):
                best.append(UNKNOWN)
                score.append(0.0)
                continue
            total = prior.copy()
            for codes, own in _blocks(_codes(text)):
                for cols in _columns(codes):
                    # One-hot rows times the matrix, as counts of the columns that occur.
                    cols = cols[:own]
                    if len(cols) > BUCKETS // 4:
                        hits = np.bincount(cols, minlength=BUCKETS)
                        used = np.flatnonzero(hits)
                        total += hits[used] @ logp[used]
                    else:
                        total += logp[cols].sum(axis=0)
            likely = np.exp(total - total.max())
            i = int(np.argmax(total))
            best.append(langs[i])
            score.append(float(min(1.0, likely[i] / likely.sum())))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())],
            [*batch.schema.names, "lang_pred", "lang_score"])


def predict(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` (with a string column ``text``) and ``lang_pred``, ``lang_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "lang_score").withColumn("text", F.col("text").cast("string"))
    schema = docs.withColumn("lang_pred", F.lit("")).withColumn("lang_score", F.lit(0.0)).schema
    return docs.mapInArrow(lambda it: _score(it, shared), schema)


def held_out(doc_id: Column) -> Column:
    """True for the fold that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fold and predict all: ``doc_id, held_out, lang_pred, score``."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
