"""Fuzzy removal of repeated lines.

Lines that are equal are one class.  Every class gets ``BANDS`` keys of ``ROWS`` min-hash values over
its character shingles (runs of ``SHINGLE`` code points, hashed to 64 bits; the whole line if it is
shorter);
classes that share a key are compared on their full shingle sets, and links of Jaccard similarity
0.8 or more are closed over by distributed union-find.  Of each component the line that comes first,
by (doc_id, place of the row, line number), is kept.  Twenty bands of five rows find a pair at 0.8 with a
chance of 0.9996, at 0.85 of 0.99999, if the values are independent; a changed character takes five
shingles with it, so lines of 50 characters with one changed letter are still linked, in any script;
``ROWS`` is to be raised with the logarithm of the corpus.

The values come from one permutation: the scrambled shingle hashes fall into ``BANDS * ROWS`` bins, each
bin's value is its least hash, and a bin that is empty takes the value of another bin, tried in an order that
is the same for all lines.  One sorted pass over a line gives its set, its size, its parity bitmap and its
values.  (Bins of one line are not quite independent; the recall is measured in ``tests/llm``.)

Scale: a very common line is combined to its class before the shuffle; keys are linked by
:mod:`linking` (keys of one line alone never become rows; rows of one key are dealt to several tasks; no
all-pairs).  Texts, not sets, of the lines that share a key are fetched by a second scan through a fixed-size
sieve, and sets are made again where pairs are compared; only documents that lose a line go through the join that removes them.

Defined cases: null or empty texts have no lines and are left as they are; blank lines are never
removed; lines end at ``\\n`` (a ``\\r`` before it belongs to the line); a document that loses all its
lines keeps an empty text; rows are told apart by their place in the table, so each row loses its own
lines whether its ``doc_id`` is null, repeated, or its text repeated; null ids come first; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import linking, shingles
from daybook.llm.common import Scratch, Sieve, batches_of, numbered, split_by, text_or_empty, written

SHINGLE = 5
BANDS = 20
ROWS = 5
SEED = 4
SIMILARITY = 80
#: Characters, and lines, worked through at a time, for the processor's caches.
CHUNK = 1 << 18
CHUNK_LINES = 2048

BINS = BANDS * ROWS
WHERE = ["doc_id", "file", "place", "line"]
SIGNED = [*WHERE, "h1", "h2", "n", "size"]
SIGNED_SCHEMA = ", ".join(f"{c} long" for c in SIGNED) + ", keys binary"

#: For every empty bin, the bins whose value it takes, in this order: some at random, then all others.
_LENDERS = np.concatenate([np.random.default_rng(SEED).integers(0, BINS, (64, BINS)), (np.arange(BINS) + np.arange(1, BINS)[:, None]) % BINS])
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Lines:
    """The non-blank lines of a column of texts: where they are, and what they hash to."""

    def __init__(self, column: pa.Array):
        self.raw, offsets = shingles.text_bytes(column)
        raw = self.raw
        begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(raw == 10) + 1]))
        begins = begins[begins < len(raw)]
        ends = np.append(begins[1:], len(raw)).astype(np.int64)
        text = np.searchsorted(offsets, begins, side="right") - 1
        first = np.append(True, text[1:] != text[:-1])[: len(text)]
        at = np.flatnonzero(first)
        number = np.arange(len(begins)) - np.repeat(at, np.diff(np.append(at, len(begins))))
        ends -= (raw[ends - 1] == 10) if len(raw) else 0
        full = ends > begins
        full[full] = ~_BLANK[raw[begins[full]]]
        for i in np.flatnonzero((ends > begins) & ~full):  # lines that begin with a blank
            full[i] = not _BLANK[raw[begins[i]:ends[i]]].all()
        self.begins, self.ends, self.number = begins[full], ends[full], number[full].astype(np.int64)
        self.text = text[full]
        self.windows = shingles.byte_windows(raw)
        self.all_begins = begins

    def __getattr__(self, name: str):
        """The same in characters, made when asked for: values, begin and size of every line, and the end of
        the positions at which its shingles start; a short line has one."""
        if name not in ("chars", "at", "sizes", "shingle_ends"):
            raise AttributeError(name)
        self.chars, before = shingles.characters(self.raw, self.all_begins)
        self.at = self.begins if before is None else before[self.begins]
        self.sizes = (self.ends if before is None else before[self.ends]) - self.at
        self.shingle_ends = self.at + np.maximum(self.sizes - SHINGLE + 1, 1)
        return self.__dict__[name]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of every line: two sums over its eight-byte words, each scrambled with its place."""
        out = [np.zeros(len(self.begins), np.uint64) for _ in range(2)]
        sizes = self.ends - self.begins
        words = (sizes + 7) // 8
        if not len(words):
            return out[0], out[1]
        starts = np.append(0, np.cumsum(words))
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], words)
        value = self.windows[np.repeat(self.begins, words) + 8 * place]
        last = starts[1:] - 1
        spare = (8 * words - sizes).astype(np.uint64)
        value[last] &= ~np.uint64(0) >> (np.uint64(8) * spare)
        place = place.astype(np.uint64)
        for k in range(2):
            mixed = shingles.mix(value + shingles.mix(place * np.uint64(2) + np.uint64(k)))
            out[k] = shingles.mix(np.add.reduceat(mixed, starts[:-1]) + sizes.astype(np.uint64))
        return out[0], out[1]

    def short(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``some`` lines are shorter than a shingle, and the hash of their own characters."""
        places = np.flatnonzero(self.sizes[some] < SHINGLE)
        out = np.zeros(len(places), np.uint64)
        for n in range(1, SHINGLE):
            fit = self.sizes[some[places]] == n
            out[fit] = shingles.run_hashes(self.chars, self.at[some[places[fit]]], n)
        return places, out

    def sets(self, at: int, to: int) -> tuple[np.ndarray, np.ndarray]:
        """Scrambled hashes of the distinct shingles of the lines ``at`` to ``to``, sorted in each, and
        where each line's begin (one entry more than lines)."""
        begins = self.at[at:to]
        counts = self.shingle_ends[at:to] - begins
        starts = np.append(0, np.cumsum(counts))
        x = shingles.run_hashes(self.chars, slice(begins[0], self.shingle_ends[to - 1]), SHINGLE)
        spans = np.zeros(2 * (to - at), np.int64)
        spans[::2] = counts
        spans[1:-1:2] = begins[1:] - self.shingle_ends[at:to - 1]
        x = x[np.repeat(np.arange(2 * (to - at)) % 2 == 0, spans)]
        places, own = self.short(np.arange(at, to))
        x[starts[places]] = own
        x = shingles.mix(x)
        for b, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            x[b:e].sort()
        new = np.append(True, x[1:] != x[:-1])
        new[starts[:-1]] = True
        return x[new], np.append(0, np.cumsum(np.add.reduceat(new, starts[:-1], dtype=np.int64)))

    def chunks(self) -> Iterator[tuple[int, int]]:
        at = 0
        while at < len(self.at):
            to = min(max(at + 1, int(np.searchsorted(self.at, self.at[at] + CHUNK))), at + CHUNK_LINES)
            yield at, to
            at = to

    def signatures(self) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the lines' sets, and ``lines x BANDS`` keys."""
        sizes = np.empty(len(self.at), np.int64)
        values = np.empty((len(self.at), BINS), np.uint64)
        for at, to in self.chunks():
            x, starts = self.sets(at, to)
            sizes[at:to] = np.diff(starts)
            values[at:to] = _binned(x, starts)
        keys = np.zeros((len(self.at), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        for r in range(ROWS):
            keys = shingles.mix(keys + values[:, r::ROWS])
        return sizes, keys

    def facts(self) -> np.ndarray:
        """``lines x FACTS``."""
        out = np.empty((len(self.at), len(linking.FACTS)), np.int64)
        for at, to in self.chunks():
            x, starts = self.sets(at, to)
            out[at:to, 0] = np.diff(starts)
            out[at:to, 1:] = linking.parities(x, np.repeat(np.arange(to - at), out[at:to, 0]), to - at)
        return out


def _binned(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``lines x BINS`` least hashes, from the sorted hashes ``x`` of every line, which begin at ``starts``."""
    lines = len(starts) - 1
    bins = x >> np.uint64(32)
    bins *= np.uint64(BINS)
    bins >>= np.uint64(32)
    bins = bins.astype(np.uint8 if BINS <= 256 else np.int64)
    lead = np.empty(len(x), bool)
    np.not_equal(bins[1:], bins[:-1], out=lead[1:])
    lead[starts[:-1]] = True
    leads = np.flatnonzero(lead)
    place = bins[leads] + np.repeat(np.arange(lines) * BINS, np.diff(np.searchsorted(leads, starts)))
    values = np.zeros(lines * BINS, np.uint64)
    full = np.zeros(lines * BINS, bool)
    values[place] = x[leads]
    full[place] = True
    empty = np.flatnonzero(~full)
    bin_ = empty % BINS
    for lender in _LENDERS:
        if not len(empty):
            break
        from_ = empty - bin_ + lender[bin_]
        lends = full[from_]
        values[empty[lends]] = values[from_[lends]]
        empty, bin_ = empty[~lends], bin_[~lends]
    return values.reshape(lines, BINS)


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _firsts(batch: pa.RecordBatch, lines: Lines, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """How often each line occurs in the batch, at the first (by ``WHERE``) of equal ones; 0 at the others."""
    rank = np.empty(len(batch), np.int64)
    rank[_by_place(batch, WHERE[:3])] = np.arange(len(batch))
    order = np.lexsort((lines.number, rank[lines.text], h2, h1))
    out = np.zeros(len(order), np.int64)
    if len(order):
        starts = np.flatnonzero(_changes(h1[order], h2[order]))
        out[order[starts]] = np.diff(np.append(starts, len(order)))
    return out


def _by_place(batch: pa.RecordBatch, columns: list[str], *over: np.ndarray) -> np.ndarray:
    """The order of rows by ``over`` and then ``columns``, ids that are null first."""
    ids = batch.column(columns[0])
    return np.lexsort((*[batch.column(c) for c in columns[:0:-1]], ids.fill_null(0), ids.is_valid(), *over[::-1]))


def _changes(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Where a run of equal hashes begins."""
    return np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))[: len(h1)]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = Lines(batch.column("text"))
        sizes, keys = lines.signatures()
        rows = pa.array(lines.text)
        h1, h2 = lines.hashes()
        n = _firsts(batch, lines, h1, h2)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(rows) for c in WHERE[:3]], pa.array(lines.number), _i64(h1), _i64(h2), pa.array(n),
             pa.array(sizes), linking.packed_keys(keys, n > 0)], [*SIGNED, "keys"])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``h1``, the first (by ``WHERE``) of every class with the sum of ``n``."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)  # without marks of columns that hold no null
        if held is not None:
            batch = pa.concat_batches([held, batch])
        h1, h2, n = (batch.column(c).to_numpy() for c in ("h1", "h2", "n"))
        order = _by_place(batch, WHERE, h1, h2)
        starts = np.flatnonzero(_changes(h1[order], h2[order]))
        found = batch.take(pa.array(order[starts])).set_column(SIGNED.index("n"), "n", pa.array(np.add.reduceat(n[order], starts)))
        # Classes of the last h1 may go on in the next batch.
        done = int(np.searchsorted(h1[order[starts]], h1[order[-1]]))
        yield found.slice(0, done)
        held = found.slice(done)
    if held is not None:
        yield held


def _wanted_lines(batches: Iterator[pa.RecordBatch], sieve) -> Iterator[pa.RecordBatch]:
    """Place and text of the lines that may be wanted."""
    for batch in batches:
        lines = Lines(batch.column("text"))
        places = [batch.column(c).to_numpy()[lines.text] for c in ("file", "place")] + [lines.number]
        some = np.flatnonzero(sieve.value(*places))
        raw = lines.raw.tobytes() if len(some) else b""
        texts = pa.array([raw[b:e] for b, e in zip(lines.begins[some].tolist(), lines.ends[some].tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([*[pa.array(x[some]) for x in places], texts], [*WHERE[1:], "items"])


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = Lines(batch.column("items"))
        assert len(lines.begins) == len(batch)
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(np.ascontiguousarray(f)) for f in lines.facts().T]], ["id", *linking.FACTS])


def _similar(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose lines x and y have the similarity."""
    for batch in batches:
        if not len(batch):
            continue
        sides = []
        for c in ("x", "y"):
            lines = Lines(batch.column(c).cast(pa.binary()))
            assert len(lines.at) == len(batch)
            sides.append([s for at, to in lines.chunks() for s in _split(*lines.sets(at, to))])
        near = np.zeros(len(batch), bool)
        for i, (x, y) in enumerate(zip(*sides)):
            both = np.concatenate((x, y))
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            near[i] = 100 * common >= percent * (len(both) - common)
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _split(x: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    return [x[b:e] for b, e in zip(starts[:-1].tolist(), starts[1:].tolist())]


def _longs(names: list[str]) -> str:
    return ", ".join(f"{c} long" for c in names)


def _texts(rows: DataFrame) -> DataFrame:
    """From numbered rows, what the scans read."""
    return rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "file", "place", text_or_empty(F.col("row.text")).alias("text"))


def _signed_lines(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The place of every line and its hashes; the classes of equal lines with the place of the first, the
    number of lines, size and keys.  Equal lines of a batch are combined before the shuffle."""
    signed = written(texts.mapInArrow(_signed, SIGNED_SCHEMA), "signed-lines")
    some = signed.filter("n > 0").repartition("h1").sortWithinPartitions("h1")
    with batches_of(texts.sparkSession, 20_000):
        classes = some.mapInArrow(_classes, SIGNED_SCHEMA).withColumn("id", F.monotonically_increasing_id())
        return signed.select(*WHERE, "h1", "h2"), written(classes, "line-classes")


def _labels(classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``h1, h2, first, label`` of the classes that occur more than once or are linked."""
    with Scratch(texts.sparkSession) as scratch:
        members: list[DataFrame] = []

        def facts_of(ids: DataFrame) -> DataFrame:
            wanted = written(classes.select("id", *WHERE[1:]).join(ids, "id"), "wanted")
            sieve = Sieve.build(wanted.drop("id"))
            some = texts.select("file", "place", "text").mapInArrow(
                lambda it: _wanted_lines(it, sieve), f"{_longs(WHERE[1:])}, items binary")
            members.append(scratch.keep(some.join(wanted, WHERE[1:]).select("id", "items"), "member-lines"))
            return members[0].mapInArrow(_facts, _longs(["id", *linking.FACTS]))

        def similar(both: DataFrame) -> DataFrame:
            return both.mapInArrow(lambda it: _similar(it, percent), "a long, b long")

        rows = linking.shared_keys(classes, BANDS)
        linked = linking.link(rows, facts_of, lambda ids: split_by(members[0], ids, "id")[0].join(ids, "id", "left_semi"), similar, percent)
        found = classes.select("id", *WHERE, "h1", "h2", "n").join(linked, "id", "left").filter("n > 1 or label is not null")
        found = found.select("h1", "h2", F.struct(*WHERE).alias("first"), F.coalesce("label", "id").alias("label"))
        return scratch.keep(found, "line-labels")


def _placed(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Numbered ``docs``, and a row per non-blank line of each: ``WHERE`` and ``keep``, null or where the
    kept line of its component is."""
    rows = numbered(docs)
    with Scratch(docs.sparkSession) as scratch:
        texts = _texts(rows)
        lines, classes = _signed_lines(texts)
        labels = _labels(classes, texts, percent)
        keep = labels.groupBy("label").agg(F.min("first").alias("keep"))
        found = labels.join(keep, "label").select("h1", "h2", "keep")
        return rows, scratch.keep(lines.join(found, ["h1", "h2"], "left").select(*WHERE, "keep"), "placed-lines")


def classify(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """A row per non-blank line: ``doc_id, line, keep_doc_id, keep_line, kept`` (the component's kept
    line; for most lines themselves)."""
    _, lines = _placed(docs, percent)
    own = F.struct(*WHERE)
    lines = lines.withColumn("keep", F.coalesce("keep", own))
    return lines.select("doc_id", "line", F.col("keep.doc_id").alias("keep_doc_id"),
                        F.col("keep.line").alias("keep_line"), F.col("keep").eqNullSafe(own).alias("kept"))


def drop_repeated_lines(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """``docs`` whose texts have lost every line that is not the kept one of its component."""
    rows, lines = _placed(docs, percent)
    gone = lines.filter(F.col("keep").isNotNull() & ~F.col("keep").eqNullSafe(F.struct(*WHERE)))
    # At most the lines of one row of the table.
    gone = written(gone.groupBy("file", "place").agg(F.collect_set("line").alias("gone")).withColumn("at", F.xxhash64("file", "place")), "gone-lines")
    may, stay = split_by(rows.withColumn("at", F.xxhash64("file", "place")), gone, "at")
    text = F.col("row.text").cast("string")
    left = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("gone", i.cast("long")))
    new = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(left, "\n"))
    cut = may.join(gone.drop("at"), ["file", "place"], "left").select(F.col("row").withField("text", new).alias("row"))
    return stay.select(F.col("row").withField("text", text).alias("row")).unionByName(cut).select("row.*")
