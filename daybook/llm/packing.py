"""Packing of tokenised documents into fixed-length training sequences.

Method: shortest-pack-first over the length histogram.  A document's ids (plus the closing id)
are cut at multiples of the sequence length; every piece is then one count in a histogram over
lengths ``1..length``.  Lengths are placed longest first, each into the currently shortest pack
that still has room for it, by counts and not by documents: a *pattern* is a range of sequence
numbers with the same content, and placing ``c`` pieces into it splits the range once.  The
placement is a list of runs ``(length, first rank, count, first sequence, offset)``, and a piece
finds its run by its rank among the pieces of its length.

Scale: the driver sees only the histogram, at most ``length`` rows whatever the corpus.  The plan
holds at most one open range per split, so its size depends on ``length`` only (a few thousand
runs for 1024), which is why broadcasting it is safe.  Ranks come from running counters inside the
tokenising task plus per-(file, length) totals summed up over files: a length that a third of all
pieces share is never gathered anywhere.

Defined cases: a null or empty text is the closing id alone (one piece of length 1); a repeated
``doc_id`` is packed once per row; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import text_or_empty, written

SEQUENCE_LENGTH = 1024
CLOSING_ID = 0

PIECE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("local_rank", T.LongType()),
])

_ENCODERS: dict[object, object] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use, from their published rule:
    printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


def byte_level_encoder(path: str):
    """The vocabulary file's byte-level BPE as a ``tiktoken`` encoding: ids in these files rise in
    merge order, so they serve as ranks.  ``tests/llm`` compares it with ``tokenizers``."""
    if path not in _ENCODERS:
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()
                 if all(c in alphabet for c in tok)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {k: v for k, v in ranks.items() if v not in set(special.values())}
        # Fixed value: the split pattern of the byte-level pre-tokeniser.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        _ENCODERS[path] = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks,
                                            special_tokens=special)
    return _ENCODERS[path]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text.  ``tiktoken`` gives up on runs of about a million blanks, for its regular
    expression keeps a way back for every one of them; the tokenizers library encodes such texts."""
    enc = byte_level_encoder(path)
    try:
        return enc.encode_to_numpy(text, allowed_special=enc.special_tokens_set)
    except ValueError:
        if ("library", path) not in _ENCODERS:
            from tokenizers import Tokenizer
            _ENCODERS["library", path] = Tokenizer.from_file(path)
        return np.array(_ENCODERS["library", path].encode(text, add_special_tokens=False).ids, "<u4")


def cut_pieces(batches: Iterator[pa.RecordBatch], tokenizer: str, length: int, closing: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    ranks = [0] * (length + 1)
    names = [f.name for f in PIECE_SCHEMA]
    for batch in batches:
        cols: list[list] = [[], [], [], [], [], []]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids = np.append(token_ids(text.as_py(), tokenizer), closing).astype("<u4")
            n = len(ids)
            raw = memoryview(ids.tobytes())
            for start in range(0, n, length):
                k = min(length, n - start)
                cols[0].append(doc_id)
                cols[1].append(start)
                cols[2].append(k)
                cols[3].append(zlib.crc32(raw[4 * start:4 * (start + k)]))
                cols[4].append(n)
                cols[5].append(ranks[k])
                ranks[k] += 1
        arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
        arrays.append(pa.array(np.full(len(cols[0]), part, np.int32)))
        arrays.append(pa.array(cols[5], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, names)


def plan_runs(histogram: dict[int, int], length: int) -> list[tuple[int, int, int, int, int]]:
    """Shortest-pack-first placement of ``{piece length: count}``.

    Returns runs ``(length, rank_from, count, first_sequence, offset)``.  ``open_by_room[r]`` holds
    ranges ``[first sequence, count]`` of packs with ``r`` free places."""
    open_by_room: list[list[list[int]]] = [[] for _ in range(length + 1)]
    rooms = 0  # bit r set: some pack has r free places
    runs, next_seq = [], 0
    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left > 0:
            room = rooms.bit_length() - 1
            if room >= size:
                first, count = open_by_room[room].pop()
                take = min(count, left)
                if take < count:
                    open_by_room[room].append([first + take, count - take])
                if not open_by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, take, first = length, left, next_seq
                # A fresh pack takes as many pieces of this size as it holds.
                per = length // size
                take = -(-left // per)
                next_seq += take
            runs.append((size, rank, take, first, length - room))
            rank, left, room = rank + take, left - take, room - size
            if room:
                open_by_room[room].append([first, take])
                rooms |= 1 << room
    return runs


RUN_SCHEMA = "length long, rank_from long, n long, first_sequence long, run_offset long"


def pack(docs: DataFrame, tokenizer: str, length: int = SEQUENCE_LENGTH, closing: int = CLOSING_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    pieces = written(source.mapInArrow(lambda it: cut_pieces(it, tokenizer, length, closing), PIECE_SCHEMA), "pieces")
    totals = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(totals.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-bases")
    # At most ``length`` rows.
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan_runs(histogram, length), RUN_SCHEMA)
    ranked = (pieces.join(bases.drop("n"), ["part", "length"])
              .withColumn("rank", F.col("base") + F.col("local_rank")))
    hit = (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_from") + F.col("n"))
    return (ranked.alias("p").join(F.broadcast(runs).alias("r"), (F.col("p.length") == F.col("r.length")) & hit)
            .select("doc_id", "start", F.col("p.length").alias("length"), "ids_crc32", "doc_tokens",
                    (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"),
                    F.col("run_offset").alias("offset")))
