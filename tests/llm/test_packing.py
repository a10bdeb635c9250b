import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from daybook.llm import packing
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(text):
    tk = Tokenizer.from_file(PATH)
    return [*tk.encode(text or "", add_special_tokens=False).ids, packing.CLOSING_ID]


def check(rows, texts):
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = library_ids(text)
        mine = sorted(pieces.pop(doc_id), key=lambda r: r.start)
        assert [r.start for r in mine] == [*np.cumsum([0, *(r.length for r in mine)])[:-1]]
        assert sum(r.length for r in mine) == len(ids)
        for r in mine:
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(part))
    assert not pieces
    gapless(rows)


def gapless(rows):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE_LENGTH
    return seqs


def test_odd_texts(make_docs):
    rows = [(i, t) for i, t in dict(ODD_TEXTS).items()]
    check(packing.pack(make_docs(rows), PATH).collect(), dict(rows))


def test_repeated_rows_and_special_strings(make_docs):
    rows = packing.pack(make_docs([(1, "a <|endoftext|> b"), (1, "a <|endoftext|> b")]), PATH).collect()
    assert len(rows) == 2 and rows[0].doc_tokens == len(library_ids("a <|endoftext|> b"))
    gapless(rows)


def test_runs_of_over_a_million_blanks(make_docs):
    texts = {1: "a" + " " * 1_200_000 + "b", 2: "\n" * 1_200_000, 3: " \t" * 600_000 + "<|endoftext|> c", 4: "short"}
    check(packing.pack(make_docs(list(texts.items())), PATH).collect(), texts)


def test_empty_table(make_docs):
    out = packing.pack(make_docs([]), PATH)
    assert out.count() == 0 and "sequence_id" in out.columns


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), min_size=1, max_size=64))
def test_plan_places_every_piece_once(histogram):
    fill, seen = {}, {}
    for size, rank, n, first, offset in packing.plan_runs(histogram, 64):
        assert rank == seen.get(size, 0)
        seen[size] = rank + n
        for s in range(first, first + n):
            assert fill.get(s, 0) == offset
            fill[s] = offset + size
    assert seen == histogram and max(fill.values()) <= 64
    assert sorted(fill) == list(range(len(fill)))


def test_little_padding():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(np.clip(rng.lognormal(5.5, 1, 200_000).astype(int), 1, 1024), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist()))
    runs = packing.plan_runs(histogram, 1024)
    sequences = max(first + n for _, _, n, first, _ in runs)
    assert sum(k * v for k, v in histogram.items()) / (1024 * sequences) > 0.99
    assert len(runs) < 20_000


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_registered_query(spark, sf):
    from daybook.llm.registered import QUERIES
    rows = QUERIES["op1_packing"](spark, sf).collect()
    check(rows, {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()})
