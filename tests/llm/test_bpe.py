import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import bpe
from tests.llm.conftest import ODD_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(enc, text):
    return np.frombuffer(b"".join(enc.encode(text)), "<u4").tolist()


def check(rows, texts, library):
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_texts(make_docs, library):
    texts = {i: t for i, t in ODD_TEXTS if i not in (None, 8)} | {50: "a<|endoftext|>b <|startoftext|>", 51: "\x00\x01 ΑΣ Σας İ", 52: "it's they'll ſ K"}
    check(bpe.round_trip(make_docs(list(texts.items())), PATH).collect(), texts, library)


def test_repeated_rows_and_empty_table(make_docs):
    assert bpe.round_trip(make_docs([(1, "ab"), (1, "ab"), (None, "ab")]), PATH).distinct().count() == 2
    assert bpe.round_trip(make_docs([]), PATH).collect() == []


def test_registered_query(spark, library):
    from daybook.llm.registered import QUERIES
    sf = "/root/testdata/sf0.001"
    check(QUERIES["op8_bpe"](spark, sf).collect(), {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}, library)


def test_encode_then_decode(make_docs, library):
    docs = make_docs([(1, "Hello wide world"), (2, None)])
    got = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert got == {1: library.decode(library.encode("Hello wide world", add_special_tokens=False).ids), 2: ""}


def test_random_texts(library):
    enc, rng = bpe.encoder(PATH), random.Random(4)
    entries = list(library.get_vocab())
    for i in range(600):
        text = "".join(rng.choice(entries).replace("</w>", rng.choice(["", " "])) for _ in range(rng.randint(1, 30)))
        if i % 3 == 0:
            text = "".join(rng.choice("aaabcdehlnorst'") for _ in range(rng.randint(1, 300)))
        if i % 7 == 0:
            text = "".join(chr(rng.choice([rng.randint(32, 126), rng.randint(128, 0x2fff), rng.randint(0x1f300, 0x1faff)])) for _ in range(60))
        assert ids_of(enc, text) == library.encode(text, add_special_tokens=False).ids


def test_stream_needs_only_bounded_lookahead():
    t = bpe.encoder(PATH).transducer
    read = 0

    def endless():
        nonlocal read
        rng = random.Random(1)
        while True:
            read += 1
            yield rng.choice("etaoinshrdlu")
    out, made = t.stream(endless()), 0
    for _ in range(20_000):
        made += len(t_of(next(out)))
        assert read - made <= t.lookahead
    assert max(map(len, t.states)) <= t.lookahead


def t_of(i, cache={}):  # noqa: B006
    if not cache:
        cache.update(bpe.encoder(PATH).text_of)
    return cache[i].removesuffix(bpe.END)


def test_small_table_gives_the_same(library):
    enc = bpe.encoder(PATH)
    small = bpe.Transducer(enc.transducer.vocab, list(enc.transducer.ranks), limit=20)
    for word in ("internationalisation", "aaaaaaaaaaaaaaaaaaaaaaa", "thequickbrownfox", "x"):
        assert list(small.stream(word)) == library.encode(word, add_special_tokens=False).ids
        assert len(small.states) <= 22


def test_lookahead_of_a_known_list():
    # A change at the end of "abcd" can undo cd, then free c for bc, then b for ab.
    merges = [("c", "d"), ("b", "c"), ("a", "b")]
    assert bpe.sufficient_lookahead(merges) >= 3
    assert bpe.sufficient_lookahead([("a", "b")]) < bpe.sufficient_lookahead(merges)


def test_incremental_decoding_of_bytes():
    back = {c: b for b, c in ((v, k) for k, v in bpe.byte_alphabet().items())}
    text = "naïve 😀 ok" + "é" * 50
    raw = text.encode()
    text_of = {i: next(c for c, b in back.items() if b == x) for i, x in enumerate(raw)}
    d = bpe.Decoder(text_of, byte_level=True)
    assert "".join([*(d.feed([i]) for i in range(len(raw))), d.finish()]) == text
    d = bpe.Decoder(text_of, byte_level=True)
    assert d.feed(range(len(raw) - 1)) + d.finish() == raw[:-1].decode("utf-8", "replace")
