"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Encoder.  Each word that the pre-tokeniser finds is read symbol by symbol.  The transducer's state
is the *pending* text since the last boundary that is certain; reading a symbol may make boundaries
certain, and the tokens before them are emitted at once.  A boundary is certain when it lies in the
BPE encoding of every prefix at which the token under way may have begun: BPE has the property that
the encoding of a text is the encoding of a prefix of it followed by one more token, so those
prefixes are all that any continuation can choose from.  A token under way must be a proper prefix
of some vocabulary entry, so only the last ``longest token`` starts are open, and pending text never
exceeds the merge list's lookahead (:func:`sufficient_lookahead`) by more than one token.  Since
text right of a certain boundary encodes independently of what is left of it, the state needs no
history: transitions are kept in a table of bounded size that starts afresh when full, and memory is
constant in the length of the text and of a word.

Decoder.  Ids are turned into text in blocks by a state machine that holds back the bytes of an
unfinished code point (byte-level vocabularies), or joins entries by blanks (vocabularies without a
decoder), exactly as a decoder over the whole list would.

Scale: a document is one row, there is no shuffle; tables per Python worker are of fixed size.

Defined cases: null or empty text has no ids and decodes to the empty string; repeated rows are
encoded each; extra columns are ignored; special-token strings in a text become their special ids.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import text_or_empty
from daybook.llm.packing import byte_alphabet

END = "</w>"
TABLE_LIMIT = 400_000
WORD_LIMIT = 400_000
#: Words of up to so many symbols may be kept with their ids.
KEPT_WORD = 32


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """How many symbols to the left a change can make itself felt, computed from the merge list.

    A difference between two encodings moves its left end across a token ``x`` only through a merge
    ``(x, z)``, and moves on only through a later merge ``(y, z')`` whose ``z'`` begins with ``x``.
    The longest such chain of rising ranks, in symbols, plus the longest entry, bounds the reach.
    Going through the merges from the last to the first, ``reach[p]`` is the longest chain that
    starts with a merge whose right side begins with ``p``."""
    reach: dict[str, int] = {}
    longest = most = 0
    for left, right in reversed(merges):
        chain = len(left) + reach.get(left, 0)
        most = max(most, chain)
        longest = max(longest, len(left) + len(right))
        for i in range(1, len(right) + 1):
            p = right[:i]
            if reach.get(p, 0) < chain:
                reach[p] = chain
    return most + longest


class State:
    """A pending text, the encodings of its prefixes where a token may be under way, and the
    transitions found so far: symbol -> (ids emitted, next state); ``None`` is the word's end."""

    __slots__ = ("pending", "starts", "to")

    def __init__(self, pending: str, starts: dict[int, tuple[str, ...]]):
        self.pending, self.starts, self.to = pending, starts, {}


class Transducer:
    """Streaming BPE over one merge list with an end-of-word mark."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], limit: int = TABLE_LIMIT):
        self.vocab, self.limit = vocab, limit
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.open = {t[:i] for t in vocab for i in range(1, len(t) + 1)}
        self.lookahead = sufficient_lookahead(merges)
        self.states: dict[str, State] = {}
        self.root = self._fresh("", {0: ()})

    def _fresh(self, pending: str, starts: dict[int, tuple[str, ...]]) -> State:
        got = self.states.get(pending)
        if got is None:
            got = self.states[pending] = State(pending, starts)
        return got

    def merge(self, symbols: list[str]) -> list[str]:
        """The encoding of a short run of symbols: the lowest rank first, from left to right."""
        ranks = self.ranks
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                r = ranks.get((symbols[i], symbols[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _last(self, text: str) -> tuple[str, ...]:
        return tuple(self.merge(list(text)))

    def _step(self, state: State, symbol: str) -> tuple[tuple[int, ...], State]:
        """Read one symbol that doesn't end the word."""
        text = state.pending + symbol
        n = len(text)
        starts = {q: e for q, e in state.starts.items() if text[q:] in self.open}
        starts[n] = self._last(text)
        # Boundaries of an encoding, as a running length; the certain ones are common to all.
        common, cut = None, 0
        for e in starts.values():
            at, ends = 0, set()
            for t in e:
                at += len(t)
                ends.add(at)
            common = ends if common is None else common & ends
        cut = max((c for c in common if c <= min(starts)), default=0)
        if not cut:
            return (), self._fresh(text, starts)
        out, at, k = [], 0, 0
        done = starts[n]
        while at < cut:
            out.append(self.vocab[done[k]])
            at += len(done[k])
            k += 1
        left = {}
        for q, e in starts.items():
            at = i = 0
            while at < cut:
                at += len(e[i])
                i += 1
            left[q - cut] = e[i:]
        return tuple(out), self._fresh(text[cut:], left)

    def _finish(self, state: State, symbol: str) -> tuple[int, ...]:
        """Read the word's last symbol."""
        return tuple(self.vocab[t] for t in self.merge([*state.pending, symbol + END]))

    def stream(self, symbols: Iterable[str]) -> Iterator[int]:
        """Ids of one word, each as soon as it is certain; ``symbols`` may be endless."""
        node, held = self.root, None
        for c in symbols:
            if held is not None:
                got = node.to.get(held)
                if got is None:
                    if len(self.states) > self.limit:
                        self.states = {}
                        self.root = self._fresh("", {0: ()})
                        node = self._fresh(node.pending, node.starts)
                        node.to = {}
                    got = node.to[held] = self._step(node, held)
                out, node = got
                if out:
                    yield from out
            held = c
        if held is not None:
            key = held + END
            got = node.to.get(key)
            if got is None:
                got = node.to[key] = self._finish(node, held)
            yield from got


class Encoder:
    """Normaliser, splitter and transducer of a vocabulary file of the lower-casing word-end kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["end_of_word_suffix"] != END or spec["normalizer"] is None:
            raise ValueError("not a vocabulary of the lower-casing word-end kind")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.transducer = Transducer(model["vocab"], pairs)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in {**model["vocab"], **self.special}.items()}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # Fixed value: the split pattern of this vocabulary.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").finditer
        self.bytes_to_chars = {b: c for c, b in byte_alphabet().items()}
        self.kept: dict[str, bytes] = {}
        self.path, self.library = path, None

    def words_by_library(self, text: str) -> list[str]:
        """Words in byte-level symbols, cut by the library itself: for texts with code points that
        one of the two Unicode versions involved may not know."""
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        # Code point by code point, as the vocabulary's lower-casing does: no final-sigma rule.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def symbols(self, word: str) -> Iterable[str]:
        if word.isascii() and word.isprintable():
            return word  # these stand for themselves
        return map(self.bytes_to_chars.__getitem__, word.encode("utf-8", "replace"))

    def word(self, word: str) -> bytes:
        """Ids of one word as little-endian 32-bit numbers."""
        got = self.kept.get(word)
        if got is None:
            got = np.fromiter(self.transducer.stream(self.symbols(word)), "<u4").tobytes()
            if len(word) <= KEPT_WORD:
                if len(self.kept) >= WORD_LIMIT:
                    self.kept = {}
                self.kept[word] = got
        return got

    def encode(self, text: str) -> Iterator[bytes]:
        """Blocks of ids, in order."""
        kept = self.kept.get
        for piece in self.cut_special.split(text) if "<|" in text else (text,):
            if piece in self.special:
                yield int(self.special[piece]).to_bytes(4, "little")
                continue
            if not piece.isascii() and any(unicodedata.category(c) == "Cn" for c in set(piece)):
                for w in self.words_by_library(piece):
                    yield np.fromiter(self.transducer.stream(w), "<u4").tobytes()
                continue
            for m in self.split(self.normal(piece)):
                w = m.group()
                yield kept(w) or self.word(w)


class Decoder:
    """Incremental decoding: ``feed`` blocks of ids, then ``finish``."""

    def __init__(self, text_of: dict[int, str], byte_level: bool = False):
        self.text_of, self.byte_level, self.begun = text_of, byte_level, False
        self.codec = codecs.getincrementaldecoder("utf-8")("replace")
        self.alphabet = byte_alphabet() if byte_level else {}

    def feed(self, ids: Iterable[int]) -> str:
        if self.byte_level:
            raw = b"".join(bytes(self.alphabet[c] for c in self.text_of[i]) for i in ids)
            return self.codec.decode(raw)
        text = " ".join(map(self.text_of.__getitem__, ids))
        if text and self.begun:
            text = " " + text
        self.begun = self.begun or bool(text)
        return text

    def finish(self) -> str:
        return self.codec.decode(b"", True) if self.byte_level else ""


_ENCODERS: dict[str, Encoder] = {}
IDS_PER_BLOCK = 1 << 16


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _blocks(parts: Iterator[bytes]) -> Iterator[bytes]:
    held: list[bytes] = []
    for p in parts:
        held.append(p)
        if len(held) >= IDS_PER_BLOCK:
            yield b"".join(held)
            held = []
    if held:
        yield b"".join(held)


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        n, ids_sha, text_sha = [], [], []
        for text in batch.column("text"):
            ids_hash, text_hash, count = hashlib.sha256(), hashlib.sha256(), 0
            back = Decoder(enc.text_of)
            for block in _blocks(enc.encode(text.as_py())):
                ids_hash.update(block)
                count += len(block) // 4
                text_hash.update(back.feed(np.frombuffer(block, "<u4").tolist()).encode())
            text_hash.update(back.finish().encode())
            n.append(count)
            ids_sha.append(ids_hash.hexdigest())
            text_sha.append(text_hash.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        out = [np.frombuffer(b"".join(enc.encode(t.as_py())), "<u4").astype(np.int32) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``."""
    return _input(docs).mapInArrow(lambda it: _ids(it, path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of a table with ``doc_id, ids``: blocks of ids through the state machine."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids").to_pylist():
                back, ids = Decoder(enc.text_of), ids or []
                parts = [back.feed(ids[i:i + IDS_PER_BLOCK]) for i in range(0, len(ids), IDS_PER_BLOCK)]
                texts.append("".join([*parts, back.finish()]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _input(docs).mapInArrow(lambda it: _digests(it, path), schema)
