import zlib

import numpy as np
import pytest

from daybook.llm import quality_vote as q
from daybook.llm.common import table
from tests.conftest import SF_ORACLE
from tests.llm.conftest import ODD_TEXTS


def naive_counts(text: bytes) -> np.ndarray:
    """Terms one by one."""
    from daybook.llm import shingles

    out = np.zeros(q.WIDTH, np.int64)
    for n in q.SIZES:
        for i in range(len(text) - n + 1):
            h = text[i]
            for c in text[i + 1:i + n]:
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ c
            h = (h ^ h >> 15) * 2654435761 & 0xFFFFFFFF
            out[h >> (32 - q.COLUMNS.bit_length() + 1)] += 1
    words = [int(shingles.word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0][0]) for w in text.split()]
    for a, b in zip(words, words[1:]):
        out[q.COLUMNS + b % q.CLASSES + q.CLASSES * (a == b)] += 1
    return out


@pytest.mark.parametrize("block", [5, 16, 1 << 18])
def test_terms(monkeypatch, block):
    monkeypatch.setattr(q, "BLOCK", block)
    for text in ["", "a", "ab", "abc", "to be to be be be\n\tor not", "über Grüße ça 😀 x", " x  x ", "one two two three " * 20]:
        got = q.term_counts(text.encode())
        want = naive_counts(text.encode())
        assert (got[:q.COLUMNS] == want[:q.COLUMNS]).all()
        if block > 5:  # no word is longer than two pieces
            assert (got == want).all()


def brute_scores(model, counts):
    out = []
    for row in counts:
        x = np.log1p(row) * model.weight
        z = x @ model.space
        if not np.linalg.norm(z) > 0:
            out.append(model.labels.mean())
            continue
        cosines = model.vectors @ z / np.linalg.norm(z)
        last = sorted(cosines)[-min(q.NEIGHBOURS, len(cosines))]
        voting = [(max(c, 0) ** q.SHARPNESS, y) for c, y in zip(cosines, model.labels) if c >= last]
        total = sum(w for w, _ in voting)
        out.append(sum(w * y for w, y in voting) / total if total > 0 else model.labels.mean())
    return np.array(out)


def test_votes_against_plain_loops(spark):
    docs, labels = table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels").selectExpr("doc_id", "quality as label")
    model = q.train(docs, labels)
    assert len(model.labels) == labels.count()
    texts = [r.text for r in docs.limit(200).collect()]
    counts = np.stack([q.term_counts(t.encode()) for t in texts])
    assert np.abs(model.scores(counts) - brute_scores(model, counts)).max() < 1e-3


def test_space_is_that_of_the_singular_vectors():
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((200, 12)) * np.arange(12, 0, -1) ** 2) @ rng.standard_normal((12, 60))
    got, want = q.span(x.astype(np.float32), 5), np.linalg.svd(x, full_matrices=False)[2][:5].T
    assert np.allclose(np.abs(got.T @ want), np.eye(5), atol=1e-2)


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    got = q.classify(docs, table(spark, "/root/testdata/sf0.1", "labels").selectExpr("doc_id", "quality as label")).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p == y for _, p, y in held]) > 0.98
    worst_good = sorted(s for s, _, y in held if y == 1)[len(held) // 50]
    assert np.mean([s < worst_good for s, _, y in held if y == 0]) > 0.95


def test_held_out_labels_change_nothing(spark, make_docs):
    rows = [(i, ("good words " if i % 2 else "BAD!! $$$ ") * (i % 7 + 1) + f"n{i}") for i in range(80)]
    labels = [(i, i % 2) for i, _ in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]

    def run(marks):
        got = q.classify(make_docs(rows), spark.createDataFrame(marks, "doc_id long, label int")).collect()
        return {r.doc_id: r.score for r in got}
    assert run(labels) == run(turned)
    assert all((s >= 0.3) == bool(i % 2) for i, s in run(labels).items())


def test_odd_rows_and_sample_bound(spark, make_docs):
    docs = make_docs(ODD_TEXTS)
    marks = spark.createDataFrame([(4, 1), (4, 0), (7, 0), (8, 1), (9, 1), (None, 0), (6, 2), (5, None), (999, 0)], "doc_id long, label int")
    got = q.classify(docs, marks).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((i is None, i) for i, _ in ODD_TEXTS)
    assert all(0 <= r.score <= 1 for r in got)
    learned = [y for i, y in {4: 1, 7: 0, 8: 1, 9: 1}.items() if zlib.crc32(str(i).encode()) % 5]
    assert {round(r.score, 6) for r in got if r.doc_id in (1, 2)} == {round(float(np.mean(learned)), 6)}
    assert len(q.train(docs, marks, learned=2).labels) == 2


def test_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in q.classify(make_docs(ODD_TEXTS), none).collect()} == {0.5}
    assert q.classify(make_docs([]), none).collect() == []
