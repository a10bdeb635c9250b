"""The pipeline against a brute-force version of its stages, on the smallest tables and odd rows."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from daybook.llm import language
from daybook.llm.common import DOC_COLUMNS, prepare
from tests.llm import test_lines, test_minhash, test_packing, test_secret_scan
from tests.llm.conftest import DOCS, ODD_TEXTS

SF = "/root/testdata/sf0.001"


def language_brute(rows):
    """{doc_id: text} of the documents whose language is told with a posterior of a half or more."""
    def columns(t):
        codes = np.array([ord(c) for c in t.lower()], np.uint32)
        return np.concatenate([np.zeros(0, np.int32), *language._columns(codes)])
    train = [r for r in rows if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    langs = sorted({r.lang for r in train})
    counts = np.full((len(langs), language.BUCKETS), language.ALPHA)
    for r in train:
        np.add.at(counts[langs.index(r.lang)], columns(r.text), 1)
    logp = np.log(counts / counts.sum(axis=1, keepdims=True))
    prior = np.log([sum(r.lang == x for r in train) / len(train) for x in langs])
    kept = {}
    for r in rows:
        if r.text is not None and any(c.isalpha() for c in r.text):
            score = prior + logp[:, columns(r.text)].sum(axis=1)
            if 1 / np.exp(score - score.max()).sum() >= 0.5:
                kept[r.doc_id] = r.text
    return kept


def lines_brute(texts):
    keep = test_lines.brute(texts)
    out = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if keep.get((i, k), (i, k)) == (i, k)) for i, t in texts.items()}
    return {i: t for i, t in out.items() if t.strip()}


def near_brute(texts):
    _, label = test_minhash.brute(texts, 5)
    return {i: t for i, t in texts.items() if label[i] == i}


def secrets_brute(texts):
    out = {}
    for i, t in texts.items():
        parts, at = [], 0
        for s, _, e in test_secret_scan.base(t):
            if s >= at:
                parts += [t[at:s], "[SECRET]"]
            at = max(at, e)
        out[i] = "".join(parts) + t[at:]
    return out


def test_against_brute_force(spark):
    prepare(spark)
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = secrets_brute(near_brute(lines_brute(language_brute(rows))))
    pieces = corpus_pipeline.run(spark, SF).collect()
    test_packing.check(pieces, texts)
    assert 0 < len(texts) < len(rows)


def test_stages_have_the_right_order_and_columns(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_duplicates", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == DOC_COLUMNS


@pytest.mark.parametrize("rows", [[], ODD_TEXTS[:-1], [(None, "some words here"), (3, "some words here"), (3, "some words here")]])
def test_stages_take_odd_rows(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS).selectExpr("*", "doc_id AS id", "1 AS label", "2 AS key")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).collect()
        assert out == [] if not rows else len(out) > 0, name
