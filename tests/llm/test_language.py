import zlib

import numpy as np

from daybook.llm import language
from tests.llm.conftest import DOCS, ODD_TEXTS


def brute_scores(train, text):
    """Per-language log posterior by plain counting; ``train``: (text, lang) pairs."""
    langs = sorted({lang for _, lang in train})

    def columns(t):
        codes = np.array([ord(c) for c in t.lower()], np.uint32)
        return np.concatenate([np.zeros(0, np.int32), *language._columns(codes)])
    counts = {x: np.zeros(language.BUCKETS) for x in langs}
    for t, x in train:
        np.add.at(counts[x], columns(t), 1)
    out = {}
    for x in langs:
        p = (counts[x] + language.ALPHA) / (counts[x] + language.ALPHA).sum()
        out[x] = np.log(sum(lang == x for _, lang in train) / len(train)) + np.log(p)[columns(text)].sum()
    return out


def rows_of(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_held_out_accuracy(spark):
    from daybook.llm.registered import QUERIES
    got = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id").lang
    fold = got[got.held_out]
    assert set(fold.index) == {i for i in got.index if zlib.crc32(str(i).encode()) % 4 == 2}
    assert (fold.lang_pred == lang[fold.index]).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_against_plain_counting(spark):
    docs = rows_of(spark).collect()
    train = [(r.text, r.lang) for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang and r.text is not None]
    model = language.train(spark.createDataFrame(train, "text string, lang string"))
    some = sorted(docs, key=lambda r: r.doc_id)[:12]
    out = {r.doc_id: r for r in language.predict(spark.createDataFrame(
        [(r.doc_id, r.text) for r in some], "doc_id long, text string"), model).collect()}
    for r in some:
        scores = brute_scores(train, r.text)
        assert out[r.doc_id].lang_pred == max(sorted(scores), key=scores.get)


def test_prediction_ignores_other_columns(spark, make_docs):
    model = language.train(rows_of(spark))
    a = language.predict(make_docs([(1, "und der die das ist nicht"), (2, "x")]), model).collect()
    b = language.predict(make_docs([(7, "und der die das ist nicht"), (8, "x")], extra=False), model).collect()
    assert [(r.lang_pred, r.lang_score) for r in a] == [(r.lang_pred, r.lang_score) for r in b]


def test_odd_texts(spark, make_docs):
    model = language.train(rows_of(spark))
    rows = language.predict(make_docs([*ODD_TEXTS, (70, "12 345 !?"), (71, "١٢٣")]), model).collect()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {1, 2, 3, 70, 71} and all(r.lang_score == 0 for r in rows if r.lang_pred == "und")
    assert len(rows) == len(ODD_TEXTS) + 2


def test_long_text_in_blocks_equals_whole(spark, monkeypatch):
    model = language.train(rows_of(spark))
    text = " ".join(r.text for r in rows_of(spark).limit(5).collect() if r.text)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = language.predict(df, model).first()
    batches = df.toArrow().to_batches()
    monkeypatch.setattr(language, "BLOCK", 37)

    class Shared:
        value = model
    cut = next(language._score(iter(batches), Shared))
    assert cut.column("lang_pred")[0].as_py() == whole.lang_pred


def test_nothing_to_learn(spark, make_docs):
    assert [r.lang_pred for r in language.identify(spark.createDataFrame([(1, "abc", None, "s", 3)], DOCS)).collect()] == ["und"]
    assert language.identify(make_docs([])).collect() == []
