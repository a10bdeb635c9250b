import collections
import itertools
import random
import re

import pytest

from daybook.llm import interactions
from tests.llm.conftest import DOCS, ODD_TEXTS


def failures(rows):
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                  "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                  "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows)}
        out.append({f for f, x in failed.items() if x})
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = collections.defaultdict(lambda: [0] * 7)
    shapley = collections.Counter()
    for (i, _, lang), failed in zip(rows, failures(rows)):
        part = lang or ""
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                c = out[part, order, step]
                if f in failed and not gone:
                    c[1] += 1
                    c[4] += i in good
                    c[5] += i in toxic
                    shapley[part, f] += 1
                elif f in failed:
                    c[2] += 1
                elif not gone:
                    c[0] += 1
                c[3] += failed == {f}
                gone = gone or f in failed
    for (part, order, step), c in out.items():
        c[6] = shapley[part, order[step - 1]]
    return {k: tuple(c) for k, c in out.items()}


@pytest.fixture()
def audited(spark):
    from daybook.llm.common import prepare

    def run(rows, labels):
        prepare(spark)
        docs = spark.createDataFrame([(i, t, lang, "s", None) for i, t, lang in rows], DOCS)
        for name in ("hash", "part", "bits", "n", "words", "place", "first", "_may", "good"):
            docs = docs.selectExpr("*", f"doc_id * 7 as `{name}`")
        marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "doc_id as n", "'x' as part")
        return interactions.audit(docs, marks).collect()
    return run


def check(got, rows, labels):
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == brute(rows, labels)
    assert len(got) == 600 * len({lang or "" for _, _, lang in rows})


def test_random_texts(audited):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        words = [rng.choice(["the", "THE", "Cat", "sat#", "on", "|", "mat", f"w{rng.randrange(400)}", "über"])
                 for _ in range(rng.choice([0, 3, 150, 199, 200, 201, 400]))]
        if rng.random() < 0.5:
            words = [f"word{k}" for k in range(len(words))]
        rows.append((rng.randrange(100), rng.choice([" ", "\n", "\t "]).join(words), rng.choice(["en", "de", None, ""])))
    rows += [(rng.randrange(-20, 200), t, lang) for _, t, lang in rng.choices(rows, k=60)]
    labels = [(rng.randrange(120), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(100)]
    check(audited(rows, labels), rows, labels)


def test_odd_rows(audited):
    rows = [(i, t, lang) for (i, t), lang in zip(ODD_TEXTS, itertools.cycle(["en", None, "", "x' y"]))]
    # Equal rows; one id with two texts, one of them repeated; rows without id.
    rows += [(20, "same", "en"), (20, "same", "en"), (21, "same", "de"), (21, "other", "de"), (30, "other", "en"), (None, "same", "en"), (None, None, None)]
    labels = [(1, 1, 1), (1, 0, 0), (20, 1, None), (None, 1, 1), (21, 0, 1), (77, 1, 1)]
    check(audited(rows, labels), rows, labels)


def test_copies_of_one_text(audited):
    rows = [(i, "copy of one text", "en") for i in range(300)] + [(1000, "alone", "en")]
    check(audited(rows, []), rows, [])


def test_empty(audited):
    assert audited([], []) == []
