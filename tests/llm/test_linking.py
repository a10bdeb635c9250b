import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import components as components_
from daybook.llm import linking, shingles
from daybook.llm.common import Sieve, packed, split_by
from daybook.llm.components import components


def closure(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("edges", [
    [],
    [(i, i + 1) for i in range(200)],  # a chain
    [(0, i) for i in range(1, 100)] + [(i, 1000 - i) for i in range(1, 100)],
    [(5, 5), (7, 5), (7, 5), (9, 8)],
])
def test_components(spark, edges):
    random.Random(3).shuffle(edges)
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == closure(nodes, edges)


def _facts(batches):
    for batch in batches:
        rows = [np.unique(shingles.mix(np.array(x, np.int64).view(np.uint64))) for x in batch.column("items").to_pylist()]
        facts = np.array([[len(x), *linking.parities(x, np.zeros(len(x), np.int64), 1)[0]] for x in rows], np.int64).reshape(-1, len(linking.FACTS))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(np.ascontiguousarray(f)) for f in facts.T]], ["id", *linking.FACTS])


def facts_of(sets):
    return sets.mapInArrow(_facts, ", ".join(f"{c} long" for c in ("id", *linking.FACTS)))


def labels_of(sets, keys, similar=linking.similar_sets):
    """Labels from (id, items) and (id, key)."""
    facts = facts_of(sets)
    found = linking.link(keys.join(facts.select("id", "size"), "id"), lambda ids: facts.join(ids, "id"),
                         lambda ids: sets.join(ids, "id"), lambda both: similar(both, 80), 80)
    return {r.id: r.label for r in found.collect()}


def linked(spark, rows, ids, width=20):
    """The set of i is the numbers i .. i + width - 1: at 80 per cent, ids up to two apart are linked."""
    sets = spark.createDataFrame([(i, list(range(i, i + width))) for i in ids], "id long, items array<long>")
    labels = labels_of(sets, spark.createDataFrame(rows, "id long, key long"))
    edges = [(a, b) for a in ids for b in (a + 1, a + 2) if b in set(ids)]
    assert {i: labels.get(i, i) for i in ids} == closure(ids, edges)


@pytest.mark.parametrize("shuffle", ["3", "40"])
@pytest.mark.parametrize("hot", [True, False])
def test_link_finds_every_link_between_bucket_mates(spark, shuffle, hot):
    """Buckets hold fifty neighbouring ids; a hot key holds all ids, most of them unlike."""
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    ids = sorted(random.Random(5).sample(range(2000), 700))
    rows = [(i, k) for i in ids for k in ((999_999,) if hot else (i // 50, 1000 + (i + 25) // 50))] + [(i, -i) for i in ids]
    try:
        linked(spark, rows, ids)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("crowd", [1, 3])
def test_salted_buckets(spark, monkeypatch, crowd):
    monkeypatch.setattr(linking, "CROWD", crowd)
    monkeypatch.setattr(linking, "FIRST", 4)
    ids = sorted(random.Random(6).sample(range(60), 32))
    linked(spark, [(i, 1) for i in ids], ids)


def test_crowded_bucket_with_copies_outliers_and_a_shared_passage(spark, monkeypatch):
    """All sets share a passage and one key; links exist within groups of edited copies only."""
    monkeypatch.setattr(linking, "CROWD", 20)
    monkeypatch.setattr(linking, "FIRST", 8)
    rng = random.Random(7)
    passage = list(range(1000, 1030))
    sets = {}
    for g in range(25):
        base = passage + [rng.randrange(10 ** 6) for _ in range(rng.randint(5, 60))]
        for _ in range(rng.choice([1, 2, 12])):
            edits = rng.randint(0, len(base) // 6)
            sets[len(sets)] = sorted({*base[edits:], *(rng.randrange(10 ** 4, 10 ** 4 + 300) for _ in range(edits))})
    df = spark.createDataFrame([(i, s) for i, s in sets.items()], "id long, items array<long>")
    labels = labels_of(df, df.select("id", F.lit(1).cast("long").alias("key")))
    edges = [(i, j) for i in sets for j in range(i)
             if 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]})]
    assert edges and {i: labels.get(i, i) for i in sets} == closure(sets, edges)


def test_group_of_copies_forms_no_square_of_pairs(spark, monkeypatch):
    formed = []

    def counted(both, percent):
        formed.append(both.count())
        return linking.similar_sets(both, percent)
    sets = spark.range(3000).select("id", F.sequence(F.lit(1), F.lit(10)).cast("array<long>").alias("items"))
    labels = labels_of(sets, spark.createDataFrame([(i, k) for i in range(3000) for k in range(4)], "id long, key long"), counted)
    assert labels == dict.fromkeys(range(3000), 0)
    assert sum(formed) < 2 * 3000


def test_bounds_never_rule_a_link_out(spark):
    rng = random.Random(8)
    sets = []
    for _ in range(150):
        base = [rng.randrange(10 ** 12) for _ in range(rng.choice([1, 5, 40, 700, 4000]))]
        sets += [sorted(base), sorted({*base[rng.randint(0, len(base) // 6):], *(rng.randrange(10 ** 12) for _ in range(len(base) // 15))})]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, items array<long>")
    bounds = facts_of(df)
    pairs = bounds.alias("x").join(bounds.alias("y"), F.expr("x.id < y.id"))
    pairs = pairs.withColumn("may", linking._may_be_near(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"), 80))
    may = {(r[0], r[1]): r.may for r in pairs.select("x.id", "y.id", "may").collect()}
    links = [(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if 100 * len({*a} & {*b}) >= 80 * len({*a} | {*b})]
    assert len(links) > 50 and all(may[p] for p in links)
    assert sum(may.values()) < 0.1 * len(may)


def test_split_by_keeps_every_member(spark):
    df = packed(spark.range(-5, 20_000).selectExpr("id as doc_id", "id as _may"), "doc_id")
    keys = spark.range(0, 20_000, 17).selectExpr("id as doc_id")
    may, stay = split_by(df, keys, "doc_id")
    assert may.join(keys, "doc_id", "left_semi").count() == keys.count()
    assert may.count() + stay.count() == 20_005 and stay.count() > 10_000
    assert split_by(df, keys.limit(0), "doc_id")[0].count() == 0
    assert Sieve.BITS // 8 <= 1 << 20


def test_first_id_of_a_key_that_goes_on_in_the_next_task(spark, monkeypatch):
    """A key is dealt as {0} | {1, 2, 3}: 1, the centre there, is like 2 and 3, and 0 is like 2 alone."""
    starts = {0: 0, 1: 4, 2: 2, 3: 5}
    df = spark.createDataFrame([(i, list(range(s, s + 20))) for i, s in starts.items()], "id long, items array<long>")
    rows = df.select("id", F.lit(1).cast("long").alias("key"))
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *_: self.repartitionById(2, F.expr("int(id > 0)")))
    labels = labels_of(df, rows)
    assert labels == dict.fromkeys(starts, 0)


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_runs_leave_out_only_rows_that_no_mate_comes_near(batch):
    """Every pair near in size shares a bucket afterwards, and what has more than two rows is open."""
    rng = random.Random(batch)
    rows = sorted({(rng.randrange(40), rng.randrange(1000)): rng.choice([1, 10, 11, 12, 100, 120, 5000]) for _ in range(150)}.items())
    rows = [(k, i, s) for (k, i), s in rows]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[x:x + batch])], ["key", "id", "size"]) for x in range(0, len(rows), batch)]
    got = [r for b in linking._runs(iter(batches), 80) for r in b.to_pylist() if not r["edge"]]
    found = {}
    for r in got:
        found.setdefault(r["key"], {})[r["id"]] = r
    assert len(got) == sum(map(len, found.values()))
    for k in {k for k, _, _ in rows}:
        mates = [(i, s) for key, i, s in rows if key == k]
        near = {i for i, s in mates for j, t in mates if i != j and 5 * min(s, t) >= 4 * max(s, t)}
        mine = found.get(k, {})
        assert near <= set(mine)
        assert all(r["centre"] == min(mine) and r["size"] == dict(mates)[i] and r["centre_size"] == dict(mates)[r["centre"]] for i, r in mine.items())
        assert len(mine) < 3 or all(r["n"] in (0, len(mine)) for r in mine.values())


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_shared_keys_are_found_in_packed_entries(rows):
    """Keys that several ids have, in one batch or in several, come with all their ids; others don't come."""
    rng = random.Random(rows)
    ids = [*range(40), *range(1 << 33, (1 << 33) + 30), 1 << 40]
    size = {i: rng.choice([1, 300, 65_535, 70_000]) for i in ids}
    few = [rng.getrandbits(64) for _ in range(12)]
    keys = {i: [5, rng.choice(few), rng.getrandbits(64)] for i in ids}
    table = np.array([keys[i] for i in ids], np.uint64)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([size[i] for i in ids]), linking.packed_keys(table, np.ones(len(ids), bool))], ["id", "size", "keys"])
    batches = [batch.slice(x, rows) for x in range(0, len(batch), rows)]
    packed_ = pa.Table.from_batches(linking._packed_entries(iter(batches), 3)).sort_by("dealt").combine_chunks()
    got = [tuple(r.values()) for b in linking._shared(iter(packed_.to_batches(max_chunksize=3))) for r in b.to_pylist()]
    held = {}
    for i in ids:
        for k in keys[i]:
            held.setdefault(k & ((1 << (linking.SLOT_BITS + linking.REST_BITS)) - 1), []).append(i)
    assert sorted(got) == sorted((k, i, min(size[i], linking.PACK - 1)) for k, mine in held.items() if len(mine) > 1 for i in mine)


def test_packed_keys_leave_out_other_rows():
    some = np.array([True, False, True])
    got = linking.packed_keys(np.arange(6, dtype=np.uint64).reshape(3, 2), some).to_pylist()
    assert [len(x) for x in got] == [2 * linking.KEY_BYTES, 0, 2 * linking.KEY_BYTES] and got[2][0] == 4


@pytest.mark.parametrize("block", [1, 50, 10_000])
def test_links_of_a_task_become_stars(monkeypatch, block):
    monkeypatch.setattr(components_, "BLOCK", block)
    rng = random.Random(block)
    links = [(rng.randrange(1, 400), 0) for _ in range(5)] + [(i, i - 1) for i in range(500, 700)] + [(b, a) for a, b in ((rng.randrange(300), rng.randrange(300, 500)) for _ in range(150))]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links[x:x + 40])], ["u", "v"]) for x in range(0, len(links), 40)]
    stars = [(r["u"], r["v"]) for b in components_._own_stars(iter(batches)) for r in b.to_pylist()]
    nodes = {x for link in links for x in link}
    want = closure(nodes, links)
    assert closure(nodes, stars) == want and len(stars) <= len(links) and all(u > v for u, v in stars)
    assert block < 10_000 or dict(stars) == {u: v for u, v in want.items() if u != v}
