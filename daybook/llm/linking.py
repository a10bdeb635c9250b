"""Linking by shared keys: from rows (id, key, size) to components of confirmed links.

1. Rows are sorted by (key, id) over the cluster, so even the rows of one key are dealt to several
   tasks, and one pass over the sorted rows gives each its bucket's *centre*, the first id of the
   key in that task; where a key goes on in the next task, the centres are compared as well.
2. Every id is compared with the centres of its buckets, at most one a key, and components are
   formed: a group of copies costs a few comparisons a member, not their square.
3. A bucket whose members are in several components may still hide a link between two members that
   are not its centre.  In such *open* buckets the members outside the largest component are compared
   with the members of other components.  Where a bucket has several centres, none was compared with
   all members, so they are among these.  (Members that no other member of the bucket comes near in
   size have left it by then, and buckets of two have no such link.)  In large buckets they are compared
   with some ``FIRST`` members first, which brings most into the component they belong to, and with all
   others after that only if they are in none.  Both sides of a large bucket are dealt to several tasks by a
   salt, and pairs are looked at as they are formed: only those that may be near are ever kept.

Before sets are fetched, two exact bounds rule most unlike pairs out: sizes, and parity bitmaps, which
are made for members of buckets.  Of
``64 * LONGS`` hash slots each set keeps the parity of its items; the slots in which two sets differ
are no more than the items in which they differ.

So every pair of bucket mates ends in one component, has been compared, or cannot have the similarity:
no link between bucket mates is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import shingles
from daybook.llm.common import Scratch, batches_of, split_by, written
from daybook.llm.components import components

#: Parity bitmaps of 1,024 slots: they tell unlike sets of up to some 2,000 items apart.
LONGS = 16
SLOTS = 64 * LONGS
PARITY = [f"parity{k}" for k in range(LONGS)]
FACTS = ["size", *PARITY]
#: Slots that keys are dealt to (their first bits), and bits of the rest that are compared.
SLOT_BITS = 10
REST_BITS = 32
KEY_BYTES = 6
#: Ids and sizes of packed entries are 16 bits; a larger size counts as the largest.
PACK = 1 << 16
#: Seeds of an open bucket that one task compares with the bucket's members, about.
CROWD = 4096
#: Members of a large bucket that its seeds are compared with first.
FIRST = 64
MEMBER_SCHEMA = "key long, id long, size long, centre long, centre_size long, n long, edge boolean"

Step = Callable[[DataFrame], DataFrame]


def parities(items: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """``owners x LONGS`` bitmaps of the scrambled items (each once per owner, owners ascending)."""
    out = np.empty((owners, LONGS), np.int64)
    slot = (items & np.uint64(SLOTS - 1)).astype(np.int64) + owner * SLOTS
    ends = np.searchsorted(owner, np.append(np.arange(0, owners, 64), owners))  # 64 owners fit the caches
    for k, (at, to) in enumerate(zip(ends, ends[1:])):
        n = min(64, owners - 64 * k)
        odd = np.bincount(slot[at:to] - 64 * k * SLOTS, minlength=n * SLOTS).astype(np.uint8) & 1
        out[64 * k:64 * k + n] = np.packbits(odd).view(np.int64).reshape(n, LONGS)
    return out


def packed_keys(keys: np.ndarray, some: np.ndarray) -> pa.Array:
    """The first ``KEY_BYTES`` bytes of all keys of a row, one after another; nothing for rows not in ``some``."""
    data = np.ascontiguousarray(keys[some]).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    offsets = np.append(0, np.cumsum(np.where(some, keys.shape[1] * KEY_BYTES, 0))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _packed_entries(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Entries of eight bytes (rest of the key, id less ``base``, size), a row for each ``slot`` that the
    keys of a run of ids have.  Of keys that several of these ids have, all entries go to rows that are
    ``sure``, dealt anywhere, and one of size 0 stands for them at the slot."""
    spread = 0
    for batch in batches:
        ids = batch.column("id").to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(ids) != 1) + 1).tolist(), len(ids)]
        for at, to in ((x, min(x + PACK, e)) for b, e in zip(ends, ends[1:]) for x in range(b, e, PACK)):
            part = batch.slice(at, to - at)
            raw = np.zeros((len(part) * keys, 8), np.uint8)
            raw[:, :KEY_BYTES] = shingles.text_bytes(part.column("keys"))[0].reshape(-1, KEY_BYTES)
            key = raw.view(np.uint64).ravel()
            key &= np.uint64((1 << (SLOT_BITS + REST_BITS)) - 1)
            owner = np.repeat(np.arange(len(part), dtype=np.uint64), keys)
            size = np.repeat(np.minimum(part.column("size").to_numpy(), PACK - 1).astype(np.uint64), keys)
            order = np.argsort(key)
            key = key[order]
            low = (owner << np.uint64(16) | size)[order]
            lead = np.append(True, key[1:] != key[:-1])
            alone = lead & np.append(lead[1:], True)
            entry = (key << np.uint64(32)) | low
            stands = lead & ~alone
            entry_of = np.where(stands, key << np.uint64(32), entry)
            spread += 1
            for chosen, entries, sure in ((lead, entry_of, False), (~alone, entry, True)):
                slot = (key[chosen] >> np.uint64(REST_BITS)).astype(np.int64)
                if not len(slot):
                    continue
                starts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
                offsets = (8 * np.append(starts, len(slot))).astype(np.int32)
                blob = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(entries[chosen])])
                slot = slot[starts]
                dealt = (slot + spread * 31 + int(ids[at] % 1021)) % (1 << SLOT_BITS) + (1 << SLOT_BITS) if sure else slot
                yield pa.RecordBatch.from_arrays([pa.array(dealt), pa.array(slot), pa.array(np.full(len(slot), ids[at], np.int64)), blob],
                                                 ["dealt", "slot", "base", "entries"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows of entries sorted by ``dealt``, (key, id, size) of those whose key others have as well."""
    rest = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))

    def chosen(dealt, slot, base, entry):
        key = (slot << REST_BITS) | (entry >> np.uint64(32)).astype(np.int64)
        sure = dealt >= 1 << SLOT_BITS
        order = np.flatnonzero(~sure)
        order = order[np.argsort(key[order])]
        same = key[order[1:]] == key[order[:-1]]
        some = order[np.append(False, same)[: len(order)] | np.append(same, False)[: len(order)]]
        some = np.append(some, np.flatnonzero(sure))
        size = (entry[some] & np.uint64(PACK - 1)).astype(np.int64)
        some, size = some[size > 0], size[size > 0]
        id_ = base[some] + (entry[some] >> np.uint64(16) & np.uint64(PACK - 1)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(id_), pa.array(size)], ["key", "id", "size"])

    for batch in batches:
        if not len(batch):
            continue
        raw, offsets = shingles.text_bytes(batch.column("entries"))
        counts = np.diff(offsets) // 8
        longs = [np.repeat(batch.column(c).to_numpy(), counts) for c in ("dealt", "slot", "base")]
        now = [np.append(r, x) for r, x in zip(rest, [*longs, np.frombuffer(raw.tobytes(), np.uint64)])]
        done = int(np.searchsorted(now[0], now[0][-1]))  # the last slot may go on
        yield chosen(*[x[:done] for x in now])
        rest = tuple(x[done:] for x in now)
    yield chosen(*rest)


def shared_keys(rows: DataFrame, keys: int) -> DataFrame:
    """(key, id, size) of the keys that several rows (id, size, ``packed_keys``) have, and of few others.  Most
    keys are had once: they are shuffled as packed arrays, eight bytes each, and sorted by no row."""
    rows = rows.select("id", "size", "keys")
    with batches_of(rows.sparkSession, 50_000):
        entries = rows.mapInArrow(lambda it: _packed_entries(it, keys), "dealt long, slot long, base long, entries binary")
        entries = entries.repartition("dealt").sortWithinPartitions("dealt")
        return written(entries.mapInArrow(_shared, "key long, id long, size long"), "shared-keys")


def _with_partner(run: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have another one near their size in their run: if any is, a neighbour by size is."""
    order = np.lexsort((size, run))
    run, size = run[order], size[order]
    near = (run[1:] == run[:-1]) & (100 * size[:-1] >= percent * size[1:])
    out = np.zeros(len(order), bool)
    out[order] = np.append(near, False) | np.append(False, near)
    return out


def _runs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Members of every key that has two or more rows in this task, with the key's first id here and
    its size, and the number of them (0: unknown); and, marked as edge, the first ids of the task's
    first and last key.  Of runs that lie within a batch, rows without a partner in size are left out."""
    held = None  # the run that reaches the end of the rows so far: key, centre, its size, rows
    first = None

    def out(key, id_, size, centre, centre_size, n, edge):
        longs = [pa.array(np.asarray(x, np.int64)) for x in (key, id_, size, centre, centre_size, n)]
        return pa.RecordBatch.from_arrays([*longs, pa.array([edge] * len(key), pa.bool_())],
                                          ["key", "id", "size", "centre", "centre_size", "n", "edge"])

    for batch in batches:
        key, id_, size = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(key):
            continue
        starts = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1)
        lengths = np.diff(np.append(starts, len(key)))
        goes_on = held is not None and held[0] == key[0]
        rows = lengths[-1] + (held[3] if goes_on and len(lengths) == 1 else 0)
        if goes_on and held[3] == 1:
            yield out(*[[x] for x in (*held[:3], held[1], held[2], 0)], False)
        if first is None:
            first = (key[0], id_[0], size[0])
        # Runs of several rows that neither come from the batch before nor may go on in the next.
        inner = lengths > 1
        inner[-1] = False
        inner[0] &= not goes_on
        run = np.repeat(np.arange(len(lengths)), lengths)
        some = np.flatnonzero(inner[run])
        some = some[_with_partner(run[some], size[some], percent)]
        if len(some):
            heads = np.append(0, np.flatnonzero(np.diff(run[some])) + 1)
            number = np.diff(np.append(heads, len(some)))
            central = np.repeat(some[heads], number)
            yield out(key[some], id_[some], size[some], id_[central], size[central], np.repeat(number, number), False)
        # The others, whole.
        ends = [(0, held[1], held[2])] if goes_on else []
        if not (goes_on and len(lengths) == 1):
            ends.append((len(lengths) - 1, id_[starts[-1]], size[starts[-1]]))
        for r, centre, centre_size in ends:
            n = lengths[r]
            if n > 1 or (goes_on and r == 0):
                at = slice(starts[r], starts[r] + n)
                yield out(key[at], id_[at], size[at], [centre] * n, [centre_size] * n, [0] * n, False)
        held = (key[-1], *ends[-1][1:], rows)
    if first is not None:
        k, i, s = zip(*([first] if first[0] == held[0] else [first, held[:3]]))
        yield out(k, i, s, i, s, [0] * len(k), True)


def bucket_members(rows: DataFrame, percent: int) -> DataFrame:
    """``rows``: (id, key, size).  (key, id, size, centre, centre_size, n) of all buckets of two or more."""
    laid = rows.select("key", "id", "size").repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    with batches_of(rows.sparkSession, 50_000):
        found = written(laid.mapInArrow(lambda it: _runs(it, percent), MEMBER_SCHEMA), "runs")
    inner, edges = found.filter(~F.col("edge")).drop("edge"), found.filter("edge").select("key", "id", "size")
    # Two edge rows a task: keys that go on from one task to the next.
    heads = edges.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("n")).filter("n > 1").select("key", "centre")
    sizes = edges.select("key", F.col("id").alias("centre"), F.col("size").alias("centre_size"))
    across = edges.join(heads, "key").join(sizes, ["key", "centre"]).withColumn("n", F.lit(0).cast("long"))
    return inner.unionByName(across.select(*inner.columns))


def _sizes_near(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _may_be_near(a: Callable[[str], Column], b: Callable[[str], Column], percent: int) -> Column:
    """False only if sizes or parities rule the similarity out: sets that differ in ``d`` items have
    ``(|a| + |b| - d) / (|a| + |b| + d)``.  ``a`` and ``b`` give the columns of the two sides."""
    both = a("size") + b("size")
    apart = sum((F.bit_count(a(p).bitwiseXOR(b(p))) for p in PARITY), F.lit(0))
    return _sizes_near(a("size"), b("size"), percent) & (100 * (both - apart) >= percent * (both + apart))


def _labelled(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _star_pairs(members: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of an id and a centre that may be near."""
    near = (members.filter((F.col("id") != F.col("centre")) & _sizes_near(F.col("size"), F.col("centre_size"), percent))
            .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
    x, y = (facts.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in FACTS]) for side in "ab")
    may = _may_be_near(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"), percent)
    return near.join(x, "a").join(y, "b").filter(may).select("a", "b")


def _open_pairs(members: DataFrame, labels: DataFrame, facts: DataFrame, percent: int, first: int | None = None) -> DataFrame:
    """Pairs (a, b) of different components in buckets of three or more that may be near and were not
    compared as member and centre; with ``first``, pairs of about so many members in larger buckets only."""
    least = 2 if first is None else first
    labelled = _labelled(members.filter(f"n > {least} or n = 0").select("key", "id", "centre"), labels)
    share = labelled.groupBy("key", "label").agg(F.count("*").alias("n"), F.min("centre").alias("low"), F.max("centre").alias("high"))
    several = (share.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("labels"),
                                        F.max_by("label", "n").alias("main"), (F.min("low") != F.max("high")).alias("cut"))
               .filter(f"labels > 1 and n > {least}").withColumn("salts", F.floor(F.col("n") / CROWD) + 1).drop("labels"))
    crowd = labelled.join(several, "key")
    if first is not None:  # few are in large buckets
        crowd = written(crowd, "crowd")
        facts, _ = split_by(facts, crowd.select("id").distinct(), "id")
    crowd = written(crowd.join(facts, "id"), "open")
    seeds = crowd.filter("label <> main and (id <> centre or cut)").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    mates = crowd if first is None else crowd.filter(F.pmod(F.xxhash64("id", "key"), F.floor(F.col("n") / first)) == 0)
    mates = mates.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    s, m = seeds.alias("s"), mates.alias("m")
    return (s.join(m, [F.col("s.key") == F.col("m.key"), F.col("s.salt") == F.col("m.salt")])
            .filter("s.label <> m.label and (s.cut or s.centre <> m.id)")
            .filter(_may_be_near(lambda c: F.col(f"s.{c}"), lambda c: F.col(f"m.{c}"), percent))
            .select(F.least("s.id", "m.id").alias("a"), F.greatest("s.id", "m.id").alias("b")).distinct())


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after ``links`` (a, b) have been added: only the components that they join are looked at."""
    for side in "ab":
        own = labels.select(F.col("id").alias(side), "label")
        links = links.join(own, side, "left").withColumn(side, F.coalesce("label", side)).drop("label")
    joined = components(links).select(F.col("id").alias("label"), F.col("label").alias("least"))
    old = labels.join(joined, "label", "left").select("id", F.coalesce("least", "label").alias("label"))
    new = joined.select(F.col("label").alias("id"), F.col("least").alias("label")).join(labels, "id", "left_anti")
    return written(old.unionByName(new), "labels")


def link(rows: DataFrame, facts_of: Step, items_of: Step, similar: Step, percent: int) -> DataFrame:
    """(id, label) of every linked id.  Of a table of ids ``facts_of`` gives (id, ``FACTS``) and ``items_of``
    (id, items), the set or what it is made from; ``similar`` gives the pairs (a, b) that have the
    similarity, of those (a, b, x, y) that it gets with the items of both."""
    spark = rows.sparkSession

    def confirm(pairs: DataFrame) -> DataFrame:
        with Scratch(spark) as brief:
            return brief.keep(similar(side_by_side(pairs, items_of(written(named(pairs), "named")))), "links")

    with Scratch(spark) as scratch:
        members = bucket_members(rows, percent)
        with Scratch(spark) as brief:
            facts = brief.keep(facts_of(written(members.select("id").distinct(), "members")), "facts")
        with Scratch(spark) as brief:
            pairs = brief.keep(_star_pairs(members, facts, percent), "star-pairs")
        labels = components(confirm(pairs))
        for first in (FIRST, None):
            with Scratch(spark) as brief:
                pairs = brief.keep(_open_pairs(members, labels, facts, percent, first), "open-pairs")
            if pairs.isEmpty():
                continue
            labels = _merged(labels, confirm(pairs))
        return scratch.keep(labels, "linked")


def named(pairs: DataFrame) -> DataFrame:
    """The ids in pairs (a, b)."""
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def side_by_side(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``a, b, x, y``: the pairs with what ``items`` (id, items) has of both."""
    return (pairs.join(items.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
            .join(items.select(F.col("id").alias("b"), F.col("items").alias("y")), "b"))


def similar_sets(both: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets x and y (arrays) have the similarity."""
    both = both.withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.filter(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")
