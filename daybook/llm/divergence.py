"""Source divergence audit: how far the word use of each source is from the others of its language.

Terms of a language are the words of at least ``LEAST_DOCS`` of its documents.  A group (language,
source), and a language, gives each kept term the smoothed share ``1 + floor(SCALE * (count +
SMOOTH) / (N + SMOOTH * V))``; two are apart by the sum of the differences over all kept terms, most
of which neither of two small sources has.

Gustavson row accumulation: the counts are kept term-major, a term with its postings (group, share), in
blocks.  In a block each group walks through its own terms and scatters, through the term's postings,
into one dense accumulator with a place per peer, so pairs of postings never become rows.  Groups
without a term have a share too, their zero baseline.  With ``p`` the shares, ``z`` the baselines, the
sum over a block of ``V`` terms is

    sum over terms of g  |p_g - z_h|  +  sum over terms of h  |p_h - z_g|  +  (V - n_g - n_h) |z_g - z_h|
    + sum over common terms  (|p_g - p_h| - |p_g - z_h| - |p_h - z_g| + |z_g - z_h|)

The last line is what the scatter adds; the sums over one group's terms against another's baseline
come from sorted shares and their running sums, for all peers at once.  All arithmetic is in whole
numbers (the shares in decimals; sums of a block in 64 bits).

Scale: texts are scanned once, and tasks emit counts combined over many documents, at most
``HELD`` terms at a time.  What is shuffled is a row per (language, source, term) and task, then the
kept ones.  A block holds about ``POSTINGS`` postings, or ``PER_SOURCE`` for each source where these
are more (a term has at most one per source), so it does not grow with the corpus; a row of its result is one group's
dense accumulator, as long as the contract's result for that group.  Languages, sources and words of any share of the rows are combined before each shuffle.
The list of best terms is cut to its ranks in each task before it is shuffled.

Defined cases: null text, lang and source are empty strings, and groups like others; a group whose
documents have no terms has zero counts; a language without kept terms has the value 0 for each pair
and no term rows; a language with one source has no pairs; repeated rows and ids count each (``doc_id``
is not used); no documents: no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import Scratch, written

# The contract's term pattern and numbers.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LEAST_DOCS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TERM_RANKS = 50

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Terms that a task holds before it emits their counts.
HELD = 1 << 18
#: Postings in a block, about; with very many sources so many a source.
POSTINGS = 1 << 14
PER_SOURCE = 64

COUNT_SCHEMA = "lang string, source string, term string, n long, docs long"
PAIR_SCHEMA = "lang string, g string, h string, value long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every term, and a row with a null term for every group seen."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for text, lang, source in zip(batch.column(0).cast(pa.large_binary()), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words = TERM.findall(text.as_py().translate(_LOWER))
            size -= len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n)
            if size > HELD:
                yield from map(_counted, held.items())
                held, size = {}, 0
    yield from map(_counted, held.items())


def _counted(item: tuple) -> pa.RecordBatch:
    (lang, source), (n, docs) = item
    terms = pa.array([None, *n], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), terms,
         pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(docs.__getitem__, n)], pa.int64())],
        ["lang", "source", "term", "n", "docs"])


def counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` over all documents, with a null term per group."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return rows.mapInArrow(_count, COUNT_SCHEMA).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """The smoothed share of a term, without any rounding; 1 in a language without kept terms."""
    return F.expr(f"1 + coalesce((cast({SCALE} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(19,0))) "
                  f"div nullif(cast({total} + {SMOOTH} * {terms} as decimal(19,0)), 0), 0L)")


class Block:
    """The postings of some terms of one language, for all its sources."""

    def __init__(self, rows: pa.Table):
        """``rows``: source, term, p; with a null term the source's baseline."""
        is_term = pc.is_valid(rows.column("term"))
        own, post = rows.filter(pc.invert(is_term)).sort_by("source"), rows.filter(is_term)
        self.sources = own.column("source").combine_chunks()
        self.zero = own.column("p").to_numpy()
        group = pc.index_in(post.column("source"), self.sources).to_numpy()
        term = post.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        # Term-major; the postings of a term by group, so a group's later peers follow its own posting.
        order = np.lexsort((group, term))
        self.group, term, self.p = group[order], term[order], post.column("p").to_numpy()[order]
        self.n_terms = int(term[-1]) + 1 if len(term) else 0
        self.ends = np.searchsorted(term, term, side="right")
        # Row-major: a group's own postings.
        self.rows = np.argsort(self.group, kind="stable")
        self.starts = np.searchsorted(self.group[self.rows], np.arange(len(self.zero) + 1))
        self.sizes = np.diff(self.starts)

    def row(self, g: int) -> np.ndarray:
        """For every peer, what group ``g`` adds to their pair: its terms against the peer's baseline,
        and for peers after it also the correction of common terms and the terms of neither."""
        mine = self.rows[self.starts[g]:self.starts[g + 1]]
        shares = np.sort(self.p[mine])
        sums = np.append(0, np.cumsum(shares))
        below = np.searchsorted(shares, self.zero)
        out = self.zero * below - sums[below] + (sums[-1] - sums[below]) - self.zero * (len(shares) - below)
        lengths = self.ends[mine] - mine - 1
        at = np.arange(lengths.sum()) + np.repeat(mine + 1 - (np.cumsum(lengths) - lengths), lengths)
        pg, ph, h = np.repeat(self.p[mine], lengths), self.p[at], self.group[at]
        z, zg = self.zero[h], self.zero[g]
        np.add.at(out, h, np.abs(pg - ph) - np.abs(pg - z) - np.abs(ph - zg) + np.abs(zg - z))
        later = slice(g + 1, None)
        out[later] += (self.n_terms - self.sizes[g] - self.sizes[later]) * np.abs(zg - self.zero[later])
        return out


def _block_pairs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each group of a block adds to the pairs with its peers, a group at a time."""
    rows = pa.Table.from_batches(batches)
    block = Block(rows.select(["source", "term", "p"]))
    everyone = np.arange(len(block.zero))
    for g in everyone:
        peers = np.delete(everyone, g)
        if len(peers):
            yield pa.RecordBatch.from_arrays(
                [pa.array([key[0].as_py()] * len(peers), pa.string()), block.sources.take(pa.array(np.minimum(g, peers))),
                 block.sources.take(pa.array(np.maximum(g, peers))), pa.array(block.row(g)[peers])], ["lang", "g", "h", "value"])


class Shares:
    """Written tables of one audit: ``groups`` (lang, source, total, lang_total, terms, blocks, base)
    and ``postings`` (lang, source, term, p, q) of the kept terms."""

    def __init__(self, docs: DataFrame, least_docs: int):
        found = written(counts(docs), "term-counts")
        seen = found.filter("term is null").select("lang", "source")
        terms = (found.filter("term is not null").groupBy("lang", "term")
                 .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.count("*").alias("postings"))
                 .filter(F.col("docs") >= least_docs).drop("docs"))
        terms = written(terms, "kept-terms")
        kept = written(found.select("lang", "source", "term", "n").join(terms.drop("postings"), ["lang", "term"]), "kept-counts")
        langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"), F.sum("postings").alias("postings"))
        totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        zero = F.lit(0).cast("long")
        sources = seen.groupBy("lang").agg(F.count("*").alias("sources"))
        langs = (sources.join(langs, "lang", "left").withColumns({c: F.coalesce(c, zero) for c in ("terms", "lang_total", "postings")})
                 .withColumn("blocks", F.floor(F.col("postings") / F.greatest(F.lit(POSTINGS), PER_SOURCE * F.col("sources"))) + 1))
        groups = (seen.join(totals, ["lang", "source"], "left").join(langs.drop("sources", "postings"), "lang")
                  .withColumn("total", F.coalesce("total", zero)).withColumn("base", share("0", "total", "terms")))
        self.groups = written(groups, "groups")
        shared = kept.join(self.groups, ["lang", "source"])
        self.postings = written(shared.select(
            "lang", "source", "term", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"),
            F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")), "postings")

    def pairs(self) -> DataFrame:
        """``lang, source, item, value`` for every two sources of a language, both ways."""
        own = self.groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                                 "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
        laid = own.unionByName(self.postings.drop("q"))
        sums = laid.groupBy("lang", "block").applyInArrow(_block_pairs, PAIR_SCHEMA)
        both = sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value")).select("lang", "value", F.explode(F.array(
            F.struct(F.col("g").alias("source"), F.col("h").alias("item")), F.struct(F.col("h").alias("source"), F.col("g").alias("item")))).alias("x"))
        return both.select("lang", "x.source", "x.item", "value")

    def terms(self) -> DataFrame:
        """``lang, source, item, value`` of the terms that a source uses more than its language."""
        return self.postings.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of the language
    by distance, part ``term`` the terms that set the source apart."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    with Scratch(docs.sparkSession) as scratch:
        shares = Shares(docs, least_docs)
        pairs = shares.pairs().withColumn("rank", F.row_number().over(order))
        terms = shares.terms().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= term_ranks)
        out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in (("pair", pairs), ("term", terms))]
        return scratch.keep(out[0].unionByName(out[1]), "divergence")
