"""URL verdicts: longest-prefix rules, then an empirical-Bayes reputation of the host.

Rules decide first.  For the other pages, labelled page outcomes (``bad`` 0/1 per page) are counted
per host, registered domain and suffix, and shrunk level by level: the corpus posterior is the prior
of a suffix, the suffix's posterior that of its domains, the domain's that of its hosts (always
without the unit's own pages), each as a beta-binomial prior whose strength is estimated by moments
from the spread of the rates at that level.  A page is blocked if the *lower* bound of its host's posterior bad rate
(Wilson's score bound at ``z`` standard deviations, with the posterior's weight as number of pages; a normal
bound is too high for weights of a few pages) is above ``threshold``; a host without labels
gets the posterior of its domain, then of its suffix.  A suffix without labels keeps the corpus mean at the
weakest prior, which never blocks by itself: other suffixes say little of it.

The outcomes come from the pages themselves, ruled or not: a page is bad if its text has more than one run
of symbols (``SYMBOLS``) for every ``WORDS_A_SYMBOL`` words, the symbol-to-word ratio of published quality
filters.  A page without html or without words is unlabelled.  ``judge`` takes other labels as a table.

Only DataFrame functions.  Scale: one pass counts per host with map-side combination (a host with a
third of all pages is one partial row per task); the host table is written once, and all further levels
work on it.  The host table is joined back to the pages, an equi-join that adaptive execution can split; pages
without a host skip it.  A page's text is read in time linear in its length.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and gets the
posterior of the pages without a host; no labelled page at all gives the prior mean ``0.5`` with strength 2, hence
``allow``; repeated pages count once per row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written

#: Suffixes of two or three labels, beside the last label of any host; a parameter of ``judge``, which
#: takes a public suffix list as well.
MULTI_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in")
#: The symbols counted, and the words that a run of them may have.
SYMBOLS = "#$%*|"
WORDS_A_SYMBOL = 10


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_labels(host: Column, suffixes: Sequence[str]) -> Column:
    """Labels of the host's suffix: those of the longest of ``suffixes`` that it ends with, else one."""
    labels = F.lit(1)
    for n in (2, 3):
        listed = [x for x in suffixes if x.count(".") == n - 1]
        if listed:
            labels = F.when(F.substring_index(host, ".", -n).isin(listed), F.lit(n)).otherwise(labels)
    return labels


def _last(host: Column, labels: Column) -> Column:
    return F.when(labels == 1, F.substring_index(host, ".", -1)).when(labels == 2, F.substring_index(host, ".", -2)).when(
        labels == 3, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -4))


def suffix_of(host: Column, suffixes: Sequence[str] = MULTI_SUFFIXES) -> Column:
    return _last(host, suffix_labels(host, suffixes))


def domain_of(host: Column, suffixes: Sequence[str] = MULTI_SUFFIXES) -> Column:
    return _last(host, suffix_labels(host, suffixes) + 1)


def outcome_of(html: Column) -> Column:
    """1 if the page's text is mostly symbols by the ratio above, else 0; null without words."""
    hidden = r"(?is)<script.*?(?:</script>|\z)|<style.*?(?:</style>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>"
    text = F.regexp_replace(html, hidden, " ")
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    runs = F.regexp_count(text, F.lit(f"[{SYMBOLS}]+"))
    return F.when(words > 0, (runs * WORDS_A_SYMBOL > words).cast("int"))


def fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def apply_rules(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; null if none fits.  ``rules``: (verdict, host, path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        hit = fits(host, path, rule_host, rule_path)
        rule = F.when(hit, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(hit, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _strength(rate: str, prior: str, n: str, least: float, most: float) -> Column:
    """Moment estimate of a beta prior's strength from the units of one level: the spread of the
    observed rates beyond binomial noise.  Little excess spread: a strong prior."""
    m = F.sum(F.col(n) * F.col(prior) * (1 - F.col(prior)))
    noise = F.sum(F.col(prior) * (1 - F.col(prior)))
    spread = F.sum(F.col(n) * (F.col(rate) - F.col(prior)) ** 2)
    excess = spread - noise
    return F.when((excess <= 0) | (m <= 0), F.lit(most)).otherwise(
        F.least(F.greatest(m / F.nullif(excess, F.lit(0.0)) - 1, F.lit(least)), F.lit(most)))


def _shrink(units: DataFrame, least: float, most: float) -> DataFrame:
    """``units``: a row per unit with its counts n and k and its prior (prior, prior_weight); adds
    the strength that the prior gets.  A prior is worth no more than what stands behind it, so a
    unit below an unseen parent stays uncertain."""
    seen = units.filter(F.col("n") > 0).withColumn("rate", F.col("k") / F.col("n"))
    level = seen.agg(F.coalesce(_strength("rate", "prior", "n", least, most), F.lit(most)).alias("level"))
    return _beside(units, level).withColumn("strength", F.least("level", "prior_weight")).drop("level", "prior_weight")


def _beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row table."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one")


def _below(units: DataFrame, parents: DataFrame, on: list[str]) -> DataFrame:
    """``units`` with the prior that their parent gives: its posterior without the unit's own pages,
    so that no page counts twice."""
    up = parents.select(*on, *[F.col(c).alias(f"up_{c}") for c in ("n", "k", "prior", "strength")])
    weight = F.col("up_n") - F.col("n") + F.col("up_strength")
    mean = (F.col("up_k") - F.col("k") + F.col("up_prior") * F.col("up_strength")) / weight
    return units.join(up, on).withColumns({"prior": mean, "prior_weight": weight}).drop("up_n", "up_k", "up_prior", "up_strength")


def reputation(outcomes: DataFrame, least: float = 2.0, most: float = 200.0,
               suffixes: Sequence[str] = MULTI_SUFFIXES) -> DataFrame:
    """Posterior of every host in ``outcomes`` (host, bad 0/1/null): ``host, mean, weight``.
    ``bad`` null: the page is unlabelled but its host gets a row."""
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    hosts = (outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
             .withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes)))
    hosts = written(hosts, "hosts")
    corpus = hosts.agg(*sums).withColumns({"prior": F.lit(0.5), "strength": F.lit(2.0), "all": F.lit(1)})
    tops = _shrink(_below(hosts.groupBy("suffix").agg(*sums).withColumn("all", F.lit(1)), F.broadcast(corpus), ["all"]), least, most)
    tops = tops.withColumn("strength", F.when(F.col("n") > 0, F.col("strength")).otherwise(F.least("strength", F.lit(least))))
    domains = _shrink(_below(hosts.groupBy("suffix", "domain").agg(*sums), tops, ["suffix"]), least, most)
    own = _shrink(_below(hosts, domains, ["suffix", "domain"]), least, most)
    weight = F.col("n") + F.col("strength")
    return own.select("host", ((F.col("k") + F.col("prior") * F.col("strength")) / weight).alias("mean"), weight.alias("weight"))


def lower_bound(mean: Column, weight: Column, z: float) -> Column:
    """Wilson's lower bound of a rate whose estimate ``mean`` is worth ``weight`` pages."""
    middle = mean + z * z / (2 * weight)
    return (middle - z * F.sqrt(mean * (1 - mean) / weight + z * z / (4 * weight * weight))) / (1 + z * z / weight)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], labels: DataFrame | None = None,
          threshold: float = 0.5, z: float = 2.326, suffixes: Sequence[str] = MULTI_SUFFIXES) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_rate, bad_lower``.

    ``labels``: (page_id, bad).  Without it every page's outcome is that of its own ``html``."""
    url = F.col("url").cast("string")
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    if labels is None:
        outcomes = pages.select(host_of(url).alias("host"), outcome_of(F.col("html").cast("string")).alias("bad"))
    else:
        marks = labels.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
        outcomes = pages.select("page_id", host_of(url).alias("host")).join(marks, "page_id", "left").select("host", "bad")
    posterior = reputation(outcomes, suffixes=suffixes)
    low = lower_bound(F.col("mean"), F.col("weight"), z)
    base = (pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
            .withColumn("rule", rule).withColumn("ruled", verdict))
    return (base.join(posterior, "host", "left")
            .withColumn("bad_lower", F.round(low, 9))
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("bad_lower") > threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    F.round("mean", 9).alias("bad_rate"), "bad_lower"))
