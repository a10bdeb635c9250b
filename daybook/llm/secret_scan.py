"""Secret scans: fixed patterns plus a battery of randomness tests on other opaque tokens.

Base spans come from three patterns, leftmost and non-overlapping per kind.  The battery then looks
at every other run of at least ``MIN_TOKEN`` token characters.  Its encoding (hex, base32, letters,
lower or upper alphanumeric, base62, base64) is inferred from the characters it uses, and over that
encoding's alphabet of ``k`` codes three statistics are taken:

* chi-squared of the code counts against uniformity.  For ordinary words it is a noncentral
  chi-squared whose noncentrality grows with the length, so ``p_text``, the chance that a word-like
  token looks this uniform, gets small only if the token is long enough to tell: the test is
  length-aware by itself;
* runs above and below the alphabet's middle, and the lag-1 serial correlation of the codes; both
  are standard normal for random codes, so together ``p_random = exp(-(z1^2 + z2^2) / 2)``.  Tokens
  that fail (repeats, alphabet walks) are not secrets.

``p_text`` is then held to a false-discovery rate of ``q`` by Benjamini-Hochberg, separately in each
length class and over the tokens of all documents.  The step-up threshold is read from a histogram
of ``-10 log10 p``: at most ``LENGTH_CLASSES x BINS`` rows whatever the corpus, so no token or
document is gathered.  Scans run twice over the texts (histogram, then verdicts) in place of
keeping intermediate rows.

Only DataFrame functions.  Positions come without a position-aware matcher: splitting by a pattern
gives the gaps between its matches, and running sums of gap and match lengths give code-point
offsets.  The sums are kept per block of 256 matches.  What overlaps what is told by ranks: a span
overlaps none of a list if as many of the list begin before its end as end by its beginning, and both
numbers are places in one sorted array.  Texts are cut in pieces of ``CUT`` code points before parts are
taken out of them.  So work grows with the length of a text, however many tokens it has, but for the sorting.

Defined cases: null text is empty; an empty text has no spans; repeated rows are scanned each; the
tables may be empty; extra columns pass through :func:`redact` and are ignored by :func:`scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import let, packed, text_or_empty

# The contract's patterns, in its order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

MIN_TOKEN = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN
#: Chance that two letters of ordinary text agree; smaller alphabets: twice the uniform chance.
TEXT_AGREEMENT = 0.065
FALSE_DISCOVERY = 0.01
RANDOM_LEVEL = 0.001
BINS = 300
#: Upper ends of the length classes.
LENGTH_CLASSES = (24, 32, 48, 1 << 30)
BLOCK = 256
CUT = 4096
SPAN = "array<struct<s:int,k:int,e:int>>"


def _spans(text: Column, pattern: str, kind: int, group: int | None = None, least: int = 0) -> Column:
    """Spans of all matches (of those whose ``group`` has ``least`` characters)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    lens = F.transform(F.arrays_zip(gaps.alias("g"), found.alias("m"), tested.alias("t")), lambda x: F.struct(
        F.length(x["g"]).alias("g"), F.length(x["m"]).alias("m"), (F.length(x["t"]) >= least).alias("ok")))
    return F.when(F.rlike(text, F.lit(pattern)), let(lens, lambda x: _positions(x, kind))).otherwise(F.array().cast(SPAN))


def _positions(lens: Column, kind: int) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(lens) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lens, b * BLOCK + 1, F.lit(BLOCK)))
    return let(blocks, lambda x: _from_blocks(x, kind))


def _from_blocks(blocks: Column, kind: int) -> Column:
    sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x["g"] + x["m"]))
    starts = F.aggregate(
        sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["out"], a["at"]).cast("array<int>").alias("out")),
    )["out"]

    def walk(b: Column, start: Column) -> Column:
        return F.aggregate(
            b, F.struct(start.alias("at"), F.array().cast(SPAN).alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["g"] + x["m"]).alias("at"),
                F.when(x["ok"], F.array_append(a["out"], F.struct(
                    (a["at"] + x["g"]).alias("s"), F.lit(kind).alias("k"), (a["at"] + x["g"] + x["m"]).alias("e"))))
                .otherwise(a["out"]).cast(SPAN).alias("out")))["out"]

    return F.flatten(F.zip_with(blocks, starts, walk))


def _encoding(body: Column) -> Column:
    """(alphabet, text agreement) of a token body; null for plain numbers, which are no secrets."""
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    table = [(r"^[0-9]+$", ""), (r"^[0-9a-f]+$", dig + "abcdef"), (r"^[0-9A-F]+$", dig + "ABCDEF"),
             (r"^[A-Z]?[a-z]+$", low), (r"^[A-Z]+$", up), (r"^[A-Z2-7]+$", up + "234567"),
             (r"^[a-z0-9]+$", low + dig), (r"^[A-Z0-9]+$", up + dig), (r"^[A-Za-z0-9]+$", up + low + dig),
             (r"^[A-Za-z0-9_-]+$", up + low + dig + "-_")]
    out = F.lit(up + low + dig + "+/")
    for pattern, alphabet in reversed(table):
        out = F.when(F.rlike(body, F.lit(pattern)), F.lit(alphabet or None).cast("string")).otherwise(out)
    return out


def _battery(token: Column) -> Column:
    """struct(n, p_text, p_random) of one token (null p_text: a plain number)."""
    body = F.regexp_replace(token, "=+$", "")
    # A capitalised word is read in lower case, like the alphabet chosen for it.
    folded = F.when(F.rlike(body, F.lit("^[A-Z][a-z]+$")), F.lower(body)).otherwise(body)
    return let(F.struct(folded.alias("body"), _encoding(body).alias("alphabet")), _graded)


def _graded(x: Column) -> Column:
    body, alphabet = x["body"], x["alphabet"]
    squares = F.aggregate(F.array_distinct(F.split(body, "")), F.lit(0.0), lambda a, c: a + F.pow(
        F.length(body) - F.length(F.replace(body, c, F.lit(""))), 2))
    codes = F.transform(F.split(body, ""), lambda c: F.instr(alphabet, c).cast("double"))
    facts = F.struct(F.length(body).cast("double").alias("n"), F.length(alphabet).cast("double").alias("k"),
                     squares.alias("squares"), codes.alias("codes"))
    return let(facts, lambda f: let(
        F.aggregate(f["codes"], F.lit(0.0), lambda a, v: a + v) / f["n"], lambda mean: _tests(f, mean)))


def _tests(f: Column, mean: Column) -> Column:
    n, k, codes = f["n"], f["k"], f["codes"]
    pairs = F.zip_with(F.slice(codes, F.lit(1), F.size(codes) - 1), F.slice(codes, F.lit(2), F.size(codes) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    sums = F.struct(
        F.aggregate(codes, F.lit(0.0), lambda a, v: a + (v > k / 2).cast("double")).alias("high"),
        F.aggregate(pairs, F.lit(1.0), lambda a, p: a + ((p["a"] > k / 2) != (p["b"] > k / 2)).cast("double")).alias("turns"),
        F.aggregate(codes, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)).alias("var"),
        F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean)).alias("cov"))

    def values(s: Column) -> Column:
        expected = 2 * s["high"] * (n - s["high"]) / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = F.when(spread > 0, (s["turns"] - expected) / F.sqrt(spread)).otherwise(F.lit(9.0))
        z_serial = F.when(s["var"] > 0, s["cov"] / s["var"] * F.sqrt(n) + 1 / F.sqrt(n)).otherwise(F.lit(9.0))
        shift = n * (k * F.greatest(F.lit(TEXT_AGREEMENT), 2.0 / k) - 1)
        z = (k / n * f["squares"] - n - (k - 1 + shift)) / F.sqrt(2 * (k - 1) + 4 * shift)
        # Logistic form of the normal distribution function.
        p_text = let(z, lambda v: 1 / (1 + F.exp(-(1.5976 * v + 0.070566 * v * v * v))))
        p_random = F.exp(-(z_runs * z_runs + z_serial * z_serial) / 2)
        return F.struct(n.cast("int").alias("n"), p_text.alias("p_text"), p_random.alias("p_random"))

    return let(sums, values)


def _class(n: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES) - 1)
    for i in reversed(range(len(LENGTH_CLASSES) - 1)):
        out = F.when(n < LENGTH_CLASSES[i], F.lit(i)).otherwise(out)
    return out


def _bin(p: Column) -> Column:
    return F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-40)))), F.lit(BINS)).cast("int")


TESTED = "array<struct<s:int,e:int,cls:int,bin:int>>"


def _ranks(values: Column, among: Column, ties: bool) -> Column:
    """For each of the sorted ``values``, how many of ``among`` are smaller (with ``ties``: not larger)."""
    own, other = (1, 0) if ties else (0, 1)
    both = F.array_sort(F.concat(F.transform(values, lambda v: 2 * v.cast("long") + own), F.transform(among, lambda v: 2 * v.cast("long") + other)))
    placed = F.filter(F.transform(both, lambda v, i: F.struct(v.alias("v"), i.alias("i"))), lambda x: x["v"] % 2 == own)
    return F.transform(placed, lambda x, j: x["i"] - j)


def _ends(spans: Column, field: str) -> Column:
    return F.transform(spans, lambda x: x[field])


def _free(tokens: Column, base: Column) -> Column:
    """Those of ``tokens`` (in order, apart from each other) that overlap no span of ``base``."""
    begun = _ranks(_ends(tokens, "e"), _ends(base, "s"), ties=False)
    ended = _ranks(_ends(tokens, "s"), _ends(base, "e"), ties=True)
    marked = F.arrays_zip(tokens.alias("x"), begun.alias("begun"), ended.alias("ended"))
    return F.transform(F.filter(marked, lambda m: m["begun"] == m["ended"]), lambda m: m["x"])


def _tested(text: Column, base: Column) -> Column:
    """Tokens of ``text`` outside ``base`` that pass as random codes, with their length class and p_text
    bin; others have bin -1 and count as tests only."""
    def grade(x: Column) -> Column:
        return let(_battery(x["token"]), lambda b: F.struct(
            x["s"].alias("s"), x["e"].alias("e"), _class(b["n"]).alias("cls"),
            F.when(b["p_random"] >= RANDOM_LEVEL, F.coalesce(_bin(b["p_text"]), F.lit(-1)))
            .otherwise(F.lit(-1)).alias("bin")))
    tokens = F.zip_with(_spans(text, TOKEN, 3), F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda x, m: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), m.alias("token")))
    # Bound by let: what a function's body names is computed again for each element.
    graded = let(tokens, lambda t: let(base, lambda b: F.transform(_free(t, b), grade))).cast(TESTED)
    return F.when(F.rlike(text, F.lit(TOKEN)), graded).otherwise(F.array().cast(TESTED))


def _with_base(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_t`` (text), ``_base`` (sorted base spans) and ``_tested`` (other tokens)."""
    t = F.col("_t")
    base = F.concat(_spans(t, ASSIGN, 0, group=2, least=8), _spans(t, ACCESS, 1), _spans(t, HEX, 2))
    return (docs.withColumn("_t", text_or_empty()).withColumn("_base", F.array_sort(base))
            .withColumn("_tested", _tested(t, F.col("_base"))))


def bars(tested: DataFrame, q: float = FALSE_DISCOVERY) -> dict[int, int]:
    """Length class -> least bin that the false-discovery rule accepts.  ``tested``: one row per
    token with ``cls`` and ``bin``."""
    counts = tested.groupBy("cls", "bin").agg(F.count("*").alias("n"))
    up = Window.partitionBy("cls").orderBy(F.desc("bin"))
    steps = (counts.withColumn("above", F.sum("n").over(up))
             .withColumn("all", F.sum("n").over(Window.partitionBy("cls")))
             .filter((F.col("bin") >= 0) & (F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("all") <= q * F.col("above"))))
    return {r["cls"]: r["bin"] for r in steps.groupBy("cls").agg(F.min("bin").alias("bin")).collect()}


def scanned(docs: DataFrame, q: float = FALSE_DISCOVERY) -> DataFrame:
    """``docs`` with ``_t``, ``_base`` and ``_all``: all spans sorted by start, then kind."""
    prepared = _with_base(docs)
    accepted = bars(_with_base(docs.select("text")).select(F.explode("_tested").alias("x")).select("x.cls", "x.bin"), q)
    least = F.array(*[F.lit(accepted.get(c, BINS + 1)) for c in range(len(LENGTH_CLASSES))])
    added = F.transform(F.filter("_tested", lambda x: x["bin"] >= F.get(least, x["cls"])),
                        lambda x: F.struct(x["s"].alias("s"), F.lit(3).alias("k"), x["e"].alias("e")))
    return prepared.withColumn("_all", F.array_sort(F.concat("_base", added.cast(SPAN)))).drop("_tested")


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, q: float = FALSE_DISCOVERY) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` (code points, end exclusive)."""
    def count(k: int) -> Column:
        return F.size(F.filter("_all", lambda x: x["k"] == k)).cast("long")
    return scanned(docs.select("doc_id", "text"), q).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        count(3).alias("n_random"), F.sha2(_joined("_base").cast("binary"), 256).alias("base_sha256"),
        _joined("_all").alias("spans"))


def _part(pieces: Column, at: Column, to: Column) -> Column:
    """The code points ``at`` to ``to`` of a text cut in pieces of ``CUT``."""
    first, last = F.floor(at / CUT).cast("int"), F.floor(to / CUT).cast("int")
    inside = F.substring(F.get(pieces, first), at - first * CUT + 1, to - at)
    whole = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    across = F.concat(F.substring(F.get(pieces, first), at - first * CUT + 1, F.lit(CUT)), whole,
                      F.coalesce(F.substring(F.get(pieces, last), F.lit(1), to - last * CUT), F.lit("")))
    return F.when(to <= at, F.lit("")).when(first == last, inside).otherwise(across)


def _marked(pieces: Column, length: Column, spans: Column, mark: str) -> Column:
    """The text with the sorted ``spans`` (overlapping ones joined) replaced."""
    def built(ends: Column) -> Column:
        # A span begins a new mark if all spans before it have ended by then; the last of these ends is
        # the end of the mark before.
        ended = F.arrays_zip(spans.alias("x"), _ranks(_ends(spans, "s"), ends, ties=True).alias("n"))
        heads = F.filter(F.transform(ended, lambda m, i: F.struct(m["x"]["s"].alias("s"), m["n"].alias("n"), i.alias("i"))),
                         lambda m: m["n"] == m["i"])
        before = F.transform(heads, lambda m: F.concat(
            _part(pieces, F.coalesce(F.get(ends, m["i"] - 1), F.lit(0)), m["s"]), F.lit(mark)))
        return F.concat(F.array_join(before, ""), _part(pieces, F.get(ends, F.size(ends) - 1), length))
    return let(F.array_sort(_ends(spans, "e")), built)


def redact(docs: DataFrame, mark: str = "[SECRET]", q: float = FALSE_DISCOVERY) -> DataFrame:
    """``docs`` with every span (overlapping ones joined) replaced by ``mark`` in ``text``; texts
    without spans, null ones too, are left as they are."""
    clean = let(F.regexp_extract_all(F.col("_t"), F.lit("(?s).{1,%d}" % CUT), F.lit(0)),
                lambda pieces: let(F.col("_all"), lambda spans: _marked(pieces, F.length("_t"), spans, mark)))
    done = scanned(packed(docs, "text"), q)
    new = F.when(F.size("_all") > 0, clean).otherwise(F.col("text"))
    return done.select(F.col("row").withField("text", new).alias("row")).select("row.*")
