"""Secret spans by patterns and by a battery of randomness tests.

Patterns find assigned credentials, access keys and long hex strings.  Every other long
token with digits and letters is tested for being random: the encoding is inferred from
its characters, then chi-squared uniformity over that alphabet, the number of runs above
and below its middle, and lag-one serial correlation are combined into one p-value.  False
discoveries are controlled within strata of token length (Benjamini-Hochberg over the whole
corpus): tokens shown to be structured are words, paths or names; what passes is a span of
kind ``random``.

Native expressions only.  The corpus-wide step aggregates p-values into a fixed number of
bins per stratum; the driver sees one threshold per stratum.

Defined results: a null text is empty and has no spans.  Offsets are code points, the end
exclusive.  Rows are handled one by one; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYWORDS = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_VALUE = 12
# Runs are maximal, so a length bound in the pattern drops the same matches as one after it.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")

#: Tokens are compared with tokens of similar length: lower ends of the strata.
STRATA = (20, 28, 40, 64)
FALSE_DISCOVERIES = 0.01
#: p-values are counted in bins of a tenth of a power of ten.
LOG_BINS, LEAST_LOG = 10, -30

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings in the order in which they are tried: name, pattern of the whole token, alphabet.
ENCODINGS = (
    ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex_upper", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", UPPER + "234567"),
    ("lower36", r"^[0-9a-z]+$", DIGITS + LOWER),
    ("upper36", r"^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", r"^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    ("base64", r"^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64_url", r".*", UPPER + LOWER + DIGITS + "-_+/"),
)

_SPAN = "array<struct<start:bigint,rank:int,end:bigint,text:string>>"


def _long(c: Column) -> Column:
    return c.cast("bigint")


def spans(text: Column, pattern: str, rank: int) -> Column:
    """Leftmost non-overlapping matches as (start, rank, end, text), from the pieces between them."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(found: Column) -> Column:
        step = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"))
        folded = F.aggregate(
            F.slice(step, F.lit(1), F.size(found)),
            F.struct(_long(F.lit(0)).alias("at"), F.array().cast(_SPAN).alias("out")),
            lambda acc, x: F.struct(
                _long(acc["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            _long(acc["at"] + F.length(x["gap"])).alias("start"),
                            F.lit(rank).alias("rank"),
                            _long(acc["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
                            x["match"].alias("text"),
                        )
                    ),
                ).alias("out"),
            ),
        )
        return F.when(F.size(found) > 0, folded["out"]).otherwise(F.array().cast(_SPAN))

    return F.transform(F.array(matches), placed)[0]


def base_spans(text: Column) -> Column:
    assign = F.filter(spans(text, ASSIGN, 1), lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 1)) >= MIN_VALUE)
    access = F.when(F.contains(text, F.lit("AKIA")), spans(text, ACCESS, 2)).otherwise(F.array().cast(_SPAN))
    return F.array_sort(F.concat(assign, access, spans(text, HEX, 3)))


def upper_tail(z: Column) -> Column:
    """P(normal > z) by a rational approximation, within 1e-7 (fixed coefficients)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))
    )
    tail = F.exp(-x * x / 2) * 0.3989422804014327 * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def p_value(token: Column) -> Column:
    """Probability of a token at least as structured, were it random in its inferred encoding."""
    bare = F.regexp_replace(token, "=+$", "")
    alphabet = F.coalesce(*[F.when(bare.rlike(p), F.lit(a)) for _, p, a in ENCODINGS])

    def tested(x: Column) -> Column:
        codes = F.transform(
            F.sequence(F.lit(1), F.length(x["bare"])),
            lambda i: (F.position(F.substr(x["bare"], i, F.lit(1)), x["alphabet"]) - 1).cast("double"),
        )
        return F.transform(F.array(codes), lambda c: _battery(c, F.length(x["alphabet"]).cast("double")))[0]

    return F.transform(F.array(F.struct(bare.alias("bare"), alphabet.alias("alphabet"))), tested)[0]


def _battery(codes: Column, m: Column) -> Column:
    n = F.size(codes).cast("double")
    zero = F.lit(0.0)
    # Sum of squared counts: the k-th equal code in sorted order adds 2k - 1.
    squares = F.aggregate(
        F.sort_array(codes),
        F.struct(F.lit(-1.0).alias("last"), zero.alias("run"), zero.alias("sum")),
        lambda a, c: F.struct(
            c.alias("last"),
            F.when(c == a["last"], a["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
            (a["sum"] + F.when(c == a["last"], 2 * a["run"] + 1).otherwise(F.lit(1.0))).alias("sum"),
        ),
    )["sum"]
    middle = (m - 1) / 2
    pairs = F.aggregate(
        codes,
        F.struct(F.lit(-1.0).alias("last"), zero.alias("changes"), zero.alias("product")),
        lambda a, c: F.struct(
            c.alias("last"),
            (a["changes"] + F.when((a["last"] >= 0) & ((c > middle) != (a["last"] > middle)), 1.0).otherwise(0.0)).alias("changes"),
            (a["product"] + F.when(a["last"] >= 0, (c - middle) * (a["last"] - middle)).otherwise(0.0)).alias("product"),
        ),
    )
    freedom = m - 1
    chi = F.greatest(squares * m / n - n, zero)
    z_chi = (F.pow(chi / freedom, F.lit(1 / 3)) - (1 - 2 / (9 * freedom))) / F.sqrt(2 / (9 * freedom))
    z_runs = (pairs["changes"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    z_serial = pairs["product"] / (F.sqrt(n - 1) * (m * m - 1) / 12)
    least = F.least(upper_tail(z_chi), 2 * upper_tail(F.abs(z_runs)), 2 * upper_tail(F.abs(z_serial)))
    return F.least(3 * least, F.lit(1.0))


def stratum(length: Column) -> Column:
    """The lower end of the token's length class."""
    out = F.lit(STRATA[0])
    for low in STRATA[1:]:
        out = F.when(length >= low, F.lit(low)).otherwise(out)
    return out


def candidates(text: Column) -> Column:
    """Long tokens with digits and letters, each with its stratum and p-value."""
    mixed = lambda t: t.rlike("[0-9]") & t.rlike("[A-Za-z]")
    any_mixed = F.exists(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), mixed)
    found = F.when(any_mixed, spans(text, TOKEN, 4)).otherwise(F.array().cast(_SPAN))
    return F.transform(
        F.filter(found, lambda s: mixed(s["text"])),
        lambda s: F.struct(
            s["start"], s["rank"], s["end"], s["text"],
            stratum(F.length(s["text"])).alias("stratum"), p_value(s["text"]).alias("p"),
        ),
    )


def _bin(p: Column) -> Column:
    return F.greatest(F.ceil(F.log10(F.greatest(p, F.lit(1e-300))) * LOG_BINS), F.lit(LEAST_LOG * LOG_BINS)).cast("int")


def structured_below(docs: DataFrame, rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Per stratum, the bin of the largest p-value at which a token is shown to be structured.

    Benjamini-Hochberg over bins: a bin's upper edge passes if it is at most ``rate``
    times the share of tokens at or below it.
    """
    tests = docs.select(F.explode(candidates(F.coalesce("text", F.lit("")))).alias("c")).select(
        F.col("c.stratum").alias("stratum"), _bin(F.col("c.p")).alias("bin")
    )
    counts = tests.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("stratum").orderBy("bin")
    edge = F.pow(F.lit(10.0), F.col("bin") / LOG_BINS)
    passed = (
        counts.withColumn("at_most", F.sum("n").over(upto))
        .withColumn("all", F.sum("n").over(Window.partitionBy("stratum")))
        .where(edge <= rate * F.col("at_most") / F.col("all"))
        .groupBy("stratum")
        .agg(F.max("bin").alias("bin"))
    )
    return {row.stratum: row.bin for row in passed.collect()}


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` (pattern spans) and ``found`` (those and random tokens), both sorted."""
    limits = structured_below(docs)
    text = F.coalesce("text", F.lit(""))

    def limit_of(s: Column) -> Column:
        out = F.lit(LEAST_LOG * LOG_BINS - 1)
        for low, bin_ in limits.items():
            out = F.when(s == low, F.lit(bin_)).otherwise(out)
        return out

    with_base = docs.withColumn("_base", base_spans(text)).withColumn("_tested", candidates(text))
    fresh = F.filter(
        F.col("_tested"),
        lambda c: (_bin(c["p"]) > limit_of(c["stratum"]))
        & ~F.exists(F.col("_base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    plain = F.transform(fresh, lambda c: F.struct(c["start"], c["rank"], c["end"], c["text"]))
    return with_base.withColumn("_found", F.array_sort(F.concat("_base", plain)))


def _digest_text(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["rank"] - 1), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts of the pattern kinds, a digest of their spans, and all spans."""
    counted = lambda rank, name: _long(F.size(F.filter("_base", lambda s: s["rank"] == rank))).alias(name)
    return with_spans(docs.select("doc_id", "text")).select(
        "doc_id",
        counted(1, "n_assign"),
        counted(2, "n_access"),
        counted(3, "n_hex"),
        F.sha2(_digest_text(F.col("_base")), 256).alias("base_sha256"),
        _digest_text(F.col("_found")).alias("spans"),
        _long(F.size("_found")).alias("n_spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mark``; overlapping spans share one."""
    text = F.col("text")
    folded = lambda found: F.aggregate(
        found,
        F.struct(_long(F.lit(0)).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.substr(text, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")), F.lit(mark)).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
    )
    rest = lambda x: F.concat(x["out"], F.substr(text, x["at"].cast("int") + 1, F.length(text)))
    clean = F.when(F.size("_found") > 0, F.transform(F.array(folded(F.col("_found"))), rest)[0]).otherwise(text)
    # The row travels as one struct, so no column of it can clash with a working column.
    marked = with_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text"))
    row = F.col("_row").withField("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.size("_found") > 0, F.length(clean).cast(kind)).otherwise(F.col("_row.n_chars")))
    return marked.select(row.alias("_row")).select("_row.*")
