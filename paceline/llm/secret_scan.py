"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Every long token gets the smallest alphabet that holds it (its inferred encoding) and three tests
for a random draw from that alphabet: chi-squared uniformity, runs above and below the middle,
and serial correlation. Their p-values are combined by Fisher's rule. In each group of one length
class and one encoding, Benjamini and Hochberg's rule on the p-values of the distinct tokens says
which ones are not random, with at most a share ``Q`` of those wrong. The others are reported where
the tests can tell words: either tokens of that length and alphabet are such that a word would fail, or
enough are left and their p-values spread evenly, as those of random tokens do.

All of it runs on Spark's own functions. What is gathered from the corpus is one histogram of fixed size.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import free_name, packed, unpacked
from paceline.llm.spans import listed, matches, named, start_first
from paceline.session import durable

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_CHARS = 12
BASE = ("assign", "access", "hex")
RANDOM = "random"
SHORTEST = 16
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
#: What a run that no encoding holds is cut into: the longest parts that one encoding holds, and those between any
#: two of ``=/_-``. Such a part may lie within another.
PARTS = tuple(rf"[A-Za-z0-9{more}]{{{SHORTEST},}}(?:=+$)?" for more in ("+/", "_-", "+"))
#: Lower ends of the length classes.
CLASSES = (16, 20, 24, 32, 48, 96)
#: Bins of p: even ones, and below the first of them one for each power of ten.
BINS, POWERS = 200, 12
#: The accepted share of false discoveries.
Q = 0.05
#: Tokens left over in a group are random if there are ENOUGH and their mean p is no more than DEVIATIONS too low.
ENOUGH, DEVIATIONS = 20, 2.0
#: Two letters of a word are alike this often (in a random token as often as one in its alphabet), and words fail
#: the tests where that puts chi-squared so many standard deviations too high. Alphabets up to NO_WORDS hold none.
ALIKE, CLEARLY, NO_WORDS = 0.067, 4.0, 16
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the smallest alphabet to the largest: the first that holds a token is its own.
ENCODINGS = (
    ("digits", DIGITS, "[0-9]+"),
    ("hex", DIGITS + "abcdef", "[0-9a-f]+"),
    ("hex", DIGITS + "ABCDEF", "[0-9A-F]+"),
    ("lower", LOWER, "[a-z]+"),
    ("upper", UPPER, "[A-Z]+"),
    ("base32", UPPER + "234567", "[A-Z2-7]+=*"),
    ("lower36", DIGITS + LOWER, "[0-9a-z]+"),
    ("upper36", DIGITS + UPPER, "[0-9A-Z]+"),
    ("base62", DIGITS + UPPER + LOWER, "[0-9A-Za-z]+"),
    ("base64", UPPER + LOWER + DIGITS + "+/", "[0-9A-Za-z+/]+=*"),
    ("base64url", UPPER + LOWER + DIGITS + "-_", "[0-9A-Za-z_-]+=*"),
)


def by_encoding(token, place):
    """The name (0) or alphabet (1) of the first encoding that holds the token; null if none does."""
    out = F.lit(None).cast("string")
    for encoding in reversed(ENCODINGS):
        out = F.when(token.rlike(f"^(?:{encoding[2]})$"), F.lit(encoding[place])).otherwise(out)
    return out


def normal_tail(z):
    """P(|Z| > |z|) of a standard normal, by a rational approximation that is good to 1e-7."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def chi_squared_tail(value, freedom):
    """P(X > value) for many degrees of freedom, by the cube-root transform to a normal."""
    spread = 2 / (freedom * 9)
    z = (F.pow(value / freedom, 1 / 3) - (1 - spread)) / F.sqrt(spread)
    both = normal_tail(z)
    return F.when(z > 0, both / 2).otherwise(1 - both / 2)


def parts(spans):
    """Spans that an encoding holds, and the parts of the others."""

    def cut_up(s):
        found = F.concat(*[matches(s["value"], p) for p in PARTS])
        # as strings, which Spark tells apart by hash; structs take a comparison of every two
        once = F.array_distinct(F.transform(found, lambda f: F.concat_ws(":", (s["start"] + f["start"]).cast("string"), (s["start"] + f["end"]).cast("string"), f["value"])))
        fields = F.transform(once, lambda f: F.split(f, ":"))
        shifted = F.transform(fields, lambda f: F.struct(f[0].cast("int").alias("start"), f[1].cast("int").alias("end"), f[2].alias("value")))
        whole = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(by_encoding(s["value"], 0).isNotNull(), whole).otherwise(shifted)

    return F.flatten(F.transform(spans, cut_up))


def tested(spans):
    """Candidate spans with length class and the combined p-value.

    Padding at the end of a token is not tested. Each step has one lambda, so nothing is worked out twice.
    """
    chosen = F.transform(
        parts(spans),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.rtrim(s["value"], F.lit("=")).alias("token"),
            by_encoding(s["value"], 0).alias("encoding"), by_encoding(s["value"], 1).alias("alphabet"),
        ),
    )
    usable = F.filter(chosen, lambda s: s["encoding"].isNotNull() & (F.length(s["token"]) >= SHORTEST))
    return F.transform(F.transform(usable, counted), combined)


def counted(s):
    """Sums over the symbols of a token: squared counts, runs, those above the middle, and moments."""
    size = F.length(s["alphabet"])
    chars = F.split(s["token"], "")
    squares = F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda total, c: total + F.pow((F.length(s["token"]) - F.length(F.replace(s["token"], c))).cast("double"), 2),
    )
    start = F.struct(
        F.lit(-1.0).alias("last"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("high"), F.lit(0.0).alias("s1"),
        F.lit(0.0).alias("s2"), F.lit(0.0).alias("s11"), F.lit(-1.0).alias("side"),
    )
    ranks = F.transform(chars, lambda c: (F.call_function("instr", s["alphabet"], c) - 1).cast("double"))

    def step(a, x):
        side = F.when(x * 2 >= size, 1.0).otherwise(0.0)
        return F.struct(
            x.alias("last"), (a["runs"] + F.when(side == a["side"], 0.0).otherwise(1.0)).alias("runs"),
            (a["high"] + side).alias("high"), (a["s1"] + x).alias("s1"), (a["s2"] + x * x).alias("s2"),
            (a["s11"] + F.when(a["last"] < 0, 0.0).otherwise(a["last"] * x)).alias("s11"), side.alias("side"),
        )

    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), F.xxhash64(s["token"]).alias("id"),
        F.length(s["token"]).cast("double").alias("n"), size.cast("double").alias("k"), squares.alias("squares"),
        F.aggregate(ranks, start, step).alias("sums"),
    )


def combined(s):
    """The three p-values and Fisher's combination of them."""
    n, k, sums = s["n"], s["k"], s["sums"]
    uniform = chi_squared_tail(F.greatest(s["squares"] * k / n - n, F.lit(1e-9)), k - 1)
    high, low = sums["high"], n - sums["high"]
    expected = high * low * 2 / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    runs = F.when(variance > 0, normal_tail((sums["runs"] - expected) / F.sqrt(variance))).otherwise(0.0)
    spread = sums["s2"] - sums["s1"] * sums["s1"] / n
    mean = sums["s1"] / n
    serial = F.when(
        spread > 0, normal_tail(((sums["s11"] - mean * mean * (n - 1)) / spread + 1 / n) * F.sqrt(n))
    ).otherwise(0.0)
    half = -sum(F.log(F.greatest(p, F.lit(1e-300))) for p in (uniform, runs, serial))
    p = F.exp(-half) * (1 + half + half * half / 2)
    length = sum(F.when(n >= c, 1).otherwise(0) for c in CLASSES)
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"), s["id"].alias("id"),
        length.alias("length"), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p"),
    )


def bin_of(p):
    """Even bins from 0 on; -2 and less below the second of them, by powers of ten."""
    power = F.least(F.floor(-F.log10(F.greatest(p, F.lit(10.0**-POWERS)))), F.lit(POWERS))
    return F.when(p * BINS < 1, -power).otherwise(F.least(F.floor(p * BINS), F.lit(BINS - 1))).cast("int")


def upper_end(b):
    return (b + 1) / BINS if b >= 0 else min(10.0**b, 1 / BINS)


def words_fail(length, encoding):
    """Whether a word of the shortest length of a class would fail the tests clearly, or can't be one."""
    k = min(len(alphabet) for name, alphabet, _ in ENCODINGS if name == encoding)
    return k <= NO_WORDS or CLASSES[length - 1] * (k * ALIKE - 1) >= CLEARLY * (2 * (k - 1)) ** 0.5


def evenly(bins, lowest):
    """Whether there are ENOUGH tokens from a bin on, spread evenly over what p can be there."""
    left = {b: n for b, n in bins.items() if b >= lowest}
    count, bar = sum(left.values()), upper_end(lowest - 1) if lowest > -POWERS else 0.0
    if count < ENOUGH:
        return False
    middle = sum(n * ((b + 0.5) / BINS if b >= 0 else upper_end(b) / 2) for b, n in left.items()) / count
    return middle >= (1 + bar) / 2 - DEVIATIONS * (1 - bar) / (12 * count) ** 0.5


def thresholds(rows: DataFrame):
    """(length class, encoding) -> the lowest bin of p at which a token counts as random; groups without one are missing.

    Every distinct token counts once, however many rows have it.
    """
    c = F.col("c")
    tokens = rows.select(F.explode("candidates").alias("c")).select(c["length"].alias("length"), c["encoding"].alias("encoding"), bin_of(c["p"]).alias("bin"), c["id"].alias("id"))
    counts = tokens.distinct().groupBy("length", "encoding", "bin").count().collect()  # at most 6 * 10 * 212 rows
    groups = {}
    for r in counts:
        groups.setdefault((r["length"], r["encoding"]), {})[r["bin"]] = r["count"]
    out = {}
    for group, bins in groups.items():
        total, rejected, lowest = sum(bins.values()), 0, -POWERS
        for b in sorted(bins):
            rejected += bins[b]
            if total * upper_end(b) <= Q * rejected:
                lowest = b + 1
        if words_fail(*group) or evenly(bins, lowest):
            out[group] = lowest
    return out


def scan(docs: DataFrame, text="text", keep=("doc_id",)) -> DataFrame:
    """The columns in ``keep`` with ``base`` and ``found``: spans of the fixed patterns, and of random tokens.

    Spans are structs of start, number, end and kind, in code points, sorted by start. Null and empty
    texts have none; the same token is judged alike wherever it stands. Rows are read once and stay
    where they are; what is written in between is the spans.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    assign = F.filter(matches(content, ASSIGN), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_CHARS)
    spans = [named(assign, BASE[0], 0), named(matches(content, ACCESS), BASE[1], 1), named(matches(content, HEX), BASE[2], 2)]
    kept = [f"`{c}`" for c in keep if c.lower() not in ("base", "found")]
    own = docs.select(*kept)
    tokens, tried = free_name(own, "tokens"), free_name(own, "candidates")
    rows = docs.select(*kept, start_first(F.concat(*spans)).alias("base"), matches(content, CANDIDATE).alias(tokens))
    rows = durable(rows.select(*kept, "base", tested(F.col(tokens)).alias(tried)))
    limits = thresholds(rows.select(F.col(tried).alias("candidates")))
    chosen = F.lit(False)

    def passes(s):
        out = chosen
        for (length, encoding), lowest in limits.items():
            out = out | ((s["length"] == length) & (s["encoding"] == encoding) & (bin_of(s["p"]) >= lowest))
        return out

    found = named(F.filter(tried, passes), RANDOM, len(BASE))
    return rows.select(*kept, "base", found.alias("found"))


def summary(scanned: DataFrame, key="doc_id") -> DataFrame:
    """Counts of the fixed kinds, the digest of their spans, and all spans as text."""
    count = lambda number: F.size(F.filter("base", lambda s: s["number"] == number)).cast("long")
    return scanned.select(
        key, *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(start_first(F.concat("base", "found"))).alias("spans"),
    )


def redact(docs: DataFrame, text="text", mask="[secret]") -> DataFrame:
    """The documents with every span replaced by a mask, and the columns they came with; null texts stay null."""
    found = scan(packed(docs, text), "text", ("row", "text"))
    pieces = F.aggregate(
        start_first(F.concat("base", "found")), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring("text", a["at"] + 1, s["start"] - a["at"]), F.lit(mask)))
            .otherwise(a["out"]).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.lit(2**31 - 1) - a["at"] - 1)),
    )
    return unpacked(found.withColumn("text", pieces), docs.columns, text)
