"""Personal data: fixed patterns, and identifiers that share their contexts.

The matches of the fixed patterns are seeds. The words around a seed are lexical patterns; other
tokens that look like identifiers and stand in the same contexts are instances. Patterns and
instances make a graph that Spark scores in rounds until they settle: a pattern is as good as the known share of
its places, an instance as good as the patterns it stands in. Instances of high score that
no fixed pattern knows are reported as found.

What counts for a pattern is the lower confidence bound of the share of its places that known instances
fill, among all places where its words occur in any text; so a common word beside which anything can
stand is never trusted, and a rare one is even where most identifiers are known.
All of it runs on Spark's own functions; the graph is aggregated before it is shuffled.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import free_name, packed, unpacked
from paceline.llm.spans import SPAN, cut, kind_first, let, listed, matches, running_ends
from paceline.llm.stream_dedup import checked_broadcast
from paceline.session import durable

#: Written so that no long text makes them slow or deep: a match can only begin where a run begins or the
#: last match ended, and no repetition gives back what it took.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")
CARD_LIKELY = r"[0-9](?:[\x20-]?[0-9]){15}"
IP_PARTS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)
CONTEXT = "context"
#: Tokens with a digit or an at sign, and such tokens one space apart as one.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+"
SHORTEST, LONGEST = 5, 64
CONTEXT_CHARS = 64
#: Far more rounds than scores need to settle; that they did not is an error, not an end.
MAX_ROUNDS = 100
#: A pattern is trusted if at least SUPPORT known instances stand in it and the lower bound of the share of
#: its places that they fill reaches TRUST; an instance from SCORE on.
SUPPORT = 3
TRUST = 0.7
SCORE = 0.8
Z = 1.0


def digits_of(value):
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits):
    """Whether the digits pass Luhn's check."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.when(k % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda total, d: total + d) % 10 == 0


def base_spans(content):
    """The spans of the fixed kinds with what stands in them, as one array sorted by kind and start."""
    within = lambda s, bounds: F.length(digits_of(s["value"])).between(*bounds)
    email = matches(content, EMAIL, content.contains("@"))
    ip = F.filter(matches(content, IP, content.rlike(r"[0-9]\.[0-9]")), lambda s: s["value"].rlike(IP_PARTS))
    card = F.filter(matches(content, CARD, content.rlike(CARD_LIKELY)), lambda s: within(s, CARD_DIGITS))
    card = F.filter(card, lambda s: luhn(digits_of(s["value"])))
    phone = F.filter(matches(content, PHONE, content.contains("+")), lambda s: within(s, PHONE_DIGITS))
    with_value = lambda f, kind, number: F.transform(
        f, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value"))
    )
    found = [with_value(f, k, n) for n, (k, f) in enumerate(zip(BASE, (email, ip, card, phone)))]
    return kind_first(F.concat(*found))


def without_value(spans):
    return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "number", "end", "kind")]))


def with_context(content):
    """Identifier-like runs with the text on both sides: structs of start, end, value, before, after."""

    def placed(c):
        count = F.size(c["values"])
        before = F.transform(F.slice(c["gaps"], F.lit(1), count), lambda g: F.substring(g, -CONTEXT_CHARS, CONTEXT_CHARS))
        after = F.transform(F.slice(c["gaps"], F.lit(2), count), lambda g: F.substring(g, 1, CONTEXT_CHARS))
        sides = F.zip_with(before, after, lambda b, a: F.struct(b.alias("before"), a.alias("after")))
        spans = F.zip_with(c["ends"], c["values"], lambda end, value: F.struct(end.alias("end"), value.alias("value")))
        return F.zip_with(
            spans, sides,
            lambda s, c: F.struct(
                (s["end"] - F.length(s["value"])).alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                c["before"].alias("before"), c["after"].alias("after"),
            ),
        )

    found = let(cut(content, CANDIDATE), placed)
    none = F.array().cast(SPAN.replace(">>", ",before:string,after:string>>"))
    return F.when(content.rlike("[0-9@]"), found).otherwise(none)


def patterns(before, after):
    """Contexts of a run: the word before it, the two words before it, the word after it."""
    left = F.filter(F.split(F.lower(before), r"\s+"), lambda w: w != "")
    right = F.filter(F.split(F.lower(after), r"\s+"), lambda w: w != "")
    last = F.element_at(left, -1)
    return F.concat(
        F.when(F.size(left) > 0, F.array(F.concat(F.lit("< "), last))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(left) > 1, F.array(F.concat(F.lit("<< "), F.element_at(left, -2), F.lit(" "), last))).otherwise(F.array().cast("array<string>")),
        F.when(F.size(right) > 0, F.array(F.concat(F.lit("> "), F.element_at(right, 1)))).otherwise(F.array().cast("array<string>")),
    )


def overlap(a, b):
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def tokens_of(run):
    """The single tokens of a run; the context of a side where another token of the run stands is empty."""

    def placed(p):
        words, ends = p["words"], p["ends"]
        return F.transform(
            words,
            lambda w, k: F.struct(
                (run["start"] + F.get(ends, k) - F.length(w) - 1).alias("start"), (run["start"] + F.get(ends, k) - 1).alias("end"),
                w.alias("value"), F.when(k == 0, run["before"]).otherwise(F.lit("")).alias("before"),
                F.when(k == F.size(words) - 1, run["after"]).otherwise(F.lit("")).alias("after"),
            ),
        )

    ends = lambda words: running_ends(F.transform(words, lambda w: F.length(w) + 1))
    return let(F.split(run["value"], " "), lambda words: let(F.struct(words.alias("words"), ends(words).alias("ends")), placed))


def parts_of(token, near):
    """What the fixed spans ``near`` leave of a token; a side where a span stands has an empty context."""

    def part(s, e):
        return F.struct(
            s.alias("start"), e.alias("end"), token["value"].substr(s - token["start"] + 1, e - s).alias("value"),
            F.when(s == token["start"], token["before"]).otherwise(F.lit("")).alias("before"),
            F.when(e == token["end"], token["after"]).otherwise(F.lit("")).alias("after"),
        )

    def until(s):
        later = F.transform(F.filter(near, lambda b: b["start"] >= s), lambda b: b["start"])
        return F.least(F.coalesce(F.array_min(later), token["end"]), token["end"])

    starts = F.array_distinct(F.concat(F.array(token["start"]), F.transform(near, lambda b: b["end"])))
    open_at = lambda s: (s < token["end"]) & ~F.exists(near, lambda b: (b["start"] <= s) & (s < b["end"]))
    return F.transform(F.filter(starts, open_at), lambda s: let(until(s), lambda e: part(s, e)))


def instance(value):
    """The key of an identifier: its text in lower case, or a hash of it if it is long."""
    return F.when(F.length(value) > LONGEST, F.concat(F.lit("#"), F.sha2(F.lower(value), 256))).otherwise(F.lower(value))


def unit(run, start, end, value, seed, joined, before, after):
    """One candidate; ``run`` and ``joined`` tell which run it belongs to and whether it is all of several tokens."""
    return F.struct(
        start.alias("start"), end.alias("end"), instance(value).alias("instance"), F.lit(seed).alias("seed"),
        F.lit(joined).alias("joined"), run["start"].alias("run"), patterns(before, after).alias("patterns"),
    )


def trimmed(run, found, joined):
    """Candidates of spans without the punctuation around them; too short ones are none."""

    def one(s):
        head = F.regexp_replace(s["value"], r"^[^A-Za-z0-9+(]+", "")
        core = F.regexp_replace(head, r"[^A-Za-z0-9)]+$", "")
        start = s["end"] - F.length(head)
        return F.struct(start.alias("start"), (start + F.length(core)).alias("end"), core.alias("value"), s["before"].alias("before"), s["after"].alias("after"))

    cores = F.filter(F.transform(found, one), lambda s: (F.length(s["value"]) >= SHORTEST) & s["value"].rlike("[0-9@]"))
    return F.transform(cores, lambda s: unit(run, s["start"], s["end"], s["value"], False, joined, s["before"], s["after"]))


def candidates(runs, base):
    """Fixed spans as seeds, what they leave of the tokens, and untouched runs of several tokens as a whole."""

    def of_token(run, token, near):
        at_edge = F.filter(near, lambda b: (b["start"] >= token["start"]) | (b["end"] <= token["end"]))
        seeds = F.transform(
            at_edge,
            lambda b: unit(
                run, b["start"], b["end"], b["value"], True, False,
                F.when(b["start"] >= token["start"], token["before"]).otherwise(F.lit("")),
                F.when(b["end"] <= token["end"], token["after"]).otherwise(F.lit("")),
            ),
        )
        return F.concat(seeds, trimmed(run, parts_of(token, near), False))

    def of_run(run, touching):
        near = lambda t: F.filter(touching, lambda b: overlap(b, t))
        single = F.flatten(F.transform(tokens_of(run), lambda t: let(near(t), lambda n: of_token(run, t, n))))
        whole = (F.size(touching) == 0) & run["value"].contains(" ")
        return F.concat(single, trimmed(run, F.filter(F.array(run), lambda _: whole), True))

    touching = lambda run: F.filter(base, lambda b: overlap(b, run))
    return F.flatten(F.transform(runs, lambda run: let(touching(run), lambda t: of_run(run, t))))


def edges_of(rows: DataFrame) -> DataFrame:
    """(pattern, instance, n, seed): how often an instance stands in a pattern, over all documents."""
    each = rows.select(F.explode("candidates").alias("c")).select("c.instance", "c.seed", F.explode("c.patterns").alias("pattern"))
    return each.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))


def lower_bound(known, total):
    """The lower end of the confidence interval of a share (Wilson)."""
    share = known / total
    root = F.sqrt(share * (1 - share) / total + Z * Z / (total * total * 4))
    return (share + Z * Z / (total * 2) - Z * root) / (1 + Z * Z / total)


def words_of(pattern):
    """A pattern's word or two words, without the side that they stand on."""
    return F.regexp_replace(pattern, "^[<>]+ ", "")


def occurrences(texts: DataFrame, edges: DataFrame) -> DataFrame:
    """(words, places): how often the words of a pattern occur at all, for patterns that can get support."""
    wanted = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")).where(F.col("instances") >= SUPPORT)
    wanted = durable(wanted.select(words_of("pattern").alias("words")).distinct())
    both = lambda w: F.concat(w, F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat_ws(" ", a, b)))
    words = let(F.filter(F.split(F.lower("content"), r"\s+"), lambda w: w != ""), lambda w: F.when(F.size(w) > 1, both(w)).otherwise(w))
    each = texts.select(F.explode(words).alias("words")).join(checked_broadcast(wanted), "words", "left_semi")
    return durable(each.groupBy("words").agg(F.count(F.lit(1)).alias("places")))


def trusted(edges: DataFrame, scores: DataFrame, places: DataFrame) -> DataFrame:
    """(pattern, confidence) of the patterns that known instances fill in nearly all places where their words occur."""
    scored = edges.join(scores, "instance")
    found = scored.groupBy("pattern").agg(
        F.sum(F.col("n") * F.col("score")).alias("known"), F.sum("n").alias("filled"),
        F.sum((F.col("score") >= SCORE).cast("int")).alias("support"),
    )
    found = found.where(F.col("support") >= SUPPORT).withColumn("words", words_of("pattern")).join(places, "words", "left")
    total = F.greatest("filled", F.coalesce("places", "filled"))
    return found.select("pattern", "support", lower_bound(F.col("known"), total).alias("confidence")).where(F.col("confidence") >= TRUST)


def rescored(edges: DataFrame, good: DataFrame, seeds: DataFrame) -> DataFrame:
    """(instance, score): 1 for seeds, else how likely one of its trusted patterns is right."""
    doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
    reached = edges.join(good, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("reached"))
    joined = seeds.join(reached, "instance", "left")
    return joined.select("instance", F.greatest(F.col("seed").cast("double"), F.coalesce("reached", F.lit(0.0))).alias("score"))


def bootstrap(rows: DataFrame, texts: DataFrame):
    """(trusted patterns, scored instances) once a round adds no pattern and no instance; each round is written.

    Scores only rise from round to round, so what is trusted or accepted once stays so.
    """
    edges = durable(edges_of(rows))
    seeds = durable(edges.groupBy("instance").agg(F.max("seed").alias("seed")))
    places = occurrences(texts, edges)
    scores, before = seeds.select("instance", F.col("seed").cast("double").alias("score")), None
    for _ in range(MAX_ROUNDS):
        good = durable(trusted(edges, scores, places))
        scores = durable(rescored(edges, good, seeds))
        now = good.count(), scores.where(F.col("score") >= SCORE).count()
        if now == before or now[0] == 0:
            return good, scores
        before = now
    raise RuntimeError("scores did not settle")


def scan(docs: DataFrame, text="text", keep=("doc_id",)) -> DataFrame:
    """The columns in ``keep`` with ``base`` and ``found``: spans of the fixed kinds, and those found by context.

    Spans are structs of start, number, end and kind, in code points, sorted by kind and start. Null and
    empty texts have none. Texts are read twice, for spans and to count the words of contexts; what is
    written in between is spans, contexts and counts. What a fixed span touches of a token is known, the
    rest of the token and its neighbours stay open. Several tokens one space apart are also tried as one
    identifier, which is found only where none of its tokens is. A side of a token where another one or a
    fixed span stands has no context; an identifier without any context is not found.
    """
    kept = [c for c in keep if c.lower() not in ("base", "found", "candidates", "runs")]
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    columns = [f"`{c}`" for c in kept]
    rows = docs.select(*columns, base_spans(content).alias("base"), with_context(content).alias("runs"))
    row = free_name(rows, "row")
    rows = rows.select(*columns, candidates(F.col("runs"), F.col("base")).alias("candidates"), without_value(F.col("base")).alias("base"))
    rows = durable(rows.withColumn(row, F.monotonically_increasing_id()))
    _, scores = bootstrap(rows, docs.select(content.alias("content")))
    accepted = scores.where(F.col("score") >= SCORE).select("instance")
    opened = rows.select(F.col(row).alias("place"), F.explode("candidates").alias("c")).where(~F.col("c.seed")).select("place", "c.*")
    spans = opened.join(accepted, "instance", "left_semi").select(
        "place", "run", "joined", F.struct("start", F.lit(len(BASE)).alias("number"), "end", F.lit(CONTEXT).alias("kind")).alias("span")
    )
    single = F.collect_list(F.when(~F.col("joined"), F.col("span")))
    runs = spans.groupBy("place", "run").agg(F.collect_list("span").alias("every"), single.alias("single"))
    runs = runs.select("place", F.when(F.size("single") > 0, F.col("single")).otherwise(F.col("every")).alias("spans"))
    found = runs.groupBy("place").agg(F.flatten(F.collect_list("spans")).alias("found")).withColumnRenamed("place", row)
    empty = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    joined = rows.drop("candidates").join(found, row, "left")
    return joined.select(*columns, "base", kind_first(F.coalesce("found", empty)).alias("found"))


def summary(scanned: DataFrame, key="doc_id") -> DataFrame:
    """Counts of the fixed kinds, the digest of their spans, and all spans as text."""
    count = lambda number: F.size(F.filter("base", lambda s: s["number"] == number)).cast("long")
    return scanned.select(
        key, *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(kind_first(F.concat("base", "found"))).alias("spans"),
    )


def documents_with(docs: DataFrame, text="text") -> DataFrame:
    """The documents with any span, with the columns they came with."""
    found = scan(packed(docs, text), "text", ("row", "text"))
    return unpacked(found.where((F.size("base") > 0) | (F.size("found") > 0)), docs.columns, text)
