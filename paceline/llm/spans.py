"""Places of pattern matches in a text, with Spark's own functions only."""

from pyspark.sql import functions as F

#: Matches whose places are summed together; keeps texts of very many matches from quadratic work.
BLOCK = 256


def let(value, body):
    """``body`` of a column that is worked out once, however often and deep the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_ends(lengths):
    """The running sums of an array column of ints."""
    return let(lengths, _running_ends)


def _running_ends(lengths):
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    part = lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK)
    follow = lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x))
    sums = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0), lambda total, x: total + x))
    starts = F.aggregate(sums, F.array(F.lit(0)), follow)
    ends = F.transform(
        F.filter(F.zip_with(blocks, starts, lambda b, s: F.struct(b.alias("block"), s.alias("start"))), lambda b: b["block"].isNotNull()),
        lambda b: F.slice(F.aggregate(part(b["block"]), F.array(b["start"]), follow), 2, BLOCK),
    )
    return F.flatten(ends)


def cut(text, pattern):
    """A struct of the matches of a pattern, in order, of the texts between them, and of the matches' ends."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(values.alias("values"), F.split(text, pattern, -1).alias("gaps"))

    def with_ends(c):
        lengths = F.zip_with(F.slice(c["gaps"], F.lit(1), F.size(c["values"])), c["values"], lambda gap, value: F.length(gap) + F.length(value))
        return F.struct(c["values"].alias("values"), c["gaps"].alias("gaps"), running_ends(lengths).alias("ends"))

    return let(both, with_ends)


SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text, pattern, likely=None):
    """Leftmost non-overlapping matches as structs of start, end (code points, end exclusive) and value.

    The pattern may not match the empty string. What stands between the matches gives their places.
    ``likely`` is a condition that every text with a match meets and that is cheaper than the pattern.
    """
    some = text.rlike(pattern) if likely is None else likely & text.rlike(pattern)
    spans = lambda c: F.zip_with(
        c["ends"], c["values"],
        lambda end, value: F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")),
    )
    found = let(cut(text, pattern), spans)
    return F.when(some, found).otherwise(F.array().cast(SPAN))


def named(found, kind, number):
    """Spans with their kind, in a form that sorts by kind and start."""
    return F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("number"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def listed(spans):
    """kind:start:end of spans, comma-joined, in the order they have."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def kind_first(spans):
    """Sorted by kind as numbered, then by start."""
    return F.array_sort(spans, lambda a, b: order(a, b, "number", "start", "end"))


def start_first(spans):
    """Sorted by start, then by kind as numbered."""
    return F.array_sort(spans, lambda a, b: order(a, b, "start", "number", "end"))


def order(a, b, *fields):
    out = F.lit(0)
    for name in reversed(fields):
        out = F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(out)
    return out
