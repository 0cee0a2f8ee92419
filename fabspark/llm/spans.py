"""Places of regular-expression matches in texts, as DataFrame expressions.

Patterns are Java's. Those used here are written so that matching is linear in
the text: runs are possessive and begin only where a run begins, with ``\\G`` for
a run that the last match ended in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEP = 128  # running sums are taken in steps, as appending to a long array copies it

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def running(a: Column) -> Column:
    """For each element of an array of longs, the sum of those before it.

    Sums are gathered in steps, as appending to a long array copies it.
    """
    none = F.array().cast("array<bigint>")

    def add(acc: Column, x: Column) -> Column:
        full = F.size(acc["part"]) >= _STEP
        return F.struct((acc["sum"] + x).alias("sum"),
                        F.when(full, F.array(acc["sum"])).otherwise(F.array_append(acc["part"], acc["sum"])).alias("part"),
                        F.when(full, F.array_append(acc["parts"], acc["part"])).otherwise(acc["parts"]).alias("parts"))

    start = F.struct(F.lit(0).cast("long").alias("sum"), none.alias("part"),
                     F.array().cast("array<array<bigint>>").alias("parts"))
    return F.aggregate(a, start, add, lambda acc: F.flatten(F.array_append(acc["parts"], acc["part"])))


def with_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]], context: int = 0) -> DataFrame:
    """Adds one array column per pattern: the matches with start, end (code points, end exclusive) and text.

    ``patterns``: name to pattern and guard; where the guard is false the pattern is
    not run and the array is empty. With ``context``, also so many characters
    before and after, up to the neighbouring matches.
    """
    # Lambdas refer to their own arguments only: a column named inside one may be put in as its whole expression by
    # the optimizer, and then be computed for every element.
    none = F.array().cast("array<string>")
    df = df.withColumns({f"_{n}_{k}": F.when(guard, f).otherwise(none) for n, (p, guard) in patterns.items()
                         for k, f in (("m", F.regexp_extract_all(text, F.lit(p), F.lit(0))),
                                      ("g", F.split(text, p, -1)))})
    count = {n: F.size(f"_{n}_m") for n in patterns}
    gap = {n: (F.slice(f"_{n}_g", F.lit(1), count[n]), F.slice(f"_{n}_g", F.lit(2), count[n])) for n in patterns}
    df = df.withColumns({f"_{n}_s": running(F.zip_with(f"_{n}_m", gap[n][0], lambda m, g: (
        F.length(m) + F.length(g)).cast("long"))) for n in patterns})

    def made(x: Column) -> Column:
        start = x["s"] + F.length(x["b"])
        more = [F.right(x["b"], F.lit(context)).alias("before"), F.left(x["a"], F.lit(context)).alias("after")] if context else []
        return F.struct(start.alias("start"), (start + F.length(x["m"])).alias("end"), x["m"].alias("text"), *more)

    def one(n: str) -> Column:
        return F.transform(F.arrays_zip(F.col(f"_{n}_m").alias("m"), F.col(f"_{n}_s").alias("s"), gap[n][0].alias("b"),
                                        gap[n][1].alias("a")), made)

    return df.withColumns({n: one(n) for n in patterns}) \
        .drop(*(f"_{n}_{k}" for n in patterns for k in "mgs"))


def as_spans(matches: str | Column, kind: int) -> Column:
    """Matches as (start, kind, end)."""
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"),
                                                   m["end"].alias("end"))).cast(SPAN)


def ordered(*spans: Column) -> Column:
    """All spans by start, then kind."""
    return F.sort_array(F.concat(*spans))


def joined(spans: str | Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others: one sweep forth and one back over both."""
    tagged = lambda a, more: F.transform(a, lambda s: F.struct(
        s["start"].alias("start"), F.lit(more).alias("more"), s["kind"].alias("kind"), s["end"].alias("end")))
    both = F.sort_array(F.concat(tagged(others, False), tagged(spans, True)))
    flags = F.array().cast("array<boolean>")

    def forth(acc: Column, s: Column) -> Column:
        reach = F.when(s["more"], acc["at"]).otherwise(F.greatest(acc["at"], s["end"]))
        return F.struct(reach.alias("at"), F.array_append(acc["out"], s["more"] & (s["start"] >= acc["at"])).alias("out"))

    def back(acc: Column, s: Column) -> Column:
        reach = F.when(s["more"], acc["at"]).otherwise(F.least(acc["at"], s["start"]))
        return F.struct(reach.alias("at"), F.array_append(acc["out"], s["more"] & (s["end"] <= acc["at"])).alias("out"))

    start = lambda at: F.struct(F.lit(at).cast("long").alias("at"), flags.alias("out"))
    before = F.aggregate(both, start(-1), forth, lambda acc: acc["out"])
    after = F.reverse(F.aggregate(F.reverse(both), start((1 << 62)), back, lambda acc: acc["out"]))
    free = F.zip_with(before, after, lambda x, y: x & y)
    kept = F.filter(F.zip_with(both, free, lambda s, ok: s.withField("more", ok)), lambda s: s["more"])
    swept = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.when((F.size(others) == 0) | (F.size(spans) == 0), spans).otherwise(swept.cast(SPAN))


def masked(text: str | Column, spans: str | Column, marks: list[str]) -> Column:
    """The text with each span replaced by its kind's mark; of overlapping spans the first one's."""
    text = F.col(text) if isinstance(text, str) else text
    names = F.array(*(F.lit(m) for m in marks))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, F.get(names, s["kind"]))).alias("out"))
        old = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], new).otherwise(old)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
