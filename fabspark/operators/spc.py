"""Statistical process control: frozen baselines, run rules, capability.

Two rule engines exist. The table engine (``violations``) flags the last point of
a run. The monitor engine (``monitor``) flags every point of a run, wants full
frames, and stays silent for series under nine readings or without spread.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark import constants as K
from fabspark.functions import columns as C
from fabspark.operators.ordering import join_on, positions, with_context
from fabspark.session import settled

SERIES = ["sensor_id", "line_id", "tester_id"]
TIME = ["process_timestamp", "observation_id"]
REACH = max(K.RULE_SPANS.values()) - 1


def early_days(long: DataFrame, by: Sequence[str], readings: int, counts: DataFrame | None = None) -> DataFrame:
    """Readings up to the day on which each group has its first ``readings``.

    Counts per group and day (``counts`` with ``day`` and ``readings``, if there are any) say which days that are. The latest of them goes into
    the filter as a literal, so the scan that follows leaves later data out and
    only the opening days are sorted, however long the history is. Readings without
    a time have no place among the first and are left out.
    """
    long = long.filter(F.col("val").isNotNull() & F.col("process_timestamp").isNotNull())
    day = F.to_date("process_timestamp")
    before = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    if counts is None:
        counts = long.groupBy(*by, day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = counts.filter(F.col("day").isNotNull()).select(*by, F.col("day").alias("_day"), F.col("readings").alias("_n"))
    until = settled(
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .filter(F.col("_before") < readings).groupBy(*by).agg(F.max("_day").alias("_until")), "until")
    last = until.agg(F.date_add(F.max("_until"), 1).cast("string")).first()[0]
    if last is None:
        return long.limit(0)
    early = long.filter(F.col("process_timestamp") < F.lit(last).cast("timestamp_ntz"))
    return join_on(early, until, list(by)).filter(day <= F.col("_until")).drop("_until")


def screened(long: DataFrame, by: Sequence[str], readings: int) -> DataFrame:
    """Mean and spread of the first readings per group, without raw outliers.

    First-N per group is a ranked filter, cut to N rows in every task before the
    shuffle; the raw statistics then run over at most N rows per group.
    """
    w = Window.partitionBy(*by).orderBy(*TIME)
    return _trimmed(early_days(long.select(*by, *TIME, "val"), by, readings)
                    .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= readings), by)


def _trimmed(first: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, spread and count of at most some hundred readings per group, without those beyond three raw sigma."""
    g = Window.partitionBy(*by)
    v = F.col("val")
    kept = first.withColumns({"_mu": C.mean(v, g), "_sd": C.spread(v, g)}).filter(
        F.abs(F.col("val") - F.col("_mu")) <= 3 * F.coalesce("_sd", F.lit(K.RAW_SIGMA_FALLBACK)))
    return kept.groupBy(*by).agg(C.mean(v).alias("mu"), C.spread(v).alias("sigma"),
                                 F.count("val").alias("readings"))


def spec_limits(long: DataFrame, line: str = K.GOLDEN_LINE,
                readings: int = K.BASELINE_READINGS) -> DataFrame:
    """Factory specification limits per sensor, from the golden line."""
    s = screened(long.filter(F.col("line_id") == line), ["sensor_id"], readings)
    half = K.SPEC_SIGMAS * F.col("sigma")
    return s.select("sensor_id", (F.col("mu") + half).alias("usl"), (F.col("mu") - half).alias("lsl"))


def first_readings(long: DataFrame, readings: int = K.BASELINE_READINGS, counts: DataFrame | None = None) -> DataFrame:
    """The first readings of every series in time, all that frozen limits depend on.

    Readings without a time have no place among the first and are left out. Every
    task cuts to ``readings`` rows a series before the shuffle, so one scan does;
    with the number of readings by series and day at hand (``counts``), only the opening days are sorted.
    The result is a mergeable state: the first readings of two such tables together
    are those of all readings behind them, see ``merged_first``.
    """
    w = Window.partitionBy(*SERIES).orderBy(*TIME)
    if counts is not None:
        long = early_days(long, SERIES, readings, counts)
    return (long.filter(F.col("val").isNotNull() & F.col("process_timestamp").isNotNull()).select(*SERIES, *TIME, "val")
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= readings).drop("_rn"))


def merged_first(a: DataFrame, b: DataFrame, readings: int = K.BASELINE_READINGS) -> DataFrame:
    """First readings of everything behind two tables of them."""
    return first_readings(a.unionByName(b), readings)


def limits_of(first: DataFrame, line: str = K.GOLDEN_LINE, readings: int = K.BASELINE_READINGS,
              min_readings: int = K.BASELINE_MIN_READINGS) -> DataFrame:
    """Limits from a table of first readings.

    The golden line's first readings of a sensor are among those of its testers, so
    specification limits need no scan of their own.
    """
    s = _trimmed(first, SERIES).filter(F.col("readings") > min_readings)
    w = Window.partitionBy("sensor_id").orderBy(*TIME)
    golden = first.filter(F.col("line_id") == line).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= readings)
    half = K.SPEC_SIGMAS * F.col("sigma")
    specs = _trimmed(golden, ["sensor_id"]).select(
        "sensor_id", (F.col("mu") + half).alias("usl"), (F.col("mu") - half).alias("lsl"))
    mu, sd = F.col("mu"), F.col("sigma")
    return s.join(specs, "sensor_id").select(
        "line_id", "tester_id", "sensor_id", "mu", "sigma",
        (mu + 3 * sd).alias("ucl"), (mu - 3 * sd).alias("lcl"),
        (mu + 2 * sd).alias("uwl"), (mu - 2 * sd).alias("lwl"), "usl", "lsl",
        F.lit(K.BASELINE_LOGIC).alias("logic_version"))


def baseline(long: DataFrame, line: str = K.GOLDEN_LINE, readings: int = K.BASELINE_READINGS,
             min_readings: int = K.BASELINE_MIN_READINGS) -> DataFrame:
    """Frozen control, warning and specification limits per line, tester and sensor, from one scan.

    A series of which every reading lacks a time has no limits.
    """
    # At most ``readings`` rows a series; settled, as two groupings read them.
    return limits_of(settled(first_readings(long, readings), "first"), line, readings, min_readings)


def spc_points(long: DataFrame, limits: DataFrame, how: str = "left") -> DataFrame:
    """Readings in order with their limits, z-score and side of the mean.

    A series without limits keeps NULL limits, so only the trend rules can fire.
    """
    placed = positions(long.filter(F.col("val").isNotNull()), SERIES, TIME)
    lim = limits.select(*SERIES, "mu", "sigma", "ucl", "lcl", "uwl", "lwl")
    # Limits are matched by plain equality, as one row per series.
    pts = placed.join(lim, SERIES, how)
    off = F.col("val") - F.col("mu")
    return pts.withColumns({"z_score": F.try_divide(off, F.col("sigma")), "side_of_mean": F.signum(off)})


def hits(cond: Column, n: int, w) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).over(w.rowsBetween(-(n - 1), 0))


def run(cond: Column, w) -> Column:
    """How many rows up to this one hold ``cond`` without a break; one step a row, however long the run.

    Rows of a window are consecutive by ``seq``.
    """
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    broken = F.max(F.when(~F.coalesce(cond, F.lit(False)), F.col("seq"))).over(upto)
    return F.col("seq") - F.coalesce(broken, F.first("seq").over(upto) - 1)


def rule_ends(points: DataFrame, block_rows: int | None = None, after: int = 0) -> DataFrame:
    """Columns ``rule1`` .. ``rule5``: true at the last point of a violating run.

    All rules share one window specification, so they cost one shuffle and one
    sort together. Rows outside ``_own`` are context and must be dropped later.
    """
    w = Window.partitionBy(*SERIES, "_blk").orderBy("seq")
    p = with_context(points, REACH, after, block_rows)
    val, z, side = F.col("val"), F.col("z_score"), F.col("side_of_mean")
    p = p.withColumns({
        "_v1": F.lag("val", 1).over(w), "_v2": F.lag("val", 2).over(w),
        "_z1": F.lag("z_score", 1).over(w), "_z2": F.lag("z_score", 2).over(w),
        "_up9": run(side > 0, w), "_dn9": run(side < 0, w)})
    step = F.signum(val - F.col("_v1"))
    p = p.withColumns({
        "_up5": run(step > 0, w), "_dn5": run(step < 0, w),
        "_alt": run(step * F.signum(F.col("_v1") - F.col("_v2")) < 0, w)})
    high, low = ([F.when(c, 1).otherwise(0) for c in cs] for cs in zip(*[(c > 2, c < -2) for c in (z, F.col("_z1"), F.col("_z2"))]))
    return p.withColumns({
        "rule1": F.coalesce(F.abs(z) > 3, F.lit(False)),
        "rule2": (F.col("_up9") >= 9) | (F.col("_dn9") >= 9),
        "rule3": (F.col("_up5") >= 5) | (F.col("_dn5") >= 5),
        "rule4": F.col("_alt") >= 12,
        "rule5": (sum(high[1:], high[0]) >= 2) | (sum(low[1:], low[0]) >= 2),
    }).drop("_v1", "_v2", "_z1", "_z2", "_up9", "_dn9", "_up5", "_dn5", "_alt")


def violations(long: DataFrame, limits: DataFrame, worst_rule_only: bool = False,
               block_rows: int | None = None) -> DataFrame:
    """One row per (observation, sensor, violated rule), or only the worst rule."""
    ends = rule_ends(spc_points(long, limits), block_rows).filter("_own")
    return violation_rows(ends, worst_rule_only)


def violation_rows(ends: DataFrame, worst_rule_only: bool = False) -> DataFrame:
    """A row for each rule that hit, or for the worst (lowest number) alone; values are rounded once a reading."""
    carried = [c for c in ("shift", "lot_id", "wafer_status") if c in ends.columns]
    hit = reduce(lambda a, b: a | b, [F.col(f"rule{n}") for n in K.RULE_NAMES])
    found = [F.when(F.col(f"rule{n}"), F.lit(n)) for n in K.RULE_NAMES]
    rule = F.col("rule_number")
    name = reduce(lambda c, n: c.when(rule == n, K.RULE_NAMES[n]), K.RULE_NAMES, F)
    rows = ends.filter(hit).select(
        "observation_id", "process_timestamp", "line_id", "tester_id", *carried, "sensor_id",
        C.rounded_value("val", 6).alias("sensor_value"), C.rounded_value("mu", 6).alias("reference_mean"),
        C.rounded_value("sigma", 6).alias("reference_sigma"), C.rounded_value("z_score", 4).alias("z_score"),
        F.array(*([F.least(*found)] if worst_rule_only else found)).alias("_found"))
    return rows.withColumn("rule_number", F.explode("_found")).filter(rule.isNotNull()).withColumn("rule_name", name) \
        .select(*[c for c in rows.columns if c != "_found"], "rule_name", "rule_number")


def monitor(long: DataFrame, limits: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Readings of a batch with every point of every violating run marked.

    Adds ``rules`` (numbers of the rules the point takes part in). Series without
    limits are left out.
    """
    points = spc_points(long, limits, "inner")
    p = rule_ends(points, block_rows, after=REACH)
    active = (F.col("series_rows") >= 9) & (F.col("sigma") != 0)
    w = Window.partitionBy(*SERIES, "_blk").orderBy("seq")
    marks = []
    for n, span in K.RULE_SPANS.items():
        end = F.col(f"rule{n}") & active & (F.col("seq") >= span)
        inside = F.max(end).over(w.rowsBetween(0, span - 1)) if span > 1 else end
        marks.append(F.when(inside, F.lit(n)))
    p = p.withColumn("rules", F.array_compact(F.array(*marks)))
    return p.filter("_own").drop("_own", "_blk", *[f"rule{n}" for n in K.RULE_SPANS])


def capability(long: DataFrame, specs: DataFrame, by: Sequence[str] = ("sensor_id",)) -> DataFrame:
    """Cp, Cpk, Cpu, Cpl; zeros under five readings or without spread.

    ``specs`` has one or more rows per sensor with equal limits (they are the
    same on all lines); one is taken.
    """
    one = settled(specs.groupBy("sensor_id").agg(F.min_by("usl", F.struct("line_id", "tester_id")).alias("usl"),
                                                 F.min_by("lsl", F.struct("line_id", "tester_id")).alias("lsl"))
                  if "line_id" in specs.columns else specs.select("sensor_id", "usl", "lsl"), "specs")
    s = long.groupBy(*by).agg(F.count("val").alias("readings"), C.mean(F.col("val")).alias("_m"),
                              C.spread(F.col("val")).alias("_s"))
    s = s.join(one, "sensor_id")
    sd, m = F.col("_s"), F.col("_m")
    usable = (F.col("readings") >= 5) & (sd != 0)
    cpu = F.try_divide(F.col("usl") - m, 3 * sd)
    cpl = F.try_divide(m - F.col("lsl"), 3 * sd)
    cp = F.try_divide(F.col("usl") - F.col("lsl"), 6 * sd)

    def shown(c: Column) -> Column:
        return F.when(usable, C.rounded(c, 3)).otherwise(F.lit(0.0))

    return s.select(*by, "readings", shown(cp).alias("cp"), shown(F.least(cpu, cpl)).alias("cpk"),
                    shown(cpu).alias("cpu"), shown(cpl).alias("cpl")).withColumn(
        "status", C.capability_class(F.col("cpk")))


def analyze_batch(long: DataFrame, limits: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Per series: mean, spread, limits, points out of control, rules hit, capability."""
    marked = monitor(long, limits, block_rows)
    hit = F.size("rules") > 0
    summary = marked.groupBy(*SERIES).agg(
        C.rounded(C.mean(F.col("val")), 4).alias("mean"),
        C.rounded(F.coalesce(C.spread(F.col("val")), F.lit(0.0)), 4).alias("std"),
        C.rounded(F.max("ucl"), 4).alias("ucl"), C.rounded(F.max("lcl"), 4).alias("lcl"),
        F.count_if(hit).alias("ooc_count"),
        *[F.max(F.array_contains("rules", n)).alias(f"_r{n}") for n in K.RULE_NAMES])
    names = F.concat_ws(", ", *[F.when(F.col(f"_r{n}"), name) for n, name in K.RULE_NAMES.items()])
    cap = join_on(
        long.groupBy(*SERIES).agg(F.count("val").alias("readings"), C.mean(F.col("val")).alias("_m"),
                                  C.spread(F.col("val")).alias("_s")),
        limits.select(*SERIES, "usl", "lsl"), SERIES)
    sd, m = F.col("_s"), F.col("_m")
    usable = (F.col("readings") >= 5) & (sd != 0)
    cpu, cpl = F.try_divide(F.col("usl") - m, 3 * sd), F.try_divide(m - F.col("lsl"), 3 * sd)
    cap = cap.select(
        *SERIES, "readings",
        F.when(usable, C.rounded(F.try_divide(F.col("usl") - F.col("lsl"), 6 * sd), 3)).otherwise(0.0).alias("cp"),
        F.when(usable, C.rounded(F.least(cpu, cpl), 3)).otherwise(0.0).alias("cpk"))
    return summary.withColumns({"ooc": F.col("ooc_count") > 0, "violations": names}).drop(
        *[f"_r{n}" for n in K.RULE_NAMES]).join(cap, SERIES)


def chart_series(long: DataFrame, limits: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Points of a control chart: index, value, limit lines, marker, padded axis range."""
    pad = (F.col("ucl") - F.col("lcl")) * 0.25
    return monitor(long, limits, block_rows).select(
        *SERIES, (F.col("seq") - 1).alias("point"), "val", "mu", "ucl", "lcl", "uwl", "lwl",
        (F.size("rules") > 0).alias("violation"),
        (F.col("lcl") - pad).alias("axis_low"), (F.col("ucl") + pad).alias("axis_high"))
