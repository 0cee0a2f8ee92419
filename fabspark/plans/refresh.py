"""Rebuild of silver and gold from bronze, in full or for the days that changed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark import constants as K
from fabspark.operators import spc, staging, stats, yields
from fabspark.operators.ordering import join_on
from fabspark.operators.reshape import to_long
from fabspark.session import scratch, settled
from fabspark.sources.lake import Change, Lake

LONG_KEYS = ("observation_id", "process_timestamp", "line_id", "tester_id", "shift", "lot_id", "wafer_status")
TABLES = ("reporting", "quarantine", "daily", "shifts", "oee", "limits", "violations", "pareto")
#: Kept beside the tables so that an intake need not read history again.
STATE = ("first_readings", "series_days", "moments")

#: When a row was computed and by which logic, by table.
STAMPS = {
    "reporting": ("silver_created_at", K.REPORTING_LOGIC, "processing_logic"), "quarantine": ("quarantined_at", None, ""),
    "daily": ("last_updated_at", None, ""), "shifts": ("computed_at", None, ""), "oee": ("computed_at", None, ""),
    "limits": ("computed_at", None, ""), "violations": ("computed_at", None, ""), "pareto": ("computed_at", None, "")}


@dataclass(frozen=True)
class Setup:
    """What a plant may set; defaults are the 590-sensor layout."""

    sensors: Sequence[str]
    monitored: Sequence[str] = tuple(K.MONITORED_SENSORS)
    ranked: Sequence[str] = tuple(K.PARETO_SENSORS)
    max_missing: int = K.MAX_MISSING
    prefix: str = ""
    key: Column | None = None


def refresh(bronze: DataFrame, root: str, setup: Setup) -> dict[str, DataFrame]:
    """Full rebuild of every silver and gold table under ``root``; what is settled on the way is dropped.

    All tables are published at once. ``Lake(spark, root).read(name)`` reads them.
    """
    with scratch(bronze.sparkSession):
        lake = _built(Lake(bronze.sparkSession, root), bronze, setup, None)
    return {n: lake.read(n) for n in TABLES}


def refresh_days(bronze: DataFrame, changed: DataFrame, root: str, setup: Setup) -> dict[str, DataFrame]:
    """Bring every table up to date after an intake, as a full rebuild would.

    ``bronze`` holds all rows, ``changed`` those that are new; bronze only grows. Rows
    of the days found in ``changed``, the day of rows without a time among them,
    replace those days in silver and in the tables by day. Limits follow from the
    kept first readings of every series. Series with new readings are judged anew
    from their first changed day on, with as many earlier readings as the rules
    look back at, or from their start where the limits moved or a new reading has
    no time. Pareto is made from the moments kept by day. The days of one intake
    are few (at most one a calendar day) and go into filters as literals.
    Without earlier tables it is a full rebuild.
    """
    spark = bronze.sparkSession
    with scratch(spark):
        lake = Lake(spark, root)
        if lake.version:
            days = [r[0] for r in changed.select(F.to_date("Time").alias("d")).distinct().collect()]
            lake = _built(lake, bronze, setup, days) if days else lake
        else:
            lake = _built(lake, bronze, setup, None)
    return {n: lake.read(n) for n in TABLES}


def _within(column: Column, days: Sequence[date | None]) -> Column:
    """Rows of these days by a time column; the range of the literals reaches the scan, the list of days does not."""
    known = [d for d in days if d is not None]
    hit = F.lit(False)
    if known:
        first, last = F.lit(str(min(known))), F.lit(str(max(known) + timedelta(days=1)))
        hit = ((column >= first.cast("timestamp_ntz")) & (column < last.cast("timestamp_ntz"))
               & F.to_date(column).isin(known))
    return hit | column.isNull() if None in days else hit


def _built(lake: Lake, bronze: DataFrame, setup: Setup, days: Sequence[date | None] | None) -> Lake:
    """Everything (``days`` is None) or what depends on some days, published as the next version."""
    c = lake.change()

    def put(name: str, df: DataFrame, by: str | None = None, replace: Sequence[object] | None = None) -> DataFrame:
        stamp = STAMPS.get(name)
        return c.put(name, staging.with_audit(df, *stamp) if stamp else df, by, replace)

    by_day = lambda name, df: put(name, df.withColumn("day", F.to_date("process_timestamp")), "day", days)
    rows = bronze if days is None else bronze.filter(_within(F.col("Time"), days))
    staged = staging.stage(rows, setup.sensors, setup.key)
    rep = by_day("reporting", staging.reporting(staged, setup.max_missing))
    quar = by_day("quarantine", staging.quarantine(staged, setup.max_missing))
    put("daily", yields.daily_yield(rep, quar), "process_date", days)
    shifts = put("shifts", yields.shift_metrics(rep, quar), "process_date", days)
    put("oee", yields.oee(shifts), "process_date", days)

    new = to_long(rep, setup.monitored, list(LONG_KEYS), setup.prefix)
    counts = new.filter(F.col("val").isNotNull()).groupBy(*spc.SERIES, F.to_date("process_timestamp").alias("day")) \
        .agg(F.count(F.lit(1)).alias("readings"))
    counts = c.put("series_days", counts, "day", days)
    first = spc.first_readings(new, counts=counts)
    if days is not None:
        kept = lake.read("first_readings").filter(~_within(F.col("process_timestamp"), days))
        first = spc.merged_first(kept, first)
    first = c.put("first_readings", first)
    limits = put("limits", spc.limits_of(first))
    if days is None:
        put("violations", spc.violations(new, limits), "sensor_id")
    else:
        _judge_again(lake, c, put, counts, limits, setup)

    ranked = [s for s in setup.ranked if s in rep.columns]
    c.put("moments", stats.label_moments(rep, ranked, "day", prefix=setup.prefix), "day", days)
    put("pareto", stats.pareto_of(c.read("moments")))
    return c.publish()


def _judge_again(lake: Lake, c: Change, put, counts: DataFrame, limits: DataFrame, setup: Setup) -> None:
    """Violations of the series with new readings, from where they may differ."""
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in ("mu", "sigma")]
    old = lake.read("limits").select(*spc.SERIES, F.col("mu").alias("_mu"), F.col("sigma").alias("_sigma"), F.lit(True).alias("_had"))
    moved = join_on(limits.select(*spc.SERIES, "mu", "sigma", F.lit(True).alias("_has")), old, spc.SERIES, "left") \
        .filter(F.col("_had").isNull() | ~(same[0] & same[1]))
    # Limits never go once there are any: a series only gains readings. A series may move without new readings of its own
    # only through its specification limits, which no rule looks at.
    starts = counts.groupBy(*spc.SERIES).agg(F.min("day").alias("_from"), F.max(F.col("day").isNull()).alias("_whole"))
    starts = join_on(starts, moved.select(*spc.SERIES, "_has"), spc.SERIES, "left").withColumn(
        "_from", F.when(F.col("_whole") | F.col("_has").isNotNull(), None).otherwise(F.col("_from"))).select(*spc.SERIES, "_from")
    starts = settled(starts, "starts")  # one row a series
    # The day by which enough earlier readings are at hand, from the kept counts by day.
    back = Window.partitionBy(*spc.SERIES).orderBy(F.desc("day"))
    before = join_on(c.read("series_days"), starts, spc.SERIES).filter(F.col("day") < F.col("_from"))
    reach = before.withColumn("_sum", F.sum("readings").over(back)).filter(F.col("_sum") >= spc.REACH) \
        .groupBy(*spc.SERIES).agg(F.max("day").alias("_back"))
    starts = settled(join_on(starts, reach, spc.SERIES, "left"), "starts")
    low = starts.agg(F.count_if(F.col("_back").isNull()), F.min("_back"), F.count(F.lit(1))).first()
    rep = c.read("reporting")
    if low[2] and not low[0]:
        rep = rep.filter(F.col("day") >= F.lit(low[1]))
    day = F.to_date("process_timestamp")
    rows = join_on(to_long(rep, setup.monitored, list(LONG_KEYS), setup.prefix), starts, spc.SERIES) \
        .filter(F.col("_back").isNull() | (day >= F.col("_back")))
    found = spc.violations(rows.drop("_from", "_back"), limits)
    since = F.col("_from").isNull() | F.coalesce(day >= F.col("_from"), F.lit(False))
    found = join_on(found, starts, spc.SERIES).filter(since).drop("_from", "_back")
    sensors = [r[0] for r in starts.select("sensor_id").distinct().collect()]  # at most the monitored ones
    earlier = lake.read("violations").filter(F.col("sensor_id").isin(sensors)).drop(*[s for s in STAMPS["violations"][:1]])
    earlier = join_on(earlier, starts.withColumn("_hit", F.lit(True)), spc.SERIES, "left") \
        .filter(F.col("_hit").isNull() | ~since).drop("_from", "_back", "_hit")
    put("violations", earlier.unionByName(found), "sensor_id", sensors)
