"""Data contracts: how many rows or keys break each rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.functions import columns as C


@dataclass(frozen=True)
class Rule:
    """``kind`` is unique, not_null, accepted_values or between."""

    kind: str
    columns: tuple[str, ...]
    values: tuple = field(default=())

    @property
    def name(self) -> str:
        return f"{self.kind}({','.join(self.columns)})"


def unique(*columns: str) -> Rule:
    return Rule("unique", columns)


def not_null(column: str) -> Rule:
    return Rule("not_null", (column,))


def accepted_values(column: str, *values) -> Rule:
    return Rule("accepted_values", (column,), values)


def between(column: str, low, high) -> Rule:
    return Rule("between", (column,), (low, high))


def _broken(rule: Rule) -> Column:
    c = C.col(rule.columns[0])
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(rule.values))
    return c.isNotNull() & ~c.between(*rule.values)


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: broken rows, or for ``unique`` the repeated keys.

    All row rules share one scan without a shuffle of rows; each uniqueness rule
    groups its key columns alone.
    """
    plain = [x for x in rules if x.kind != "unique"]
    parts = []
    if plain:
        counted = df.agg(*[F.count_if(_broken(x)).alias(f"f{i}") for i, x in enumerate(plain)])
        parts.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(x.name).alias("rule"), F.col(f"f{i}").alias("failures"))
            for i, x in enumerate(plain)]))))
    for x in rules:
        if x.kind == "unique":
            cols = [C.col(c) for c in x.columns]
            dup = df.dropna(subset=list(x.columns)).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(dup.agg(F.count_if(F.col("_n") > 1).alias("failures")).select(
                F.lit(x.name).alias("rule"), "failures"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("passed", F.col("failures") == 0)


SILVER_RULES = [unique("observation_id"), not_null("observation_id"),
                accepted_values("wafer_status", "Pass", "Fail", "Unknown")]
DAILY_RULES = [unique("process_date", "line_id"), not_null("process_date"),
               between("yield_percentage", 0, 100), not_null("total_wafers_tested")]
