"""Metric registry, golden parity and answer scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .marts import KPIS

NUMBER = r"(-?[0-9][0-9,]*\.?[0-9]*)"


def evaluate(df: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """(metric, value) of SQL aggregate expressions, from one pass."""
    row = df.agg(*(F.expr(e).cast("double").alias(f"m{i}") for i, e in enumerate(metrics.values())))
    return row.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(f"m{i}").alias("value")) for i, m in enumerate(metrics)))).alias("r")).select("r.*")


def population_drift(populations: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Per metric: the population measured when it was registered, measured now, and whether it moved."""
    parts = [df.agg(F.count(F.lit(1)).alias("now")).select(F.lit(name).alias("metric"), F.lit(then).cast("long").alias("measured"), "now") for name, (df, then) in populations.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("drifted", F.col("measured") != F.col("now"))


#: Unit and tolerance by kind of KPI.
_PERCENT, _DAYS, _RATIO, _USD = ("percent", 0.0001), ("days", 0.1), ("ratio", 0.01), ("usd", 1.0)
UNITS = {k: _PERCENT for k in KPIS} | {k: _RATIO for k in ("gmroi", "inventory_turns", "weeks_of_supply")} | {k: _DAYS for k in ("days_inventory_outstanding", "dso", "dpo", "cash_conversion_cycle", "close_cycle_days")} | {k: _USD for k in ("sales_per_fte", "avg_ticket")}


def golden_cases(headline: DataFrame) -> DataFrame:
    """(metric, unit, expected, tolerance) from the headline row."""
    rows = F.array(*(F.struct(F.lit(k).alias("metric"), F.lit(u).alias("unit"), F.col(k).cast("double").alias("expected"), F.lit(t).alias("tolerance")) for k, (u, t) in UNITS.items()))
    return headline.select(F.explode(rows).alias("r")).select("r.*")


def within(actual: Column, expected: Column, tolerance: Column, unit: Column) -> Column:
    """Parity; a percentage may be given as a share or in percent. Null never passes."""
    near = F.abs(actual - expected) <= tolerance
    return F.coalesce(near | ((unit == "percent") & (F.abs(actual / 100 - expected) <= tolerance)), F.lit(False))


def parity(actuals: DataFrame, golden: DataFrame) -> DataFrame:
    """Golden cases with the actual value (metric, value) and whether it passes."""
    both = golden.join(actuals, "metric", "left")
    return both.withColumn("passed", within(F.col("value"), F.col("expected"), F.col("tolerance"), F.col("unit")))


def first_number(text: Column) -> Column:
    """The first number in a text, thousands separators allowed; null if there is none."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, NUMBER, 1), ",", ""), F.lit("")).try_cast("double")


def score_answers(answers: DataFrame, golden: DataFrame) -> DataFrame:
    """Recorded answers (metric, answer, latency_ms) against the golden values."""
    found = answers.withColumn("value", first_number(F.col("answer"))).join(golden, "metric", "left")
    return found.withColumn("correct", within(F.col("value"), F.col("expected"), F.col("tolerance"), F.col("unit")))


def evaluation_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("cases"), F.count_if("correct").alias("correct"), F.max("latency_ms").alias("max_latency_ms"))


def badge(evidence: DataFrame, kpis: list[str] = KPIS) -> DataFrame:
    """Where the headline's values come from: LIVE, CACHE, or MOCK wherever that isn't proven.

    evidence: the headline's columns, and live, cached and mock (booleans; null: unknown). A real tier needs its own
    flag true, the other two unknown, and no KPI missing.
    """
    lacking = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in kpis))
    only = lambda c, *others: F.coalesce(F.col(c), F.lit(False)) & reduce(lambda a, b: a & b, (F.col(o).isNull() for o in others))
    tier = F.when(lacking, "MOCK").when(only("cached", "live", "mock"), "CACHE").when(only("live", "cached", "mock"), "LIVE").otherwise("MOCK")
    return evidence.withColumn("badge", tier)


def answer_score(answers: DataFrame) -> DataFrame:
    """40 points for SQL that passed the guardrails, 30 for a result of at least one row, 30 for parity with a golden case.

    answers: domain, guarded, row_count, in_tolerance (null counts as no); finance needs 100, others 70.
    """
    points = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    scored = answers.withColumn("score", points(F.col("guarded"), 40) + points(F.col("row_count") >= 1, 30) + points(F.col("in_tolerance"), 30))
    return scored.withColumn("floor", F.when(F.col("domain") == "finance", 100).otherwise(70)).withColumn("accepted", F.col("score") >= F.col("floor"))
