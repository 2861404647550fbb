"""Reports over evaluated periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethealth.config import ALERTA, ANORMAL, NORMAL, STATUSES

PERIOD = ("evaluation_year", "evaluation_week")


def frequency(df: DataFrame, column: str) -> DataFrame:
    """value, n, share of each value."""
    n = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("__t"))
    return n.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("__t")).alias("share"))


def by_period(df: DataFrame, status: str = "overall_status", period: Sequence[str] = PERIOD) -> DataFrame:
    return df.groupBy(*period, status).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, status: str = "overall_status", period: Sequence[str] = PERIOD, domain: Sequence[str] = STATUSES) -> DataFrame:
    """A column for each status with the period's count, and one with its percentage."""
    counts = [F.count_if(F.col(status) == s).alias(s) for s in domain]
    out = df.groupBy(*period).agg(*counts, F.count(F.lit(1)).alias("total"))
    return out.withColumns({f"{s}_pct": 100.0 * F.col(s) / F.col("total") for s in domain})


def unit_by_period(df: DataFrame, labels: Sequence[str], label: Column, status: str = "overall_status") -> DataFrame:
    """A row for each unit and a column for each period label, with its first status by name."""
    return df.withColumn("__l", label).groupBy("unit_id").pivot("__l", list(labels)).agg(F.min(status))


def changes(df: DataFrame, status: str = "overall_status") -> DataFrame:
    """Units with more than one status, and which."""
    return df.groupBy("unit_id").agg(F.countDistinct(status).alias("n_statuses"), F.sort_array(F.collect_set(status)).alias("statuses")).where("n_statuses > 1")


def transitions(df: DataFrame, status: str = "overall_status", period: Sequence[str] = PERIOD) -> DataFrame:
    """Each row with the status before, where it differs."""
    w = Window.partitionBy("unit_id").orderBy(*period)
    return df.withColumn("previous_status", F.lag(status).over(w)).where(F.col("previous_status").isNotNull() & (F.col("previous_status") != F.col(status)))


def score_trend(df: DataFrame, period: Sequence[str] = PERIOD) -> DataFrame:
    return df.groupBy(*period).agg(F.avg("machine_score").alias("mean_score"), F.median("machine_score").alias("median_score"), F.max("machine_score").alias("max_score"))


def ranking(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Units by mean score, with how many periods had an issue."""
    issue = F.col("overall_status").isin(ALERTA, ANORMAL)
    out = df.groupBy("unit_id").agg(F.avg("machine_score").alias("mean_score"), F.count_if(issue).alias("periods_with_issues"), F.count(F.lit(1)).alias("periods"))
    out = out.withColumn("issue_rate", 100.0 * F.col("periods_with_issues") / F.col("periods"))
    return out.orderBy(F.desc("mean_score"), "unit_id").limit(top) if top else out


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key is there more than once."""
    return df.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("__n > 1").drop("__n")


def coverage(df: DataFrame, period: Sequence[str] = PERIOD) -> DataFrame:
    return df.groupBy(*period).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("unit_id").alias("units"))


def degrading(components: DataFrame, n: int = 4, period: Sequence[str] = PERIOD) -> DataFrame:
    """Mean score of the last n and the first n periods of each unit's component, and whether it rose."""
    keys = ["unit_id", "component"]
    newest = Window.partitionBy(*keys).orderBy(*(F.desc(p) for p in period))
    oldest = Window.partitionBy(*keys).orderBy(*period)
    rows = components.withColumns({"__new": F.row_number().over(newest), "__old": F.row_number().over(oldest)})
    out = rows.groupBy(*keys).agg(F.avg(F.when(F.col("__new") <= n, F.col("component_score"))).alias("recent"), F.avg(F.when(F.col("__old") <= n, F.col("component_score"))).alias("oldest"), F.count(F.lit(1)).alias("periods"))
    return out.withColumn("degrading", F.col("recent") > F.col("oldest"))


def kpis(df: DataFrame) -> DataFrame:
    """One row: units by status and their percentage of the fleet."""
    names = {NORMAL: "normal", ALERTA: "alerta", ANORMAL: "anormal"}
    out = df.agg(F.count(F.lit(1)).alias("total_units"), *(F.count_if(F.col("overall_status") == s).alias(f"{n}_units") for s, n in names.items()), F.avg("priority_score").alias("mean_priority"))
    return out.withColumns({f"{n}_pct": F.when(F.col("total_units") > 0, 100.0 * F.col(f"{n}_units") / F.col("total_units")).otherwise(0.0) for n in names.values()})


def kpi_deltas(df: DataFrame, period: Sequence[str] = PERIOD) -> DataFrame:
    """Units in Anormal and Alerta in each period, and the change from the one before."""
    n = df.groupBy(*period).agg(F.count_if(F.col("overall_status") == ANORMAL).alias("anormal_units"), F.count_if(F.col("overall_status") == ALERTA).alias("alerta_units"))
    w = Window.orderBy(*period)  # one row a period
    return n.withColumns({f"{c}_delta": F.col(f"{c}_units") - F.lag(f"{c}_units").over(w) for c in ("anormal", "alerta")})


def boxplot(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = long.groupBy(*keys).agg(q.alias("q"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"), F.count(value).alias("n"))
    return out.select(*keys, "low", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "high", "mean", "n")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts of equal bins between the least and the greatest value; the last one holds its upper edge."""
    ends = df.agg(F.min(column).alias("__a"), F.max(column).alias("__b"))
    at = F.when(F.col("__b") > F.col("__a"), F.least(F.lit(bins - 1), F.floor((F.col(column) - F.col("__a")) / F.nullif(F.col("__b") - F.col("__a"), F.lit(0.0)) * bins))).otherwise(0)
    rows = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).withColumn("bin", at.cast("int"))
    out = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.first("__a").alias("a"), F.first("__b").alias("b"))
    return out.select("bin", (F.col("a") + F.col("bin") * (F.col("b") - F.col("a")) / bins).alias("low"), "n")


def summary(df: DataFrame, signals: Sequence[str]) -> DataFrame:
    """signal, n, mean, std, min, q1, median, q3, max."""
    made = [F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"), F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.max(c).cast("double").alias("max")).alias(c) for c in signals]
    long = df.agg(*made).unpivot([], list(signals), "signal", "x")
    return long.select("signal", "x.n", "x.mean", "x.std", "x.min", F.col("x.q")[0].alias("q1"), F.col("x.q")[1].alias("median"), F.col("x.q")[2].alias("q3"), "x.max")


def correlations(df: DataFrame, signals: Sequence[str]) -> DataFrame:
    """signal_a, signal_b, corr of each pair, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(signals) for b in signals[i + 1 :]]
    row = df.agg(*(F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    cells = F.explode(F.array(*(F.struct(F.lit(a).alias("signal_a"), F.lit(b).alias("signal_b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs))))
    return row.select(cells.alias("c")).select("c.*")


def run_summary(machine: DataFrame, components: DataFrame, period: Sequence[str] = PERIOD) -> DataFrame:
    """Status counts at both levels for each period, and SUCCESS, or ERROR where a level has nothing."""
    count = lambda c, pre: [F.count_if(F.col(c) == s).alias(f"{pre}_{s.lower()}") for s in STATUSES]
    m = machine.groupBy(*period).agg(F.count(F.lit(1)).alias("machines"), *count("overall_status", "machine"))
    c = components.groupBy(*period).agg(F.count(F.lit(1)).alias("components"), *count("component_status", "component"))
    out = m.join(c, list(period), "full_outer").na.fill(0)
    return out.withColumn("status", F.when((F.col("machines") > 0) & (F.col("components") > 0), "SUCCESS").otherwise("ERROR"))


def heatmap(rows: DataFrame, slot: Column, severity: str = "severity") -> DataFrame:
    """signal_name, slot, anomalies, readings, rate."""
    out = rows.groupBy("signal_name", slot.alias("slot")).agg(F.count_if(F.col(severity) > 0).alias("anomalies"), F.count(severity).alias("readings"))
    return out.withColumn("rate", F.when(F.col("readings") > 0, F.col("anomalies") / F.col("readings")).otherwise(0.0))


def data_profile(df: DataFrame, unit: str, ts: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(unit).alias("units"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def page(df: DataFrame, order: Sequence[Column | str], size: int, number: int = 0) -> DataFrame:
    """A page of a table in an order that leaves no ties."""
    return df.orderBy(*order).offset(size * number).limit(size)


def shuffled(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows in a random order that depends on the keys and the seed and not on how rows are partitioned."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)
