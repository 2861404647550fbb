"""Regular grids, fills and interpolation, as window functions by unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethealth.config import Names


def grid(df: DataFrame, step: str = "1 minute", names: Names = Names()) -> DataFrame:
    """A row for each unit and step, from the unit's first reading to its last whole step."""
    bounds = df.groupBy(names.unit).agg(F.min(names.ts).alias("__a"), F.max(names.ts).alias("__b"))
    return bounds.select(names.unit, F.explode(F.sequence("__a", "__b", F.expr(f"INTERVAL {step}"))).alias(names.ts))


def on_grid(df: DataFrame, step: str = "1 minute", names: Names = Names(), snap: str | None = None) -> DataFrame:
    """Readings on the unit's grid, with created_by_reindex for steps that had none.

    Readings between steps are lost, unless ``snap`` names a unit of time that
    they are first rounded down to. Times must be distinct within a unit.
    """
    if snap:
        df = df.withColumn(names.ts, F.date_trunc(snap, names.ts).cast(dict(df.dtypes)[names.ts]))
    marked = df.withColumn("__there", F.lit(1))
    joined = grid(df, step, names).join(marked, [names.unit, names.ts], "left")
    return joined.withColumn("created_by_reindex", F.col("__there").isNull().cast("tinyint")).drop("__there")


def fill_both_ways(c: Column, keys: Sequence[str], ts: str) -> Column:
    """The last value before a null, else the first one after it."""
    return F.coalesce(last_known(c, keys, ts), next_known(c, keys, ts))


def last_known(c: Column, keys: Sequence[str], ts: str) -> Column:
    return F.last(c, True).over(Window.partitionBy(*keys).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0))


def next_known(c: Column, keys: Sequence[str], ts: str) -> Column:
    """Backwards in time, as a frame that grows is linear and one that shrinks is evaluated anew for each row."""
    return F.last(c, True).over(Window.partitionBy(*keys).orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, 0))


def interpolated(column: str, keys: Sequence[str], ts: str, limit: int) -> Column:
    """Straight lines in time between readings: the first ``limit`` nulls of a gap, and none before the first or after the last reading."""
    c, t = F.col(column), F.col(ts)  # __at numbers the rows of the keys by time
    known = F.when(c.isNotNull(), F.struct(c.cast("double").alias("v"), t.alias("t"), F.col("__at").alias("n")))
    before, after = last_known(known, keys, ts), next_known(known, keys, ts)
    micros = lambda a, b: F.timestamp_diff("MICROSECOND", a, b).cast("double")
    line = before["v"] + (after["v"] - before["v"]) * micros(before["t"], t) / micros(before["t"], after["t"])
    return F.when(c.isNotNull(), c.cast("double")).when(before.isNotNull() & after.isNotNull() & (F.col("__at") - before["n"] <= limit), line)


def interpolate(df: DataFrame, signals: Sequence[str], limit: int, keys: Sequence[str], ts: str) -> DataFrame:
    """Signals interpolated, with imputed_any and n_imputed_signals."""
    numbered = df.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(ts)))
    filled = numbered.withColumns({f"__i_{c}": interpolated(c, keys, ts, limit) for c in signals})
    new = [(F.col(c).isNull() & F.col(f"__i_{c}").isNotNull()).cast("int") for c in signals]
    total = sum(new[1:], new[0]) if new else F.lit(0)
    counted = filled.withColumn("n_imputed_signals", total.cast("smallint")).withColumn("imputed_any", (F.col("n_imputed_signals") > 0).cast("tinyint"))
    return counted.withColumns({c: F.col(f"__i_{c}") for c in signals}).drop("__at", *(f"__i_{c}" for c in signals))


def regular(df: DataFrame, signals: Sequence[str], categories: Sequence[str] = (), step: str = "1 minute", limit: int = 10, names: Names = Names()) -> DataFrame:
    """The grid with categories filled both ways, signals interpolated, lineage, and time_gap_min, which is the step."""
    out = on_grid(df, step, names)
    out = out.withColumns({c: fill_both_ways(F.col(c), [names.unit], names.ts) for c in categories})
    out = interpolate(out, signals, limit, [names.unit], names.ts)
    gap = F.timestamp_diff("MICROSECOND", F.lag(names.ts).over(Window.partitionBy(names.unit).orderBy(names.ts)), F.col(names.ts)) / 60e6
    return out.withColumn("time_gap_min", gap)


def impute_pairs(df: DataFrame, signals: Sequence[str], most_missing: float = 0.5, names: Names = Names()) -> DataFrame:
    """Fills each unit's signal both ways, but for those of which more than the share is missing; these become null."""
    w = Window.partitionBy(names.unit)
    share = {c: F.avg(F.col(c).isNull().cast("int")).over(w) for c in signals}
    return df.withColumns({c: F.when(share[c] <= most_missing, fill_both_ways(F.col(c), [names.unit], names.ts)) for c in signals})
