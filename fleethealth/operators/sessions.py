"""Operating cycles: runs of readings without a long gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethealth.config import Names
from fleethealth.functions.values import right_closed
from fleethealth.operators.resample import interpolate

# Edges and labels of the bins.
ACCELERATION = ((-1.5, -0.5, 0.5, 1.5), ("High Deceleration", "Moderate Deceleration", "Flat", "Moderate Acceleration", "High Acceleration"))
ELEVATION = ((-10, -5, 5, 10), ("Steep Downhill", "Downhill", "Flat", "Uphill", "Steep Uphill"))

MINUTE = 60_000_000


def numbered(df: DataFrame, gap_minutes: float = 5, names: Names = Names()) -> DataFrame:
    """Adds cycle_id: 1 for a unit's first reading, one more after each gap above the limit."""
    w = Window.partitionBy(names.unit).orderBy(names.ts)
    gap = F.timestamp_diff("MICROSECOND", F.lag(names.ts).over(w), F.col(names.ts))
    fresh = F.when(gap.isNull() | (gap > int(gap_minutes * MINUTE)), 1).otherwise(0)
    return df.withColumn("__new", fresh).withColumn("cycle_id", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def summary(cycles: DataFrame, names: Names = Names()) -> DataFrame:
    """start, end, n_rows, duration_min and coverage of each cycle; coverage is rows over the minutes, rounded half to even, and one."""
    out = cycles.groupBy(names.unit, "cycle_id").agg(F.min(names.ts).alias("start_time"), F.max(names.ts).alias("end_time"), F.count(F.lit(1)).alias("n_rows"))
    minutes = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / float(MINUTE)
    return out.withColumn("duration_min", minutes).withColumn("coverage", F.col("n_rows") / (F.bround("duration_min", 0) + 1))


def valid(cycles: DataFrame, min_minutes: float = 120, min_coverage: float = 0.8, names: Names = Names()) -> DataFrame:
    """Readings of the cycles that last and are dense enough."""
    good = summary(cycles, names).where((F.col("duration_min") >= min_minutes) & (F.col("coverage") >= min_coverage))
    return cycles.join(good.select(names.unit, "cycle_id"), [names.unit, "cycle_id"], "left_semi")


def interpolated(cycles: DataFrame, signals: Sequence[str], limit: int = 20, names: Names = Names()) -> DataFrame:
    return interpolate(cycles, signals, limit, [names.unit, "cycle_id"], names.ts)


def diff(column: str, names: Names = Names()) -> Column:
    return F.col(column) - F.lag(column).over(Window.partitionBy(names.unit, "cycle_id").orderBy(names.ts))


def movements(cycles: DataFrame, speed: str = "GroundSpd", elevation: str = "GPSElevation", temperatures: Sequence[str] = (), names: Names = Names()) -> DataFrame:
    """Differences from reading to reading within a cycle, and the bins of acceleration and climb."""
    out = cycles.withColumns({"GroundAcc": diff(speed, names), "ElevationChange": diff(elevation, names), **{f"{c}_diff": diff(c, names) for c in temperatures}})
    return out.withColumns({"GroundAccCategorical": right_closed(F.col("GroundAcc"), *ACCELERATION), "ElevationChangeCategorical": right_closed(F.col("ElevationChange"), *ELEVATION)})


def group_means(df: DataFrame, keys: Sequence[str], value: str, top: int = 15) -> DataFrame:
    """count, mean and sample deviation of a value by the keys, the largest groups first."""
    stats = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return stats.orderBy(F.desc("n"), *keys).limit(top)


def labelled(cycles: DataFrame, outside_share: Column, limit: float = 0.05) -> DataFrame:
    """``cycle_label``: Anomalous if more than the share of a cycle's readings lies outside P5 to P95."""
    return cycles.withColumn("cycle_label", F.when(outside_share > limit, "Anomalous").otherwise("Normal"))
