"""From reconstruction errors to a health index, at the grain of signal, window and unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethealth.config import Health

# Categories of a health index from 0 to 100.
CATEGORIES = ((80.0, "Excellent"), (60.0, "Good"), (40.0, "Fair"), (20.0, "Poor"))


def errors(pairs: DataFrame) -> DataFrame:
    """Adds abs_error and squared_error to rows with y_true and y_pred."""
    d = F.col("y_true") - F.col("y_pred")
    return pairs.withColumns({"abs_error": F.abs(d), "squared_error": d * d})


def reconstruction_errors(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """mae, mse, rmse by the keys: a window's, or a window's and signal's."""
    out = errors(pairs).groupBy(*keys).agg(F.avg("abs_error").alias("mae"), F.avg("squared_error").alias("mse"))
    return out.withColumn("rmse", F.sqrt("mse"))


def error_stats(pairs: DataFrame, cfg: Health = Health()) -> DataFrame:
    """Reference statistics of each signal's absolute errors: p_low, p_high, mean, std, min, max, n."""
    q = F.percentile("abs_error", F.array(F.lit(cfg.percentile_low / 100), F.lit(cfg.percentile_high / 100)))
    out = errors(pairs).groupBy("signal").agg(q.alias("q"), F.avg("abs_error").alias("mean"), F.stddev_pop("abs_error").alias("std"), F.min("abs_error").alias("min"), F.max("abs_error").alias("max"), F.count("abs_error").alias("n"))
    return out.select("signal", F.col("q")[0].alias("p_low"), F.col("q")[1].alias("p_high"), "mean", "std", "min", "max", "n")


def normalised(error: Column, low: Column, high: Column, eps: float) -> Column:
    return F.greatest(F.lit(0.0), (error - low) / (high - low + F.lit(eps)))


def _over_time(c: Column, how: str) -> Column:
    made = {"mean": F.avg, "median": F.median, "max": F.max, "p95": lambda x: F.percentile(x, F.lit(0.95))}
    if how not in made:
        raise ValueError(f"time_agg {how}")
    return made[how](c)


def _over_signals(c: Column, how: str) -> Column:
    made = {"mean": F.avg, "rms": lambda x: F.sqrt(F.avg(x * x)), "max": F.max}
    if how not in made:
        raise ValueError(f"signal_agg {how}")
    return made[how](c)


def _over_windows(c: Column, how: str) -> Column:
    made = {"mean": F.avg, "median": F.median, "min": F.min, "p10": lambda x: F.percentile(x, F.lit(0.1))}
    if how not in made:
        raise ValueError(f"unit_agg {how}")
    return made[how](c)


def signal_scores(pairs: DataFrame, stats: DataFrame, keys: Sequence[str], cfg: Health = Health()) -> DataFrame:
    """Raw and normalised error of each window's signal; a signal whose limits coincide is an error."""
    limits = stats.select("signal", "p_low", F.when(F.col("p_high") > F.col("p_low"), F.col("p_high")).otherwise(F.raise_error(F.concat(F.lit("error limits coincide: "), F.col("signal"))).cast("double")).alias("p_high"))
    rows = errors(pairs).join(F.broadcast(limits), "signal")
    rows = rows.withColumn("norm_error", normalised(F.col("abs_error"), F.col("p_low"), F.col("p_high"), cfg.eps))
    return rows.groupBy(*keys, "signal").agg(_over_time(F.col("abs_error"), cfg.time_agg).alias("recon_error_raw"), _over_time(F.col("norm_error"), cfg.time_agg).alias("recon_error_norm"), F.first("p_low").alias("p_low_ref"), F.first("p_high").alias("p_high_ref"), F.count(F.lit(1)).alias("window_size"))


def window_scores(signals: DataFrame, keys: Sequence[str], cfg: Health = Health()) -> DataFrame:
    out = signals.groupBy(*keys).agg(
        _over_signals(F.col("recon_error_raw"), cfg.signal_agg).alias("reconstruction_error_raw"),
        _over_signals(F.col("recon_error_norm"), cfg.signal_agg).alias("reconstruction_error_score"),
        F.count(F.lit(1)).alias("n_signals"),
        F.max("window_size").alias("window_size"),
    )
    return out.withColumn("health_index", F.exp(-cfg.alpha * F.col("reconstruction_error_score")))


def unit_scores(windows: DataFrame, unit: str = "Unit", cfg: Health = Health()) -> DataFrame:
    return windows.groupBy(unit).agg(
        _over_windows(F.col("health_index"), cfg.unit_agg).alias("health_index"),
        _over_windows(F.col("reconstruction_error_score"), cfg.unit_agg).alias("reconstruction_error"),
        F.count("health_index").alias("n_windows"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
    )


def percent_scale(index: Column) -> Column:
    return 100.0 * index


def category(index_percent: Column) -> Column:
    out = F.when(index_percent.isNull(), F.lit(None).cast("string"))
    for limit, name in CATEGORIES:
        out = out.when(index_percent >= limit, name)
    return out.otherwise("Critical")


def consolidated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of the list that are there, in its order."""
    return df.select(*(c for c in columns if c in df.columns))


def trend(windows: DataFrame, unit: str = "Unit", flat: float = 1e-3) -> DataFrame:
    """slope of the health index over days, and which way it goes."""
    days = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("start_time").cast("timestamp_ntz")) / 86_400e6
    out = windows.groupBy(unit).agg(F.regr_slope(F.col("health_index"), days).alias("slope"))
    return out.withColumn("direction", F.when(F.col("slope") > flat, "improving").when(F.col("slope") < -flat, "degrading").otherwise("stable"))
