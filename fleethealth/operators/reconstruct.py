"""Reconstruction of signals; the health index takes whatever a reconstructor gives."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Reconstructor(Protocol):
    def fit(self, train: DataFrame) -> Reconstructor: ...

    def reconstruct(self, df: DataFrame) -> DataFrame: ...


class MeanReconstructor:
    """Each reading from its unit's mean in the training data, else the signal's mean over all units; rows are unit, signal, y_true."""

    def __init__(self, unit: str = "Unit") -> None:
        self.unit = unit

    def fit(self, train: DataFrame) -> MeanReconstructor:
        self.by_unit = train.groupBy(self.unit, "signal").agg(F.avg("y_true").alias("__own"))
        self.overall = train.groupBy("signal").agg(F.avg("y_true").alias("__all"))
        return self

    def reconstruct(self, df: DataFrame) -> DataFrame:
        joined = df.join(self.by_unit, [self.unit, "signal"], "left").join(F.broadcast(self.overall), "signal", "left")
        return joined.withColumn("y_pred", F.coalesce("__own", "__all")).drop("__own", "__all")


class PCAReconstructor:
    """A linear autoencoder over flattened windows: projection on the leading components and back.

    Rows hold ``x``, an array of arrays of numbers, all of one shape; ``x_pred`` is added.
    """

    def __init__(self, k: int = 8) -> None:
        self.k = k

    def fit(self, train: DataFrame) -> PCAReconstructor:
        """Second moments are summed on the executors; a matrix of (steps x signals) squared comes to the driver."""

        def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n, s, ss = 0, None, None
            for frame in frames:
                if len(frame):
                    x = np.stack([np.concatenate([np.asarray(r, dtype=np.float64) for r in rows]) for rows in frame["x"]])
                    n += len(x)
                    s = x.sum(axis=0) if s is None else s + x.sum(axis=0)
                    ss = x.T @ x if ss is None else ss + x.T @ x
            if n:
                yield pd.DataFrame({"n": [n], "s": [s.tolist()], "ss": [ss.ravel().tolist()]})

        rows = train.select("x").mapInPandas(moments, "n long, s array<double>, ss array<double>")
        n, s, ss = 0, 0.0, 0.0
        for r in rows.toLocalIterator():
            n, s, ss = n + r.n, s + np.array(r.s), ss + np.array(r.ss)
        if not n:
            raise ValueError("no window to fit on")
        self.mean = s / n
        cov = ss.reshape(len(self.mean), -1) / n - np.outer(self.mean, self.mean)
        values, vectors = np.linalg.eigh(cov)
        self.axes = vectors[:, np.argsort(values)[::-1][: min(self.k, len(values))]]
        return self

    def reconstruct(self, df: DataFrame) -> DataFrame:
        mean, axes = self.mean, self.axes

        def of(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            flat = np.stack([np.concatenate([np.asarray(r, dtype=np.float64) for r in rows]) for rows in x])
            back = mean + (flat - mean) @ axes @ axes.T
            return pd.Series([b.reshape(len(rows), -1).tolist() for b, rows in zip(back, x)])

        return df.withColumn("x_pred", F.pandas_udf(of, "array<array<double>>")("x"))


def exploded(df: DataFrame, keys: Sequence[str], signals: Sequence[str]) -> DataFrame:
    """Rows (keys, step, signal, y_true, y_pred) of windows with x and x_pred."""
    steps = df.select(*keys, F.posexplode(F.arrays_zip("x", "x_pred")).alias("step", "r"))
    cells = F.explode(F.array(*(F.struct(F.lit(s).alias("signal"), F.col("r.x")[i].cast("double").alias("y_true"), F.col("r.x_pred")[i].alias("y_pred")) for i, s in enumerate(signals))))
    return steps.select(*keys, "step", cells.alias("c")).select(*keys, "step", "c.*")


def time_split(df: DataFrame, ts: str, weeks: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train and test: before and from ``weeks`` before the last time of all units."""
    last = df.agg(F.max(ts).alias("__last"))
    cut = F.col("__last") - F.make_dt_interval(F.lit(7 * weeks))
    marked = df.crossJoin(F.broadcast(last)).withColumn("__test", F.col(ts) >= cut)
    return marked.where(~F.col("__test")).select(*df.columns), marked.where("__test").select(*df.columns)


#: Microseconds of an hour and of a day.
HOUR, DAY = 3_600_000_000, 86_400_000_000
#: Fixed value: a normal variable lies within so many deviations with a probability of 0.8.
BAND = 1.2815515655446004


def _hour_of(us: Column) -> Column:
    """Hour of day, from whole microseconds: a fraction of days would be off by one on the hour."""
    return F.floor(F.pmod(us, F.lit(DAY)) / HOUR).cast("int")


def forecast(df: DataFrame, unit: str, signal: str, ts: str, horizon_days: int = 7, min_points: int = 100) -> DataFrame:
    """A straight line through each unit's readings and its hour-of-day means, carried on by the hour for ``horizon_days``.

    Gives unit, step (hours after the last reading), forecast, lower and upper,
    between which 0.8 of normal residuals lie. Null readings don't count; units
    of fewer points are left out; an hour of day without a reading has no mean.
    """
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    rows = df.where(F.col(signal).isNotNull()).select(unit, F.col(signal).alias("__y"), us.alias("__us")).withColumns({"__t": F.col("__us") / DAY, "__h": _hour_of(F.col("__us"))})
    line = rows.groupBy(unit).agg(F.regr_slope("__y", "__t").alias("slope"), F.regr_intercept("__y", "__t").alias("level"), F.max("__us").alias("last"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_points)
    left = F.col("__y") - (F.col("slope") * F.col("__t") + F.col("level"))
    season = rows.join(line, unit).groupBy(unit, "__h").agg(F.avg(left).alias("season"), (F.var_pop(left) * F.count(F.lit(1))).alias("squares"))
    spread = season.groupBy(unit).agg(F.sum("squares").alias("squares"))
    steps = line.join(spread, unit).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon_days * 24)))).withColumn("__us", F.col("last") + F.col("step").cast("long") * HOUR)
    made = steps.withColumn("__h", _hour_of(F.col("__us"))).join(season.select(unit, "__h", "season"), [unit, "__h"], "left")
    mean = F.col("slope") * (F.col("__us") / DAY) + F.col("level") + F.coalesce("season", F.lit(0.0))
    width = BAND * F.sqrt(F.col("squares") / F.col("n"))
    return made.select(unit, "step", mean.alias("forecast"), (mean - width).alias("lower"), (mean + width).alias("upper"))


def forecast_status(made: DataFrame, limits: DataFrame, unit: str) -> DataFrame:
    """Means of a forecast and of its band, and predicted_status: Alerta outside the unit's P5 to P95, else Normal.

    limits: unit, P5, P95, one row a unit; without one the status is InsufficientData.
    """
    means = made.groupBy(unit).agg(*(F.avg(c).alias(f"forecast_{n}") for c, n in (("forecast", "mean"), ("lower", "lower"), ("upper", "upper"))))
    m = F.col("forecast_mean")
    status = F.when(F.col("P5").isNull() | F.col("P95").isNull(), "InsufficientData").when((m < F.col("P5")) | (m > F.col("P95")), "Alerta").otherwise("Normal")
    return means.join(limits.select(unit, "P5", "P95"), unit, "left").withColumn("predicted_status", status).drop("P5", "P95")
