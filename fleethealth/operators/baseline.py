"""Percentile baselines by unit, signal and state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethealth.config import PERCENTILES, Names
from fleethealth.functions.values import finite

ALL = "All"
LIMITS = ("P2", "P5", "P95", "P98")


def _percentiles(df: DataFrame, keys: Sequence[str], signals: Sequence[str]) -> DataFrame:
    """Exact percentiles and counts of every signal in one aggregation on the keys; rows are spread by signal only afterwards."""
    wide = df.groupBy(*keys).agg(*(F.struct(F.percentile(finite(F.col(c)), F.array(*(F.lit(p) for p in PERCENTILES))).alias("p"), F.count(finite(F.col(c))).alias("n")).alias(c) for c in signals))
    long = wide.unpivot(list(keys), list(signals), "Signal", "x")
    return long.select(*keys, "Signal", *(F.col("x.p")[i].alias(c) for i, c in enumerate(LIMITS)), F.col("x.n").alias("sample_count"))


def baselines(training: DataFrame, signals: Sequence[str], version: str, min_samples: int = 100, names: Names = Names()) -> DataFrame:
    """Unit, Signal, EstadoMaquina, P2, P5, P95, P98, sample_count, baseline_version.

    A state counts from ``min_samples`` non-null readings on; a unit's signal
    without any such state is taken over all states, as ``All``, if that is
    enough. Readings without a state count there only. An empty table gives an
    empty one.
    """
    keys = [names.unit, names.state]
    own = _percentiles(training.where(F.col(names.state).isNotNull()), keys, signals).where(F.col("sample_count") >= min_samples)
    rest = _percentiles(training, [names.unit], signals).where(F.col("sample_count") >= min_samples)
    rest = rest.join(own.select(names.unit, "Signal").distinct(), [names.unit, "Signal"], "left_anti").withColumn(names.state, F.lit(ALL))
    both = own.unionByName(rest)
    return both.select(F.col(names.unit).alias("Unit"), "Signal", F.col(names.state).alias("EstadoMaquina"), *LIMITS, "sample_count").withColumn("baseline_version", F.lit(version))


def first_seen(training: DataFrame, names: Names = Names()) -> DataFrame:
    """When each unit was first in each state, over all its rows."""
    return training.where(F.col(names.state).isNotNull()).groupBy(F.col(names.unit).alias("Unit"), F.col(names.state).alias("EstadoMaquina")).agg(F.min(names.ts).alias("first_seen"))


def picked(base: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """One baseline for each unit and signal: ``All`` if there is one, else that of the state seen first (by name, without ``seen``)."""
    if seen is not None:
        base = base.join(seen, ["Unit", "EstadoMaquina"], "left")
        order = F.struct((F.col("EstadoMaquina") != ALL).alias("a"), F.col("first_seen").isNull().alias("b"), F.col("first_seen").alias("c"), F.col("EstadoMaquina").alias("d"))
    else:
        order = F.struct((F.col("EstadoMaquina") != ALL).alias("a"), F.col("EstadoMaquina").alias("d"))
    row = F.min_by(F.struct("EstadoMaquina", *LIMITS, "sample_count"), order)
    return base.groupBy("Unit", "Signal").agg(row.alias("b")).select("Unit", "Signal", "b.*")


def metadata(base: DataFrame) -> DataFrame:
    """One row of counts: baselines, units, signals, those of a state and those over all states."""
    return base.agg(
        F.count(F.lit(1)).alias("total_baselines"),
        F.countDistinct("Unit").alias("units"),
        F.countDistinct("Signal").alias("signals"),
        F.count_if(F.col("EstadoMaquina") != ALL).alias("state_specific"),
        F.count_if(F.col("EstadoMaquina") == ALL).alias("aggregated"),
    )


def shifts(new: DataFrame, old: DataFrame, limit: float = 0.2) -> DataFrame:
    """Baselines old and new side by side: the relative change of P2 and P98, and whether one is above the limit or a side is missing."""
    keys = ["Unit", "Signal", "EstadoMaquina"]
    both = new.select(*keys, F.col("P2").alias("new_p2"), F.col("P98").alias("new_p98")).join(old.select(*keys, F.col("P2").alias("old_p2"), F.col("P98").alias("old_p98")), keys, "full_outer")
    change = lambda p: F.abs(F.col(f"new_{p}") - F.col(f"old_{p}")) / F.nullif(F.abs(F.col(f"old_{p}")), F.lit(0.0))
    return both.withColumns({"p2_change": change("p2"), "p98_change": change("p98")}).withColumn("flagged", F.coalesce(F.greatest("p2_change", "p98_change") > limit, F.lit(True)))
