"""Readings against baselines, and signals over a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethealth.config import ALERTA, ANORMAL, INSUFFICIENT, NORMAL, ComponentMap, Names, Scoring
from fleethealth.functions.values import finite, percent
from fleethealth.operators.baseline import ALL, LIMITS, picked

UNKNOWN = "Unknown"


def severity(v: Column, p2: Column, p5: Column, p95: Column, p98: Column) -> Column:
    """0 within [P5, P95], 1 out to P2 and P98, 3 beyond; null for a null reading."""
    return F.when(v.between(p5, p95), 0.0).when(((v >= p2) & (v < p5)) | ((v > p95) & (v <= p98)), 1.0).when((v < p2) | (v > p98), 3.0)


def signal_status(score: Column, cfg: Scoring = Scoring()) -> Column:
    return F.when(score.isNull(), INSUFFICIENT).when(score >= cfg.signal_anormal, ANORMAL).when(score >= cfg.signal_alerta, ALERTA).otherwise(NORMAL)


def long_form(df: DataFrame, signals: Sequence[str], names: Names = Names(), keep: Sequence[str] = ()) -> DataFrame:
    """unit_id, state, ts, signal_name, value, and the columns to keep; one row for each reading of each signal, nulls too."""
    wide = df.select(F.col(names.unit).alias("unit_id"), F.col(names.state).alias("state"), F.col(names.ts).alias("ts"), *keep, *(finite(F.col(c)).alias(c) for c in signals))
    return wide.unpivot(["unit_id", "state", "ts", *keep], list(signals), "signal_name", "value")


def component_of(mapping: ComponentMap, df: DataFrame) -> DataFrame:
    """signal_name and the last component that lists it."""
    last = {s: c.name for c in mapping.components for s in c.signals}
    return df.sparkSession.createDataFrame(list(last.items()), "signal_name string, component string")


def scored_readings(current: DataFrame, base: DataFrame, signals: Sequence[str], names: Names = Names(), seen: DataFrame | None = None, by_state: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Each reading with its limits and its severity.

    One baseline counts for all readings of a unit's signal; by state, the
    reading's own state has precedence over it. Signals without a baseline drop out.
    """
    pick = picked(base, seen).select(F.col("Unit").alias("unit_id"), F.col("Signal").alias("signal_name"), *LIMITS)
    rows = long_form(current, signals, names, keep).join(pick, ["unit_id", "signal_name"])
    if by_state:
        own = base.where(F.col("EstadoMaquina") != ALL).select(F.col("Unit").alias("unit_id"), F.col("Signal").alias("signal_name"), F.col("EstadoMaquina").alias("state"), *(F.col(c).alias(f"own_{c}") for c in LIMITS))
        rows = rows.join(own, ["unit_id", "signal_name", "state"], "left").withColumns({c: F.when(F.col("own_P2").isNotNull(), F.col(f"own_{c}")).otherwise(F.col(c)) for c in LIMITS}).drop(*(f"own_{c}" for c in LIMITS))
    return rows.withColumn("severity", severity(F.col("value"), *(F.col(c) for c in LIMITS)))


def evaluate_signals(current: DataFrame, base: DataFrame, signals: Sequence[str], mapping: ComponentMap, names: Names = Names(), seen: DataFrame | None = None, by_state: bool = False, cfg: Scoring = Scoring(), by: Sequence[str] = ()) -> DataFrame:
    """A row for each unit and signal (and period, the columns ``by``): window score, status, counts and limits.

    A signal whose readings are all null is InsufficientData; one without a
    baseline is left out. Without readings there are no rows. The limits of
    readings scored by state are the lowest and highest of the states.
    """
    rows = scored_readings(current, base, signals, names, seen, by_state, by)
    low, high = (F.min, F.max)
    sums = rows.groupBy("unit_id", "signal_name", *by).agg(
        F.avg("severity").alias("window_score_normalized"),
        F.count("severity").alias("sample_count"),
        F.count_if(F.col("severity") > 0).alias("anomaly_count"),
        F.max("severity").alias("max_score"),
        F.count(F.lit(1)).alias("reading_count"),
        low("P2").alias("p2"),
        low("P5").alias("p5"),
        high("P95").alias("p95"),
        high("P98").alias("p98"),
    )
    named = sums.join(F.broadcast(component_of(mapping, current)), "signal_name", "left").withColumn("component", F.coalesce("component", F.lit(UNKNOWN)))
    return named.withColumns({"signal_status": signal_status(F.col("window_score_normalized"), cfg), "anomaly_percentage": percent(F.col("anomaly_count"), F.col("sample_count"))})


def observed(current: DataFrame, signals: Sequence[str], names: Names = Names()) -> DataFrame:
    """What each unit's signals were: least, greatest, mean, over non-null readings."""
    return long_form(current, signals, names).groupBy("unit_id", "signal_name").agg(F.min("value").alias("observed_min"), F.max("value").alias("observed_max"), F.avg("value").alias("observed_mean"))


def blended(percentile_score: Column, model_score: Column, weight: float = 0.6) -> Column:
    return weight * percentile_score + (1 - weight) * model_score


def model_status(mse: Column, alerta: float = 0.01, anormal: float = 0.05) -> Column:
    return F.when(mse.isNull(), INSUFFICIENT).when(mse >= anormal, ANORMAL).when(mse >= alerta, ALERTA).otherwise(NORMAL)
