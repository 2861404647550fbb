"""Alerts: readings beyond their limits, narrow and wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# System and subsystem of a signal.
SYSTEMS = {
    "EngCoolTemp": ("Engine", "Cooling"),
    "EngOilPres": ("Engine", "Lubrication"),
    "EngSpd": ("Engine", "Combustion"),
    "TCOutTemp": ("Engine", "Turbocharger"),
    "TrnLubeTemp": ("Transmission", "Lubrication"),
    "TrnOilPres": ("Transmission", "Hydraulics"),
    "LtFBrkTemp": ("Brakes", "Friction"),
    "LtRBrkTemp": ("Brakes", "Friction"),
    "RtFBrkTemp": ("Brakes", "Friction"),
    "RtRBrkTemp": ("Brakes", "Friction"),
    "StrgOilTemp": ("Steering", "Hydraulics"),
    "StrgOilPres": ("Steering", "Hydraulics"),
    "DiffTemp": ("Differential", "Lubrication"),
    "DiffLubePres": ("Differential", "Lubrication"),
}


def narrow(scored: DataFrame, least: float = 3.0, systems: Mapping[str, tuple[str, str]] = SYSTEMS) -> DataFrame:
    """AlertID, Fecha, Unit, Trigger, System, SubSystem, value, upper, lower of each reading of at least the severity.

    The id is a hash of unit, signal and time, so that it doesn't depend on what
    else is alerted and two runs agree.
    """
    rows = scored.where(F.col("severity") >= least)
    table = rows.sparkSession.createDataFrame([(k, *v) for k, v in systems.items()] or [("", "", "")], "Trigger string, System string, SubSystem string")
    made = rows.select(F.xxhash64("unit_id", "signal_name", "ts").alias("AlertID"), F.col("ts").alias("Fecha"), F.col("unit_id").alias("Unit"), F.col("signal_name").alias("Trigger"), "value", F.col("P98").alias("upper"), F.col("P2").alias("lower"), F.col("state").alias("State"))
    return made.join(F.broadcast(table), "Trigger", "left").select("AlertID", "Fecha", "Unit", "Trigger", F.coalesce("System", F.lit("Unknown")).alias("System"), F.coalesce("SubSystem", F.lit("Unknown")).alias("SubSystem"), "value", "upper", "lower", "State")


def wide(alerts: DataFrame, scored: DataFrame, signals: Sequence[str]) -> DataFrame:
    """Each alert with value and limits of all signals that its unit had at that time; of repeated readings the highest counts."""
    at = scored.groupBy(F.col("unit_id").alias("Unit"), F.col("ts").alias("Fecha")).agg(
        *(F.max(F.when(F.col("signal_name") == s, F.col(source))).alias(f"{s}_{name}") for s in signals for source, name in (("value", "Value"), ("P98", "Upper_Limit"), ("P2", "Lower_Limit")))
    )
    return alerts.select("AlertID", "Unit", "Fecha", "Trigger", "State").join(at, ["Unit", "Fecha"]).withColumnRenamed("Fecha", "TimeStart")


def as_of(left: DataFrame, right: DataFrame, key: str, ts: str, columns: Sequence[str]) -> DataFrame:
    """The right side's columns at or before each left row's time, by one ordered pass over both sides together."""
    marked = left.withColumn("__left", F.lit(1)).unionByName(right.select(key, ts, *columns).withColumn("__left", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(ts, "__left").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(F.when(F.col("__left") == 0, F.struct(F.col(c).alias("v"))), True).over(w)["v"]
    return marked.withColumns({c: last(c) for c in columns}).where("__left = 1").drop("__left")


def counts(alerts: DataFrame, *keys: Column | str) -> DataFrame:
    return alerts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def per_month(alerts: DataFrame) -> DataFrame:
    return counts(alerts, F.date_format("Fecha", "yyyy-MM").alias("month"))


def unit_trigger_matrix(alerts: DataFrame, triggers: Sequence[str]) -> DataFrame:
    return alerts.groupBy("Unit").agg(*(F.count_if(F.col("Trigger") == t).alias(t) for t in triggers))
