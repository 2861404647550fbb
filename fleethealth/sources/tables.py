"""The star-schema tables as telemetry, so that every operator can be run and checked on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.config import Component, ComponentMap

SIGNALS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
MAP = ComponentMap((Component("pricing", ("l_extendedprice", "l_discount"), "High"), Component("volume", ("l_quantity",), "Medium"), Component("fiscal", ("l_tax", "l_discount"), "Low")))
CUT = "2001-01-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: a unit for each supplier, states by return flag, four signals."""
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("Unit"), F.col("l_shipdate").alias("Fecha"), F.col("l_returnflag").alias("EstadoMaquina"), F.col("l_linestatus").alias("EstadoCarga"), *SIGNALS)


def cut() -> Column:
    return F.lit(CUT).cast("timestamp_ntz")


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).where(F.col("Fecha") < cut())


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).where(F.col("Fecha") >= cut())


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: a unit for each user, one reading at a time, signals ``value`` and ``k`` (from the JSON)."""
    return read(spark, sf_dir, "events").select(F.col("user_id").alias("Unit"), F.col("ts").alias("Fecha"), F.col("event_type").alias("EstadoMaquina"), "value", F.get_json_object("props", "$.k").cast("double").alias("k"), "event_id")
