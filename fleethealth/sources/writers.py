"""Sinks: baselines, histories that are kept one row a key, JSON and CSV."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleethealth.operators.baseline import metadata
from fleethealth.sources.readers import _fs, recovered

MACHINE_KEY = ("unit_id", "evaluation_week", "evaluation_year")
COMPONENT_KEY = ("unit_id", "component", "evaluation_week", "evaluation_year")


def save_baseline(base: DataFrame, folder: str) -> None:
    """A partition for each version; writing a version again replaces it alone."""
    base.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("baseline_version").parquet(folder)


def merged(old: DataFrame | None, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old and new rows, of a key the newest batch's; of repeated keys within a batch the last by all plain columns, then by the JSON of the others."""
    new = new.withColumn("__batch", F.lit(1))
    both = new if old is None else old.withColumn("__batch", F.lit(0)).unionByName(new, allowMissingColumns=True)
    plain = [c for c, kind in both.dtypes if not kind.startswith(("map", "array", "struct")) and c not in key and c != "__batch"]
    nested = [F.to_json(F.struct(c)).desc() for c, _ in both.dtypes if c not in plain and c not in key and c != "__batch"]
    order = Window.partitionBy(*key).orderBy(F.desc("__batch"), *(F.desc(c) for c in plain), *nested)
    return both.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank", "__batch")


def swap(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Writes beside the path, then puts it in its place, so that df may read from the path.

    A crash between the two renames leaves the history aside and the new one
    complete; ``readers.recovered``, which every upsert and ``readers.history``
    begin with, puts it in place. One writer at a time.
    """
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{beside}.new") if partition_by else df.write.parquet(f"{beside}.new")
    p, fs = _fs(spark, path)
    q, _ = _fs(spark, f"{beside}.new")
    if fs.exists(p):
        old, _ = _fs(spark, f"{beside}.old")
        fs.rename(p, old)
        fs.rename(q, p)
        fs.delete(old, True)
    else:
        fs.mkdirs(p.getParent())
        fs.rename(q, p)


def upsert(new: DataFrame, path: str, key: Sequence[str]) -> None:
    """Merges a batch into a history; doing it twice changes nothing. Sorted within partitions by the key's order."""
    spark = new.sparkSession
    old = spark.read.parquet(path) if recovered(spark, path) else None
    swap(spark, merged(old, new, key).sortWithinPartitions(*key), path)


def save_forecast(made: DataFrame, path: str, version: str) -> None:
    """A forecast as a partition of its version; writing a version again replaces it alone."""
    made.withColumn("forecast_version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("forecast_version").parquet(path)


def upsert_machines(new: DataFrame, path: str) -> None:
    upsert(new, path, MACHINE_KEY)


def upsert_components(new: DataFrame, path: str) -> None:
    upsert(new, path, COMPONENT_KEY)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text file, in any store that Spark writes to."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_json(spark: SparkSession, value, path: str) -> None:
    write_text(spark, json.dumps(value, indent=2, default=str), path)


def baseline_metadata(base: DataFrame, path: str, **extra) -> dict:
    """Counts of a baseline as JSON, with whatever else is given."""
    held = {**metadata(base).first().asDict(), **extra}
    write_json(base.sparkSession, held, path)
    return held


def export_columns(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """The columns of the list that are there."""
    df.select(*(c for c in columns if c in df.columns)).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV with a header, for reports that people open."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
