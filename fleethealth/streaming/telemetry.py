"""Telemetry as a stream: deduplicated, scored against a fixed baseline, summed by window, merged into histories."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fleethealth.config import ComponentMap, Names, Scoring
from fleethealth.functions.values import percent
from fleethealth.operators.baseline import picked
from fleethealth.operators.scoring import LIMITS, component_of, long_form, severity, signal_status
from fleethealth.sources.writers import upsert


def source(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    """Files as they come into a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def deduplicated(df: DataFrame, delay: str = "10 minutes", names: Names = Names()) -> DataFrame:
    """One reading for each unit and time; state is kept for the delay only."""
    return df.withWatermark(names.ts, delay).dropDuplicatesWithinWatermark([names.unit, names.ts])


def window_scores(df: DataFrame, base: DataFrame, signals: Sequence[str], mapping: ComponentMap, size: str = "60 minutes", slide: str | None = None, delay: str = "10 minutes", names: Names = Names(), cfg: Scoring = Scoring()) -> DataFrame:
    """Window score and status of each unit's signal by clock windows; rows later than the delay are dropped here and left to the batch merge."""
    pick = picked(base).select(F.col("Unit").alias("unit_id"), F.col("Signal").alias("signal_name"), *LIMITS)
    rows = long_form(df, signals, names).withWatermark("ts", delay).join(F.broadcast(pick), ["unit_id", "signal_name"])
    rows = rows.withColumn("severity", severity(F.col("value"), *(F.col(c) for c in LIMITS)))
    sums = rows.groupBy("unit_id", "signal_name", F.window("ts", size, slide or size).alias("w")).agg(F.avg("severity").alias("window_score_normalized"), F.count("severity").alias("sample_count"), F.count_if(F.col("severity") > 0).alias("anomaly_count"))
    named = sums.join(F.broadcast(component_of(mapping, base)), "signal_name", "left").withColumn("component", F.coalesce("component", F.lit("Unknown")))
    return named.select("unit_id", "signal_name", "component", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "window_score_normalized", "sample_count", "anomaly_count", percent(F.col("anomaly_count"), F.col("sample_count")).alias("anomaly_percentage"), signal_status(F.col("window_score_normalized"), cfg).alias("signal_status"))


def sessions(df: DataFrame, gap: str = "5 minutes", delay: str = "10 minutes", names: Names = Names()) -> DataFrame:
    """Runs of a unit's readings without a gap as long as this."""
    out = df.withWatermark(names.ts, delay).groupBy(names.unit, F.session_window(names.ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n_rows"))
    return out.select(names.unit, F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"), "n_rows")


def transitions(statuses: DataFrame) -> DataFrame:
    """unit_id, previous_status, overall_status, at: changes of status, by a state of one string a unit; within a batch rows are taken in the order of ``at``."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def of(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        rows = pd.concat(list(frames)).sort_values(["at", "overall_status"])
        for status, at in zip(rows["overall_status"], rows["at"]):
            if last is not None and status != last:
                out.append((key[0], last, status, at))
            last = status
        state.update((last,))
        yield pd.DataFrame(out, columns=["unit_id", "previous_status", "overall_status", "at"])

    return statuses.groupBy("unit_id").applyInPandasWithState(of, "unit_id string, previous_status string, overall_status string, at timestamp", "last string", "append", GroupStateTimeout.NoTimeout)


def merge_into(df: DataFrame, path: str, key: Sequence[str], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> StreamingQuery:
    """Merges each batch into a history, one row a key; a batch that runs twice changes nothing."""
    return df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, _: upsert(prepare(batch), path, key)).start()
