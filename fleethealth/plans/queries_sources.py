"""Queries that write what a weekly run writes and read it back: sources, sinks, the expected fleet and reconstruction."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fleethealth.operators import baseline, clean, health, reconstruct, reports, rollup
from fleethealth.plans import health_index
from fleethealth.plans.queries_series import PAIRS, SER, pairs, series
from fleethealth.plans.queries_telemetry import BY, PERIOD, TEL, base_sql, machines, machines_sql
from fleethealth.plans.registry import query
from fleethealth.sources import readers, writers
from fleethealth.sources import tables as t


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share; a local session without one gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="fleethealth-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/fleethealth-core/{name}-{uuid.uuid4().hex}"


def silver(spark, d, weeks: tuple[tuple[int, int], ...]) -> str:
    """A folder of weekly files of the telemetry, as a fleet's collector leaves it."""
    folder = scratch(spark, "silver")
    rows = t.telemetry(spark, d)
    for year, week in weeks:
        monday = readers.week_monday(year, week)
        own = rows.where((F.col("Fecha") >= F.lit(str(monday)).cast("timestamp_ntz")) & (F.col("Fecha") < F.date_add(F.lit(str(monday)).cast("date"), 7).cast("timestamp_ntz")))
        own.write.parquet(f"{folder}/{readers.WEEK_FILE.format(week=week, year=year)}")
    return folder


WEEKS = ((1998, 9), (1998, 10), (1998, 11), (1998, 12), (1998, 13))


@query("read_week", f"WITH {TEL} SELECT Unit, count(*) AS n, min(Fecha) AS first_time, max(Fecha) AS last_time, round(sum(l_quantity), 4) AS total FROM t WHERE Fecha >= TIMESTAMP '1998-03-30' AND Fecha < TIMESTAMP '1998-04-06' GROUP BY Unit")
def read_week(spark, d):
    """One week's file (S1): week 13 of 1998 begins on 30 March."""
    rows = readers.evaluation_week(spark, silver(spark, d, WEEKS[-1:]), *WEEKS[-1])
    return rows.groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.min("Fecha").alias("first_time"), F.max("Fecha").alias("last_time"), F.round(F.sum("l_quantity"), 4).alias("total"))


@query("read_history", f"WITH {TEL} SELECT CAST(Fecha AS DATE) AS day, count(*) AS n, count(DISTINCT Unit) AS units FROM t WHERE Fecha >= TIMESTAMP '1998-03-09' AND Fecha <= TIMESTAMP '1998-03-29' GROUP BY ALL")
def read_history(spark, d):
    """The days before a week out of weekly files (S2): three weeks before 30 March, to the Sunday's first moment."""
    rows = readers.baseline_window(spark, silver(spark, d, WEEKS), 1998, 13, 21)
    return rows.groupBy(F.to_date("Fecha").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("Unit").alias("units"))


@query("read_all_weeks", f"WITH {TEL} SELECT strftime(Fecha, '%Y') AS year, CAST(strftime(Fecha, '%W') AS INTEGER) AS week, count(*) AS n FROM t WHERE Fecha >= TIMESTAMP '1998-03-02' AND Fecha < TIMESTAMP '1998-04-06' GROUP BY ALL")
def read_all_weeks(spark, d):
    """All weekly files of a folder (S5), year and week by their names."""
    rows = readers.all_weeks(spark, silver(spark, d, WEEKS))
    return rows.groupBy(F.col("file_year").cast("string").alias("year"), F.col("file_week").alias("week")).agg(F.count(F.lit(1)).alias("n"))


@query("previous_weeks", f"WITH {machines_sql(BY)} SELECT printf('W%02d-%d', evaluation_week, evaluation_year) AS week_label, evaluation_week = 20 AS is_current, count(*) AS n FROM mach WHERE evaluation_year = 2001 AND evaluation_week BETWEEN 17 AND 20 GROUP BY ALL")
def previous_weeks(spark, d):
    """A week of a history and those before it (S3)."""
    history = machines(spark, d, PERIOD)
    rows = readers.previous_weeks(history, 2001, 20, 3, "evaluation_year", "evaluation_week")
    return rows.groupBy("week_label", "is_current").agg(F.count(F.lit(1)).alias("n"))


BASE_COLUMNS = ("P2", "P5", "P95", "P98")


@query("baseline_saved", f"WITH {base_sql(100)} SELECT Unit, Signal, EstadoMaquina, {', '.join(f'round({c}, 6) AS {c}' for c in BASE_COLUMNS)}, sample_count, '20010101' AS baseline_version FROM base")
def baseline_saved(spark, d):
    """A baseline that is written twice, beside an older version, and loaded as the newest one (K1, S7)."""
    folder = scratch(spark, "baselines")
    base = baseline.baselines(t.training(spark, d), t.SIGNALS, "20010101")
    writers.save_baseline(base.withColumn("baseline_version", F.lit("20001225")), folder)
    writers.save_baseline(base, folder)
    writers.save_baseline(base, folder)
    out = readers.load_baseline(spark, folder)
    return out.select("Unit", "Signal", "EstadoMaquina", *(F.round(c, 6).alias(c) for c in BASE_COLUMNS), "sample_count", "baseline_version")


@query(
    "history_written",
    f"""WITH {machines_sql(BY)} SELECT unit_id, evaluation_week, evaluation_year, CASE WHEN evaluation_week < 10 THEN 'Seen again' ELSE overall_status END AS overall_status, round(machine_score, 9) AS machine_score FROM mach""",
)
def history_written(spark, d):
    """A history that two batches are merged into, the second of them twice: a key's newest row stays (K2, J5)."""
    path = f"{scratch(spark, 'history')}/machine_status.parquet"
    rows = machines(spark, d, PERIOD).select("unit_id", "evaluation_week", "evaluation_year", "overall_status", "machine_score")
    writers.upsert_machines(rows, path)
    again = rows.where("evaluation_week < 10").withColumn("overall_status", F.lit("Seen again"))
    writers.upsert_machines(again, path)
    writers.upsert_machines(again, path)
    return readers.history(spark, path).select("unit_id", "evaluation_week", "evaluation_year", "overall_status", F.round("machine_score", 9).alias("machine_score"))


@query(
    "expected_fleet",
    f"""WITH {machines_sql(BY)}, fleet AS (SELECT DISTINCT Unit AS unit_id FROM base), m AS (SELECT * FROM mach WHERE evaluation_year = 2001 AND evaluation_week = 20)
SELECT fleet.unit_id, coalesce(m.overall_status, 'InsufficientData') AS overall_status, coalesce(round(m.machine_score, 9), 0) AS machine_score, CAST(coalesce(m.total_components, 3) AS BIGINT) AS total_components
FROM fleet LEFT JOIN m ON m.unit_id = fleet.unit_id""",
)
def expected_fleet(spark, d):
    """A week's machines; units with a baseline that the week has no data of come out as InsufficientData (A17)."""
    base = baseline.baselines(t.training(spark, d), t.SIGNALS, "20010101")
    heard = machines(spark, d, PERIOD).where("evaluation_year = 2001 AND evaluation_week = 20")
    out = rollup.with_missing_units(heard, rollup.expected_fleet(base), 3)
    return out.select("unit_id", "overall_status", F.round("machine_score", 9).alias("machine_score"), "total_components")


LABELS = [f"W{w:02d}-2001" for w in range(17, 21)]


@query(
    "unit_week_pivot",
    f"WITH {machines_sql(BY)} SELECT unit_id, "
    + ", ".join(f"min(overall_status) FILTER (WHERE evaluation_week = {w}) AS \"W{w:02d}-2001\"" for w in range(17, 21))
    + " FROM mach WHERE evaluation_year = 2001 AND evaluation_week BETWEEN 17 AND 20 GROUP BY unit_id",
)
def unit_week_pivot(spark, d):
    """A row for each unit and a column for each week with its status (A21)."""
    rows = machines(spark, d, PERIOD).where("evaluation_year = 2001 AND evaluation_week BETWEEN 17 AND 20")
    return reports.unit_by_period(rows, LABELS, F.format_string("W%02d-%d", "evaluation_week", "evaluation_year"))


@query("dropped_columns", f"WITH {TEL} SELECT EstadoMaquina, count(*) AS n, round(sum(l_tax), 6) AS tax FROM t GROUP BY ALL")
def dropped_columns(spark, d):
    """Columns that go where they are there (P11); what is left still has the signal."""
    rows = clean.without(t.telemetry(spark, d), ["AirFltr", "l_quantity", "EngOilFltr"])
    assert "l_quantity" not in rows.columns
    return rows.groupBy("EstadoMaquina").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_tax"), 6).alias("tax"))


@query("component_units", "SELECT c.component, Unit, sigs FROM (VALUES ('engine', 'a', 'x,y'), ('engine', 'b', 'x,y'), ('brakes', 'a', 'z')) AS c(component, model, sigs), (SELECT l_suppkey AS Unit, CASE WHEN l_suppkey % 2 = 0 THEN 'a' ELSE 'b' END AS model FROM lineitem GROUP BY ALL) u WHERE u.model = c.model")
def component_units(spark, d):
    """Units and signals of each component by a two-level fleet map, the first model's signals counting (S6, P25, J6)."""
    units = t.telemetry(spark, d).select("Unit").distinct()
    models = units.withColumn("truck_model", F.when(F.col("Unit") % 2 == 0, "a").otherwise("b"))
    parts = spark.createDataFrame([("a", 0, "engine", ["x", "y"]), ("b", 1, "engine", ["q"]), ("a", 0, "brakes", ["z"])], "truck_model string, model_pos int, component string, signals array<string>")
    out = readers.component_units(models, parts)
    return out.select("component", "Unit", F.array_join("signals", ",").alias("sigs"))


@query("artifacts", f"WITH {PAIRS} SELECT signal, round(p_low, 6) AS p_low, round(p_high, 6) AS p_high, n, 1.5::DOUBLE AS alpha FROM st")
def artifacts(spark, d):
    """Reference errors and settings that are saved as JSON and loaded again (K8, M9)."""
    folder = scratch(spark, "artifacts")
    stats = health.error_stats(pairs(spark, d)[0])
    health_index.save_artifacts(stats, health_index.Health(alpha=1.5), folder)
    held, cfg = health_index.load_artifacts(spark, folder)
    return held.select("signal", F.round("p_low", 6).alias("p_low"), F.round("p_high", 6).alias("p_high"), "n", F.lit(cfg.alpha).alias("alpha"))


@query(
    "health_time_agg",
    f"""WITH {PAIRS}, q AS (SELECT te.Unit, te.hour_idx, te.signal, quantile_cont(greatest(0, (err - p_low) / (p_high - p_low + 1e-8)), 0.5) AS norm FROM te JOIN st ON st.signal = te.signal GROUP BY ALL),
w AS (SELECT Unit, hour_idx, avg(norm) AS score, exp(-avg(norm)) AS hi FROM q GROUP BY ALL)
SELECT Unit, round(min(hi), 6) AS lowest, round(quantile_cont(score, 0.0), 6) AS least_error, count(*) AS n_windows FROM w GROUP BY Unit""",
)
def health_time_agg(spark, d):
    """Median over time, mean over signals, least over windows (A29-A31)."""
    made = health_index.score_pairs(*pairs(spark, d), ["Unit", "hour_idx"], "Unit", health_index.Health(time_agg="median", signal_agg="mean", unit_agg="min"), "Fecha").units
    return made.select("Unit", F.round("health_index", 6).alias("lowest"), F.round("reconstruction_error", 6).alias("least_error"), "n_windows")


@query("forecast_written", f"WITH {SER} SELECT Unit, CAST(168 AS BIGINT) AS n, CAST(1 AS INTEGER) AS first_step, CAST(168 AS INTEGER) AS last_step FROM e WHERE value IS NOT NULL GROUP BY Unit HAVING count(*) >= 60")
def forecast_written(spark, d):
    """A forecast that is written under its version and read back (K13)."""
    path = scratch(spark, "forecasts")
    made = reconstruct.forecast(series(spark, d), "Unit", "value", "Fecha", 7, 60)
    writers.save_forecast(made, path, "20010101")
    writers.save_forecast(made, path, "20010101")
    out = spark.read.parquet(path)
    return out.groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.min("step").alias("first_step"), F.max("step").alias("last_step"))

