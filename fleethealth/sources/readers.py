"""Sources: weekly telemetry, histories, maps, baselines, spreadsheets."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleethealth.config import ComponentMap

# Names of weekly files.
WEEK_FILE = "Week{week:02d}Year{year}.parquet"
_WEEK_NAME = re.compile(r"Week(\d{2})Year(\d{4})\.parquet")


def week_monday(year: int, week: int) -> dt.date:
    """The Monday of a week; week 1 holds the year's first Monday."""
    first = dt.date(year, 1, 1)
    return first + dt.timedelta(days=(7 - first.weekday()) % 7 + 7 * (week - 1))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of what matches in a folder of any file system that Spark reads, by name."""
    p, fs = _fs(spark, f"{folder.rstrip('/')}/{pattern}")
    found = fs.globStatus(p) or []
    return sorted((x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in found)


def newest_file(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    found = list_files(spark, folder, pattern)
    return max(found, key=lambda x: (x[2], x[0]))[0] if found else None


def make_folder(spark: SparkSession, folder: str) -> None:
    p, fs = _fs(spark, folder)
    fs.mkdirs(p)


def _time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.try_to_timestamp(ts)) if dict(df.dtypes)[ts] == "string" else df


def evaluation_week(spark: SparkSession, folder: str, year: int, week: int, ts: str = "Fecha") -> DataFrame:
    """One week's file. FileNotFoundError if it isn't there, ValueError if it has no rows."""
    path = f"{folder}/{WEEK_FILE.format(week=week, year=year)}"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    df = _time(spark.read.parquet(path), ts)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def history_bounds(year: int, week: int, lookback_days: int = 90) -> tuple[dt.datetime, dt.datetime]:
    """From the week's Monday less the lookback to the Sunday's first moment before it, both included."""
    monday = dt.datetime.combine(week_monday(year, week), dt.time())
    return monday - dt.timedelta(days=lookback_days), monday - dt.timedelta(days=1)


def baseline_window(spark: SparkSession, folder: str, year: int, week: int, lookback_days: int = 90, ts: str = "Fecha") -> DataFrame:
    """Telemetry of the days before a week, of all files that can be read, in one scan with the bounds pushed down.

    Only files whose week, by their names, may hold such days are opened: a
    file is taken from a week before its Monday to a week after its Sunday, as
    collectors close weeks late. AnalysisException if there is none.
    """
    start, end = history_bounds(year, week, lookback_days)
    slack = dt.timedelta(days=7)
    paths = [p for p, y, w in week_files(spark, folder) if start - 2 * slack <= dt.datetime.combine(week_monday(y, w), dt.time()) <= end + slack]
    df = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(*(paths or [f"{folder}/Week*.parquet"]))
    return _time(df, ts).where((F.col(ts) >= F.lit(start)) & (F.col(ts) <= F.lit(end)))


def week_files(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, year, week) of a folder's weekly files, by the names alone; other names are passed over."""
    found = ((p, _WEEK_NAME.fullmatch(p.rstrip("/").rpartition("/")[2])) for p, _, _ in list_files(spark, folder, "Week*.parquet"))
    return [(p, int(m[2]), int(m[1])) for p, m in found if m]


def all_weeks(spark: SparkSession, folder: str, ts: str = "Fecha") -> DataFrame:
    """Every weekly file of a folder in one scan, with file_year and file_week from its name. Files may lack each other's columns."""
    df = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True).parquet(f"{folder}/Week*.parquet")
    name = F.input_file_name()
    part = lambda k: F.regexp_extract(name, _WEEK_NAME.pattern, k).cast("int")
    return _time(df.withColumns({"file_week": part(1), "file_year": part(2)}), ts)


def recovered(spark: SparkSession, path: str) -> bool:
    """Whether a history is there, after what a crash within ``writers.swap`` left has been put right.

    If the history is missing, the version that was written to its end, else
    the one that had been moved aside, takes its place.
    """
    if exists(spark, path):
        return True
    p, fs = _fs(spark, path)
    beside = [x for x, _, _ in list_files(spark, *path.rstrip("/").rsplit("/", 1)[:1], pattern=f"{path.rstrip('/').rpartition('/')[2]}.*")]
    for found in [x for x in beside if x.endswith(".new") and exists(spark, f"{x}/_SUCCESS")] + [x for x in beside if x.endswith(".old")]:
        q, _ = _fs(spark, found)
        return bool(fs.rename(q, p))
    return False


def history(spark: SparkSession, path: str) -> DataFrame:
    """A history that ``writers.upsert`` keeps. FileNotFoundError without one."""
    if not recovered(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def previous_weeks(df: DataFrame, year: int, week: int, n: int, year_col: str = "eval_year", week_col: str = "eval_week") -> DataFrame:
    """The week and the n before it, with week_label and is_current."""
    monday = week_monday(year, week)
    wanted = []
    for k in range(n + 1):
        day = monday - dt.timedelta(days=7 * k)
        wanted.append((day.year, int(day.strftime("%W"))))
    keep = F.lit(False)
    for y, w in wanted:
        keep = keep | ((F.col(year_col) == y) & (F.col(week_col) == w))
    return df.where(keep).withColumns({"week_label": F.format_string("W%02d-%d", week_col, year_col), "is_current": (F.col(year_col) == year) & (F.col(week_col) == week)})


def component_map(spark: SparkSession, path: str) -> ComponentMap:
    """A JSON file of components; the map is a few hundred lines at most."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return ComponentMap.of(json.loads(text))


def fleet_map(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(Unit, truck_model) and (truck_model, model_pos, component, signals): two small dimensions of a two-level map."""
    held = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    units = spark.createDataFrame(list(held["id_to_truck_model"].items()), "Unit string, truck_model string")
    rows = [(m, i, c, list(x.get("signals", ()))) for i, (m, parts) in enumerate(held["model_components"].items()) for c, x in parts.items()]
    return units, spark.createDataFrame(rows, "truck_model string, model_pos int, component string, signals array<string>")


def component_units(units: DataFrame, parts: DataFrame) -> DataFrame:
    """component, Unit, signals: units whose model has the component, with the signals of the first model that has it."""
    first = parts.groupBy("component").agg(F.min_by("signals", "model_pos").alias("signals"))
    return parts.select("component", "truck_model").join(F.broadcast(units), "truck_model").join(F.broadcast(first), "component").select("component", "Unit", "signals")


def load_baseline(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """Baselines of a version, or of the newest one."""
    df = spark.read.parquet(folder).withColumn("baseline_version", F.col("baseline_version").cast("string"))
    if version is not None:
        return df.where(F.col("baseline_version") == version)
    newest = df.agg(F.max("baseline_version").alias("__v"))
    return df.join(F.broadcast(newest), F.col("baseline_version") == F.col("__v"), "left_semi")


def or_empty(read, spark: SparkSession, schema: StructType | str) -> DataFrame:
    """What ``read()`` gives, or an empty table of the schema if its source is missing or can't be read."""
    try:
        df = read()
        df.schema  # resolved now, so that a missing path shows here
        return df
    except (PySparkException, OSError, ValueError, ImportError):
        return spark.createDataFrame([], schema)


def parquet_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return or_empty(lambda: spark.read.parquet(path), spark, schema)


def spreadsheet(spark: SparkSession, path: str, rename: dict[str, str] | None = None, day_first: Sequence[str] = ()) -> DataFrame:
    """A spreadsheet (or a CSV of the same columns): columns renamed, dates read as dd/MM/yyyy. Spreadsheets are read on the driver."""
    if path.lower().endswith(".csv"):
        df = spark.read.option("header", True).csv(path)
    else:
        import pandas as pd

        df = spark.createDataFrame(pd.read_excel(path, dtype=str))
    df = df.withColumnsRenamed(rename or {})
    return df.withColumns({c: F.to_date(F.try_to_timestamp(F.col(c), F.lit("dd/MM/yyyy"))) for c in day_first})


def spreadsheet_or_empty(spark: SparkSession, path: str, schema: StructType | str, **how) -> DataFrame:
    return or_empty(lambda: spreadsheet(spark, path, **how), spark, schema)


def fetch(spark: SparkSession, source: str, target: str, pattern: str = "*") -> dict[str, int]:
    """Copies the files of a folder of any store to another; counts of copied, skipped (already there, same size), failed."""
    done = {"copied": 0, "skipped": 0, "failed": 0}
    conf = spark._jsc.hadoopConfiguration()
    make_folder(spark, target)
    for path, size, _ in list_files(spark, source, pattern):
        src, src_fs = _fs(spark, path)
        dst, dst_fs = _fs(spark, f"{target.rstrip('/')}/{src.getName()}")
        if dst_fs.exists(dst) and dst_fs.getFileStatus(dst).getLen() == size:
            done["skipped"] += 1
            continue
        try:
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(src_fs, src, dst_fs, dst, False, conf)
            done["copied"] += 1
        except Exception:  # one file's failure is counted and doesn't end the run
            done["failed"] += 1
    return done
