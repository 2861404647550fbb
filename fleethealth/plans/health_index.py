"""The health index: regular series to windows, reconstruction and scores, for all components at once."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleethealth.config import RANGES, Health, Names, Windowing
from fleethealth.operators import clean, features, health, reconstruct, resample, windows
from fleethealth.sources.writers import write_json


@dataclass(frozen=True)
class Scores:
    signals: DataFrame
    windows: DataFrame
    units: DataFrame


def regular_series(raw: DataFrame, signals: Sequence[str], names: Names = Names(), step: str = "1 minute", ranges=RANGES) -> DataFrame:
    """Ranges masked, thin rows dropped, states filled, on a grid with interpolation."""
    df = clean.fill_states(clean.enough_signals(clean.mask_ranges(raw, ranges), signals), names.state, names.load)
    df = clean.keep_last(df, [names.unit, names.ts], [c for c in df.columns if c not in (names.unit, names.ts)])
    categories = [c for c in (names.state, names.load) if c in df.columns]
    return resample.regular(df, signals, categories, step, names=names)


def long_blocks(df: DataFrame, signals: Sequence[str], cfg: Windowing = Windowing(), names: Names = Names()) -> DataFrame:
    """Rows (unit, hour_idx, step, ts, signal, y_true) of a unit's full blocks."""
    rows = windows.block_rows(df, signals, cfg, names)
    return rows.select(names.unit, "hour_idx", "step", names.ts, *(F.col(c).cast("double").alias(c) for c in signals)).unpivot([names.unit, "hour_idx", "step", names.ts], list(signals), "signal", "y_true")


def score_pairs(train: DataFrame, test: DataFrame, keys: Sequence[str], unit: str, cfg: Health = Health(), ts: str | None = None) -> Scores:
    """train, test: rows (keys, signal, y_true, y_pred); limits come from the training errors alone."""
    stats = health.error_stats(train, cfg)
    by_signal = health.signal_scores(test, stats, keys, cfg)
    by_window = health.window_scores(by_signal, keys, cfg)
    if ts is not None:
        times = test.groupBy(*keys).agg(F.min(ts).alias("start_time"), F.max(ts).alias("end_time"))
        by_window = by_window.join(times, list(keys))
    else:
        by_window = by_window.withColumns({"start_time": F.lit(None).cast("timestamp"), "end_time": F.lit(None).cast("timestamp")})
    return Scores(by_signal, by_window, health.unit_scores(by_window, unit, cfg))


def process_component(series: DataFrame, signals: Sequence[str], names: Names = Names(), weeks: int = 8, windowing: Windowing = Windowing(), cfg: Health = Health(), reconstructor: Callable[[str], reconstruct.Reconstructor] = reconstruct.MeanReconstructor) -> Scores:
    """Split in time, scale by the training part, cut in blocks, reconstruct, score. reconstructor: makes a model of rows unit, signal, y_true from the unit's column."""
    train, test = reconstruct.time_split(series, names.ts, weeks)
    pre = features.Preprocessor(list(signals)).fit(train)
    keep = [names.unit, names.ts]
    a = long_blocks(pre.transform(train, keep), signals, windowing, names)
    b = long_blocks(pre.transform(test, keep), signals, windowing, names)
    model = reconstructor(names.unit).fit(a)
    return score_pairs(model.reconstruct(a), model.reconstruct(b), [names.unit, "hour_idx"], names.unit, cfg, names.ts)


def run(series: DataFrame, component_units: DataFrame, units: DataFrame, names: Names = Names(), **how) -> tuple[DataFrame, list[dict]]:
    """Windows of all components in one table with component and truck_model; a component that can't be processed is reported."""
    made, failed = [], []
    for r in component_units.select("component", "signals").distinct().orderBy("component").collect():  # the map's size
        own = series.join(F.broadcast(component_units.where(F.col("component") == r.component).select(F.col("Unit").alias(names.unit))), names.unit, "left_semi")
        signals = [s for s in r.signals if s in series.columns]
        try:
            if not signals:
                raise ValueError("none of its signals is there")
            made.append(process_component(own, signals, names, **how).windows.withColumn("component", F.lit(r.component)))
        except ValueError as e:
            failed.append({"component": r.component, "error": str(e)})
    if not made:
        raise ValueError("no component could be processed")
    out = made[0]
    for x in made[1:]:
        out = out.unionByName(x)
    models = units.select(F.col("Unit").alias(names.unit), "truck_model")
    return out.join(F.broadcast(models), names.unit, "left"), failed


def tune(train: DataFrame, valid: DataFrame, alphas: Sequence[float], unit: str = "Unit") -> list[dict]:
    """A row for each setting, best first: the spread of the health index of the validation windows. A grid, so that it repeats exactly."""
    trials = []
    for alpha in alphas:
        s = score_pairs(train, valid, [unit, "hour_idx"], unit, Health(alpha=alpha)).windows.agg(F.avg("health_index").alias("m"), F.stddev_pop("health_index").alias("s")).first()
        trials.append({"alpha": alpha, "mean": s.m, "std": s.s})
    return sorted(trials, key=lambda t: (-(t["std"] or 0), t["alpha"]))


def quality(series: DataFrame, names: Names = Names()) -> DataFrame:
    """Rows, created and imputed shares and the number of time steps of each unit."""
    return series.groupBy(names.unit).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(F.col("created_by_reindex").cast("double")).alias("created_share"), F.avg(F.col("imputed_any").cast("double")).alias("imputed_share"))


def save_artifacts(stats: DataFrame, cfg: Health, folder: str) -> None:
    """Settings, signals and reference errors as three small JSON files."""
    spark = stats.sparkSession
    rows = {r["signal"]: {k: v for k, v in r.asDict().items() if k != "signal"} for r in stats.orderBy("signal").collect()}  # a row a signal
    write_json(spark, asdict(cfg), f"{folder}/health_index_config.json")
    write_json(spark, rows, f"{folder}/error_stats.json")
    write_json(spark, list(rows), f"{folder}/signal_cols.json")


def load_artifacts(spark: SparkSession, folder: str) -> tuple[DataFrame, Health]:
    """What save_artifacts wrote: reference errors and settings."""
    held = {name: json.loads("\n".join(r.value for r in spark.read.text(f"{folder}/{name}.json", wholetext=True).collect())) for name in ("health_index_config", "error_stats", "signal_cols")}
    rows = [(s, *(held["error_stats"][s][c] for c in ("p_low", "p_high", "mean", "std", "min", "max", "n"))) for s in held["signal_cols"]]
    return spark.createDataFrame(rows, "signal string, p_low double, p_high double, mean double, std double, min double, max double, n long"), Health(**held["health_index_config"])
