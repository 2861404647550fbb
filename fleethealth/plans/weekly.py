"""The weekly evaluation: telemetry to signals, components and machines, for any number of weeks in one job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethealth.config import VALID_STATES, ComponentMap, Names, Scoring
from fleethealth.operators import baseline, clean, rollup, scoring
from fleethealth.sources import readers, writers


@dataclass(frozen=True)
class Evaluation:
    baselines: DataFrame
    signals: DataFrame
    components: DataFrame
    machines: DataFrame


def evaluate(training: DataFrame, current: DataFrame, signals: Sequence[str], mapping: ComponentMap, version: str, names: Names = Names(), cfg: Scoring = Scoring(), by: Sequence[str] = (), by_state: bool = False, policy: str = "weighted") -> Evaluation:
    """Evaluates ``current``, by the period columns ``by`` if there are any, against baselines of ``training``. Nothing runs until a result is read."""
    base = baseline.baselines(training, signals, version, cfg.min_samples, names)
    evaluated = scoring.evaluate_signals(current, base, signals, mapping, names, baseline.first_seen(training, names), by_state, cfg, by)
    parts = rollup.components(evaluated, mapping, cfg, by)
    return Evaluation(base, evaluated, parts, rollup.machines(parts, policy, cfg, by))


def with_period(df: DataFrame, ts: str) -> DataFrame:
    """Adds evaluation_year and evaluation_week of each reading, so that all weeks are evaluated at once."""
    first = F.next_day(F.date_sub(F.make_date(F.year(ts), F.lit(1), F.lit(1)), 1), "MO")
    return df.withColumns({"evaluation_year": F.year(ts), "evaluation_week": F.floor((F.date_diff(F.col(ts).cast("date"), first) + 7) / 7).cast("int")})


def run_week(spark, silver: str, map_path: str, golden: str, year: int, week: int, lookback_days: int = 90, names: Names = Names(), cfg: Scoring = Scoring(), states: Sequence[str] = VALID_STATES) -> Evaluation:
    """Reads a week and its history, evaluates, and merges the results into the golden tables."""
    current = readers.evaluation_week(spark, silver, year, week, names.ts)
    signals = clean.signal_columns(current)
    mapping = readers.component_map(spark, map_path)
    training = clean.clean(readers.baseline_window(spark, silver, year, week, lookback_days, names.ts), signals, names, states)
    version = readers.week_monday(year, week).strftime("%Y%m%d")
    made = evaluate(training, clean.clean(current, signals, names, states), signals, mapping, version, names, cfg)
    writers.save_baseline(made.baselines, f"{golden}/baselines")
    base = readers.load_baseline(spark, f"{golden}/baselines", version)
    again = scoring.evaluate_signals(clean.clean(current, signals, names, states), base, signals, mapping, names, baseline.first_seen(training, names), False, cfg)
    period = {"evaluation_week": F.lit(week), "evaluation_year": F.lit(year), "baseline_version": F.lit(version)}
    parts = rollup.components(again, mapping, cfg)
    history = f"{golden}/machine_status.parquet"
    fleet = rollup.expected_fleet(base, readers.history(spark, history) if readers.recovered(spark, history) else None)
    machines = rollup.with_missing_units(rollup.machines(parts, "weighted", cfg), fleet, len(mapping.components))
    writers.upsert_components(parts.withColumns(period), f"{golden}/classified.parquet")
    writers.upsert_machines(machines.withColumns(period), history)
    writers.baseline_metadata(base, f"{golden}/baseline_metadata_{version}.json", version=version, lookback_days=lookback_days)
    return Evaluation(base, again, parts, machines)


def run_weeks(spark, silver: str, map_path: str, golden: str, weeks: Sequence[tuple[int, int]], **how) -> list[dict]:
    """run_week for each (year, week); a week's failure is a row of the result and doesn't end the run."""
    out = []
    for year, week in weeks:
        try:
            run_week(spark, silver, map_path, golden, year, week, **how)
            out.append({"year": year, "week": week, "status": "SUCCESS", "error": None})
        except Exception as e:
            out.append({"year": year, "week": week, "status": "ERROR", "error": str(e)[:500]})
    return out
