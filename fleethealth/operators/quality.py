"""Validation: checks as rows of (check_name, severity, failed_rows, message)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleethealth.config import RANGES, STATUSES, ComponentMap, Names
from fleethealth.functions.values import haversine_km

ERROR, WARNING = "ERROR", "WARNING"
REPORT = "check_name string, severity string, failed_rows long, message string"


def schema_violations(df: DataFrame, expected: StructType) -> list[tuple[str, str, str]]:
    """(column, severity, message): missing columns are errors, other types warnings."""
    there = {f.name: f.dataType for f in df.schema}
    out = [(f.name, ERROR, "column is missing") for f in expected if f.name not in there]
    return out + [(f.name, WARNING, f"{there[f.name].simpleString()} instead of {f.dataType.simpleString()}") for f in expected if f.name in there and there[f.name] != f.dataType]


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def report(df: DataFrame, checks: Mapping[str, tuple[str, Column, str]]) -> DataFrame:
    """A row for each check: how many rows it fails for, all in one pass. checks: name to (severity, condition of a failure, message)."""
    counts = df.agg(*(F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, (_, bad, _) in checks.items()))
    long = counts.unpivot([], list(checks), "check_name", "failed_rows")
    about = df.sparkSession.createDataFrame([(k, s, m) for k, (s, _, m) in checks.items()], "check_name string, severity string, message string")
    return long.join(F.broadcast(about), "check_name").select("check_name", "severity", F.col("failed_rows").cast("long").alias("failed_rows"), "message")


def silver(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = RANGES, names: Names = Names(), now: Column | None = None, unit_pattern: str = r"^[A-Z0-9_\-]+$") -> DataFrame:
    """Telemetry: null keys, future times, repeated (unit, time), unit names, ranges, incomplete positions."""
    now = F.current_timestamp() if now is None else now
    ts, unit = F.col(names.ts), F.col(names.unit)
    checks = {
        "null_key": (ERROR, unit.isNull() | ts.isNull(), "unit and time are required"),
        "future_time": (ERROR, ts > now, "times are not in the future"),
        "duplicate_key": (ERROR, F.count(F.lit(1)).over(Window.partitionBy(unit, ts)) > 1, "one reading for each unit and time"),
        "unit_name": (WARNING, ~unit.cast("string").rlike(unit_pattern), "upper-case letters, digits, hyphens and underscores"),
        **{f"range_{c}": (WARNING, ~F.col(c).between(a, b), f"between {a} and {b}") for c, (a, b) in ranges.items() if c in df.columns},
    }
    gps = [c for c in ("GPSLat", "GPSLon", "GPSElevation") if c in df.columns]
    if len(gps) == 3:
        known = sum((F.col(c).isNotNull().cast("int") for c in gps[1:]), F.col(gps[0]).isNotNull().cast("int"))
        checks["gps_incomplete"] = (WARNING, known.between(1, 2), "all three of a position or none")
    flags = df.select(*(F.coalesce(bad, F.lit(False)).alias(name) for name, (_, bad, _) in checks.items()))
    return report(flags, {name: (s, F.col(name), m) for name, (s, _, m) in checks.items()})


def state_conflicts(df: DataFrame, still: Sequence[str] = ("Apagada",), working: Sequence[str] = ("Operacional", "Operacional Bajo", "Operacional Alto"), speed: str = "EngSpd", state: str = "EstadoMaquina") -> DataFrame:
    """Rows whose state and engine speed contradict each other."""
    return df.where((F.col(state).isin(*still) & (F.abs(F.col(speed)) > 1)) | (F.col(state).isin(*working) & (F.col(speed) == 0)))


def position_jumps(df: DataFrame, limit_km: float = 100.0, names: Names = Names()) -> DataFrame:
    """Readings further than the limit from the unit's reading before, with jump_km."""
    w = Window.partitionBy(names.unit).orderBy(names.ts)
    km = haversine_km(F.lag("GPSLat").over(w), F.lag("GPSLon").over(w), F.col("GPSLat"), F.col("GPSLon"))
    return df.withColumn("jump_km", km).where(F.col("jump_km") > limit_km)


def machine_rules(machine: DataFrame) -> DataFrame:
    """Machine status: domain of the status, counts that add up, score, priority, status against counts, one row a key."""
    c = F.col
    parts = c("components_normal") + c("components_alerta") + c("components_anormal") + c("components_insufficient")
    keys = [x for x in ("unit_id", "evaluation_week", "evaluation_year") if x in machine.columns]
    rows = machine.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    return report(
        rows,
        {
            "status_domain": (ERROR, ~c("overall_status").isin(*STATUSES), "a known status"),
            "counts_add_up": (ERROR, parts != c("total_components"), "counts add up to the total"),
            "score_not_negative": (ERROR, c("machine_score") < 0, "a score is not negative"),
            "priority_formula": (ERROR, F.abs(c("priority_score") - (100 * c("components_anormal") + 10 * c("components_alerta") + c("machine_score"))) > 1e-6, "100 * anormal + 10 * alerta + score"),
            "anormal_has_component": (WARNING, (c("overall_status") == "Anormal") & (c("components_anormal") < 1), "Anormal needs an Anormal component"),
            "normal_has_none": (WARNING, (c("overall_status") == "Normal") & (c("components_alerta") + c("components_anormal") > 0), "Normal has no component in alert"),
            "unique_key": (ERROR, c("__n") > 1, "one row for each unit and period"),
        },
    )


def component_rules(components: DataFrame, mapping: ComponentMap) -> DataFrame:
    c = F.col
    known = [x.name for x in mapping.components]
    return report(
        components,
        {
            "known_component": (ERROR, ~c("component").isin(*known), "a component of the map"),
            "score_range": (ERROR, ~c("component_score").between(0, 1), "between 0 and 1"),
            "coverage_range": (ERROR, ~c("signal_coverage").between(0, 1), "between 0 and 1"),
            "triggers_evaluated": (ERROR, F.size(F.array_except("triggering_signals", F.map_keys("signals_evaluation"))) > 0, "triggering signals were evaluated"),
        },
    )


def alert_rules(alerts: DataFrame, details: DataFrame) -> DataFrame:
    """AlertID, problem: alerts without details, details without alerts, and pairs whose unit or trigger differ."""
    a = alerts.select("AlertID", F.col("Unit").alias("a_unit"), F.col("Trigger").alias("a_trigger"), F.lit(1).alias("a"))
    d = details.select("AlertID", F.col("Unit").alias("d_unit"), F.col("Trigger").alias("d_trigger"), F.lit(1).alias("d"))
    problem = F.when(F.col("d").isNull(), "no detail").when(F.col("a").isNull(), "no alert").when(~F.col("a_unit").eqNullSafe(F.col("d_unit")) | ~F.col("a_trigger").eqNullSafe(F.col("d_trigger")), "differs")
    return a.join(d, "AlertID", "full_outer").select("AlertID", problem.alias("problem")).where("problem is not null")


def completeness(silver_units: DataFrame, machine: DataFrame) -> DataFrame:
    """Units with telemetry and no machine status."""
    return silver_units.select("unit_id").distinct().join(machine.select("unit_id"), "unit_id", "left_anti")


def unknown_versions(machine: DataFrame, base: DataFrame) -> DataFrame:
    """Rows whose baseline version no baseline has."""
    return machine.join(base.select("baseline_version").distinct(), "baseline_version", "left_anti")
