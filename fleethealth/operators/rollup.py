"""From signals to components and machines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleethealth.config import ALERTA, ANORMAL, CRITICALITY, INSUFFICIENT, NORMAL, SEVERITY, ComponentMap, Scoring
from fleethealth.functions.values import lookup, ordered_sum


def membership(mapping: ComponentMap, df: DataFrame) -> DataFrame:
    """A row for each component and signal of it: component, component_pos, criticality, mapped_signals, signal_name, signal_pos. Small: broadcast."""
    rows = [(c.name, i, c.criticality, len(c.signals), s, j) for i, c in enumerate(mapping.components) for j, s in enumerate(c.signals)]
    return df.sparkSession.createDataFrame(rows, "component string, component_pos int, criticality string, mapped_signals int, signal_name string, signal_pos int")


def component_status(score: Column, coverage: Column, cfg: Scoring = Scoring()) -> Column:
    return F.when(coverage < cfg.min_coverage, INSUFFICIENT).when(score >= cfg.component_anormal, ANORMAL).when(score >= cfg.component_alerta, ALERTA).otherwise(NORMAL)


def components(signals: DataFrame, mapping: ComponentMap, cfg: Scoring = Scoring(), by: Sequence[str] = ()) -> DataFrame:
    """A row for each unit and component with at least one evaluated signal (and period ``by``).

    A signal counts in each component that lists it. Adds component_score,
    component_status, triggering_signals (all that aren't Normal, in the
    component's order), signals_evaluation, signal_coverage, sample_count_avg.
    """
    rows = signals.drop("component").join(F.broadcast(membership(mapping, signals)), "signal_name")
    if cfg.min_valid_share is None:
        weight = (F.col("sample_count") > 0).cast("double")
    else:
        weight = (F.col("sample_count") >= cfg.min_valid_share * F.col("reading_count")).cast("double")
    rows = rows.withColumns({"__w": weight, "__s": lookup(F.col("signal_status"), SEVERITY, 0.0)})
    in_order = F.sort_array(F.collect_list(F.struct("signal_pos", "signal_name", "signal_status", "window_score_normalized", "anomaly_percentage", "sample_count")))
    out = rows.groupBy("unit_id", "component", *by).agg(
        F.first("component_pos").alias("component_pos"),
        F.first("criticality").alias("criticality"),
        F.coalesce(ordered_sum(F.col("signal_pos"), F.col("__w") * F.col("__s")) / F.nullif(F.sum("__w"), F.lit(0.0)), F.lit(0.0)).alias("component_score"),
        (F.count(F.lit(1)) / F.first("mapped_signals")).alias("signal_coverage"),
        F.avg("sample_count").alias("sample_count_avg"),
        in_order.alias("__all"),
    )
    return out.withColumns(
        {
            "component_status": component_status(F.col("component_score"), F.col("signal_coverage"), cfg),
            "triggering_signals": F.transform(F.filter("__all", lambda x: x["signal_status"] != NORMAL), lambda x: x["signal_name"]),
            "signals_evaluation": F.map_from_entries(
                F.transform(
                    "__all",
                    lambda x: F.struct(
                        x["signal_name"].alias("key"),
                        F.struct(x["signal_status"].alias("status"), x["window_score_normalized"].alias("window_score"), x["anomaly_percentage"].alias("anomaly_percentage"), x["sample_count"].alias("sample_count")).alias("value"),
                    ),
                )
            ),
        }
    ).drop("__all")


def machine_status(score: Column, cfg: Scoring = Scoring()) -> Column:
    return F.when(score > cfg.machine_anormal, ANORMAL).when(score > cfg.machine_alerta, ALERTA).otherwise(NORMAL)


def worst_status(anormal: Column, alerta: Column) -> Column:
    return F.when(anormal > 0, ANORMAL).when(alerta > 0, ALERTA).otherwise(NORMAL)


def priority(anormal: Column, alerta: Column, score: Column) -> Column:
    return 100 * anormal + 10 * alerta + score


def machines(evaluated: DataFrame, policy: str = "weighted", cfg: Scoring = Scoring(), by: Sequence[str] = ()) -> DataFrame:
    """A row for each unit (and period): counts by status, score, status, priority and the components' details.

    ``weighted``: components' severities by criticality, added in the map's
    order, so that sums at a limit round alike every time. ``worst``: the worst
    component decides, and scores weigh by 3, 2, 1 for High, Medium, Low.
    """
    count = {s: F.count_if(F.col("component_status") == s) for s in (NORMAL, ALERTA, ANORMAL, INSUFFICIENT)}
    if policy == "weighted":
        part = lookup(F.col("criticality"), CRITICALITY, 1.0) * lookup(F.col("component_status"), SEVERITY, 0.0)
    elif policy == "worst":
        part = lookup(F.col("criticality"), {"High": 3.0, "Medium": 2.0, "Low": 1.0}, 1.0) * F.col("component_score")
    else:
        raise ValueError(f"no policy {policy}")
    details = F.sort_array(F.collect_list(F.struct("component_pos", "component", "component_status", "component_score", "triggering_signals", "signal_coverage")))
    out = evaluated.groupBy("unit_id", *by).agg(
        count[NORMAL].alias("components_normal"),
        count[ALERTA].alias("components_alerta"),
        count[ANORMAL].alias("components_anormal"),
        count[INSUFFICIENT].alias("components_insufficient"),
        F.count(F.lit(1)).alias("total_components"),
        ordered_sum(F.col("component_pos"), part).alias("machine_score"),
        details.alias("__d"),
    )
    status = machine_status(F.col("machine_score"), cfg) if policy == "weighted" else worst_status(F.col("components_anormal"), F.col("components_alerta"))
    named = F.transform("__d", lambda x: F.struct(x["component"].alias("component"), x["component_status"].alias("status"), x["component_score"].alias("score"), x["triggering_signals"].alias("triggering_signals"), x["signal_coverage"].alias("signal_coverage")))
    return out.withColumns({"overall_status": status, "priority_score": priority(F.col("components_anormal"), F.col("components_alerta"), F.col("machine_score")), "component_details": named}).drop("__d")


def expected_fleet(base: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Units of the history if there is one, else of the baselines."""
    return history.select("unit_id").distinct() if history is not None else base.select(F.col("Unit").alias("unit_id")).distinct()


def with_missing_units(machine: DataFrame, fleet: DataFrame, n_components: int) -> DataFrame:
    """Adds a row for each unit of the fleet that has none: InsufficientData, score 0, all components insufficient."""
    absent = fleet.join(machine.select("unit_id"), "unit_id", "left_anti").select("unit_id")
    fixed = {"overall_status": F.lit(INSUFFICIENT), "machine_score": F.lit(0.0), "priority_score": F.lit(0.0), "components_insufficient": F.lit(n_components).cast("long"), "total_components": F.lit(n_components).cast("long")}
    kinds = {f.name: f.dataType for f in machine.schema}
    zero = {c: F.lit(0).cast("long") for c in ("components_normal", "components_alerta", "components_anormal")}
    rows = absent.select(*((F.col("unit_id") if c == "unit_id" else (fixed | zero).get(c, F.lit(None)).cast(kinds[c])).alias(c) for c in machine.columns))
    return machine.unionByName(rows)
