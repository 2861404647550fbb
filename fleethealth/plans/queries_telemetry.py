"""Queries of the weekly evaluation, on lineitem as telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethealth.config import STATUSES, Scoring
from fleethealth.operators import alerts, baseline, clean, features, quality, regress, reports, rollup, scoring
from fleethealth.plans.registry import query
from fleethealth.plans.weekly import with_period
from fleethealth.sources import tables as t
from fleethealth.sources.writers import MACHINE_KEY, merged

STRICT = Scoring(signal_alerta=0.12, signal_anormal=0.2)

TEL = """
t AS (SELECT l_suppkey AS Unit, l_shipdate AS Fecha, l_returnflag AS EstadoMaquina, l_linestatus AS EstadoCarga,
             l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
tr AS (SELECT * FROM t WHERE Fecha < TIMESTAMP '2001-01-01'),
ev AS (SELECT * FROM t WHERE Fecha >= TIMESTAMP '2001-01-01')"""


def long_sql(name: str, of: str, keep: str = "") -> str:
    return f"{name} AS (" + " UNION ALL ".join(f"SELECT Unit, EstadoMaquina, Fecha{keep}, '{s}' AS Signal, {s} AS value FROM {of}" for s in t.SIGNALS) + ")"


def base_sql(least: int) -> str:
    q = ", ".join(f"quantile_cont(value, {p}) AS {c}" for p, c in ((0.02, "P2"), (0.05, "P5"), (0.95, "P95"), (0.98, "P98")))
    return f"""
{TEL}, {long_sql('trl', 'tr')},
own AS (SELECT Unit, Signal, EstadoMaquina, {q}, count(value) AS sample_count FROM trl GROUP BY Unit, Signal, EstadoMaquina HAVING count(value) >= {least}),
rest AS (SELECT Unit, Signal, 'All' AS EstadoMaquina, {q}, count(value) AS sample_count FROM trl
         WHERE NOT EXISTS (SELECT 1 FROM own WHERE own.Unit = trl.Unit AND own.Signal = trl.Signal) GROUP BY Unit, Signal HAVING count(value) >= {least}),
base AS (SELECT * FROM own UNION ALL SELECT * FROM rest)"""


PICK = """
seen AS (SELECT Unit, EstadoMaquina, min(Fecha) AS first_seen FROM tr GROUP BY Unit, EstadoMaquina),
pick AS (SELECT * FROM (SELECT b.*, row_number() OVER (PARTITION BY b.Unit, b.Signal ORDER BY b.EstadoMaquina <> 'All', seen.first_seen NULLS LAST, b.EstadoMaquina) AS rn
                        FROM base b LEFT JOIN seen ON seen.Unit = b.Unit AND seen.EstadoMaquina = b.EstadoMaquina) WHERE rn = 1)"""

SEVERITY = """CASE WHEN value BETWEEN P5 AND P95 THEN 0.0::DOUBLE
     WHEN (value >= P2 AND value < P5) OR (value > P95 AND value <= P98) THEN 1.0::DOUBLE
     WHEN value < P2 OR value > P98 THEN 3.0::DOUBLE END"""


def signals_sql(least: int = 100, low: float = 0.35, high: float = 0.9, by: str = "", by_state: bool = False) -> str:
    """CTEs up to sev (scored readings) and sig (evaluated signals); by: period columns, with a comma before each."""
    period = ", CAST(year(Fecha) AS INTEGER) AS evaluation_year, CAST(strftime(Fecha, '%W') AS INTEGER) AS evaluation_week" if by else ""
    sev = f"""lim AS (SELECT e.*, p.P2, p.P5, p.P95, p.P98 FROM evl e JOIN pick p ON p.Unit = e.Unit AND p.Signal = e.Signal)"""
    if by_state:
        sev = """lim AS (SELECT e.*, coalesce(o.P2, p.P2) AS P2, coalesce(o.P5, p.P5) AS P5, coalesce(o.P95, p.P95) AS P95, coalesce(o.P98, p.P98) AS P98
 FROM evl e JOIN pick p ON p.Unit = e.Unit AND p.Signal = e.Signal
 LEFT JOIN own o ON o.Unit = e.Unit AND o.Signal = e.Signal AND o.EstadoMaquina = e.EstadoMaquina)"""
    return f"""{base_sql(least)}, {PICK}, evp AS (SELECT *{period} FROM ev), {long_sql('evl', 'evp', by)}, {sev},
sev AS (SELECT Unit AS unit_id, Signal AS signal_name, EstadoMaquina AS state, Fecha AS ts, value, P2, P5, P95, P98{by}, {SEVERITY} AS severity FROM lim),
sums AS (SELECT unit_id, signal_name{by}, avg(severity) AS window_score_normalized, count(severity) AS sample_count, count(*) FILTER (WHERE severity > 0) AS anomaly_count,
                max(severity) AS max_score, min(P2) AS p2, min(P5) AS p5, max(P95) AS p95, max(P98) AS p98 FROM sev GROUP BY unit_id, signal_name{by}),
sig AS (SELECT *, CASE signal_name WHEN 'l_quantity' THEN 'volume' WHEN 'l_extendedprice' THEN 'pricing' ELSE 'fiscal' END AS component,
               CASE WHEN window_score_normalized IS NULL THEN 'InsufficientData' WHEN window_score_normalized >= {high} THEN 'Anormal'
                    WHEN window_score_normalized >= {low} THEN 'Alerta' ELSE 'Normal' END AS signal_status,
               CASE WHEN sample_count > 0 THEN 100.0::DOUBLE * anomaly_count / sample_count ELSE 0.0::DOUBLE END AS anomaly_percentage FROM sums)"""


def machines_sql(by: str = "", policy: str = "weighted", low: float = 0.12, high: float = 0.2) -> str:
    """CTEs up to comp and mach."""
    if policy == "weighted":
        part = "(CASE criticality WHEN 'High' THEN 1.0::DOUBLE WHEN 'Medium' THEN 0.4::DOUBLE ELSE 0.2::DOUBLE END) * (CASE component_status WHEN 'Alerta' THEN 0.3::DOUBLE WHEN 'Anormal' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
        status = "CASE WHEN machine_score > 1.4::DOUBLE THEN 'Anormal' WHEN machine_score > 0.6::DOUBLE THEN 'Alerta' ELSE 'Normal' END"
    else:
        part = "(CASE criticality WHEN 'High' THEN 3.0::DOUBLE WHEN 'Medium' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END) * component_score"
        status = "CASE WHEN components_anormal > 0 THEN 'Anormal' WHEN components_alerta > 0 THEN 'Alerta' ELSE 'Normal' END"
    count = ", ".join(f"count(*) FILTER (WHERE component_status = '{s}') AS components_{n}" for s, n in zip(STATUSES, ("normal", "alerta", "anormal", "insufficient")))
    return f"""{signals_sql(100, low, high, by)},
member AS (SELECT * FROM (VALUES ('pricing', 0, 'High', 2, 'l_extendedprice', 0), ('pricing', 0, 'High', 2, 'l_discount', 1), ('volume', 1, 'Medium', 1, 'l_quantity', 0),
  ('fiscal', 2, 'Low', 2, 'l_tax', 0), ('fiscal', 2, 'Low', 2, 'l_discount', 1)) AS m(component, component_pos, criticality, mapped, signal_name, signal_pos)),
parts AS (SELECT sig.unit_id, sig.signal_name, m.component, component_pos, criticality, mapped, signal_pos, signal_status, sample_count, window_score_normalized{by},
  CASE WHEN sample_count > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS w,
  CASE signal_status WHEN 'Alerta' THEN 0.3::DOUBLE WHEN 'Anormal' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS s FROM sig JOIN member m ON m.signal_name = sig.signal_name),
scored AS (SELECT unit_id, component{by}, any_value(component_pos) AS component_pos, any_value(criticality) AS criticality,
  coalesce(list_reduce(list(w * s ORDER BY signal_pos), lambda a, b: a + b) / nullif(sum(w), 0), 0.0::DOUBLE) AS component_score,
  count(*)::DOUBLE / any_value(mapped) AS signal_coverage, avg(sample_count) AS sample_count_avg,
  coalesce(string_agg(signal_name, ',' ORDER BY signal_pos) FILTER (WHERE signal_status <> 'Normal'), '') AS triggers FROM parts GROUP BY unit_id, component{by}),
comp AS (SELECT *, CASE WHEN signal_coverage < 0.5 THEN 'InsufficientData' WHEN component_score >= 0.45::DOUBLE THEN 'Anormal' WHEN component_score >= 0.15::DOUBLE THEN 'Alerta' ELSE 'Normal' END AS component_status FROM scored),
msum AS (SELECT unit_id{by}, {count}, count(*) AS total_components, list_reduce(list({part} ORDER BY component_pos), lambda a, b: a + b) AS machine_score FROM comp GROUP BY unit_id{by}),
mach AS (SELECT *, {status} AS overall_status, 100 * components_anormal + 10 * components_alerta + machine_score AS priority_score FROM msum)"""


BY = ", evaluation_year, evaluation_week"
PERIOD = ["evaluation_year", "evaluation_week"]


def evaluated(spark, d, by=(), cfg=STRICT, **how) -> tuple[DataFrame, DataFrame]:
    train, now = t.training(spark, d), t.current(spark, d)
    base = baseline.baselines(train, t.SIGNALS, "20010101")
    if by:
        now = with_period(now, "Fecha")
    return scoring.evaluate_signals(now, base, t.SIGNALS, t.MAP, seen=baseline.first_seen(train), cfg=cfg, by=by, **how), base


def components(spark, d, by=()) -> DataFrame:
    return rollup.components(evaluated(spark, d, by)[0], t.MAP, STRICT, by)


def machines(spark, d, by=(), policy="weighted") -> DataFrame:
    return rollup.machines(components(spark, d, by), policy, STRICT, by)


def scored(spark, d) -> DataFrame:
    train = t.training(spark, d)
    return scoring.scored_readings(t.current(spark, d), baseline.baselines(train, t.SIGNALS, "20010101"), t.SIGNALS, seen=baseline.first_seen(train))


SIGNAL_COLUMNS = ["unit_id", "signal_name", "component", "window_score_normalized", "signal_status", "sample_count", "anomaly_count", "anomaly_percentage", "max_score", "p2", "p5", "p95", "p98"]
SIGNAL_SQL = "unit_id, signal_name, component, round(window_score_normalized, 9) AS window_score_normalized, signal_status, sample_count, anomaly_count, round(anomaly_percentage, 9) AS anomaly_percentage, max_score, round(p2, 6) AS p2, round(p5, 6) AS p5, round(p95, 6) AS p95, round(p98, 6) AS p98"


def rounded(df: DataFrame, columns: list[str], digits: dict[str, int]) -> DataFrame:
    return df.select(*(F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in columns))


ROUND = {"window_score_normalized": 9, "anomaly_percentage": 9, "p2": 6, "p5": 6, "p95": 6, "p98": 6}


@query("signal_eval", f"WITH {signals_sql()} SELECT {SIGNAL_SQL} FROM sig")
def signal_eval(spark, d):
    return rounded(evaluated(spark, d, cfg=Scoring())[0], SIGNAL_COLUMNS, ROUND)


@query("signal_eval_state_mode", f"WITH {signals_sql(by_state=True)} SELECT {SIGNAL_SQL} FROM sig")
def signal_eval_state_mode(spark, d):
    return rounded(evaluated(spark, d, cfg=Scoring(), by_state=True)[0], SIGNAL_COLUMNS, ROUND)


COMPONENT_SQL = "unit_id, component, criticality, component_status, round(component_score, 9) AS component_score, round(signal_coverage, 9) AS signal_coverage, round(sample_count_avg, 6) AS sample_count_avg, triggers"


@query("component_eval", f"WITH {machines_sql()} SELECT {COMPONENT_SQL} FROM comp")
def component_eval(spark, d):
    out = components(spark, d).withColumn("triggers", F.array_join("triggering_signals", ","))
    return rounded(out, ["unit_id", "component", "criticality", "component_status", "component_score", "signal_coverage", "sample_count_avg", "triggers"], {"component_score": 9, "signal_coverage": 9, "sample_count_avg": 6})


@query("component_triggers", f"WITH {machines_sql()} SELECT unit_id, component, signal_name AS trigger_signal, signal_status, sample_count FROM parts WHERE signal_status <> 'Normal'")
def component_triggers(spark, d):
    each = components(spark, d).select("unit_id", "component", F.explode("triggering_signals").alias("trigger_signal"), "signals_evaluation")
    return each.select("unit_id", "component", "trigger_signal", F.col("signals_evaluation")[F.col("trigger_signal")]["status"].alias("signal_status"), F.col("signals_evaluation")[F.col("trigger_signal")]["sample_count"].alias("sample_count"))


MACHINE_COLUMNS = ["unit_id", "overall_status", "machine_score", "priority_score", "components_normal", "components_alerta", "components_anormal", "components_insufficient", "total_components"]
MACHINE_SQL = "unit_id, overall_status, round(machine_score, 9) AS machine_score, round(priority_score, 9) AS priority_score, components_normal, components_alerta, components_anormal, components_insufficient, total_components"
MACHINE_ROUND = {"machine_score": 9, "priority_score": 9}


@query("machine_status", f"WITH {machines_sql()} SELECT {MACHINE_SQL} FROM mach")
def machine_status(spark, d):
    return rounded(machines(spark, d), MACHINE_COLUMNS, MACHINE_ROUND)


@query("machine_status_worst", f"WITH {machines_sql(policy='worst')} SELECT {MACHINE_SQL} FROM mach")
def machine_status_worst(spark, d):
    return rounded(machines(spark, d, policy="worst"), MACHINE_COLUMNS, MACHINE_ROUND)


@query(
    "machine_details",
    f"WITH {machines_sql()} SELECT unit_id, component, component_status AS status, round(component_score, 9) AS score, round(signal_coverage, 9) AS signal_coverage FROM comp",
)
def machine_details(spark, d):
    each = machines(spark, d).select("unit_id", F.explode("component_details").alias("c"))
    return each.select("unit_id", F.col("c.component").alias("component"), F.col("c.status").alias("status"), F.round("c.score", 9).alias("score"), F.round("c.signal_coverage", 9).alias("signal_coverage"))


@query(
    "fleet_missing_units",
    f"""WITH {machines_sql()} SELECT {MACHINE_SQL} FROM mach UNION ALL
SELECT s_suppkey, 'InsufficientData', 0.0, 0.0, 0, 0, 0, 3, 3 FROM supplier WHERE s_suppkey NOT IN (SELECT unit_id FROM mach)""",
)
def fleet_missing_units(spark, d):
    some = machines(spark, d)
    return rounded(rollup.with_missing_units(some, t.read(spark, d, "supplier").select(F.col("s_suppkey").alias("unit_id")), len(t.MAP.components)), MACHINE_COLUMNS, MACHINE_ROUND)


BASE_SQL = "Unit, Signal, EstadoMaquina, round(P2, 6) AS P2, round(P5, 6) AS P5, round(P95, 6) AS P95, round(P98, 6) AS P98, sample_count"
BASE_ROUND = {"P2": 6, "P5": 6, "P95": 6, "P98": 6}


@query("baseline_state", f"WITH {base_sql(150)} SELECT {BASE_SQL} FROM own")
def baseline_state(spark, d):
    base = baseline.baselines(t.training(spark, d), t.SIGNALS, "20010101", 150).where(F.col("EstadoMaquina") != baseline.ALL)
    return rounded(base, ["Unit", "Signal", "EstadoMaquina", *baseline.LIMITS, "sample_count"], BASE_ROUND)


@query("baseline_fallback_all", f"WITH {base_sql(200)} SELECT {BASE_SQL} FROM base")
def baseline_fallback_all(spark, d):
    return rounded(baseline.baselines(t.training(spark, d), t.SIGNALS, "20010101", 200), ["Unit", "Signal", "EstadoMaquina", *baseline.LIMITS, "sample_count"], BASE_ROUND)


@query("baseline_first_pick", f"WITH {base_sql(150)}, {PICK} SELECT {BASE_SQL} FROM pick")
def baseline_first_pick(spark, d):
    train = t.training(spark, d)
    return rounded(baseline.picked(baseline.baselines(train, t.SIGNALS, "20010101", 150), baseline.first_seen(train)), ["Unit", "Signal", "EstadoMaquina", *baseline.LIMITS, "sample_count"], BASE_ROUND)


@query(
    "baseline_metadata",
    f"WITH {base_sql(200)} SELECT count(*) AS total_baselines, count(DISTINCT Unit) AS units, count(DISTINCT Signal) AS signals, count(*) FILTER (WHERE EstadoMaquina <> 'All') AS state_specific, count(*) FILTER (WHERE EstadoMaquina = 'All') AS aggregated FROM base",
)
def baseline_metadata(spark, d):
    return baseline.metadata(baseline.baselines(t.training(spark, d), t.SIGNALS, "20010101", 200))


@query(
    "baseline_shifts",
    f"""WITH {TEL}, {long_sql('trl', 'tr')}, cut AS (SELECT *, Fecha >= TIMESTAMP '1998-01-01' AS late FROM trl),
b AS (SELECT late, Unit, Signal, EstadoMaquina, quantile_cont(value, 0.02) AS P2, quantile_cont(value, 0.98) AS P98 FROM cut GROUP BY ALL HAVING count(value) >= 20)
SELECT Unit, Signal, EstadoMaquina, round(abs(n.P2 - o.P2) / nullif(abs(o.P2), 0), 9) AS p2_change, round(abs(n.P98 - o.P98) / nullif(abs(o.P98), 0), 9) AS p98_change,
       coalesce(greatest(abs(n.P2 - o.P2) / nullif(abs(o.P2), 0), abs(n.P98 - o.P98) / nullif(abs(o.P98), 0)) > 0.2, true) AS flagged
FROM (SELECT * FROM b WHERE late) n FULL JOIN (SELECT * FROM b WHERE NOT late) o USING (Unit, Signal, EstadoMaquina)""",
)
def baseline_shifts(spark, d):
    train = t.training(spark, d)
    late = F.col("Fecha") >= F.lit("1998-01-01").cast("timestamp_ntz")
    new, old = (baseline.baselines(train.where(c), t.SIGNALS, "x", 20).where(F.col("EstadoMaquina") != baseline.ALL) for c in (late, ~late))
    out = baseline.shifts(new, old)
    return out.select("Unit", "Signal", "EstadoMaquina", F.round("p2_change", 9).alias("p2_change"), F.round("p98_change", 9).alias("p98_change"), "flagged")


ORDERED = "Fecha, EstadoMaquina, EstadoCarga, l_quantity, l_extendedprice, l_discount, l_tax"
ROW = "Unit, Fecha, EstadoMaquina, EstadoCarga, l_quantity, l_extendedprice, l_discount, l_tax"


def dedup_sql(order: str, of: str = "t") -> str:
    return f"SELECT {ROW} FROM (SELECT *, row_number() OVER (PARTITION BY Unit, Fecha ORDER BY {order}) AS rn FROM {of}) WHERE rn = 1"


ALL_UP = "EstadoMaquina, EstadoCarga, l_quantity, l_extendedprice, l_discount, l_tax"
ALL_DOWN = ", ".join(f"{c} DESC" for c in ALL_UP.split(", "))
REST = ALL_UP.split(", ")


@query("dedup_keep_first", f"WITH {TEL} {dedup_sql(ALL_UP)}")
def dedup_keep_first(spark, d):
    return clean.keep_first(t.telemetry(spark, d), ["Unit", "Fecha"], REST)


@query("dedup_keep_last", f"WITH {TEL} {dedup_sql(ALL_DOWN)}")
def dedup_keep_last(spark, d):
    return clean.keep_last(t.telemetry(spark, d), ["Unit", "Fecha"], REST)


@query(
    "silver_clean",
    f"""WITH {TEL}, dd AS ({dedup_sql(ALL_UP, '(SELECT * FROM t WHERE Fecha IS NOT NULL)')}), st AS (SELECT * FROM dd WHERE EstadoMaquina IN ('A', 'R')),
m AS (SELECT {', '.join(f'avg({s}) AS m_{s}, stddev_pop({s}) AS s_{s}' for s in t.SIGNALS)} FROM st)
SELECT Unit, Fecha, EstadoMaquina, EstadoCarga, {', '.join(f'CASE WHEN s_{s} > 0 AND abs(({s} - m_{s}) / s_{s}) > 1.5 THEN NULL ELSE {s} END AS {s}' for s in t.SIGNALS)} FROM st, m""",
)
def silver_clean(spark, d):
    return clean.clean(t.telemetry(spark, d), t.SIGNALS, states=("A", "R"), limit=1.5)


@query(
    "missing_pct",
    f"WITH {TEL}, m AS (SELECT {', '.join(f'CASE WHEN {s} BETWEEN {a} AND {b} THEN {s} END AS {s}' for s, a, b in (('l_quantity', 10, 40), ('l_discount', 0.06, 1)))} FROM t) "
    + " UNION ALL ".join(f"SELECT '{s}' AS signal, round(100.0::DOUBLE * avg(CASE WHEN {s} IS NULL THEN 1 ELSE 0 END), 9) AS missing_pct, 100.0 * avg(CASE WHEN {s} IS NULL THEN 1 ELSE 0 END) > 50 AS warn FROM m" for s in ("l_quantity", "l_discount")),
)
def missing_pct(spark, d):
    masked = clean.mask_ranges(t.telemetry(spark, d), {"l_quantity": (10, 40), "l_discount": (0.06, 1)})
    return clean.missing_report(masked, ["l_quantity", "l_discount"]).select("signal", F.round("missing_pct", 9).alias("missing_pct"), "warn")


@query(
    "range_mask",
    f"WITH {TEL} SELECT Unit, count(*) AS n, count(CASE WHEN l_quantity BETWEEN 10 AND 40 THEN 1 END) AS quantity, count(CASE WHEN l_discount BETWEEN 0.02 AND 0.05 THEN 1 END) AS discount FROM t GROUP BY Unit",
)
def range_mask(spark, d):
    masked = clean.mask_ranges(t.telemetry(spark, d), {"l_quantity": (10, 40), "l_discount": (0.02, 0.05)})
    return masked.groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.count("l_quantity").alias("quantity"), F.count("l_discount").alias("discount"))


@query(
    "row_thresh",
    f"""WITH {TEL}, m AS (SELECT Unit, CASE WHEN l_quantity BETWEEN 10 AND 20 THEN l_quantity END AS a, CASE WHEN l_extendedprice BETWEEN 0 AND 20000 THEN l_extendedprice END AS b,
CASE WHEN l_discount BETWEEN 0.02 AND 0.05 THEN l_discount END AS c, CASE WHEN l_tax BETWEEN 0 AND 0.03 THEN l_tax END AS e FROM t)
SELECT Unit, count(*) AS n FROM m WHERE (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT + (e IS NOT NULL)::INT >= 2 GROUP BY Unit""",
)
def row_thresh(spark, d):
    masked = clean.mask_ranges(t.telemetry(spark, d), {"l_quantity": (10, 20), "l_extendedprice": (0, 20000), "l_discount": (0.02, 0.05), "l_tax": (0, 0.03)})
    return clean.enough_signals(masked, t.SIGNALS).groupBy("Unit").agg(F.count(F.lit(1)).alias("n"))


def weekly(sql: str) -> str:
    return f"WITH {machines_sql(BY)} {sql}"


@query("weekly_machine_status", weekly(f"SELECT evaluation_year, evaluation_week, {MACHINE_SQL} FROM mach"))
def weekly_machine_status(spark, d):
    return rounded(machines(spark, d, PERIOD), [*PERIOD, *MACHINE_COLUMNS], MACHINE_ROUND)


@query("status_by_week", weekly("SELECT evaluation_year, evaluation_week, overall_status, count(*) AS n FROM mach GROUP BY ALL"))
def status_by_week(spark, d):
    return reports.by_period(machines(spark, d, PERIOD))


@query("status_frequency", weekly("SELECT overall_status AS value, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 9) AS share FROM mach GROUP BY overall_status"))
def status_frequency(spark, d):
    return reports.frequency(machines(spark, d, PERIOD), "overall_status").select("value", "n", F.round("share", 9).alias("share"))


@query(
    "status_pct_pivot",
    weekly(
        "SELECT evaluation_year, evaluation_week, "
        + ", ".join(f"count(*) FILTER (WHERE overall_status = '{s}') AS {s}, round(100.0::DOUBLE * count(*) FILTER (WHERE overall_status = '{s}') / count(*), 9) AS {s}_pct" for s in STATUSES)
        + ", count(*) AS total FROM mach GROUP BY ALL"
    ),
)
def status_pct_pivot(spark, d):
    out = reports.crosstab(machines(spark, d, PERIOD))
    return rounded(out, out.columns, {f"{s}_pct": 9 for s in STATUSES})


@query("status_changes", weekly("SELECT unit_id, count(DISTINCT overall_status) AS n_statuses, string_agg(DISTINCT overall_status, ',' ORDER BY overall_status) AS statuses FROM mach GROUP BY unit_id HAVING count(DISTINCT overall_status) > 1"))
def status_changes(spark, d):
    return reports.changes(machines(spark, d, PERIOD)).withColumn("statuses", F.array_join("statuses", ","))


@query(
    "status_transitions",
    weekly("SELECT unit_id, evaluation_year, evaluation_week, previous_status, overall_status FROM (SELECT *, lag(overall_status) OVER (PARTITION BY unit_id ORDER BY evaluation_year, evaluation_week) AS previous_status FROM mach) WHERE previous_status <> overall_status"),
)
def status_transitions(spark, d):
    return reports.transitions(machines(spark, d, PERIOD)).select("unit_id", *PERIOD, "previous_status", "overall_status")


@query("score_trend", weekly("SELECT evaluation_year, evaluation_week, round(avg(machine_score), 9) AS mean_score, round(median(machine_score), 9) AS median_score, round(max(machine_score), 9) AS max_score FROM mach GROUP BY ALL"))
def score_trend(spark, d):
    out = reports.score_trend(machines(spark, d, PERIOD))
    return rounded(out, out.columns, {"mean_score": 9, "median_score": 9, "max_score": 9})


@query(
    "unit_ranking",
    weekly("SELECT unit_id, round(avg(machine_score), 9) AS mean_score, count(*) FILTER (WHERE overall_status IN ('Alerta', 'Anormal')) AS periods_with_issues, count(*) AS periods, round(100.0::DOUBLE * count(*) FILTER (WHERE overall_status IN ('Alerta', 'Anormal')) / count(*), 9) AS issue_rate FROM mach GROUP BY unit_id"),
)
def unit_ranking(spark, d):
    out = reports.ranking(machines(spark, d, PERIOD), None)
    return rounded(out, out.columns, {"mean_score": 9, "issue_rate": 9})


@query("topk_priority", f"WITH {machines_sql()} SELECT unit_id, round(priority_score, 9) AS priority_score, overall_status FROM mach ORDER BY priority_score DESC, unit_id LIMIT 10")
def topk_priority(spark, d):
    return machines(spark, d).orderBy(F.desc("priority_score"), "unit_id").limit(10).select("unit_id", F.round("priority_score", 9).alias("priority_score"), "overall_status")


@query("dup_keys", f"WITH {TEL} SELECT {ROW} FROM (SELECT *, count(*) OVER (PARTITION BY Unit, Fecha) AS n FROM t) WHERE n > 1")
def dup_keys(spark, d):
    return reports.duplicates(t.telemetry(spark, d), ["Unit", "Fecha"])


@query("week_coverage", weekly('SELECT evaluation_year, evaluation_week, count(*) AS "rows", count(DISTINCT unit_id) AS units FROM mach GROUP BY ALL'))
def week_coverage(spark, d):
    return reports.coverage(machines(spark, d, PERIOD))


@query(
    "degrading",
    weekly("""SELECT unit_id, component, round(avg(component_score) FILTER (WHERE a <= 4), 9) AS recent, round(avg(component_score) FILTER (WHERE b <= 4), 9) AS oldest, count(*) AS periods,
  avg(component_score) FILTER (WHERE a <= 4) > avg(component_score) FILTER (WHERE b <= 4) + 1e-12 AS degrading
FROM (SELECT *, row_number() OVER (PARTITION BY unit_id, component ORDER BY evaluation_year DESC, evaluation_week DESC) AS a,
             row_number() OVER (PARTITION BY unit_id, component ORDER BY evaluation_year, evaluation_week) AS b FROM comp) GROUP BY unit_id, component"""),
)
def degrading(spark, d):
    out = reports.degrading(components(spark, d, PERIOD))
    return out.select("unit_id", "component", F.round("recent", 9).alias("recent"), F.round("oldest", 9).alias("oldest"), "periods", (F.col("recent") > F.col("oldest") + 1e-12).alias("degrading"))


@query(
    "kpi",
    f"""WITH {machines_sql()} SELECT count(*) AS total_units, {', '.join(f"count(*) FILTER (WHERE overall_status = '{s}') AS {s.lower()}_units, round(100.0::DOUBLE * count(*) FILTER (WHERE overall_status = '{s}') / count(*), 9) AS {s.lower()}_pct" for s in STATUSES[:3])}, round(avg(priority_score), 9) AS mean_priority FROM mach""",
)
def kpi(spark, d):
    out = reports.kpis(machines(spark, d))
    return rounded(out, out.columns, {"normal_pct": 9, "alerta_pct": 9, "anormal_pct": 9, "mean_priority": 9})


@query(
    "kpi_deltas",
    weekly("""SELECT *, anormal_units - lag(anormal_units) OVER (ORDER BY evaluation_year, evaluation_week) AS anormal_delta, alerta_units - lag(alerta_units) OVER (ORDER BY evaluation_year, evaluation_week) AS alerta_delta
FROM (SELECT evaluation_year, evaluation_week, count(*) FILTER (WHERE overall_status = 'Anormal') AS anormal_units, count(*) FILTER (WHERE overall_status = 'Alerta') AS alerta_units FROM mach GROUP BY ALL)"""),
)
def kpi_deltas(spark, d):
    return reports.kpi_deltas(machines(spark, d, PERIOD))


@query(
    "run_summary",
    weekly(
        "SELECT m.*, c.* EXCLUDE (evaluation_year, evaluation_week), 'SUCCESS' AS status FROM (SELECT evaluation_year, evaluation_week, count(*) AS machines, "
        + ", ".join(f"count(*) FILTER (WHERE overall_status = '{s}') AS machine_{s.lower()}" for s in STATUSES)
        + " FROM mach GROUP BY ALL) m JOIN (SELECT evaluation_year, evaluation_week, count(*) AS components, "
        + ", ".join(f"count(*) FILTER (WHERE component_status = '{s}') AS component_{s.lower()}" for s in STATUSES)
        + " FROM comp GROUP BY ALL) c ON c.evaluation_year = m.evaluation_year AND c.evaluation_week = m.evaluation_week"
    ),
)
def run_summary(spark, d):
    return reports.run_summary(machines(spark, d, PERIOD), components(spark, d, PERIOD))


@query(
    "history_upsert",
    f"""WITH {machines_sql(BY)}, a AS (SELECT unit_id, evaluation_year, evaluation_week, overall_status, machine_score FROM mach WHERE evaluation_week <= 30),
b AS (SELECT unit_id, evaluation_year, evaluation_week, 'Anormal' AS overall_status, machine_score + 1 AS machine_score FROM mach WHERE evaluation_week >= 20)
SELECT unit_id, evaluation_year, evaluation_week, overall_status, round(machine_score, 9) AS machine_score FROM b UNION ALL
SELECT unit_id, evaluation_year, evaluation_week, overall_status, round(machine_score, 9) FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.unit_id = a.unit_id AND b.evaluation_year = a.evaluation_year AND b.evaluation_week = a.evaluation_week)""",
)
def history_upsert(spark, d):
    rows = machines(spark, d, PERIOD).select("unit_id", *PERIOD, "overall_status", "machine_score")
    old = rows.where("evaluation_week <= 30")
    new = rows.where("evaluation_week >= 20").withColumns({"overall_status": F.lit("Anormal"), "machine_score": F.col("machine_score") + 1})
    return merged(old, new, MACHINE_KEY).select("unit_id", *PERIOD, "overall_status", F.round("machine_score", 9).alias("machine_score"))


ALERTS = f"""WITH {signals_sql()}, al AS (SELECT unit_id AS Unit, ts AS Fecha, signal_name AS Trigger, value, P98 AS upper, P2 AS lower, state AS State FROM sev WHERE severity >= 3)"""


@query("alerts_narrow", f"{ALERTS} SELECT Fecha, Unit, Trigger, CASE WHEN Trigger = 'l_quantity' THEN 'Logistics' ELSE 'Unknown' END AS System, value, round(upper, 6) AS upper, round(lower, 6) AS lower FROM al")
def alerts_narrow(spark, d):
    out = alerts.narrow(scored(spark, d), systems={"l_quantity": ("Logistics", "Volume")})
    return out.select("Fecha", "Unit", "Trigger", "System", "value", F.round("upper", 6).alias("upper"), F.round("lower", 6).alias("lower"))


@query(
    "alerts_wide",
    f"""{ALERTS}, w AS (SELECT unit_id, ts, {', '.join(f"max(value) FILTER (WHERE signal_name = '{s}') AS {s}_Value, round(max(P98) FILTER (WHERE signal_name = '{s}'), 6) AS {s}_Upper_Limit, round(max(P2) FILTER (WHERE signal_name = '{s}'), 6) AS {s}_Lower_Limit" for s in t.SIGNALS)} FROM sev GROUP BY unit_id, ts)
SELECT al.Unit, al.Fecha AS TimeStart, Trigger, w.* EXCLUDE (unit_id, ts) FROM al JOIN w ON w.unit_id = al.Unit AND w.ts = al.Fecha""",
)
def alerts_wide(spark, d):
    rows = scored(spark, d)
    out = alerts.wide(alerts.narrow(rows), rows, t.SIGNALS)
    limits = [c for c in out.columns if c.endswith("_Limit")]
    return out.select("Unit", "TimeStart", "Trigger", *(F.round(c, 6).alias(c) if c in limits else F.col(c) for c in out.columns if c not in ("Unit", "TimeStart", "Trigger", "AlertID", "State")))


@query("alerts_by_trigger", f"{ALERTS} SELECT Trigger, strftime(Fecha, '%Y-%m') AS month, count(*) AS n FROM al GROUP BY ALL")
def alerts_by_trigger(spark, d):
    return alerts.counts(alerts.narrow(scored(spark, d)), "Trigger", F.date_format("Fecha", "yyyy-MM").alias("month"))


@query("alerts_matrix", f"{ALERTS} SELECT Unit, {', '.join(f'''count(*) FILTER (WHERE Trigger = '{s}') AS {s}''' for s in t.SIGNALS)} FROM al GROUP BY Unit")
def alerts_matrix(spark, d):
    return alerts.unit_trigger_matrix(alerts.narrow(scored(spark, d)), t.SIGNALS)


@query(
    "alert_integrity",
    """WITH a AS (SELECT o_orderkey AS AlertID, o_custkey AS Unit, o_orderpriority AS Trigger FROM orders WHERE o_orderkey % 10 <> 3),
d AS (SELECT o_orderkey AS AlertID, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_custkey END AS Unit, o_orderpriority AS Trigger FROM orders WHERE o_orderkey % 10 <> 5)
SELECT coalesce(a.AlertID, d.AlertID) AS AlertID, CASE WHEN d.AlertID IS NULL THEN 'no detail' WHEN a.AlertID IS NULL THEN 'no alert' ELSE 'differs' END AS problem
FROM a FULL JOIN d ON a.AlertID = d.AlertID WHERE a.AlertID IS NULL OR d.AlertID IS NULL OR a.Unit IS DISTINCT FROM d.Unit OR a.Trigger IS DISTINCT FROM d.Trigger""",
)
def alert_integrity(spark, d):
    rows = t.read(spark, d, "orders").select(F.col("o_orderkey").alias("AlertID"), F.col("o_custkey").alias("Unit"), F.col("o_orderpriority").alias("Trigger"))
    details = rows.where("AlertID % 10 <> 5").withColumn("Unit", F.when(F.col("AlertID") % 7 == 0, F.lit(-1).cast("long")).otherwise(F.col("Unit")))
    return quality.alert_rules(rows.where("AlertID % 10 <> 3"), details)


@query(
    "silver_checks",
    f"""WITH {TEL}, n AS (SELECT *, count(*) OVER (PARTITION BY Unit, Fecha) AS k FROM t)
SELECT 'null_key' AS check_name, 'ERROR' AS severity, count(*) FILTER (WHERE Unit IS NULL OR Fecha IS NULL) AS failed_rows FROM n
UNION ALL SELECT 'future_time', 'ERROR', count(*) FILTER (WHERE Fecha > TIMESTAMP '2001-06-01') FROM n
UNION ALL SELECT 'duplicate_key', 'ERROR', count(*) FILTER (WHERE k > 1) FROM n
UNION ALL SELECT 'unit_name', 'WARNING', count(*) FILTER (WHERE NOT regexp_matches(CAST(Unit AS VARCHAR), '^[A-Z0-9_\\-]+$')) FROM n
UNION ALL SELECT 'range_l_quantity', 'WARNING', count(*) FILTER (WHERE NOT l_quantity BETWEEN 2 AND 40) FROM n""",
)
def silver_checks(spark, d):
    return quality.silver(t.telemetry(spark, d), {"l_quantity": (2, 40)}, now=F.lit("2001-06-01").cast("timestamp_ntz")).drop("message")


@query(
    "machine_checks",
    weekly("""SELECT * FROM (VALUES ('status_domain', 'ERROR', 0::BIGINT), ('counts_add_up', 'ERROR', 0), ('score_not_negative', 'ERROR', 0), ('priority_formula', 'ERROR', 0), ('unique_key', 'ERROR', 0)) AS v(check_name, severity, failed_rows)
UNION ALL SELECT 'anormal_has_component', 'WARNING', count(*) FILTER (WHERE overall_status = 'Anormal' AND components_anormal < 1) FROM mach
UNION ALL SELECT 'normal_has_none', 'WARNING', count(*) FILTER (WHERE overall_status = 'Normal' AND components_alerta + components_anormal > 0) FROM mach"""),
)
def machine_checks(spark, d):
    return quality.machine_rules(machines(spark, d, PERIOD)).drop("message")


@query("completeness", "SELECT s_suppkey AS unit_id FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_shipdate >= TIMESTAMP '2001-01-01')")
def completeness(spark, d):
    units = t.read(spark, d, "supplier").select(F.col("s_suppkey").alias("unit_id"))
    return quality.completeness(units, t.current(spark, d).where("l_quantity > 49").select(F.col("Unit").alias("unit_id")))



@query(
    "boxplot_stats",
    f"""WITH {TEL}, {long_sql('evl', 'ev')} SELECT Signal AS signal_name, EstadoMaquina AS state, min(value) AS low, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS high, round(avg(value), 6) AS mean, count(value) AS n FROM evl GROUP BY ALL""",
)
def boxplot_stats(spark, d):
    out = reports.boxplot(scoring.long_form(t.current(spark, d), t.SIGNALS), ["signal_name", "state"])
    return rounded(out, out.columns, {"q1": 6, "median": 6, "q3": 6, "mean": 6})


@query(
    "histogram",
    f"""WITH {TEL}, e AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b FROM t),
x AS (SELECT CAST(least(49, floor((l_extendedprice - a) / (b - a) * 50)) AS INTEGER) AS bin, a, b FROM t, e)
SELECT bin, round(any_value(a) + bin * (any_value(b) - any_value(a)) / 50, 6) AS low, count(*) AS n FROM x GROUP BY bin""",
)
def histogram(spark, d):
    return reports.histogram(t.telemetry(spark, d), "l_extendedprice").select("bin", F.round("low", 6).alias("low"), "n")


@query(
    "signal_summary",
    f"WITH {TEL} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS signal, count({s}) AS n, round(avg({s}), 8) AS mean, round(stddev_samp({s}), 8) AS std, min({s}) AS min, round(quantile_cont({s}, 0.25), 6) AS q1, round(quantile_cont({s}, 0.5), 6) AS median, round(quantile_cont({s}, 0.75), 6) AS q3, max({s}) AS max FROM t"
        for s in t.SIGNALS
    ),
)
def signal_summary(spark, d):
    out = reports.summary(t.telemetry(spark, d), t.SIGNALS)
    return rounded(out, out.columns, {"mean": 8, "std": 8, "q1": 6, "median": 6, "q3": 6})


PAIRS = [(a, b) for i, a in enumerate(t.SIGNALS) for b in t.SIGNALS[i + 1 :]]


@query("corr_matrix", f"WITH {TEL} " + " UNION ALL ".join(f"SELECT '{a}' AS signal_a, '{b}' AS signal_b, round(corr({a}, {b}), 6) AS corr FROM t" for a, b in PAIRS))
def corr_matrix(spark, d):
    return reports.correlations(t.telemetry(spark, d), t.SIGNALS).select("signal_a", "signal_b", F.round("corr", 6).alias("corr"))


@query(
    "observed_range",
    f"WITH {TEL}, {long_sql('evl', 'ev')} SELECT Unit AS unit_id, Signal AS signal_name, min(value) AS observed_min, max(value) AS observed_max, round(avg(value), 6) AS observed_mean FROM evl GROUP BY ALL",
)
def observed_range(spark, d):
    out = scoring.observed(t.current(spark, d), t.SIGNALS)
    return rounded(out, out.columns, {"observed_mean": 6})


@query(
    "anomaly_heatmap",
    f"WITH {signals_sql()} SELECT signal_name, strftime(ts, '%Y-%m') AS slot, count(*) FILTER (WHERE severity > 0) AS anomalies, count(severity) AS readings, round(count(*) FILTER (WHERE severity > 0)::DOUBLE / count(severity), 9) AS rate FROM sev GROUP BY ALL",
)
def anomaly_heatmap(spark, d):
    out = reports.heatmap(scored(spark, d), F.date_format("ts", "yyyy-MM"))
    return rounded(out, out.columns, {"rate": 9})


@query("data_profile", f'WITH {TEL} SELECT count(*) AS "rows", count(DISTINCT Unit) AS units, min(Fecha) AS first_time, max(Fecha) AS last_time FROM t')
def data_profile(spark, d):
    return reports.data_profile(t.telemetry(spark, d), "Unit", "Fecha")


@query(
    "robust_scale",
    f"""WITH {TEL}, s AS (SELECT median(l_quantity) AS m1, quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS i1, median(l_extendedprice) AS m2, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS i2 FROM tr)
SELECT Unit, count(*) AS n, round(avg((l_quantity - m1) / i1), 6) AS quantity, round(max((l_extendedprice - m2) / i2), 6) AS price FROM ev, s GROUP BY Unit""",
)
def robust_scale(spark, d):
    from fleethealth.functions.values import robust_scaled

    stats = features.scaler_stats(t.training(spark, d), ["l_quantity", "l_extendedprice"])
    row = stats.agg(*(F.max(F.when(F.col("signal") == s, F.col(c))).alias(f"{s}_{c}") for s in ("l_quantity", "l_extendedprice") for c in ("median", "iqr")))
    rows = t.current(spark, d).crossJoin(F.broadcast(row))
    scaled = {s: robust_scaled(F.col(s), F.col(f"{s}_median"), F.col(f"{s}_iqr")) for s in ("l_quantity", "l_extendedprice")}
    return rows.groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(scaled["l_quantity"]), 6).alias("quantity"), F.round(F.max(scaled["l_extendedprice"]), 6).alias("price"))


@query(
    "one_hot",
    f"""WITH {TEL} SELECT Unit, sum(CASE WHEN EstadoMaquina = 'N' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS state_N, sum(CASE WHEN EstadoMaquina = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS state_R FROM ev GROUP BY Unit""",
)
def one_hot(spark, d):
    from fleethealth.functions.values import one_hot as encode

    rows = t.current(spark, d)
    columns = encode(F.col("EstadoMaquina"), ["A", "N", "R"], "state")
    return rows.select("Unit", *columns).groupBy("Unit").agg(F.sum("state_N").alias("state_N"), F.sum("state_R").alias("state_R"))


@query("vocabulary", "SELECT CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS position, l_returnflag AS value FROM (SELECT DISTINCT l_returnflag FROM lineitem)")
def vocabulary(spark, d):
    return features.vocabulary(t.telemetry(spark, d), "EstadoMaquina")


@query(
    "ols_simple",
    f"WITH {TEL} SELECT Unit, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM t GROUP BY Unit",
)
def ols_simple(spark, d):
    out = regress.simple(t.telemetry(spark, d), ["Unit"], "l_extendedprice", "l_quantity")
    return rounded(out, out.columns, {"slope": 6, "intercept": 4, "r2": 6})


@query(
    "ols_multiple",
    f"""WITH {TEL}, c AS (SELECT count(*)::DOUBLE AS n, covar_pop(l_extendedprice, l_quantity) AS y1, covar_pop(l_extendedprice, l_tax) AS y2, var_pop(l_quantity) AS v1, var_pop(l_tax) AS v2, covar_pop(l_quantity, l_tax) AS c12,
 avg(l_extendedprice) AS my, avg(l_quantity) AS m1, avg(l_tax) AS m2, var_pop(l_extendedprice) AS vy FROM t),
b AS (SELECT *, (y1 * v2 - y2 * c12) / (v1 * v2 - c12 * c12) AS b1, (y2 * v1 - y1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM c),
r AS (SELECT *, vy - b1 * y1 - b2 * y2 AS s2 FROM b)
SELECT CAST(n AS BIGINT) AS n, round(my - b1 * m1 - b2 * m2, 3) AS intercept, round(b1, 3) AS quantity, round(b2, 3) AS tax, round(1 - s2 / vy, 6) AS r2,
 round((n * (ln(2 * pi() * s2) + 1) + 6) / n, 6) AS aic_per_row, round((n * (ln(2 * pi() * s2) + 1) + 3 * ln(n)) / n, 6) AS bic_per_row FROM r""",
)
def ols_multiple(spark, d):
    f = regress.ols(t.telemetry(spark, d), "l_extendedprice", ["l_quantity", "l_tax"])
    row = (f.n, round(f.coefficients["Intercept"], 3), round(f.coefficients["l_quantity"], 3), round(f.coefficients["l_tax"], 3), round(f.r2, 6), round(f.aic / f.n, 6), round(f.bic / f.n, 6))
    return spark.createDataFrame([row], "n long, intercept double, quantity double, tax double, r2 double, aic_per_row double, bic_per_row double")


@query(
    "score_blend",
    f"WITH {signals_sql()} SELECT unit_id, signal_name, round(0.6::DOUBLE * window_score_normalized + 0.4::DOUBLE * max_score, 9) AS blended, CASE WHEN window_score_normalized / 10 >= 0.05 THEN 'Anormal' WHEN window_score_normalized / 10 >= 0.01 THEN 'Alerta' ELSE 'Normal' END AS model_status FROM sig",
)
def score_blend(spark, d):
    rows = evaluated(spark, d, cfg=Scoring())[0]
    return rows.select("unit_id", "signal_name", F.round(scoring.blended(F.col("window_score_normalized"), F.col("max_score")), 9).alias("blended"), scoring.model_status(F.col("window_score_normalized") / 10).alias("model_status"))
