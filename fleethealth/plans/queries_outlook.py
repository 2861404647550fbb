"""Queries of forecasts, positions, weeks side by side and pages of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleethealth.operators import alerts, quality, reconstruct, reports
from fleethealth.plans.queries_series import SER, series
from fleethealth.plans.queries_telemetry import ALERTS, TEL, machines, machines_sql, scored
from fleethealth.plans.registry import query
from fleethealth.plans.weekly import with_period
from fleethealth.sources import readers
from fleethealth.sources import tables as t

#: Events have 45 to 99 readings a user.
POINTS = 60

FORECAST = f"""WITH {SER},
r AS (SELECT Unit, value AS y, epoch_us(Fecha) AS us, epoch_us(Fecha) / 86400000000.0::DOUBLE AS t, CAST(hour(Fecha) AS INTEGER) AS h FROM e WHERE value IS NOT NULL),
line AS (SELECT Unit, regr_slope(y, t) AS slope, regr_intercept(y, t) AS level, max(us) AS last, count(*) AS n FROM r GROUP BY Unit HAVING count(*) >= {POINTS}),
season AS (SELECT Unit, h, avg(y - (slope * t + level)) AS season, var_pop(y - (slope * t + level)) * count(*) AS squares FROM r JOIN line USING (Unit) GROUP BY Unit, h),
spread AS (SELECT Unit, sum(squares) AS squares FROM season GROUP BY Unit),
step AS (SELECT line.*, squares, CAST(s AS INTEGER) AS step, last + s * 3600000000 AS us FROM line JOIN spread USING (Unit), range(1, 169) AS x(s)),
made AS (SELECT step.Unit, step.step, step.slope * (step.us / 86400000000.0::DOUBLE) + step.level + coalesce(season.season, 0.0::DOUBLE) AS forecast, {reconstruct.BAND!r}::DOUBLE * sqrt(step.squares / step.n) AS width
         FROM step LEFT JOIN season ON season.Unit = step.Unit AND season.h = hour(make_timestamp(step.us)))"""


def made(spark, d):
    return reconstruct.forecast(series(spark, d), "Unit", "value", "Fecha", 7, POINTS)


@query("forecast", f"{FORECAST} SELECT Unit, step, round(forecast, 4) AS forecast, round(forecast - width, 4) AS lower, round(forecast + width, 4) AS upper FROM made")
def forecast(spark, d):
    return made(spark, d).select("Unit", "step", *(F.round(c, 4).alias(c) for c in ("forecast", "lower", "upper")))


@query(
    "forecast_status",
    f"""{FORECAST}, lim AS (SELECT Unit, quantile_cont(value, 0.3) AS lo, quantile_cont(value, 0.7) AS hi FROM e GROUP BY Unit),
m AS (SELECT Unit, avg(forecast) AS a, avg(forecast - width) AS b, avg(forecast + width) AS c FROM made GROUP BY Unit)
SELECT m.Unit, round(a, 4) AS forecast_mean, round(b, 4) AS forecast_lower, round(c, 4) AS forecast_upper,
       CASE WHEN lo IS NULL THEN 'InsufficientData' WHEN a < lo OR a > hi THEN 'Alerta' ELSE 'Normal' END AS predicted_status FROM m LEFT JOIN lim ON lim.Unit = m.Unit""",
)
def forecast_status(spark, d):
    """Narrower limits than a baseline's, over all units, so that both statuses occur; a unit without limits is tested on a fixture."""
    limits = series(spark, d).groupBy("Unit").agg(F.percentile("value", F.array(F.lit(0.3), F.lit(0.7))).alias("p")).select("Unit", F.col("p")[0].alias("P5"), F.col("p")[1].alias("P95"))
    out = reconstruct.forecast_status(made(spark, d), limits, "Unit")
    return out.select("Unit", *(F.round(f"forecast_{c}", 4).alias(f"forecast_{c}") for c in ("mean", "lower", "upper")), "predicted_status")


@query(
    "position_jumps",
    f"""WITH {SER}, p AS (SELECT event_id, Unit, Fecha, radians(-30 + value / 100) AS la, radians(-71 + k / 50) AS lo FROM e),
l AS (SELECT *, lag(la) OVER w AS la0, lag(lo) OVER w AS lo0 FROM p WINDOW w AS (PARTITION BY Unit ORDER BY Fecha)),
j AS (SELECT event_id, 2 * 6371.0088::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin((la - la0) / 2), 2) + cos(la0) * cos(la) * pow(sin((lo - lo0) / 2), 2)))) AS km FROM l WHERE la0 IS NOT NULL)
SELECT event_id, round(km, 6) AS jump_km FROM j WHERE km > 100""",
)
def position_jumps(spark, d):
    placed = series(spark, d).withColumns({"GPSLat": -30 + F.col("value") / 100, "GPSLon": -71 + F.col("k") / 50})
    return quality.position_jumps(placed).select("event_id", F.round("jump_km", 6).alias("jump_km"))


@query(
    "weekly_boxplots",
    f"""WITH {TEL}, p AS (SELECT year(Fecha) AS y, CAST(strftime(Fecha, '%W') AS INTEGER) AS w, l_quantity AS v FROM t)
SELECT printf('W%02d-%d', w, y) AS week_label, w = 30 AS is_current, min(v) AS low, round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
       round(quantile_cont(v, 0.75), 6) AS q3, max(v) AS high, round(avg(v), 6) AS mean, count(v) AS n FROM p WHERE y = 2000 AND w BETWEEN 24 AND 30 GROUP BY y, w""",
)
def weekly_boxplots(spark, d):
    weeks = readers.previous_weeks(with_period(t.telemetry(spark, d), "Fecha"), 2000, 30, 6, "evaluation_year", "evaluation_week")
    out = reports.boxplot(weeks, ["week_label", "is_current"], "l_quantity")
    return out.select("week_label", "is_current", "low", *(F.round(c, 6).alias(c) for c in ("q1", "median", "q3")), "high", F.round("mean", 6).alias("mean"), "n")


@query("alerts_per_month", f"{ALERTS} SELECT strftime(Fecha, '%Y-%m') AS month, count(*) AS n FROM al GROUP BY ALL")
def alerts_per_month(spark, d):
    return alerts.per_month(alerts.narrow(scored(spark, d)))


@query("ranking_page", f"WITH {machines_sql()} SELECT unit_id, overall_status, round(priority_score, 9) AS priority_score FROM mach ORDER BY mach.priority_score DESC, unit_id LIMIT 5 OFFSET 5")
def ranking_page(spark, d):
    """The second page of five of the fleet's ranking."""
    return reports.page(machines(spark, d), [F.desc("priority_score"), "unit_id"], 5, 1).select("unit_id", "overall_status", F.round("priority_score", 9).alias("priority_score"))


@query(
    "state_conflicts",
    f"WITH {SER} SELECT event_id, EstadoMaquina, value FROM e WHERE (EstadoMaquina = 'click' AND abs(value) > 1) OR (EstadoMaquina IN ('view', 'purchase') AND value = 0)",
)
def state_conflicts(spark, d):
    return quality.state_conflicts(series(spark, d), ["click"], ["view", "purchase"], "value").select("event_id", "EstadoMaquina", "value")
