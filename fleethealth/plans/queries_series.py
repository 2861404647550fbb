"""Queries of series, cycles, windows and the health index, on events as telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethealth.config import Health, Windowing
from fleethealth.functions import dates
from fleethealth.functions.values import percent
from fleethealth.operators import alerts, clean, health, reconstruct, resample, sessions, windows
from fleethealth.plans.health_index import long_blocks, score_pairs
from fleethealth.plans.registry import query
from fleethealth.sources import tables as t

SER = """
e AS (SELECT user_id AS Unit, ts AS Fecha, event_type AS EstadoMaquina, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_id FROM events)"""
GAP_MIN = 720

NUMBERED = f"""
g AS (SELECT *, CASE WHEN lag(Fecha) OVER w IS NULL OR epoch_us(Fecha) - epoch_us(lag(Fecha) OVER w) > {GAP_MIN * 60_000_000} THEN 1 ELSE 0 END AS fresh FROM e WINDOW w AS (PARTITION BY Unit ORDER BY Fecha)),
c AS (SELECT * EXCLUDE (fresh), CAST(sum(fresh) OVER (PARTITION BY Unit ORDER BY Fecha ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cycle_id FROM g),
s AS (SELECT Unit, cycle_id, min(Fecha) AS start_time, max(Fecha) AS end_time, count(*) AS n_rows, (epoch_us(max(Fecha)) - epoch_us(min(Fecha))) / 60000000.0::DOUBLE AS duration_min FROM c GROUP BY Unit, cycle_id)"""

HALF_EVEN = "round_even(duration_min, 0)"


def series(spark, d) -> DataFrame:
    return t.event_series(spark, d)


def cycles(spark, d) -> DataFrame:
    return sessions.numbered(series(spark, d), GAP_MIN)


@query("sessions", f"WITH {SER}, {NUMBERED} SELECT Unit, cycle_id, start_time, end_time, n_rows, round(duration_min, 6) AS duration_min FROM s")
def session_list(spark, d):
    return sessions.summary(cycles(spark, d)).select("Unit", "cycle_id", "start_time", "end_time", "n_rows", F.round("duration_min", 6).alias("duration_min"))


VALID = f"v AS (SELECT Unit, cycle_id FROM s WHERE duration_min >= 120 AND n_rows / ({HALF_EVEN} + 1) >= 0.004::DOUBLE)"


@query("valid_sessions", f"WITH {SER}, {NUMBERED}, {VALID} SELECT c.Unit, c.cycle_id, count(*) AS n, round(sum(value), 4) AS total FROM c JOIN v ON v.Unit = c.Unit AND v.cycle_id = c.cycle_id GROUP BY ALL")
def valid_sessions(spark, d):
    good = sessions.valid(cycles(spark, d), 120, 0.004)
    return good.groupBy("Unit", "cycle_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("session_diffs", f"WITH {SER}, {NUMBERED} SELECT event_id, cycle_id, round(value - lag(value) OVER (PARTITION BY Unit, cycle_id ORDER BY Fecha), 9) AS value_diff FROM c")
def session_diffs(spark, d):
    return cycles(spark, d).select("event_id", "cycle_id", F.round(sessions.diff("value"), 9).alias("value_diff"))


def bin_sql(c: str, edges, labels) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL " + " ".join(f"WHEN {c} <= {e} THEN '{x}'" for e, x in zip(edges, labels)) + f" ELSE '{labels[-1]}' END"


MOVES = f"""mv AS (SELECT *, value - lag(value) OVER (PARTITION BY Unit, cycle_id ORDER BY Fecha) AS acc, k - lag(k) OVER (PARTITION BY Unit, cycle_id ORDER BY Fecha) AS climb FROM c),
bn AS (SELECT *, {bin_sql('acc', *sessions.ACCELERATION)} AS acc_bin, {bin_sql('climb', *sessions.ELEVATION)} AS climb_bin FROM mv)"""


@query("binned_group_means", f"WITH {SER}, {NUMBERED}, {MOVES} SELECT EstadoMaquina, acc_bin, climb_bin, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM bn GROUP BY ALL ORDER BY n DESC, EstadoMaquina NULLS FIRST, acc_bin NULLS FIRST, climb_bin NULLS FIRST LIMIT 15")
def binned_group_means(spark, d):
    moved = sessions.movements(cycles(spark, d), "value", "k").withColumnsRenamed({"GroundAccCategorical": "acc_bin", "ElevationChangeCategorical": "climb_bin"})
    return sessions.group_means(moved, ["EstadoMaquina", "acc_bin", "climb_bin"], "value").select("EstadoMaquina", "acc_bin", "climb_bin", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    "cycle_labels",
    f"""WITH {SER}, {NUMBERED}, b AS (SELECT Unit, quantile_cont(value, 0.05) AS p5, quantile_cont(value, 0.95) AS p95 FROM e GROUP BY Unit),
o AS (SELECT c.Unit, cycle_id, avg(CASE WHEN value BETWEEN p5 AND p95 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS share FROM c JOIN b ON b.Unit = c.Unit GROUP BY ALL)
SELECT Unit, cycle_id, round(share, 9) AS share, CASE WHEN share > 0.05::DOUBLE THEN 'Anomalous' ELSE 'Normal' END AS cycle_label FROM o""",
)
def cycle_labels(spark, d):
    rows = cycles(spark, d)
    limits = series(spark, d).groupBy("Unit").agg(F.percentile("value", F.array(F.lit(0.05), F.lit(0.95))).alias("q"))
    share = rows.join(limits, "Unit").groupBy("Unit", "cycle_id").agg(F.avg(F.when(F.col("value").between(F.col("q")[0], F.col("q")[1]), 0.0).otherwise(1.0)).alias("share"))
    return sessions.labelled(share, F.col("share")).select("Unit", "cycle_id", F.round("share", 9).alias("share"), "cycle_label")


HOURLY = """
h AS (SELECT user_id AS Unit, date_trunc('hour', ts) AS Fecha, max(event_type) AS EstadoMaquina, avg(value) AS value FROM events GROUP BY ALL),
b AS (SELECT Unit, min(Fecha) AS a, max(Fecha) AS z FROM h GROUP BY Unit),
gr AS (SELECT Unit, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS Fecha FROM b),
j AS (SELECT gr.Unit, CAST(gr.Fecha AS TIMESTAMP) AS Fecha, h.EstadoMaquina, h.value, CASE WHEN h.Unit IS NULL THEN 1 ELSE 0 END AS created FROM gr LEFT JOIN h ON h.Unit = gr.Unit AND h.Fecha = gr.Fecha)"""

FILLED = """
n AS (SELECT *, row_number() OVER (PARTITION BY Unit ORDER BY Fecha) AS rn FROM j),
p AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN {'v': value, 't': Fecha, 'n': rn} END IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a,
             first_value(CASE WHEN value IS NOT NULL THEN {'v': value, 't': Fecha, 'n': rn} END IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS z FROM n),
i AS (SELECT *, CASE WHEN value IS NOT NULL THEN value WHEN a IS NOT NULL AND z IS NOT NULL AND rn - a.n <= 10
        THEN a.v + (z.v - a.v) * (epoch_us(Fecha) - epoch_us(a.t))::DOUBLE / (epoch_us(z.t) - epoch_us(a.t))::DOUBLE END AS filled FROM p)"""


def hourly(spark, d) -> DataFrame:
    rows = t.read(spark, d, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("Fecha")
    return rows.groupBy(F.col("user_id").alias("Unit"), hour).agg(F.max("event_type").alias("EstadoMaquina"), F.avg("value").alias("value"))


def regular(spark, d) -> DataFrame:
    return resample.regular(hourly(spark, d), ["value"], ["EstadoMaquina"], "1 hour")


@query("grid", f"WITH {HOURLY} SELECT Unit, count(*) AS n, CAST(sum(created) AS BIGINT) AS created, min(Fecha) AS first_time, max(Fecha) AS last_time FROM j GROUP BY Unit")
def grid(spark, d):
    out = resample.on_grid(hourly(spark, d), "1 hour")
    return out.groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("created_by_reindex").cast("long")).alias("created"), F.min("Fecha").alias("first_time"), F.max("Fecha").alias("last_time"))


@query("interpolate", f"WITH {HOURLY}, {FILLED} SELECT Unit, Fecha, round(filled, 10) AS value FROM i WHERE filled IS NOT NULL")
def interpolate(spark, d):
    return regular(spark, d).where("value is not null").select("Unit", "Fecha", F.round("value", 10).alias("value"))


@query(
    "ffill_bfill",
    f"""WITH {HOURLY} SELECT Unit, Fecha, coalesce(last_value(EstadoMaquina IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
first_value(EstadoMaquina IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS EstadoMaquina FROM j""",
)
def ffill_bfill(spark, d):
    return regular(spark, d).select("Unit", "Fecha", "EstadoMaquina")


@query("impute_flags", f"WITH {HOURLY}, {FILLED} SELECT Unit, count(*) AS n, CAST(sum(created) AS BIGINT) AS created, count(*) FILTER (WHERE value IS NULL AND filled IS NOT NULL) AS imputed, count(filled) AS known FROM i GROUP BY Unit")
def impute_flags(spark, d):
    return regular(spark, d).groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("created_by_reindex").cast("long")).alias("created"), F.sum(F.col("n_imputed_signals").cast("long")).alias("imputed"), F.count("value").alias("known"))


@query(
    "impute_pairs",
    f"""WITH {SER}, m AS (SELECT *, CASE WHEN k > 40 THEN k END AS kk FROM e), s AS (SELECT *, avg(CASE WHEN kk IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER (PARTITION BY Unit) AS share FROM m)
SELECT event_id, CASE WHEN share <= 0.5 THEN coalesce(last_value(kk IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(kk IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) END AS k FROM s""",
)
def impute_pairs(spark, d):
    masked = series(spark, d).withColumn("k", F.when(F.col("k") > 40, F.col("k")))
    return resample.impute_pairs(masked, ["k"]).select("event_id", "k")


@query("rolling_mean", f"WITH {SER} SELECT event_id, round(m, 6) AS rolling_mean FROM (SELECT event_id, avg(value) OVER w AS m, count(*) OVER w AS n FROM e WINDOW w AS (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)) WHERE n = 10")
def rolling_mean(spark, d):
    return windows.rolling_mean(series(spark, d), "value", 10).select("event_id", F.round("rolling_mean", 6).alias("rolling_mean"))


GATE = Windowing(size=24, step=3, min_numeric_coverage=0.5, min_row_coverage=0.5, max_created_fraction=0.95, max_imputed_fraction=0.8)


@query(
    "sliding_gate",
    f"""WITH {HOURLY}, {FILLED}, o AS (SELECT Unit, Fecha, rn - 1 AS start_idx, count(*) OVER w AS n, max(Fecha) OVER w AS end_time, sum(CASE WHEN filled IS NOT NULL THEN 1 ELSE 0 END) OVER w / 24.0::DOUBLE AS numeric_coverage,
 sum(created) OVER w / 24.0::DOUBLE AS created_fraction, sum(CASE WHEN value IS NULL AND filled IS NOT NULL THEN 1 ELSE 0 END) OVER w / 24.0::DOUBLE AS imputed_fraction FROM i WINDOW w AS (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING))
SELECT Unit, CAST(start_idx AS BIGINT) AS start_idx, Fecha AS start_time, end_time, round(numeric_coverage, 9) AS numeric_coverage, round(created_fraction, 9) AS created_fraction, round(imputed_fraction, 9) AS imputed_fraction
FROM o WHERE n = 24 AND start_idx % 3 = 0 AND numeric_coverage >= 0.5 AND created_fraction <= 0.95 AND imputed_fraction <= 0.8""",
)
def sliding_gate(spark, d):
    out = windows.sliding(regular(spark, d), ["value"], GATE)
    return out.select("Unit", F.col("start_idx").cast("long").alias("start_idx"), "start_time", "end_time", *(F.round(c, 9).alias(c) for c in ("numeric_coverage", "created_fraction", "imputed_fraction")))


@query(
    "window_tensors",
    f"""WITH {HOURLY}, {FILLED}, f AS (SELECT Unit, Fecha, rn, value, filled, created, coalesce(last_value(filled IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(filled IGNORE NULLS) OVER (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS x FROM i),
o AS (SELECT Unit, rn - 1 AS start_idx, count(*) OVER w AS n, sum(CASE WHEN filled IS NOT NULL THEN 1 ELSE 0 END) OVER w / 24.0::DOUBLE AS nc, sum(created) OVER w / 24.0::DOUBLE AS cf, sum(CASE WHEN value IS NULL AND filled IS NOT NULL THEN 1 ELSE 0 END) OVER w / 24.0::DOUBLE AS im,
 sum(CAST(x AS FLOAT)::DOUBLE) OVER w AS total FROM f WINDOW w AS (PARTITION BY Unit ORDER BY Fecha ROWS BETWEEN CURRENT ROW AND 23 FOLLOWING))
SELECT Unit, CAST(start_idx AS BIGINT) AS start_idx, 24 AS steps, round(total, 3) AS total FROM o WHERE n = 24 AND start_idx % 3 = 0 AND nc >= 0.5 AND cf <= 0.95 AND im <= 0.8""",
)
def window_tensors(spark, d):
    out = windows.sliding_tensors(regular(spark, d), ["value"], ["value"], GATE)
    total = F.aggregate("x", F.lit(0.0), lambda a, r: a + r[0].cast("double"))
    return out.select("Unit", F.col("start_idx").cast("long").alias("start_idx"), F.size("x").alias("steps"), F.round(total, 3).alias("total"))


BLOCK = """
r AS (SELECT *, row_number() OVER (PARTITION BY Unit ORDER BY Fecha) - 1 AS pos, count(*) OVER (PARTITION BY Unit) AS n FROM e),
bl AS (SELECT *, CAST(floor(pos / 12) AS INTEGER) AS hour_idx, CAST(pos % 12 AS INTEGER) AS step FROM r WHERE pos < n - n % 12)"""
BLOCKS = Windowing(size=12)


@query("tumbling_blocks", f"WITH {SER}, {BLOCK} SELECT Unit, hour_idx, min(Fecha) AS start_time, max(Fecha) AS end_time, count(*) AS n_rows FROM bl GROUP BY ALL")
def tumbling_blocks(spark, d):
    return windows.block_metadata(windows.block_rows(series(spark, d), ["value"], BLOCKS)).select("Unit", "hour_idx", "start_time", "end_time", "n_rows")


PAIRS = f"""{SER}, {BLOCK},
lg AS (SELECT Unit, hour_idx, step, Fecha, 'value' AS signal, value AS y_true FROM bl UNION ALL SELECT Unit, hour_idx, step, Fecha, 'k', k FROM bl),
av AS (SELECT Unit, signal, avg(y_true) AS m FROM lg WHERE hour_idx < 3 GROUP BY ALL), al AS (SELECT signal, avg(y_true) AS m FROM lg WHERE hour_idx < 3 GROUP BY ALL),
pr AS (SELECT lg.*, coalesce(av.m, al.m) AS y_pred, abs(y_true - coalesce(av.m, al.m)) AS err FROM lg LEFT JOIN av ON av.Unit = lg.Unit AND av.signal = lg.signal JOIN al ON al.signal = lg.signal),
st AS (SELECT signal, quantile_cont(err, 0.5) AS p_low, quantile_cont(err, 0.95) AS p_high, avg(err) AS mean, stddev_pop(err) AS std, min(err) AS low, max(err) AS high, count(err) AS n FROM pr WHERE hour_idx < 3 GROUP BY signal),
te AS (SELECT * FROM pr WHERE hour_idx >= 3),
ss AS (SELECT te.Unit, te.hour_idx, te.signal, avg(err) AS raw, avg(greatest(0, (err - p_low) / (p_high - p_low + 1e-8))) AS norm FROM te JOIN st ON st.signal = te.signal GROUP BY ALL),
tm AS (SELECT Unit, hour_idx, min(Fecha) AS start_time, max(Fecha) AS end_time FROM te GROUP BY ALL),
ws AS (SELECT ss.Unit, ss.hour_idx, sqrt(avg(raw * raw)) AS reconstruction_error_raw, sqrt(avg(norm * norm)) AS score, count(*) AS n_signals FROM ss GROUP BY ALL),
wi AS (SELECT ws.*, exp(-score) AS health_index, start_time, end_time FROM ws JOIN tm ON tm.Unit = ws.Unit AND tm.hour_idx = ws.hour_idx)"""


def pairs(spark, d) -> tuple[DataFrame, DataFrame]:
    long = long_blocks(series(spark, d), ["value", "k"], BLOCKS)
    train, test = long.where("hour_idx < 3"), long.where("hour_idx >= 3")
    model = reconstruct.MeanReconstructor().fit(train)
    return model.reconstruct(train), model.reconstruct(test)


def scores(spark, d, cfg: Health = Health()):
    return score_pairs(*pairs(spark, d), ["Unit", "hour_idx"], "Unit", cfg, "Fecha")


@query("error_stats", f"WITH {PAIRS} SELECT signal, round(p_low, 6) AS p_low, round(p_high, 6) AS p_high, round(mean, 6) AS mean, round(std, 6) AS std, round(low, 6) AS min, round(high, 6) AS max, n FROM st")
def error_stats(spark, d):
    out = health.error_stats(pairs(spark, d)[0])
    return out.select("signal", *(F.round(c, 6).alias(c) for c in ("p_low", "p_high", "mean", "std", "min", "max")), "n")


@query("recon_errors", f"WITH {PAIRS} SELECT Unit, hour_idx, signal, round(avg(err), 9) AS mae, round(avg((y_true - y_pred) * (y_true - y_pred)), 8) AS mse, round(sqrt(avg((y_true - y_pred) * (y_true - y_pred))), 9) AS rmse FROM te GROUP BY ALL")
def recon_errors(spark, d):
    out = health.reconstruction_errors(pairs(spark, d)[1], ["Unit", "hour_idx", "signal"])
    return out.select("Unit", "hour_idx", "signal", F.round("mae", 9).alias("mae"), F.round("mse", 8).alias("mse"), F.round("rmse", 9).alias("rmse"))


@query("health_signal", f"WITH {PAIRS} SELECT Unit, hour_idx, signal, round(raw, 6) AS recon_error_raw, round(norm, 6) AS recon_error_norm FROM ss")
def health_signal(spark, d):
    return scores(spark, d).signals.select("Unit", "hour_idx", "signal", F.round("recon_error_raw", 6).alias("recon_error_raw"), F.round("recon_error_norm", 6).alias("recon_error_norm"))


@query("health_window", f"WITH {PAIRS} SELECT Unit, hour_idx, round(reconstruction_error_raw, 6) AS reconstruction_error_raw, round(score, 6) AS reconstruction_error_score, round(health_index, 6) AS health_index, n_signals, start_time, end_time FROM wi")
def health_window(spark, d):
    return scores(spark, d).windows.select("Unit", "hour_idx", *(F.round(c, 6).alias(c) for c in ("reconstruction_error_raw", "reconstruction_error_score", "health_index")), "n_signals", "start_time", "end_time")


@query("health_unit", f"WITH {PAIRS} SELECT Unit, round(avg(health_index), 6) AS health_index, round(avg(score), 6) AS reconstruction_error, count(health_index) AS n_windows, min(start_time) AS start_time, max(end_time) AS end_time FROM wi GROUP BY Unit")
def health_unit(spark, d):
    return scores(spark, d).units.select("Unit", F.round("health_index", 6).alias("health_index"), F.round("reconstruction_error", 6).alias("reconstruction_error"), "n_windows", "start_time", "end_time")


@query(
    "health_unit_p10",
    f"""WITH {PAIRS}, ss2 AS (SELECT te.Unit, te.hour_idx, te.signal, quantile_cont(greatest(0, (err - p_low) / (p_high - p_low + 1e-8)), 0.95) AS norm FROM te JOIN st ON st.signal = te.signal GROUP BY ALL),
w2 AS (SELECT Unit, hour_idx, max(norm) AS score, exp(-0.5 * max(norm)) AS hi FROM ss2 GROUP BY ALL)
SELECT Unit, round(quantile_cont(hi, 0.1), 6) AS health_index, round(quantile_cont(score, 0.1), 6) AS reconstruction_error, count(hi) AS n_windows FROM w2 GROUP BY Unit""",
)
def health_unit_p10(spark, d):
    out = scores(spark, d, Health(alpha=0.5, time_agg="p95", signal_agg="max", unit_agg="p10")).units
    return out.select("Unit", F.round("health_index", 6).alias("health_index"), F.round("reconstruction_error", 6).alias("reconstruction_error"), "n_windows")


@query(
    "health_categories",
    f"WITH {PAIRS} SELECT CASE WHEN 100 * health_index >= 80 THEN 'Excellent' WHEN 100 * health_index >= 60 THEN 'Good' WHEN 100 * health_index >= 40 THEN 'Fair' WHEN 100 * health_index >= 20 THEN 'Poor' ELSE 'Critical' END AS category, count(*) AS n FROM wi GROUP BY ALL",
)
def health_categories(spark, d):
    return scores(spark, d).windows.groupBy(health.category(health.percent_scale(F.col("health_index"))).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("health_trend", f"WITH {PAIRS} SELECT Unit, round(regr_slope(health_index, epoch_us(start_time) / 86400e6), 6) AS slope FROM wi GROUP BY Unit")
def health_trend(spark, d):
    return health.trend(scores(spark, d).windows).select("Unit", F.round("slope", 6).alias("slope"))


@query("train_test_split", f"WITH {SER}, m AS (SELECT max(Fecha) - INTERVAL 14 DAY AS cut FROM e) SELECT CASE WHEN Fecha >= cut THEN 'test' ELSE 'train' END AS part, count(*) AS n, min(Fecha) AS first_time, max(Fecha) AS last_time FROM e, m GROUP BY ALL")
def train_test_split(spark, d):
    train, test = reconstruct.time_split(series(spark, d), "Fecha", 2)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("Fecha").alias("first_time"), F.max("Fecha").alias("last_time"))


@query("last_sequence", f"WITH {SER}, z AS (SELECT *, row_number() OVER (PARTITION BY Unit ORDER BY Fecha DESC) AS rn FROM e) SELECT Unit, count(*) AS n, min(Fecha) AS first_time FROM z WHERE rn <= 20 GROUP BY Unit")
def last_sequence(spark, d):
    return windows.last_rows(series(spark, d), 20).groupBy("Unit").agg(F.count(F.lit(1)).alias("n"), F.min("Fecha").alias("first_time"))


@query("unit_standardised", f"WITH {SER}, z AS (SELECT event_id, (value - avg(value) OVER (PARTITION BY Unit)) / stddev_pop(value) OVER (PARTITION BY Unit) AS v FROM e) SELECT event_id, round(v, 6) AS value FROM z")
def unit_standardised(spark, d):
    return windows.standardised(series(spark, d), ["value"]).select("event_id", F.round("value", 6).alias("value"))


@query("json_props", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY event_type")
def json_props(spark, d):
    rows = t.read(spark, d, "events").withColumn("p", F.from_json("props", "k long"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("k_sum"))


MONTHS = ", ".join(f"'{m}'" for m in dates.MONTHS)


@query(
    "date_scalars",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS spanish, ([{MONTHS}])[month(o_orderdate)] AS month_name, strftime(o_orderdate, '%Y%m%d') AS version,
CAST(abs(epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1998-06-15 12:00:00')) // 86400000000 AS BIGINT) AS days, CAST(strftime(o_orderdate, '%W') AS INTEGER) AS week, count(*) AS n FROM orders GROUP BY ALL""",
)
def date_scalars(spark, d):
    c = F.col("o_orderdate")
    out = t.read(spark, d, "orders").select(
        "o_orderkey",
        dates.spanish(c).alias("spanish"),
        dates.spanish_month(c).alias("month_name"),
        dates.version_stamp(c).alias("version"),
        dates.days_between(c, F.lit("1998-06-15 12:00:00").cast("timestamp_ntz")).alias("days"),
        dates.week_number(c).alias("week"),
    )
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "week_calendar",
    """SELECT CAST(y AS INTEGER) AS year, CAST(w AS INTEGER) AS week, CAST(strptime(y || '-W' || w || '-1', '%Y-W%W-%w') AS DATE) AS monday, printf('W%02d-%d', w, y) AS label, CAST(y * 100 + w AS INTEGER) AS label_order
FROM range(2018, 2030) AS a(y), range(1, 53) AS b(w)""",
)
def week_calendar(spark, d):
    grid_ = spark.range(2018, 2030).select(F.col("id").cast("int").alias("year")).select("year", F.explode(F.sequence(F.lit(1), F.lit(52))).alias("week"))
    out = grid_.select("year", "week", dates.week_monday(F.col("year"), F.col("week")).alias("monday"), dates.week_label(F.col("year"), F.col("week")).alias("label"))
    return out.withColumn("label_order", dates.label_order(F.col("label")))


@query("date_range_filter", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31' GROUP BY ALL")
def date_range_filter(spark, d):
    rows = t.read(spark, d, "orders")
    day = lambda x: F.lit(x).cast("timestamp_ntz")
    return clean.in_dates(rows, "o_orderdate", day("1997-01-01"), day("1998-12-31")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("zscore_mask", f"WITH {SER}, m AS (SELECT avg(value) AS a, stddev_pop(value) AS s FROM e) SELECT EstadoMaquina, count(*) AS n, count(CASE WHEN abs((value - a) / s) > 1.5 THEN NULL ELSE value END) AS kept FROM e, m GROUP BY EstadoMaquina")
def zscore_mask(spark, d):
    return clean.mask_outliers(series(spark, d), ["value"], 1.5).groupBy("EstadoMaquina").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("kept"))


@query(
    "as_of_join",
    f"WITH {SER} SELECT l.event_id, r.value AS value, r.k AS k FROM (SELECT * FROM e WHERE EstadoMaquina = 'purchase') l ASOF LEFT JOIN (SELECT * FROM e WHERE EstadoMaquina <> 'purchase') r ON l.Unit = r.Unit AND l.Fecha >= r.Fecha",
)
def as_of_join(spark, d):
    rows = series(spark, d)
    left = rows.where("EstadoMaquina = 'purchase'").select("Unit", "Fecha", "event_id")
    right = rows.where("EstadoMaquina <> 'purchase'").select("Unit", "Fecha", "value", "k")
    return alerts.as_of(left, right, "Unit", "Fecha", ["value", "k"]).select("event_id", "value", "k")


@query("fleet_profile", f"WITH {SER} SELECT EstadoMaquina, count(*) AS n, count(DISTINCT Unit) AS units, round(100.0::DOUBLE * count(*) FILTER (WHERE value > 90) / count(*), 9) AS high_pct FROM e GROUP BY ALL")
def fleet_profile(spark, d):
    out = series(spark, d).groupBy("EstadoMaquina").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("Unit").alias("units"), F.count_if(F.col("value") > 90).alias("high"))
    return out.select("EstadoMaquina", "n", "units", F.round(percent(F.col("high"), F.col("n")), 9).alias("high_pct"))
