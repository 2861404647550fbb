"""Hand-made cases of the operators' rules."""

import datetime as dt
import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleethealth.config import ComponentMap, Names, Scoring, Windowing
from fleethealth.functions import dates, values
from fleethealth.operators import alerts, baseline, clean, driver, features, health, quality, reconstruct, regress, reports, resample, rollup, scoring, sessions, windows
from fleethealth.plans import cycles, health_index, weekly
from fleethealth.sources import readers, writers

T0 = dt.datetime(2025, 1, 6)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def one(df):
    return df.first()


def test_severity_at_the_limits(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 5.0, 50.0, 95.0, 96.0, 98.0, 98.5, None)], "v double")
    out = [r[0] for r in df.select(scoring.severity(F.col("v"), F.lit(2.0), F.lit(5.0), F.lit(95.0), F.lit(98.0))).collect()]
    assert out == [3.0, 1.0, 1.0, 0.0, 0.0, 0.0, 1.0, 1.0, 3.0, None]


@pytest.mark.parametrize(("score", "status"), [(None, "InsufficientData"), (0.0, "Normal"), (0.349, "Normal"), (0.35, "Alerta"), (0.899, "Alerta"), (0.9, "Anormal")])
def test_signal_status(spark, score, status):
    assert one(spark.createDataFrame([(score,)], "s double").select(scoring.signal_status(F.col("s"))))[0] == status


MAP5 = ComponentMap.of({"components": {"x": {"signals": list("abcde"), "criticality": "High"}}})


def component(spark, statuses, mapping=MAP5):
    rows = [("u", s, "x", 0.0, st, 10, 0, 0.0, 0.0, 10) for s, st in zip("abcde", statuses) if st]
    sig = spark.createDataFrame(rows, "unit_id string, signal_name string, component string, window_score_normalized double, signal_status string, sample_count long, anomaly_count long, anomaly_percentage double, max_score double, reading_count long")
    return rollup.components(sig, mapping)


@pytest.mark.parametrize(
    ("statuses", "score", "status"),
    [
        (["Alerta"] * 3 + ["Normal"] * 2, 0.18, "Alerta"),
        (["Anormal"] + ["Normal"] * 4, 0.20, "Alerta"),
        (["Alerta", "Anormal"] + ["Normal"] * 3, 0.26, "Alerta"),
        (["Alerta"] * 2 + ["Anormal"] * 3, 0.72, "Anormal"),
        (["Normal", "Normal", None, None, None], 0.0, "InsufficientData"),
    ],
)
def test_component_score(spark, statuses, score, status):
    r = one(component(spark, statuses))
    assert r.component_score == pytest.approx(score, abs=1e-12)
    assert r.component_status == status
    assert r.triggering_signals == [s for s, st in zip("abcde", statuses) if st and st != "Normal"]


def machine(spark, parts):
    rows = [("u", f"c{i}", i, level, st, 0.5, 1.0, []) for i, (level, st) in enumerate(parts)]
    comp = spark.createDataFrame(rows, "unit_id string, component string, component_pos int, criticality string, component_status string, component_score double, signal_coverage double, triggering_signals array<string>")
    return one(rollup.machines(comp))


def test_machine_sums_in_order(spark):
    assert machine(spark, [("Medium", "Anormal"), ("Low", "Anormal")]).overall_status == "Alerta"  # 0.4 + 0.2 rounds above 0.6
    assert machine(spark, [("High", "Alerta"), ("High", "Alerta")]).overall_status == "Normal"
    assert machine(spark, [("Medium", "Anormal")] * 3 + [("Low", "Anormal")]).overall_status == "Anormal"
    assert machine(spark, [("Low", "Anormal")] + [("Medium", "Anormal")] * 3).overall_status == "Alerta"
    assert machine(spark, [("7", "Anormal")]).machine_score == 1.0  # an unknown level weighs 1


def test_missing_units_get_a_row(spark):
    rows = rollup.machines(spark.createDataFrame([("a", "c", 0, "High", "Normal", 0.0, 1.0, [])], "unit_id string, component string, component_pos int, criticality string, component_status string, component_score double, signal_coverage double, triggering_signals array<string>"))
    out = {r.unit_id: r for r in rollup.with_missing_units(rows, spark.createDataFrame([("a",), ("b",)], "unit_id string"), 12).collect()}
    assert out["b"].overall_status == "InsufficientData" and out["b"].components_insufficient == 12 and out["b"].machine_score == 0.0
    assert out["a"].overall_status == "Normal"


def telemetry(spark, states, signal="s"):
    rows = [("u", minutes(i), st, float(i)) for i, st in enumerate(states)]
    return spark.createDataFrame(rows, f"Unit string, Fecha timestamp, EstadoMaquina string, {signal} double")


def test_baseline_needs_samples_and_falls_back(spark):
    base = baseline.baselines(telemetry(spark, ["ND"] * 99 + ["Ralenti"] * 100), ["s"], "v")
    assert [(r.EstadoMaquina, r.sample_count) for r in base.collect()] == [("Ralenti", 100)]
    base = baseline.baselines(telemetry(spark, ["ND"] * 60 + ["Ralenti"] * 60), ["s"], "v")
    assert [(r.EstadoMaquina, r.sample_count) for r in base.collect()] == [("All", 120)]
    assert baseline.baselines(telemetry(spark, ["ND"] * 20), ["s"], "v").count() == 0


def test_first_state_is_picked(spark):
    train = telemetry(spark, ["Ralenti"] + ["ND"] * 3 + ["Ralenti"] * 3)
    base = baseline.baselines(train, ["s"], "v", min_samples=3)
    assert one(baseline.picked(base, baseline.first_seen(train))).EstadoMaquina == "Ralenti"
    assert one(baseline.picked(base)).EstadoMaquina == "ND"


def test_all_null_signal_is_insufficient(spark):
    train = telemetry(spark, ["ND"] * 5)
    now = train.withColumn("s", F.lit(None).cast("double"))
    out = one(scoring.evaluate_signals(now, baseline.baselines(train, ["s"], "v", 5), ["s"], ComponentMap.of({"c": {"signals": ["s"]}})))
    assert (out.signal_status, out.sample_count, out.anomaly_count, out.max_score, out.anomaly_percentage) == ("InsufficientData", 0, 0, None, 0.0)


def test_clean_order_and_outliers(spark):
    rows = [("u", "2025-01-06 00:00:00", "ND", 1.0), ("u", "2025-01-06 00:00:00", "ND", 2.0), ("u", "bad", "ND", 3.0), ("u", "2025-01-06 00:01:00", "Apagada", 4.0), ("u", "2025-01-06 00:02:00", None, 5.0)]
    df = spark.createDataFrame(rows, "Unit string, Fecha string, EstadoMaquina string, s double")
    assert [r.s for r in clean.clean(df, ["s"]).collect()] == [1.0]
    many = spark.createDataFrame([(float(i % 2),) for i in range(1000)] + [(1e6,)], "s double")
    assert clean.mask_outliers(many, ["s"]).where("s is null").count() == 1
    flat = spark.createDataFrame([(1.0,)] * 5 + [(None,)], "s double")
    assert clean.mask_outliers(flat, ["s"]).where("s is null").count() == 1


def test_signal_columns_are_numeric_and_not_excluded(spark):
    df = spark.createDataFrame([("u", 1.0, "x", 2, 3.0)], "Unit string, EngSpd double, note string, a int, b double")
    assert clean.signal_columns(df) == ["a", "b"]


def test_small_cleaners(spark):
    df = spark.createDataFrame([(None, None, 1.0, None), ("ND", "x", 30.0, 2.0)], "EstadoMaquina string, EstadoCarga string, a double, b double")
    assert [tuple(r)[:2] for r in clean.fill_states(df).collect()] == [("ND", "Sin Carga"), ("ND", "x")]
    assert [r.a for r in clean.mask_ranges(df, {"a": (1, 30), "missing": (0, 1)}).collect()] == [1.0, 30.0]
    text = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "a string")
    assert [r.a for r in clean.to_numbers(text, ["a"]).collect()] == [1.5, None, None]


def series(spark, points):
    return spark.createDataFrame([("u", minutes(m), v) for m, v in points], "Unit string, Fecha timestamp, s double")


def test_interpolation_against_pandas(spark):
    points = [(0, None), (1, 1.0), *((m, None) for m in range(2, 17)), (17, 9.0), (18, None)]
    got = [r.s for r in resample.interpolate(series(spark, points), ["s"], 10, ["Unit"], "Fecha").orderBy("Fecha").collect()]
    want = pd.Series([v for _, v in points], index=[minutes(m) for m, _ in points], dtype=float).interpolate(method="time", limit=10, limit_area="inside")
    assert [None if math.isnan(x) else round(x, 9) for x in want] == [None if x is None else round(x, 9) for x in got]


def test_grid_loses_readings_between_steps(spark):
    df = spark.createDataFrame([("u", T0, 1.0), ("u", T0 + dt.timedelta(seconds=90), 2.0), ("u", minutes(3), 3.0)], "Unit string, Fecha timestamp, s double")
    out = resample.on_grid(df).orderBy("Fecha").collect()
    assert [r.s for r in out] == [1.0, None, None, 3.0] and [r.created_by_reindex for r in out] == [0, 1, 1, 0]
    assert [r.s for r in resample.on_grid(df, snap="minute").orderBy("Fecha").collect()] == [1.0, 2.0, None, 3.0]


def test_regular_series_has_lineage(spark):
    df = spark.createDataFrame([("u", T0, "ND", 1.0), ("u", minutes(2), None, 3.0)], "Unit string, Fecha timestamp, EstadoMaquina string, s double")
    out = resample.regular(df, ["s"], ["EstadoMaquina"]).orderBy("Fecha").collect()
    assert [(r.s, r.EstadoMaquina, r.imputed_any, r.n_imputed_signals, r.time_gap_min) for r in out] == [(1.0, "ND", 0, 0, None), (2.0, "ND", 1, 1, 1.0), (3.0, "ND", 0, 0, 1.0)]


def test_cycles_split_above_the_gap(spark):
    df = spark.createDataFrame([("u", T0, 1.0), ("u", minutes(5), 1.0), ("u", minutes(10) + dt.timedelta(seconds=1), 1.0)], "Unit string, Fecha timestamp, s double")
    assert [r.cycle_id for r in sessions.numbered(df).orderBy("Fecha").collect()] == [1, 1, 2]


def test_valid_cycles_and_study(spark):
    rows = [("u", minutes(i), "ND", "x", float(i % 9), 500.0 + i, 60.0 + i % 5) for i in range(150)] + [("v", minutes(0), "ND", "x", 1.0, 500.0, 60.0)]
    df = spark.createDataFrame(rows, "Unit string, Fecha timestamp, EstadoMaquina string, EstadoCarga string, GroundSpd double, GPSElevation double, RtRBrkTemp double")
    out = cycles.prepared(df, ["GroundSpd", "GPSElevation", "RtRBrkTemp"])
    assert {r.Unit for r in out.select("Unit").distinct().collect()} == {"u"} and out.count() == 150
    assert {r.GroundAccCategorical for r in out.collect()} == {None, "Moderate Acceleration", "High Deceleration"}
    fits = cycles.study(out, ["RtRBrkTemp"], {"speed": ["GroundSpd"], "both": ["GroundSpd", "GPSElevation"]})
    assert len(fits) == 2 and fits[0].n == 150 and 0 <= fits[0].r2 <= fits[1].r2


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (-2.0, -1.5, -0.5, 0.5, 1.5, 1.6, None)], "v double")
    got = [r[0] for r in df.select(values.right_closed(F.col("v"), *sessions.ACCELERATION)).collect()]
    assert got == ["High Deceleration", "High Deceleration", "Moderate Deceleration", "Flat", "Moderate Acceleration", "High Acceleration", None]


@pytest.mark.parametrize(("n", "blocks"), [(59, 0), (60, 1), (61, 1), (120, 2)])
def test_blocks_and_windows(spark, n, blocks):
    df = series(spark, [(i, float(i)) for i in range(n)])
    assert windows.block_metadata(windows.block_rows(df, ["s"])).count() == blocks
    assert windows.sliding(df, ["s"]).count() == max(0, n - 59)


def test_tensors_hold_the_rows(spark):
    df = series(spark, [(i, None if i == 3 else float(i)) for i in range(10)])
    cfg = Windowing(size=4, step=2, min_numeric_coverage=0.7, min_row_coverage=0.7)
    got = {r.start_idx: [x[0] for x in r.x] for r in windows.tensors(df, windows.sliding(df, ["s"], cfg), ["s"], cfg).collect()}
    assert got == {0: [0, 1, 2, 2], 2: [2, 2, 4, 5], 4: [4, 5, 6, 7], 6: [6, 7, 8, 9]}


def test_scaling_round_trip(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, None), (None, "b")], "s double, c string")
    pre = features.Preprocessor(["s"], ["c"]).fit(df)
    again = features.Preprocessor.from_json(pre.to_json())
    assert again.scale == pre.scale == {"s": (2.0, 0.5)}
    assert again.vocabularies == {"c": ["__missing__", "a", "b"]}
    assert [tuple(r) for r in again.transform(df).collect()] == [(-2.0, 1.0, 0.0), (0.0, 0.0, 1.0), (2.0, 0.0, 0.0), (None, 0.0, 1.0)]
    with pytest.raises(ValueError):
        pre.transform(df.drop("s"))


def test_health_needs_distinct_limits(spark):
    rows = spark.createDataFrame([("u", 0, "s", 1.0, 1.0)], "Unit string, hour_idx int, signal string, y_true double, y_pred double")
    with pytest.raises(Exception, match="coincide"):
        health.signal_scores(rows, health.error_stats(rows), ["Unit", "hour_idx"]).collect()


def test_pca_reconstructs_what_it_can_span(spark):
    rows = [(i, [[float(i), 2.0 * i], [3.0 * i, 4.0 * i]]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, x array<array<double>>")
    out = reconstruct.PCAReconstructor(1).fit(df).reconstruct(df)
    d = reconstruct.exploded(out, ["id"], ["a", "b"]).agg(F.max(F.abs(F.col("y_true") - F.col("y_pred")))).first()[0]
    assert d < 1e-9


def test_process_component_and_run(spark):
    rows = [(u, T0 + dt.timedelta(hours=h), float((h * 7 + len(u)) % 13)) for u in ("a", "bb") for h in range(24 * 90)]
    df = spark.createDataFrame(rows, "Unit string, Fecha timestamp, s double")
    units = spark.createDataFrame([("a", "m1"), ("bb", "m2")], "Unit string, truck_model string")
    parts = spark.createDataFrame([("m1", 0, "c", ["s"]), ("m2", 1, "c", ["zzz"]), ("m2", 1, "none", ["zzz"])], "truck_model string, model_pos int, component string, signals array<string>")
    out, failed = health_index.run(df, readers.component_units(units, parts), units, windowing=Windowing(size=24))
    got = out.collect()
    assert {(r.Unit, r.truck_model, r.component) for r in got} == {("a", "m1", "c"), ("bb", "m2", "c")} and all(0 < r.health_index <= 1 for r in got)
    assert [f["component"] for f in failed] == ["none"]


def test_forecast_follows_a_line(spark):
    df = spark.createDataFrame([("u", T0 + dt.timedelta(hours=h), 2.0 * h) for h in range(200)], "Unit string, Fecha timestamp, s double")
    out = reconstruct.forecast(df, "Unit", "s", "Fecha", 1).orderBy("step").collect()
    assert len(out) == 24 and out[0].forecast == pytest.approx(400, abs=1e-3)
    assert out[0].lower == pytest.approx(400, abs=1e-3) and out[0].upper == pytest.approx(400, abs=1e-3)


def test_forecast_keeps_the_hour_of_day(spark):
    df = spark.createDataFrame([("u", T0 + dt.timedelta(hours=h), 100.0 if (T0.hour + h) % 24 == 6 else 0.0) for h in range(24 * 20)], "Unit string, Fecha timestamp, s double")
    out = reconstruct.forecast(df, "Unit", "s", "Fecha", 3).collect()
    high = {r.step for r in out if r.forecast > 50}
    assert high == {s for s in range(1, 73) if (T0.hour + 24 * 20 - 1 + s) % 24 == 6}
    assert all(r.lower <= r.forecast <= r.upper for r in out)


def test_forecast_status(spark):
    made = spark.createDataFrame([(u, 1, x, x - 1, x + 1) for u, x in (("a", 5.0), ("b", 50.0), ("c", 5.0))], "Unit string, step int, forecast double, lower double, upper double")
    limits = spark.createDataFrame([("a", 0.0, 10.0), ("b", 0.0, 10.0)], "Unit string, P5 double, P95 double")
    got = {r.Unit: (r.predicted_status, r.forecast_lower, r.forecast_upper) for r in reconstruct.forecast_status(made, limits, "Unit").collect()}
    assert got == {"a": ("Normal", 4.0, 6.0), "b": ("Alerta", 49.0, 51.0), "c": ("InsufficientData", 4.0, 6.0)}
    few = spark.createDataFrame([("u", T0, None)], "Unit string, Fecha timestamp, s double")
    assert reconstruct.forecast(few, "Unit", "s", "Fecha", 1).count() == 0


def test_quality_and_alert_rules(spark):
    df = spark.createDataFrame([("T-1", T0, 5.0), ("T-1", T0, 50.0), ("bad name", None, None)], "Unit string, Fecha timestamp, s double")
    got = {r.check_name: r.failed_rows for r in quality.silver(df, {"s": (0, 10)}, now=F.lit(dt.datetime(2030, 1, 1))).collect()}
    assert got == {"null_key": 1, "future_time": 0, "duplicate_key": 2, "unit_name": 1, "range_s": 1}
    a = spark.createDataFrame([(1, "u", "t"), (2, "u", "t"), (3, "u", "t")], "AlertID long, Unit string, Trigger string")
    b = spark.createDataFrame([(1, "u", "t"), (2, "v", "t"), (4, "u", "t")], "AlertID long, Unit string, Trigger string")
    assert {r.AlertID: r.problem for r in quality.alert_rules(a, b).collect()} == {2: "differs", 3: "no detail", 4: "no alert"}


def test_jumps_and_conflicts(spark):
    df = spark.createDataFrame([("u", T0, -30.0, -71.0, 500.0, 0.0, "Operacional"), ("u", minutes(1), -32.0, -71.0, 500.0, 900.0, "Apagada")], "Unit string, Fecha timestamp, GPSLat double, GPSLon double, GPSElevation double, EngSpd double, EstadoMaquina string")
    assert quality.position_jumps(df).count() == 1
    assert quality.position_jumps(df).first().jump_km == pytest.approx(222.4, abs=0.2)
    assert quality.state_conflicts(df).count() == 2


def test_schema_check(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    df = spark.createDataFrame([("x", 1)], "a string, b int")
    want = StructType([StructField("a", StringType()), StructField("b", LongType()), StructField("c", StringType())])
    assert quality.schema_violations(df, want) == [("c", "ERROR", "column is missing"), ("b", "WARNING", "int instead of bigint")]
    with pytest.raises(ValueError):
        quality.require_columns(df, ["a", "z"])


def test_upsert_is_idempotent_and_keeps_last(spark, tmp_path):
    path = str(tmp_path / "history")
    rows = lambda *r: spark.createDataFrame(list(r), "unit_id string, evaluation_week int, evaluation_year int, overall_status string")
    writers.upsert_machines(rows(("a", 1, 2025, "Normal"), ("b", 1, 2025, "Normal")), path)
    for _ in range(2):
        writers.upsert_machines(rows(("a", 1, 2025, "Alerta"), ("a", 2, 2025, "Normal")), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [("a", 1, 2025, "Alerta"), ("a", 2, 2025, "Normal"), ("b", 1, 2025, "Normal")]


def test_calendar_matches_strptime(spark):
    rows = [(y, w) for y in (2018, 2024, 2025, 2026) for w in (1, 2, 50, 52)]
    got = spark.createDataFrame(rows, "y int, w int").select("y", "w", dates.week_monday(F.col("y"), F.col("w")).alias("m")).collect()
    for r in got:
        want = dt.datetime.strptime(f"{r.y}-W{r.w}-1", "%Y-W%W-%w").date()
        assert r.m == want == readers.week_monday(r.y, r.w)
    assert readers.history_bounds(2025, 50) == (dt.datetime(2025, 9, 16), dt.datetime(2025, 12, 14))


def test_dates(spark):
    df = spark.createDataFrame([("2025-03-01", "2025-03-04 23:00:00"), (None, "x")], "a string, b string").select(dates.parse(F.col("a"), "dd/MM/yyyy").alias("a"), dates.parse(F.col("b")).alias("b"))
    got = df.select(dates.days_between(F.col("a"), F.col("b")), dates.spanish(F.col("a")), dates.spanish_month(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(3, "01/03/2025", "Marzo"), (0, "N/A", "N/A")]


def week_table(spark, folder, week, year, unit_rows):
    spark.createDataFrame(unit_rows, "Unit string, Fecha timestamp, EstadoMaquina string, EngCoolTemp double").write.parquet(f"{folder}/{readers.WEEK_FILE.format(week=week, year=year)}")


def test_weekly_run_end_to_end(spark, tmp_path):
    silver, golden = f"{tmp_path}/silver", f"{tmp_path}/golden"
    monday = dt.datetime(2025, 12, 15)  # week 50
    before = [(u, monday - dt.timedelta(days=10, minutes=i), "ND", 80 + i % 10 + 0.0) for u in ("A", "B") for i in range(200)]
    week_table(spark, silver, 48, 2025, before)
    week_table(spark, silver, 50, 2025, [("A", monday + dt.timedelta(minutes=i), "ND", 200.0 if i % 2 else 85.0) for i in range(50)])
    (tmp_path / "map.json").write_text(json.dumps({"components": {"engine": {"signals": ["EngCoolTemp"], "criticality": "High"}}}))
    done = weekly.run_weeks(spark, silver, f"{tmp_path}/map.json", golden, [(2025, 50), (2025, 51), (2025, 50)])
    assert [d["status"] for d in done] == ["SUCCESS", "ERROR", "SUCCESS"], done
    got = {r.unit_id: r for r in spark.read.parquet(f"{golden}/machine_status.parquet").collect()}
    assert got["A"].overall_status == "Alerta" and got["B"].overall_status == "InsufficientData"
    assert spark.read.parquet(f"{golden}/classified.parquet").count() == 1
    assert readers.load_baseline(spark, f"{golden}/baselines").count() == 2


def test_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.evaluation_week(spark, str(tmp_path), 2025, 1)
    assert readers.parquet_or_empty(spark, f"{tmp_path}/none", "a int").count() == 0
    assert readers.spreadsheet_or_empty(spark, f"{tmp_path}/none.xlsx", "a int").count() == 0
    (tmp_path / "x.csv").write_text("Equipos,Fecha_Actual\nT_1,31/12/2024\nT_2,bad\n")
    got = readers.spreadsheet(spark, f"{tmp_path}/x.csv", {"Equipos": "Unit", "Fecha_Actual": "Fecha"}, ["Fecha"]).collect()
    assert [tuple(r) for r in got] == [("T_1", dt.date(2024, 12, 31)), ("T_2", None)]
    assert readers.newest_file(spark, str(tmp_path), "*.csv").endswith("x.csv")
    assert readers.fetch(spark, str(tmp_path), f"{tmp_path}/to", "*.csv") == {"copied": 1, "skipped": 0, "failed": 0}
    assert readers.fetch(spark, str(tmp_path), f"{tmp_path}/to", "*.csv")["skipped"] == 1
    (tmp_path / "fleet.json").write_text(json.dumps({"id_to_truck_model": {"a": "m"}, "model_components": {"m": {"c": {"signals": ["s"]}}}}))
    units, parts = readers.fleet_map(spark, f"{tmp_path}/fleet.json")
    assert [tuple(r) for r in readers.component_units(units, parts).collect()] == [("c", "a", ["s"])]


def test_as_of_takes_the_reading_at_or_before(spark):
    left = spark.createDataFrame([("u", minutes(0)), ("u", minutes(5)), ("v", minutes(5))], "k string, t timestamp")
    right = spark.createDataFrame([("u", minutes(1), 1), ("u", minutes(5), None)], "k string, t timestamp, x int")
    got = sorted((r.k, r.t, r.x) for r in alerts.as_of(left, right, "k", "t", ["x"]).collect())
    assert [x for _, _, x in got] == [None, None, None]
    right = right.withColumn("x", F.coalesce("x", F.lit(7)))
    assert sorted(str(r.x) for r in alerts.as_of(left, right, "k", "t", ["x"]).collect()) == ["7", "None", "None"]


def test_reports_on_empty_tables(spark):
    empty = spark.createDataFrame([], "unit_id string, evaluation_year int, evaluation_week int, overall_status string, machine_score double, priority_score double")
    assert one(reports.kpis(empty)).normal_pct == 0.0
    for made in (reports.frequency(empty, "overall_status"), reports.crosstab(empty), reports.changes(empty), reports.transitions(empty), reports.score_trend(empty), reports.ranking(empty), reports.histogram(empty, "machine_score")):
        assert made.count() == 0


def test_driver_helpers(spark):
    tries = []

    def call():
        tries.append(1)
        if len(tries) < 3:
            raise OSError
        return "done"

    assert driver.retry(call, sleep=lambda s: None) == "done" and len(tries) == 3
    assert driver.logger("x") is driver.logger("x") and len(driver.logger("x").handlers) == 1
    assert driver.failures(spark, [{"name": "a", "error": ValueError("b")}]).first().error == "b"


def test_information_criteria():
    aic, bic = regress.information(100, 50.0, 3)
    assert aic == pytest.approx(100 * (math.log(2 * math.pi * 0.5) + 1) + 6) and bic - aic == pytest.approx(3 * math.log(100) - 6)


def test_coverage_weight_by_valid_share(spark):
    rows = [("u", "a", "x", 0.0, "Anormal", 4, 0, 0.0, 0.0, 10), ("u", "b", "x", 0.0, "Normal", 10, 0, 0.0, 0.0, 10)]
    sig = spark.createDataFrame(rows, "unit_id string, signal_name string, component string, window_score_normalized double, signal_status string, sample_count long, anomaly_count long, anomaly_percentage double, max_score double, reading_count long")
    mapping = ComponentMap.of({"x": {"signals": ["a", "b"]}})
    assert one(rollup.components(sig, mapping)).component_score == 0.5
    assert one(rollup.components(sig, mapping, Scoring(min_valid_share=0.5))).component_score == 0.0


def test_names_can_be_changed(spark):
    names = Names("machine", "at", "mode", "load")
    df = telemetry(spark, ["ND"] * 5).toDF("machine", "at", "mode", "s")
    base = baseline.baselines(df, ["s"], "v", 5, names)
    assert base.columns[:3] == ["Unit", "Signal", "EstadoMaquina"] and base.count() == 1


def test_health_artifacts_come_back(spark, tmp_path):
    from fleethealth.config import Health

    rows = spark.createDataFrame([("u", 0, "s", float(i), 0.0) for i in range(10)], "Unit string, hour_idx int, signal string, y_true double, y_pred double")
    stats = health.error_stats(rows)
    health_index.save_artifacts(stats, Health(alpha=2.0), str(tmp_path / "a"))
    again, cfg = health_index.load_artifacts(spark, str(tmp_path / "a"))
    assert cfg == Health(alpha=2.0) and [tuple(r) for r in again.collect()] == [tuple(r) for r in stats.select(*again.columns).collect()]


def test_pages_and_shuffles(spark):
    df = spark.range(25)
    assert [r.id for r in reports.page(df, ["id"], 10, 2).collect()] == list(range(20, 25))
    a, b = ([r.id for r in reports.shuffled(df.repartition(n), ["id"]).collect()] for n in (1, 5))
    assert a == b != list(range(25)) and sorted(a) == list(range(25))


def test_regression_with_interactions(spark):
    rows = [(float(i % 7), "ab"[i % 2], 3.0 + 2.0 * (i % 7) * (i % 2 == 1)) for i in range(70)]
    fit = regress.ols(spark.createDataFrame(rows, "x double, g string, y double"), "y", ["x*g"])
    assert fit.r2 == pytest.approx(1.0, abs=1e-9) and fit.n == 70
