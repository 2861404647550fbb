import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleethealth.config import Windowing
from fleethealth.operators import clean, reconstruct, windows
from fleethealth.plans import health_index
from fleethealth.sources import readers, writers
from fleethealth.sources.readers import _fs


def test_a_history_survives_a_crash_between_the_renames(spark, tmp_path):
    path = f"file://{tmp_path}/machine_status.parquet"
    row = lambda s: spark.createDataFrame([("a", 1, 2025, s)], "unit_id string, evaluation_week int, evaluation_year int, overall_status string")
    writers.upsert_machines(row("Normal"), path)
    p, fs = _fs(spark, path)
    old, _ = _fs(spark, f"{path}.1.old")
    fs.rename(p, old)
    assert readers.history(spark, path).first().overall_status == "Normal"  # nothing new was complete
    fs.rename(p, old)
    row("Alerta").write.parquet(f"{path}.1.new")
    writers.upsert_machines(row("Anormal").withColumn("unit_id", F.lit("b")), path)
    assert sorted((r.unit_id, r.overall_status) for r in readers.history(spark, path).collect()) == [("a", "Alerta"), ("b", "Anormal")]
    with pytest.raises(FileNotFoundError):
        readers.history(spark, f"file://{tmp_path}/none.parquet")


def test_repeated_keys_that_differ_in_arrays_alone(spark, tmp_path):
    new = spark.createDataFrame([("a", [1]), ("a", [2]), ("a", [0])], "k string, v array<int>")
    for parts in (1, 3):
        assert [r.v for r in writers.merged(None, new.repartition(parts), ["k"]).collect()] == [[2]]


def test_only_files_of_the_weeks_are_opened(spark, tmp_path):
    folder = f"file://{tmp_path}/silver"
    for year, week in ((2024, 10), (2024, 48), (2025, 1), (2025, 2), (2025, 30)):
        day = dt.datetime.combine(readers.week_monday(year, week), dt.time(12))
        spark.createDataFrame([("u", day)], "Unit string, Fecha timestamp").write.parquet(f"{folder}/{readers.WEEK_FILE.format(week=week, year=year)}")
    df = readers.baseline_window(spark, folder, 2025, 3, 90)
    assert sorted({f.split("Week")[1][:10] for f in df.inputFiles()}) == ["01Year2025", "02Year2025", "48Year2024"]
    assert df.count() == 3
    assert sorted((r.file_year, r.file_week) for r in readers.all_weeks(spark, folder).collect()) == [(2024, 10), (2024, 48), (2025, 1), (2025, 2), (2025, 30)]


@pytest.mark.parametrize("size,step", [(5, 2), (7, 1)])
def test_tensors_of_both_ways_and_by_hand(spark, size, step):
    """Windows across the parts' borders, nulls, and a unit of too few rows."""
    t0 = dt.datetime(2025, 1, 1)
    rows = [(u, t0 + dt.timedelta(minutes=i), None if (i * 7 + len(u)) % 11 == 0 else float(i), int(i % 13 == 0)) for u, n in (("a", 130), ("bb", 83), ("c", 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "Unit string, Fecha timestamp, s double, created_by_reindex int").repartition(3)
    cfg = Windowing(size=size, step=step, min_numeric_coverage=0.75, min_row_coverage=0.75, max_created_fraction=0.15)
    one = {(r.Unit, r.start_idx): (r.start_time, r.end_time, r.x) for r in windows.sliding_tensors(df, ["s"], ["s"], cfg).collect()}
    two = {(r.Unit, r.start_idx): (r.start_time, r.end_time, r.x) for r in windows.tensors(df, windows.sliding(df, ["s"], cfg), ["s"], cfg).collect()}
    want = {}
    for u in ("a", "bb"):
        own = [r for r in rows if r[0] == u]
        known = [r[2] for r in own]
        for i, v in enumerate(known):
            known[i] = v if v is not None else next((x for x in reversed(known[:i]) if x is not None), next((x for x in known[i:] if x is not None), 0.0))
        for i in range(0, len(own) - size + 1, step):
            part = own[i : i + size]
            if sum(r[2] is not None for r in part) / size >= 0.75 and sum(r[3] for r in part) / size <= 0.15:
                want[u, i] = part[0][1], part[-1][1], [[x] for x in known[i : i + size]]
    assert one == two == want


def test_columns_that_are_there_go(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.without(df, ["b", "c"]).columns == ["a"] and clean.without(df, []).columns == ["a", "b"]


def test_predicted_statuses(spark):
    made = spark.createDataFrame([("low", 1.0), ("in", 5.0), ("none", 5.0)], "Unit string, forecast double").withColumns({"lower": F.col("forecast") - 1, "upper": F.col("forecast") + 1})
    limits = spark.createDataFrame([("low", 2.0, 9.0), ("in", 2.0, 9.0)], "Unit string, P5 double, P95 double")
    got = {r.Unit: r.predicted_status for r in reconstruct.forecast_status(made, limits, "Unit").collect()}
    assert got == {"low": "Alerta", "in": "Normal", "none": "InsufficientData"}


def test_a_component_with_another_reconstructor(spark):
    class Zero(reconstruct.MeanReconstructor):
        def reconstruct(self, df):
            return df.withColumn("y_pred", F.lit(0.0))

    t0 = dt.datetime(2025, 1, 1)
    rows = [("u", t0 + dt.timedelta(days=d, minutes=m), float(m % 7 + d % 3)) for d in range(0, 120, 4) for m in range(12)]
    df = spark.createDataFrame(rows, "Unit string, Fecha timestamp, s double")
    one, two = (health_index.process_component(df, ["s"], windowing=Windowing(size=12), reconstructor=m).windows for m in (reconstruct.MeanReconstructor, Zero))
    assert one.count() == two.count() > 0
    assert one.agg(F.avg("reconstruction_error_raw")).first()[0] != two.agg(F.avg("reconstruction_error_raw")).first()[0]
