import datetime as dt

from fleethealth.config import ComponentMap
from fleethealth.operators import baseline, scoring
from fleethealth.streaming import telemetry as stream

T0 = dt.datetime(2025, 1, 6)
SCHEMA = "Unit string, Fecha timestamp, EstadoMaquina string, s double"


def drained(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/c-{name}").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def feed(spark, tmp_path, rows):
    path = f"{tmp_path}/in"
    for k, part in enumerate(rows):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return stream.source(spark, path, spark.createDataFrame([], SCHEMA).schema, 1)


def test_dedup_and_window_scores(spark, tmp_path):
    row = lambda m, v: ("u", T0 + dt.timedelta(minutes=m), "ND", v)
    df = feed(spark, tmp_path, [[row(0, 5.0), row(0, 5.0), row(1, 500.0)], [row(300, 5.0)], [row(900, 5.0)]])
    assert len(drained(stream.deduplicated(df), "dd", tmp_path)) == 4
    train = spark.createDataFrame([("u", T0 - dt.timedelta(minutes=i + 1), "ND", float(i % 10)) for i in range(200)], SCHEMA)
    base = baseline.baselines(train, ["s"], "v")
    got = drained(stream.window_scores(df, base, ["s"], ComponentMap.of({"c": {"signals": ["s"]}})), "ws", tmp_path)
    first = min(got, key=lambda r: r.window_start)
    assert (first.sample_count, first.anomaly_count, first.signal_status, first.component) == (3, 1, "Anormal", "c")


def test_sessions_and_merge(spark, tmp_path):
    row = lambda m: ("u", T0 + dt.timedelta(minutes=m), "ND", 1.0)
    df = feed(spark, tmp_path, [[row(0), row(3)], [row(100)], [row(500)]])
    assert (T0, 2) in {(r.start_time, r.n_rows) for r in drained(stream.sessions(df), "se", tmp_path)}
    path = f"{tmp_path}/history"
    for k in range(2):
        stream.merge_into(df.selectExpr("Unit AS unit_id", "1 AS evaluation_week", "2025 AS evaluation_year", "s"), path, ("unit_id", "evaluation_week", "evaluation_year"), f"{tmp_path}/m{k}").awaitTermination(120)
    assert spark.read.parquet(path).count() == 1


def test_transitions_over_batches(spark, tmp_path):
    """Each file is a batch: the state carries a unit's last status from one to the next."""
    schema = "unit_id string, overall_status string, at timestamp"
    at = lambda h: T0 + dt.timedelta(hours=h)
    for k, part in enumerate([[("a", "Normal", at(0)), ("b", "Alerta", at(0))], [("a", "Alerta", at(1)), ("b", "Alerta", at(1))], [("a", "Alerta", at(2)), ("b", "Normal", at(3)), ("b", "Anormal", at(2))]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/st")
    df = stream.source(spark, f"{tmp_path}/st", spark.createDataFrame([], schema).schema, 1)
    got = sorted((r.unit_id, r.previous_status, r.overall_status, r["at"]) for r in drained(stream.transitions(df), "tr", tmp_path))
    assert got == [("a", "Normal", "Alerta", at(1)), ("b", "Alerta", "Anormal", at(2)), ("b", "Anormal", "Normal", at(3))]


def test_late_rows_are_left_to_the_batch_merge(spark, tmp_path):
    """A reading behind the watermark isn't in the stream's windows; the weekly batch, which reads all rows, has it."""
    row = lambda m, v: ("u", T0 + dt.timedelta(minutes=m), "ND", v)
    df = feed(spark, tmp_path, [[row(0, 5.0)], [row(600, 5.0)], [row(700, 5.0)], [row(1, 500.0)], [row(1300, 5.0)]])  # a batch's rows are late by the watermark that the batch before began with
    train = spark.createDataFrame([("u", T0 - dt.timedelta(minutes=i + 1), "ND", float(i % 10)) for i in range(200)], SCHEMA)
    base = baseline.baselines(train, ["s"], "v")
    mapping = ComponentMap.of({"c": {"signals": ["s"]}})
    first = min(drained(stream.window_scores(df, base, ["s"], mapping), "late", tmp_path), key=lambda r: r.window_start)
    assert (first.sample_count, first.anomaly_count) == (1, 0)
    whole = scoring.evaluate_signals(spark.read.parquet(f"{tmp_path}/in"), base, ["s"], mapping).first()
    assert (whole.sample_count, whole.anomaly_count) == (5, 1)
