"""Windows of a fixed number of rows over a unit's regular series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleethealth.config import Names, Windowing
from fleethealth.operators.resample import fill_both_ways

#: Windows' lengths in a part of a unit's series.
PARTS = 8


def rolling_mean(df: DataFrame, column: str, size: int, names: Names = Names(), out: str = "rolling_mean") -> DataFrame:
    """The mean of each full run of ``size`` rows, at its first row; rows that begin no full run are left out."""
    w = Window.partitionBy(names.unit).orderBy(names.ts).rowsBetween(0, size - 1)
    return df.withColumns({out: F.avg(column).over(w), "__n": F.count(F.lit(1)).over(w)}).where(F.col("__n") == size).drop("__n")


def _gated(df: DataFrame, signals: Sequence[str], cfg: Windowing, names: Names) -> tuple[DataFrame, list[str]]:
    """Each row with start_idx, what the window that begins there covers, and __open: whether the window passes; and the names of the fractions.

    A window's count is the difference of two running sums, one of them looked
    up ``size - 1`` rows ahead, so the work doesn't grow with the windows' size.
    """
    w = Window.partitionBy(names.unit).orderBy(names.ts)
    sofar, ahead = w.rowsBetween(Window.unboundedPreceding, 0), cfg.size - 1
    there = [F.col(c).isNotNull().cast("int") for c in signals]
    rows = df.withColumns({"start_idx": F.row_number().over(w) - 1, "__seen": sum(there[1:], there[0]) if there else F.lit(0)})
    counts = {"seen": F.col("__seen"), "rows": (F.col("__seen") > 0).cast("int")}
    extra = []
    for name, source, most in (("created_fraction", "created_by_reindex", cfg.max_created_fraction), ("imputed_fraction", "imputed_any", cfg.max_imputed_fraction)):
        if source in df.columns:
            counts[name] = F.coalesce(F.col(source).cast("int"), F.lit(0))
            extra.append((name, most))
    rows = rows.withColumns({f"__own_{k}": c for k, c in counts.items()})
    rows = rows.withColumns({f"__to_{k}": F.sum(f"__own_{k}").over(sofar) for k in counts})
    rows = rows.withColumns({f"__at_{k}": F.lead(f"__to_{k}", ahead).over(w) for k in counts} | {"end_time": F.lead(names.ts, ahead).over(w), "__last": F.lead("start_idx", ahead).over(w)})
    total = {k: F.col(f"__at_{k}") - F.col(f"__to_{k}") + F.col(f"__own_{k}") for k in counts}
    made = {
        "numeric_coverage": total["seen"] / cfg.size / len(signals) if signals else F.lit(1.0),
        "row_coverage": total["rows"] / cfg.size if signals else F.lit(1.0),
        **{name: total[name] / cfg.size for name, _ in extra},
    }
    gates = (F.col("numeric_coverage") >= cfg.min_numeric_coverage) & (F.col("row_coverage") >= cfg.min_row_coverage)
    for name, most in extra:
        if most is not None:
            gates &= F.col(name) <= most
    out = rows.withColumns(made).withColumn("__open", F.col("__last").isNotNull() & (F.col("start_idx") % cfg.step == 0) & gates)
    return out, [name for name, _ in extra]


def sliding(df: DataFrame, signals: Sequence[str], cfg: Windowing = Windowing(), names: Names = Names()) -> DataFrame:
    """Windows of ``size`` rows that pass the gates, every ``step`` rows: unit, start_idx, end_idx_exclusive, times, coverages and fractions.

    Only counts slide; nothing is copied into windows here (see tensors). Units
    of fewer rows have none. The fractions are there if the series has
    created_by_reindex and imputed_any, whose nulls count as 0.
    """
    rows, extra = _gated(df, signals, cfg, names)
    return rows.where("__open").select(names.unit, F.lit("train_sliding").alias("window_type"), "start_idx", (F.col("start_idx") + cfg.size).alias("end_idx_exclusive"), F.col(names.ts).alias("start_time"), "end_time", "numeric_coverage", "row_coverage", *extra)


def sliding_tensors(df: DataFrame, signals: Sequence[str], columns: Sequence[str], cfg: Windowing = Windowing(), names: Names = Names()) -> DataFrame:
    """What ``tensors`` gives for the windows that ``sliding`` finds in the same series, which is read once and joined with nothing."""
    rows, _ = _gated(df, signals, cfg, names)
    rows = filled(rows, columns, cfg.train_fill, names)
    window = F.struct(F.col("start_idx").alias("__at"), F.array(*(F.col(c).cast("float") for c in columns)).alias("x"), F.coalesce("__open", F.lit(False)).alias("open"), F.col(names.ts).alias("start_time"), "end_time")
    parts = _parts(rows.select(names.unit, F.col("start_idx").alias("__at"), window.alias("__r")), cfg, names)
    own = F.filter("__rows", lambda r: r["open"] & (r["__at"] < (F.col("__part") + 1) * PARTS * cfg.size))
    chosen = parts.select(names.unit, "__part", F.col("__rows")["x"].alias("__x"), F.explode(own).alias("__w"))
    return _finite(chosen.select(names.unit, F.col("__w.__at").alias("start_idx"), "__w.start_time", "__w.end_time", _slice(F.col("__x"), F.col("__w.__at"), cfg).alias("x")))


def _parts(rows: DataFrame, cfg: Windowing, names: Names) -> DataFrame:
    """A unit's rows (__at, __r), gathered in parts of PARTS * size rows, each with the first ``size`` rows of the next part."""
    part = F.floor(F.col("__at") / (PARTS * cfg.size))
    into = F.when((part > 0) & (F.col("__at") % (PARTS * cfg.size) < cfg.size), F.array(part, part - 1)).otherwise(F.array(part))
    return rows.select(names.unit, F.explode(into).alias("__part"), "__r").groupBy(names.unit, "__part").agg(F.sort_array(F.collect_list("__r")).alias("__rows"))  # (PARTS + 1) * size rows at most


def _slice(x: Column, start: Column, cfg: Windowing) -> Column:
    return F.slice(x, (start - F.col("__part") * PARTS * cfg.size + 1).cast("int"), cfg.size)


def _finite(windows: DataFrame) -> DataFrame:
    return windows.where(F.forall("x", lambda r: F.forall(r, lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")))))


def filled(df: DataFrame, columns: Sequence[str], value: float, names: Names = Names()) -> DataFrame:
    """Nulls of a unit filled from before, else from after, else with the value."""
    return df.withColumns({c: F.coalesce(fill_both_ways(F.col(c), [names.unit], names.ts), F.lit(value)) for c in columns})


def blocks(df: DataFrame, size: int = 60, names: Names = Names()) -> DataFrame:
    """Adds block (hour_idx) and step: consecutive runs of ``size`` rows of a unit, not tied to the clock; the rest of a unit goes."""
    w = Window.partitionBy(names.unit).orderBy(names.ts)
    rows = df.withColumns({"__at": F.row_number().over(w) - 1, "__n": F.count(F.lit(1)).over(Window.partitionBy(names.unit))})
    usable = rows.where(F.col("__at") < F.col("__n") - F.col("__n") % size)
    return usable.withColumns({"hour_idx": F.floor(F.col("__at") / size).cast("int"), "step": (F.col("__at") % size).cast("int")}).drop("__at", "__n")


def block_rows(df: DataFrame, columns: Sequence[str], cfg: Windowing = Windowing(), names: Names = Names()) -> DataFrame:
    """Blocks with the columns filled over the usable rows only; blocks with a value that isn't finite go."""
    rows = filled(blocks(df, cfg.size, names), columns, cfg.predict_fill, names)
    good = [~F.isnan(c) & (F.abs(F.col(c)) != float("inf")) for c in columns]
    fine = F.min(F.forall(F.array(*good), lambda x: x).cast("int")).over(Window.partitionBy(names.unit, "hour_idx")) if good else F.lit(1)
    return rows.withColumn("__fine", fine).where("__fine = 1").drop("__fine")


def block_metadata(rows: DataFrame, names: Names = Names()) -> DataFrame:
    return rows.groupBy(names.unit, "hour_idx").agg(F.min(names.ts).alias("start_time"), F.max(names.ts).alias("end_time"), F.count(F.lit(1)).alias("n_rows")).withColumn("window_type", F.lit("predict_block"))


def tensors(df: DataFrame, windows: DataFrame, columns: Sequence[str], cfg: Windowing = Windowing(), names: Names = Names()) -> DataFrame:
    """The chosen windows with x, an array of ``size`` rows of floats; windows are gated before anything is copied.

    A unit's rows are gathered once, in parts of equal numbers of rows, and
    each part also gets the first rows of the next one, as many as a window may
    reach into it; a window is then a slice of the part in which it begins.
    """
    w = Window.partitionBy(names.unit).orderBy(names.ts)
    rows = filled(df, columns, cfg.train_fill, names).withColumn("__at", F.row_number().over(w) - 1)
    parts = _parts(rows.select(names.unit, "__at", F.struct("__at", F.array(*(F.col(c).cast("float") for c in columns)).alias("x")).alias("__r")), cfg, names)
    chosen = windows.withColumn("__part", F.floor(F.col("start_idx") / (PARTS * cfg.size))).select(names.unit, "__part", "start_idx", "start_time", "end_time")
    inside = chosen.join(parts, [names.unit, "__part"])
    return _finite(inside.select(names.unit, "start_idx", "start_time", "end_time", _slice(F.col("__rows")["x"], F.col("start_idx"), cfg).alias("x")))


def last_rows(df: DataFrame, n: int = 168, names: Names = Names()) -> DataFrame:
    """Each unit's last n rows."""
    w = Window.partitionBy(names.unit).orderBy(F.col(names.ts).desc())
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def standardised(df: DataFrame, signals: Sequence[str], names: Names = Names()) -> DataFrame:
    """(x - mean) / population deviation within each unit; 0 where a unit's signal is constant."""
    w = Window.partitionBy(names.unit)
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.coalesce((F.col(c) - F.avg(c).over(w)) / F.nullif(F.stddev_pop(c).over(w), F.lit(0.0)), F.lit(0.0))) for c in signals})
