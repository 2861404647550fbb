"""Cleaning of wide telemetry."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleethealth.config import NOT_SIGNALS, RANGES, VALID_STATES, Names
from fleethealth.functions.values import finite

NUMBERS = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")


def signal_columns(df: DataFrame, excluded: Iterable[str] = NOT_SIGNALS) -> list[str]:
    """Numeric columns outside the excluded ones, in the table's order."""
    out = set(excluded)
    return [c for c, kind in df.dtypes if c not in out and kind.split("(")[0] in NUMBERS]


def valid_timestamps(df: DataFrame, ts: str = "Fecha") -> DataFrame:
    """Times that can't be read become null, and rows without one go."""
    if dict(df.dtypes)[ts] == "string":
        df = df.withColumn(ts, F.try_to_timestamp(F.col(ts)))
    return df.where(F.col(ts).isNotNull())


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence, last: bool) -> DataFrame:
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*(c.desc() if last else c.asc() for c in order)))).where("__rank = 1").drop("__rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row for each key, the first by ``order``, which must leave no ties among different rows."""
    return _numbered(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    return _numbered(df, keys, order, last=True)


def valid_states(df: DataFrame, states: Sequence[str] = VALID_STATES, column: str = "EstadoMaquina") -> DataFrame:
    """Rows in one of the states; null goes. Without the column nothing happens."""
    return df.where(F.col(column).isin(*states)) if column in df.columns else df


def missing_report(df: DataFrame, signals: Sequence[str], warn_above: float = 50.0) -> DataFrame:
    """signal, missing_pct, warn: the share of nulls of each signal, in one pass."""
    shares = df.agg(*(F.coalesce(100.0 * F.avg(F.col(c).isNull().cast("int")), F.lit(0.0)).alias(c) for c in signals))
    return shares.unpivot([], list(signals), "signal", "missing_pct").withColumn("warn", F.col("missing_pct") > warn_above)


def mask_outliers(df: DataFrame, signals: Sequence[str], limit: float = 10.0) -> DataFrame:
    """Nulls readings further than ``limit`` population deviations from the mean over all units; one row of moments is broadcast."""
    moments = df.agg(*(F.avg(finite(F.col(c))).alias(f"__m_{c}") for c in signals), *(F.stddev_pop(finite(F.col(c))).alias(f"__s_{c}") for c in signals))
    far = lambda c: (F.col(f"__s_{c}") > 0) & (F.abs((F.col(c) - F.col(f"__m_{c}")) / F.nullif(F.col(f"__s_{c}"), F.lit(0.0))) > limit)
    masked = df.crossJoin(F.broadcast(moments)).withColumns({c: F.when(F.coalesce(far(c), F.lit(False)), None).otherwise(F.col(c)) for c in signals})
    return masked.select(*df.columns)


def mask_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = RANGES) -> DataFrame:
    """Nulls readings outside [low, high]; columns that aren't there are passed over."""
    return df.withColumns({c: F.when(F.col(c).between(a, b), F.col(c)) for c, (a, b) in ranges.items() if c in df.columns})


def without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drops the columns that are there."""
    return df.drop(*(c for c in columns if c in df.columns))


def enough_signals(df: DataFrame, signals: Sequence[str]) -> DataFrame:
    """Rows with at least half of the signals, rounded down."""
    return df.na.drop(thresh=len(signals) // 2, subset=list(signals)) if len(signals) > 1 else df


def fill_states(df: DataFrame, state: str = "EstadoMaquina", load: str = "EstadoCarga") -> DataFrame:
    return df.na.fill({c: v for c, v in ((state, "ND"), (load, "Sin Carga")) if c in df.columns})


def to_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strings as numbers; null where they are none."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in columns})


def in_dates(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows from start to end, both included; None leaves a side open."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    return df if end is None else df.where(F.col(column) <= F.lit(end))


def clean(df: DataFrame, signals: Sequence[str], names: Names = Names(), states: Sequence[str] = VALID_STATES, limit: float = 10.0) -> DataFrame:
    """Times, repeated readings (the first stays), states, outliers, in this order."""
    df = valid_timestamps(df, names.ts)
    df = keep_first(df, [names.unit, names.ts], [names.unit, *(c for c in df.columns if c not in (names.unit, names.ts))])
    df = valid_states(df, states, names.state)
    return mask_outliers(df, signals, limit)
