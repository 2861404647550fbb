"""Scaling and encoding, learnt from one table and applied to another."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethealth.functions.values import one_hot, robust_scaled

MISSING = "__missing__"


def scaler_stats(df: DataFrame, signals: Sequence[str]) -> DataFrame:
    """signal, median, iqr over all units; nulls count as the median for the quartiles, and an iqr of 0 is 1."""
    medians = df.agg(*(F.median(c).alias(c) for c in signals))
    joined = df.select(*signals).crossJoin(F.broadcast(medians.select(*(F.col(c).alias(f"__m_{c}") for c in signals))))
    quart = joined.agg(*(F.struct(F.first(f"__m_{c}").alias("m"), F.percentile(F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")), F.array(F.lit(0.25), F.lit(0.75))).alias("q")).alias(c) for c in signals))
    long = quart.unpivot([], list(signals), "signal", "x")
    iqr = F.col("x.q")[1] - F.col("x.q")[0]
    return long.select("signal", F.col("x.m").alias("median"), F.when(iqr == 0, 1.0).otherwise(iqr).alias("iqr"))


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """The values of a category in order, null as ``__missing__``: position, value. The first one is what encoding leaves out."""
    values = df.agg(F.sort_array(F.collect_set(F.coalesce(F.col(column), F.lit(MISSING)))).alias("v"))
    return values.select(F.posexplode("v").alias("position", "value"))


@dataclass
class Preprocessor:
    """Robust scaling of signals and one-hot encoding of categories."""

    signals: Sequence[str]
    categories: Sequence[str] = ()
    scale: dict[str, tuple[float, float]] = field(default_factory=dict)
    vocabularies: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> Preprocessor:
        """Two aggregates; the driver gets a row for each signal and the categories' values."""
        self.scale = {r.signal: (r.median, r.iqr) for r in scaler_stats(df, self.signals).collect()}
        self.vocabularies = {c: [r.value for r in vocabulary(df, c).orderBy("position").collect()] for c in self.categories}
        return self

    def columns(self) -> list[str]:
        return [*self.signals, *(f"{c}_{v}" for c in self.categories for v in self.vocabularies[c][1:])]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The columns to keep, the scaled signals (nulls stay) and the encoded categories."""
        missing = [c for c in (*self.signals, *self.categories) if c not in df.columns]
        if missing:
            raise ValueError(f"columns are missing: {', '.join(missing)}")
        scaled = [robust_scaled(F.col(c).cast("double"), F.lit(self.scale[c][0]), F.lit(self.scale[c][1])).alias(c) for c in self.signals]
        return df.select(*keep, *scaled, *(x for c in self.categories for x in one_hot(F.col(c), self.vocabularies[c], c, MISSING)))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Preprocessor:
        held = json.loads(text)
        held["scale"] = {k: tuple(v) for k, v in held["scale"].items()}
        return cls(**held)
