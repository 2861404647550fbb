"""Least squares with the measures that go with it."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Fit:
    formula: str
    n: int
    coefficients: dict[str, float]
    r2: float
    aic: float
    bic: float


def information(n: int, rss: float, k: int) -> tuple[float, float]:
    """AIC and BIC of a Gaussian model with k coefficients."""
    base = n * (math.log(2 * math.pi * max(rss, 1e-300) / n) + 1)
    return base + 2 * k, base + k * math.log(n)


def ols(df: DataFrame, target: str, terms: Sequence[str]) -> Fit:
    """Ordinary least squares of the target on numeric and string columns (dummies, the first value by name left out); rows with a null go.

    A term may join columns: ``a:b`` is their product, ``a*b`` that and both.
    """
    from pyspark.ml.feature import RFormula
    from pyspark.ml.regression import LinearRegression

    formula = f"{target} ~ {' + '.join(terms)}"
    columns = list(dict.fromkeys(c.strip() for t in terms for c in re.split("[:*]", t)))
    rows = df.select(target, *columns).na.drop()
    encoded = RFormula(formula=formula, stringIndexerOrderType="alphabetDesc", featuresCol="__x", labelCol="__y").fit(rows)
    data = encoded.transform(rows)
    model = LinearRegression(featuresCol="__x", labelCol="__y", solver="normal").fit(data)
    attrs = data.schema["__x"].metadata["ml_attr"]["attrs"]
    names = [a["name"] for a in sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])]
    n = int(model.summary.numInstances)
    rss = float(model.summary.meanSquaredError) * n
    aic, bic = information(n, rss, len(names) + 1)
    return Fit(formula, n, {"Intercept": float(model.intercept), **dict(zip(names, map(float, model.coefficients)))}, float(model.summary.r2), aic, bic)


def grid(df: DataFrame, targets: Sequence[str], formulas: Mapping[str, Sequence[str]]) -> list[Fit]:
    """Every formula for every target."""
    return [ols(df, t, terms) for t in targets for terms in formulas.values()]


def simple(df: DataFrame, keys: Sequence[str], y: str, x: str) -> DataFrame:
    """A line through y and x for each group, in one aggregation: slope, intercept, r2, n."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))
