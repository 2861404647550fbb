"""The study of operating cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fleethealth.config import RANGES, Names
from fleethealth.operators import clean, regress, sessions


def prepared(raw: DataFrame, signals: Sequence[str], names: Names = Names(), gap_minutes: float = 5) -> DataFrame:
    """Readings of valid cycles, masked, filled and interpolated, with their movements."""
    df = clean.mask_ranges(raw, RANGES).na.drop(how="all", subset=list(signals))
    df = clean.fill_states(df, names.state, names.load)
    df = clean.keep_last(df, [names.unit, names.ts], [c for c in df.columns if c not in (names.unit, names.ts)])
    cycles = sessions.interpolated(sessions.valid(sessions.numbered(df, gap_minutes, names), names=names), signals, names=names)
    return sessions.movements(cycles, temperatures=[s for s in signals if s.endswith("BrkTemp")], names=names)


def study(cycles: DataFrame, targets: Sequence[str], formulas: dict[str, Sequence[str]]) -> list[regress.Fit]:
    return regress.grid(cycles, targets, formulas)
