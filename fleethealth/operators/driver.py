"""What runs around the operators: logs, retries, errors, failure rows."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class FleetError(Exception):
    """An error of this library."""


class DataError(FleetError):
    """Data that can't be worked on."""


class ConfigError(FleetError):
    """Settings that can't hold."""


def logger(name: str, level: int = logging.INFO) -> logging.Logger:
    """A logger with one handler, however often it is asked for."""
    log = logging.getLogger(name)
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(name)s %(levelname)s %(message)s"))
        log.addHandler(handler)
        log.setLevel(level)
    return log


class Logged:
    """Gives a class its logger."""

    @property
    def log(self) -> logging.Logger:
        return logger(type(self).__name__)


def retry(call: Callable, times: int = 3, wait: float = 1.0, on: tuple[type[Exception], ...] = (OSError,), sleep: Callable[[float], None] = time.sleep):
    """What ``call`` gives, tried up to ``times`` times, waiting twice as long each time."""
    for k in range(times):
        try:
            return call()
        except on:
            if k == times - 1:
                raise
            sleep(wait * 2**k)


def failures(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """What failed, as a table."""
    return spark.createDataFrame([(str(r.get("name")), str(r.get("error"))) for r in rows], "name string, error string")
