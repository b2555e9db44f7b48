"""Models and indexes that all executors get, and their release."""

from __future__ import annotations

from typing import Any

from pyspark import Broadcast
from pyspark.sql import SparkSession

_sent: list[Broadcast] = []


def share(spark: SparkSession, value: Any) -> Broadcast:
    """The value, of a bounded size, as a broadcast that ``release`` knows of."""
    _sent.append(spark.sparkContext.broadcast(value))
    return _sent[-1]


def release() -> None:
    """Frees the executors' copies of all that was shared so far, for use once the rows made with it are stored. A plan
    that runs again after all gets them again from the driver."""
    while _sent:
        _sent.pop().unpersist()
