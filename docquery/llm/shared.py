"""Sending a model to the executors once."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def send(spark: SparkSession, model: Any) -> Callable[[], Any]:
    """Broadcast `model`, whose size its maker bounds; the result gives it back inside tasks.

    Each Python worker unpacks it once.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    opened: dict[int, Any] = {}

    def get() -> Any:
        if not opened:
            opened[0] = pickle.loads(packed.value)
        return opened[0]

    return get
