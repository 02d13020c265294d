"""What Python workers keep between batches, and small files sent to them."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import SparkSession

# What a worker made, and when it was last asked for.
_KEPT: dict[Hashable, Any] = {}
_USED: dict[Hashable, float] = {}
IDLE = 5.0  # seconds after which other stages' objects are given up
_FILES: dict[tuple[str, str], Broadcast] = {}


def per_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()`` once per worker process and key, until the worker has served something else for a while."""
    _USED[key] = time.monotonic()
    if key not in _KEPT:
        give_up_idle()
        _KEPT[key] = make()
        gc.collect()  # what was only needed to make it
        _trim()
    return _KEPT[key]


def give_up_idle() -> None:
    """Drop what this worker has not used for ``IDLE`` seconds.

    Spark hands its workers from stage to stage; the tables and caches of an earlier one would
    otherwise stay in memory beside those of the present one. Called once per batch.
    """
    now = time.monotonic()
    old = [key for key, at in _USED.items() if now - at > IDLE]
    for key in old:
        del _USED[key]
    dropped = [key for key in old if key in _KEPT]
    for key in dropped:
        del _KEPT[key]
    if dropped:
        gc.collect()
        pa.default_memory_pool().release_unused()
        _trim()


def _trim() -> None:
    """Hand freed memory back to the system where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def file_bytes(spark: SparkSession, path: str) -> Broadcast:
    """A model or vocabulary file of the driver, sent once to every executor.

    Its size does not depend on the data; over 64 MB it is refused.
    """
    key = (spark.sparkContext.applicationId, path)
    if key not in _FILES:
        with open(path, "rb") as f:
            content = f.read()
        if len(content) > 64 << 20:
            raise ValueError(f"{path} is too large to be sent to every worker")
        _FILES[key] = spark.sparkContext.broadcast(content)
    return _FILES[key]
