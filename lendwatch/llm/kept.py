"""What Python workers hold: batches of bounded size, and the things of one operator at a time."""

from __future__ import annotations

import ctypes
from functools import cache

import pyarrow as pa
from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_TEXTS = 1024
_LARGE = 1 << 19  # bytes from which a worker's arrays get pages of their own
_kept: dict[str, dict] = {}


def small_batches(spark: SparkSession) -> None:
    """Let whole texts go to Python in batches of at most 1,024 rows; a smaller setting of the session stays.

    Spark's 10,000 texts are some 30 MB, which executor and worker hold several times over: in vectors
    that double as they grow, on the way through the socket and on the way back. A plan reads the
    setting when it runs, so it stays.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= _TEXTS:
        spark.conf.set(_BATCH, _TEXTS)


def give_back() -> None:
    """Return freed memory to the system, which allocators otherwise hold for the process's next need.

    Where the C library has no such call, only Arrow's is returned.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@cache
def _hold_little() -> None:
    """Let large arrays of this process go back to the system as soon as they are freed.

    The C library otherwise learns to keep up to 32 MB arrays on its heap, where small things that
    stay between them hold the space of many. Where it has no such setting, nothing changes.
    """
    setting = getattr(ctypes.CDLL(None), "mallopt", None)
    if setting is not None:
        setting(-3, _LARGE)  # M_MMAP_THRESHOLD
        setting(-1, 32 * _LARGE)  # M_TRIM_THRESHOLD


def kept_by(owner: str) -> dict:
    """What ``owner`` keeps in this process, to read and fill; what other operators kept is let go.

    A worker process goes on to other stages, where an index nobody asks any more would take the
    executor's memory until the process ends.
    """
    _hold_little()
    others = [o for o in _kept if o != owner]
    for other in others:
        del _kept[other]
    if others:
        give_back()
    return _kept.setdefault(owner, {})
