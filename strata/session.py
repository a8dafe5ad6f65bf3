"""Session helpers: the shared scratch folder, and small parallel job submission."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

A = TypeVar("A")
B = TypeVar("B")

# How many table writes are submitted at once.
WRITERS = 4


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="strata-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small table of strings, whole numbers and NULLs as literals of the plan, without Python data behind it."""
    fields = T.StructType.fromDDL(schema).fields

    def shown(value, dtype: T.DataType) -> str:
        if value is None:
            text = "NULL"
        elif isinstance(value, str):
            text = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        else:
            text = str(value)
        return f"CAST({text} AS {dtype.simpleString()})"

    lines = ["(" + ", ".join(shown(v, f.dataType) for v, f in zip(row, fields, strict=True)) + ")" for row in rows]
    names = ", ".join(f.name for f in fields)
    if not lines:
        none = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in fields)
        return spark.sql(f"SELECT * FROM VALUES ({none}) AS t({names}) LIMIT 0")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS t({names})")


def in_parallel(
    spark: SparkSession, work: Callable[[A], B], items: Iterable[A], threads: int = WRITERS
) -> list[B]:
    """Submit independent jobs from a few driver threads; the first error is raised.

    Each job is distributed as usual. The threads only keep the cluster busy
    while one small table finishes its last task.
    """
    items = list(items)
    if len(items) <= 1 or threads <= 1:
        return [work(i) for i in items]
    target = inheritable_thread_target(spark)(work)
    with ThreadPoolExecutor(max_workers=min(threads, len(items))) as pool:
        return list(pool.map(target, items))
