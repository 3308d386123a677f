"""What the operators share: the folder all executors see, stored tables, and memory kept by a worker."""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset and everything runs on this machine, ``/tmp/checkpoints`` stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = "file:///tmp/checkpoints"
    folder = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    return folder if "://" in folder else f"file://{os.path.abspath(folder)}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again.

    The copy outlives executors, is computed once, and later steps read only the columns they need.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def worker_memory(name: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps from one task to the next."""
    kept = sys.modules.setdefault("seriesloom_worker_memory", types.ModuleType("seriesloom_worker_memory"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)


def need_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Only ``columns``, so that others of whatever name do no harm."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {', '.join(df.columns)}")
    return df.select(*columns)


def fields(**kinds: str) -> T.StructType:
    """A schema from names and type names."""
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in kinds.items()])
