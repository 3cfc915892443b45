"""Session settings, checkpoints and Arrow text access shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of an Arrow batch handed to Python; texts of 100 KB then still make batches of some 50 MB.
BATCH_ROWS = 500
#: A side is broadcast only when it was counted and has at most this many (narrow) rows.
BROADCAST_ROWS = 200_000
#: Whether shuffle files go at the end of a query; only for queries that are run once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of Python stages, and see to it that there is a checkpoint folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``; where that is unset a folder of our own is used on a local
    master, as in tests on one machine, and any other master is refused: its executors could not see that folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stash(df: DataFrame) -> DataFrame:
    """``df`` written as a compact table to the checkpoint folder and read again: cuts lineage like checkpoint().

    The shuffle files of the write go when it is done, the tables of a session when its driver ends."""
    spark = df.sparkSession
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/tables"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path := f"{folder}/{uuid.uuid4().hex}")
    finally:
        spark.conf.set(CLEANUP, before)

    def remove() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    atexit.register(remove)
    return spark.read.schema(df.schema).parquet(path)


def join_small(left: DataFrame, right: DataFrame, on, how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a narrow ``right`` that was checkpointed: broadcast if its counted rows are few, shuffled otherwise."""
    return left.join(F.broadcast(right) if right.limit(max_rows + 1).count() <= max_rows else right, on, how)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without copies: (bytes, offsets); null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def run_starts(column: pa.Array) -> np.ndarray:
    """Places at which a value differs from the one before; nulls are equal to each other."""
    n = len(column)
    if not n:
        return np.zeros(0, np.int64)
    a, b = column.slice(1), column.slice(0, n - 1)
    differs = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null()))
    return np.append(0, np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply rounds), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def with_fields(df: DataFrame, *fields: tuple[str, str]) -> T.StructType:
    """The schema of ``df`` and further (name, DDL type) fields behind."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"`{n.replace('`', '``')}` {t}" for n, t in fields)).fields])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def named(columns: list[str]) -> list[Column]:
    """Columns by their whole names, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """mapInArrow, also of tables with dots or backticks in their column names, which it doesn't take."""
    plain = {c: free_name(df, f"odd_{i}") for i, c in enumerate(df.columns) if "." in c or "`" in c}
    if not plain:
        return df.mapInArrow(run, schema)
    inner = T.StructType([T.StructField(plain.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields])
    return df.toDF(*[plain.get(c, c) for c in df.columns]).mapInArrow(run, inner).toDF(*schema.names)
