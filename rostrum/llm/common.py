"""What the operators of this subpackage share: scratch tables, files that every executor can open, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

#: Rows and bytes of an Arrow batch that is handed to Python, where the session has not set its own.
BATCH_ROWS, BATCH_BYTES = "1024", str(8 << 20)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small where texts can be long; a value that the session has set itself stays."""
    for key, value, default in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS, "10000"),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES, str(2**31 - 1)),
    ):
        if spark.conf.get(key, default) in (default, "-1", "2147483647b", "9223372036854775807", "9223372036854775807b"):
            spark.conf.set(key, value)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's URI below spark.checkpoint.dir, which driver and executors share; only a local session may do without the setting."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="rostrum-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again: lineage ends there and nothing is computed twice."""
    path = path or scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.rostrum_path = path
    return out


def remove(spark: SparkSession, path: str | None) -> None:
    """Delete a scratch folder through Hadoop's file system, so that any store works."""
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that are done; it does so once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def within(df: DataFrame, rows: int) -> bool:
    """Whether df has at most that many rows; counts no more of it than needed."""
    return df.limit(rows + 1).count() <= rows


def split_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Atomic:
    """A file that appears only when complete, under a name of its own for every attempt, so that nothing is ever renamed onto a
    file that exists. A task that runs twice leaves two files of the same bytes; the manifest, which Spark commits once, names one (uri)."""

    def __init__(self, uri: str):
        ctx = TaskContext.get()
        stem, dot, ending = uri.rpartition(".")
        self.uri = f"{stem}-{ctx.taskAttemptId() if ctx else 0}-{uuid.uuid4().hex[:8]}{dot}{ending}"
        self.fs, self.path = split_uri(self.uri)
        self.tmp = f"{self.path}.part"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.tmp, compression=None)
        self.size = 0

    def write(self, data) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> int:
        self.out.close()
        self.fs.move(self.tmp, self.path)
        return self.size


def opened(uri: str):
    fs, path = split_uri(uri)
    return fs.open_input_stream(path, compression=None, buffer_size=1 << 20)


#: What modules hold in a worker between tasks, by module: functions that let go of it.
_HELD: dict[str, Callable[[], None]] = {}


def held(module: str, let_go: Callable[[], None]) -> None:
    """Say how to free what a module remembers in a worker."""
    _HELD[module] = let_go


def only(module: str) -> None:
    """At a task's start: free what other modules remember, so that a worker that serves several operators holds one memory at a time."""
    others = [f for m, f in _HELD.items() if m != module]
    if others and _LAST[:1] != [module]:
        for f in others:
            f()
        gc.collect()
        give_back()
    _LAST[:] = [module]


def give_back() -> None:
    """Return memory that is free to the system, so that a worker that waits for its next task holds little more than what it remembers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_LAST: list[str] = []


def _alone(batches: Iterator[pa.RecordBatch], *, fn: Callable[..., Iterator[pa.RecordBatch]], **fixed) -> Iterator[pa.RecordBatch]:
    only(fn.__module__)
    yield from fn(batches, **fixed)
    give_back()


def arrow_map(df: DataFrame, fn: Callable[..., Iterator[pa.RecordBatch]], schema: T.StructType, **fixed) -> DataFrame:
    """mapInArrow of a module-level function with fixed arguments."""
    ship(df.sparkSession)
    small_batches(df.sparkSession)
    return df.mapInArrow(partial(_alone, fn=fn, **fixed), schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have yet."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


#: Spark and Arrow types by the names that struct() takes.
KINDS = {"int": (T.IntegerType(), pa.int32()), "long": (T.LongType(), pa.int64()), "double": (T.DoubleType(), pa.float64()), "string": (T.StringType(), pa.string()), "boolean": (T.BooleanType(), pa.bool_()), "binary": (T.BinaryType(), pa.binary())}


def struct(ddl: str) -> T.StructType:
    """A schema from "name type, ..." without a session, so that workers can load modules that declare one."""
    fields = []
    for part in ddl.split(", "):
        name, kind = part.split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append(T.StructField(name, T.ArrayType(KINDS[inner][0]) if kind != inner else KINDS[kind][0]))
    return T.StructType(fields)


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, pa.list_(KINDS[k[6:-1]][1]) if k.startswith("array<") else KINDS[k][1]) for n, k in (x.split(" ") for x in ddl.split(", "))])


class Numbering(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


def gather(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """The runs of flat that which names, one after the other."""
    starts, n = (np.cumsum(sizes) - sizes if starts is None else starts)[which], sizes[which]
    ends = np.cumsum(n)
    return flat[np.repeat(starts - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
