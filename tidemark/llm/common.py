"""Helpers shared by the training-data operators: table access, scratch tables, Arrow row maps."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes in one Arrow batch. Work on a batch of texts takes many times its bytes, so it is kept short.
ARROW_ROWS, ARROW_BYTES = 2048, 512 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor share.

    It is the one named by ``spark.checkpoint.dir``; a folder of our own is used only where the
    session names none and runs in one process, as in local tests. On a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def written(df: DataFrame, what: str = "t", slim: bool = False, options: dict | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    A ``slim`` table (a few numbers a row) goes to an eighth of the shuffle's partitions, because
    every file costs calls to the store.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and later plans
    prune columns of the written table.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tidemark/{what}-{uuid.uuid4().hex}"
    out = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)) if slim else df
    out.write.options(compression="zstd", **(options or {})).parquet(path)
    SCRATCH.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


#: Folders that this driver has written and not deleted.
SCRATCH: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in SCRATCH:
        SCRATCH.remove(path)


def release(*frames: DataFrame) -> None:
    """Delete tables made by :func:`written` that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_tidemark_path", None):
            _delete(df.sparkSession, path)


def kept_alone(make: Callable[[], DataFrame], what: str) -> DataFrame:
    """What ``make`` gives, written; every scratch table made on the way is deleted then."""
    before = set(SCRATCH)
    out = written(make(), what)
    for path in [p for p in SCRATCH if p not in before and p != out._tidemark_path]:
        _delete(out.sparkSession, path)
    return out


def short_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


#: Large tables that modules keep in a worker process from task to task.
HELD: list[dict] = []


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def forget() -> None:
    """Empty what modules keep in this process, for work that does not need it."""
    for held in HELD:
        held.clear()
    give_back()


def _typed(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def map_batches(df: DataFrame, run: Callable, schema: StructType | str, keep: bool = False) -> DataFrame:
    """``run`` takes a pyarrow RecordBatch and returns a dict of columns (or None for no rows).

    A worker that runs it first forgets the tables of other work, unless ``keep`` says that they are used.
    """
    short_batches(df.sparkSession)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            forget()
        for batch in batches:
            if batch.num_rows:
                out = run(batch)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([_typed(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(over, schema)


def gathered(rows: DataFrame, size: int) -> np.ndarray:
    """``rows`` (place, value) as an array of ``size`` longs, zero where there is none; never more rows than that."""
    held, out = rows.toArrow(), np.zeros(size, np.int64)
    out[held.column(0).to_numpy()] = held.column(1).to_numpy()
    return out


def texts_of(column) -> list[str]:
    """Python strings of an Arrow string column; null counts as the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra or clashing columns can do no harm."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])
