"""Shared helpers: scratch tables in the cluster's shared folder, and Arrow kernels."""
from __future__ import annotations

import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of the parts in which kernels take Arrow batches; Spark's own batches hold 64 MB at most.
PART_ROWS, PART_BYTES = 1250, 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one is set only where that is unset, in local mode alone."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """All scratch tables of this application are below it."""
    return f"{shared_dir(spark)}/gridloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{label}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables: results that are not written yet can't be read after it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most so many rows for what is run inside; the session's own setting holds again afterwards.

    Batches stand in the memory of the JVM and of the worker at once, beside an executor's heap.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name, None)
    spark.conf.set(name, str(min(rows, int(own)) if own and int(own) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, for every executor."""
    path = scratch_path(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Letters and digits among the characters of PLAIN texts, on which no reading of a split pattern can differ from the
#: library's: printable Latin up to U+017F without superscripts, fractions and dotted capital I, and ASCII white space.
LETTERS, DIGITS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9"
NOT_PLAIN = re.compile("[^\t-\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u017f]")


def plain_pattern(pattern: str) -> re.Pattern:
    """A split pattern of letter and digit properties, for PLAIN texts."""
    own = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    own = own.replace(r"[^\s\p{L}\p{N}]", f"[^\\s{LETTERS}{DIGITS}]").replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", f"[{DIGITS}]")
    return re.compile(own)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, where their import path does not have it already."""
    root = str(Path(__file__).resolve().parents[2])
    app = spark.sparkContext.applicationId
    if app in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(app)
    where = shutil.make_archive(f"{tempfile.mkdtemp()}/gridloom", "zip", root, "gridloom")
    spark.sparkContext.addPyFile(where)


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most PART_ROWS rows and PART_BYTES bytes, or of one longer row."""
    if batch.num_rows > 1 and (batch.num_rows > PART_ROWS or batch.nbytes > PART_BYTES):
        half = batch.num_rows // 2
        yield from parts_of(batch.slice(0, half))
        yield from parts_of(batch.slice(half))
    elif batch.num_rows:
        yield batch


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def give_back() -> None:
    """Return freed memory to the system: workers wait beside the executor's heap while other stages run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def run_kernel(kernel: Callable[[], Callable[[pa.RecordBatch], dict]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task: kernel() once, its result on each part of each batch."""
    step = kernel()
    for batch in batches:
        for part in parts_of(batch):
            yield pa.RecordBatch.from_pydict(step(part))
    batch = part = step = None  # before memory is given back
    give_back()


def map_batches(df: DataFrame, kernel: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """Run kernel() once per task; the callable it gives turns each part of an Arrow batch into output columns."""
    ship_package(df.sparkSession)
    return df.mapInArrow(lambda batches: run_kernel(kernel, batches), schema)


#: Rows of a key from which join_hot broadcasts what the key is joined with.
HOT_ROWS = 100_000


def join_hot(rows: DataFrame, table: DataFrame, key: str, sizes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """rows joined with table, which has one row a key. sizes (key, size), a written table, counts the rows of each key.

    Keys of more than hot_rows rows never move: they meet their rows of table by a broadcast, one of hot_rows rows at most.
    Without such a key it is a plain join, of a far smaller plan.
    """
    loud_keys = sizes.where(F.col("size") > hot_rows).select(key)
    if loud_keys.isEmpty():
        return rows.join(table, key)
    hot = F.broadcast(loud_keys)
    loud = rows.join(F.broadcast(table.join(hot, key, "left_semi")), key)
    return rows.join(hot, key, "left_anti").join(table, key).unionByName(loud)


def rows_of(docs: DataFrame) -> DataFrame:
    """(rid, row, doc_id, text) of docs, written: row has all columns of docs, whatever their names; rid numbers the rows."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("rid"))
    return materialize(rows, "rows").select("rid", "row", F.col("row.doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("row.text")).alias("text"))


def same_columns(out: DataFrame, like: DataFrame) -> DataFrame:
    return out.select(*[F.col(f"`{c}`") for c in like.columns])


class Recent:
    """What a worker has worked out for recent words: two generations, so that frequent words outlive a full memory.

    Holds at most twice ``size`` words, and those of one batch besides.
    """

    def __init__(self, size: int):
        self.size, self.now, self.before = size, {}, {}

    def ready(self, words: set, learn: Callable[[list], object]) -> dict:
        """A dictionary that holds all of words; learn(list) gives (word, value) for those seen in neither generation."""
        new = words.difference(self.now)
        if len(self.now) + len(new) > self.size:
            self.before, self.now, new = self.now, {}, words
        now, before = self.now, self.before
        ask = []
        for w in new:
            if w in before:
                now[w] = before[w]
            else:
                ask.append(w)
        if ask:
            now.update(learn(ask))
        return now
