"""Shared scratch tables and row identity for the operators of this package.

Lineage is cut by writing a table below ``spark.checkpoint.dir`` and reading
it back, so a lost executor costs the tasks it ran and never a whole job.
"""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of the session.

    The folder is the one the cluster names. Only a local session without one
    (a test) gets a folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        own = spark.sparkContext.applicationId
        if own not in _folders:
            _folders[own] = tempfile.mkdtemp(prefix="llm-scratch-")
        base = _folders[own]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark deletes the shuffle files of a query as soon as it has ended.
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as a table read from there.

    Nothing reads the shuffles of the write again, so their files go when it ends
    and the disk holds those of one step at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP_CONF)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = files(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_shared_file(spark: SparkSession, name: str, data: bytes, suffix: str = "") -> str:
    """Write a file of bounded size to the shared folder, through the file system it is on."""
    path = scratch_path(spark, name) + suffix
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        for at in range(0, len(data), 1 << 22):
            out.write(bytearray(data[at:at + (1 << 22)]))
    finally:
        out.close()
    return path


#: Bytes of an Arrow batch that goes to a Python worker.
BATCH_BYTES = "4m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


_shipped: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """What Python workers need: batches of bounded size, and this package.

    By default a batch is 10,000 rows, which are any number of bytes if texts
    are long, so Spark is told to cut batches by bytes too, unless the session
    has its own bound. The package's source is sent to the executors once per application.
    """
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sorted(root.rglob("*.py")):
                archive.write(source, source.relative_to(root.parent))
        context.addPyFile(write_shared_file(spark, root.name, packed.getvalue(), ".zip"))
        _shipped.add(context.applicationId)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The Arrow function ``run``, after which Arrow's free memory leaves the worker, which lives on."""
    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return released


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(df: DataFrame, text_col: str) -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def row_key(df: DataFrame, text_col: str) -> Column:
    """64-bit hash of the text: with the id it names a row, whatever else repeats."""
    return F.xxhash64(text_of(df, text_col))


def keep_marked(docs: DataFrame, actions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows that ``actions`` drops.

    ``actions`` is a written table ``(id, row_key, drop)`` with one row per
    ``(id, row_key)`` that needs one: ``drop`` true removes its rows, false
    means that the row repeats and one of the repeats stays. Rows that it
    doesn't name stay. All columns of ``docs`` are returned as they were.
    """
    key = free_name(docs, "row_key")
    columns = docs.columns
    keyed = docs.withColumn(key, row_key(docs, text_col))

    def named(marks: DataFrame) -> Column:
        return keyed[id_col].eqNullSafe(marks["id"]) & (keyed[key] == marks["row_key"])

    drops = actions.where("drop")
    ties = actions.where("NOT drop")
    kept = keyed.join(drops, named(drops), "left_anti")
    if ties.isEmpty():
        return kept.select(*[docs_col(c) for c in columns])
    unique = kept.join(ties, kept[id_col].eqNullSafe(ties["id"]) & (kept[key] == ties["row_key"]),
                       "left_anti")
    repeated = kept.join(ties, kept[id_col].eqNullSafe(ties["id"]) & (kept[key] == ties["row_key"]),
                         "left_semi").dropDuplicates([id_col, key])
    return unique.unionByName(repeated).select(*[docs_col(c) for c in columns])


def docs_col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")
