"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import site
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.session import scratch_dir

#: A word: a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: All original columns of a row travel in one struct under this name, so that
#: working columns never clash with columns of the caller.
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, keep: list[str] | None = None, **keys) -> DataFrame:
    """``df`` (or its columns ``keep``) as one struct plus named working columns.

    A working column is a function of ``c``, where ``c(name)`` is a column of ``df``.
    """
    # Duplicate names cannot be addressed one by one: rename by position first.
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    pos = {c: f"c{i}" for i, c in reversed(list(enumerate(df.columns)))}
    kept = [f"c{i}" for i in range(len(df.columns))] if keep is None else [pos[k] for k in keep]
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)]).alias(ROW)
    cols = [fn(lambda name: F.col(pos[name])).alias(k) for k, fn in keys.items()]
    return plain.select(row, *cols)


def unpacked(df: DataFrame, names: list[str], *extra: str) -> DataFrame:
    """Undo :func:`packed`: the original columns under ``names``, then ``extra``."""
    cols = [F.col(f"{ROW}.c{i}").alias(n) for i, n in enumerate(names)]
    return df.select(*cols, *[F.col(e) for e in extra])


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package, where nothing else does.

    Functions of this package are sent to the workers by name. Under ``--py-files``, an installed
    package or a shared ``PYTHONPATH`` the workers find it; if the driver only has it on its own
    path, a zip of the package is handed to Spark, which distributes it.
    """
    import tickforge

    root = os.path.dirname(os.path.dirname(os.path.abspath(tickforge.__file__)))
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    sc = spark.sparkContext
    if getattr(sc, "_tickforge_shipped", False) or not os.path.isdir(root) or \
            any(os.path.realpath(p) == os.path.realpath(root) for p in found if p):
        return
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tickforge-zip-")), "tickforge_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tickforge")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(target)
    sc._tickforge_shipped = True


def give_back_memory() -> None:
    """Return what a finished task has freed to the machine.

    A Python worker outlives its task and waits for the next, perhaps of another stage. What the allocators of C and of Arrow keep
    for later would be held by all idle workers of an executor, beside the stage that runs now.
    """
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it has no such call
        pass


def python_map(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` whose function may use this package on every worker; a worker's memory is given back after each task."""
    ship_package(df.sparkSession)

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back_memory()

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    Cuts the lineage with a table that survives lost executors, and keeps
    costly work from running twice. The folder belongs to the job: it may be
    deleted when the results that were derived from it have been written.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table of :func:`stored` once nothing reads it any more."""
    delete_path(df.sparkSession, df.scratch_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job wrote, on whatever file system it lies."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def unsigned_fraction(h: Column) -> Column:
    """A signed 64-bit hash as a number in [0, 1), in the order of the hash."""
    return (F.shiftright(h, 12).cast("double") + F.lit(float(2 ** 51))) / F.lit(float(2 ** 52))
