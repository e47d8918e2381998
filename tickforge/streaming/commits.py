"""Append-only commit log of a folder of data: which writes count.

Data is written to folders that are never written twice; an entry of the log makes a folder part of the table. An
entry is a small JSON file under ``_commits``, created by one atomic rename that fails if the name is taken. So

* a write that ends before its entry leaves a folder that no reader sees;
* a write that runs again finds its entry and is left out, also after its rows were folded into a base;
* a base names the entries that it replaces. What was committed while the base was being written is not among
  them and stays; of two bases made at the same time the second is refused.

Readers resolve the log once and read the folders it names. The log has one short file a commit.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG, DATA = "_commits", "data"


class CommitConflict(RuntimeError):
    """Another base was committed in the meantime; nothing of this one counts."""


@dataclass(frozen=True)
class Entry:
    """One commit: its name, its folder (under the sink), the entries it replaces, what was counted while writing, and
    for a table kept in parts (months) the parts that it replaces, each with its folder ('' for a part left empty), and
    the commits of another table that it was made from."""

    name: str
    folder: str
    replaces: list[str] = field(default_factory=list)
    metrics: dict[str, int] = field(default_factory=dict)
    parts: dict[str, str] = field(default_factory=dict)
    sources: list[str] = field(default_factory=list)

    @property
    def is_base(self) -> bool:
        return self.name.startswith("base-")


class CommitLog:
    def __init__(self, spark: SparkSession, sink: str):
        self.spark, self.sink = spark, sink
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(sink).getFileSystem(self._conf)

    def _at(self, *parts: str):
        return self._path(os.path.join(self.sink, *parts))

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(LOG, f"{name}.json"))

    def entries(self) -> list[Entry]:
        """All commits, by name. Their number is that of the batches, not of the rows."""
        if not self._fs.exists(self._at(LOG)):
            return []
        files = [f.getPath() for f in self._fs.listStatus(self._at(LOG))]
        names = sorted(f.toString() for f in files if f.getName().endswith(".json"))
        return [Entry(**json.loads(self._read(n))) for n in names]

    def _read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def new_folder(self, name: str) -> str:
        """A folder for one attempt at a write."""
        return os.path.join(DATA, f"{name}-{uuid.uuid4().hex[:12]}")

    def location(self, folder: str) -> str:
        return os.path.join(self.sink, folder)

    def add(self, entry: Entry) -> bool:
        """Commit; False if an entry of this name is there already."""
        draft = self._at(LOG, f".{entry.name}-{uuid.uuid4().hex[:12]}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(asdict(entry)).encode()))
        finally:
            out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        # FileContext's rename fails if the target is there; FileSystem's may replace it.
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self._at(LOG, f"{entry.name}.json"), options)
        except Exception as error:
            if not self.has(entry.name):
                raise
            if "FileAlreadyExists" not in str(error):
                raise
            self._fs.delete(draft, False)
            return False
        return True

    def live(self) -> list[Entry]:
        """The entries that make up the table."""
        found = self.entries()
        gone = {n for e in found for n in e.replaces}
        return [e for e in found if e.name not in gone]

    def sources(self) -> set[str]:
        """The commits of other tables that this one was made from so far."""
        return {n for e in self.entries() for n in e.sources}

    def next_base(self) -> str:
        bases = [int(e.name.split("-")[1]) for e in self.entries() if e.is_base]
        return f"base-{max(bases, default=0) + 1:09d}"

    def subfolders(self, folder: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._at(folder)) if f.isDirectory())

    def remove_replaced(self) -> int:
        """Delete the folders of replaced entries, once no reader uses them any more. Their entries stay, so that a batch
        which runs again is still known. Returns the number of folders."""
        keep = {e.name for e in self.live()}
        done = 0
        for e in self.entries():
            if e.name not in keep and self._fs.exists(self._at(e.folder)):
                done += bool(self._fs.delete(self._at(e.folder), True))
        return done

    def report(self) -> DataFrame:
        """One row a commit and metric: ``commit, metric, value``."""
        schema = T.StructType([T.StructField("commit", T.StringType()), T.StructField("metric", T.StringType()),
                               T.StructField("value", T.LongType())])
        rows = [(e.name, k, v) for e in self.entries() for k, v in sorted(e.metrics.items())]
        return self.spark.createDataFrame(rows, schema)

    def read(self, entries: list[Entry]) -> DataFrame:
        return self.spark.read.parquet(*[self.location(e.folder) for e in entries])


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of a stream, as its checkpoint names it: batch numbers start again in a new checkpoint."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(checkpoint, "metadata"))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def merged(base: DataFrame, changes: DataFrame, keys: list[str], resolve) -> DataFrame:
    """A base of one row a key and newer rows, made one table again.

    Only the base's rows of a changed key meet the changes, in ``resolve`` (rows -> one row a key). The rest of the base is
    passed on unsorted; where the changed keys are few, it is not shuffled either.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    touched = changes.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    kept = base.join(touched, same, "left_anti")
    again = base.join(touched, same, "left_semi")
    return kept.unionByName(resolve(again.unionByName(changes)))
