"""Tables kept by month, whose months are replaced whole and all at once.

A replacement writes the rows of its months to a new folder and then makes one commit
(:mod:`tickforge.streaming.commits`). Until then readers see the old months, afterwards the new ones; a write that
fails halfway is never seen. Files of other months are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.operators import layout
from tickforge.streaming.commits import CommitConflict, CommitLog, Entry

_MONTH = "__month"
#: The part of rows without a date.
UNDATED = "none"


class MonthTable:
    """A table under ``path`` with one part for each month of ``date``; ``schema`` is that of a table without rows."""

    def __init__(self, spark: SparkSession, path: str, date: str, schema: T.StructType):
        self.spark, self.date, self.schema = spark, date, schema
        self.log = CommitLog(spark, path)

    def month_of(self):
        return F.coalesce(F.date_format(F.col(self.date), "yyyy-MM"), F.lit(UNDATED))

    def parts(self) -> dict[str, str]:
        """Folder of every month that has rows, as of the last commit."""
        now: dict[str, str] = {}
        for e in self.log.entries():  # names sort by version
            now.update(e.parts)
        return {m: f for m, f in sorted(now.items()) if f}

    def replace(self, rows: DataFrame, months: list[str] | None = None, key: str | None = None,
                observation: Observation | None = None, sources: list[str] | None = None) -> list[str]:
        """Replace ``months`` (``yyyy-MM``; default: those of ``rows``) by ``rows``; returns the months.

        A listed month without rows becomes empty; a row outside the listed months is an error, and nothing is committed. With
        ``key`` the rows of a month are sorted by key and date. ``sources`` names the commits that the rows were made from; they
        are recorded by the same commit. Of two replacements of one month at the same time, the second to
        end fails with :class:`CommitConflict`; of different months, both count.
        """
        known = {e.name for e in self.log.entries()}
        folder = self.log.new_folder("months")
        out = rows.withColumn(_MONTH, self.month_of())
        out = layout.partition_by_key(out, _MONTH, None) if key is None else \
            out.hint("rebalance", _MONTH).sortWithinPartitions(_MONTH, key, self.date)
        written = layout.write_table(out, path=self.log.location(folder), partition_by=[_MONTH], observation=observation)
        counted = dict(written.get)
        found = {n.split("=", 1)[1]: f"{folder}/{n}" for n in self.log.subfolders(folder) if n.startswith(f"{_MONTH}=")}
        if months is not None and not set(found) <= set(months):
            raise ValueError(f"rows of months that are not replaced: {sorted(set(found) - set(months))}")
        parts = {m: found.get(m, "") for m in (months if months is not None else found)}
        while True:
            since = [e for e in self.log.entries() if e.name not in known]
            clash = {m for e in since for m in e.parts if m in parts}
            if clash:
                raise CommitConflict(f"replaced by another run meanwhile: {sorted(clash)}")
            version = 1 + max((int(e.name.split("-")[1]) for e in self.log.entries()), default=0)
            if self.log.add(Entry(f"months-{version:09d}", folder, metrics=counted, parts=parts, sources=sources or [])):
                return sorted(parts)

    def read(self, months: list[str] | None = None) -> DataFrame:
        """The rows of some months (default: all). Only their folders are opened."""
        at = [f for m, f in self.parts().items() if months is None or m in set(months)]
        if not at:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.log.location(f) for f in at])
