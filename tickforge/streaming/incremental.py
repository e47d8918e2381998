"""Incremental landing -> bronze quotes on Structured Streaming.

Each run takes only payload files not seen before (the file source keeps its
log in the checkpoint). A micro-batch goes through the same labelling, cleaning
and stamping as the batch path (:func:`tickforge.plans.medallion.quote_bars`),
is written to a folder of its own and committed to the sink's log
(:mod:`tickforge.streaming.commits`) under the stream's identity and the batch number. A batch
that runs again after a failure writes nothing if its commit is there, and
otherwise commits a new folder, so nothing is lost or doubled, also when the commits
before were folded in between. What the batch holds (documents by
outcome, bars) is counted while it is written, and kept with its commit.

Nothing is dropped for being late, and no state is kept: fetches overlap, so the bars
are compacted when they are read (one row per ticker and date, the latest
ingestion, then the later file). The result does not depend on how files were dealt to
micro-batches. ``compact_increments`` folds what has piled up into a base, one row a bar;
a read then only compares the bars of later batches with those of the base.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import layout
from tickforge.plans import medallion
from tickforge.sources.payload import OUTCOMES, QUOTE_PAYLOAD, outcome_of, with_source
from tickforge.streaming.commits import CommitConflict, CommitLog, Entry, merged, stream_id

KEYS = ["ticker", "Date"]
ORDER = ["ingestion_timestamp", *medallion.SOURCE_COLUMNS]


def _latest(rows: DataFrame) -> DataFrame:
    return layout.latest_per_key(rows, KEYS, ORDER)


def _resolved(log: CommitLog, entries: list[Entry]) -> DataFrame:
    """One row per (ticker, Date) over some live entries, with the source columns."""
    bases, increments = [e for e in entries if e.is_base], [e for e in entries if not e.is_base]
    if not increments:
        return log.read(bases)
    if not bases:
        return _latest(log.read(increments))
    return merged(log.read(bases), log.read(increments), KEYS, _latest)


def read_quotes(spark: SparkSession, sink: str) -> DataFrame:
    """The bronze table: all commits, one row per (ticker, Date). A sink without commits is an empty table."""
    log = CommitLog(spark, sink)
    live = log.live()
    if not live:
        return schemas.empty_frame(spark, schemas.BRONZE_QUOTES)
    return schemas.conform(_resolved(log, live), schemas.BRONZE_QUOTES)


def ingestion_report(spark: SparkSession, sink: str) -> DataFrame:
    """``commit, metric, value``: documents by outcome and bars written, of every batch; ``rows`` of every base."""
    return CommitLog(spark, sink).report()


def incremental_quotes(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                       max_files_per_trigger: int | None = None, timeout_s: float | None = None,
                       run_ts: _dt.datetime | None = None, null_fill: float | None = 0.0,
                       multi_line: bool = False) -> DataFrame:
    """Run one availableNow pass; returns the bronze table (:func:`read_quotes`).

    ``max_files_per_trigger`` bounds a micro-batch and changes no result.
    """
    reader = spark.readStream.schema(QUOTE_PAYLOAD).option("multiLine", multi_line)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stamp = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    log = CommitLog(spark, sink)

    def append(batch: DataFrame, number: int) -> None:
        name = f"batch-{stream_id(spark, checkpoint)}-{number:09d}"
        if log.has(name):
            return
        seen = Observation()
        counts = [F.count_if(outcome_of(batch) == o).alias(o) for o in OUTCOMES]
        docs = batch.observe(seen, F.count(F.lit(1)).alias("documents"), *counts)
        bars = medallion.quote_bars(docs, null_fill, stamp)
        folder = log.new_folder(name)
        # Rebalanced: as few files as the volume needs.
        written = layout.write_table(bars.hint("rebalance"), path=log.location(folder))
        log.add(Entry(name, folder, metrics={**seen.get, "bars": written.get["rows"]}))

    q = (with_source(reader.json(landing)).writeStream.foreachBatch(append)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("incremental run did not finish")
    if q.exception() is not None:
        raise q.exception()
    return read_quotes(spark, sink)


def compact_increments(spark: SparkSession, sink: str) -> DataFrame:
    """Fold all commits into one base, written by month; returns the table.

    Readers and a running stream are not cut off: the folders that the base replaces stay until
    ``CommitLog.remove_replaced``, and batches committed meanwhile are not replaced. Another compaction that ended first
    makes this one fail with :class:`CommitConflict`, which changes nothing. With no new batch nothing is done.
    """
    log = CommitLog(spark, sink)
    live, name = log.live(), log.next_base()
    if any(not e.is_base for e in live):
        folder = log.new_folder(name)
        rows = layout.partition_by_key(_resolved(log, live), "ticker", "Date")
        written = layout.write_table(rows, path=log.location(folder))
        if not log.add(Entry(name, folder, [e.name for e in live], {"rows": written.get["rows"]})):
            raise CommitConflict(f"{name} of {sink} was committed by another run")
    return read_quotes(spark, sink)
