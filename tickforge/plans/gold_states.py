"""Silver by month, month states beside it, and gold from the states: a refresh works on the months that changed.

A refresh of some months reads and writes these months of silver and of the states. Gold is then made from one short row
a key and month; of the dashboard's two edge months it reads single rows (see :func:`tickforge.operators.macro.edge_months`).
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tickforge import schemas
from tickforge.operators import equity, layout, macro
from tickforge.plans import medallion
from tickforge.streaming import incremental
from tickforge.streaming.commits import CommitLog
from tickforge.streaming.month_table import MonthTable


class _Layer:
    """A silver table and its states, both by month."""

    key: str
    date: str

    def __init__(self, spark: SparkSession, root: str, rows: DataFrame):
        """``rows`` gives the schema of the silver rows; none of it is read."""
        self.silver = MonthTable(spark, os.path.join(root, "silver"), self.date, rows.schema)
        self.states = MonthTable(spark, os.path.join(root, "states"), "ref_month", self._states(rows).schema)

    def refresh(self, rows: DataFrame, months: list[str] | None = None, sources: list[str] | None = None) -> list[str]:
        """Replace whole months by ``rows`` (see :meth:`MonthTable.replace`), and their states."""
        changed = self.silver.replace(rows, months, key=self.key, sources=sources)
        self.catch_up()
        return changed

    def catch_up(self) -> list[str]:
        """Make the states of months whose silver rows were replaced since (also by a run that ended before its states)."""
        known = self.states.log.sources()
        behind = [e for e in self.silver.log.entries() if e.name not in known]
        months = sorted({m for e in behind for m in e.parts})
        if behind:
            self.states.replace(self.changed_states(months), months, sources=[e.name for e in behind])
        return months

    def changed_states(self, months: list[str]) -> DataFrame:
        """The states of some months, from these months' rows."""
        return self._states(self.silver.read(months))


class QuoteLayer(_Layer):
    key, date = "symbol", "trade_date"

    def _states(self, rows: DataFrame) -> DataFrame:
        return equity.month_states(rows.filter("trade_date is not null"))

    def gold(self) -> DataFrame:
        return equity.performance_of_states(self.states.read())


class SeriesLayer(_Layer):
    key, date = "idx_type", "ref_date"

    def _states(self, rows: DataFrame) -> DataFrame:
        return macro.month_states(rows.filter("ref_date is not null"))

    def gold(self, as_of: _dt.date, months: int = 6, sort: bool = True) -> DataFrame:
        edges = self.silver.read(macro.edge_months(as_of, months))
        return macro.dashboard_of_states(self.states.read(), edges, as_of, months=months, sort=sort)


def _months(rows: DataFrame, date: str) -> list[str]:
    """The months of some rows: as many as the calendar has."""
    month = F.date_format(F.col(date), "yyyy-MM")
    return sorted(r[0] for r in rows.select(month).distinct().collect() if r[0] is not None)


def _within(date: str, months: list[str]):
    """A filter on the date itself, which reaches the scan: the rows of some months."""
    out = F.lit(False)
    for m in months:
        first = _dt.datetime.strptime(m, "%Y-%m")
        after = (first + _dt.timedelta(days=32)).replace(day=1)
        out = out | ((F.col(date) >= F.lit(first).cast("timestamp")) & (F.col(date) < F.lit(after).cast("timestamp")))
    return out


def update_quotes(spark: SparkSession, landing: str, root: str, check_mode: str = "warn", **ingest) -> dict:
    """The incremental counterpart of the quote side of a refresh: what has landed since the last run, and the months it touches.

    1. New payload files become commits of bronze (:func:`tickforge.streaming.incremental.incremental_quotes`).
    2. The months of their bars are read from bronze, compacted and checked, and replace those months of silver; the same commit
       records which bronze commits it holds. So a run that is cut off anywhere is made good by the next one.
    3. The states of these months are made again, and gold from all states.

    Returns the months, what was ingested a commit and metric, and the observed rows of gold. ``ingest`` are options of
    ``incremental_quotes``. Tables lie under ``root``: ``bronze``, ``quotes/silver``, ``quotes/states``, ``gold_equity``.
    """
    at = {n: os.path.join(root, n) for n in ("bronze", "checkpoint", "quotes", "gold_equity")}
    bronze = incremental.incremental_quotes(spark, landing, at["bronze"], at["checkpoint"], **ingest)
    layer = QuoteLayer(spark, at["quotes"], schemas.empty_frame(spark, schemas.SILVER_EQUITY))
    log, held = CommitLog(spark, at["bronze"]), layer.silver.log.sources()
    new = [e for e in log.entries() if not e.is_base and e.name not in held]
    months = _months(log.read(new), "Date") if new else []
    if new:
        rows = medallion.silver_quotes(bronze.filter(_within("Date", months)), check_mode)
        layer.refresh(schemas.conform(rows, schemas.SILVER_EQUITY), months, [e.name for e in new])
    layer.catch_up()
    written = layout.write_table(layer.gold(), path=at["gold_equity"])
    return {"months": months, "ingested": {e.name: e.metrics for e in new}, "gold_equity": dict(written.get)}
