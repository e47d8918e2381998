"""Landed quote payloads as a data source of their own: ``spark.read.format("quote_payloads")``.

The landing folder has one folder or file a ticker (``PETR4/…``, ``symbol=PETR4/…`` or ``PETR4.json``), JSON lines inside.
Every ticker is an input partition, and a filter on ``ticker`` is taken over by the source: the files of other
tickers are not opened. Files are listed and read through ``pyarrow.fs``, so any file system it knows will do; nothing is fetched
from a service.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "ticker string, epoch double, open double, high double, low double, close double, volume double, source_file string"
_FIELDS = ("date", "open", "high", "low", "close", "volume")


def _ticker(name: str) -> str:
    """The ticker that a folder or file is named by, normalised as everywhere (suffix dropped, upper case)."""
    name = re.sub(r"(\.(json|jsonl|ndjson))?(\.gz)?$", "", name.split("=", 1)[-1])
    return name.replace(".SA", "").upper()


def _number(value) -> float | None:
    """A number or a quoted number; anything else is missing."""
    try:
        out = float(value)
    except (TypeError, ValueError):
        return None
    return out if out == out else None


def _files(path: str):
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return system, root


class TickerPartition(InputPartition):
    def __init__(self, ticker: str, paths: list[str]):
        super().__init__(ticker)
        self.ticker, self.paths = ticker, paths


class QuotePayloads(DataSource):
    """Options: ``path`` (the landing folder)."""

    @classmethod
    def name(cls) -> str:
        return "quote_payloads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "QuoteReader":
        return QuoteReader(self.options["path"])


class QuoteReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.wanted = path, None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("ticker",):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f  # left to Spark

    def partitions(self) -> list[TickerPartition]:
        """One a ticker: the names in the landing folder decide, no file is opened."""
        from pyarrow import fs

        system, root = _files(self.path)
        found: dict[str, list[str]] = {}
        for entry in system.get_file_info(fs.FileSelector(root)):
            ticker = _ticker(entry.base_name)
            if entry.base_name[:1] in "._" or self.wanted is not None and ticker not in self.wanted:
                continue
            inside = [entry] if entry.is_file else system.get_file_info(fs.FileSelector(entry.path, recursive=True))
            names = [f.path for f in inside if f.is_file and posixpath.basename(f.path)[:1] not in "._"]
            found.setdefault(ticker, []).extend(sorted(names))
        return [TickerPartition(t, p) for t, p in sorted(found.items()) if p]

    def read(self, partition: TickerPartition) -> Iterator[tuple]:
        """The bars of a ticker's documents; lines that are no JSON document give none."""
        system, _ = _files(self.path)
        for path in partition.paths if partition else []:
            with system.open_input_stream(path, compression="detect") as raw:
                for line in _lines(raw):
                    try:
                        results = json.loads(line).get("results") or []
                        bars = results[0].get("historicalDataPrice") or []
                    except (ValueError, AttributeError, IndexError):
                        continue
                    for bar in bars:
                        if isinstance(bar, dict):
                            yield (partition.ticker, *[_number(bar.get(f)) for f in _FIELDS], path)


def _lines(stream) -> Iterator[bytes]:
    """Lines of a stream, read in blocks."""
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from (w for w in whole if w.strip())
    if rest.strip():
        yield rest


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filters handed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(QuotePayloads)
