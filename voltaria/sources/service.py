"""A forecast service as a Spark data source: points are asked for in batches, one task a batch.

    spark.dataSource.register(GridService)
    spark.read.format("grid-service").options(url=..., lats="46.0,46.1", lons="11.0,11.1", hourly="temperature_2m").load()

The service takes POST requests with latitude, longitude and hourly (or daily) lists (comma-separated) and answers with one
object per point: latitude, longitude and ``hourly`` (``daily``) with a ``time`` array and one array per variable; daily
rows carry the point's elevation, null where the answer has none. Answers 429 and 5xx and broken connections
are tried again with growing pauses; an answer that names a daily limit ends the read at once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import parse_qsl, urlencode
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class DailyLimit(RuntimeError):
    """The service gives no more answers today."""


def with_retry(ask: Callable[[], bytes], tries: int = 5, base_delay: float = 1.0, max_delay: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The answer of ``ask``, tried again while the failure may pass."""
    for k in range(tries):
        try:
            return ask()
        except HTTPError as e:
            text = e.read().decode("utf-8", "replace")
            if "daily" in text.lower() and "limit" in text.lower():
                raise DailyLimit(text) from e
            if e.code != 429 and e.code < 500 or k == tries - 1:
                raise
        except (URLError, TimeoutError, ConnectionError):
            if k == tries - 1:
                raise
        sleep(min(max_delay, base_delay * 2**k))
    raise AssertionError


def asked(options: dict[str, str]) -> tuple[str, list[str]]:
    """Whether rows are hourly or daily, and their variables."""
    every = "daily" if "daily" in options else "hourly"
    return every, options[every].split(",")


class Batch(InputPartition):
    def __init__(self, lats: list[str], lons: list[str]) -> None:
        self.lats, self.lons = lats, lons


class GridService(DataSource):
    """Options: url, lats, lons, hourly or daily (comma-separated lists), params (further ones of every request, such as
    ``past_days=2&timezone=UTC``), batch (points a request, 100), timeout (seconds), tries, base_delay."""

    @classmethod
    def name(cls) -> str:
        return "grid-service"

    def schema(self) -> str:
        every, variables = asked(self.options)
        return "lat double, lon double, time string" + "".join(f", {v} double" for v in variables) + (", elevation double" if every == "daily" else "")

    def reader(self, schema) -> DataSourceReader:
        return GridReader(dict(self.options))


class GridReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[Batch]:
        lats, lons, n = self.options["lats"].split(","), self.options["lons"].split(","), int(self.options.get("batch", "100"))
        return [Batch(lats[k : k + n], lons[k : k + n]) for k in range(0, len(lats), n)]

    def read(self, partition: Batch) -> Iterator[tuple]:
        every, variables = asked(self.options)
        body = urlencode([("latitude", ",".join(partition.lats)), ("longitude", ",".join(partition.lons)), (every, ",".join(variables)), *parse_qsl(self.options.get("params", ""))]).encode()

        def ask() -> bytes:
            with urlopen(self.options["url"], body, float(self.options.get("timeout", "30"))) as r:
                return r.read()

        answer = json.loads(with_retry(ask, int(self.options.get("tries", "5")), float(self.options.get("base_delay", "1"))))
        for one in answer if isinstance(answer, list) else [answer]:
            rows, high = one[every], one.get("elevation")
            point = () if every == "hourly" else (None if high is None else float(high),)
            for at, *values in zip(rows["time"], *(rows[v] for v in variables), strict=True):
                yield (float(one["latitude"]), float(one["longitude"]), at, *(None if v is None else float(v) for v in values), *point)
