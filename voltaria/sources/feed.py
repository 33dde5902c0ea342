"""Services that list what was created within a time range, page by page, as a batch or a streaming source with offsets.

    spark.dataSource.register(TimedFeed)
    spark.readStream.format("timed-feed").options(url=".../commitments/export", start="2026-01-01T00:00:00", token_url=..., client_id=..., client_secret=...).load()

The service takes GET requests with ``created_after`` (included), ``created_before`` (not included), ``limit`` and ``offset`` and
answers with a JSON list, or an object with one under ``items``. Rows hold each item as JSON text, for ``from_json``.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Iterator
from urllib.error import HTTPError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .service import with_retry


class Slice(InputPartition):
    """Seconds since the epoch, the end left out."""

    def __init__(self, start: int, end: int) -> None:
        self.start, self.end = start, end


def slices(start: int, end: int, seconds: int) -> list[Slice]:
    """Ranges between multiples of ``seconds``, so that a range is cut alike in every run."""
    cuts = [start, *range(start - start % seconds + seconds, end, seconds), end]
    return [Slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def instant(text: str) -> int:
    """Seconds of an ISO time; without a zone it is UTC."""
    at = dt.datetime.fromisoformat(text)
    return int((at if at.tzinfo else at.replace(tzinfo=dt.UTC)).timestamp())


def written(seconds: int) -> str:
    return dt.datetime.fromtimestamp(seconds, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


class Client:
    """Asks a service with a bearer token, if options give a token_url: by client credentials, a new one shortly before the old one
    ends or once the service rejects it."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.token, self.ends = options, None, 0.0
        self.timeout = float(options.get("timeout", "30"))

    def bearer(self) -> str:
        if self.token is None or time.time() > self.ends:
            o = self.options
            form = {"grant_type": "client_credentials", "client_id": o["client_id"], "client_secret": o["client_secret"]} | ({"scope": o["scope"]} if o.get("scope") else {})
            answer = json.loads(self._ask(Request(o["token_url"], urlencode(form).encode())))
            self.token, self.ends = answer["access_token"], time.time() + float(answer.get("expires_in", 300)) - 30
        return self.token

    def get(self, url: str) -> bytes:
        if not self.options.get("token_url"):
            return self._ask(Request(url))
        try:
            return self._ask(Request(url, headers={"Authorization": f"Bearer {self.bearer()}"}))
        except HTTPError as e:
            if e.code != 401:
                raise
            self.token = None
            return self._ask(Request(url, headers={"Authorization": f"Bearer {self.bearer()}"}))

    def _ask(self, request: Request) -> bytes:
        def ask() -> bytes:
            with urlopen(request, timeout=self.timeout) as r:
                return r.read()

        return with_retry(ask, int(self.options.get("tries", "5")), float(self.options.get("base_delay", "1")))


class TimedFeed(DataSource):
    """Options: url, start (ISO time), until (by default now, less ``lag`` seconds, 60), slice (seconds a task asks for, 86400),
    limit (items a page, 500), token_url, client_id, client_secret, scope, timeout, tries, base_delay.

    An empty range gives no rows; items that the service adds to a range after it was read, more than ``lag`` late, are not seen.
    """

    @classmethod
    def name(cls) -> str:
        return "timed-feed"

    def schema(self) -> str:
        return "created_from timestamp, item string"

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FeedStream(dict(self.options))


class _Feed:
    """What batch and stream share: the pages of a slice, asked for in the task that has it."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.seconds = options, int(options.get("slice", "86400"))

    def until(self) -> int:
        given = self.options.get("until")
        return instant(given) if given else int(time.time()) - int(self.options.get("lag", "60"))

    def read(self, partition: Slice) -> Iterator[tuple]:
        limit, client, n = int(self.options.get("limit", "500")), Client(self.options), 0
        start = dt.datetime.fromtimestamp(partition.start, dt.UTC)
        while True:
            ask = {"created_after": written(partition.start), "created_before": written(partition.end), "limit": limit, "offset": n}
            page = json.loads(client.get(f"{self.options['url']}?{urlencode(ask)}"))
            items = page["items"] if isinstance(page, dict) else page
            for item in items:
                yield start, json.dumps(item, ensure_ascii=False)
            n += len(items)
            if len(items) < limit:
                return


class FeedReader(_Feed, DataSourceReader):
    def partitions(self) -> list[Slice]:
        return slices(instant(self.options["start"]), self.until(), self.seconds)


class FeedStream(_Feed, DataSourceStreamReader):
    """The offset is the end of what was read. Spark keeps it with the checkpoint, so a restart goes on from there."""

    def initialOffset(self) -> dict:
        return {"until": instant(self.options["start"])}

    def latestOffset(self) -> dict:
        return {"until": max(self.until(), instant(self.options["start"]))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return slices(start["until"], end["until"], self.seconds)
