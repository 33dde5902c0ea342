"""The paged source by time against a server of this machine: pages once over restarts, tokens renewed, bundles in documents."""

import json
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from voltaria.sources import feed, payloads, service

START = feed.instant("2026-01-01T00:00:00")
HOUR = 3600


class Server:
    """Items created every 20 minutes; tokens that count for three answers."""

    def __init__(self):
        self.items = [{"id": k, "created_at": feed.written(START + 1200 * k), "status": "Kind.settled" if k % 2 else "open"} for k in range(30)]
        self.asked, self.tokens, self.left = [], 0, {}
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def answer(self, code, value):
                body = json.dumps(value).encode()
                self.send_response(code)
                self.end_headers()
                self.wfile.write(body)

            def do_POST(self):
                form = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
                assert form["client_secret"] == ["s"] and form["grant_type"] == ["client_credentials"]
                outer.tokens += 1
                outer.left[f"t{outer.tokens}"] = 3
                self.answer(200, {"access_token": f"t{outer.tokens}", "expires_in": 600})

            def do_GET(self):
                token = self.headers.get("Authorization", "").removeprefix("Bearer ")
                if outer.left.get(token, 0) < 1:
                    return self.answer(401, {})
                outer.left[token] -= 1
                q = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
                found = [i for i in outer.items if q["created_after"] <= i["created_at"] < q["created_before"]]
                outer.asked.append((q["created_after"], q["created_before"], int(q["offset"])))
                self.answer(200, {"items": found[int(q["offset"]) : int(q["offset"]) + int(q["limit"])]})

            def log_message(self, *args):
                pass

        self.http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.http.serve_forever, daemon=True).start()
        self.options = {
            "url": f"http://127.0.0.1:{self.http.server_port}/export", "token_url": f"http://127.0.0.1:{self.http.server_port}/token", "client_id": "c", "client_secret": "s",
            "start": "2026-01-01T00:00:00", "slice": str(HOUR), "limit": "2", "base_delay": "0.01",
        }


@pytest.fixture
def server(spark):
    for m in (feed, service):
        cloudpickle.register_pickle_by_value(m)
    spark.dataSource.register(feed.TimedFeed)
    s = Server()
    yield s
    s.http.shutdown()
    for m in (feed, service):
        cloudpickle.unregister_pickle_by_value(m)


def test_slices_are_cut_alike():
    assert [(s.start, s.end) for s in feed.slices(5, 25, 10)] == [(5, 10), (10, 20), (20, 25)]
    assert [(s.start, s.end) for s in feed.slices(10, 20, 10)] == [(10, 20)] and feed.slices(10, 10, 10) == []
    assert feed.instant("2026-01-01T01:00:00+01:00") == feed.instant("2026-01-01T00:00:00")


def test_batch_reads_whole_pages_and_renews_tokens(spark, server):
    df = spark.read.format("timed-feed").options(**server.options, until="2026-01-01T04:00:00").load()
    got = df.select(F.get_json_object("item", "$.id").cast("int").alias("id")).collect()
    assert sorted(r.id for r in got) == list(range(12)) and df.rdd.getNumPartitions() == 4
    one = spark.read.format("timed-feed").options(**{**server.options, "slice": str(4 * HOUR)}, until="2026-01-01T04:00:00").load()
    before = server.tokens
    assert one.count() == 12 and server.tokens > before + 1  # seven pages, three answers a token


def test_restarts_go_on_from_the_offset(spark, server, tmp_path):
    def run(until):
        stream = spark.readStream.format("timed-feed").options(**server.options, until=until).load()
        w = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out"))
        w.trigger(availableNow=True).start().awaitTermination(60)

    for until in ("2026-01-01T03:00:00", "2026-01-01T03:00:00", "2026-01-01T07:30:00"):
        run(until)
    out = spark.read.parquet(str(tmp_path / "out")).select(F.from_json("item", "id int, created_at timestamp, status string").alias("i")).select("i.*")
    assert sorted(r.id for r in out.collect()) == list(range(23))  # those before half past seven
    assert len(server.asked) == len(set(server.asked))


def test_failed_answers_fail_the_read(spark, server):
    bad = spark.read.format("timed-feed").options(**{**server.options, "url": server.options["token_url"] + "/none", "token_url": ""}, until="2026-01-01T01:00:00").load()
    with pytest.raises(Exception, match="401"):
        bad.collect()


def test_bundles_of_several_documents(spark):
    pytest.importorskip("yaml")
    text = """--- # first
community:
  id: rec1
  areas: {n: {topology: [s1]}}
members:
  a: {status: active, user_id: u1, area: n, delivery_points: [{id: d1}, {id: ""}], assets: {meter: {x: {sensor_id: m1}, y: {}}}}
  b: {status: active}
---
# nothing but a remark
---
{"community": {"id": "rec2"}, "members": {"c": {"status": "active", "user_id": "u---2", "since": "2026-01-01"}}}
--- {community: {}, members: {d: {status: active, user_id: u9}}}
...
"""
    texts = spark.createDataFrame([(text,), ("",), (None,)], "value string")
    members = payloads.registry_members(payloads.bundles(texts))
    got = sorted((r.user_id, r.rec_id, r.topology_ids, r.delivery_point_ids, r.sensor_ids) for r in members.collect())
    assert got == [("u---2", "rec2", [], [], []), ("u1", "rec1", ["s1"], ["d1"], ["m1"])]
    assert payloads.bundles(texts.limit(0)).count() == 0
