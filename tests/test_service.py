"""The forecast service's source against a server of this machine, and its retries."""

import datetime as dt
import io
import json
import threading
import urllib.error
import urllib.parse
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark import cloudpickle

from voltaria.sources import payloads, service


@pytest.fixture
def url():
    failures = [503, 429]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            ask = urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())
            if failures:
                self.send_error(failures.pop())
                return
            if "daily" in ask:
                assert ask["past_days"] == ["2"] and ask["timezone"] == ["Europe/Rome"]
                high = lambda a: {} if a == "3" else {"elevation": 100 * float(a)}
                out = [{"latitude": float(a), "longitude": float(o), **high(a), "daily": {"time": ["2026-05-27", "2026-05-29", "2026-05-30"], "temperature_2m_max": [float(a), None, 30]}} for a, o in zip(ask["latitude"][0].split(","), ask["longitude"][0].split(","), strict=True)]
            else:
                out = [{"latitude": float(a), "longitude": float(o), "hourly": {"time": ["t0", "t1"], "temp": [float(a), None]}} for a, o in zip(ask["latitude"][0].split(","), ask["longitude"][0].split(","), strict=True)]
            body = json.dumps(out).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/"
    server.shutdown()


def test_points_in_batches(spark, url):
    cloudpickle.register_pickle_by_value(service)
    try:
        spark.dataSource.register(service.GridService)
        df = spark.read.format("grid-service").options(url=url, lats="1,2,3", lons="4,5,6", hourly="temp", batch="2", base_delay="0.01").load()
        assert sorted(tuple(r) for r in df.filter("temp IS NOT NULL").collect()) == [(1.0, 4.0, "t0", 1.0), (2.0, 5.0, "t0", 2.0), (3.0, 6.0, "t0", 3.0)]
    finally:
        cloudpickle.unregister_pickle_by_value(service)


def test_daily_rows_carry_elevation_and_model(spark, url):
    cloudpickle.register_pickle_by_value(service)
    try:
        spark.dataSource.register(service.GridService)
        read = spark.read.format("grid-service").options(url=url, lats="1,3", lons="4,6", daily="temperature_2m_max", params="past_days=2&timezone=Europe%2FRome", batch="1", base_delay="0.01")
        got = sorted((tuple(r) for r in payloads.heat_days(read.load(), dt.date(2026, 5, 28)).collect()), key=lambda r: (r[1], r[0]))
    finally:
        cloudpickle.unregister_pickle_by_value(service)
    day = lambda d: dt.date(2026, 5, d)
    near, far = "icon_d2", "best_match_extended"
    assert got == [(day(d), lat, lon, t if d != 29 else None, high, far if d == 30 else near) for lat, lon, high in ((1.0, 4.0, 100.0), (3.0, 6.0, None)) for d, t in ((27, lat), (29, None), (30, 30.0))]


def failing(*codes, text="busy"):
    left = list(codes)

    def ask():
        if left:
            raise urllib.error.HTTPError("u", left.pop(0), "m", {}, io.BytesIO(text.encode()))
        return b"ok"

    return ask


def test_retries_and_their_end():
    waits = []
    assert service.with_retry(failing(500, 429, 503), sleep=waits.append, max_delay=3) == b"ok" and waits == [1, 2, 3]
    with pytest.raises(urllib.error.HTTPError):
        service.with_retry(failing(400), sleep=waits.append)
    with pytest.raises(service.DailyLimit):
        service.with_retry(failing(429, text="Daily API request limit exceeded"), sleep=waits.append)
    with pytest.raises(urllib.error.HTTPError):
        service.with_retry(failing(500, 500), tries=2, sleep=waits.append)
