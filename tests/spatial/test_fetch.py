import json
import threading
import urllib.parse
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from skylattice.sources import fetch

FAST = fetch.Retry(5, 0.0)


@pytest.fixture
def server():
    """A server that counts requests and fails as often as it is told."""

    class Handler(BaseHTTPRequestHandler):
        def answer(self, what):
            s = self.server
            with s.lock:
                s.asked[what] += 1
                fails = s.asked[what] <= s.fails(what)
            body = s.body(what).encode()
            self.send_response(503 if fails else 200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.answer(self.path)

        def do_POST(self):
            self.answer(urllib.parse.parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode())["data"][0])

        def log_message(self, *args):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    s.lock, s.asked, s.fails, s.body = threading.Lock(), Counter(), lambda what: 0, lambda what: what
    s.url = f"http://127.0.0.1:{s.server_address[1]}"
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield s
    s.shutdown()


def test_retry_counts_pauses_and_raises_the_last_error():
    calls, slept = [], []

    def call():
        calls.append(1)
        if len(calls) < 4:
            raise OSError(len(calls))
        return "x"

    assert fetch.Retry(5, 6.0)(call, slept.append) == "x" and slept == [6.0] * 3
    calls.clear()
    with pytest.raises(OSError, match="3"):
        fetch.Retry(3, 5.0)(call, slept.append)
    assert len(calls) == 3 and slept[3:] == [5.0, 5.0]
    with pytest.raises(ValueError):
        fetch.Retry(0, 0.0)(call)
    assert (fetch.MAP_RETRY.tries, fetch.MAP_RETRY.pause, fetch.PATCH_RETRY.tries, fetch.PATCH_RETRY.pause) == (5, 6.0, 4, 5.0)


def test_map_requests_are_tried_again(spark, server):
    server.fails = lambda what: 4
    places = {"elements": [{"type": "node", "lon": 1.0, "lat": 2.0, "tags": {"emergency": "water_tank"}}, {"type": "way", "center": {"lon": 3.0, "lat": 4.0}}, {"type": "way"}]}
    server.body = lambda what: json.dumps(places)
    got = fetch.target_points(spark, server.url, [(0, 0, 1, 1), (5, 5, 6, 6)], FAST).collect()
    assert sorted((r.request, r.lon, r.lat) for r in got) == [(0, 1.0, 2.0), (0, 3.0, 4.0), (1, 1.0, 2.0), (1, 3.0, 4.0)]
    assert len(server.asked) == 2 and set(server.asked.values()) == {5} and all("(0,0,1,1)" in q or "(5,5,6,6)" in q for q in server.asked)
    server.fails = lambda what: 10**6
    with pytest.raises(Exception, match="503"):
        fetch.target_points(spark, server.url, [(7, 7, 8, 8)], fetch.Retry(2, 0.0)).collect()


def test_geometries_and_boundaries(spark, server):
    line = [{"lon": 0.0, "lat": 0.0}, {"lon": 1.0, "lat": 0.0}]
    both = {"elements": [{"type": "way", "geometry": line, "tags": {"a": "b"}}, {"type": "relation", "members": [{"type": "way", "role": "inner", "geometry": line}, {"type": "node"}]}]}
    server.body = lambda what: json.dumps(both)
    got = fetch.geometries(spark, server.url, ('["a"="b"]',), [(0, 0, 1, 1)], FAST).collect()
    assert [(r.type, len(r.geometry)) for r in got] == [("way", 2)] and 'way["a"="b"](0,0,1,1)' in next(iter(server.asked)) and "out geom" in next(iter(server.asked))
    ways = fetch.relation_ways(spark, server.url, ["Town", "Éville"], FAST).collect()
    assert sorted((r.request, r.rel_ord, r.way_ord) for r in ways) == [(0, 1, 0), (1, 1, 0)] and any('"name"="Éville"' in q for q in server.asked)


def test_tiles_are_fetched_once(spark, server):
    tiles = spark.createDataFrame([(f"k{i % 7}", f"{server.url}/t{i % 7}") for i in range(20)] + [(None, f"{server.url}/none")], "key string, url string")
    server.fails = lambda what: {"/t1": 2, "/t2": 10**6}.get(what, 0)
    first = fetch.prefetch(tiles, "cache_once", retry=fetch.Retry(3, 0.0))
    statuses = lambda df: dict(sorted(tuple(r) for r in df.collect()))
    assert statuses(first) == {f"k{i}": "failed" if i == 2 else "fetched" for i in range(7)} == statuses(first)
    assert server.asked == {"/t0": 1, "/t1": 3, "/t2": 3, "/t3": 1, "/t4": 1, "/t5": 1, "/t6": 1}
    # Hits fetch nothing; the failed one is asked for again, and comes now.
    server.fails = lambda what: 0
    assert statuses(fetch.prefetch(tiles, "cache_once", retry=FAST)) == {f"k{i}": "fetched" if i == 2 else "hit" for i in range(7)}
    assert server.asked["/t2"] == 4 and sum(server.asked.values()) == 12
    assert statuses(fetch.prefetch(tiles, "cache_once", retry=FAST)) == {f"k{i}": "hit" for i in range(7)} and sum(server.asked.values()) == 12
    got = fetch.contents(spark.createDataFrame([("k3", 1), ("zz", 2)], "key string, n int"), "cache_once").orderBy("n").collect()
    assert bytes(got[0].content) == b"/t3" and got[1].content is None
    errors = spark.table("cache_once").where(F.col("error").isNotNull()).collect()
    assert [(r.key, r.content) for r in errors] == [("k2", None)] and "503" in errors[0].error
