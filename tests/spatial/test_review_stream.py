import random

from skylattice.streaming import review

EVENTS = "key string, event string, verdict string, ts bigint"


def told(events):
    """The standing verdicts by replaying each key's events with a stack."""
    out = {}
    for key in {e[0] for e in events if e[0] is not None}:
        first = {}
        for _, event, verdict, ts in (e for e in events if e[0] == key and None not in e):
            first[event] = min(first.get(event, (ts, verdict)), (ts, verdict))
        if not first:
            continue
        stack = []
        for (ts, verdict), _ in sorted(((v, k) for k, v in first.items()), key=lambda x: (x[0][0], x[1])):
            if verdict != review.UNDO:
                stack.append((verdict, ts))
            elif stack:
                stack.pop()
        out[key] = (*(stack[-1] if stack else (None, None)), len(first))
    return out


def drawn(n, seed):
    rng = random.Random(seed)
    events = [(f"k{rng.randint(0, 12)}", f"e{rng.randint(0, 60)}", rng.choice(["vrai", "faux", "skip", "undo", "undo"]), rng.randint(0, 50)) for _ in range(n)]
    return events + events[: n // 5] + [(None, "e", "vrai", 1), ("k1", None, "vrai", 99), ("k2", "x", None, 99), ("k3", "y", "vrai", None), ("gone", "a", "undo", 1)]


def test_standing_verdicts_replay_events(spark):
    for seed in range(3):
        events = drawn(400, seed)
        got = {r.key: (r.verdict, r.at, r.events) for r in review.standing_verdicts(spark.createDataFrame(events, EVENTS).repartition(5)).collect()}
        assert got == told(events) and any(v[0] is None for v in got.values())
    assert review.standing_verdicts(spark.createDataFrame([], EVENTS)).count() == 0


def test_stream_restarts_and_equals_the_table(spark, tmp_path):
    events = drawn(300, 7)
    random.Random(8).shuffle(events)  # late ones come in any batch
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run(parts):
        for part in parts:
            spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(source)
        query = review.upsert(review.live_verdicts(stream), target, checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(240)
        assert query.exception() is None and not query.isActive

    try:
        run([events[:120], events[120:200]])
        assert {r.key: (r.verdict, r.at, r.events) for r in review.state(spark, target).collect()} == told(events[:200])
        # A new query goes on from the checkpoint; what comes again changes nothing.
        run([events[200:], events[:50]])
        got = {r.key: (r.verdict, r.at, r.events) for r in review.state(spark, target).collect()}
        assert got == told(events)
        assert got == {r.key: (r.verdict, r.at, r.events) for r in review.standing_verdicts(spark.createDataFrame(events, EVENTS)).collect()}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
