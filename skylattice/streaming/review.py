"""Review verdicts as a keyed stream: the last verdict of each place wins, and an undo takes back the one before it.

Events may come late, in any order and repeatedly: they count once by their name and in the order of their times.  An
undo takes back the last verdict before it that still stands, and nothing if none does.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Fixed value: what an event says that takes back a verdict.
UNDO = "undo"

_STATE = "key string, verdict string, at bigint, events bigint"


def last_verdicts(events: DataFrame) -> DataFrame:
    """(key, verdict, at) of a stream or table of events (key, verdict, ts): the latest by time, ties by verdict."""
    last = events.groupBy("key").agg(F.max(F.struct("ts", "verdict")).alias("last"))
    return last.select("key", F.col("last.verdict").alias("verdict"), F.col("last.ts").alias("at"))


def standing_verdicts(events: DataFrame) -> DataFrame:
    """(key, verdict, at, events) of a table of events (key, event, verdict, ts): the verdict that stands and its time, null where all are undone.

    ``event`` is unique in a key but for repeats; of different events of one name the first by time counts.  Rows with a
    null key, event, verdict or ts go.  A verdict stands if no more undos than verdicts come after it, and the last such one wins.
    """
    known = events.where("key is not null and event is not null and verdict is not null and ts is not null")
    once = known.groupBy("key", "event").agg(F.min(F.struct(F.col("ts").cast("bigint").alias("ts"), "verdict")).alias("e")).select("key", "event", "e.*")
    later = Window.partitionBy("key").orderBy(F.desc("ts"), F.desc("event")).rowsBetween(Window.unboundedPreceding, -1)
    weighed = once.withColumn("open", F.coalesce(F.sum(F.when(F.col("verdict") == UNDO, 1).otherwise(-1)).over(later), F.lit(0)))
    stands = F.when((F.col("verdict") != UNDO) & (F.col("open") <= 0), F.struct("ts", "event", "verdict"))
    return weighed.groupBy("key").agg(F.max(stands).alias("s"), F.count("*").alias("events")).select("key", F.col("s.verdict").alias("verdict"), F.col("s.ts").alias("at"), "events")


class StandingVerdicts(StatefulProcessor):
    """Keeps each place's events by name and tells its verdict whenever one is new; a repeat changes nothing and tells nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._events = handle.getMapState("events", "event string", "ts bigint, verdict string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        changed = False
        for r in rows:
            if r.event is None or r.verdict is None or r.ts is None:
                continue
            new, old = (int(r.ts), r.verdict), self._events.getValue((r.event,)) if self._events.containsKey((r.event,)) else None
            if old is None or new < tuple(old):
                self._events.updateValue((r.event,), new)
                changed = True
        if changed:
            yield self._told(key[0])

    def _told(self, key: str) -> Row:
        events = sorted(((v[0], k[0], v[1]) for k, v in self._events.iterator()), reverse=True)
        open_ = 0
        for ts, _, verdict in events:
            if verdict == UNDO:
                open_ += 1
            elif open_ == 0:
                return Row(key=key, verdict=verdict, at=ts, events=len(events))
            else:
                open_ -= 1
        return Row(key=key, verdict=None, at=None, events=len(events))

    def close(self) -> None:
        pass


def live_verdicts(events: DataFrame) -> DataFrame:
    """Updates (key, verdict, at, events) of a stream of events (key, event, verdict, ts), the last of a key being ``standing_verdicts`` of all so far.

    The session's state store must be the one on disk (RocksDB), so that state isn't bound by memory; a place keeps one
    small row an event.
    """
    keyed = events.where("key is not null").select("key", "event", "verdict", F.col("ts").cast("bigint").alias("ts"))
    return keyed.groupBy("key").transformWithState(statefulProcessor=StandingVerdicts(), outputStructType=_STATE, outputMode="Update", timeMode="None")


def upsert(updates: DataFrame, path: str, checkpoint: str):
    """A streaming query that appends each batch of updates to the folder ``path``; a batch that is written again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)


def state(spark, path: str) -> DataFrame:
    """(key, verdict, at, events): the latest update of each key in a folder of ``upsert``."""
    rows = spark.read.parquet(path)
    return rows.groupBy("key").agg(F.max_by(F.struct("verdict", "at", "events"), "batch").alias("s")).select("key", "s.*")
