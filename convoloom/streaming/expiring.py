"""Sessions of a stream that close for good: event-time state that leaves the store once the watermark has passed it."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: The store that keeps lists, single values and timers.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ("start", "end", "turns", "reason")
#: Buckets that keys are dealt to; fixed, since a checkpoint holds state by bucket.
BUCKETS = 1024
WAITING = pa.schema([("who", pa.string()), ("us", pa.int64()), ("id", pa.int64()), ("finish", pa.bool_())])
OPEN = pa.schema([("who", pa.string()), ("start", pa.int64()), ("last", pa.int64()), ("turns", pa.int64())])


class SessionProcessor(StatefulProcessor):
    """Events of a bucket of keys wait in a list of blocks until the watermark has passed them; then, in order of time and id and each
    once, they go to their key's open session. A bucket is one key of the state, so that a call on the state is not made for
    every key or event. A timer stands at the first waiting event or at the end of the gap after the last turn of a session,
    whichever is earlier; a bucket without either holds no state."""

    def __init__(self, key: str, gap_ms: int, max_turns: int):
        self.key, self.gap, self.most = key, gap_ms * 1000, max_turns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "block binary")
        self.open = handle.getValueState("open", "block binary")
        self.due = handle.getValueState("due", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        first, blocks = None, []
        for part in rows:
            if len(part):
                new = pa.table([pa.array(part["who"].tolist(), pa.string()), part["us"].to_numpy(), part["id"].to_numpy(), part["finish"].to_numpy(bool)], names=WAITING.names)
                blocks.append((_pack(new),))
                first = int(part["us"].min()) if first is None else min(first, int(part["us"].min()))
        if first is not None:
            self.waiting.appendList(blocks)
            due = self.due.get()
            if due is None or first // 1000 < due[0]:
                self._timer(first // 1000, due)
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = pa.concat_tables([WAITING.empty_table(), *(_unpack(b) for (b,) in self.waiting.get())])
        passed = pc.less(rows["us"], mark)
        ready, rest = rows.filter(passed), rows.filter(pc.invert(passed))
        ready = ready.group_by(WAITING.names).aggregate([]).sort_by([(c, "ascending") for c in WAITING.names])
        kept = self.open.get()
        sessions = {} if kept is None else {who: tuple(x) for who, *x in zip(*_unpack(kept[0]).to_pydict().values(), strict=True)}
        out = []
        for who, us, finish in zip(*(ready[c].to_pylist() for c in ("who", "us", "finish")), strict=True):
            session = sessions.pop(who, None)
            if session is not None and us - session[1] > self.gap:
                out.append((who, *session, "gap"))
                session = None
            session = (us, us, 1) if session is None else (session[0], us, session[2] + 1)
            if finish or session[2] >= self.most:
                out.append((who, *session, "finish" if finish else "limit"))
            else:
                sessions[who] = session
        for who in [w for w, x in sessions.items() if x[1] + self.gap < mark]:
            out.append((who, *sessions.pop(who), "gap"))
        if rest.num_rows:
            self.waiting.put([(_pack(rest),)])
        else:
            self.waiting.clear()
        if sessions:
            self.open.update((_pack(pa.table([list(c) for c in zip(*((w, *x) for w, x in sessions.items()), strict=True)], schema=OPEN)),))
        else:
            self.open.clear()
        self.due.clear()
        dues = ([pc.min(rest["us"]).as_py() // 1000] if rest.num_rows else []) + ([(min(x[1] for x in sessions.values()) + self.gap) // 1000] if sessions else [])
        if dues:
            self._timer(min(dues), None)
        if out:
            who, start, last, turns, reason = zip(*out, strict=True)
            yield pd.DataFrame({self.key: who, "start": pd.to_datetime(start, unit="us", utc=True), "end": pd.to_datetime(last, unit="us", utc=True), "turns": turns, "reason": reason})

    def _timer(self, ms: int, old: tuple | None) -> None:
        if old is not None:
            self.handle.deleteTimer(old[0])
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def close(self) -> None:
        pass


def _pack(t: pa.Table) -> bytes:
    """A table as bytes of the state."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as out:
        out.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpack(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(block)).read_all()


def _milliseconds(df: DataFrame, length: str) -> int:
    """An interval such as ``30 minutes`` in milliseconds."""
    return df.sparkSession.range(1).select((F.expr(f"unix_micros(timestamp_seconds(0) + interval {length})") / 1000).cast("long")).first()[0]


def _events(events: DataFrame, finish: Column, key: str, id_col: str, ts: str) -> DataFrame:
    when = F.col(ts).cast("timestamp")
    return events.filter(F.col(ts).isNotNull()).select(F.col(key), F.coalesce(F.col(id_col), F.lit(-1)).cast("long").alias("id"), when.alias("at"), F.unix_micros(when).alias("us"), F.coalesce(finish, F.lit(False)).alias("finish"))


def closed_sessions(
    events: DataFrame, finish: Column, gap: str = "30 minutes", max_turns: int = 20, late: str = "10 minutes", key: str = "user_id", id_col: str = "event_id", ts: str = "ts"
) -> DataFrame:
    """T2, T4 on a stream: (key, start, end, turns, reason) of every session once it is over for good.

    A session ends with an event that ``finish`` marks, with its ``max_turns``-th event, or when more than ``gap`` of event time passes
    without one. Events may come in any order up to ``late`` behind the newest; what comes later is dropped by the engine. An
    event that is repeated (same key, id and time) counts once. Null keys are a key, null ids an id; events without a time are
    left out. Rows are only given out behind the watermark, so they never change; all state of a session goes with it. The state is
    the open sessions and the events within ``late`` of BUCKETS buckets of keys; a bucket is read and written as a whole when one
    of its keys is due. The key is of a type that a cast to a string and back keeps. Needs the RocksDB state store (``use_store``).
    """
    rows = _events(events, finish, key, id_col, ts).withWatermark("at", late)
    kind = rows.schema[key].dataType
    binary = kind.typeName() == "binary"
    who = F.hex(key) if binary else F.col(key).cast("string")
    rows = rows.select(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).alias("bucket"), who.alias("who"), "id", "at", "us", "finish")
    made = SessionProcessor("who", _milliseconds(events, gap), max_turns)
    closed = rows.groupBy("bucket").transformWithStateInPandas(made, "who string, start timestamp, end timestamp, turns long, reason string", "Append", "EventTime")
    return closed.select((F.unhex("who") if binary else F.col("who").cast(kind)).alias(key), *COLUMNS)


def batch_sessions(
    events: DataFrame, finish: Column, gap: str = "30 minutes", max_turns: int = 20, late: str = "10 minutes", key: str = "user_id", id_col: str = "event_id", ts: str = "ts"
) -> DataFrame:
    """The rows of ``closed_sessions`` for a stream that has brought all of ``events``, as one batch."""
    rows = _events(events, finish, key, id_col, ts).distinct()
    lag, quiet = _milliseconds(events, late), _milliseconds(events, gap) * 1000
    mark = rows.agg(((F.floor(F.max("us") / 1000) - lag) * 1000).alias("mark"))
    rows = rows.join(F.broadcast(mark)).filter(F.col("us") < F.col("mark"))
    line = Window.partitionBy(key).orderBy("us", "id", "finish")
    new = F.coalesce((F.col("us") - F.lag("us").over(line) > quiet) | F.lag("finish").over(line), F.lit(True))
    rows = rows.withColumn("new", new).withColumn("part", F.sum(F.col("new").cast("int")).over(line))
    place = F.row_number().over(Window.partitionBy(key, "part").orderBy("us", "id", "finish"))
    rows = rows.withColumn("cut", F.floor((place - 1) / max_turns))
    whole = rows.groupBy(key, "part", "cut").agg(
        F.min("at").alias("start"), F.max("at").alias("end"), F.max("us").alias("last"), F.count("*").alias("turns"), F.bool_or("finish").alias("finish"), F.first("mark").alias("mark")
    )
    reason = F.when(F.col("finish"), "finish").when(F.col("turns") >= max_turns, "limit").when(F.col("part_end"), "gap")
    nexts = Window.partitionBy(key).orderBy("part", "cut")
    whole = whole.withColumn("part_end", F.lead("part").over(nexts).isNotNull() | (F.col("last") + quiet < F.col("mark")))
    return whole.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(key, *COLUMNS)


def use_store(spark) -> None:
    """Sets the RocksDB state store for streams that start from now on; it has to be the same for all runs of a checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
