"""ST1 on ``transformWithStateInPandas``: best-k retention over restarted, late, finished runs.

Runs are dealt into ``BUCKETS`` groups, so that frames, state calls and timers are paid per
bucket and not per run. State of a bucket:

* ``clock``: map state, for each run its last step, session number and last event time, and
  the at most k retained ``(loss, step)`` of its current session;
* ``waiting``: list state, the events that the watermark has not passed, a frame of them as
  one value of four columns. They are taken in event-time order once it has, so late
  events inside the watermark give the same decisions as ordered ones; of a run's events
  equal in (event time, step) the last one counts;
* ``check``: value state, when the first run of the bucket may be finished.

A timer fires when the watermark reaches the earliest waiting event; another one, ``idle``
after a run's last event, deletes the state of finished runs. A stream that goes on where a
batch job stopped gets the retained checkpoints as initial state.

Events are stored frame by frame. A bucket's waiting events are in memory together when
the watermark passes some of them; bound a micro-batch by the source's options. The state
store must be RocksDB (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import ensure_checkpoint_dir, ship_by_value

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 1024  # part of the state's layout: a checkpoint goes on with the number it began with
CHUNK = 10_000
RUN = T.StructType([T.StructField("run", T.StringType())])
CLOCK = T.StructType(
    [T.StructField("step", T.LongType()), T.StructField("session", T.LongType()), T.StructField("at", T.LongType()),
     T.StructField("losses", T.ArrayType(T.DoubleType())), T.StructField("steps", T.ArrayType(T.LongType()))]
)
WAITING = T.StructType(
    [T.StructField("run", T.ArrayType(T.StringType())), T.StructField("at", T.ArrayType(T.LongType())),
     T.StructField("step", T.ArrayType(T.LongType())), T.StructField("loss", T.ArrayType(T.DoubleType()))]
)
CHECK = T.StructType([T.StructField("at", T.LongType())])


class SessionBestK(StatefulProcessor):
    """One bucket of runs: see the module text. ``idle_ms`` None: finished runs are kept."""

    def __init__(self, k: int, idle_ms: int | None):
        self.k, self.idle_ms = k, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getMapState("clock", RUN, CLOCK)
        self.waiting = handle.getListState("waiting", WAITING)
        self.check = handle.getValueState("check", CHECK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            self._wait(frame["run"].to_numpy(object), *(frame[c].to_numpy() for c in ("at_ms", "step", "eval_loss")))
            low = int(frame["at_ms"].min())
            first = low if first is None else min(first, low)
        watermark = timerValues.getCurrentWatermarkInMs()
        if first is not None and first > watermark:
            self.handle.registerTimer(first)  # what waits from before has its own timer
        else:
            yield from self._due(watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        yield from self._due(watermark)
        check = self.check.get()
        if check is not None and watermark >= check[0]:
            self._forget(watermark)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for run, rows in initialState.groupby("run", dropna=False, sort=False):
            run = None if pd.isna(run) else run
            step, session, at, losses, steps = self.clock.getValue((run,)) or (None, 0, 0, [], [])
            best = sorted([*zip(losses, steps), *((float(a), int(b)) for a, b in zip(rows["eval_loss"], rows["step"]))])[: self.k]
            last = int(rows["last_step"].max())
            self.clock.updateValue((run,), (last if step is None else max(step, last), max(session, int(rows["session"].max())), max(at, int(rows["at_ms"].max())), [a for a, _ in best], [b for _, b in best]))

    def _wait(self, *columns: np.ndarray) -> None:
        for i in range(0, len(columns[0]), CHUNK):
            self.waiting.appendValue(tuple(x[i : i + CHUNK].tolist() for x in columns))

    def _held(self) -> list[np.ndarray]:
        held = list(self.waiting.get())
        return [np.concatenate([np.array(h[c], kind) for h in held]) for c, kind in enumerate((object, np.int64, np.int64, np.float64))] if held else []

    def _due(self, watermark: int) -> Iterator[pd.DataFrame]:
        """Decisions of the waiting events that the watermark has passed."""
        held = self._held()
        if not held or not (now := held[1] <= watermark).any():
            return
        self.waiting.clear()
        if not now.all():
            later = [x[~now] for x in held]
            self._wait(*later)
            self.handle.registerTimer(int(later[1].min()))
        run, at, step, loss = (x[now] for x in held)
        code, names = pd.factorize(run, use_na_sentinel=False)
        order = np.lexsort((step, at, code))
        c, t, s = code[order], at[order], step[order]
        order = order[np.append((c[1:] != c[:-1]) | (t[1:] != t[:-1]) | (s[1:] != s[:-1]), True)]
        out = []
        ends = np.flatnonzero(np.append(np.diff(code[order]) != 0, True)) + 1
        for a, z in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
            mine = order[a:z]
            self._decide(run[mine[0]], zip(at[mine].tolist(), step[mine].tolist(), loss[mine].tolist()), out)
        if self.idle_ms is not None:
            self._check_at(int(at.min()) + self.idle_ms)
        if out:
            yield pd.DataFrame(out, columns=["run", "session", "step", "eval_loss", "saved", "pruned_step"])

    def _decide(self, run: str | None, events, out: list) -> None:
        """One run's events, in order."""
        last, session, seen, losses, steps = self.clock.getValue((run,)) or (None, 1, 0, [], [])
        best = list(zip(losses, steps))
        for at, step, loss in events:
            if last is not None and step <= last:
                best, session = [], session + 1
            last, seen = step, max(seen, at)
            if loss != loss:
                continue
            saved = len(best) < self.k or loss < best[-1][0]
            gone = best.pop()[1] if saved and len(best) == self.k else None
            if saved:
                best.append((loss, step))
                best.sort()
            out.append((run, session, step, loss, saved, gone))
        self.clock.updateValue((run,), (last, session, seen, [a for a, _ in best], [b for _, b in best]))

    def _check_at(self, at: int) -> None:
        check = self.check.get()
        if check is None or at < check[0]:
            self.check.update((at,))
            self.handle.registerTimer(at)

    def _forget(self, watermark: int) -> None:
        """Deletes the finished runs of the bucket and sets the next look."""
        held = self._held()
        busy = set(held[0].tolist()) if held else set()
        done, ahead = [], None
        for (run,), clock in self.clock.iterator():
            end = clock[2] + self.idle_ms
            if end > watermark:
                ahead = end if ahead is None else min(ahead, end)
            elif run not in busy:  # a busy one is looked at again when its events are due
                done.append(run)
        for run in done:
            self.clock.removeKey((run,))
        self.check.clear()
        if ahead is not None:
            self._check_at(ahead)

    def close(self) -> None:
        pass


def session_best_k_stream(events: DataFrame, k: int = 2, delay: str = "1 hour", idle: str | None = None, initial: DataFrame | None = None) -> DataFrame:
    """Streaming ``events (run_id, at timestamp, step, eval_loss)`` -> append-only decisions
    ``(run_id, session, step, eval_loss, saved, pruned_step)``.

    Events count in the order of ``(at, step)``; those later than ``delay`` behind the
    newest are dropped by the watermark. A NULL or NaN loss saves nothing but its step
    counts for the session. ``idle``: how long after its last event a run is finished.
    ``initial (run_id, session, step, eval_loss, last_step, at)``: the retained
    checkpoints of runs that a batch job has handled so far.
    """
    if k < 1:
        raise ValueError("k must be >= 1")
    spark = events.sparkSession
    ship_by_value(__name__)
    idle_ms = None if idle is None else int(spark.range(1).select((F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {idle}"))).alias("m")).first()["m"])
    kind = events.schema["run_id"].dataType
    run = F.hex("run_id") if isinstance(kind, T.BinaryType) else F.col("run_id").cast("string")  # no float for a NULL among ids
    bucket = F.pmod(F.xxhash64("run_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    src = events.select(bucket, run.alias("run"), "at", F.unix_millis("at").alias("at_ms"), F.col("step").cast("long"), F.col("eval_loss").cast("double"))
    src = src.where("at IS NOT NULL AND step IS NOT NULL").fillna(float("nan"), ["eval_loss"]).withWatermark("at", delay)
    out = T.StructType(
        [T.StructField("run", T.StringType()), T.StructField("session", T.LongType()), T.StructField("step", T.LongType()), T.StructField("eval_loss", T.DoubleType()),
         T.StructField("saved", T.BooleanType()), T.StructField("pruned_step", T.LongType())]
    )
    start = None
    if initial is not None:
        start = initial.withColumn("run_id", F.col("run_id").cast(kind)).select(bucket, run.alias("run"), "session", "step", "eval_loss", "last_step", F.unix_millis("at").alias("at_ms")).groupBy("bucket")
    got = src.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=SessionBestK(k, idle_ms), outputStructType=out, outputMode="Append", timeMode="EventTime", initialState=start
    )
    back = F.unhex("run") if isinstance(kind, T.BinaryType) else F.col("run").cast(kind)
    return got.select(back.alias("run_id"), "session", "step", "eval_loss", "saved", "pruned_step")


def replay_sessions(spark: SparkSession, events: DataFrame, k: int = 2, delay: str = "1 hour", idle: str | None = None, drops: int = 4, initial: DataFrame | None = None) -> DataFrame:
    """Feed a finished table ``(run_id, at, step, eval_loss)`` through the stream as ``drops``
    micro-batches cut by event time; a last drop with one row far in the future moves the
    watermark past every event. Uses a session of its own, whose state store is RocksDB."""
    mine = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        mine.conf.set(name, spark.conf.get(name))
    mine.conf.set(PROVIDER_CONF, ROCKSDB)
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/session-best-k-{uuid.uuid4().hex}"
    ev = events.select("run_id", F.col("at").cast("timestamp").alias("at"), F.col("step").cast("long"), F.col("eval_loss").cast("double"))
    ends = ev.agg(F.unix_millis(F.min("at")).alias("lo"), F.unix_millis(F.max("at")).alias("hi")).first()
    span = (ends["hi"] or 0) - (ends["lo"] or 0) + 1
    drop = F.floor((F.unix_millis("at") - F.lit(ends["lo"] or 0)) * drops / F.lit(span))
    ev.withColumn("drop", F.greatest(F.least(drop, F.lit(drops - 1)), F.lit(0))).write.partitionBy("drop").parquet(f"{base}/staged")
    if initial is not None:
        initial.write.parquet(f"{base}/initial")
    for i in range(drops + 1):
        part = spark.read.schema(ev.schema).parquet(f"{base}/staged/drop={i}") if i < drops and _exists(spark, f"{base}/staged/drop={i}") else None
        if i == drops:
            far = F.timestamp_millis(F.lit((ends["hi"] or 0) + 400 * 86_400_000))
            part = spark.range(1).select(F.lit(None).cast(ev.schema["run_id"].dataType).alias("run_id"), far.alias("at"), F.lit(0).cast("long").alias("step"), F.lit(None).cast("double").alias("eval_loss"))
        if part is None:
            continue
        part.write.mode("append").parquet(f"{base}/in")
        stream = mine.readStream.schema(ev.schema).parquet(f"{base}/in")
        start = None if initial is None else mine.read.schema(initial.schema).parquet(f"{base}/initial")
        got = session_best_k_stream(stream, k, delay, idle, start)
        q = got.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.schema(got.schema).parquet(f"{base}/out")


def _exists(spark: SparkSession, path: str) -> bool:
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)
