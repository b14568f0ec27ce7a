"""Structured Streaming over event files: windowed counts with a watermark, month replacement, and
the checkpoint-and-replay operator as a stateful stream."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.late_events import accepted
from ..session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's file or folder as a stream."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if os.path.isfile(path):
        return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return spark.readStream.schema(schema).parquet(path)


def drain(stream: DataFrame, *, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> DataFrame | None:
    """Runs a stream over what is there now; gives what it wrote, unless `each` handles the batches."""
    spark = stream.sparkSession
    home = shared_folder(spark)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/ckpt").trigger(availableNow=True)
    if each is not None:
        writer.foreachBatch(each).start().awaitTermination()
        return None
    writer.format("parquet").option("path", f"{home}/out").start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{home}/out")


def window_counts(events: DataFrame, *, time: str, width: str, late: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums per tumbling window and key; events later than the watermark are dropped."""
    t = F.col(time).cast("timestamp")
    d = events.withColumn("__t", t).withWatermark("__t", late)
    amount = F.col(value).cast("decimal(18,4)")
    out = d.groupBy(F.window("__t", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"))
    return out.select(F.col("w.start").alias("desde"), *keys, "n", "total")


def sessions(events: DataFrame, *, time: str, gap: str, late: str, keys: list[str]) -> DataFrame:
    """Session windows: events of a key less than `gap` apart belong together."""
    d = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    out = d.groupBy(F.session_window("__t", gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("desde"), F.col("w.end").alias("hasta"), *keys, "n")


def stream_windows(spark: SparkSession, sf_dir: str, width: str = "1 hour") -> DataFrame:
    """Windowed counts of the events table, computed by a stream and closed at the end.

    The end of the input closes no window by itself, so the counts are kept in complete mode in a
    table that each batch replaces.
    """
    home = shared_folder(spark)
    counted = window_counts(file_stream(spark, sf_dir, "events"), time="ts", width=width, late="1 day", keys=["event_type"], value="value")
    drain(counted, mode="complete", each=lambda batch, _: batch.write.mode("overwrite").parquet(f"{home}/ventanas"))
    return spark.read.parquet(f"{home}/ventanas")


def replace_months(path: str) -> Callable[[DataFrame, int], None]:
    """A batch handler that replaces the months a batch holds: running it twice changes nothing."""
    from ..sources.files import write_months

    return lambda batch, _: write_months(batch, path)


def _partial_sums(key: str, event: str, value: str) -> Callable[[Iterator], Iterator]:
    """Sums per key and period of every Arrow batch: no state, so it can precede the stateful step."""

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by([key, event], use_threads=False).aggregate([(value, "sum")])
            yield from t.select([key, event, f"{value}_sum"]).rename_columns([key, event, value]).to_batches()

    return sums


def replay_stream(events: DataFrame, *, key: str, event: str, value: str, every: int, max_late: int, arrival: str | None = None) -> DataFrame:
    """Running totals per key in event order, corrected as late events arrive.

    The state of a key holds its sums per period and a snapshot of (period, running total) at every
    `every` periods.  A late event restores the snapshot before it, replays the sorted suffix, and
    gives out again every period from there, with a higher version that replaces the earlier one.

    With `arrival` (the period of the delivery an event came in) an event is late by its own two
    periods, as in `late_events.accepted`, so the results do not depend on how the events fall into
    batches; any period can still be corrected, and state grows by one sum per period of a key.
    Without it the only time known is that of the stream: events more than `max_late` periods behind
    the newest of their key in EARLIER batches are left out, and periods that no late event can
    precede any more are folded into the oldest snapshot.

    Events without key or period are left out; a null value adds nothing.  Only sums per key and
    period of each Arrow batch are shuffled, so a hot key does not gather its events in one task.
    """
    import pandas as pd

    kind = events.schema[key].dataType.simpleString()
    by_arrival = arrival is not None

    def step(k, frames, state):
        log, snaps, newest, version = state.get if state.exists else ([], [], None, 0)
        log, snaps = {p: v for p, v in log}, [tuple(x) for x in snaps]
        got: dict[int, float] = {}
        for f in frames:
            for p, v in zip(f[event], f[value]):
                if by_arrival or newest is None or newest - p <= max_late:
                    got[int(p)] = got.get(int(p), 0.0) + float(v)
        if got:
            version += 1
            first = min(got)
            newest = max(got) if newest is None else max(newest, *got)
            snaps = [s for s in snaps if s[0] <= first]  # restore the checkpoint before the first new event
            at, total = snaps[-1] if snaps else (min([first, *log]), 0.0)
            for p, v in got.items():
                log[p] = log.get(p, 0.0) + v
            out, seen = {}, at
            for p in sorted(x for x in log if x >= at):
                while seen + every <= p:
                    seen += every
                    snaps.append((seen, total))
                total += log[p]
                out[p] = total
            settled = [] if by_arrival else [s for s in snaps if s[0] <= newest - max_late]
            if settled:  # nothing can arrive before this snapshot any more
                snaps = [s for s in snaps if s[0] >= settled[-1][0]]
                log = {p: v for p, v in log.items() if p >= settled[-1][0]}
            rows = [(k[0], p, t, version) for p, t in sorted(out.items()) if p >= first]
            yield pd.DataFrame(rows, columns=[key, event, "total", "version"])
        state.update((sorted(log.items()), snaps, newest, version))

    if arrival is not None:
        events = accepted(events, key=key, event=event, arrival=arrival, max_late=max_late)
    kept = events.where(F.col(key).isNotNull() & F.col(event).isNotNull())
    kept = kept.select(key, F.col(event).cast("int").alias(event), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias(value))
    sums = kept.mapInArrow(_partial_sums(key, event, value), f"`{key}` {kind}, `{event}` int, `{value}` double")
    out = f"`{key}` {kind}, `{event}` int, total double, version int"
    pair = "array<struct<p:int,v:double>>"
    return sums.groupBy(key).applyInPandasWithState(step, out, f"log {pair}, snaps {pair}, newest int, version int", "update", "NoTimeout")
