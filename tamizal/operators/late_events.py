"""Late and out-of-order events: per-period aggregates by event time, corrected by replay.

Events of a key arrive in deliveries.  The state of a key is ordered by delivery, and a snapshot of
it (a checkpoint) is kept at every `interval` deliveries.  A delivery that brings an event of
another period than its own restores the checkpoint that precedes it, replays the sorted suffix of
the key's events from there, and the outputs of the key are replaced by those of the replayed state.

Here the state is "the last accepted record of the key", so a segment of the log between two
checkpoints folds to one record by an aggregate with map-side partial results: a key that holds a
third of all events never gathers in one task, and at most (number of segments) rows per key meet.

Defined cases: events without key, event period or arrival period, and events later than `max_late`
periods, are left out; early events are kept; of several events of one delivery the highest `order`
counts (ties: the greatest carried values); an empty log gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def accepted(events: DataFrame, *, key: str, event: str, arrival: str, max_late: int) -> DataFrame:
    """The events inside the lateness cut-off (periods are month indexes)."""
    return events.where(F.col(key).isNotNull() & F.col(event).isNotNull() & F.col(arrival).isNotNull() & (F.col(arrival) - F.col(event) <= max_late))


def _state(event: str, arrival: str, order: str, carry: list[str]) -> Column:
    return F.struct(F.col(arrival).alias("llegada"), F.col(order).alias("orden"), F.col(event).alias("evento"), *[F.col(c) for c in carry])


def checkpoints(events: DataFrame, *, key: str, event: str, arrival: str, order: str, carry: list[str], interval: int) -> DataFrame:
    """One row per key and segment of the log: the folded state and the snapshot that precedes it.

    Columns: key, tramo (segment), estado (state folded over the segment), punto (the checkpoint:
    state over all earlier segments, null before the first), tardio (the segment holds an event of
    another period than its delivery's).
    """
    state = _state(event, arrival, order, carry)
    folded = events.groupBy(F.col(key), F.floor(F.col(arrival) / interval).cast("int").alias("tramo")).agg(
        F.max(state).alias("estado"), F.max(F.col(event) != F.col(arrival)).alias("tardio")
    )
    w = Window.partitionBy(key).orderBy("tramo").rowsBetween(Window.unboundedPreceding, -1)
    return folded.withColumn("punto", F.max("estado").over(w))


def replay(points: DataFrame, *, key: str) -> DataFrame:
    """The published and the corrected state of every key.

    Columns: key, publicado (the state the running fold has published: of all segments, or of those
    before the first disturbed one, null if there is none), estado (keys with out-of-order events:
    the restored checkpoint before the first disturbed segment and the replayed suffix; null for the
    others), repuesto (the key's output has to be replaced by `estado`).
    """
    w = Window.partitionBy(key)
    first = F.min(F.when(F.col("tardio"), F.col("tramo"))).over(w)
    marked = points.withColumn("desde", first)
    disturbed = F.col("desde").isNotNull()
    restored = F.max(F.when(F.col("tramo") == F.col("desde"), F.col("punto")))
    suffix = F.max(F.when(F.col("tramo") >= F.col("desde"), F.col("estado")))
    untouched = F.greatest(F.max(F.when(~disturbed, F.col("punto"))), F.max(F.when(~disturbed, F.col("estado"))))
    return marked.groupBy(key).agg(F.coalesce(restored, untouched).alias("publicado"), F.greatest(restored, suffix).alias("estado"), F.max(disturbed).alias("repuesto"))


def restate(
    events: DataFrame,
    published: DataFrame,
    *,
    key: str,
    event: str,
    arrival: str,
    order: str,
    group: str,
    count: str,
    max_late: int,
    interval: int = 3,
) -> DataFrame:
    """(evento, group, restado, publicado): counts per period and group, restated and as published.

    `published` has (evento, group, count) rows to be added up.  Null groups are a group of their own.
    """
    kept = accepted(events, key=key, event=event, arrival=arrival, max_late=max_late)
    points = checkpoints(kept, key=key, event=event, arrival=arrival, order=order, carry=[group], interval=interval)
    # the outputs of marked keys are replaced, the others stand as they are
    state = replay(points, key=key).select(F.when(F.col("repuesto"), F.col("estado")).otherwise(F.col("publicado")).alias("estado"))
    new = state.select(F.col("estado.evento").alias("evento"), F.col(f"estado.{group}").alias(group), F.lit(1).cast("long").alias("r"), F.lit(0).cast("long").alias("p"))
    old = published.select(F.col(event).alias("evento"), F.col(group), F.lit(0).cast("long").alias("r"), F.coalesce(F.col(count).cast("long"), F.lit(0)).alias("p"))
    return new.unionByName(old).groupBy("evento", group).agg(F.sum("r").alias("restado"), F.sum("p").alias("publicado"))


class CheckpointStore:
    """The snapshots of all keys in a folder that outlives a run, so that a run reads its new delivery
    and, of what is stored, only the keys the delivery touches.

    Rows of the folder: key, tramo (segment of the log), estado (the segment folded), hasta (the
    snapshot: the state after the segment), version (the run that wrote them).  A delivery restores
    each touched key's last snapshot before its earliest segment in the delivery, replays the sorted
    suffix (stored segments from there on and the new ones), and writes the suffix again under its own
    version; of several versions of a segment the newest counts.  What was written stays as it is until
    the next version is complete, so a run that fails can be started again.
    """

    def __init__(self, path: str, *, key: str, event: str, arrival: str, order: str, carry: list[str], max_late: int, interval: int = 3):
        self.path, self.key, self.event, self.arrival, self.order, self.carry, self.max_late, self.interval = path, key, event, arrival, order, carry, max_late, interval

    def stored(self, spark, versions: int) -> DataFrame | None:
        """The newest rows of every key and segment after so many deliveries."""
        if not versions:
            return None
        each = [spark.read.parquet(f"{self.path}/version={v}").withColumn("version", F.lit(v)) for v in range(versions)]
        row = F.max(F.struct("version", "estado", "hasta")).alias("x")
        return reduce(DataFrame.unionByName, each).groupBy(self.key, "tramo").agg(row).select(self.key, "tramo", "x.estado", "x.hasta")

    def deliver(self, events: DataFrame, version: int) -> DataFrame:
        """Takes in delivery number `version` (0, 1, ...); gives (key, antes, despues): the keys whose
        output changes, with the state to take back (null if there was none) and the one to put."""
        spark, key = events.sparkSession, self.key
        kept = accepted(events, key=key, event=self.event, arrival=self.arrival, max_late=self.max_late)
        new = kept.groupBy(key, F.floor(F.col(self.arrival) / self.interval).cast("int").alias("tramo")).agg(F.max(_state(self.event, self.arrival, self.order, self.carry)).alias("estado"))
        touched = new.groupBy(key).agg(F.min("tramo").alias("desde"))
        old = self.stored(spark, version)
        segments = new
        if old is not None:
            mine = old.join(touched, key)
            restored = mine.where("tramo < desde").groupBy(key).agg(F.max_by("hasta", "tramo").alias("punto"))
            suffix = new.unionByName(mine.where("tramo >= desde").select(new.columns))
            segments = suffix.groupBy(key, "tramo").agg(F.max("estado").alias("estado")).join(restored, key, "left")
        else:
            segments = segments.withColumn("punto", F.lit(None).cast(new.schema["estado"].dataType))
        run = Window.partitionBy(key).orderBy("tramo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        segments = segments.withColumn("hasta", F.greatest(F.max("estado").over(run), F.col("punto")))
        segments.select(key, "tramo", "estado", "hasta").write.mode("overwrite").parquet(f"{self.path}/version={version}")
        after = spark.read.parquet(f"{self.path}/version={version}").groupBy(key).agg(F.max_by("hasta", "tramo").alias("despues"))
        if old is None:
            return after.select(key, F.lit(None).cast(after.schema["despues"].dataType).alias("antes"), "despues")
        before = old.join(touched.select(key), key, "left_semi").groupBy(key).agg(F.max_by("hasta", "tramo").alias("antes"))
        return after.join(before, key, "left").select(key, "antes", "despues").where(~F.col("antes").eqNullSafe(F.col("despues")))
