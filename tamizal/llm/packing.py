"""Filling fixed-capacity containers: shortest-pack-first over the length histogram.

Lengths are placed longest first.  Of the packs that still have room, the one with the least content
is filled first; packs with the same content history are one pattern with a count, so the work
depends on the capacity and not on the number of items.  The patterns are then joined back to the
items by their rank within their length.

Defined cases: items larger than the capacity are split into full pieces and a rest; items of size 0
or null take no room and belong to no container (null container); ties in length are ordered by key
and piece; repeated keys are separate items; an empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Ranks inside a length are counted in slices of about so many items, so no length (however
#: frequent) is numbered by one task.
SLICE = 200_000


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """[(number of containers, lengths in them)], every length placed exactly counts[length] times."""
    packs: dict[int, list[list]] = {}  # content -> [count, lengths]
    for length in sorted((x for x, n in counts.items() if n > 0), reverse=True):
        left = counts[length]
        while left:
            fill = min((f for f in packs if f + length <= capacity), default=None)
            if fill is None:
                # item by item, a new pack takes more of the same length before another is opened
                full, rest = divmod(left, capacity // length)
                if full:
                    packs.setdefault(capacity // length * length, []).append([full, (length,) * (capacity // length)])
                if rest:
                    packs.setdefault(rest * length, []).append([1, (length,) * rest])
                break
            pattern = packs[fill][-1]
            used = min(left, pattern[0])
            pattern[0] -= used
            if not pattern[0]:
                packs[fill].pop()
                if not packs[fill]:
                    del packs[fill]
            packs.setdefault(fill + length, []).append([used, (*pattern[1], length)])
            left -= used
    return [(n, lengths) for each in packs.values() for n, lengths in each]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, container of the first rank, offset in the container)."""
    taken: dict[int, int] = {}
    out, base = [], 0
    for n, lengths in patterns:
        at = 0
        for length in lengths:
            first = taken.get(length, 0)
            out.append((length, first, first + n, base, at))
            taken[length] = first + n
            at += length
        base += n
    return sorted(out)


def _place(batches: Iterator, shared) -> Iterator:
    import numpy as np
    import pyarrow as pa

    length, first, _, base, at = shared.value
    order = length * (1 << 44) + first
    for b in batches:
        rank = b.column(b.schema.get_field_index("rango")).to_numpy(zero_copy_only=False)
        largo = b.column(b.schema.get_field_index("largo")).to_numpy(zero_copy_only=False).astype("int64")
        k = np.searchsorted(order, largo * (1 << 44) + rank, "right") - 1
        names = [n for n in b.schema.names if n != "rango"]
        cols = [b.column(b.schema.get_field_index(n)) for n in names]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(base[k] + rank - first[k]), pa.array(at[k].astype("int32"))], names=[*names, "contenedor", "posicion"])


def pack(sizes: DataFrame, *, key: str, size: str, capacity: int) -> DataFrame:
    """(key, pieza, inicio, largo, contenedor, posicion): one row per piece of every item."""
    import numpy as np

    ensure_checkpoint_dir(sizes.sparkSession)
    n = F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0))
    items = sizes.select(F.col(f"`{key}`").alias("clave"), n.alias("n"), F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / capacity) - 1, F.lit(0)).cast("int"))).alias("pieza"))
    items = items.select("clave", "pieza", (F.col("pieza").cast("long") * capacity).alias("inicio"), F.least(F.col("n") - F.col("pieza").cast("long") * capacity, F.lit(capacity)).cast("int").alias("largo")).checkpoint()
    counts = {r["largo"]: r["c"] for r in items.where("largo > 0").groupBy("largo").agg(F.count(F.lit(1)).alias("c")).collect()}  # at most `capacity` rows
    table = slots(pack_histogram(counts, capacity))
    slices = max(1, -(-sum(counts.values()) // SLICE))
    d = items.where("largo > 0").withColumn("corte", F.pmod(F.xxhash64("clave", "pieza"), F.lit(slices)).cast("int"))
    sizes_of = d.groupBy("largo", "corte").agg(F.count(F.lit(1)).alias("c"))
    before = sizes_of.select("largo", "corte", (F.sum("c").over(Window.partitionBy("largo").orderBy("corte")) - F.col("c")).alias("antes"))
    local = F.row_number().over(Window.partitionBy("largo", "corte").orderBy("clave", "pieza")) - 1
    ranked = d.withColumn("__r", local).join(before, ["largo", "corte"]).select("clave", "pieza", "inicio", "largo", (F.col("__r") + F.col("antes")).alias("rango"))
    kind = items.schema["clave"].dataType.simpleString()
    columns = f"clave {kind}, pieza int, inicio bigint, largo int, contenedor bigint, posicion int"
    # a row per slot of a pattern: their number follows the capacity, not the items
    shared = sizes.sparkSession.sparkContext.broadcast(tuple(np.array(c, dtype="int64") for c in zip(*table)) if table else tuple(np.zeros(0, dtype="int64") for _ in range(5)))
    placed = ranked.mapInArrow(partial(_place, shared=shared), columns)
    none = items.where("largo <= 0").select("clave", "pieza", "inicio", "largo", F.lit(None).cast("long").alias("contenedor"), F.lit(None).cast("int").alias("posicion"))
    return placed.unionByName(none).withColumnRenamed("clave", key)
