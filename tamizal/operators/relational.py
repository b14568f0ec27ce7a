"""Keyed selection, ranks, hierarchies, set differences and joins as DataFrame compositions.

Every rule that depends on order takes explicit ordering columns; ties are settled by those columns,
so results do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..session import ensure_checkpoint_dir


def first_by(df: DataFrame, keys: list[str], order: list[str], where: Column | None = None) -> DataFrame:
    """One row per key: the first by `order` among those that satisfy `where`.

    An aggregate with map-side partial results instead of a sorted window, so a hot key costs one
    row per map task; null keys are a group of their own.
    """
    rest = [c for c in df.columns if c not in keys]
    d = df if where is None else df.where(where)
    pick = F.min(F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in rest]).alias("__fila"))).alias("__m")
    return d.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"__m.__fila.{c}").alias(c) for c in rest])


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by `order`."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.max(F.struct(*[F.col(c) for c in order], F.struct(*[F.col(c) for c in rest]).alias("__fila"))).alias("__m")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"__m.__fila.{c}").alias(c) for c in rest])


def rank_desc(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, puesto, de): rank() of every distinct value, largest first, and the size of its
    group, from running counts instead of a window over the group (W1, W2)."""
    d = running_counts(value_counts(df, keys, value), keys)
    return d.select(*keys, F.col("__v").alias(value), (F.col("__total") - F.col("__hasta") + 1).alias("puesto"), F.col("__total").alias("de"))


def in_tree(df: DataFrame, tree: DataFrame, code: str, name: str = "nodo") -> DataFrame:
    """Adds the node each code hangs on: its first 5 figures if they are in the tree, else 4.

    Nodes of 4 and 5 figures are at most 110 000 whatever the data, hence the broadcast.
    """
    nodes = tree.where(F.col("codigo").rlike("^[0-9]{4,5}$")).select("codigo").distinct()
    five, four = (F.broadcast(nodes.where(F.length("codigo") == n).select(F.col("codigo").alias(f"__c{n}"))) for n in (5, 4))
    d = df.join(five, F.left(F.col(code), F.lit(5)) == F.col("__c5"), "left").join(four, F.left(F.col(code), F.lit(4)) == F.col("__c4"), "left")
    return d.withColumn(name, scalars.node_of(F.col(code), F.col("__c5").isNotNull(), F.col("__c4").isNotNull())).drop("__c5", "__c4")


def mode_by(df: DataFrame, keys: list[str], value: str, weight: Column | None = None) -> DataFrame:
    """The most frequent (or heaviest) value per key; ties go to the smallest value."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(w.alias("peso"))
    best = counts.groupBy(*keys).agg(F.max("peso").alias("peso"), F.min_by(value, F.struct(-F.col("peso"), F.col(value))).alias(value))
    return best.select(*keys, value, "peso")


def value_counts(df: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """(keys, __t, __v, __n): how often each value (a double) occurs per group, with an order-keeping
    slice `__t` of the number line: 256 slices an octave, so their number is bounded by the range of
    the values and not by how many there are.  Null and NaN values do not count."""
    v = F.col(value).cast("double")
    d = df.select(*keys, v.alias("__v"), (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("__w"))
    size = F.floor(F.least(F.log2(F.abs("__v")) * 256, F.lit(500_000.0))) + 300_000
    part = F.when(F.col("__v") == 0, 0).otherwise(F.signum("__v") * size.cast("double")).cast("int")
    return d.where(F.col("__v").isNotNull() & ~F.isnan("__v")).withColumn("__t", part).groupBy(*keys, "__t", "__v").agg(F.sum("__w").alias("__n"))


def running_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Adds `__hasta` (values up to this one) and `__total` of the group to `value_counts` rows.

    The running count is that of the slices before, which are few rows per group, plus that inside the
    slice; so no task sorts a group, however many of all rows it holds.
    """
    k = [F.col(c) for c in keys]
    slices = counts.groupBy(*keys, "__t").agg(F.sum("__n").alias("__s"))
    over = Window.partitionBy(*k)
    before = F.sum("__s").over(over.orderBy("__t").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__s")
    slices = slices.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], F.col("__t").alias("__u"), before.alias("__antes"), F.sum("__s").over(over).alias("__total"))
    inside = counts.withColumn("__r", F.sum("__n").over(Window.partitionBy(*k, F.col("__t")).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    same = F.col("__t") == F.col("__u")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    j = inside.join(slices, same)
    return j.select(*keys, "__v", "__n", (F.col("__antes") + F.col("__r")).alias("__hasta"), "__total")


def quantiles(counts: DataFrame, keys: list[str], *, index: dict[str, str] | None = None, between: dict[str, float] | None = None) -> DataFrame:
    """(keys, n, one column per quantile) of `value_counts` rows, exact.

    index: 0-based position in the sorted values as an SQL expression over n (Q1, Q2: 'n div 4',
    'least(n * 10 div 100, n - 1)').  between: fraction, interpolated between neighbours (Q3).
    """
    d = running_counts(counts, keys).withColumnRenamed("__total", "n")
    at = {name: F.lit(q) * (F.col("n") - 1) for name, q in (between or {}).items()}
    wanted: dict[str, Column] = {name: F.expr(e) for name, e in (index or {}).items()}
    for name, pos in at.items():
        wanted |= {f"__bajo_{name}": F.floor(pos), f"__alto_{name}": F.ceil(pos)}
    hit = {name: (F.col("__hasta") - F.col("__n") <= i) & (i < F.col("__hasta")) for name, i in wanted.items()}
    g = d.where(reduce(Column.__or__, hit.values())).groupBy(*keys, "n").agg(*[F.max(F.when(h, F.col("__v"))).alias(name) for name, h in hit.items()])
    mixed = [(F.col(f"__bajo_{name}") + (F.col(f"__alto_{name}") - F.col(f"__bajo_{name}")) * (pos - F.floor(pos))).alias(name) for name, pos in at.items()]
    return g.select(*keys, "n", *(index or {}), *mixed)


def prefix_levels(df: DataFrame, code: str, longest: int) -> DataFrame:
    """A row per level of a code whose ancestors are its prefixes (J6): no theta join, no recursion.

    Null codes stay as one row with null level, for an unclassified bucket (U1).
    """
    levels = F.sequence(F.lit(1), F.least(F.length(code), F.lit(longest)))
    d = df.withColumn("nivel", F.explode_outer(F.when(F.length(code) > 0, levels)))
    return d.withColumn("nodo", F.expr(f"left(`{code}`, nivel)"))


def left_tree(tree: DataFrame, facts: DataFrame, code: str, zero: list[str]) -> DataFrame:
    """Every node of the tree with its facts, zeros for empty ones."""
    return tree.join(facts, code, "left").fillna(0, subset=zero)


def difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of left that right lacks (U2, U4); null keys never match."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def missing_months(loaded: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """(anio, mes) expected between two months and not loaded."""
    spark = loaded.sparkSession
    span = spark.sql(f"select explode(sequence(make_date({first[0]}, {first[1]}, 1), make_date({last[0]}, {last[1]}, 1), interval 1 month)) m")
    expected = span.select(F.year("m").alias("anio"), F.month("m").alias("mes"))
    return expected.join(loaded.select("anio", "mes").distinct(), ["anio", "mes"], "left_anti")


def orphan_months(items: DataFrame, processes: DataFrame) -> DataFrame:
    """(anio, mes, lineas): months that have lines and no process."""
    have = items.where("anio is not null and mes is not null").groupBy("anio", "mes").agg(F.count(F.lit(1)).alias("lineas"))
    return have.join(processes.select("anio", "mes").distinct(), ["anio", "mes"], "left_anti")


def fill_from(df: DataFrame, source: DataFrame, keys: list[str], columns: list[str], *, only_null: bool = True) -> DataFrame:
    """Values of `source` (one row per key) put where df has none, or everywhere."""
    side = source.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in columns])
    j = df.join(side, keys, "left")
    new = {c: F.coalesce(F.col(c), F.col(f"__n_{c}")) if only_null else F.coalesce(F.col(f"__n_{c}"), F.col(c)) for c in columns}
    return j.withColumns(new).select(*df.columns)


#: Pairs of one kind that a task should hold at a time (8 bytes each, twice that while they are read).
HELD = 12_000_000
#: Rows whose pairs are packed together.
PACKED = 1 << 20
#: Kinds of packed pairs: (through, left), (through, right) and (left, right).
OWN, MARK, MET = 0, 1, 2


def _packer(parts: int, kinds: tuple[int, ...]):
    """Rows (l, r, t, i, j: the parts of l and r) into packed pairs (kind, part, n, data): the distinct
    pairs of up to PACKED rows and one part, as compressed Arrow."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    columns = {OWN: ("t", "l", "i"), MARK: ("t", "r", "j"), MET: ("l", "r", "i")}

    def coded(column):
        """Codes in the order of the values, and the values."""
        enc = column.dictionary_encode()
        order = pc.sort_indices(enc.dictionary).to_numpy()
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return rank[enc.indices.to_numpy()], enc.dictionary.take(pa.array(order))

    def data_of(codes_a, codes_b, va, vb) -> bytes:
        """Sorted distinct pairs as three batches: the values of each side, and the steps from pair to pair
        where a pair is the number a * len(values of b) + b of its places among these values."""
        ua, a = np.unique(codes_a, return_inverse=True)
        ub, b = np.unique(codes_b, return_inverse=True)
        steps = np.diff(a * len(ub) + b, prepend=0)
        narrow = next(t for t in (np.uint16, np.uint32, np.int64) if steps.max() <= np.iinfo(t).max)
        sink = pa.BufferOutputStream()
        for x in (va.take(pa.array(ua)), vb.take(pa.array(ub)), pa.array(steps.astype(narrow))):
            batch = pa.RecordBatch.from_arrays([x], names=["x"])
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def packed(rows: pa.Table) -> pa.RecordBatch:
        out = []
        for kind in kinds:
            some = rows.select(columns[kind]).drop_null().combine_chunks()
            if not some.num_rows:
                continue
            (a, va), (b, vb) = (coded(some.column(k).chunk(0)) for k in (0, 1))
            key = np.unique((some.column(2).to_numpy().astype(np.int64) * len(va) + a) * len(vb) + b)
            a, b = np.divmod(key, len(vb))
            p, a = np.divmod(a, len(va))
            cuts = np.searchsorted(p, np.arange(parts + 1))
            for q in np.flatnonzero(np.diff(cuts)).tolist():
                at = slice(cuts[q], cuts[q + 1])
                out.append((kind, q, cuts[q + 1] - cuts[q], data_of(a[at], b[at], va, vb)))
        kind, part, n, data = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], names=["__kind", "__part", "__n", "__data"])

    def pack(batches: Iterator) -> Iterator:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACKED:
                yield packed(pa.Table.from_batches(held))
                held, rows = [], 0
        if held:
            yield packed(pa.Table.from_batches(held))

    return pack


def _count_cell(batches: Iterator) -> Iterator:
    """The packed pairs of one cell into (left, c): for each left, how many rights of the cell it reaches,
    or less how many it met."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    data: dict[int, list] = {OWN: [], MARK: [], MET: []}
    for batch in batches:
        for kind, d in zip(batch.column(0).to_pylist(), batch.column(1)):
            data[kind].append(d.as_buffer())

    def coded(kind: int):
        """Codes of both sides of all pairs of a kind, and the values of each side."""
        values, steps = ([], []), []
        for d in data.pop(kind):
            source = pa.BufferReader(d)
            for to in (*values, steps):
                to.append(pa.ipc.open_stream(source).read_all().column(0).chunk(0))
        codes = [np.empty(sum(map(len, steps)), dtype=np.int32) for _ in values]
        encoded = [pa.chunked_array(v).combine_chunks().dictionary_encode() for v in values]
        maps = [e.indices.to_numpy() for e in encoded]
        at, done = [0, 0], 0
        for va, vb, s in zip(*values, steps):
            places = np.divmod(np.cumsum(s.to_numpy(), dtype=np.int64), len(vb))
            for k, v in enumerate((va, vb)):
                codes[k][done : done + len(s)] = maps[k][at[k] : at[k] + len(v)][places[k]]
                at[k] += len(v)
            done += len(s)
        return *codes, *(e.dictionary for e in encoded)

    def distinct(high, low):
        """Pairs of codes as sorted distinct numbers."""
        key = high.astype(np.int64)
        key <<= 32
        key |= low
        key.sort()
        return key[np.append(True, key[1:] != key[:-1])] if len(key) else key

    def out(lefts, n):
        some = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([lefts.take(pa.array(some)), pa.array(n[some].astype(np.int64))], names=["__l", "__c"])

    if data[MET]:
        left, right, lefts, _ = coded(MET)
        key = distinct(left, right)
        yield out(lefts, -np.bincount(key >> 32, minlength=len(lefts)))
    if not data[OWN] or not data[MARK]:
        return
    through, right, known, rights = coded(MARK)
    sets = distinct(through, right)
    del through, right
    ends = np.searchsorted(sets, np.arange(1, len(known) + 1) << 32)
    starts = np.append(0, ends[:-1])
    sets &= 0xFFFFFFFF  # the rights of each `through` value, one after the other
    through, left, values, lefts = coded(OWN)
    place = pc.index_in(values, value_set=known).fill_null(-1).to_numpy()[through]
    own = distinct(left[place >= 0], place[place >= 0])
    del through, left, place
    cuts = np.searchsorted(own, np.arange(len(lefts) + 1) << 32)
    own &= 0xFFFFFFFF
    n, reached = np.zeros(len(lefts), dtype=np.int64), np.zeros(len(rights), dtype=bool)
    for k in range(len(lefts)):
        of = own[cuts[k] : cuts[k + 1]]
        a, b = starts[of], ends[of]
        spans = [sets[x:y] for x, y in zip(a.tolist(), b.tolist())]
        if len(spans) < 2:
            n[k] = sum(map(len, spans))
        elif (b - a).sum() * 16 < len(rights):  # few: not worth clearing and counting the whole mask
            n[k] = len(np.unique(np.concatenate(spans)))
        else:
            reached[:] = False
            for s in spans:
                reached[s] = True
            n[k] = np.count_nonzero(reached)
    yield out(lefts, n)


def never_met(pairs: DataFrame, offers: DataFrame, *, left: str, right: str, through: str) -> DataFrame:
    """Per left, how many rights share a `through` value with it and never met it.

    pairs: (left, right, through) that met, all of them also in offers; offers: (right, through).
    Each input is read once and its distinct pairs are kept packed.  Groups of lefts times groups of
    rights make a grid; a cell holds the `through` values of its lefts and the rights of all `through`
    values, and counts what each left reaches, so no pair of a left and a right that never met is
    written out.  Lefts without such rights have no row.
    """
    spark = pairs.sparkSession
    ensure_checkpoint_dir(spark)
    parts = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")) // 6)  # larger parts pack better
    part = lambda c: F.pmod(F.hash(c), F.lit(parts))
    packed_as = "__kind int, __part int, __n bigint, __data binary"
    rows = pairs.where(F.col(through).isNotNull()).select(F.col(left).alias("l"), F.col(right).alias("r"), F.col(through).alias("t"), part(left).alias("i"), part(right).alias("j"))
    packed = rows.mapInArrow(_packer(parts, (OWN, MARK, MET) if offers is pairs else (OWN, MET)), packed_as)
    if offers is not pairs:
        marks = offers.where(F.col(through).isNotNull()).select(F.col(right).alias("r"), F.col(through).alias("t"), part(right).alias("j"))
        packed = packed.union(marks.mapInArrow(_packer(parts, (MARK,)), packed_as))
    packed = packed.checkpoint()
    size = dict.fromkeys((OWN, MARK, MET), 0) | {r["__kind"]: r["n"] for r in packed.groupBy("__kind").agg(F.sum("__n").alias("n")).collect()}
    # as few groups as their size allows, since each side is sent once per group of the other; then as many as keep all cores busy
    i, j = (min(parts, max(1, -(-n // HELD))) for n in (max(size[OWN], size[MET]), size[MARK]))
    while i * j < 2 * spark.sparkContext.defaultParallelism and min(i, j) < parts:
        if j < parts and (size[MARK] * i >= size[OWN] * j or i == parts):
            j += 1
        else:
            i += 1
    # cell (x, y) is x * (j + 1) + y; those with y = j count what met
    over = lambda n, cell: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), cell)
    row, column = F.col("__part") % i, F.col("__part") % j
    cells = F.when(F.col("__kind") == OWN, over(j, lambda y: row * (j + 1) + y)).when(F.col("__kind") == MARK, over(i, lambda x: x * (j + 1) + column)).otherwise(F.array(row * (j + 1) + j))
    sent = packed.select("__kind", "__data", F.explode(cells).alias("__cell")).repartitionById(i * (j + 1), "__cell").select("__kind", "__data")
    counts = sent.mapInArrow(_count_cell, f"__l {pairs.schema[left].dataType.simpleString()}, __c bigint")
    return counts.groupBy(F.col("__l").alias(left)).agg(F.sum("__c").alias("n")).where("n > 0")


def top_k(df: DataFrame, order: list[Column], k: int, offset: int = 0) -> DataFrame:
    """The k first rows after `offset` (O1, O3, P14): TakeOrderedAndProject, no global sort."""
    return df.orderBy(*order).offset(offset).limit(k) if offset else df.orderBy(*order).limit(k)


def ranked(df: DataFrame, within: list[str], by: Column, name: str = "puesto") -> DataFrame:
    """rank() and size of the partition."""
    w = Window.partitionBy(*within)
    return df.withColumn(name, F.rank().over(w.orderBy(by)).cast("bigint")).withColumn("de", F.count(F.lit(1)).over(w))


def share(df: DataFrame, value: str, name: str = "cuota") -> DataFrame:
    """Each row's share of the total (W4): the total is one row, so no single-partition window."""
    total = df.agg(F.sum(value).alias("__total"))
    return df.join(F.broadcast(total)).withColumn(name, F.try_divide(F.col(value).cast("double"), F.col("__total").cast("double"))).drop("__total")
