"""Exact order statistics per group over very many values: distributed multi-select.

Values are kept as sorted runs of (value, count), spread over all partitions, so that no group (not
even one with a third of all rows) ever meets in one task.  The ranks wanted of a group lie in
disjoint ranges of its values.  Each round every partition proposes its local median of each range;
the weighted median of the proposals (always a value of the range) is the pivot; all runs count three
ways (below, equal, above); a rank is found at the pivot or goes on in one of the two halves, and
what no rank can reach any more is discarded.  A pivot of that kind leaves at most three quarters of a
range, so the rounds are O(log n) and bounded.  Ranges of at most FINISH values are finished by
gathering just those.  The error is zero, and summaries of partitions, months or days add up: `merge`
of their histograms gives the percentiles of all.

The state of a round is one entry per open range.  Groups with more than FINISH values go through the
rounds in batches of at most BATCH groups, so the state held by the driver and sent to the executors
is bounded whatever the number of groups; smaller groups need no round.

Defined cases: null and NaN values are not values; infinities are; ties share a value and count as
often as they occur; ranks outside 1..n are null; an empty input gives an empty result; groups are
compared as strings, and null groups are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Ranges of at most so many values are gathered.
FINISH = 1024
#: Rows folded into one set of runs.
BLOCK = 400_000
#: Groups that go through the rounds together.
BATCH = 20_000
#: log(2^63) to the base 4/3, and some.
MOST_ROUNDS = 200
_RUNS = "grupo string, valores array<double>, cuentas array<bigint>, total bigint"


def observations(df: DataFrame, *, group: Column, value: Column) -> DataFrame:
    """(grupo, valor, n) with a row per value: multi_select folds them where they are."""
    v = value.cast("double")
    d = df.select(group.cast("string").alias("grupo"), v.alias("valor"), F.lit(1).cast("bigint").alias("n"))
    return d.where(F.col("grupo").isNotNull() & F.col("valor").isNotNull() & ~F.isnan("valor"))


def histogram(df: DataFrame, *, group: Column, value: Column) -> DataFrame:
    """(grupo, valor, n): the mergeable summary; map-side partial counts keep its shuffle small."""
    return merge(observations(df, group=group, value=value))


def merge(*parts: DataFrame) -> DataFrame:
    """Adds up histograms of separate partitions, months or days."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("grupo", "valor").agg(F.sum("n").alias("n"))


def _build(batches: Iterator, levels: int | None) -> Iterator:
    """Sorted runs of (grupo, valor, n) rows; with `levels` a group is a code, and every prefix of it
    up to that length is a group."""
    import numpy as np
    import pyarrow as pa

    def flush(rows: list):
        t = pa.Table.from_batches(rows).combine_chunks()
        code = t.column("grupo").combine_chunks().dictionary_encode()
        code = code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code
        names = np.array(code.dictionary.to_pylist(), dtype=object)
        at = code.indices.to_numpy(zero_copy_only=False).astype("int64")
        v = t.column("valor").to_numpy().astype("float64") + 0.0  # one zero
        n = t.column("n").to_numpy().astype("int64")
        if levels is not None:
            known: dict[str, int] = {}
            parts = []
            for k in range(1, levels + 1):
                to = np.array([known.setdefault(x[:k], len(known)) if len(x) >= k else -1 for x in names], dtype="int64")[at]
                parts.append((to[to >= 0], v[to >= 0], n[to >= 0]))
            names = np.array(list(known), dtype=object)
            at, v, n = (np.concatenate(x) for x in zip(*parts))
        if not len(at):
            return None
        order = np.lexsort((v, at))
        at, v, n = at[order], v[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (v[1:] != v[:-1])]))
        at, v, n = at[new], v[new], np.add.reduceat(n, new)
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        off = pa.array(np.append(edge, len(at)).astype("int32"))
        total = pa.array(np.add.reduceat(n, edge))
        return pa.RecordBatch.from_arrays([pa.array(names[at[edge]], pa.string()), pa.ListArray.from_arrays(off, pa.array(v)), pa.ListArray.from_arrays(off, pa.array(n)), total], names=["grupo", "valores", "cuentas", "total"])

    rows, size = [], 0
    for batch in batches:
        rows.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            out = flush(rows)
            rows, size = [], 0
            if out is not None:
                yield out
    if size:
        out = flush(rows)
        if out is not None:
            yield out


def _each_run(batch) -> Iterator:
    """(group, sorted values, running count from 0) of the runs of a batch."""
    import numpy as np

    values, counts = batch.column("valores"), batch.column("cuentas")
    flat_v, flat_c = values.values.to_numpy(), counts.values.to_numpy()
    off, coff = values.offsets.to_numpy(), counts.offsets.to_numpy()
    for i, g in enumerate(batch.column("grupo").to_pylist()):
        yield g, flat_v[off[i] : off[i + 1]], np.concatenate([[0], np.cumsum(flat_c[coff[i] : coff[i + 1]])])


def _median(v, c, a: int, d: int) -> float:
    """The weighted median of the values a..d, one of them."""
    import numpy as np

    return float(v[np.searchsorted(c, c[a] + (c[d] - c[a] + 1) // 2, "left") - 1])


def _combined(proposals: list[tuple[float, int]]) -> float | None:
    """The weighted median of a task's proposals, one of them."""
    half, seen = (sum(n for _, n in proposals) + 1) // 2, 0
    for m, n in sorted(proposals):
        seen += n
        if seen >= half:
            return m
    return None


def _first(batches: Iterator) -> Iterator:
    """A task's number of values and proposal for each of its groups."""
    import pyarrow as pa

    got: dict[str, list] = {}
    for batch in batches:
        for g, v, c in _each_run(batch):
            got.setdefault(g, []).append((_median(v, c, 0, len(v)), int(c[-1])))
    rows = [(g, sum(n for _, n in p), _combined(p)) for g, p in got.items()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.float64()))], names=["grupo", "n", "medio"])


def _bounds(v, lo: float | None, hi: float | None) -> tuple[int, int]:
    """Where the open range (lo, hi) lies in sorted values."""
    import numpy as np

    return (0 if lo is None else int(np.searchsorted(v, lo, "right"))), (len(v) if hi is None else int(np.searchsorted(v, hi, "left")))


_STEP = "i long, menos long, igual long, nl long, ml double, nr long, mr double"


def _step(batches: Iterator, shared) -> Iterator:
    """Three-way counts of a task's runs against the pivots, and its proposals for either side."""
    import pyarrow as pa

    state, got = shared.value, {}
    for batch in batches:
        for g, v, c in _each_run(batch):
            for i, lo, hi, pivot in state.get(g, ()):
                a, d = _bounds(v, lo, hi)
                if a >= d:
                    continue
                x, y = a + v[a:d].searchsorted(pivot, "left"), a + v[a:d].searchsorted(pivot, "right")
                s = got.setdefault(i, [0, 0, [], []])
                s[0] += int(c[x] - c[a])
                s[1] += int(c[y] - c[x])
                if x > a:
                    s[2].append((_median(v, c, a, x), int(c[x] - c[a])))
                if d > y:
                    s[3].append((_median(v, c, y, d), int(c[d] - c[y])))
    rows = [(i, le, eq, sum(n for _, n in left), _combined(left), sum(n for _, n in right), _combined(right)) for i, (le, eq, left, right) in got.items()]
    if rows:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["i", "menos", "igual", "nl", "ml", "nr", "mr"])


def _trim(batches: Iterator, shared) -> Iterator:
    """The runs without what no wanted rank can reach any more."""
    import numpy as np
    import pyarrow as pa

    state = shared.value
    for batch in batches:
        groups, values, counts = [], [], []
        for g, v, c in _each_run(batch):
            n = np.diff(c)
            spans = [_bounds(v, lo, hi) for _, lo, hi, _ in state.get(g, ())]
            spans = sorted(s for s in spans if s[0] < s[1])
            if spans:
                groups.append(g)
                values.append(np.concatenate([v[a:d] for a, d in spans]))
                counts.append(np.concatenate([n[a:d] for a, d in spans]))
        if groups:
            off = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype("int32"))
            lists = [pa.ListArray.from_arrays(off, pa.array(np.concatenate(x))) for x in (values, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), *lists, pa.array([int(x.sum()) for x in counts], pa.int64())], names=["grupo", "valores", "cuentas", "total"])


def _rest(batches: Iterator, shared) -> Iterator:
    """The values of the ranges that are short enough to be gathered."""
    import numpy as np
    import pyarrow as pa

    state = shared.value
    for batch in batches:
        ids, values, counts = [], [], []
        for g, v, c in _each_run(batch):
            n = np.diff(c)
            for i, lo, hi, _ in state.get(g, ()):
                a, d = _bounds(v, lo, hi)
                if a < d:
                    ids.append(i)
                    values.append(v[a:d])
                    counts.append(n[a:d])
        if ids:
            off = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype("int32"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.ListArray.from_arrays(off, pa.array(np.concatenate(x))) for x in (values, counts)]], names=["i", "valores", "cuentas"])


def _weighted_median(value: str, weight: str) -> Column:
    """The weighted median of one proposal per task."""
    half = f"cast(floor((sum({weight}) + 1) / 2) as bigint)"
    all_of = f"sort_array(collect_list(case when {weight} > 0 then struct({value} as m, {weight} as w) end))"
    return F.expr(f"aggregate({all_of}, struct(0L as c, cast(null as double) as v), (a, x) -> struct(a.c + x.w as c, if(a.v is null and a.c + x.w >= {half}, x.m, a.v) as v)).v")


def _at_rank(pairs: str, rank: str) -> Column:
    """The value at a 1-based rank of sorted (value, count) pairs."""
    return F.expr(f"aggregate({pairs}, struct(0L as c, cast(null as double) as v), (a, x) -> struct(a.c + x.cuentas as c, if(a.v is null and a.c + x.cuentas >= {rank}, x.valores, a.v) as v)).v")


def _gathered() -> Column:
    return F.expr("sort_array(flatten(collect_list(arrays_zip(valores, cuentas))))")


class _Range:
    """Values strictly between lo and hi (None: open), the first of which has rank `before` + 1."""

    def __init__(self, group, lo, hi, before, n, pivot, ranks):
        self.group, self.lo, self.hi, self.before, self.n, self.pivot, self.ranks = group, lo, hi, before, n, pivot, ranks


def _select(runs: DataFrame, groups: list[tuple]) -> tuple[list[tuple], DataFrame, list[_Range]]:
    """Runs the rounds for (group, total, pivot, ranks) rows: what was found as (group, rank, value),
    the trimmed runs, and the ranges left to be gathered."""
    sc = runs.sparkSession.sparkContext
    found: list[tuple] = []
    open_ = [_Range(g, None, None, 0, n, pivot, sorted(set(ranks))) for g, n, pivot, ranks in groups]
    short: list[_Range] = []
    stored = sum(r.n for r in open_)

    def share(ranges: list[_Range]):
        state: dict = {}
        for i, r in enumerate(ranges):
            state.setdefault(r.group, []).append((i, r.lo, r.hi, r.pivot))
        return sc.broadcast(state)  # an entry per open range of at most BATCH groups

    for _ in range(MOST_ROUNDS):
        if not open_:
            break
        if 2 * sum(r.n for r in open_ + short) <= stored:
            stored = sum(r.n for r in open_ + short)
            runs = runs.mapInArrow(partial(_trim, shared=share(open_ + short)), _RUNS).checkpoint()
        counts = runs.mapInArrow(partial(_step, shared=share(open_)), _STEP).groupBy("i").agg(
            *[F.sum(c).alias(f"s_{c}") for c in ("menos", "igual", "nl", "nr")], _weighted_median("ml", "nl").alias("izq"), _weighted_median("mr", "nr").alias("der")
        )
        nxt: list[_Range] = []
        for row in counts.collect():  # a row per open range of at most BATCH groups
            r = open_[row["i"]]
            low, high = r.before + row["s_menos"], r.before + row["s_menos"] + row["s_igual"]
            found += [(r.group, k, r.pivot) for k in r.ranks if low < k <= high]
            left, right = [k for k in r.ranks if k <= low], [k for k in r.ranks if k > high]
            if left:
                nxt.append(_Range(r.group, r.lo, r.pivot, r.before, row["s_nl"], row["izq"], left))
            if right:
                nxt.append(_Range(r.group, r.pivot, r.hi, high, row["s_nr"], row["der"], right))
        short += [r for r in nxt if r.n <= FINISH]
        open_ = [r for r in nxt if r.n > FINISH]
    if open_:
        raise RuntimeError("the selection did not end")
    return found, runs, short


def multi_select(hist: DataFrame, ranks: dict[str, Column], *, levels: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """(grupo, total, one double column per rank): the values at 1-based ranks of each group.

    hist has rows of `observations`, `histogram` or `merge`, in any number per group and value; ranks
    gives, by name, an expression over the column `total` (the number of values of the group).  With
    levels, groups are codes and every prefix of up to so many characters is a group.  `only` has the
    groups wanted, in a column `grupo`; the others have no row.
    """
    spark = hist.sparkSession
    ensure_checkpoint_dir(spark)
    names = list(ranks)
    runs = hist.mapInArrow(partial(_build, levels=levels), _RUNS).checkpoint()
    totals = runs.mapInArrow(_first, "grupo string, n bigint, medio double").groupBy("grupo").agg(F.sum("n").alias("total"), _weighted_median("medio", "n").alias("medio"))
    if only is not None:
        totals = totals.join(only.select("grupo").where("grupo is not null").distinct(), "grupo", "left_semi")
    wanted = totals.select("grupo", "total", "medio", F.array(*[F.when(r.between(1, F.col("total")), r).cast("long") for r in ranks.values()]).alias("rangos")).checkpoint()

    small = wanted.where(F.col("total") <= FINISH)
    # only runs that are short themselves can belong to a small group
    pairs = runs.where(F.col("total") <= FINISH).drop("total").join(small.select("grupo"), "grupo").groupBy("grupo").agg(_gathered().alias("x"))
    done = small.join(pairs, "grupo").select("grupo", "total", *[_at_rank("x", f"rangos[{k}]").alias(n) for k, n in enumerate(names)])

    big = wanted.where(F.col("total") > FINISH)
    batches = -(-big.count() // BATCH)
    for part in range(batches):
        mine = big.where(F.pmod(F.xxhash64("grupo"), F.lit(batches)) == part)
        groups = [(r["grupo"], r["total"], r["medio"], r["rangos"]) for r in mine.collect()]  # about BATCH rows
        found, left, short = _select(runs, [(g, n, m, [k for k in ks if k is not None]) for g, n, m, ks in groups])
        state: dict = {}
        for i, r in enumerate(short):
            state.setdefault(r.group, []).append((i, r.lo, r.hi, None))
        open_ranks = spark.createDataFrame([(i, r.group, k, k - r.before) for i, r in enumerate(short) for k in r.ranks], "i bigint, grupo string, k bigint, resta bigint")
        rest = left.mapInArrow(partial(_rest, shared=spark.sparkContext.broadcast(state)), "i bigint, valores array<double>, cuentas array<bigint>").groupBy("i").agg(_gathered().alias("x"))
        values = open_ranks.join(rest, "i").select("grupo", "k", _at_rank("x", "resta").alias("v"))
        values = values.unionByName(spark.createDataFrame(found, "grupo string, k bigint, v double"))
        by_rank = values.groupBy("grupo").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m"))
        got = mine.join(by_rank, "grupo", "left").select("grupo", "total", *[F.try_element_at("m", F.col("rangos")[k]).alias(n) for k, n in enumerate(names)])
        done = done.unionByName(got)
    return done

