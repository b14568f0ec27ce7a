"""Vectors in array columns: normalising, nearest representative, merging of near-equal ones.

The representatives are a bounded set (categories); the vectors are not.  Above the checked size the
representatives are taken in blocks, so memory stays bounded and no pair table is ever written.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Representatives held by one pass over the vectors.
BLOCK = 20_000


def normalised(c: Column) -> Column:
    """v / (|v| + 1e-9)."""
    x = F.transform(c, lambda v: v.cast("double"))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)) + F.lit(1e-9)
    return F.transform(x, lambda v: v / norm)


def centroids(df: DataFrame, label: str, vector: str, size: int) -> DataFrame:
    """(label, centro): mean vector per label, added up per component without gathering a group."""
    x = [F.avg(F.get(vector, F.lit(i)).cast("double")).alias(f"c{i}") for i in range(size)]
    return df.where(F.size(vector) == size).groupBy(label).agg(*x).select(label, F.array(*[f"c{i}" for i in range(size)]).alias("centro"))


def nearest(df: DataFrame, reps: DataFrame, *, key: str, vector: str, rep: str, rep_vector: str, least: float = -1.0) -> DataFrame:
    """(key, rep, similitud): the most similar representative of every vector.

    Cosine similarity; ties go to the smallest representative; below `least` there is no row.
    Null vectors and vectors of another length than the representatives' have no row.
    """
    rows = sorted(((r[0], r[1]) for r in reps.select(rep, rep_vector).where(F.col(rep_vector).isNotNull()).collect()), key=lambda r: r[0])
    kinds = f"`{key}` {df.schema[key].dataType.simpleString()}, `{rep}` {reps.schema[rep].dataType.simpleString()}, similitud double"

    def scorer(block: list[tuple]):
        def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import numpy as np

            names = [b[0] for b in block]
            m = np.array([b[1] for b in block], dtype="float64")
            m /= np.linalg.norm(m, axis=1, keepdims=True) + 1e-9
            for f in frames:
                f = f[[v is not None and len(v) == m.shape[1] for v in f["v"]]]
                if len(f):
                    x = np.stack(f["v"].to_numpy()).astype("float64")
                    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
                    s = np.round(x @ m.T, 6)
                    k = s.argmax(axis=1)
                    yield pd.DataFrame({key: f["k"].to_numpy(), rep: [names[i] for i in k], "similitud": s[np.arange(len(f)), k]})

        return score

    d = df.select(F.col(key).alias("k"), F.col(vector).alias("v"))
    parts = [d.mapInPandas(scorer(rows[i : i + BLOCK]), kinds) for i in range(0, len(rows), BLOCK)]
    if not parts:
        return d.limit(0).select(F.col("k").alias(key), F.lit(None).cast(reps.schema[rep].dataType).alias(rep), F.lit(None).cast("double").alias("similitud"))
    best = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            best = best.unionByName(p)
        best = best.groupBy(key).agg(F.min(F.struct(-F.col("similitud"), F.col(rep))).alias("m")).select(key, F.col(f"m.{rep}").alias(rep), (-F.col("m.col1")).alias("similitud"))
    return best.where(F.col("similitud") >= least)


def similarity_histogram(best: DataFrame, cuts: list[float]) -> DataFrame:
    """(corte, n, parte): how many rows of `nearest` reach each cut, and their share (T5)."""
    total = best.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("similitud") >= c).alias(f"n{i}") for i, c in enumerate(cuts)])
    each = F.array(*[F.struct(F.lit(c).alias("corte"), F.col(f"n{i}").alias("n")) for i, c in enumerate(cuts)])
    return total.select("total", F.explode(each).alias("x")).select("x.corte", "x.n", F.try_divide("x.n", "total").alias("parte"))


def merge_labels(reps: DataFrame, *, rep: str, vector: str, weight: str, least: float) -> DataFrame:
    """(rep, grupo): labels whose similarity reaches `least`, joined transitively under the heaviest
    (ties: the smallest label) (T4).  The labels are the bounded set of categories."""
    spark = reps.sparkSession
    rows = reps.select(rep, vector, weight).collect()
    import numpy as np

    m = np.array([r[1] for r in rows], dtype="float64").reshape(len(rows), -1)
    m /= np.linalg.norm(m, axis=1, keepdims=True) + 1e-9
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(m[i + 1 :] @ m[i] >= least) + i + 1:
            a, b = root(i), root(int(j))
            if a != b:
                lead, other = sorted((a, b), key=lambda x: (-(rows[x][2] or 0), rows[x][0]))
                parent[other] = lead
    kind = reps.schema[rep].dataType.simpleString()
    return spark.createDataFrame([(r[0], rows[root(i)][0]) for i, r in enumerate(rows)], f"`{rep}` {kind}, grupo {kind}")
