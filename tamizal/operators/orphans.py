"""References to records that do not exist, per field and period.

The distinct non-null references of a period are left-anti-joined to the parents that are valid in
it; only the orphans that remain are classified and joined back to the referring rows for per-row
results and counts.  Taking distinct references first (with map-side partial aggregation) removes
the skew of hot keys before anything is shuffled by key; the join back is salted, because one
missing key may be referred to by a third of all rows.

Defined cases: null and blank references are no references; a parent key that occurs in several rows
is valid when any of them is; repeated parent rows change nothing; null parent keys never match; an
empty parent table makes every reference an orphan of class ausente; rows with a null period have
no period in which a parent could be valid, so their references are orphans of class ausente or
posterior.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .snapshots import clean_text


def tax_id_key(c: Column) -> Column:
    """A tax id without outer blanks and without the source's wrapping (any case)."""
    t = clean_text(c)
    return F.nullif(F.regexp_replace(t, r"(?i)^EC-RUC-\s*(\d+)\s*(?:-\d+)?$", "$1"), F.lit(""))


def references(df: DataFrame, *, row: str, period: Column, fields: dict[str, Column]) -> DataFrame:
    """Long form of the references: (fila, campo, clave, periodo)."""
    pairs = F.array(*[F.struct(F.lit(n).alias("campo"), k.cast("string").alias("clave")) for n, k in fields.items()])
    long = df.select(F.col(row).alias("fila"), period.cast("int").alias("periodo"), F.explode(pairs).alias("r"))
    return long.select("fila", "r.campo", "r.clave", "periodo").where(F.col("clave").isNotNull() & (F.col("clave") != ""))


def parents(tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Long form of the parents: (campo, clave, alta, baja) without repeats."""
    each = [t.select(F.lit(n).alias("campo"), k.cast("string").alias("clave"), F.col("alta").cast("int").alias("alta"), F.col("baja").cast("int").alias("baja")) for n, (t, k) in tables.items()]
    return reduce(DataFrame.unionByName, each).where(F.col("clave").isNotNull()).distinct()


def orphan_keys(refs: DataFrame, parent: DataFrame) -> DataFrame:
    """(campo, clave, periodo, clase): the distinct references without a valid parent."""
    keys = refs.select("campo", "clave", "periodo").distinct()
    p = parent.alias("p")
    valid = (F.col("p.alta").isNull() | (F.col("p.alta") <= F.col("k.periodo"))) & (F.col("p.baja").isNull() | (F.col("k.periodo") < F.col("p.baja")))
    same = (F.col("k.campo") == F.col("p.campo")) & (F.col("k.clave") == F.col("p.clave"))
    lost = keys.alias("k").join(p, same & valid, "left_anti")
    known = parent.groupBy("campo", "clave").agg(F.min("baja").alias("primera_baja"), F.lit(True).alias("existe"))
    out = lost.join(known, ["campo", "clave"], "left")
    clase = F.when(F.col("existe").isNull(), "ausente").when(F.col("primera_baja") <= F.col("periodo"), "borrado").otherwise("posterior")
    return out.select("campo", "clave", "periodo", clase.alias("clase"))


def orphan_rows(refs: DataFrame, parent: DataFrame, *, salts: int = 8) -> DataFrame:
    """(fila, campo, clave, periodo, clase) for every reference to a missing parent."""
    lost = orphan_keys(refs, parent).withColumn("sal", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = refs.withColumn("sal", F.pmod(F.xxhash64("fila"), F.lit(salts)).cast("int"))
    match = salted["campo"].eqNullSafe(lost["campo"]) & (salted["clave"] == lost["clave"]) & salted["periodo"].eqNullSafe(lost["periodo"]) & (salted["sal"] == lost["sal"])
    return salted.join(lost, match).select("fila", salted["campo"], salted["clave"], salted["periodo"], "clase")


def orphan_report(refs: DataFrame, parent: DataFrame) -> DataFrame:
    """(campo, periodo, n_referencias, n_huerfanas, ausente, borrado, posterior), counted on distinct
    references weighted by their rows, so no row is shuffled twice."""
    weights = refs.groupBy("campo", "clave", "periodo").agg(F.count(F.lit(1)).alias("n"))
    lost = orphan_keys(refs, parent)
    match = weights["campo"].eqNullSafe(lost["campo"]) & (weights["clave"] == lost["clave"]) & weights["periodo"].eqNullSafe(lost["periodo"])
    j = weights.join(lost, match, "left").select(weights["campo"], weights["periodo"], "n", "clase")
    count = lambda c: F.sum(F.when(F.col("clase") == c, F.col("n")).otherwise(0)).alias(c)
    return j.groupBy("campo", "periodo").agg(F.sum("n").alias("n_referencias"), F.sum(F.when(F.col("clase").isNotNull(), F.col("n")).otherwise(0)).alias("n_huerfanas"), count("ausente"), count("borrado"), count("posterior"))
