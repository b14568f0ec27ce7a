"""What changed between consecutive full snapshots.

EXCEPT ALL both ways removes the rows that are identical in two consecutive deliveries: every row is
counted +1 in its own delivery and -1 as "expected again" in the next one, and a row survives on one
side by as many copies as the counts differ.  Only these residues are full-joined by key to label
additions, removals and changes, so the join sees what changed and not the snapshots.

Defined cases: rows without key (null or blank) or without delivery are ignored, but such rows still
make their delivery exist; of several rows of a key in a delivery the highest sequence counts (ties:
the greatest compared values, so the result is the same in every run); outer blanks never matter;
'' is null; a key that only ever appears in one delivery is added and then removed; empty input and
a single delivery give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANK = r"^[\s\u00a0\ufeff]+|[\s\u00a0\ufeff]+$"


def clean_text(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, BLANK, ""), F.lit(""))


def clean_amount(c: Column, places: int = 2) -> Column:
    """Whole units of 10^-places; NaN is null."""
    return F.when(F.isnan(c), None).otherwise(F.round(c.cast("double"), places) * 10**places).cast("decimal(30,0)")


def latest_rows(df: DataFrame, *, delivery: str, key: str, sequence: str, compare: dict[str, Column]) -> DataFrame:
    """One row per delivery and key, with the compared columns in their comparable form."""
    d = df.select(F.col(delivery).alias("entrega"), clean_text(F.col(key)).alias("clave"), F.col(sequence).alias("__s"), F.struct(*[v.alias(k) for k, v in compare.items()]).alias("__v"))
    d = d.where(F.col("entrega").isNotNull() & F.col("clave").isNotNull())
    best = d.groupBy("entrega", "clave").agg(F.max(F.struct("__s", "__v")).alias("__b"))
    return best.select("entrega", "clave", *[F.col(f"__b.__v.{k}").alias(k) for k in compare])


def residues(latest: DataFrame, next_delivery: DataFrame, columns: list[str]) -> DataFrame:
    """EXCEPT ALL both ways between each delivery and the one before it.

    Columns: entrega, clave, the compared ones, and copias: > 0 for rows only in the later delivery,
    < 0 for rows only in the earlier one.
    """
    # one row per delivery, so it stays tiny however many rows a delivery has
    step = next_delivery
    now = latest.withColumn("signo", F.lit(1))
    joined = latest.join(step, "entrega").where(F.col("siguiente").isNotNull())
    then = joined.drop("entrega").withColumnRenamed("siguiente", "entrega").withColumn("signo", F.lit(-1))
    both = now.unionByName(then.select(now.columns))
    return both.groupBy("entrega", "clave", *columns).agg(F.sum("signo").alias("copias")).where(F.col("copias") != 0)


def snapshot_changes(df: DataFrame, *, delivery: str, key: str, sequence: str, compare: dict[str, Column]) -> DataFrame:
    """(entrega, clave, cambio, plus {column}_antes / {column}_despues of each compared column)."""
    columns = list(compare)
    latest = latest_rows(df, delivery=delivery, key=key, sequence=sequence, compare=compare)
    found = df.select(F.col(delivery).alias("entrega")).where(F.col("entrega").isNotNull()).distinct()
    order = found.withColumn("siguiente", F.lead("entrega").over(Window.orderBy("entrega")))
    res = residues(latest, order, columns)
    first = found.agg(F.min("entrega").alias("primera"))
    res = res.join(F.broadcast(first), F.col("entrega") > F.col("primera"), "left_semi")  # one row
    after = res.where("copias > 0").select("entrega", "clave", *[F.col(c).alias(f"{c}_despues") for c in columns], F.lit(True).alias("__a"))
    before = res.where("copias < 0").select("entrega", "clave", *[F.col(c).alias(f"{c}_antes") for c in columns], F.lit(True).alias("__b"))
    out = before.join(after, ["entrega", "clave"], "full")
    label = F.when(F.col("__b").isNull(), "alta").when(F.col("__a").isNull(), "baja").otherwise("cambio")
    return out.withColumn("cambio", label).drop("__a", "__b")
