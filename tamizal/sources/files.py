"""File sources and sinks with declared schemas: CSV, JSON, Parquet by month.

A header that differs from the declared one, or a byte sequence that is not valid in the declared
encoding, stops the load; a value that does not fit its declared type is null.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars
from ..functions.scalars import coerce
from ..functions.text import BROKEN, repair_encoding


class ContractError(ValueError):
    """A delivered file does not have the declared form."""


def read_csv(spark: SparkSession, path: str, columns: list[str], *, sep: str = ",", encoding: str = "UTF-8", exact: bool = True) -> DataFrame:
    """All-text table with exactly the declared header.

    The header is compared on its own, so the check does not depend on the reader's leniency; a byte
    order mark is no part of it.  exact=False takes the columns by place and only skips the header.
    """
    if exact:
        head = spark.read.option("encoding", encoding).option("sep", sep).option("header", False).csv(path).limit(1).first()
        found = [] if head is None else [(x or "").lstrip("﻿").strip() for x in head]
        if found != columns:
            raise ContractError(f"header: missing {sorted(set(columns) - set(found))}, extra {sorted(set(found) - set(columns))}, order {found == columns}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, sep=sep, encoding=encoding, multiLine=True, quote='"', escape='"', enforceSchema=True, mode="PERMISSIVE")


def read_json(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Records of a declared schema, with the file they came from."""
    return spark.read.schema(schema).json(paths, multiLine=True).withColumn("archivo", F.col("_metadata.file_name"))


def normalise_month(spark: SparkSession, folder: str, tables: dict[str, list[str]], present: list[str] | None = None) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables of a month's folder and the warnings of its load (S3).

    tables: the declared header of each table, in the file that starts with its name; `present` names
    further files that have to be there.  A missing file stops the load.  Releases are told apart by
    ocid: the first counts, and the number of others is a warning.  Files keep their order in `orden`.
    """
    names = sorted(os.listdir(folder)) if os.path.isdir(folder) else []
    of = {t: next((n for n in names if n.startswith(f"{t}_")), None) for t in [*tables, *(present or [])]}
    lost = [t for t, n in of.items() if n is None]
    if lost:
        raise ContractError(f"{folder}: no {lost}")
    out, said = {}, []
    for t, columns in tables.items():
        # one file of a month: its row numbers are places in it
        d = read_csv(spark, f"{folder}/{of[t]}", columns).withColumn("orden", F.monotonically_increasing_id())
        if "ocid" in columns and t == "releases":
            rest = [c for c in d.columns if c != "ocid"]
            once = d.groupBy("ocid").agg(F.min(F.struct("orden", *[c for c in rest if c != "orden"])).alias("x"), F.count(F.lit(1)).alias("__n"))
            extra = once.agg(F.sum(F.col("__n") - 1)).first()[0]
            if extra:
                said.append(f"{extra} releases repeat an ocid")
            d = once.select("ocid", *[F.col(f"x.{c}").alias(c) for c in rest]).select(d.columns)
        out[t] = d
    return out, said


def method_coverage(folder: str, methods: list[str]) -> dict[str, str]:
    """State of every method of a month (S4): ok, sin_datos (an empty file says there are none) or
    fallo (no file).  All failed is an error: then nothing can be told about the month."""
    state = {}
    for m in methods:
        path = f"{folder}/{m}.json"
        state[m] = "fallo" if not os.path.exists(path) else "ok" if os.path.getsize(path) else "sin_datos"
    if methods and set(state.values()) == {"fallo"}:
        raise ContractError(f"{folder}: no method could be read")
    return state


def read_methods(spark: SparkSession, folder: str, methods: list[str], schema: T.StructType) -> tuple[DataFrame, dict[str, str]]:
    """The union of the methods' records, and the state of each."""
    state = method_coverage(folder, methods)
    paths = [f"{folder}/{m}.json" for m, s in state.items() if s == "ok"]
    return (read_json(spark, paths, schema) if paths else spark.createDataFrame([], schema).withColumn("archivo", F.lit(None).cast("string"))), state


def read_text_checked(spark: SparkSession, path: str, *, share: float = 0.01, least: int = 20) -> DataFrame:
    """(archivo, texto): whole files as UTF-8, mended where they were decoded twice.

    A file that is not UTF-8 stops the load, and so does one with more than `share` of broken
    fragments among its characters outside ASCII, when there are at least `least` of them.
    """
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("archivo"), F.col("content"))
    d = raw.select("archivo", F.is_valid_utf8("content").alias("bien") if hasattr(F, "is_valid_utf8") else F.lit(True).alias("bien"), F.expr("try_validate_utf8(cast(content as string))").alias("texto"))
    broken = F.regexp_count("texto", F.lit(BROKEN))
    outside = F.length(F.regexp_replace("texto", r"[\x00-\x7f]", ""))
    bad = d.where(F.col("texto").isNull() | ((broken >= least) & (broken > share * outside)))
    first = bad.select("archivo").first()
    if first is not None:
        raise ContractError(f"encoding: {first['archivo']}")
    return d.select("archivo", repair_encoding("texto").alias("texto"))


def declared(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Columns and types as declared (S5): missing ones are null, undeclared ones an error."""
    extra = [c for c in df.columns if c not in schema]
    if extra:
        raise ContractError(f"undeclared columns: {extra}")
    empty: Column = F.lit(None).cast("string")
    return df.select(*[coerce(F.col(c) if c in df.columns else empty, kind).alias(c) for c, kind in schema.items()])


def write_months(df: DataFrame, path: str) -> None:
    """Replaces exactly the months that df holds (S5, S11), one folder per month, zstd.

    Rows are brought together by month and a salt, so a month is a few files and no single task
    writes a hot month alone.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(4))
    spread = df.repartition("anio", "mes", salt)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("anio", "mes").parquet(path)


def gated_window(items: DataFrame, processes: DataFrame, expected: int, share: float = 0.75) -> DataFrame:
    """The lines of a window, if enough of its months are there and none has lines but no process."""
    from ..operators.relational import orphan_months

    gate = coverage_gate(items, expected, share).first()
    lost = [(r["anio"], r["mes"]) for r in orphan_months(items, processes).limit(24).collect()]
    if not gate["bien"] or lost:
        raise ContractError(f"window: {gate['cargados']} of {expected} months, without processes {lost}")
    return items


def read_months(spark: SparkSession, path: str, first: int, last: int, columns: list[str] | None = None) -> DataFrame:
    """The months (yyyymm) of a window: partitions outside it are not listed as input."""
    d = spark.read.parquet(path).where((F.col("anio") * 100 + F.col("mes")).between(first, last))
    return d if columns is None else d.select(*columns)


def read_year(spark: SparkSession, path: str, year: int) -> dict[str, DataFrame]:
    """A year's three tables, projected (S7): procesos (the last row of every ocid), items, and
    ganadores (distinct winners of every ocid)."""
    d = {t: spark.read.parquet(f"{path}/{t}").where((F.col("anio") == year) & F.col("ocid").isNotNull()) for t in ("procesos", "items", "oferentes")}
    last = d["procesos"].groupBy("ocid").agg(F.max(F.struct("mes", "orden", "metodo", "comprador_ruc")).alias("x")).select("ocid", "x.metodo", "x.comprador_ruc")
    items = d["items"].select("ocid", "origen", "cpc", "cantidad", "unidad", "precio_unitario")
    won = d["oferentes"].where("gano and ruc is not null").select("ocid", "ruc").distinct()
    return {"procesos": last, "items": items, "ganadores": won}


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh (S10): the new rows are written aside and take the place of the old ones at once,
    so a load that fails leaves the old table; the table itself may be read to make df."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}.__nuevo")
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, old = hadoop.Path(f"{path}.__nuevo"), hadoop.Path(path)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if not fs.rename(new, old):
        raise OSError(f"{path} could not be replaced")


def refresh(spark: SparkSession, home: str, views: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Snapshots of derived tables, made again in the order given; readers take the stored rows."""
    for name, make in views.items():
        replace_table(make(), f"{home}/{name}")
    return {name: spark.read.parquet(f"{home}/{name}") for name in views}


def upsert(base: DataFrame, part: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last write wins (S12): of the rows of a key, in base or in part, the one latest in `order`."""
    rest = [c for c in base.columns if c not in keys and c != order]
    both = base.unionByName(part).groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("x"))
    return both.select(*keys, *[F.col(f"x.{c}").alias(c) for c in [order, *rest]]).select(base.columns)


def read_tree(spark: SparkSession, path: str, *, most_inherited: int = 5, levels: dict[int, int] | None = None) -> DataFrame:
    """(codigo, nivel, nombre, padre) of a checked tree.

    A node of the fifth level without a name takes its parent's, at most `most_inherited` of them;
    any other fault (length, prefix, repeated code, missing parent, no name, numbers per level other
    than `levels`) stops the load.
    """
    raw = read_csv(spark, path, ["Codigo", "Nivel", "Descripcion", "Codigo_Padre"])
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    d = raw.select(text("Codigo").alias("codigo"), F.col("Nivel").try_cast("int").alias("nivel"), text("Descripcion").alias("nombre"), F.nullif(text("Codigo_Padre"), F.lit("")).alias("padre"))
    over = d.groupBy("codigo").agg(F.max("nombre").alias("__np"), F.count(F.lit(1)).alias("__k"))
    j = d.join(over.select("codigo", "__k"), "codigo").join(over.select(F.col("codigo").alias("__c"), "__np"), F.col("padre") == F.col("__c"), "left")
    blank = F.length("nombre") < 3
    heir = (F.col("nivel") == 5) & blank & (F.length("__np") >= 3)
    below = F.col("nivel") > 1
    faults = {"length": ~F.length("codigo").eqNullSafe(F.col("nivel")), "parent": below & ~F.col("padre").eqNullSafe(F.expr("left(codigo, length(codigo) - 1)")), "missing parent": below & F.col("__c").isNull(), "repeated": F.col("__k") > 1, "name": blank & ~heir}
    seen = j.agg(F.count_if(heir).alias("heirs"), *[F.count_if(c).alias(n) for n, c in faults.items()]).first().asDict()
    bad = {n: v for n, v in seen.items() if v and n != "heirs"}
    if seen["heirs"] > most_inherited:
        bad["inherited names"] = seen["heirs"]
    if levels is not None:
        found = {r["nivel"]: r["count"] for r in d.groupBy("nivel").count().collect()}  # a row per level
        if found != levels:
            bad["levels"] = found
    if bad:
        raise ContractError(f"tree: {bad}")
    return j.select("codigo", "nivel", F.when(heir, F.col("__np")).otherwise(F.col("nombre")).alias("nombre"), "padre")


def read_products(spark: SparkSession, path: str, tree: DataFrame, *, least: int = 1, orphans: float = 0.01) -> DataFrame:
    """(codigo, nombre, umbral, subclase) of a Latin-1 catalogue (S9, D7): the first row of a code
    counts; too few products, or more than a share without a subclass in the tree, stop the load."""
    raw = read_csv(spark, path, ["codigo", "nombre", "umbral"], sep=";", encoding="ISO-8859-1", exact=False)
    d = raw.select(F.trim("codigo").alias("codigo"), F.trim("nombre").alias("nombre"), scalars.percent(F.coalesce("umbral", F.lit(""))).alias("umbral"), F.monotonically_increasing_id().alias("__o")).where("codigo <> ''")
    d = d.groupBy("codigo").agg(F.min(F.struct("__o", "nombre", "umbral")).alias("x")).select("codigo", "x.nombre", "x.umbral")
    d = d.join(tree.where("nivel = 5").select(F.col("codigo").alias("subclase")), F.left("codigo", F.lit(5)) == F.col("subclase"), "left")
    n, lost = d.agg(F.count(F.lit(1)), F.count_if(F.col("subclase").isNull())).first()
    if n < least or lost > orphans * n:
        raise ContractError(f"products: {n}, of which {lost} without a subclass")
    return d


def coverage_gate(df: DataFrame, expected: int, share: float = 0.75) -> DataFrame:
    """One row: months loaded, expected, whether the load may go on (V4)."""
    months = df.select("anio", "mes").distinct().agg(F.count(F.lit(1)).alias("cargados"))
    return months.select("cargados", F.lit(expected).cast("long").alias("esperados"), (F.col("cargados") >= expected * share).alias("bien"))


def add_counts(base: DataFrame, part: DataFrame, keys: list[str], month: str, count: str) -> DataFrame:
    """Per-month contributions, so that loading a month again replaces its share and adds nothing."""
    kept = base.join(part.select(month).distinct(), month, "left_anti")
    return kept.unionByName(part).groupBy(*keys, month).agg(F.sum(count).alias(count))
