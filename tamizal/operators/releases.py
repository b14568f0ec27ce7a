"""Release records -> the seven flat tables, and the summary row of every process.

A record's children stay text until the table that needs them parses just its own fields, so changing
shapes and types never break a read: a field of another shape is null.  Everything is a JVM
expression followed by one explode; no shuffle.  `nested.flatten_children` gives the ids alone.

Defined cases: records that are not valid JSON as a whole, and releases without ocid, give nothing;
null elements and elements that are no objects are left out; amounts that are no numbers are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from . import relational as rel
from .nested import STRICT, _elements

FIELDS = ["ocid", "date", "tag", "buyer", "planning", "tender", "awards", "auctions", "parties"]
KEYS = ["reg_id", "pos", "ocid"]


def release_rows(df: DataFrame, *, row: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """(reg_id, pos, keep..., FIELDS as text): one row per release of every readable record."""
    shape = ", ".join(f"{f} string" for f in FIELDS)
    d = df.select(F.col(row).cast("long").alias("reg_id"), *(keep or []), F.col(text).alias("__t"))
    d = d.withColumn("__p", F.from_json("__t", f"releases string, {shape}, __bad string", STRICT))
    d = d.where(F.col("__p.__bad").isNull() & (F.json_array_length(F.concat(F.lit("["), F.col("__t"), F.lit("]"))) == 1))
    own = F.array(F.struct(*[F.col(f"__p.{f}").alias(f) for f in FIELDS]))
    inner = F.transform(_elements(F.col("__p.releases")), lambda r: F.from_json(r, shape))
    d = d.select("reg_id", *(keep or []), F.posexplode(F.when(F.col("__p.releases").isNotNull(), inner).otherwise(own)).alias("pos", "r"))
    return d.select("reg_id", "pos", *(keep or []), "r.*").where("ocid <> ''")


def _field(text: str, path: str) -> Column:
    return F.get_json_object(text, f"$.{path}")


def _objects(text: Column) -> Column:
    """The elements of a list that are objects."""
    return F.filter(_elements(text), lambda x: F.trim(x).startswith("{"))


def _inner(elements: Column, field: str) -> Column:
    """The objects in a list field of each element, as one list."""
    return F.flatten(F.transform(elements, lambda x: F.coalesce(_objects(F.get_json_object(x, f"$.{field}")), F.array().cast("array<string>"))))


def _rows(d: DataFrame, objects: Column, shape: str) -> DataFrame:
    return d.select(*KEYS, F.explode(objects).alias("__x")).withColumn("x", F.from_json("__x", shape))


def _short(c: Column, size: int) -> Column:
    """The first characters; '' is null."""
    return F.nullif(F.left(c, F.lit(size)), F.lit(""))


def processes(d: DataFrame) -> DataFrame:
    amount = scalars.or_zero_falls(scalars.number(_field("tender", "value.amount")), scalars.number(_field("planning", "budget.amount.amount")))
    return d.select(
        *KEYS, scalars.tag_state(F.col("tag")).alias("estado"), scalars.before(_field("tender", "procurementMethodDetails"), " en el convenio").alias("metodo"),
        _field("tender", "title").alias("titulo"), _field("tender", "description").alias("objeto"), amount.alias("referencial"),
        scalars.number(_field("tender", "numberOfTenderers")).cast("bigint").alias("n_oferentes"), _field("tender", "mainProcurementCategory").alias("categoria_ocds"),
        _field("tender", "awardCriteria").alias("criterio"), _field("planning", "budget.id").alias("partida"), _field("planning", "rationale").alias("justificacion"),
        scalars.tax_id(_field("buyer", "id")).alias("comprador_ruc"), F.left(F.coalesce("date", F.lit("")), F.lit(10)).alias("fecha"),
    )


def items(d: DataFrame) -> DataFrame:
    """Lines of the tender and of every award; `precio_unitario` is the amount as delivered."""
    none = F.array().cast("array<string>")
    mark = lambda o: lambda x: F.struct(F.lit(o).alias("origen"), x.alias("t"))
    both = F.concat(F.transform(F.coalesce(_objects(_field("tender", "items")), none), mark("tender")), F.transform(F.coalesce(_inner(_objects(F.col("awards")), "items"), none), mark("award")))
    shape = "id string, quantity string, description string, unit struct<name:string,value:struct<amount:string,currency:string>>, classification struct<id:string>"
    x = d.select(*KEYS, F.explode(both).alias("e")).select(*KEYS, "e.origen", F.from_json("e.t", shape).alias("x"))
    return x.select(
        *KEYS, "origen", F.col("x.id").alias("item_id"), F.col("x.classification.id").alias("cpc"), F.col("x.description").alias("descripcion"), scalars.number(F.col("x.quantity")).alias("cantidad"),
        F.col("x.unit.name").alias("unidad"), scalars.number(F.col("x.unit.value.amount")).alias("precio_unitario"), F.col("x.unit.value.currency").alias("moneda"),
    )


def bidders(d: DataFrame) -> DataFrame:
    """All tenderers, and whether an award of the release names them."""
    won = F.transform(_inner(_objects(F.col("awards")), "suppliers"), lambda s: scalars.tax_id(F.get_json_object(s, "$.id")))
    x = d.select(*KEYS, F.coalesce(won, F.array().cast("array<string>")).alias("w"), F.explode(_objects(_field("tender", "tenderers"))).alias("t"))
    x = x.select(*KEYS, "w", scalars.tax_id(_field("t", "id")).alias("ruc"), _field("t", "name").alias("nombre"))
    return x.select(*KEYS, "ruc", "nombre", F.coalesce(F.array_contains("w", F.col("ruc")), F.lit(False)).alias("gano"))


def bids(d: DataFrame) -> DataFrame:
    """Bids of the stages of every auction, under their first tenderer."""
    x = d.select(*KEYS, F.explode(_inner(F.transform(_inner(_objects(F.col("auctions")), "stages"), lambda s: s), "bids")).alias("b"))
    first = F.get(_objects(_field("b", "tenderers")), F.lit(0))
    return x.withColumn("f", first).select(*KEYS, _field("b", "id").alias("puja_id"), scalars.tax_id(_field("f", "id")).alias("ruc"), F.left(_field("b", "date"), F.lit(19)).alias("fecha"), scalars.number(_field("b", "value.amount")).alias("valor"))


def parties(d: DataFrame) -> DataFrame:
    x = d.select(*KEYS, F.explode(_objects(F.col("parties"))).alias("p"))
    x = x.select(*KEYS, scalars.tax_id(_field("p", "id")).alias("ruc"), _field("p", "name").alias("nombre"), F.array_join(F.from_json(_field("p", "roles"), "array<string>"), ",").alias("roles"), _field("p", "address.region").alias("provincia"), _field("p", "address.locality").alias("canton"), _field("p", "contactPoint.url").alias("web"))
    return x.where("ruc is not null")


def enquiries(d: DataFrame) -> DataFrame:
    x = _rows(d, _objects(_field("tender", "enquiries")), "id string, date string, author struct<id:string,name:string>, description string, answer string, dateAnswered string")
    return x.select(
        *KEYS, F.col("x.id").alias("consulta_id"), F.left("x.date", F.lit(19)).alias("fecha"), scalars.tax_id(F.col("x.author.id")).alias("autor_ruc"), F.col("x.author.name").alias("autor"),
        _short(F.col("x.description"), 2000).alias("pregunta"), _short(F.col("x.answer"), 2000).alias("respuesta"), _short(F.col("x.dateAnswered"), 19).alias("fecha_respuesta"),
    )


def lots(d: DataFrame) -> DataFrame:
    """Lots; the techniques of a lot are the names of an object's fields, in order."""
    x = _rows(d, _objects(_field("tender", "lots")), "id string, title string, value struct<amount:string>, techniques string")
    names = F.when(F.trim("x.techniques").startswith("{"), F.array_join(F.array_sort(F.json_object_keys("x.techniques")), ","))
    return x.select(*KEYS, F.col("x.id").alias("lote_id"), F.col("x.title").alias("titulo"), scalars.number(F.col("x.value.amount")).alias("monto"), names.alias("tecnicas"))


def summary_rows(releases: DataFrame, tender: DataFrame, planning: DataFrame, awards: DataFrame, suppliers: DataFrame, keys: list[str]) -> DataFrame:
    """One row per process of a file from its normalised tables.

    Every table has the keys and `orden` (its place in the file); releases: fecha, tag, buyer_id;
    tender: procurementMethodDetails, value_amount, title, description, numberOfTenderers; planning:
    budget_amount, rationale; awards: amount; suppliers: id.  Of several releases the first counts, of
    tenders the last, of budgets, reasons and suppliers the first valid one; award amounts are added
    up; rows without a readable date are left out; each side is one row per key before the joins.
    """
    r = rel.first_by(releases, keys, ["orden"]).withColumn("dia", scalars.day(F.col("fecha"))).where("dia is not null")
    t = rel.last_by(tender, keys, ["orden"]).drop("orden")
    first = lambda c, ok: F.min(F.when(ok, F.struct("orden", c.alias("v"))))["v"]
    budget, reason = scalars.number(F.col("budget_amount")), F.trim("rationale")
    p = planning.groupBy(*keys).agg(first(budget, budget.isNotNull()).alias("presupuesto"), first(reason, reason != "").alias("razon"))
    a = awards.groupBy(*keys).agg(F.sum(scalars.number(F.col("amount")).cast("decimal(18,4)")).cast("double").alias("adjudicado"))
    ruc = scalars.tax_id(F.col("id"))
    s = suppliers.groupBy(*keys).agg(first(ruc, ruc.isNotNull()).alias("proveedor_ruc"))
    d = r.join(t, keys, "left").join(p, keys, "left").join(a, keys, "left").join(s, keys, "left")
    text = F.coalesce(F.nullif("description", F.lit("")), "razon", F.nullif("title", F.lit("")))
    return d.select(
        *keys, F.col("dia").alias("fecha"), scalars.tag_state(F.col("tag")).alias("estado"), scalars.before(F.col("procurementMethodDetails"), " en el convenio").alias("metodo"), scalars.tax_id(F.col("buyer_id")).alias("comprador_ruc"),
        "proveedor_ruc", scalars.or_zero_falls(scalars.number(F.col("value_amount")), F.col("presupuesto")).alias("referencial"), "adjudicado", F.left(text, F.lit(200)).alias("objeto"), scalars.number(F.col("numberOfTenderers")).cast("int").alias("n_oferentes"),
    )
