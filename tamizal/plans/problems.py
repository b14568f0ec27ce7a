"""The pN_ queries of the general problems, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import late_events, nested, orphans, snapshots, timestamps, units
from ..session import table
from .registry import RELEASES_SQL, json_elements

MAX_LATE_MONTHS = 4


def _with_source(df: DataFrame, fuente: DataFrame) -> DataFrame:
    """Adds the zone and the numeric date order of the row's source (8 fixed rows)."""
    f = fuente.groupBy("fuente_id").agg(F.min("zona").alias("__zona"), F.min("orden_fecha").alias("__orden"))
    return df.join(f, "fuente_id", "left")


def p1_restated(spark: SparkSession, sf: str) -> DataFrame:
    """(anio, mes, comprador_ruc, restado, publicado) for every buyer and month of either side."""
    r = table(spark, sf, "proceso_resumen").select("fila_id", "ocid", "fecha", "anio", "mes", "comprador_ruc", "fuente_id")
    fuente = table(spark, sf, "fuente")
    r = timestamps.normalise_timestamps(_with_source(r, fuente), value="fecha", zone="__zona", order="__orden", with_local=True, intervals=timestamps.zone_intervals(fuente))
    day = F.date_from_unix_date(F.floor(F.col("local_us") / 86_400_000_000).cast("int"))
    events = r.select("fila_id", "ocid", (F.year(day) * 12 + F.month(day) - 1).alias("evento"), (F.col("anio") * 12 + F.col("mes") - 1).alias("llegada"), "comprador_ruc")
    h = table(spark, sf, "hecho_mes").distinct()
    published = h.select((F.col("anio") * 12 + F.col("mes") - 1).alias("evento"), "comprador_ruc", "n_procesos")
    out = late_events.restate(events, published, key="ocid", event="evento", arrival="llegada", order="fila_id", group="comprador_ruc", count="n_procesos", max_late=MAX_LATE_MONTHS)
    return out.select(F.floor(F.col("evento") / 12).cast("int").alias("anio"), (F.col("evento") % 12 + 1).cast("int").alias("mes"), "comprador_ruc", "restado", "publicado")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    d = p1_restated(spark, sf).where(F.col("comprador_ruc").isNotNull() & F.col("anio").isNotNull())
    return d.where("restado <> publicado").select("anio", "mes", "comprador_ruc", (F.col("restado") - F.col("publicado")).cast("int").alias("n_cambio"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return nested.flatten_children(table(spark, sf, "detalle_mes"), row="reg_id", text="registro")


def _compared() -> dict[str, Column]:
    return {
        "estado": F.lower(snapshots.clean_text(F.col("estado"))),
        "proveedor_ruc": snapshots.clean_text(F.col("proveedor_ruc")),
        "referencial": snapshots.clean_amount(F.col("referencial")),
        "adjudicado": snapshots.clean_amount(F.col("adjudicado")),
    }


def p3_changes(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "proceso_foto").select("foto", "secuencia", "ocid", "estado", "proveedor_ruc", "referencial", "adjudicado")
    return snapshots.snapshot_changes(d, delivery="foto", key="ocid", sequence="secuencia", compare=_compared())


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_changes(spark, sf).select(F.col("entrega").alias("foto"), F.col("clave").alias("ocid"), "cambio")


def _references(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    r = table(spark, sf, "proceso_resumen").select("fila_id", "anio", "mes", "cpc_nodo", "proveedor_ruc", "categoria_id")
    refs = orphans.references(
        r,
        row="fila_id",
        period=F.col("anio") * 100 + F.col("mes"),
        fields={"cpc_nodo": snapshots.clean_text(F.col("cpc_nodo")), "proveedor_ruc": orphans.tax_id_key(F.col("proveedor_ruc")), "categoria_id": F.col("categoria_id").cast("string")},
    )
    parent = orphans.parents(
        {
            "cpc_nodo": (table(spark, sf, "cpc_nivel"), snapshots.clean_text(F.col("codigo"))),
            "proveedor_ruc": (table(spark, sf, "entidad"), orphans.tax_id_key(F.col("ruc"))),
            "categoria_id": (table(spark, sf, "categoria"), F.col("categoria_id").cast("string")),
        }
    )
    return refs, parent


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    refs, parent = _references(spark, sf)
    return orphans.orphan_rows(refs, parent).select(F.col("fila").alias("fila_id"), "campo", "clase")


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphans.orphan_report(*_references(spark, sf))


def p6_instants(spark: SparkSession, sf: str) -> DataFrame:
    """(fila_id, campo, valor, instante_us, lectura) for every value of the three columns."""
    r = table(spark, sf, "proceso_resumen").select("fila_id", "fecha", "publicado", "cierra", "fuente_id")
    pairs = F.array(*[F.struct(F.lit(c).alias("campo"), F.col(c).alias("valor")) for c in ("fecha", "publicado", "cierra")])
    fuente = table(spark, sf, "fuente")
    long = _with_source(r, fuente).select("fila_id", "__zona", "__orden", F.explode(pairs).alias("x")).select("fila_id", "__zona", "__orden", "x.campo", "x.valor").where("valor is not null")
    out = timestamps.normalise_timestamps(long, value="valor", zone="__zona", order="__orden", intervals=timestamps.zone_intervals(fuente))
    return out.select("fila_id", "campo", "valor", "instante_us", "lectura")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    form = F.when(F.col("campo") == "fecha", F.col("valor").rlike(r"^\d{4}-\d{2}-\d{2}\z")).otherwise(F.col("valor").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}-05:00\z"))
    return p6_instants(spark, sf).where(F.col("instante_us").isNotNull() & ~form).select("fila_id", "campo", "instante_us")


def p7_converted(spark: SparkSession, sf: str) -> DataFrame:
    """Every measured line with its unit, in base units."""
    i = table(spark, sf, "proceso_item").select("item_fila", "unidad", "descripcion", "cantidad", "precio_unitario").where("cantidad > 0 and precio_unitario > 0")
    out = units.convert(i, table(spark, sf, "unidad_conv"), unit="unidad", description="descripcion", quantity="cantidad", price="precio_unitario")
    return out.select("item_fila", "unidad", "unidad_base", "cantidad_milesimas", "precio_diezmilesimas")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    bases = table(spark, sf, "unidad_conv").select(F.col("unidad_base").alias("unidad")).where("unidad is not null").distinct()
    return p7_converted(spark, sf).join(bases, "unidad", "left_anti").select("item_fila", "unidad_base", "cantidad_milesimas", "precio_diezmilesimas")


QUERIES = {
    "p2_found": p2_found,
    "p7_found": p7_found,
    "p7_converted": p7_converted,
    "p1_found": p1_found,
    "p1_restated": p1_restated,
    "p3_found": p3_found,
    "p3_changes": p3_changes,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p6_found": p6_found,
    "p6_instants": p6_instants,
}

_FOTO = """f as (select foto, trim(ocid) ocid, secuencia, lower(nullif(trim(estado), '')) estado, nullif(trim(proveedor_ruc), '') proveedor_ruc, cast(referencial as decimal(18,2)) referencial, cast(adjudicado as decimal(18,2)) adjudicado from proceso_foto where nullif(trim(ocid), '') is not null), u as (select * from (select *, row_number() over (partition by foto, ocid order by secuencia desc) r from f) where r = 1), d as (select foto, lead(foto) over (order by foto) siguiente from (select distinct foto from proceso_foto where foto is not null)), antes as (select siguiente foto, u.* exclude (foto) from u join d using (foto) where siguiente is not null), ahora as (select * from u where foto > (select min(foto) from d))"""
_REFS = """r as (select fila_id, 'cpc_nodo' campo, nullif(trim(cpc_nodo), '') clave, anio * 100 + mes periodo from proceso_resumen union all select fila_id, 'proveedor_ruc', nullif(regexp_replace(trim(proveedor_ruc), '^EC-RUC-\\s*(\\d+)\\s*(?:-\\d+)?$', '\\1', 'i'), ''), anio * 100 + mes from proceso_resumen union all select fila_id, 'categoria_id', categoria_id::varchar, anio * 100 + mes from proceso_resumen), p as (select 'cpc_nodo' campo, codigo clave, alta, baja from cpc_nivel union all select 'proveedor_ruc', trim(ruc), alta, baja from entidad union all select 'categoria_id', categoria_id::varchar, alta, baja from categoria), g as (select campo, clave, min(baja) baja from p group by all), h as (select r.*, case when g.clave is null then 'ausente' when g.baja <= periodo then 'borrado' else 'posterior' end clase from r left join g using (campo, clave) where r.clave is not null and not exists (select 1 from p where p.campo = r.campo and p.clave = r.clave and (alta is null or alta <= periodo) and (p.baja is null or periodo < p.baja)))"""
_CHILD = """select {name!r} tabla, reg_id, ocid, 'tender' padre, i pos, case json_type(o, '$.id') when 'NULL' then '' else coalesce(o ->> '$.id', '') end hijo_id from (select reg_id, ocid, unnest(range(len(l)))::int i, l[i + 1] o from (select reg_id, ocid, {elements} l from rel)) where json_type(o) = 'OBJECT'"""
_CHILDREN = " union all ".join(_CHILD.format(name=name, elements=json_elements(f"(r -> '$.tender.{field}')")) for name, field in nested.TENDER_CHILDREN.items() if name != "oferentes")
_BIDDERS = f"""select tabla, reg_id, ocid, padre, pos, regexp_extract(regexp_replace(hijo_id, '[0-9]{{14,}}', '', 'g'), '[0-9]{{10,13}}') hijo_id from ({_CHILD.format(name="oferentes", elements=json_elements("(r -> '$.tender.tenderers')"))})"""
_AWARDED = f"""select 'items' tabla, reg_id, ocid, padre, i pos, coalesce(o ->> '$.id', '') hijo_id from (select reg_id, ocid, padre, unnest(range(len(l)))::int i, l[i + 1] o from (select reg_id, ocid, coalesce(a ->> '$.id', '') padre, {json_elements("(a -> '$.items')")} l from (select reg_id, ocid, unnest({json_elements("(r -> '$.awards')")}) a from rel))) where json_type(o) = 'OBJECT'"""
SQL: dict[str, str] = {
    "p2_found": f"""with {RELEASES_SQL} select distinct * from ({_CHILDREN} union all {_BIDDERS} union all {_AWARDED})""",
    "p3_changes": f"""with {_FOTO} select foto entrega, ocid clave, case when a.secuencia is null then 'alta' when b.secuencia is null then 'baja' else 'cambio' end cambio, a.estado estado_antes, b.estado estado_despues, a.proveedor_ruc proveedor_ruc_antes, b.proveedor_ruc proveedor_ruc_despues, cast(a.referencial * 100 as bigint) referencial_antes, cast(b.referencial * 100 as bigint) referencial_despues, cast(a.adjudicado * 100 as bigint) adjudicado_antes, cast(b.adjudicado * 100 as bigint) adjudicado_despues from antes a full join ahora b using (foto, ocid) where a.secuencia is null or b.secuencia is null or a.estado is distinct from b.estado or a.proveedor_ruc is distinct from b.proveedor_ruc or a.referencial is distinct from b.referencial or a.adjudicado is distinct from b.adjudicado""",
    "p3_found": f"""with {_FOTO} select foto, ocid, case when a.secuencia is null then 'alta' when b.secuencia is null then 'baja' else 'cambio' end cambio from antes a full join ahora b using (foto, ocid) where a.secuencia is null or b.secuencia is null or a.estado is distinct from b.estado or a.proveedor_ruc is distinct from b.proveedor_ruc or a.referencial is distinct from b.referencial or a.adjudicado is distinct from b.adjudicado""",
    "p4_found": f"""with {_REFS} select fila_id, campo, clase from h""",
    "p4_report": f"""with {_REFS} select campo, periodo, count(*) n_referencias, count(clase) n_huerfanas, count(*) filter (clase = 'ausente') ausente, count(*) filter (clase = 'borrado') borrado, count(*) filter (clase = 'posterior') posterior from (select r.*, h.clase from r left join h using (fila_id, campo) where r.clave is not null) group by campo, periodo""",
}
