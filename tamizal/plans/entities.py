"""Entities, their cards and their identifiers, each query with the SQL that defines it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars, text
from ..operators import relational as rel
from ..session import table
from .catalogue import g02_entity_year
from .market import BANDS, CUTOFF, LAST_BAND
from .registry import QUERIES, SQL, dec, money, query, tax_id_sql

__all__ = ["QUERIES", "SQL"]

#: The year that is still running: figures of a single year come from the one before.
CURRENT = 2025
_SUPPLIER = tax_id_sql("proveedor_ruc")
_BAND = "case " + " ".join(f"when {{c}} < {edge:.0f} then '{name}'" for edge, name in BANDS) + f" else '{LAST_BAND}' end"


@query(f"""select fila_id, {_SUPPLIER} ruc from proceso_resumen""")
def f05_tax_ids(spark, sf):
    return table(spark, sf, "proceso_resumen").select("fila_id", scalars.tax_id(F.col("proveedor_ruc")).alias("ruc"))


@query(f"""select ocid, ruc from (select ocid, {_SUPPLIER} ruc, row_number() over (partition by ocid order by anio, mes, fila_id) r from proceso_resumen where {_SUPPLIER} is not null) where r = 1""")
def d03_first_valid_supplier(spark, sf):
    d = table(spark, sf, "proceso_resumen").select("ocid", "anio", "mes", "fila_id", scalars.tax_id(F.col("proveedor_ruc")).alias("ruc"))
    return rel.first_by(d, ["ocid"], ["anio", "mes", "fila_id"], where=F.col("ruc").isNotNull()).select("ocid", "ruc")


@query("""select distinct ruc, regexp_matches(ruc, '^[0-9]+$') and length(ruc) >= 3 and substr(ruc, 3, 1) < '6' es_natural, regexp_matches(ruc, '^[0-9]+$') and substr(ruc, 3, 1) = '6' es_publica from entidad where ruc is not null""")
def f06_kinds(spark, sf):
    d = table(spark, sf, "entidad").where("ruc is not null").select("ruc").distinct()
    return d.select("ruc", scalars.is_natural(F.col("ruc")).alias("es_natural"), scalars.is_public(F.col("ruc")).alias("es_publica"))


_PROVINCE = "case left({c}, 2) " + " ".join(f"when '{k}' then '{v}'" for k, v in scalars.PROVINCES.items()) + " end"


@query(f"""select distinct ruc, {_PROVINCE.format(c='ruc')} provincia from (select comprador_ruc ruc from hecho_mes union all select proveedor_ruc from hecho_mes) where ruc is not null""")
def f07_provinces(spark, sf):
    h = table(spark, sf, "hecho_mes")
    d = h.select(F.explode(F.array("comprador_ruc", "proveedor_ruc")).alias("ruc")).where("ruc is not null").distinct()
    return d.select("ruc", scalars.province(F.col("ruc")).alias("provincia"))


@query("""select item_fila, case when regexp_matches(trim(item_id), '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') then try_cast(trim(item_id) as double) end numero from proceso_item""")
def f01_numbers(spark, sf):
    return table(spark, sf, "proceso_item").select("item_fila", scalars.number(F.col("item_id")).alias("numero"))


@query("""select fila_id, nullif(trim(split_part(metodo, ' en el convenio', 1)), '') base, nullif(trim(split_part(metodo, ' - ', 1)), '') corto from proceso_resumen""")
def f03_method_base(spark, sf):
    r = table(spark, sf, "proceso_resumen")
    return r.select("fila_id", scalars.before(F.col("metodo"), " en el convenio").alias("base"), scalars.before(F.col("metodo"), " - ").alias("corto"))


@query("""select item_fila, try_cast(item_id as bigint) entero, monto_linea is not null con_monto, cast(mes as varchar) texto from proceso_item where regexp_matches(item_id, '^[0-9]+$') or not regexp_matches(item_id, '[0-9]$')""")
def f12_coerced(spark, sf):
    """Declared types; what does not fit is null."""
    i = table(spark, sf, "proceso_item").where(F.col("item_id").rlike("^[0-9]+$") | ~F.col("item_id").rlike("[0-9]$"))
    return i.select("item_fila", scalars.coerce(F.col("item_id"), "entero").alias("entero"), F.col("monto_linea").isNotNull().alias("con_monto"), scalars.coerce(F.col("mes"), "texto").alias("texto"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(l_discount, 4) parte from lineitem where l_discount is not null""")
def f13_percent_texts(spark, sf):
    """Shares written as text ('4,00%') and read again."""
    written = F.concat(F.regexp_replace(F.format_string("%.2f", F.col("l_discount") * 100), r"\.", ","), F.lit("%"))
    return table(spark, sf, "lineitem").where("l_discount is not null").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", scalars.percent(written).alias("parte"))


@query("""select fila_id, case when length(t) >= 8 then left(t, 300) else '' end comparable from (select fila_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(objeto, '(?i)^\\s*orden de compra para adquirir los siguientes productos:?\\s*', ''), '[A-Z]{2,}[A-Z0-9]*-[A-Z0-9-]{4,}', ' ', 'g'), '\\s+', ' ', 'g'))) t from proceso_resumen)""")
def f16_comparable_text(spark, sf):
    return table(spark, sf, "proceso_resumen").select("fila_id", text.comparable(F.col("objeto")).alias("comparable"))


@query("""select distinct nombre, length(trim(nombre)) between 3 and 48 and len(string_split_regex(trim(nombre), '\\s+')) <= 5 and not regexp_matches(trim(nombre), '(?i)(:|\\bes m[aá]s\\b|\\bes un\\b|\\bcategor[ií]a\\b|\\bnombre\\b|\\bser[ií]a\\b|\\bcreo\\b|\\bpodr[ií]a\\b|\\bmejor\\b|^\\W|\\bno,)') and regexp_matches(trim(nombre), '^\\p{Lu}') and not regexp_matches(nombre, '\\d') bien from categoria where nombre is not null""")
def f18_valid_names(spark, sf):
    return table(spark, sf, "categoria").where("nombre is not null").select("nombre", text.is_short_name(F.col("nombre")).alias("bien")).distinct()


@query("""select fila_id, case when adjudicado is null then 'no declarado' when adjudicado >= 1e6 then '$' || replace(format('{:,.1f}', adjudicado / 1e6), ',', '.') || ' M' when adjudicado >= 1e3 then '$' || replace(format('{:,.0f}', adjudicado / 1e3), ',', '.') || ' K' else '$' || replace(format('{:,.0f}', adjudicado), ',', '.') end texto from proceso_resumen""")
def f21_amount_texts(spark, sf):
    return table(spark, sf, "proceso_resumen").select("fila_id", scalars.short_amount(F.col("adjudicado")).alias("texto"))


@query("""with d as (select doc_id, text, list_count(list_filter(string_split_regex(text, '\\r\\n|\\r|\\n'), lambda x: regexp_matches(x, '[ÂÃ][\\x{80}-¿]+'))) malas, len(string_split_regex(text, '\\r\\n|\\r|\\n')) lineas from documents where text is not null) select doc_id, round(malas / lineas, 6) parte from d where malas > 0""")
def f23_broken_lines(spark, sf):
    """Share of lines with a broken fragment."""
    d = table(spark, sf, "documents").where("text is not null").select("doc_id", F.round(text.broken_lines(F.col("text")), 6).alias("parte"))
    return d.where("parte > 0")


@query("""with c as (select unnest(regexp_extract_all(text, '[^\\x00-\\x7f]')) letra from documents) select letra, count(*) n from c group by letra order by n desc, letra limit 8""")
def f23_outside_ascii(spark, sf):
    """The eight most frequent characters outside ASCII."""
    c = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"[^\x00-\x7f]"), F.lit(0))).alias("letra"))
    return rel.top_k(c.groupBy("letra").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.asc("letra")], 8)


# Entities


_EY = """h as (select distinct * from hecho_mes), ex as (select comprador_ruc ruc, anio, 'comprador' rol, proveedor_ruc otro, n_procesos, adjudicado from h where comprador_ruc is not null union all select proveedor_ruc, anio, 'proveedor', comprador_ruc, n_procesos, adjudicado from h where proveedor_ruc is not null), ey as (select ruc, anio, rol, sum(cast(adjudicado as decimal(18,4))) m, cast(sum(n_procesos) as bigint) n, count(distinct otro) c from ex group by ruc, anio, rol)"""
_NAMES = """no as (select ruc, nombre from (select ruc, nombre, row_number() over (partition by ruc order by count(*) desc, nombre) r from entidad where ruc is not null and nombre is not null group by ruc, nombre) where r = 1)"""
_G5 = f"""{_EY}, {_NAMES}, pr as (select * from ey where rol = 'proveedor'), hi as (select ruc, sum(m) total, sum(n)::bigint procesos, min(anio) primero, max(anio) ultimo, count(*) anios, coalesce(max(anio) filter (anio < {CURRENT}), max(anio)) base from pr group by ruc), ro as (select ruc, case when count(distinct rol) > 1 then 'ambos' else min(rol) end tipo from ey group by ruc), co as (select coalesce(max(anio) filter (anio < {CURRENT}), {CURRENT} - 1) cohorte from pr),
g5 as (select ro.ruc, coalesce(nombre, ro.ruc) nombre, tipo, regexp_matches(ro.ruc, '^[0-9]+$') and length(ro.ruc) >= 3 and substr(ro.ruc, 3, 1) < '6' es_natural, regexp_matches(ro.ruc, '^[0-9]+$') and substr(ro.ruc, 3, 1) = '6' es_publica, {_PROVINCE.format(c='ro.ruc')} provincia, case when hi.ruc is not null then {_BAND.format(c='coalesce(pr.m, 0)')} end tramo, base anio_base, cast(round(pr.m, 2) as double) monto_base, pr.n procesos_base, pr.c compradores_base, base = cohorte activo, cast(round(total, 2) as double) monto_total, procesos procesos_total, primero primer_anio, ultimo ultimo_anio, anios anios_activo from ro left join no using (ruc) left join hi on hi.ruc = ro.ruc left join pr on pr.ruc = ro.ruc and pr.anio = base cross join co)"""


@query(f"""with {_G5} select * from g5""")
def g05_entities(spark, sf):
    """Every entity with its name, roles and headline figures of its last complete year.

    The cohort is the last complete year of all suppliers; a supplier of the running year alone has
    that year's figures and is not active.
    """
    ey = g02_entity_year(spark, sf)
    own = F.col("rol") == "proveedor"
    year = F.struct((F.col("anio") < CURRENT).alias("completo"), "anio", "monto", "n_procesos", "n_contrapartes")
    d = ey.groupBy("ruc").agg(
        F.min("rol").alias("r0"), F.max("rol").alias("r1"), F.max(F.when(own, year)).alias("b"), F.sum(F.when(own, dec("monto"))).alias("t"), F.sum(F.when(own, F.col("n_procesos"))).alias("procesos_total"),
        F.min(F.when(own, F.col("anio"))).alias("primer_anio"), F.max(F.when(own, F.col("anio"))).alias("ultimo_anio"), F.count(F.when(own, 1)).alias("k"),
    )
    cohort = ey.where(own & (F.col("anio") < CURRENT)).agg(F.coalesce(F.max("anio"), F.lit(CURRENT - 1)).alias("cohorte"))  # one row
    names = rel.mode_by(table(spark, sf, "entidad").where("ruc is not null").select("ruc", "nombre"), ["ruc"], "nombre").select("ruc", "nombre")
    d = d.join(names, "ruc", "left").join(F.broadcast(cohort))
    sells = F.col("k") > 0
    return d.select(
        "ruc", F.coalesce("nombre", "ruc").alias("nombre"), F.when(F.col("r0") == F.col("r1"), F.col("r0")).otherwise("ambos").alias("tipo"), scalars.is_natural(F.col("ruc")).alias("es_natural"), scalars.is_public(F.col("ruc")).alias("es_publica"),
        scalars.province(F.col("ruc")).alias("provincia"), F.when(sells, scalars.banded(F.coalesce("b.monto", F.lit(0.0)), BANDS, LAST_BAND)).alias("tramo"), F.col("b.anio").alias("anio_base"), F.round("b.monto", 2).alias("monto_base"), F.col("b.n_procesos").alias("procesos_base"),
        F.col("b.n_contrapartes").alias("compradores_base"), (F.col("b.anio") == F.col("cohorte")).alias("activo"), F.round("t", 2).cast("double").alias("monto_total"), "procesos_total", "primer_anio", "ultimo_anio", F.when(sells, F.col("k")).alias("anios_activo"),
    )


@query(f"""with {_G5}, co2 as (select ruc, rank() over (partition by tramo order by monto_base desc) puesto_tramo, count(*) over (partition by tramo) n_tramo from g5 where activo and tramo is not null) select g5.ruc, nombre, tipo, tramo, activo, monto_base, puesto_tramo, n_tramo, monto_total from g5 left join co2 using (ruc) where tipo in ('proveedor', 'ambos') and not es_natural""")
def j18_supplier_cards(spark, sf):
    """Suppliers with their rank among the active ones of their band.

    A band may hold a third of all suppliers, so the rank comes from running counts of the distinct
    amounts and not from a window over the band.
    """
    e = g05_entities(spark, sf)
    peers = e.where(F.col("activo") & F.col("tramo").isNotNull())
    ranks = rel.rank_desc(peers, ["tramo"], "monto_base").withColumnsRenamed({"puesto": "puesto_tramo", "de": "n_tramo"})
    cards = e.where(F.col("tipo").isin("proveedor", "ambos") & ~F.col("es_natural"))
    d = cards.join(ranks.withColumn("activo", F.lit(True)), ["tramo", "monto_base", "activo"], "left")
    return d.select("ruc", "nombre", "tipo", "tramo", "activo", "monto_base", "puesto_tramo", "n_tramo", "monto_total")


@query(f"""with {_G5}, bu as (select * from ey where rol = 'comprador'), bg as (select max(anio) anio from bu where anio < {CURRENT}), own as (select ruc, anio, m, n, c from (select bu.*, row_number() over (partition by ruc order by bu.anio desc) r from bu, bg where bu.anio <= bg.anio) where r = 1), hb as (select ruc, sum(m) total, sum(n)::bigint procesos, min(anio) primero, max(anio) ultimo, count(*) anios from bu group by ruc) select g5.ruc, nombre, tipo, own.anio anio_base, own.anio = (select anio from bg) activo, cast(own.m as double) monto_base, own.n procesos_base, own.c proveedores_base, cast(total as double) monto_total, procesos procesos_total, primero primer_anio, ultimo ultimo_anio, anios anios_activo from g5 join hb using (ruc) left join own using (ruc) where tipo in ('comprador', 'ambos') and not es_natural""")
def j19_buyer_cards(spark, sf):
    """Buyers with their history and the figures of their last complete year."""
    buys = g02_entity_year(spark, sf).where("rol = 'comprador'")
    base = buys.where(F.col("anio") < CURRENT).agg(F.max("anio").alias("global"))  # one row
    done = F.col("anio") <= F.col("global")
    year = F.struct("anio", "monto", "n_procesos", "n_contrapartes")
    h = buys.join(F.broadcast(base)).groupBy("ruc", "global").agg(F.max(F.when(done, year)).alias("b"), F.sum(dec("monto")).cast("double").alias("monto_total"), F.sum("n_procesos").alias("procesos_total"), F.min("anio").alias("primer_anio"), F.max("anio").alias("ultimo_anio"), F.count(F.lit(1)).alias("anios_activo"))
    e = g05_entities(spark, sf).where(F.col("tipo").isin("comprador", "ambos") & ~F.col("es_natural")).select("ruc", "nombre", "tipo")
    return e.join(h, "ruc").select("ruc", "nombre", "tipo", F.col("b.anio").alias("anio_base"), (F.col("b.anio") == F.col("global")).alias("activo"), F.col("b.monto").alias("monto_base"), F.col("b.n_procesos").alias("procesos_base"), F.col("b.n_contrapartes").alias("proveedores_base"), "monto_total", "procesos_total", "primer_anio", "ultimo_anio", "anios_activo")


@query(f"""with {_EY} select ruc, anio, rol, cast(m as double) monto from (select *, row_number() over (partition by ruc, rol order by anio desc) r from ey) where r = 1""")
def d04_latest_year(spark, sf):
    return rel.last_by(g02_entity_year(spark, sf), ["ruc", "rol"], ["anio"]).select("ruc", "anio", "rol", "monto")


@query(f"""select comprador_ruc, proveedor_ruc, anio, cast(sum(cast(adjudicado as decimal(18,4))) as double) monto, cast(sum(n_procesos) as bigint) n_procesos from (select distinct * from hecho_mes) where comprador_ruc is not null and proveedor_ruc is not null and anio >= {CUTOFF // 12} - 1 group by all""")
def g03_recent_relations(spark, sf):
    """Buyer and supplier per year, from the year before the last settled one on."""
    h = table(spark, sf, "hecho_mes").where(F.col("anio") >= CUTOFF // 12 - 1).distinct().where("comprador_ruc is not null and proveedor_ruc is not null")
    return h.groupBy("comprador_ruc", "proveedor_ruc", "anio").agg(money("adjudicado").alias("monto"), F.sum("n_procesos").alias("n_procesos"))


@query(f"""with {_G5} select tramo, round(avg(c), 6) media, count(*) n from g5 join ey on ey.ruc = g5.ruc and ey.rol = 'proveedor' and ey.anio = (select max(anio) from ey) group by tramo""")
def g24_counterparts_by_band(spark, sf):
    """Average number of buyers per band of suppliers in the last year."""
    ey = g02_entity_year(spark, sf)
    last = ey.agg(F.max("anio").alias("anio"))  # one row
    d = ey.where("rol = 'proveedor'").join(F.broadcast(last), "anio", "left_semi").join(g05_entities(spark, sf).select("ruc", "tramo"), "ruc")
    return d.groupBy("tramo").agg(F.round(F.avg("n_contrapartes"), 6).alias("media"), F.count(F.lit(1)).alias("n"))


@query(f"""with {_G5} select count(*) n from g5 join ey on ey.ruc = g5.ruc and ey.rol = 'proveedor' and ey.anio = (select max(anio) from ey where rol = 'proveedor' and anio < {CURRENT}) where tramo in ('100-500K', '500K-2M')""")
def g26_segment_size(spark, sf):
    """Suppliers of two bands that were active in the last complete year."""
    sells = g02_entity_year(spark, sf).where(F.col("rol") == "proveedor")
    last = sells.where(F.col("anio") < CURRENT).agg(F.max("anio").alias("anio"))  # one row
    e = g05_entities(spark, sf).where(F.col("tramo").isin("100-500K", "500K-2M")).select("ruc")
    return sells.join(F.broadcast(last), "anio", "left_semi").join(e, "ruc").agg(F.count(F.lit(1)).alias("n"))


# Buyers a supplier never met


def masked_view(e: DataFrame) -> DataFrame:
    """(ruc_visible, nombre): the only view of entities; persons show four figures."""
    d = rel.mode_by(e.where("ruc is not null").select("ruc", "nombre"), ["ruc"], "nombre")
    return d.select(F.when(scalars.is_natural(F.col("ruc")), scalars.masked(F.col("ruc"))).otherwise(F.col("ruc")).alias("ruc_visible"), "nombre")


def unmet_buyers(r: DataFrame, entities: DataFrame, supplier: str, most: int = 100) -> DataFrame:
    """Buyers of the nodes a supplier has served that it never served, largest first.

    They are looked up by their visible id, so a person, whose id is masked, is never given.
    """
    own = r.where(F.col("proveedor_ruc") == supplier)
    nodes = own.select("cpc_nodo").where("cpc_nodo is not null").distinct()
    met = own.select("comprador_ruc").where("comprador_ruc is not null").distinct()
    d = r.where("comprador_ruc is not null").join(nodes, "cpc_nodo", "left_semi").join(met, "comprador_ruc", "left_anti")
    d = d.groupBy("comprador_ruc").agg(F.count(F.lit(1)).alias("n"), money("adjudicado").alias("monto"))
    d = d.join(masked_view(entities), F.col("comprador_ruc") == F.col("ruc_visible")).select("comprador_ruc", "nombre", "n", "monto")
    return rel.top_k(d, [F.desc_nulls_last("monto"), F.asc("comprador_ruc")], most)


@query(f"""with {_NAMES}, s as (select proveedor_ruc from proceso_resumen where regexp_matches(proveedor_ruc, '^\\d{{13}}$') and cpc_nodo is not null group by 1 order by count(*), 1 limit 1), own as (select * from proceso_resumen where proveedor_ruc = (select proveedor_ruc from s)) select comprador_ruc, nombre, count(*) n, cast(sum(cast(adjudicado as decimal(18,4))) as double) monto from proceso_resumen join no on ruc = comprador_ruc where not (length(ruc) >= 3 and substr(ruc, 3, 1) < '6') and left(cpc_nodo, 1) in (select left(cpc_nodo, 1) from own where cpc_nodo is not null) and comprador_ruc not in (select comprador_ruc from own where comprador_ruc is not null) group by 1, 2 order by monto desc nulls last, 1 limit 100""")
def j09_unmet_buyers(spark, sf):
    """For the supplier with fewest rows, by section of the tree."""
    r = table(spark, sf, "proceso_resumen").select("proveedor_ruc", "comprador_ruc", "cpc_nodo", "adjudicado")
    counts = r.where(F.col("proveedor_ruc").rlike(r"^\d{13}$") & F.col("cpc_nodo").isNotNull()).groupBy("proveedor_ruc").agg(F.count(F.lit(1)).alias("n"))
    one = rel.top_k(counts, [F.asc("n"), F.asc("proveedor_ruc")], 1).first()
    return unmet_buyers(r.withColumn("cpc_nodo", F.left("cpc_nodo", F.lit(1))), table(spark, sf, "entidad"), one[0] if one else "")


# Pages


@query("""with l as (select ruc, nombre from (select distinct ruc, nombre from entidad where ruc in (select comprador_ruc from hecho_mes where comprador_ruc is not null))) select ruc, nombre, (select count(*) from l) total from l order by nombre, ruc limit 20 offset 5""")
def sel14_listed_page(spark, sf):
    """A page of the entities in a list of keys, with the number of all that match."""
    h = table(spark, sf, "hecho_mes").select(F.col("comprador_ruc").alias("ruc")).where("ruc is not null")
    d = table(spark, sf, "entidad").select("ruc", "nombre").distinct().join(h, "ruc", "left_semi")
    page = rel.top_k(d, [F.asc_nulls_last("nombre"), F.asc_nulls_last("ruc")], 20, offset=5)
    return page.join(F.broadcast(d.agg(F.count(F.lit(1)).alias("total"))))  # one row


@query("""select ruc, nombre, clave from (select distinct ruc, nombre, lower(nombre) clave from entidad where nombre is not null) where contains(clave, 'cia')""")
def t11_search_view(spark, sf):
    """Search by a part of the lower-case key."""
    d = table(spark, sf, "entidad").where("nombre is not null").select("ruc", "nombre", F.lower("nombre").alias("clave")).distinct()
    return d.where(F.col("clave").contains("cia"))
