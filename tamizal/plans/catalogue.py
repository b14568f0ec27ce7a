"""Queries over whole tables for the inventory's own operators, each with the SQL that defines it.

Names follow the inventory's ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars, text
from ..operators import relational as rel
from ..operators import vectors
from ..session import table
from ..streaming import events as streams
from .registry import QUERIES, SQL, dec, money, query

__all__ = ["QUERIES", "SQL"]

# Deduplication and keyed selection


@query("""select ocid, fila_id, estado, anio, mes from (select *, row_number() over (partition by ocid order by anio, mes, fila_id) r from proceso_resumen) where r = 1""")
def d01_first_delivery(spark, sf):
    d = table(spark, sf, "proceso_resumen").select("ocid", "fila_id", "estado", "anio", "mes")
    return rel.first_by(d, ["ocid"], ["anio", "mes", "fila_id"]).select("ocid", "fila_id", "estado", "anio", "mes")


@query("""select ocid, fila_id, estado, anio, mes from (select *, row_number() over (partition by ocid order by anio desc, mes desc, fila_id desc) r from proceso_resumen) where r = 1""")
def d02_last_delivery(spark, sf):
    d = table(spark, sf, "proceso_resumen").select("ocid", "fila_id", "estado", "anio", "mes")
    return rel.last_by(d, ["ocid"], ["anio", "mes", "fila_id"]).select("ocid", "fila_id", "estado", "anio", "mes")


@query("""select ruc, nombre, peso from (select ruc, nombre, count(*) peso, row_number() over (partition by ruc order by count(*) desc, nombre) r from entidad where nombre is not null group by ruc, nombre) where r = 1""")
def d08_name_mode(spark, sf):
    return rel.mode_by(table(spark, sf, "entidad").select("ruc", "nombre"), ["ruc"], "nombre")


# Scalars


@query("""select distinct ruc, repeat('.', greatest(length(ruc) - 4, 0)) || right(ruc, 4) visible, left(ruc, 2) prefijo from entidad where ruc is not null""")
def f08_masked(spark, sf):
    d = table(spark, sf, "entidad").where("ruc is not null")
    return d.select("ruc", scalars.masked(F.col("ruc")).alias("visible"), F.left("ruc", F.lit(2)).alias("prefijo")).distinct()


@query("""select p_partkey, case when p_retailprice < 1000 then 'bajo' when p_retailprice < 1500 then 'medio' else 'alto' end banda from part where p_retailprice is not null""")
def f09_bands(spark, sf):
    return table(spark, sf, "part").where("p_retailprice is not null").select("p_partkey", scalars.banded(F.col("p_retailprice"), [(1000, "bajo"), (1500, "medio")], "alto").alias("banda"))


@query("""select fila_id, try_cast(left(fecha, 10) as date) dia from proceso_resumen where regexp_matches(left(fecha, 10), '^\\d{4}-\\d{2}-\\d{2}$')""")
def f11_days(spark, sf):
    d = table(spark, sf, "proceso_resumen").where(F.left("fecha", F.lit(10)).rlike(r"^\d{4}-\d{2}-\d{2}$"))
    return d.select("fila_id", scalars.day(F.col("fecha")).alias("dia"))


@query("""select item_fila, case when length(regexp_replace(cpc, '\\D', '', 'g')) >= 3 then left(regexp_replace(cpc, '\\D', '', 'g'), 5) end grupo from proceso_item""")
def f15_code_groups(spark, sf):
    return table(spark, sf, "proceso_item").select("item_fila", scalars.code_prefix(F.col("cpc")).alias("grupo"))


@query("""select distinct nombre, array_to_string(list_sort(list_transform(list_filter(regexp_extract_all(translate(lower(nombre), 'áàäâãéèëêíìïîóòöôõúùüûñç', 'aaaaaeeeeiiiiooooouuuunc'), '[a-z]+'), lambda w: not list_contains(['de','del','la','el','los','las','y','para','en','con','a'], w)), lambda w: case when ends_with(w, 'es') and length(w) > 5 then left(w, length(w) - 2) when ends_with(w, 's') and length(w) > 4 then left(w, length(w) - 1) else w end)), ' ') clave from entidad where nombre is not null""")
def f17_name_keys(spark, sf):
    return table(spark, sf, "entidad").where("nombre is not null").select("nombre", text.name_key(F.col("nombre")).alias("clave")).distinct()


@query("""select doc_id, len(regexp_extract_all(text, '[ÂÃ][\\x{80}-¿]+')) rotos from documents where text is not null and regexp_matches(text, '[ÂÃ][\\x{80}-¿]+')""")
def f23_broken_texts(spark, sf):
    n = F.regexp_count("text", F.lit(r"[ÂÃ][\u0080-¿]+")).cast("long")
    return table(spark, sf, "documents").select("doc_id", n.alias("rotos")).where("rotos > 0")


@query()
def f22_repaired_texts(spark, sf):
    d = table(spark, sf, "documents").where(F.col("text").rlike(r"[ÂÃ][\u0080-¿]"))
    return d.select("doc_id", text.repair_encoding("text").alias("texto"))


# Aggregations

_G1 = "anio, mes, nullif(trim(comprador_ruc), '') comprador, nullif(trim(proveedor_ruc), '') proveedor, nullif(trim(metodo), '') metodo"


@query(f"""select {_G1}, count(*) n_procesos, cast(sum(coalesce(cast(referencial as decimal(18,2)), 0)) as double) referencial, cast(sum(coalesce(cast(adjudicado as decimal(18,2)), 0)) as double) adjudicado from proceso_resumen group by all""")
def g01_month_cube(spark, sf):
    r = table(spark, sf, "proceso_resumen")
    key = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    zero = F.lit(0).cast("decimal(18,2)")
    d = r.select("anio", "mes", key("comprador_ruc").alias("comprador"), key("proveedor_ruc").alias("proveedor"), key("metodo").alias("metodo"), "referencial", "adjudicado")
    return d.groupBy("anio", "mes", "comprador", "proveedor", "metodo").agg(F.count(F.lit(1)).alias("n_procesos"), money(F.coalesce(dec("referencial", 2), zero), 2).alias("referencial"), money(F.coalesce(dec("adjudicado", 2), zero), 2).alias("adjudicado"))


@query("""with h as (select distinct * from hecho_mes), e as (select comprador_ruc ruc, anio, 'comprador' rol, proveedor_ruc otro, n_procesos, adjudicado from h where comprador_ruc is not null union all select proveedor_ruc, anio, 'proveedor', comprador_ruc, n_procesos, adjudicado from h where proveedor_ruc is not null)
select ruc, anio, rol, cast(sum(cast(adjudicado as decimal(18,4))) as double) monto, cast(sum(n_procesos) as bigint) n_procesos, count(distinct otro) n_contrapartes from e group by ruc, anio, rol""")
def g02_entity_year(spark, sf):
    h = table(spark, sf, "hecho_mes").distinct()
    # both roles in one pass over the cube
    roles = F.array(
        F.struct(F.col("comprador_ruc").alias("ruc"), F.lit("comprador").alias("rol"), F.col("proveedor_ruc").alias("otro")),
        F.struct(F.col("proveedor_ruc").alias("ruc"), F.lit("proveedor").alias("rol"), F.col("comprador_ruc").alias("otro")),
    )
    d = h.select("anio", "n_procesos", "adjudicado", F.explode(roles).alias("r")).select("anio", "n_procesos", "adjudicado", "r.*").where("ruc is not null")
    # one row per counterpart first, so the distinct count needs no second expansion of the rows
    per = d.groupBy("ruc", "anio", "rol", "otro").agg(F.sum(dec("adjudicado")).alias("m"), F.sum("n_procesos").alias("n"))
    return per.groupBy("ruc", "anio", "rol").agg(F.sum("m").cast("double").alias("monto"), F.sum("n").alias("n_procesos"), F.count("otro").alias("n_contrapartes"))


@query("""select comprador_ruc, proveedor_ruc, anio, cast(sum(cast(adjudicado as decimal(18,4))) as double) monto, cast(sum(n_procesos) as bigint) n_procesos from (select distinct * from hecho_mes) where comprador_ruc is not null and proveedor_ruc is not null group by all""")
def g03_relations(spark, sf):
    h = table(spark, sf, "hecho_mes").distinct().where("comprador_ruc is not null and proveedor_ruc is not null")
    return h.groupBy("comprador_ruc", "proveedor_ruc", "anio").agg(money("adjudicado").alias("monto"), F.sum("n_procesos").alias("n_procesos"))


@query("""select cpc, anio, cast(sum(cast(monto_linea as decimal(18,4))) as double) monto, count(distinct ocid) n_procesos from proceso_item where cpc is not null group by cpc, anio""")
def g08_code_market(spark, sf):
    i = table(spark, sf, "proceso_item").where("cpc is not null")
    per = i.groupBy("cpc", "anio", "ocid").agg(F.sum(dec("monto_linea")).alias("m"))
    return per.groupBy("cpc", "anio").agg(F.sum("m").cast("double").alias("monto"), F.count("ocid").alias("n_procesos"))


_TREE = """l as (select cpc_nodo, comprador_ruc, proveedor_ruc, adjudicado, n_oferentes, estado from proceso_resumen), e as (select left(cpc_nodo, k) nodo, l.* from l, generate_series(1, 5) g(k) where length(cpc_nodo) >= k and regexp_matches(cpc_nodo, '^\\d+$'))"""


def _levels(spark, sf):
    d = table(spark, sf, "proceso_resumen").select("cpc_nodo", "comprador_ruc", "proveedor_ruc", "adjudicado", "n_oferentes", "estado", "metodo")
    return rel.prefix_levels(d.where(F.col("cpc_nodo").rlike(r"^\d+$")), "cpc_nodo", 5)


@query(f"""with l as (select cpc_nodo, coalesce(metodo, '(sin método)') metodo, adjudicado from proceso_resumen), e as (select left(cpc_nodo, k) nodo, l.* from l, generate_series(1, 5) g(k) where length(cpc_nodo) >= k and regexp_matches(cpc_nodo, '^\\d+$')) select nodo, metodo, count(*) n, cast(coalesce(sum(cast(adjudicado as decimal(18,4))), 0) as double) monto from e group by nodo, metodo""")
def g11_node_method(spark, sf):
    d = _levels(spark, sf).groupBy("nodo", F.coalesce("metodo", F.lit("(sin método)")).alias("metodo"))
    return d.agg(F.count(F.lit(1)).alias("n"), F.coalesce(money("adjudicado"), F.lit(0.0)).alias("monto"))


@query("""select comprador_ruc, count(*) n, cast(sum(n_procesos) as bigint) procesos, min(anio) desde, max(anio) hasta, count(distinct anio) anios from (select distinct * from hecho_mes) where comprador_ruc is not null group by comprador_ruc""")
def g18_buyer_history(spark, sf):
    h = table(spark, sf, "hecho_mes").distinct().where("comprador_ruc is not null")
    return h.groupBy("comprador_ruc").agg(F.count(F.lit(1)).alias("n"), F.sum("n_procesos").alias("procesos"), F.min("anio").alias("desde"), F.max("anio").alias("hasta"), F.countDistinct("anio").alias("anios"))


@query("""select metodo, count(*) n, round(100.0 * count(*) filter (estado in ('cerrado', 'adjudicado')) / greatest(count(*), 1), 2) pct from proceso_resumen group by metodo""")
def g19_share_closed(spark, sf):
    closed = F.count_if(F.col("estado").isin("cerrado", "adjudicado"))
    return table(spark, sf, "proceso_resumen").groupBy("metodo").agg(F.count(F.lit(1)).alias("n"), F.round(F.lit(100.0) * closed / F.count(F.lit(1)), 2).alias("pct"))


@query("""select ocid, cast(round(sum(cast(monto_linea as decimal(18,4))), 2) as double) total from proceso_item where origen = 'tender' and monto_linea > 0 group by ocid""")
def g21_process_totals(spark, sf):
    i = table(spark, sf, "proceso_item").where("origen = 'tender' and monto_linea > 0")
    return i.groupBy("ocid").agg(F.round(F.sum(dec("monto_linea")), 2).cast("double").alias("total"))


@query("""select cast(extract(year from m) as int) anio, cast(extract(month from m) as int) mes from generate_series(date '2015-01-01', date '2026-03-01', interval 1 month) g(m) where not exists (select 1 from hecho_mes h where h.anio = extract(year from m) and h.mes = extract(month from m))""")
def g22_missing_months(spark, sf):
    return rel.missing_months(table(spark, sf, "hecho_mes"), (2015, 1), (2026, 3))


@query("""select left(cpc_nodo, 1) seccion, count(distinct comprador_ruc) compradores from proceso_resumen where regexp_matches(cpc_nodo, '^\\d+$') group by 1 order by 2 desc, 1 limit 3""")
def g25_top_sections(spark, sf):
    d = table(spark, sf, "proceso_resumen").where(F.col("cpc_nodo").rlike(r"^\d+$"))
    return rel.top_k(d.groupBy(F.left("cpc_nodo", F.lit(1)).alias("seccion")).agg(F.countDistinct("comprador_ruc").alias("compradores")), [F.desc("compradores"), F.asc("seccion")], 3)


@query("""with a as (select anio, sum(n_procesos) n from (select distinct * from hecho_mes) group by anio), b as (select anio, count(distinct ocid) m from proceso_resumen group by anio) select anio, cast(n as bigint) n_cubo, m n_filas, round(n / m, 4) razon from a full join b using (anio)""")
def g27_reconciliation(spark, sf):
    a = table(spark, sf, "hecho_mes").distinct().groupBy("anio").agg(F.sum("n_procesos").alias("n_cubo"))
    b = table(spark, sf, "proceso_resumen").groupBy("anio").agg(F.countDistinct("ocid").alias("n_filas"))
    return a.join(b, "anio", "full").select("anio", "n_cubo", "n_filas", F.round(F.col("n_cubo") / F.col("n_filas"), 4).alias("razon"))


@query("""select (select count(*) from proceso_resumen) filas, (select count(distinct ocid) from proceso_resumen) procesos, (select cast(sum(cast(adjudicado as decimal(18,4))) as double) from proceso_resumen) monto, (select count(distinct ruc) from entidad) entidades, (select count(*) from cpc_nivel where nivel = 1) secciones""")
def g16_totals(spark, sf):
    """One-row aggregates side by side; each table is read once."""
    r = table(spark, sf, "proceso_resumen").agg(F.count(F.lit(1)).alias("filas"), F.countDistinct("ocid").alias("procesos"), money("adjudicado").alias("monto"))
    e = table(spark, sf, "entidad").agg(F.countDistinct("ruc").alias("entidades"))
    n = table(spark, sf, "cpc_nivel").where("nivel = 1").agg(F.count(F.lit(1)).alias("secciones"))
    return r.join(e).join(n)


@query("""with l as (select ocid, sum(cast(monto_linea as decimal(18,4))) s from proceso_item where origen = 'tender' group by ocid), r as (select ocid, max(cast(referencial as decimal(18,4))) m from proceso_resumen group by ocid) select count(*) n, count(*) filter (abs(s - m) <= m * 0.02) cerca from l join r using (ocid) where s > 0 and m > 0""")
def g23_line_check(spark, sf):
    i = table(spark, sf, "proceso_item").where("origen = 'tender'").groupBy("ocid").agg(F.sum(dec("monto_linea")).alias("s"))
    r = table(spark, sf, "proceso_resumen").groupBy("ocid").agg(F.max(dec("referencial")).alias("m"))
    return i.join(r, "ocid").where("s > 0 and m > 0").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("s") - F.col("m")) <= F.col("m") * F.lit(0.02).cast("decimal(4,2)")).alias("cerca"))


@query("""select count(*) lineas, count(*) filter (metodo is null) sin_metodo, round(count(*) filter (metodo is null) / count(*), 6) parte from proceso_item i left join (select ocid, max(metodo) metodo from proceso_resumen group by ocid) r using (ocid)""")
def j02_lines_without_method(spark, sf):
    m = table(spark, sf, "proceso_resumen").groupBy("ocid").agg(F.max("metodo").alias("metodo"))
    d = table(spark, sf, "proceso_item").select("ocid").join(m, "ocid", "left")
    none = F.count_if(F.col("metodo").isNull())
    return d.agg(F.count(F.lit(1)).alias("lineas"), none.alias("sin_metodo"), F.round(none / F.count(F.lit(1)), 6).alias("parte"))



# Joins


@query("""with l as (select l_suppkey s, o_custkey c, left(lpad(p_size::varchar, 2, '0') || lpad((p_partkey % 1000)::varchar, 3, '0'), 5) n from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey), own as (select distinct s, n from l), who as (select distinct c, n from l), reach as (select distinct s, c from own join who using (n)) select s, count(*) n from reach r where not exists (select 1 from l where l.s = r.s and l.c = r.c) group by s""")
def j08_never_met(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("n"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_suppkey").alias("s"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c"))
    d = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).select("s", "c", F.col("n").alias("x"))
    return rel.never_met(d, d, left="s", right="c", through="x")


@query("""select r.fila_id, coalesce(r.cpc, i.cpc) cpc from proceso_resumen r left join (select ocid, min(cpc) cpc from proceso_item group by ocid) i using (ocid)""")
def j14_filled_codes(spark, sf):
    r = table(spark, sf, "proceso_resumen").select("fila_id", "ocid", "cpc")
    i = table(spark, sf, "proceso_item").groupBy("ocid").agg(F.min("cpc").alias("cpc"))
    return rel.fill_from(r, i, ["ocid"], ["cpc"]).select("fila_id", "cpc")


# Windows, order, sets


@query("""with t as (select c_nationkey, c_custkey, cast(sum(cast(o_totalprice as decimal(18,2))) as double) monto from customer join orders on c_custkey = o_custkey group by all) select c_nationkey, c_custkey, monto, rank() over (partition by c_nationkey order by monto desc) puesto, count(*) over (partition by c_nationkey) de from t""")
def w01_ranked_customers(spark, sf):
    c, o = table(spark, sf, "customer").select("c_custkey", "c_nationkey"), table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    # totals before the join: the orders are shuffled once, by customer, as partial sums
    t = o.groupBy("o_custkey").agg(money("o_totalprice", 2).alias("monto"))
    d = c.join(t, F.col("c_custkey") == F.col("o_custkey")).select("c_nationkey", "c_custkey", "monto")
    return rel.ranked(d, ["c_nationkey"], F.desc("monto"))


@query("""select metodo, n, round(n / sum(n) over (), 6) cuota from (select metodo, count(*) n from proceso_resumen group by metodo)""")
def w04_method_share(spark, sf):
    d = table(spark, sf, "proceso_resumen").groupBy("metodo").agg(F.count(F.lit(1)).alias("n"))
    return rel.share(d, "n").withColumn("cuota", F.round("cuota", 6))


@query("""select fila_id, adjudicado from proceso_resumen where adjudicado is not null order by adjudicado desc, fila_id limit 100""")
def o01_largest(spark, sf):
    return rel.top_k(table(spark, sf, "proceso_resumen").where("adjudicado is not null").select("fila_id", "adjudicado"), [F.desc("adjudicado"), F.asc("fila_id")], 100)


@query("""select fila_id, ocid from proceso_resumen order by ocid, fila_id limit 50 offset 100""")
def sel14_page(spark, sf):
    return rel.top_k(table(spark, sf, "proceso_resumen").select("fila_id", "ocid"), [F.asc("ocid"), F.asc("fila_id")], 50, offset=100)


@query("""select fila_id, anio, mes from proceso_resumen where anio * 12 + mes between 2025 * 12 + 1 and 2025 * 12 + 8""")
def sel06_window(spark, sf):
    return table(spark, sf, "proceso_resumen").select("fila_id", "anio", "mes").where("anio * 12 + mes between 2025 * 12 + 1 and 2025 * 12 + 8")


# Text and vectors


@query("""select fila_id from proceso_resumen where regexp_matches(translate(lower(objeto), 'áéíóúüñ', 'aeiouun'), '(^|[^a-z0-9])guantes?($|[^a-z0-9])') and regexp_matches(translate(lower(objeto), 'áéíóúüñ', 'aeiouun'), '(^|[^a-z0-9])nitrilos?($|[^a-z0-9])')""")
def t09_search(spark, sf):
    return table(spark, sf, "proceso_resumen").where(text.matches(F.col("objeto"), "guantes de nitrilo")).select("fila_id")


def _trigram_sql(x: str) -> str:
    folded = f"regexp_replace(translate(lower({x}), 'áàäâãéèëêíìïîóòöôõúùüûñç', 'aaaaaeeeeiiiiooooouuuunc'), '[^a-z0-9]+', ' ', 'g')"
    return f"list_distinct(list_transform(range(1, length('  ' || {folded} || ' ') - 1), lambda k: substr('  ' || {folded} || ' ', k, 3)))"


@query(f"""with n as (select distinct ruc, nombre, {_trigram_sql('nombre')} a, {_trigram_sql("'Empresa Lorvi S.A.'")} b from entidad where nombre is not null) select * from (select ruc, nombre, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) similitud from n) where similitud >= 0.15""")
def t10_similar_names(spark, sf):
    """Names whose trigrams resemble a searched name, with the similarity."""
    d = table(spark, sf, "entidad").select("ruc", "nombre").where("nombre is not null").distinct()
    return d.withColumn("similitud", F.round(text.trigram_similarity(F.col("nombre"), F.lit("Empresa Lorvi S.A.")), 6)).where("similitud >= 0.15")


@query("""select label, cast(count(*) as bigint) n, round(avg(embedding[1]), 4) c1, round(avg(embedding[64]), 4) c64 from embeddings group by label""")
def t02_centroids(spark, sf):
    e = table(spark, sf, "embeddings")
    c = vectors.centroids(e, "label", "embedding", 64)
    n = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return c.join(n, "label").select("label", "n", F.round(F.get("centro", F.lit(0)), 4).alias("c1"), F.round(F.get("centro", F.lit(63)), 4).alias("c64"))


_CENTRES = "ce as (select label, list(m order by i) c from (select label, i, avg(embedding[i]::double) m from embeddings, generate_series(1, 64) g(i) where len(embedding) = 64 group by all) group by label)"
_BEST = f"{_CENTRES}, si as (select vec_id, ce.label, list_cosine_similarity(embedding::double[], c) s from embeddings, ce), be as (select vec_id, label, s from (select *, row_number() over (partition by vec_id order by round(s, 6) desc, label) r from si) where r = 1)"


@query(f"""with {_BEST} select vec_id, label, round(round(s, 6), 4) similitud from be""")
def t05_nearest_any(spark, sf):
    """The nearest label of every vector, however far."""
    e = table(spark, sf, "embeddings")
    d = vectors.nearest(e, vectors.centroids(e, "label", "embedding", 64), key="vec_id", vector="embedding", rep="label", rep_vector="centro")
    return d.withColumn("similitud", F.round("similitud", 4))


@query(f"""with {_BEST} select vec_id, label, round(s, 6) similitud from be where round(s, 6) >= 0.55""")
def t05_nearest_label(spark, sf):
    """The nearest label of every vector; below the threshold none is given."""
    e = table(spark, sf, "embeddings")
    return vectors.nearest(e, vectors.centroids(e, "label", "embedding", 64), key="vec_id", vector="embedding", rep="label", rep_vector="centro", least=0.55)


@query(f"""with {_BEST}, cu as (select unnest([0.35, 0.45, 0.55, 0.65, 0.75])::double corte) select corte, count(*) filter (round(s, 6) >= corte) n, count(*) filter (round(s, 6) >= corte) / count(*) parte from be, cu group by corte""")
def t05_similarity_histogram(spark, sf):
    """(corte, n, parte): vectors whose best similarity reaches each cut, before any threshold."""
    e = table(spark, sf, "embeddings")
    best = vectors.nearest(e, vectors.centroids(e, "label", "embedding", 64), key="vec_id", vector="embedding", rep="label", rep_vector="centro")
    return vectors.similarity_histogram(best, [0.35, 0.45, 0.55, 0.65, 0.75])


@query(f"""with recursive {_CENTRES}, w as (select label, count(*) n from embeddings group by label), ed as (select a.label a, b.label b from ce a, ce b where list_cosine_similarity(a.c, b.c) >= 0.92), re(a, b) as (select a, b from ed union select re.a, ed.b from re join ed on re.b = ed.a) select re.a as label, first(re.b order by n desc, re.b) grupo from re join w on w.label = re.b group by re.a""")
def t04_merged_labels(spark, sf):
    e = table(spark, sf, "embeddings")
    c = vectors.centroids(e, "label", "embedding", 64).join(e.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label")
    return vectors.merge_labels(c, rep="label", vector="centro", weight="n", least=0.92)


@query("""with n as (select fila_id, categoria_id, lower(trim(objeto)) t from proceso_resumen), k as (select t, categoria_id, row_number() over (partition by t order by fila_id) r from n where categoria_id is not null and t is not null) select n.fila_id, coalesce(n.categoria_id, k.categoria_id) categoria_id from n left join k on n.t = k.t and k.r = 1""")
def t06_spread_labels(spark, sf):
    """The first known label of an equal text, given to rows without one."""
    d = table(spark, sf, "proceso_resumen").select("fila_id", "categoria_id", F.lower(F.trim("objeto")).alias("t"))
    known = rel.first_by(d, ["t"], ["fila_id"], where=F.col("categoria_id").isNotNull() & F.col("t").isNotNull()).select("t", "categoria_id")
    return rel.fill_from(d, known, ["t"], ["categoria_id"]).select("fila_id", "categoria_id")


# Checks, views, streams


@query("""select 'ruc' chequeo, count(*) filter (not regexp_matches(comprador_ruc, '^[0-9]{13}$')) malos, count(comprador_ruc) total from hecho_mes""")
def v09_tax_id_shape(spark, sf):
    h = table(spark, sf, "hecho_mes")
    return h.agg(F.count_if(~F.col("comprador_ruc").rlike("^[0-9]{13}$")).alias("malos"), F.count("comprador_ruc").alias("total")).select(F.lit("ruc").alias("chequeo"), "malos", "total")


@query("""select case when substr(ruc, 3, 1) < '6' then repeat('.', greatest(length(ruc) - 4, 0)) || right(ruc, 4) else ruc end ruc_visible, nombre, tipo from entidad where ruc is not null""")
def x06_masked_view(spark, sf):
    e = table(spark, sf, "entidad").where("ruc is not null")
    visible = F.when(F.substring("ruc", 3, 1) < "6", scalars.masked(F.col("ruc"))).otherwise(F.col("ruc"))
    return e.select(visible.alias("ruc_visible"), "nombre", "tipo")


@query("""select date_trunc('hour', ts) desde, event_type, count(*) n, cast(sum(cast(value as decimal(18,4))) as double) total from events group by all""")
def st1_stream_windows(spark, sf):
    d = streams.stream_windows(spark, sf)
    return d.select(F.col("desde").cast("timestamp_ntz").alias("desde"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query("""select l_returnflag, l_linestatus, cast(sum(cast(l_quantity as decimal(18,4))) as double) cantidad, cast(sum(cast(l_extendedprice as decimal(18,4))) as double) importe, count(*) n from lineitem group by all""")
def q01_line_summary(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(money("l_quantity").alias("cantidad"), money("l_extendedprice").alias("importe"), F.count(F.lit(1)).alias("n"))


@query("""select n_name, cast(extract(year from o_orderdate) as int) anio, cast(sum(cast(l_extendedprice as decimal(18,4))) as double) importe, count(distinct o_orderkey) pedidos from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by all""")
def q05_nation_year(spark, sf):
    li = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(dec("l_extendedprice")).alias("m"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    d = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    d = d.join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    d = d.join(table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    # one row per order by now, so orders are counted without a distinct
    return d.groupBy("n_name", F.year("o_orderdate").alias("anio")).agg(F.sum("m").cast("double").alias("importe"), F.count(F.lit(1)).alias("pedidos"))
