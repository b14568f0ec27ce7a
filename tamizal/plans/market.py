"""Prices, the code tree and the market of its nodes, each query with the SQL that defines it.

The statistics leave out the last months, which still change: a month counts up to CUTOFF.  Measures
are taken per full code first, and only these partial results are multiplied by the levels of the
tree; distinct counts and quantiles come from distinct parties and value counts, so a node that holds
a third of all rows is never one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars, text
from ..operators import relational as rel
from ..session import ensure_checkpoint_dir, table
from .registry import QUERIES, SQL, dec, filled, money, query

__all__ = ["QUERIES", "SQL"]

#: Last month index (year * 12 + month) whose figures are settled: four months before the last one delivered.
CUTOFF = 2025 * 12 + 12 - 4
#: Bands of yearly amounts.
BANDS = [(5e3, "<5K"), (25e3, "5-25K"), (100e3, "25-100K"), (500e3, "100-500K"), (2e6, "500K-2M"), (10e6, "2-10M")]
LAST_BAND = ">10M"
UNCLASSIFIED = "_sin_clasificar"
ZERO = "cast(0 as decimal(18,4))"


def settled(months: int = CUTOFF):
    return F.col("anio") * 12 + F.col("mes") <= months


@query(f"""select fila_id, anio, mes from proceso_resumen where anio * 12 + mes <= {CUTOFF}""")
def sel05_settled(spark, sf):
    """Rows of months that no longer change (P5)."""
    return table(spark, sf, "proceso_resumen").select("fila_id", "anio", "mes").where(settled())


# Which lines count, and the code of a process


def single_origin(items: DataFrame, *, annual: bool = False) -> DataFrame:
    """Lines of one origin per process (P10): award where any award line has an amount, else tender.

    Of the two variants, the plain one keeps all award lines of such a process and takes every origin
    but award as tender; the annual one works per year, keeps only award lines with an amount and
    takes as tender only what says so.
    """
    keys = ["ocid", "anio"] if annual else ["ocid"]
    is_award = F.coalesce(F.col("origen") == "award", F.lit(False))
    priced = F.coalesce(is_award & (F.col("monto_linea") > 0), F.lit(False))
    awarded = items.where(priced).select(*keys).distinct()
    if annual:
        award, other = items.where(priced), items.where(F.col("origen") == "tender")
    else:
        award, other = items.where(is_award).join(awarded, keys, "left_semi"), items.where(~is_award)
    return award.unionByName(other.join(awarded, keys, "left_anti"))


@query("""with s as (select ocid, max(case when origen = 'award' and monto_linea > 0 then 1 else 0 end) a from proceso_item group by ocid) select item_fila, i.ocid, origen from proceso_item i join s using (ocid) where (a = 1) = (origen is not distinct from 'award')""")
def sel10_single_origin(spark, sf):
    i = table(spark, sf, "proceso_item").select("item_fila", "ocid", "origen", "monto_linea").where("ocid is not null")
    return single_origin(i).select("item_fila", "ocid", "origen")


_CHOSEN = """el as (select *, max(case when origen = 'award' and monto_linea > 0 then 1 else 0 end) over (partition by ocid, anio) a from proceso_item where ocid is not null), ch as (select * from el where case when a = 1 then origen = 'award' and monto_linea > 0 else origen = 'tender' end)"""


@query(f"""with {_CHOSEN} select item_fila, ocid, anio, origen from ch""")
def sel10_single_origin_year(spark, sf):
    i = table(spark, sf, "proceso_item").select("item_fila", "ocid", "anio", "origen", "monto_linea").where("ocid is not null")
    return single_origin(i, annual=True).select("item_fila", "ocid", "anio", "origen")


def largest_line_code(items: DataFrame) -> DataFrame:
    """(ocid, cpc): the code of a process's largest single line; ties take the smallest code."""
    amount = F.coalesce(dec("monto_linea"), F.expr(ZERO))
    return items.where("cpc is not null").groupBy("ocid").agg(F.min(F.struct((-amount).alias("m"), "cpc")).alias("x")).select("ocid", "x.cpc")


_LARGEST = """select ocid, cpc from (select ocid, cpc, row_number() over (partition by ocid order by coalesce(cast(monto_linea as decimal(18,4)), 0) desc, cpc) r from proceso_item where cpc is not null) where r = 1"""


@query(_LARGEST)
def d05_dominant_code(spark, sf):
    return largest_line_code(table(spark, sf, "proceso_item").select("ocid", "cpc", "monto_linea"))


@query(f"""with d as ({_LARGEST}) select fila_id, d.cpc from proceso_resumen p join d using (ocid) where p.cpc is null""")
def x02_codes_from_items(spark, sf):
    """Codes that rows without one get from the largest line of their process."""
    r = table(spark, sf, "proceso_resumen").where("cpc is null").select("fila_id", "ocid")
    return r.join(largest_line_code(table(spark, sf, "proceso_item").select("ocid", "cpc", "monto_linea")), "ocid").select("fila_id", "cpc")


def code_by_amount(items: DataFrame) -> DataFrame:
    """(ocid, cpc, peso): the code with most money; award lines, if there are any, decide alone."""
    w = F.when(dec("precio_unitario", 6) != 0, dec("precio_unitario", 6)).otherwise(F.lit("0.000001").cast("decimal(18,6)"))
    d = items.where("ocid is not null and cpc <> ''").groupBy("ocid", (F.col("origen") == "award").alias("a"), "cpc").agg(F.sum(w).alias("w"))
    d = d.withColumn("a", F.coalesce("a", F.lit(False)))
    best = d.groupBy("ocid").agg(F.min(F.struct((~F.col("a")).alias("a"), (-F.col("w")).alias("w"), "cpc")).alias("x"))
    return best.select("ocid", "x.cpc", (-F.col("x.w")).cast("double").alias("peso"))


_D9 = """w as (select ocid, coalesce(origen = 'award', false) a, cpc, sum(case when cast(precio_unitario as decimal(18,6)) <> 0 then cast(precio_unitario as decimal(18,6)) else 0.000001 end) w from proceso_item where ocid is not null and cpc <> '' group by all), d9 as (select ocid, cpc, cast(w as double) peso from (select *, row_number() over (partition by ocid order by a desc, w desc, cpc) r from w) where r = 1)"""


@query(f"""with {_D9} select * from d9""")
def d09_code_by_amount(spark, sf):
    return code_by_amount(table(spark, sf, "proceso_item").select("ocid", "origen", "cpc", "precio_unitario"))


@query(f"""with {_CHOSEN}, s as (select ocid, anio, trim(cpc) cpc, sum(cast(monto_linea as decimal(18,4))) m from ch where monto_linea is not null and trim(cpc) <> '' group by all) select ocid, anio, cpc, cast(m as double) monto from (select *, row_number() over (partition by ocid, anio order by m desc, cpc) r from s) where r = 1""")
def d10_code_by_lines(spark, sf):
    """The code with the largest sum of line totals of a process in a year."""
    i = table(spark, sf, "proceso_item").select("ocid", "anio", "origen", "cpc", "monto_linea").where("ocid is not null")
    return lines_by_code(single_origin(i, annual=True)).select("ocid", "anio", "cpc", F.col("m").cast("double").alias("monto"))


def lines_by_code(chosen: DataFrame) -> DataFrame:
    """(ocid, anio, cpc, m): code with the largest sum, ties the smallest code."""
    s = chosen.where("monto_linea is not null").select("ocid", "anio", filled("cpc").alias("cpc"), "monto_linea").where("cpc is not null").groupBy("ocid", "anio", "cpc").agg(F.sum(dec("monto_linea")).alias("m"))
    return s.groupBy("ocid", "anio").agg(F.min(F.struct((-F.col("m")).alias("m"), "cpc")).alias("x")).select("ocid", "anio", "x.cpc", (-F.col("x.m")).alias("m"))


_NODE = "case when left({c}, 5) in (select codigo from cpc_nivel where length(codigo) = 5) then left({c}, 5) when left({c}, 4) in (select codigo from cpc_nivel where length(codigo) = 4) then left({c}, 4) end"


@query(f"""select item_fila, {_NODE.format(c='cpc')} nodo from proceso_item""")
def f14_nodes_of_codes(spark, sf):
    return rel.in_tree(table(spark, sf, "proceso_item").select("item_fila", "cpc"), table(spark, sf, "cpc_nivel"), "cpc").select("item_fila", "nodo")


@query(f"""select fila_id, {_NODE.format(c='cpc')} nodo, cpc_nodo is not distinct from {_NODE.format(c='cpc')} igual from proceso_resumen""")
def x01_assigned_nodes(spark, sf):
    """The node every row should carry, and whether it does."""
    d = rel.in_tree(table(spark, sf, "proceso_resumen").select("fila_id", "cpc", "cpc_nodo"), table(spark, sf, "cpc_nivel"), "cpc")
    return d.select("fila_id", "nodo", F.col("cpc_nodo").eqNullSafe(F.col("nodo")).alias("igual"))


# Exact quantiles per group


@query(f"""with h as (select distinct * from hecho_mes), c as (select anio, mes, comprador_ruc, proveedor_ruc, metodo, sum(cast(referencial as decimal(18,4))) r, sum(cast(adjudicado as decimal(18,4))) a from h where metodo <> '' and anio * 12 + mes <= {CUTOFF} group by all), x as (select metodo, anio, cast(a as double) / cast(r as double) x from c where r > 0 and a > 0), o as (select *, row_number() over (partition by metodo, anio order by x) - 1 i, count(*) over (partition by metodo, anio) n from x where x <= 1.5)
select metodo, anio, n, round(max(x) filter (i = n // 4), 6) p25, round(max(x) filter (i = (3 * n) // 4), 6) p75, round(median(x), 6) mediana from o where n >= 5 group by metodo, anio, n""")
def g04_ratio_quantiles(spark, sf):
    """Awarded over reference amount of the cells of the cube; above 1.5 it is an error of capture."""
    h = table(spark, sf, "hecho_mes").distinct().where(settled() & (F.col("metodo") != ""))
    c = h.groupBy("anio", "mes", "comprador_ruc", "proveedor_ruc", "metodo").agg(F.sum(dec("referencial")).alias("r"), F.sum(dec("adjudicado")).alias("a"))
    x = c.where("r > 0 and a > 0").select("metodo", "anio", (F.col("a").cast("double") / F.col("r").cast("double")).alias("x")).where("x <= 1.5")
    q = rel.quantiles(rel.value_counts(x, ["metodo", "anio"], "x"), ["metodo", "anio"], index={"p25": "n div 4", "p75": "3 * n div 4"}, between={"mediana": 0.5})
    return q.where("n >= 5").select("metodo", "anio", "n", *[F.round(c, 6).alias(c) for c in ("p25", "p75", "mediana")])


def _prices(i: DataFrame) -> DataFrame:
    d = i.where("precio_unitario > 0 and cpc <> '' and anio is not null").select("cpc", "anio", filled("unidad").alias("unidad"), F.col("precio_unitario").alias("x"))
    return d.where("unidad is not null")


_AT = {f"p{q}": f"least(cast(floor(n * {q / 100}D) as bigint), n - 1)" for q in (10, 25, 75, 90)}
_AT_SQL = ", ".join(f"max(x) filter (i = least(cast(floor(n * {q / 100}::double) as bigint), n - 1)) p{q}" for q in (10, 25, 75, 90))
_G7 = f"""p as (select cpc, anio, trim(unidad) unidad, precio_unitario x from proceso_item where precio_unitario > 0 and cpc <> '' and anio is not null and trim(unidad) <> ''), o as (select *, row_number() over (partition by cpc, anio, unidad order by x) - 1 i, count(*) over (partition by cpc, anio, unidad) n from p), g7 as (select cpc, anio, left(unidad, 40) unidad, n, {_AT_SQL}, round(median(x), 6) mediana, min(x) minimo, max(x) maximo from o where n >= 5 group by cpc, anio, o.unidad, n)"""


@query(f"""with {_G7} select * from g7""")
def g07_value_quantiles(spark, sf):
    """Price distribution per code, year and whole unit text (G7); the unit is cut after grouping."""
    keys = ["cpc", "anio", "unidad"]
    counts = rel.value_counts(_prices(table(spark, sf, "proceso_item")), keys, "x")
    ends = {"minimo": "0L", "maximo": "n - 1"}
    q = rel.quantiles(counts, keys, index={**_AT, **ends}, between={"mediana": 0.5}).where("n >= 5")
    return q.select("cpc", "anio", F.left("unidad", F.lit(40)).alias("unidad"), "n", *_AT, F.round("mediana", 6).alias("mediana"), "minimo", "maximo")


@query(f"""with {_G7}, pr as (select cpc, descripcion from (select cpc, descripcion, row_number() over (partition by cpc order by item_fila) r from proceso_item where cpc is not null) where r = 1) select g7.cpc, anio, unidad, n, mediana, descripcion from g7 left join pr using (cpc)""")
def j07_prices_with_products(spark, sf):
    """Prices with the first description of their code."""
    first = rel.first_by(table(spark, sf, "proceso_item").where("cpc is not null").select("cpc", "item_fila", "descripcion"), ["cpc"], ["item_fila"]).select("cpc", "descripcion")
    return g07_value_quantiles(spark, sf).select("cpc", "anio", "unidad", "n", "mediana").join(first, "cpc", "left")


@query(f"""with {_CHOSEN}, p as (select trim(cpc) cpc, anio, left(trim(unidad), 40) unidad, precio_unitario x from ch where precio_unitario > 0 and trim(cpc) <> '' and trim(unidad) <> '' and monto_linea is not null), o as (select *, row_number() over (partition by cpc, anio, unidad order by x) - 1 i, count(*) over (partition by cpc, anio, unidad) n from p)
select cpc, anio, unidad, n, max(x) filter (i = least(cast(floor(n * 0.25::double) as bigint), n - 1)) p25, max(x) filter (i = least(cast(floor(n * 0.75::double) as bigint), n - 1)) p75, round(median(x), 6) mediana from o where n >= 10 group by cpc, anio, unidad, n""")
def g14_value_year(spark, sf):
    i = table(spark, sf, "proceso_item").select("ocid", "anio", "origen", "cpc", "unidad", "precio_unitario", "monto_linea").where("ocid is not null")
    d = single_origin(i, annual=True).where("precio_unitario > 0 and monto_linea is not null")
    d = d.select(filled("cpc").alias("cpc"), "anio", F.left(filled("unidad"), F.lit(40)).alias("unidad"), F.col("precio_unitario").alias("x")).where("cpc is not null and unidad is not null")
    keys = ["cpc", "anio", "unidad"]
    q = rel.quantiles(rel.value_counts(d, keys, "x"), keys, index={k: _AT[k] for k in ("p25", "p75")}, between={"mediana": 0.5}).where("n >= 10")
    return q.select(*keys, "n", "p25", "p75", F.round("mediana", 6).alias("mediana"))


# The tree


_BASE = f"b as (select *, anio * 12 + mes <= {CUTOFF} cerrado, anio * 12 + mes <= {CUTOFF} and adjudicado > 0 ok from proceso_resumen)"
_TREE = f"{_BASE}, e as (select left(cpc_nodo, k) nodo, b.* from b, generate_series(1, 5) g(k) where length(cpc_nodo) >= k)"
_G10 = f"""{_TREE}, a as (select nodo, count(*) filter (ok) n, cast(sum(cast(adjudicado as decimal(18,4))) filter (ok) as double) monto, round(quantile_cont(adjudicado, 0.5) filter (ok), 6) mediana, round(quantile_cont(adjudicado, 0.25) filter (ok), 6) p25, round(quantile_cont(adjudicado, 0.75) filter (ok), 6) p75, count(distinct comprador_ruc) filter (ok) compradores, count(distinct proveedor_ruc) filter (ok) proveedores, round(quantile_cont(n_oferentes, 0.5) filter (cerrado and n_oferentes is not null), 6) mediana_oferentes, count(*) filter (cerrado and n_oferentes = 1) un_oferente, count(*) filter (cerrado and n_oferentes is not null) con_oferentes, round(quantile_cont(adjudicado / referencial, 0.5) filter (ok and referencial > 0), 6) baja_mediana, count(*) filter (estado in ('planificacion', 'abierto')) abiertos from e group by nodo),
g10 as (select codigo, nivel, padre, coalesce(n, 0) n, coalesce(monto, 0) monto, mediana, p25, p75, coalesce(compradores, 0) compradores, coalesce(proveedores, 0) proveedores, mediana_oferentes, coalesce(un_oferente, 0) un_oferente, coalesce(con_oferentes, 0) con_oferentes, baja_mediana, coalesce(abiertos, 0) abiertos from cpc_nivel left join a on codigo = nodo
union all select '{UNCLASSIFIED}', 0, null, count(*) filter (ok), coalesce(cast(sum(cast(adjudicado as decimal(18,4))) filter (ok) as double), 0), round(quantile_cont(adjudicado, 0.5) filter (ok), 6), null, null, count(distinct comprador_ruc) filter (ok), count(distinct proveedor_ruc) filter (ok), null, 0, 0, null, count(*) filter (estado in ('planificacion', 'abierto')) from b where cpc_nodo is null)"""


def node_facts(r: DataFrame) -> DataFrame:
    """(nodo, measures) of every level; rows without node under UNCLASSIFIED."""
    ok = F.coalesce(settled() & (F.col("adjudicado") > 0), F.lit(False))
    r = r.select("cpc_nodo", "comprador_ruc", "proveedor_ruc", "adjudicado", "referencial", "n_oferentes", "estado", ok.alias("ok"), F.coalesce(settled(), F.lit(False)).alias("cerrado"))
    bidders = F.col("cerrado") & F.col("n_oferentes").isNotNull()

    def levels(d: DataFrame) -> DataFrame:
        return rel.prefix_levels(d, "cpc_nodo", 5).withColumn("nodo", F.when(F.col("cpc_nodo").isNull(), UNCLASSIFIED).otherwise(F.col("nodo"))).where("nodo is not null")

    sums = {"n": F.count_if("ok"), "monto": F.sum(F.when(F.col("ok"), dec("adjudicado"))), "un_oferente": F.count_if(bidders & (F.col("n_oferentes") == 1)), "con_oferentes": F.count_if(bidders), "abiertos": F.count_if(F.col("estado").isin("planificacion", "abierto"))}
    added = levels(r.groupBy("cpc_nodo").agg(*[c.alias(n) for n, c in sums.items()])).groupBy("nodo").agg(*[F.sum(n).alias(n) for n in sums])
    roles = F.array(F.struct(F.lit(True).alias("compra"), F.col("comprador_ruc").alias("ruc")), F.struct(F.lit(False).alias("compra"), F.col("proveedor_ruc").alias("ruc")))
    parties = r.where("ok").select("cpc_nodo", F.explode(roles).alias("x")).select("cpc_nodo", "x.*").where("ruc is not null").distinct()
    parties = levels(parties).select("nodo", "compra", "ruc").distinct().groupBy("nodo").agg(F.count_if("compra").alias("compradores"), F.count_if(~F.col("compra")).alias("proveedores"))
    values = {"adj": F.when(F.col("ok"), F.col("adjudicado")), "of": F.when(F.col("cerrado"), F.col("n_oferentes").cast("double")), "baja": F.when(F.col("ok") & (F.col("referencial") > 0), F.col("adjudicado") / F.col("referencial"))}
    long = r.select("cpc_nodo", F.explode(F.array(*[F.struct(F.lit(k).alias("medida"), v.alias("x")) for k, v in values.items()])).alias("m")).select("cpc_nodo", "m.*")
    counts = levels(rel.value_counts(long, ["cpc_nodo", "medida"], "x"))
    q = rel.quantiles(rel.value_counts(counts, ["nodo", "medida"], "__v", "__n"), ["nodo", "medida"], between={"p25": 0.25, "p50": 0.5, "p75": 0.75})
    of = lambda m, c: F.round(F.max(F.when(F.col("medida") == m, F.col(c))), 6)
    q = q.groupBy("nodo").agg(of("adj", "p50").alias("mediana"), of("adj", "p25").alias("p25"), of("adj", "p75").alias("p75"), of("of", "p50").alias("mediana_oferentes"), of("baja", "p50").alias("baja_mediana"))
    return added.join(parties, "nodo", "left").join(q, "nodo", "left").withColumn("monto", F.col("monto").cast("double"))


@query(f"""with {_G10} select * from g10""")
def g10_tree(spark, sf):
    """Every node of the tree with its facts, zeros for empty ones, and the unclassified rest."""
    facts = node_facts(table(spark, sf, "proceso_resumen")).withColumnRenamed("nodo", "codigo")
    zero = ["n", "monto", "compradores", "proveedores", "un_oferente", "con_oferentes", "abiertos"]
    tree = table(spark, sf, "cpc_nivel").select("codigo", "nivel", "padre")
    rest = spark.createDataFrame([(UNCLASSIFIED, 0, None)], "codigo string, nivel int, padre string")
    d = rel.left_tree(tree.unionByName(rest), facts, "codigo", zero)
    bucket = F.col("codigo") == UNCLASSIFIED
    none = {c: F.when(~bucket, F.col(c)) for c in ("p25", "p75", "mediana_oferentes", "baja_mediana")}
    return d.withColumns({**none, **{c: F.when(bucket, 0).otherwise(F.col(c)) for c in ("un_oferente", "con_oferentes")}}).select("codigo", "nivel", "padre", "n", "monto", "mediana", "p25", "p75", "compradores", "proveedores", "mediana_oferentes", "un_oferente", "con_oferentes", "baja_mediana", "abiertos")


@query(f"""with {_G10} select codigo, nivel, n, monto from g10 where nivel in (0, 1)""")
def o02_market_index(spark, sf):
    """Sections and the unclassified rest, largest amount first (O2)."""
    return g10_tree(spark, sf).where("nivel in (0, 1)").select("codigo", "nivel", "n", "monto").orderBy(F.desc("monto"), "codigo")


def children_by_amount(tree: DataFrame, parent: str) -> DataFrame:
    """The children of a node, largest amount first."""
    return tree.where(F.col("padre") == parent).orderBy(F.desc("monto"), "codigo")


@query(f"""with {_G10} select codigo, n, monto from g10 where padre = '2'""")
def o05_children(spark, sf):
    return children_by_amount(g10_tree(spark, sf), "2").select("codigo", "n", "monto")


def node_party(r: DataFrame, party: str, other: str) -> DataFrame:
    """(nodo, ruc, n, monto, otros): a party's settled awards per node."""
    d = r.where(settled() & (F.col("adjudicado") > 0) & F.col(party).isNotNull() & (F.length("cpc_nodo") > 0))
    d = d.groupBy("cpc_nodo", F.col(party).alias("ruc"), F.col(other).alias("otro")).agg(F.count(F.lit(1)).alias("n"), F.sum(dec("adjudicado")).alias("m"))
    d = rel.prefix_levels(d, "cpc_nodo", 5).groupBy("nodo", "ruc", "otro").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    return d.groupBy("nodo", "ruc").agg(F.sum("n").alias("n"), F.sum("m").cast("double").alias("monto"), F.count("otro").alias("otros"))


_G12 = "with " + _TREE + " select nodo, {a} ruc, count(*) n, cast(sum(cast(adjudicado as decimal(18,4))) as double) monto, count(distinct {b}) otros from e where ok and {a} is not null group by all"


@query(_G12.format(a="proveedor_ruc", b="comprador_ruc"))
def g12_node_supplier(spark, sf):
    return node_party(table(spark, sf, "proceso_resumen"), "proveedor_ruc", "comprador_ruc")


@query(_G12.format(a="comprador_ruc", b="proveedor_ruc"))
def g12_node_buyer(spark, sf):
    return node_party(table(spark, sf, "proceso_resumen"), "comprador_ruc", "proveedor_ruc")


_G13 = f"""{_CHOSEN}, lin as (select ocid, anio, sum(cast(monto_linea as decimal(18,4))) m from ch where monto_linea is not null group by all having m > 0), cod as (select ocid, anio, cpc from (select ocid, anio, trim(cpc) cpc, row_number() over (partition by ocid, anio order by sum(cast(monto_linea as decimal(18,4))) desc, trim(cpc)) r from ch where monto_linea is not null and trim(cpc) <> '' group by ocid, anio, trim(cpc)) where r = 1), p as (select lin.ocid, lin.anio, m, {_NODE.format(c='cpc')} n5 from lin left join cod on lin.ocid = cod.ocid and lin.anio is not distinct from cod.anio), ex as (select left(n5, k) codigo, p.* from p, generate_series(1, 5) g(k) where length(n5) >= k union all select '{UNCLASSIFIED}', p.* from p where n5 is null), bu as (select ocid, anio, comprador_ruc from (select ocid, anio, comprador_ruc, row_number() over (partition by ocid, anio order by mes desc, fila_id desc) r from proceso_resumen) where r = 1 and comprador_ruc <> ''), wi as (select distinct ocid, anio, proveedor_ruc from proceso_resumen where proveedor_ruc <> '')"""


@query(f"""with {_G13}, a as (select codigo, anio, count(*) n, cast(round(sum(m), 2) as double) monto, round(median(cast(m as double)), 6) mediana from ex group by all), c as (select codigo, ex.anio, count(distinct comprador_ruc) compradores from ex join bu using (ocid, anio) group by all), w as (select codigo, ex.anio, count(distinct proveedor_ruc) ganadores from ex join wi using (ocid, anio) group by all) select a.*, coalesce(compradores, 0) compradores, coalesce(ganadores, 0) ganadores from a left join c using (codigo, anio) left join w using (codigo, anio)""")
def g13_node_year(spark, sf):
    """Amounts, buyers and winners of every node and year, from the chosen lines of each process; a
    process counts under the node of its dominant code, or as unclassified (G13)."""
    i = table(spark, sf, "proceso_item").select("ocid", "anio", "origen", "cpc", "monto_linea").where("ocid is not null and anio is not null")
    # both origins are added up side by side, so the choice of P10 needs no join
    line = dec("monto_linea")
    award, tender = F.when((F.col("origen") == "award") & (F.col("monto_linea") > 0), line), F.when(F.col("origen") == "tender", line)
    per = i.groupBy("ocid", "anio", filled("cpc").alias("cpc")).agg(F.sum(award).alias("a"), F.sum(tender).alias("t"))
    best = lambda c: F.min(F.when(F.col("cpc").isNotNull() & F.col(c).isNotNull(), F.struct((-F.col(c)).alias("m"), "cpc")))["cpc"]
    p = per.groupBy("ocid", "anio").agg(F.sum("a").alias("a"), F.sum("t").alias("t"), best("a").alias("ca"), best("t").alias("ct"))
    p = p.select("ocid", "anio", F.coalesce("a", "t").alias("m"), F.when(F.col("a").isNotNull(), F.col("ca")).otherwise(F.col("ct")).alias("cpc")).where("m > 0")
    p = rel.in_tree(p, table(spark, sf, "cpc_nivel"), "cpc", "n5")
    r = table(spark, sf, "proceso_resumen").select("ocid", "anio", "mes", "fila_id", "comprador_ruc", "proveedor_ruc").where("ocid is not null")
    who = r.groupBy("ocid", "anio").agg(F.max(F.struct("mes", "fila_id", F.nullif("comprador_ruc", F.lit("")).alias("c")))["c"].alias("comprador"), F.collect_set(F.nullif("proveedor_ruc", F.lit(""))).alias("ganadores"))  # rows of one process and year
    ensure_checkpoint_dir(spark)
    p = p.join(who, ["ocid", "anio"], "left").select("n5", "anio", "m", "comprador", "ganadores").checkpoint()  # a row per process, read three times below
    keys = ["codigo", "anio"]
    full = lambda d: rel.prefix_levels(d, "n5", 5).withColumn("codigo", F.coalesce("nodo", F.lit(UNCLASSIFIED))).drop("nivel", "nodo")
    a = full(p.groupBy("n5", "anio").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"))).groupBy(*keys).agg(F.sum("n").alias("n"), F.round(F.sum("m"), 2).cast("double").alias("monto"))
    roles = F.concat(F.array(F.struct(F.lit(True).alias("compra"), F.col("comprador").alias("ruc"))), F.transform(F.coalesce("ganadores", F.array().cast("array<string>")), lambda x: F.struct(F.lit(False).alias("compra"), x.alias("ruc"))))
    parties = p.select("n5", "anio", F.explode(roles).alias("x")).select("n5", "anio", "x.*").where("ruc is not null").distinct()
    parties = full(parties).select(*keys, "compra", "ruc").distinct().groupBy(*keys).agg(F.count_if("compra").alias("compradores"), F.count_if(~F.col("compra")).alias("ganadores"))
    counts = full(rel.value_counts(p.withColumn("x", F.col("m").cast("double")), ["n5", "anio"], "x"))
    q = rel.quantiles(rel.value_counts(counts, keys, "__v", "__n"), keys, between={"mediana": 0.5}).select(*keys, F.round("mediana", 6).alias("mediana"))
    return a.join(q, keys).join(parties, keys, "left").select(*keys, "n", "monto", "mediana", F.coalesce("compradores", F.lit(0)).alias("compradores"), F.coalesce("ganadores", F.lit(0)).alias("ganadores"))


@query(f"""with {_G13}, y as (select anio, count(distinct codigo) nodos from ex group by anio) select anio, nodos, nodos > 100 bien from y""")
def v07_nodes_per_year(spark, sf):
    """Years with enough nodes to be published (V7)."""
    y = g13_node_year(spark, sf).groupBy("anio").agg(F.count(F.lit(1)).alias("nodos"))
    return y.withColumn("bien", F.col("nodos") > 100)


_G17 = "select {a} ruc, c.codigo, c.descripcion, count(*) n, cast(sum(cast(adjudicado as decimal(18,4))) as double) monto, count(distinct {b}) otros from proceso_resumen r join cpc_nivel c on r.cpc_nodo = c.codigo where estado in ('adjudicado', 'cerrado') and {a} is not null group by all"


def party_node(spark, sf, party: str, other: str) -> DataFrame:
    r = table(spark, sf, "proceso_resumen").where(F.col("estado").isin("adjudicado", "cerrado") & F.col(party).isNotNull() & F.col("cpc_nodo").isNotNull())
    # facts first: the descriptions are joined to groups and not to rows
    d = r.groupBy(F.col(party).alias("ruc"), F.col("cpc_nodo").alias("codigo"), F.col(other).alias("otro")).agg(F.count(F.lit(1)).alias("n"), F.sum(dec("adjudicado")).alias("m"))
    d = d.groupBy("ruc", "codigo").agg(F.sum("n").alias("n"), F.sum("m").cast("double").alias("monto"), F.count("otro").alias("otros"))
    return d.join(table(spark, sf, "cpc_nivel").select("codigo", "descripcion"), "codigo").select("ruc", "codigo", "descripcion", "n", "monto", "otros")


@query(_G17.format(a="comprador_ruc", b="proveedor_ruc"))
def g17_buyer_node(spark, sf):
    return party_node(spark, sf, "comprador_ruc", "proveedor_ruc")


@query(_G17.format(a="proveedor_ruc", b="comprador_ruc"))
def g17_supplier_node(spark, sf):
    return party_node(spark, sf, "proveedor_ruc", "comprador_ruc")


@query("""with i as (select ocid, count(*) lineas, cast(sum(cast(monto_linea as decimal(18,4))) as double) monto from proceso_item where ocid is not null group by ocid), w as (select distinct ocid, trim(proveedor_ruc) ruc from proceso_resumen where trim(proveedor_ruc) <> '') select w.ruc, i.ocid, lineas, monto from i join w using (ocid)""")
def j03_lines_of_winners(spark, sf):
    """Lines of the processes of every winner; the lines are added up before they meet the winners."""
    i = table(spark, sf, "proceso_item").where("ocid is not null").groupBy("ocid").agg(F.count(F.lit(1)).alias("lineas"), money("monto_linea").alias("monto"))
    w = table(spark, sf, "proceso_resumen").select("ocid", filled("proveedor_ruc").alias("ruc")).where("ruc is not null").distinct()
    return i.join(w, "ocid").select("ruc", "ocid", "lineas", "monto")


# Names of groups


_GROUP = "case when length(regexp_replace(cpc, '\\D', '', 'g')) >= 3 then left(regexp_replace(cpc, '\\D', '', 'g'), 5) end"
_COUNTS = f"dc as (select {_GROUP} grupo, trim(descripcion) d, count(*) n from proceso_item where {_GROUP} is not null and descripcion <> '' group by all)"


def description_counts(items: DataFrame) -> DataFrame:
    """(grupo, d, n): how often each description occurs per code group."""
    d = items.select(scalars.code_prefix(F.col("cpc")).alias("grupo"), F.trim("descripcion").alias("d")).where("grupo is not null and d is not null and d <> ''")
    return d.groupBy("grupo", "d").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_D9} select ocid, {_GROUP} grupo from d9 where {_GROUP} is not null""")
def g20_process_groups(spark, sf):
    """The code group of every process, by its dominant code."""
    d = code_by_amount(table(spark, sf, "proceso_item").select("ocid", "origen", "cpc", "precio_unitario"))
    return d.select("ocid", scalars.code_prefix(F.col("cpc")).alias("grupo")).where("grupo is not null")


_NOISE_SQL = "(?i)\\b(n\\.?c\\.?p\\.?|excepto|incluidas?|inclusive|estos servicios|los siguientes|y otros|varios|otras?)\\b"
_F19 = f"""{_COUNTS}, top as (select grupo, d, total from (select *, row_number() over (partition by grupo order by n desc, d) r, sum(n) over (partition by grupo) total from dc) where r = 1), cl as (select *, trim(regexp_replace(regexp_replace(regexp_replace(d, '{_NOISE_SQL}', '', 'g'), '[.,;:].*$', ''), '\\s+', ' ', 'g')) t from top), f19 as (select grupo, total::bigint total, trim(left(case when (case when t = '' then left(d, 48) else t end) = upper(case when t = '' then left(d, 48) else t end) and upper(t) <> lower(t) then upper(left(t, 1)) || lower(substr(t, 2)) else case when t = '' then left(d, 48) else t end end, 48)) nombre from cl)"""


def group_names(counts: DataFrame) -> DataFrame:
    """(grupo, total, nombre): a short name from the most frequent description."""
    best = counts.groupBy("grupo").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("n"), "d"))["d"].alias("d"))
    return best.select("grupo", "total", text.fallback_name(F.col("d")).alias("nombre"))


@query(f"""with {_F19} select grupo, total, nombre from f19""")
def f19_group_names(spark, sf):
    return group_names(description_counts(table(spark, sf, "proceso_item")))


@query(f"""with {_COUNTS}, t as (select *, row_number() over (partition by grupo order by n desc, d) r from dc), u as (select *, row_number() over (partition by grupo, left(lower(d), 60) order by r) f from t where r <= 18), v as (select *, row_number() over (partition by grupo order by r) s from u where f = 1) select grupo, left(string_agg(d, ' · ' order by s), 900) texto from v where s <= 6 group by grupo""")
def f20_representative_text(spark, sf):
    """The six most frequent descriptions of a group that differ in their first 60 characters, among
    its first eighteen (F20).  Only these leave their tasks: the rank is limited on the map side."""
    w = Window.partitionBy("grupo").orderBy(F.desc("n"), "d")
    t = description_counts(table(spark, sf, "proceso_item")).withColumn("r", F.row_number().over(w)).where("r <= 18")
    u = t.groupBy("grupo", F.left(F.lower("d"), F.lit(60)).alias("k")).agg(F.min(F.struct("r", "d")).alias("x"))
    v = u.groupBy("grupo").agg(F.slice(F.sort_array(F.collect_list("x")), 1, 6).alias("x"))  # at most 18 of a group
    return v.select("grupo", F.left(F.array_join(F.transform("x", lambda e: e["d"]), " · "), F.lit(900)).alias("texto"))


_KEY_SQL = "array_to_string(list_sort(list_transform(list_filter(regexp_extract_all(translate(lower(nombre), 'áàäâãéèëêíìïîóòöôõúùüûñç', 'aaaaaeeeeiiiiooooouuuunc'), '[a-z]+'), lambda w: not list_contains(['de','del','la','el','los','las','y','para','en','con','a'], w)), lambda w: case when ends_with(w, 'es') and length(w) > 5 then left(w, length(w) - 2) when ends_with(w, 's') and length(w) > 4 then left(w, length(w) - 1) else w end)), ' ')"


def distinct_names(names: DataFrame, kept: DataFrame | None = None) -> DataFrame:
    """(grupo, nombre): one name per group; equal ones (F17) are told apart by the group's code.

    Groups in `kept` (grupo, nombre) keep their name; of the others the one with most rows goes first.
    """
    d = names.withColumn("viejo", F.lit(False))
    if kept is not None:
        d = d.join(kept.select("grupo"), "grupo", "left_anti").unionByName(kept.select("grupo", F.lit(0).cast("bigint").alias("total"), "nombre", F.lit(True).alias("viejo")))
    w = Window.partitionBy(text.name_key(F.col("nombre"))).orderBy(F.desc("viejo"), F.desc("total"), "grupo")
    d = d.withColumn("r", F.row_number().over(w))
    return d.select("grupo", F.when((F.col("r") > 1) & ~F.col("viejo"), F.concat("nombre", F.lit(" ("), "grupo", F.lit(")"))).otherwise(F.col("nombre")).alias("nombre"))


@query(f"""with {_F19} select grupo, case when r > 1 then nombre || ' (' || grupo || ')' else nombre end nombre from (select *, row_number() over (partition by {_KEY_SQL} order by total desc, grupo) r from f19)""")
def t07_distinct_names(spark, sf):
    return distinct_names(f19_group_names(spark, sf))


@query("""with p as (select cpc, descripcion, left(cpc, 5) s from (select cpc, descripcion, row_number() over (partition by cpc order by item_fila) r from proceso_item where cpc <> '') where r = 1) select cpc, p.descripcion, codigo subclase from p left join cpc_nivel on codigo = s""")
def s09_products(spark, sf):
    """The products that occur: first description of every code, and its subclass if there is one
    (D7, S9)."""
    p = rel.first_by(table(spark, sf, "proceso_item").where("cpc <> ''").select("cpc", "item_fila", "descripcion"), ["cpc"], ["item_fila"])
    tree = table(spark, sf, "cpc_nivel").select(F.col("codigo").alias("subclase"))
    return p.join(tree, F.left("cpc", F.lit(5)) == F.col("subclase"), "left").select("cpc", "descripcion", "subclase")


# Gates


@query("""with m as (select ocid, max(metodo) metodo from proceso_resumen group by ocid), j as (select i.cpc, i.anio, m.metodo from proceso_item i left join m using (ocid)) select count(*) lineas, count(*) filter (cpc <> '' and anio is not null and metodo is null) sin_metodo, count(*) filter (cpc <> '' and anio is not null and metodo is not null) utiles, sin_metodo <= 0.01 * lineas and utiles >= 0.5 * lineas bien from j""")
def v05_usable_lines(spark, sf):
    """Lines whose process has no method, usable lines, and whether prices may be published: at most
    1 % without method and at least half usable (V5, J2)."""
    m = table(spark, sf, "proceso_resumen").groupBy("ocid").agg(F.max("metodo").alias("metodo"))
    d = table(spark, sf, "proceso_item").select("ocid", "cpc", "anio").join(m, "ocid", "left")
    coded = (F.col("cpc") != "") & F.col("anio").isNotNull()
    d = d.agg(F.count(F.lit(1)).alias("lineas"), F.count_if(coded & F.col("metodo").isNull()).alias("sin_metodo"), F.count_if(coded & F.col("metodo").isNotNull()).alias("utiles"))
    return d.withColumn("bien", (F.col("sin_metodo") <= 0.01 * F.col("lineas")) & (F.col("utiles") >= 0.5 * F.col("lineas")))


@query("""select count(distinct ocid) filter (cpc_nodo is not null) clasificados, clasificados >= 1000 bien from proceso_resumen""")
def v06_classified(spark, sf):
    d = table(spark, sf, "proceso_resumen").where("cpc_nodo is not null").agg(F.countDistinct("ocid").alias("clasificados"))
    return d.withColumn("bien", F.col("clasificados") >= 1000)


@query("""select nivel, count(*) n, count(*) filter (length(codigo) <> nivel) largo_mal, count(*) filter (nivel > 1 and padre is distinct from left(codigo, length(codigo) - 1)) padre_mal, count(*) filter (nivel > 1 and padre not in (select codigo from cpc_nivel)) sin_padre, count(*) filter (length(coalesce(descripcion, '')) < 3) sin_nombre, count(*) - count(distinct codigo) repetidos from cpc_nivel group by nivel""")
def v03_tree_levels(spark, sf):
    """Nodes per level and how many break a rule of the tree (V3)."""
    return tree_report(table(spark, sf, "cpc_nivel"))


def tree_report(tree: DataFrame) -> DataFrame:
    known = tree.select(F.col("codigo").alias("__p")).distinct()
    d = tree.join(known, F.col("padre") == F.col("__p"), "left")
    below = F.col("nivel") > 1
    return d.groupBy("nivel").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.length("codigo") != F.col("nivel")).alias("largo_mal"),
        F.count_if(below & ~F.col("padre").eqNullSafe(F.expr("left(codigo, length(codigo) - 1)"))).alias("padre_mal"),
        F.count_if(below & F.col("padre").isNotNull() & F.col("__p").isNull()).alias("sin_padre"),
        F.count_if(F.length(F.coalesce("descripcion", F.lit(""))) < 3).alias("sin_nombre"), (F.count(F.lit(1)) - F.countDistinct("codigo")).alias("repetidos"),
    )


_ADD = "select h.padre codigo, cast(sum(cast(h.monto as decimal(18,4))) as double) hijos, p.monto, abs(p.monto - hijos) > 0.0001 mal from g10 h join g10 p on h.padre = p.codigo group by h.padre, p.monto"


@query(f"""with {_G10} {_ADD}""")
def j12_tree_additivity(spark, sf):
    """The amount of every node against the sum of its children's (J12); rows of nodes whose code ends
    above the fifth level stay with the parent, so these show up."""
    t = g10_tree(spark, sf).select("codigo", "padre", "monto")
    kids = t.where("padre is not null").groupBy(F.col("padre").alias("codigo")).agg(F.sum(dec("monto")).cast("double").alias("hijos"))
    return kids.join(t.select("codigo", "monto"), "codigo").select("codigo", "hijos", "monto", (F.abs(F.col("monto") - F.col("hijos")) > 0.0001).alias("mal"))


@query("""select distinct codigo from (select ocid, unnest(array_agg(distinct cpc_nodo)) codigo from proceso_resumen where cpc_nodo is not null group by ocid) where codigo not in (select codigo from cpc_nivel where codigo is not null)""")
def j11_unknown_nodes(spark, sf):
    """Elements of a list of nodes that the tree does not have."""
    nodes = table(spark, sf, "proceso_resumen").where("cpc_nodo is not null").groupBy("ocid").agg(F.collect_set("cpc_nodo").alias("x"))
    return rel.difference(nodes.select(F.explode("x").alias("codigo")).distinct(), table(spark, sf, "cpc_nivel"), ["codigo"])


@query("""select distinct ocid from proceso_foto where ocid is not null and ocid not in (select ocid from proceso_resumen where ocid is not null)""")
def u02_unknown_processes(spark, sf):
    """Processes of the snapshots that no delivery has."""
    return rel.difference(table(spark, sf, "proceso_foto").select("ocid").where("ocid is not null").distinct(), table(spark, sf, "proceso_resumen"), ["ocid"])


@query("""select distinct codigo from mercado_nodo where codigo not in (select cpc_nodo from proceso_resumen where cpc_nodo is not null)""")
def u04_pruned_nodes(spark, sf):
    """Published nodes that a new delivery no longer has (U4)."""
    return rel.difference(table(spark, sf, "mercado_nodo").select("codigo").distinct(), table(spark, sf, "proceso_resumen").select(F.col("cpc_nodo").alias("codigo")).where("codigo is not null"), ["codigo"])


@query(f"""select count(*) n, cast(sum(cast(referencial as decimal(18,4))) as double) monto, count(*) filter (estado = 'abierto') abiertos, count(*) filter (cierra is not null) con_cierre, count(*) filter (referencial > 0) con_monto from proceso_resumen where estado in ('abierto', 'planificacion')""")
def g15_open_header(spark, sf):
    """One row over the same rows a list of open processes shows."""
    d = table(spark, sf, "proceso_resumen").where(F.col("estado").isin("abierto", "planificacion"))
    return d.agg(F.count(F.lit(1)).alias("n"), money("referencial").alias("monto"), F.count_if(F.col("estado") == "abierto").alias("abiertos"), F.count("cierra").alias("con_cierre"), F.count_if(F.col("referencial") > 0).alias("con_monto"))


@query("""select item_fila, unidad from proceso_item where regexp_matches(unidad, '^[A-Z0-9]+-[A-Z0-9-]+$') or not contains(unidad, ' ')""")
def sel13_code_like(spark, sf):
    """Texts that look like a code."""
    return table(spark, sf, "proceso_item").select("item_fila", "unidad").where(scalars.looks_like_code(F.col("unidad")))


@query("""select distinct ocid, regexp_replace(case when starts_with(ocid, 'ocds-9zq7xk-') then substr(ocid, 13) else ocid end, '-[^-]*$', '') codigo from proceso_resumen where ocid is not null""")
def f26_process_codes(spark, sf):
    d = table(spark, sf, "proceso_resumen").where("ocid is not null").select("ocid").distinct()
    return d.select("ocid", scalars.process_code(F.col("ocid"), "ocds-9zq7xk").alias("codigo"))


@query("""with i as (select anio, mes, count(*) lineas from proceso_item where anio is not null and mes is not null group by all), p as (select distinct anio, mes from proceso_resumen where metodo = 'Licitación de Seguros' and estado = 'abierto') select i.anio, i.mes, lineas from i left join p using (anio, mes) where p.anio is null""")
def s06_orphan_months(spark, sf):
    """Months with lines but without a process of one kind (the gate S6 asks for any process)."""
    p = table(spark, sf, "proceso_resumen").where("metodo = 'Licitación de Seguros' and estado = 'abierto'")
    return rel.orphan_months(table(spark, sf, "proceso_item"), p)
