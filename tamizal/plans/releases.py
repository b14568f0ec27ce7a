"""Tables of the nested release records, each query with the SQL that defines it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import relational as rel
from ..operators import releases as ops
from ..session import table
from .registry import QUERIES, RELEASES_SQL, SQL, json_objects, number_sql, query, tax_id_sql

__all__ = ["QUERIES", "SQL"]


def _state(r: str) -> str:
    each = [("contract", "cerrado"), ("award", "adjudicado"), ("tender", "abierto"), ("planning", "planificacion")]
    listed = " ".join(f"when list_contains(t, '{tag}') then '{state}'" for tag, state in each)
    alone = " ".join(f"when '{tag}' then '{state}'" for tag, state in each)
    return f"case when json_type({r}, '$.tag') = 'ARRAY' then (case {listed} else 'desconocido' end) else (case {r} ->> '$.tag' {alone} else 'desconocido' end) end"


_METHOD = "nullif(trim(split_part(r ->> '$.tender.procurementMethodDetails', ' en el convenio', 1)), '')"


def release_table(spark, sf) -> DataFrame:
    return ops.release_rows(table(spark, sf, "detalle_mes"), row="reg_id", text="registro", keep=["anio", "mes"])


@query(f"""with {RELEASES_SQL}, x as (select *, list_transform(json_extract(r, '$.tag[*]'), lambda z: z ->> '$') t from rel) select reg_id, pos, ocid, {_state('r')} estado, {_METHOD} metodo, r ->> '$.tender.title' titulo, r ->> '$.tender.description' objeto, coalesce(nullif({number_sql("(r ->> '$.tender.value.amount')")}, 0), {number_sql("(r ->> '$.planning.budget.amount.amount')")}) referencial, {number_sql("(r ->> '$.tender.numberOfTenderers')")}::bigint n_oferentes, r ->> '$.tender.mainProcurementCategory' categoria_ocds, r ->> '$.tender.awardCriteria' criterio, r ->> '$.planning.budget.id' partida, r ->> '$.planning.rationale' justificacion, {tax_id_sql("(r ->> '$.buyer.id')")} comprador_ruc, left(coalesce(r ->> '$.date', ''), 10) fecha from x""")
def t01_release_processes(spark, sf):
    return ops.processes(release_table(spark, sf))


_ITEMS = f"""it as (select reg_id, pos, ocid, 'tender' origen, unnest({json_objects("(r -> '$.tender.items')")}) o from rel union all select reg_id, pos, ocid, 'award', unnest({json_objects("(a -> '$.items')")}) from (select reg_id, pos, ocid, unnest({json_objects("(r -> '$.awards')")}) a from rel))"""


@query(f"""with {RELEASES_SQL}, {_ITEMS} select reg_id, pos, ocid, origen, o ->> '$.id' item_id, o ->> '$.classification.id' cpc, o ->> '$.description' descripcion, {number_sql("(o ->> '$.quantity')")} cantidad, o ->> '$.unit.name' unidad, {number_sql("(o ->> '$.unit.value.amount')")} precio_unitario, o ->> '$.unit.value.currency' moneda from it""")
def t01_release_items(spark, sf):
    return ops.items(release_table(spark, sf))


@query(f"""with {RELEASES_SQL}, w as (select reg_id, pos, list({tax_id_sql("(s ->> '$.id')")}) w from (select reg_id, pos, unnest({json_objects("(a -> '$.suppliers')")}) s from (select reg_id, pos, unnest({json_objects("(r -> '$.awards')")}) a from rel)) group by reg_id, pos), x as (select reg_id, pos, ocid, {tax_id_sql("(o ->> '$.id')")} ruc, o ->> '$.name' nombre from (select reg_id, pos, ocid, unnest({json_objects("(r -> '$.tender.tenderers')")}) o from rel)) select x.*, coalesce(list_contains(w, ruc), false) gano from x left join w using (reg_id, pos)""")
def t01_release_bidders(spark, sf):
    return ops.bidders(release_table(spark, sf))


@query(f"""with {RELEASES_SQL}, x as (select reg_id, pos, ocid, unnest({json_objects("(r -> '$.tender.enquiries')")}) o from rel) select reg_id, pos, ocid, o ->> '$.id' consulta_id, left(o ->> '$.date', 19) fecha, {tax_id_sql("(o ->> '$.author.id')")} autor_ruc, o ->> '$.author.name' autor, nullif(left(o ->> '$.description', 2000), '') pregunta, nullif(left(o ->> '$.answer', 2000), '') respuesta, nullif(left(o ->> '$.dateAnswered', 19), '') fecha_respuesta from x""")
def t01_release_enquiries(spark, sf):
    return ops.enquiries(release_table(spark, sf))


@query(f"""with {RELEASES_SQL}, x as (select reg_id, pos, ocid, unnest({json_objects("(r -> '$.tender.lots')")}) o from rel) select reg_id, pos, ocid, o ->> '$.id' lote_id, o ->> '$.title' titulo, {number_sql("(o ->> '$.value.amount')")} monto, case when json_type(o, '$.techniques') = 'OBJECT' then array_to_string(list_sort(json_keys(o, '$.techniques')), ',') end tecnicas from x""")
def t01_release_lots(spark, sf):
    return ops.lots(release_table(spark, sf))


@query()
def t01_release_bids(spark, sf):
    """Bids of auctions; the test tables hold none, the tests do."""
    return ops.bids(release_table(spark, sf))


@query()
def t01_release_parties(spark, sf):
    """Parties with their territory; the test tables hold none, the tests do."""
    return ops.parties(release_table(spark, sf))


def _normalised(d: DataFrame) -> dict[str, DataFrame]:
    """The tables of a month's file, made of the nested records."""
    keys = ["anio", "mes", "ocid"]
    d = d.withColumn("orden", F.col("reg_id") * 1000 + F.col("pos"))
    f = ops._field
    award = d.select(*keys, "orden", F.posexplode(ops._objects(F.col("awards"))).alias("k", "a"))
    supplier = award.select(*keys, (F.col("orden") * 1000 + F.col("k")).alias("__o"), F.posexplode(ops._objects(f("a", "suppliers"))).alias("j", "s"))
    return {
        "releases": d.select(*keys, "orden", F.col("date").alias("fecha"), "tag", f("buyer", "id").alias("buyer_id")),
        "tender": d.where(F.trim("tender").startswith("{")).select(*keys, "orden", *[f("tender", p).alias(n) for n, p in {"procurementMethodDetails": "procurementMethodDetails", "value_amount": "value.amount", "title": "title", "description": "description", "numberOfTenderers": "numberOfTenderers"}.items()]),
        "planning": d.where(F.trim("planning").startswith("{")).select(*keys, "orden", f("planning", "budget.amount.amount").alias("budget_amount"), f("planning", "rationale").alias("rationale")),
        "awards": award.select(*keys, "orden", f("a", "value.amount").alias("amount")),
        "suppliers": supplier.select(*keys, (F.col("__o") * 1000 + F.col("j")).alias("orden"), f("s", "id").alias("id")),
    }


@query(f"""with {RELEASES_SQL}, o as (select *, reg_id * 1000 + pos orden, list_transform(json_extract(r, '$.tag[*]'), lambda z: z ->> '$') t from rel), re as (select * from (select *, row_number() over (partition by anio, mes, ocid order by orden) n from o) where n = 1 and try_cast(left(r ->> '$.date', 10) as date) is not null), te as (select anio, mes, ocid, r te from (select *, row_number() over (partition by anio, mes, ocid order by orden desc) n from o where json_type(r, '$.tender') = 'OBJECT') where n = 1), pl as (select anio, mes, ocid, min_by({number_sql("(r ->> '$.planning.budget.amount.amount')")}, orden) filter ({number_sql("(r ->> '$.planning.budget.amount.amount')")} is not null) b from o group by all), su as (select anio, mes, ocid, min_by(ruc, (orden * 1000 + k) * 1000 + j) filter (ruc is not null) ruc from (select anio, mes, ocid, orden, k, unnest(range(len(s))) j, {tax_id_sql("(s[j + 1] ->> '$.id')")} ruc from (select anio, mes, ocid, orden, k, {json_objects("(a[k + 1] -> '$.suppliers')")} s from (select anio, mes, ocid, orden, a, unnest(range(len(a))) k from (select *, {json_objects("(r -> '$.awards')")} a from o)))) group by all)
select re.anio, re.mes, re.ocid, try_cast(left(re.r ->> '$.date', 10) as date) fecha, {_state('re.r')} estado, nullif(trim(split_part(te ->> '$.tender.procurementMethodDetails', ' en el convenio', 1)), '') metodo, {tax_id_sql("(re.r ->> '$.buyer.id')")} comprador_ruc, su.ruc proveedor_ruc, coalesce(nullif({number_sql("(te ->> '$.tender.value.amount')")}, 0), b) referencial, null::double adjudicado, left(coalesce(nullif(te ->> '$.tender.description', ''), nullif(te ->> '$.tender.title', '')), 200) objeto, {number_sql("(te ->> '$.tender.numberOfTenderers')")}::int n_oferentes from re left join te using (anio, mes, ocid) left join pl using (anio, mes, ocid) left join su using (anio, mes, ocid)""")
def sel02_summary_rows(spark, sf):
    """One row per process of a month's file."""
    return ops.summary_rows(**_normalised(release_table(spark, sf)), keys=["anio", "mes", "ocid"])


@query("""with ab as (select distinct ocid from proceso_resumen where estado = 'abierto' and ocid is not null) select ocid, item_id, origen, cpc, nullif(left(descripcion, 400), '') descripcion, cantidad, unidad from (select *, row_number() over (partition by ocid, item_id, origen order by item_fila) r from proceso_item semi join ab using (ocid)) where r = 1""")
def sel03_open_items(spark, sf):
    """Lines of open processes, the first of each key."""
    r = table(spark, sf, "proceso_resumen").where("estado = 'abierto'").select("ocid")
    i = table(spark, sf, "proceso_item").select("ocid", "item_id", "origen", "item_fila", "cpc", "descripcion", "cantidad", "unidad")
    return open_rows(i, r, ["ocid", "item_id", "origen"], "item_fila").select("ocid", "item_id", "origen", "cpc", ops._short(F.col("descripcion"), 400).alias("descripcion"), "cantidad", "unidad")


def open_rows(d: DataFrame, open_: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of the processes in open_ (P3), the first of every key."""
    return rel.first_by(d.join(open_.select("ocid").distinct(), "ocid", "left_semi"), keys, [order])


@query(f"""with {RELEASES_SQL}, b as (select {tax_id_sql("(r ->> '$.buyer.id')")} ruc, left(r ->> '$.buyer.name', 180) nombre from rel), s as (select {tax_id_sql("(s ->> '$.id')")} ruc, left(s ->> '$.name', 180) nombre from (select unnest({json_objects("(a -> '$.suppliers')")}) s from (select unnest({json_objects("(r -> '$.awards')")}) a from rel))) select ruc, nombre, count(*) n from (select * from b union all select * from s) where ruc is not null and nombre <> '' group by all""")
def g06_name_counts(spark, sf):
    """How often each name of a buyer or a supplier occurs."""
    d = release_table(spark, sf)
    both = F.concat(F.array(F.struct(ops._field("buyer", "id").alias("id"), ops._field("buyer", "name").alias("n"))), F.transform(F.coalesce(ops._inner(ops._objects(F.col("awards")), "suppliers"), F.array().cast("array<string>")), lambda s: F.struct(F.get_json_object(s, "$.id").alias("id"), F.get_json_object(s, "$.name").alias("n"))))
    x = d.select(F.explode(both).alias("x")).select(scalars.tax_id(F.col("x.id")).alias("ruc"), F.left("x.n", F.lit(180)).alias("nombre"))
    return x.where("ruc is not null and nombre <> ''").groupBy("ruc", "nombre").agg(F.count(F.lit(1)).alias("n"))
