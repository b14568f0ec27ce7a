"""The pN_ queries of the text problems, over whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bpe, packing, quantiles, sentences

CAPACITY = 2048
LONGEST_CODE = 5


def _prices(spark: SparkSession, sf: str) -> DataFrame:
    """Prices > 0 of the distinct lines by the first digits of their code."""
    i = table(spark, sf, "proceso_item").select("item_fila", "ocid", "item_id", "origen", "cpc", "precio_unitario")
    once = i.groupBy("ocid", "item_id", "origen").agg(F.min(F.struct("item_fila", "cpc", "precio_unitario")).alias("x")).select("x.cpc", "x.precio_unitario")
    lines = once.where("precio_unitario > 0 and cpc is not null")
    return quantiles.observations(lines, group=F.substring("cpc", 1, LONGEST_CODE), value=F.col("precio_unitario"))


def p5_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """(codigo, n, p10, p25, mediana, p75, p90) of every prefix: the values at rank ceil(q * n)."""
    at = lambda pct: F.floor((F.col("total") * pct + 99) / 100)
    ranks = {"p10": at(10), "p25": at(25), "mediana": at(50), "p75": at(75), "p90": at(90)}
    return quantiles.multi_select(_prices(spark, sf), ranks, levels=LONGEST_CODE).withColumnsRenamed({"grupo": "codigo", "total": "n"})


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """A figure is wrong when it lies below the value at rank (q - 10) % or above the one at (q + 10) %."""
    total = F.col("total")
    ranks = {}
    for campo, pct in (("p25", 25), ("mediana", 50), ("p75", 75)):
        ranks[f"{campo}_bajo"] = F.floor((total * (pct - 10) + 99) / 100)
        ranks[f"{campo}_alto"] = F.floor(total * (pct + 10) / 100) + 1
    nodes = table(spark, sf, "mercado_nodo").select("codigo", "p25", "mediana", "p75").where("codigo is not null")
    bounds = quantiles.multi_select(_prices(spark, sf), ranks, levels=LONGEST_CODE, only=nodes.select(F.col("codigo").alias("grupo")))
    d = nodes.join(bounds, nodes["codigo"] == bounds["grupo"])
    bad = F.array(*[F.when((F.col(c) < F.col(f"{c}_bajo")) | (F.col(c) > F.col(f"{c}_alto")), F.lit(c)) for c in ("p25", "mediana", "p75")])
    return d.select("codigo", F.explode(F.array_compact(bad)).alias("campo")).distinct()


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(table(spark, sf, "documents").select("doc_id", "text"))


def p9_containers(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, pieza, inicio, largo, contenedor, posicion): every piece and its place."""
    sizes = bpe.encode(table(spark, sf, "documents").select("doc_id", "text"), counts_only=True)
    return packing.pack(sizes, key="doc_id", size="n_tokens", capacity=CAPACITY)


def p9_fill(spark: SparkSession, sf: str) -> DataFrame:
    """One row: containers, tokens in them, and the share of room left unused."""
    d = p9_containers(spark, sf).where("contenedor is not null")
    full = d.groupBy("contenedor").agg(F.sum("largo").alias("n"))
    return full.agg(F.count(F.lit(1)).alias("contenedores"), F.sum("n").alias("tokens"), F.max("n").alias("lleno_max"), F.round(1 - F.sum("n") / (F.count(F.lit(1)) * CAPACITY), 6).alias("sin_usar"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentences.split_sentences(table(spark, sf, "documents").select("doc_id", "text", "lang"))


QUERIES = {"p5_found": p5_found, "p5_percentiles": p5_percentiles, "p10_found": p10_found, "p8_ids": p8_ids, "p9_containers": p9_containers, "p9_fill": p9_fill}
_PRICES = """l as (select cpc, precio_unitario p from (select *, row_number() over (partition by ocid, item_id, origen order by item_fila) r from proceso_item) where r = 1 and precio_unitario > 0 and cpc is not null)"""
SQL: dict[str, str] = {
    "p5_found": f"""with {_PRICES}, m as (unpivot (select codigo, p25, mediana, p75 from mercado_nodo) on p25, mediana, p75 into name campo value f), c as (select codigo, campo, case campo when 'p25' then 25 when 'p75' then 75 else 50 end q, count(*) n, count(*) filter (p < f) lt, count(*) filter (p <= f) le from m join l on starts_with(cpc, codigo) group by all) select codigo, campo from c where 100 * le < (q - 10) * n or 100 * lt > (q + 10) * n""",
    "p5_percentiles": f"""with {_PRICES}, e as (select left(cpc, k) codigo, p from l, generate_series(1, 5) g(k) where length(cpc) >= k) select codigo, count(*) n, quantile_disc(p, 0.1) p10, quantile_disc(p, 0.25) p25, quantile_disc(p, 0.5) mediana, quantile_disc(p, 0.75) p75, quantile_disc(p, 0.9) p90 from e group by codigo""",
}
