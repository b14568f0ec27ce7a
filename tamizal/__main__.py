"""python -m tamizal QUERY DIR [--salida PATH] [--desde YYYYMM --hasta YYYYMM] [--seco]

Runs a registered query over the tables of a folder and writes its rows; --desde and --hasta keep the
months of a result that has anio and mes; --seco only shows the plan.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLANS = ["problems", "catalogue", "market", "entities", "releases"]


def known() -> dict:
    out: dict = {}
    for m in PLANS:
        out |= importlib.import_module(f"tamizal.plans.{m}").QUERIES
    return out


def run(spark: SparkSession, args: list[str]) -> DataFrame:
    p = argparse.ArgumentParser(prog="tamizal")
    p.add_argument("query", choices=sorted(known()))
    p.add_argument("dir")
    p.add_argument("--salida")
    p.add_argument("--desde", type=int)
    p.add_argument("--hasta", type=int)
    p.add_argument("--seco", action="store_true")
    a = p.parse_args(args)
    d = known()[a.query](spark, a.dir)
    if a.desde or a.hasta:
        if not {"anio", "mes"} <= set(d.columns):
            p.error(f"{a.query} has no months")
        d = d.where((F.col("anio") * 100 + F.col("mes")).between(a.desde or 0, a.hasta or 999912))
    if a.seco:
        d.explain("formatted")
    elif a.salida:
        d.write.mode("overwrite").parquet(a.salida)
    else:
        d.show(20, truncate=False)
    return d


if __name__ == "__main__":
    import sys

    run(SparkSession.builder.getOrCreate(), sys.argv[1:])
