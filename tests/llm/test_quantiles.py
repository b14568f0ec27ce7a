import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tamizal.llm import quantiles


def select(d, ranks, **how):
    return {r["grupo"]: r for r in quantiles.multi_select(quantiles.observations(d, group=F.col("g"), value=F.col("v")), ranks, **how).collect()}


def ranks():
    total = F.col("total")
    return {"lo": F.floor((total + 9) / 10), "mid": F.floor((total + 1) / 2), "hi": total, "out": total + 1}


def check(got, values):
    values.sort()
    n = len(values)
    assert (got["total"], got["lo"], got["mid"], got["hi"], got["out"]) == (n, values[(n + 9) // 10 - 1], values[(n + 1) // 2 - 1], values[-1], None)


@pytest.mark.parametrize("finish, batch", [(1024, 20_000), (16, 20_000), (16, 3)])
def test_multi_select_equals_sorting(spark, monkeypatch, finish, batch):
    monkeypatch.setattr(quantiles, "FINISH", finish)
    monkeypatch.setattr(quantiles, "BATCH", batch)
    rnd = random.Random(3)
    rows = [("hot", rnd.choice([rnd.lognormvariate(2, 2), 5.0])) for _ in range(6000)]
    rows += [(f"g{rnd.randint(0, 30)}", round(rnd.lognormvariate(2, 2), 2)) for _ in range(2000)]
    rows += [("one", 1.5), ("ties", 2.0), ("ties", 2.0), ("ties", 2.0), (None, 1.0), ("nulls", None), ("nan", float("nan")), ("inf", float("inf")), ("inf", 1.0), ("zero", 0.0), ("zero", -0.0)]
    d = spark.createDataFrame(rows, "g string, v double").withColumn("total", F.lit("clash"))
    want = defaultdict(list)
    for g, v in rows:
        if g is not None and v is not None and v == v:
            want[g].append(v)
    got = select(d, ranks())
    assert set(got) == set(want)
    for g, values in want.items():
        check(got[g], values)


@pytest.mark.parametrize("rank", [1, 600, 601, 900, 1200])
def test_two_values_only(spark, rank):
    """All runs of a batch can be trimmed away."""
    rows = [("a", 1.0)] * 600 + [("a", 2.0)] * 600 + [("b", float(i)) for i in range(3000)]
    d = spark.createDataFrame(rows, "g string, v double").repartition(2)
    got = select(d, {"p": F.lit(rank)})
    assert got["a"]["p"] == (1.0 if rank <= 600 else 2.0) and got["b"]["p"] == rank - 1.0


def test_infinities_of_both_signs(spark):
    values = [-math.inf] * 1500 + [math.inf] * 1500 + [0.0, 1.0, 2.0]
    d = spark.createDataFrame([("a", v) for v in values] + [("b", -math.inf if i % 2 else math.inf) for i in range(1300)], "g string, v double").repartition(3)
    got = select(d, ranks())
    check(got["a"], values)
    check(got["b"], [-math.inf] * 650 + [math.inf] * 650)


def test_parts_merge(spark):
    d = spark.range(3000).select(F.lit("g").alias("g"), (F.col("id") * 7 % 3000).cast("double").alias("v"), (F.col("id") % 3).alias("m"))
    parts = [quantiles.histogram(d.where(f"m = {m}"), group=F.col("g"), value=F.col("v")) for m in range(3)]
    assert quantiles.multi_select(quantiles.merge(*parts), {"p": F.lit(1500)}).first()["p"] == 1499.0
    both = quantiles.multi_select(parts[0].unionByName(parts[1]).unionByName(parts[2]), {"p": F.lit(1500), "none": F.lit(None)}).first()
    assert (both["p"], both["none"]) == (1499.0, None)


def test_empty_input(spark):
    d = spark.createDataFrame([], "g string, v double")
    assert quantiles.multi_select(quantiles.observations(d, group=F.col("g"), value=F.col("v")), {"p": F.lit(1)}).count() == 0


def test_prefixes_of_codes(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice(["12345", "12399", "1", "", "20000", "123456"]), float(rnd.randint(0, 50))) for _ in range(4000)]
    d = spark.createDataFrame(rows, "g string, v double")
    want = defaultdict(list)
    for g, v in rows:
        for k in range(1, min(len(g), 5) + 1):
            want[g[:k]].append(v)
    got = select(d, ranks(), levels=5)
    assert set(got) == set(want)
    for g, values in want.items():
        check(got[g], values)
    only = spark.createDataFrame([("1",), ("2",), ("1",), (None,), ("9",)], "grupo string")
    some = select(d, ranks(), levels=5, only=only)
    assert set(some) == {"1", "2"} and some["1"] == got["1"]
