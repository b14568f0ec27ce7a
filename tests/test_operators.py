import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamizal.functions import scalars, text
from tamizal.operators import relational as rel
from tamizal.operators import vectors
from tamizal.sources import files
from tamizal.streaming import events as streams


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, expr, want",
    [
        ("EC-RUC-1791240502001-14583", scalars.tax_id, "1791240502001"), ("1791240502001", scalars.tax_id, "1791240502001"), ("", scalars.tax_id, None), ("abc", scalars.tax_id, None), ("1791240502001-14583", scalars.tax_id, None), ("ec-ruc-1791240502001", scalars.tax_id, "1791240502001"), ("EC-RUC-1791240502001-", scalars.tax_id, None), ("EC-RUC-1791240502001-1-2", scalars.tax_id, None), (" 0102030405 ", scalars.tax_id, "0102030405"), ("EC-RUC-17912405020011", scalars.tax_id, None),
        ("1e3", scalars.number, 1000.0), ("12d", scalars.number, None), ("", scalars.number, None), (None, scalars.number, None),
        ("40,00%", scalars.percent, 0.4), ("20,18%", scalars.percent, 0.2018), ("", scalars.percent, None),
        ("3526000506", scalars.code_prefix, "35260"), ("AB", scalars.code_prefix, None), ("7", scalars.code_prefix, None),
        ("1791240502001", scalars.masked, ".........2001"), ("170", scalars.masked, "170"), ("1791240502001", scalars.province, "PICHINCHA"), ("9991240502001", scalars.province, None),
        ('["planning", "award"]', scalars.tag_state, "adjudicado"), ("planning, tender", scalars.tag_state, "abierto"), (None, scalars.tag_state, "desconocido"), ('["tender","award","contract"]', scalars.tag_state, "cerrado"), ("[]", scalars.tag_state, "desconocido"),
        ("1104567890001", scalars.is_natural, True), ("1791240502001", scalars.is_natural, False), ("1660003510001", scalars.is_public, True), ("x", scalars.is_natural, False), (None, scalars.is_public, False),
        ("ocds-x-SIE-ABC-2024-17", lambda c: scalars.process_code(c, "ocds-x"), "SIE-ABC-2024"), ("SIE-ABC-2024", scalars.looks_like_code, True), ("compra de papel", scalars.looks_like_code, False),
        ("Subasta en el convenio X", lambda c: scalars.before(c, " en el convenio"), "Subasta"),
        ("Equipos Médicos de la", text.name_key, "equipo medico"), ("Equipo médico", text.name_key, "equipo medico"),
        ("garantÃ­a tÃ©cnica", text.repair_encoding, "garantía técnica"), ("sin daño", text.repair_encoding, "sin daño"), (None, text.repair_encoding, None), ("Ã", text.repair_encoding, "Ã"), ("Ã¡Ã³ÂÂ¡ y Â¿quÃ©? ÃÃ±o", text.repair_encoding, "áóÂ¡ y ¿qué? Ãño"), ("Ã©\x80 fin\nÃ©", text.repair_encoding, "Ã©\x80 fin\né"),
        ("corto", text.comparable, ""), ("Compra AB-CDEF-123  de  Papel", text.comparable, "compra de papel"),
        ("Orden de compra para adquirir los siguientes productos: Papel bond", text.comparable, "papel bond"), ("Es mejor otro", text.is_short_name, False), ("OTRAS PRENDAS DE PAPEL, n.c.p.", text.fallback_name, "Prendas de papel"), ("varios", text.fallback_name, "varios"), ("Equipo médico", text.is_short_name, True), ("equipo", text.is_short_name, False),
    ],
)
def test_scalars(spark, value, expr, want):
    assert one(spark, value, expr) == want


def test_bands_and_amounts(spark):
    band = lambda c: scalars.banded(c, [(10.0, "a"), (20.0, "b")], "c")
    assert [one(spark, x, band, "double") for x in (-1.0, 10.0, 25.0, None)] == ["a", "b", "c", None]
    assert [one(spark, x, scalars.short_amount, "double") for x in (1234567.0, 1234567890.0, 5400.0, 12.0, None)] == ["$1.2 M", "$1.234.6 M", "$5 K", "$12", "no declarado"]


def test_keyed_selection(spark):
    d = spark.createDataFrame([("a", 2, "x", 1), ("a", 1, None, 5), ("a", 3, "y", 2), (None, 1, "z", 1), ("b", 1, "q", 1), ("b", 1, "p", 1)], "k string, o int, v string, w int")
    assert {r["k"]: r["v"] for r in rel.first_by(d, ["k"], ["o"]).collect()} == {"a": None, None: "z", "b": "p"}
    assert {r["k"]: r["v"] for r in rel.first_by(d, ["k"], ["o"], where=F.col("v").isNotNull()).collect()} == {"a": "x", None: "z", "b": "p"}
    assert {r["k"]: r["v"] for r in rel.last_by(d, ["k"], ["o"]).collect()} == {"a": "y", None: "z", "b": "q"}
    assert {r["k"]: r["v"] for r in rel.mode_by(d, ["k"], "v").collect()} == {"a": "x", None: "z", "b": "p"}
    assert {r["k"]: r["v"] for r in rel.mode_by(d, ["k"], "v", F.col("w")).collect()} == {"a": "y", None: "z", "b": "p"}
    assert rel.first_by(d.limit(0), ["k"], ["o"]).count() == 0


def test_tree_is_additive(spark):
    d = spark.createDataFrame([("12345", 1), ("12399", 2), ("1", 4), (None, 8), ("", 16)], "c string, n int")
    got = {r["nodo"]: r["s"] for r in rel.prefix_levels(d, "c", 5).groupBy("nodo").agg(F.sum("n").alias("s")).collect()}
    assert got == {"1": 7, "12": 3, "123": 3, "1234": 1, "12345": 1, "1239": 2, "12399": 2, None: 24}


@pytest.mark.parametrize("held", [2_000, 2])
def test_never_met_equals_pairs(spark, monkeypatch, held):
    import random

    monkeypatch.setattr(rel, "HELD", held)

    rnd = random.Random(2)
    rows = [(rnd.randint(0, 9), rnd.choice([None, *range(40)]), rnd.choice([None, *range(12)])) for _ in range(300)]
    d = spark.createDataFrame(rows, "l int, r int, t int")
    got = {r["l"]: r["n"] for r in rel.never_met(d, d, left="l", right="r", through="t").collect()}
    ok = {(a, b, t) for a, b, t in rows if t is not None}
    who = {}
    for _, b, t in ok:
        if b is not None:
            who.setdefault(t, set()).add(b)
    want = {}
    for a in {x[0] for x in ok}:
        reach = set().union(*[who.get(t, set()) for x, _, t in ok if x == a])
        n = len(reach - {b for x, b, _ in ok if x == a})
        if n:
            want[a] = n
    assert got == want


def test_never_met_reads_its_rows_once(spark):
    """Repeating what is below it four times made shuffles of several times the input."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    d = spark.range(1000).selectExpr("id % 7 l", "id % 50 r", "id % 11 t").mapInArrow(counted, "l bigint, r bigint, t bigint")
    assert {r["l"]: r["n"] for r in rel.never_met(d, d, left="l", right="r", through="t").collect()} == {}
    assert seen.value == 1000


@pytest.mark.parametrize("held", [12_000_000, 500])
def test_never_met_other_offers(spark, monkeypatch, held):
    """Offers beyond the pairs, text keys, one value that all share, lefts of few and of many values."""
    import random

    monkeypatch.setattr(rel, "HELD", held)
    rnd = random.Random(5)
    pairs = [(f"l{rnd.randint(0, 30)}", f"r{rnd.randint(0, 400)}", f"t{rnd.randint(0, 90)}") for _ in range(400)] + [(f"l{k}", "r1", "all") for k in range(15)] + [("one", "r2", "t0"), ("alone", "r9", "only")]
    offers = [p[1:] for p in pairs] + [(f"r{k}", "all") for k in range(300)] + [(f"r{rnd.randint(0, 900)}", f"t{rnd.randint(0, 120)}") for _ in range(900)] + [("r7", None), (None, "t1")]
    got = rel.never_met(spark.createDataFrame(pairs, "l string, r string, t string"), spark.createDataFrame(offers, "r string, t string"), left="l", right="r", through="t")
    who, reach, met = {}, {}, {}
    for r, t in offers:
        who.setdefault(t, set()).update({r} - {None})
    for a, r, t in pairs:
        reach.setdefault(a, set()).update(who[t])
        met.setdefault(a, set()).add(r)
    want = {a: len(reach[a] - met[a]) for a in reach if reach[a] - met[a]}
    assert {r["l"]: r["n"] for r in got.collect()} == want
    assert got.dtypes == [("l", "string"), ("n", "bigint")]


def test_quantiles_equal_sorting(spark):
    """By position and interpolated, with ties, signs, infinities and null keys, on many slices."""
    import math
    import random
    import statistics

    rnd = random.Random(9)
    rows = [("hot", rnd.choice([rnd.gauss(0, 1e3), 7.0, 0.0, -0.0, 1e-300, 1e300])) for _ in range(3000)]
    rows += [(None, float(i)) for i in range(10)] + [("one", 1.5), ("inf", math.inf), ("inf", -math.inf), ("inf", 3.0), ("none", None), ("nan", math.nan)]
    d = spark.createDataFrame(rows, "g string, v double")
    q = rel.quantiles(rel.value_counts(d, ["g"], "v"), ["g"], index={"p10": "least(cast(floor(n * 0.1D) as bigint), n - 1)", "p25": "n div 4", "top": "n - 1"}, between={"q3": 0.75, "mediana": 0.5})
    got = {r["g"]: r for r in q.collect()}
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, v in groups.items():
        v.sort()
        n = len(v)
        assert (got[g]["n"], got[g]["p10"], got[g]["p25"], got[g]["top"]) == (n, v[min(int(n * 0.1), n - 1)], v[n // 4], v[-1])
        assert got[g]["mediana"] == pytest.approx(statistics.median(v))
        if g != "inf":
            at = 0.75 * (n - 1)
            assert got[g]["q3"] == pytest.approx(v[int(at)] + (v[math.ceil(at)] - v[int(at)]) * (at - int(at)))
    assert rel.quantiles(rel.value_counts(d.limit(0), ["g"], "v"), ["g"], between={"m": 0.5}).count() == 0


def test_ranks_from_running_counts(spark):
    rows = [("a", 3.0), ("a", 3.0), ("a", 1.0), ("a", 9.0), (None, 2.0), ("b", None)]
    d = spark.createDataFrame(rows, "g string, v double")
    assert sorted((r["g"] or "", r["v"], r["puesto"], r["de"]) for r in rel.rank_desc(d, ["g"], "v").collect()) == [("", 2.0, 1, 1), ("a", 1.0, 4, 4), ("a", 3.0, 2, 4), ("a", 9.0, 1, 4)]


def test_nodes_of_codes(spark):
    tree = spark.createDataFrame([("12345",), ("1239",), ("123",), (None,)], "codigo string")
    d = spark.createDataFrame([(c,) for c in ["1234599", "12345", "12399", "1239", "123", "99999", "", None]], "c string")
    assert [r["nodo"] for r in rel.in_tree(d, tree, "c").collect()] == ["12345", "12345", "1239", "1239", None, None, None, None]


def test_origin_of_lines(spark):
    from tamizal.plans import market

    rows = [("a", 2024, "tender", 5.0), ("a", 2024, "award", 9.0), ("a", 2024, "award", 0.0), ("a", 2025, "tender", 5.0), ("b", 2024, "tender", 5.0), ("b", 2024, "award", None), ("b", 2024, "other", 1.0), ("c", 2024, None, 1.0)]
    d = spark.createDataFrame(rows, "ocid string, anio int, origen string, monto_linea double")
    plain = sorted((r["ocid"], r["origen"] or "", r["monto_linea"] or 0) for r in market.single_origin(d).collect())
    assert plain == [("a", "award", 0.0), ("a", "award", 9.0), ("b", "other", 1.0), ("b", "tender", 5.0), ("c", "", 1.0)]
    year = sorted((r["ocid"], r["anio"], r["origen"], r["monto_linea"]) for r in market.single_origin(d, annual=True).collect())
    assert year == [("a", 2024, "award", 9.0), ("a", 2025, "tender", 5.0), ("b", 2024, "tender", 5.0)]


def test_dominant_codes(spark):
    from tamizal.plans import market

    one = [("p", "tender", "CLIPS", 0.5)] * 100 + [("p", "tender", "PC", 900.0)]
    rows = one + [("q", "tender", "A", 900.0), ("q", "award", "B", 1.0), ("r", "award", "C", None), ("s", "award", None, 9.0), ("s", "tender", "D", 2.0)]
    d = spark.createDataFrame(rows, "ocid string, origen string, cpc string, precio_unitario double")
    assert {r["ocid"]: r["cpc"] for r in market.code_by_amount(d).collect()} == {"p": "PC", "q": "B", "r": "C", "s": "D"}
    lines = spark.createDataFrame([("p", "A", 3.0), ("p", "A", 3.0), ("p", "B", 5.0), ("q", "Z", None), ("q", "Y", None)], "ocid string, cpc string, monto_linea double")
    assert {r["ocid"]: r["cpc"] for r in market.largest_line_code(lines).collect()} == {"p": "B", "q": "Y"}


def test_names_do_not_collide(spark):
    from tamizal.plans import market

    names = spark.createDataFrame([("1", 5, "Equipo médico"), ("2", 9, "Equipos Médicos"), ("3", 1, "Papel"), ("4", 8, "Papeles")], "grupo string, total bigint, nombre string")
    assert {r["grupo"]: r["nombre"] for r in market.distinct_names(names).collect()} == {"2": "Equipos Médicos", "1": "Equipo médico (1)", "3": "Papel (3)", "4": "Papeles"}
    kept = spark.createDataFrame([("3", "Papel"), ("9", "Equipo médico")], "grupo string, nombre string")
    assert {r["grupo"]: r["nombre"] for r in market.distinct_names(names, kept).collect()} == {"9": "Equipo médico", "2": "Equipos Médicos (2)", "1": "Equipo médico (1)", "3": "Papel", "4": "Papeles (4)"}


def test_release_tables(spark):
    """The seven tables of one full release, and of odd ones."""
    from tamizal.operators import releases as ops

    full = {
        "ocid": "o", "date": "2024-03-12T09:00:00-05:00", "tag": ["tender", "award"], "buyer": {"id": "EC-RUC-1760001550001-9"}, "planning": {"budget": {"id": "p", "amount": {"amount": 7}}, "rationale": "why"},
        "tender": {
            "title": "T", "description": "D", "value": {"amount": 0}, "procurementMethodDetails": "Subasta en el convenio X", "numberOfTenderers": "2", "items": [{"id": 1, "quantity": "3", "unit": {"name": "u", "value": {"amount": 2.5, "currency": "USD"}}, "classification": {"id": "12345"}}, None, "x"],
            "tenderers": [{"id": "EC-RUC-1791240502001-14583", "name": "A"}, {"id": "EC-RUC-0990004196001-1", "name": "B"}, {"id": None}], "enquiries": {"id": 4, "date": "2024-03-12T09:00:00-05:00", "description": "", "answer": "x" * 3000, "author": {"id": "1791240502001", "name": "A"}},
            "lots": [{"id": "L", "value": {"amount": "9"}, "techniques": {"b": 1, "a": 2}}, {"id": "M", "techniques": ["x"]}],
        },
        "awards": [{"items": [{"id": "z"}], "suppliers": [{"id": "EC-RUC-1791240502001"}]}], "parties": [{"id": "1791240502001", "name": "A", "roles": ["buyer", "payer"], "address": {"region": "R", "locality": "C"}, "contactPoint": {"url": "w"}}, {"id": "nobody"}],
        "auctions": [{"stages": [{"bids": [{"id": "b", "date": "2024-03-12T09:00:00-05:00", "value": {"amount": 5}, "tenderers": [{"id": "1791240502001"}]}, {"id": "c"}]}, None]}],
    }
    odd = [None, "", "{", "7", '{"ocid": ""}', '{"ocid": "x", "tender": [], "awards": 3, "auctions": "?"}', json.dumps({"releases": [{"ocid": "y", "tender": {"lots": json.dumps([{"id": 1}])}}]})]
    d = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([json.dumps(full), *odd])], "r int, t string, ocid string")
    rows = ops.release_rows(d, row="r", text="t").cache()
    assert [r["ocid"] for r in rows.orderBy("reg_id").collect()] == ["o", "x", "y"]
    first = lambda df: [tuple(r)[3:] for r in df.collect() if r["ocid"] == "o"]
    assert first(ops.processes(rows)) == [("adjudicado", "Subasta", "T", "D", 7.0, 2, None, None, "p", "why", "1760001550001", "2024-03-12")]
    assert first(ops.items(rows)) == [("tender", "1", "12345", None, 3.0, "u", 2.5, "USD"), ("award", "z", None, None, None, None, None, None)]
    assert first(ops.bidders(rows)) == [("1791240502001", "A", True), ("0990004196001", "B", False), (None, None, False)]
    assert first(ops.bids(rows)) == [("b", "1791240502001", "2024-03-12T09:00:00", 5.0), ("c", None, None, None)]
    assert first(ops.parties(rows)) == [("1791240502001", "A", "buyer,payer", "R", "C", "w")]
    assert first(ops.enquiries(rows)) == [("4", "2024-03-12T09:00:00", "1791240502001", "A", None, "x" * 2000, None)]
    assert first(ops.lots(rows)) == [("L", None, 9.0, "a,b"), ("M", None, None, None)]
    assert [r["lote_id"] for r in ops.lots(rows).collect() if r["ocid"] == "y"] == ["1"]
    rows.unpersist()


def test_summary_rows(spark):
    """First release, last tender, first valid budget, reason and supplier, added awards; dates that
    cannot be read drop the row."""
    from tamizal.operators import releases as ops

    t = lambda rows, kind: spark.createDataFrame(rows, kind)
    releases = t([("a", 1, "2025-04-10T00:00", '["planning"]', "1791240502001"), ("a", 2, "2020-01-01", "x", None), ("b", 3, "soon", "x", None), ("c", 4, "2026-05-20", "contract", "EC-RUC-1")], "ocid string, orden int, fecha string, tag string, buyer_id string")
    tender = t([("a", 1, "Old", "1", "x", "x", "9"), ("a", 2, "Menor en el convenio Y", "0", "title", None, " ")], "ocid string, orden int, procurementMethodDetails string, value_amount string, title string, description string, numberOfTenderers string")
    planning = t([("a", 1, "bad", " "), ("a", 2, "5.5", "why"), ("a", 3, "9", "no")], "ocid string, orden int, budget_amount string, rationale string")
    awards = t([("a", "1.25"), ("a", "x"), ("a", "2")], "ocid string, amount string")
    suppliers = t([("a", 1, "nobody"), ("a", 2, "EC-RUC-0990004196001-7"), ("a", 3, "1791240502001")], "ocid string, orden int, id string")
    got = {r["ocid"]: tuple(str(x) if x is not None else None for x in r[1:]) for r in ops.summary_rows(releases, tender, planning, awards, suppliers, ["ocid"]).collect()}
    assert got == {"a": ("2025-04-10", "planificacion", "Menor", "1791240502001", "0990004196001", "5.5", "3.25", "why", None), "c": ("2026-05-20", "cerrado", None, None, None, None, None, None, None)}


def test_nearest_and_merge(spark, monkeypatch):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, None), (4, [1.0]), (5, [-1.0, 0.1])], "i int, v array<double>")
    reps = spark.createDataFrame([("a", [2.0, 0.0], 5), ("b", [0.0, 1.0], 3), ("c", [1.9, 0.1], 9)], "r string, c array<double>, n int")
    want = {1: "a", 2: "b", 5: "b"}
    assert {r["i"]: r["r"] for r in vectors.nearest(d, reps, key="i", vector="v", rep="r", rep_vector="c").collect()} == want
    monkeypatch.setattr(vectors, "BLOCK", 1)
    assert {r["i"]: r["r"] for r in vectors.nearest(d, reps, key="i", vector="v", rep="r", rep_vector="c").collect()} == want
    assert vectors.nearest(d, reps.limit(0), key="i", vector="v", rep="r", rep_vector="c").count() == 0
    assert {r["r"]: r["grupo"] for r in vectors.merge_labels(reps, rep="r", vector="c", weight="n", least=0.92).collect()} == {"a": "c", "b": "b", "c": "c"}


def test_no_label_below_the_threshold(spark, tmp_path):
    """The label of the query needs a similarity of 0.55; the histogram counts all vectors."""
    from tamizal.plans import catalogue

    unit = lambda **x: [x.get(f"c{i}", 0.0) for i in range(64)]
    rows = [(1, "a", unit(c0=3.0)), (2, "a", unit(c0=1.0)), (3, "b", unit(c1=4.0)), (4, "b", unit(c1=1.0)), (5, None, unit(c0=0.4, c2=0.9)), (6, None, unit(c0=0.6, c2=0.8))]
    spark.createDataFrame(rows, "vec_id long, label string, embedding array<float>").where("label is not null or vec_id > 4").write.parquet(str(tmp_path / "embeddings.parquet"))
    reps = spark.createDataFrame([("a", unit(c0=2.0)), ("b", unit(c1=2.0))], "label string, centro array<double>")
    e = spark.read.parquet(str(tmp_path / "embeddings.parquet"))
    best = vectors.nearest(e, reps, key="vec_id", vector="embedding", rep="label", rep_vector="centro")
    got = [tuple(r) for r in vectors.similarity_histogram(best, [0.35, 0.45, 0.55, 0.75]).orderBy("corte").collect()]
    assert got == [(0.35, 6, 1.0), (0.45, 5, 5 / 6), (0.55, 5, 5 / 6), (0.75, 4, 4 / 6)]
    lost = spark.createDataFrame([(9, "a", unit(c0=1.0)), (10, "a", unit(c1=1.0)), (11, "a", unit(c2=1.0)), (12, "a", unit(c3=1.0))], "vec_id long, label string, embedding array<float>")
    lost.write.parquet(str(tmp_path / "far" / "embeddings.parquet"))
    assert catalogue.QUERIES["t05_nearest_label"](spark, str(tmp_path / "far")).count() == 0
    assert {r["n"] for r in catalogue.QUERIES["t05_similarity_histogram"](spark, str(tmp_path / "far")).collect()} == {0, 4}


def test_csv_contract(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿k,v\n1,"x, ""y"""\n2,\n', encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv"), ["k", "v"]).collect()] == [("1", 'x, "y"'), ("2", None)]
    with pytest.raises(files.ContractError):
        files.read_csv(spark, str(tmp_path / "a.csv"), ["k", "w"])
    (tmp_path / "b.csv").write_bytes("code;name\n1;Año\n".encode("latin-1"))
    assert files.read_csv(spark, str(tmp_path / "b.csv"), ["c", "n"], sep=";", encoding="ISO-8859-1", exact=False).first()["n"] == "Año"


def test_checked_text(spark, tmp_path):
    (tmp_path / "good.txt").write_text("garantía " * 200 + "garantÃ­a", encoding="utf-8")
    assert "Ã" not in files.read_text_checked(spark, str(tmp_path / "good.txt")).first()["texto"]
    (tmp_path / "latin.txt").write_bytes("año".encode("latin-1"))
    (tmp_path / "broken.txt").write_text("garantÃ­a " * 30, encoding="utf-8")
    for name in ("latin.txt", "broken.txt"):
        with pytest.raises(files.ContractError):
            files.read_text_checked(spark, str(tmp_path / name))


def test_declared_columns(spark):
    d = spark.createDataFrame([("7", "1234,56")], "a string, b string")
    assert tuple(files.declared(d, {"a": "entero", "b": "decimal", "c": "texto"}).first()) == (7, None, None)
    with pytest.raises(files.ContractError):
        files.declared(d, {"a": "entero"})


def test_json_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"ocid": "a", "n": 1}')
    schema = T.StructType([T.StructField("ocid", T.StringType()), T.StructField("n", T.LongType())])
    r = files.read_json(spark, [str(tmp_path / "r.json")], schema).first()
    assert (r["ocid"], r["n"], r["archivo"]) == ("a", 1, "r.json")


def test_months_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    d = lambda rows: spark.createDataFrame(rows, "x int, anio int, mes int")
    files.write_months(d([(1, 2024, 1), (2, 2024, 2)]), path)
    files.write_months(d([(9, 2024, 2), (8, 2024, 3)]), path)
    files.write_months(d([(9, 2024, 2), (8, 2024, 3)]), path)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 8, 9]
    assert [r["x"] for r in files.read_months(spark, path, 202403, 202412, ["x"]).collect()] == [8]
    assert files.coverage_gate(spark.read.parquet(path), 4).first()["bien"]
    assert not files.coverage_gate(spark.read.parquet(path), 5).first()["bien"]
    base = spark.createDataFrame([("a", 1, 5), ("a", 2, 1)], "k string, m int, n long")
    part = spark.createDataFrame([("a", 2, 7)], "k string, m int, n long")
    again = files.add_counts(files.add_counts(base, part, ["k"], "m", "n"), part, ["k"], "m", "n")
    assert sorted((r["m"], r["n"]) for r in again.collect()) == [(1, 5), (2, 7)]


def test_missing_months(spark):
    d = spark.createDataFrame([(2024, 1), (2024, 3)], "anio int, mes int")
    assert sorted(map(tuple, rel.missing_months(d, (2023, 12), (2024, 4)).collect())) == [(2023, 12), (2024, 2), (2024, 4)]


def test_replay_stream(spark, tmp_path):
    """Late events correct earlier periods; events beyond the cut-off are left out."""
    kind = "k string, p int, v double"
    batches = [[("a", 1, 1.0), ("a", 4, 2.0), ("b", 1, 5.0)], [("a", 2, 10.0), ("a", 5, 1.0)], [("a", 0, 99.0), ("a", 9, 1.0)], [("a", 3, 7.0), ("a", 8, 2.0)]]
    for i, rows in enumerate(batches):
        path = tmp_path / "in" / f"{i}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(f'{{"k": "{k}", "p": {p}, "v": {v}}}' for k, p, v in rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    src = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    out: dict = {}

    def keep(batch, _):
        for r in batch.collect():
            if (r["k"], r["p"]) not in out or out[r["k"], r["p"]][0] < r["version"]:
                out[r["k"], r["p"]] = (r["version"], r["total"])

    stream = streams.replay_stream(src, key="k", event="p", value="v", every=2, max_late=4)
    stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    assert {k: v[1] for k, v in out.items()} == {("a", 1): 1.0, ("a", 2): 11.0, ("a", 4): 13.0, ("a", 5): 14.0, ("a", 8): 16.0, ("a", 9): 17.0, ("b", 1): 5.0}


def replayed(spark, folder, batches, **how):
    """The last version of every total of a stream over one file per batch (k, p, v, arrival)."""
    for i, rows in enumerate(batches):
        path = folder / "in" / f"{i}.json"
        path.parent.mkdir(exist_ok=True, parents=True)
        path.write_text("\n".join(json.dumps(dict(zip("kpva", r))) for r in rows))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    src = spark.readStream.schema("k string, p int, v double, a int").option("maxFilesPerTrigger", 1).json(str(folder / "in"))
    out: dict = {}

    def keep(batch, _):
        for r in batch.collect():
            if (r["k"], r["p"]) not in out or out[r["k"], r["p"]][0] < r["version"]:
                out[r["k"], r["p"]] = (r["version"], r["total"])

    stream = streams.replay_stream(src, key="k", event="p", value="v", every=2, max_late=4, **how)
    stream.writeStream.outputMode("update").option("checkpointLocation", str(folder / "c")).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return {k: v[1] for k, v in out.items()}


def test_replay_stream_keeps_a_backlog(spark, tmp_path):
    """A first batch of 24 periods, none of them late, is kept whole."""
    got = replayed(spark, tmp_path, [[("a", p, 1.0, p) for p in range(24)], [("a", 18, 9.0, 24), ("a", 19, 2.0, 23)]])
    assert got == {("a", p): p + 1.0 + (2.0 if p >= 19 else 0.0) for p in range(24)}


def test_replay_stream_does_not_depend_on_batches(spark, tmp_path):
    import random

    rnd = random.Random(4)
    rows = []
    for _ in range(300):
        arrival = rnd.randint(0, 30)
        key, late = rnd.choice(["hot", "hot", "b", "c", None]), rnd.choice([0, 0, 1, 4, 5, 9, -1, None])
        rows.append((key, None if late is None else arrival - late, rnd.choice([1.0, 2.0, 0.5, None]), arrival))
    want: dict = {}
    for k, p, v, a in rows:
        if k is not None and p is not None and a - p <= 4:
            want[k, p] = want.get((k, p), 0.0) + (v or 0.0)
    want = {(k, p): sum(v for (x, q), v in want.items() if x == k and q <= p) for k, p in want}
    in_order = sorted(rows, key=lambda r: r[3])
    assert replayed(spark, tmp_path / "one", [rows], arrival="a") == want
    assert replayed(spark, tmp_path / "many", [in_order[i : i + 60] for i in range(0, 300, 60)], arrival="a") == want
    assert replayed(spark, tmp_path / "mixed", [rows[i : i + 60] for i in range(0, 300, 60)], arrival="a") == want


def test_stream_windows_equal_batch(spark, data):
    got = streams.stream_windows(spark, data, "1 day")
    want = spark.read.parquet(f"{data}/events.parquet").groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("desde"), "event_type").count()
    assert sorted((r["desde"], r["event_type"], r["n"]) for r in got.collect()) == sorted(map(tuple, want.collect()))
