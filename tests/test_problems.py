import json
import re
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tamizal.operators import late_events, nested, orphans, snapshots, units
from tamizal.plans import problems
from tamizal.session import table

# Late events


def brute_restate(events, max_late):
    best = {}
    for order, key, event, arrival, group in events:
        if key is None or event is None or arrival is None or arrival - event > max_late:
            continue
        if key not in best or (arrival, order) > best[key][0]:
            best[key] = ((arrival, order), event, group)
    return Counter((e, g) for _, e, g in best.values())


@pytest.mark.parametrize("interval", [1, 3, 100])
def test_late_events_equal_brute_force(spark, interval):
    import random

    rnd = random.Random(interval)
    events = []
    for i in range(800):
        arrival = rnd.randint(0, 23)
        event = None if rnd.random() < 0.05 else arrival - rnd.choice([0, 0, 0, 1, 2, 5, 9, -1])
        key = None if rnd.random() < 0.02 else "hot" if rnd.random() < 0.3 else f"k{rnd.randint(0, 150)}"
        events.append((i, key, event, arrival, None if rnd.random() < 0.05 else f"g{rnd.randint(0, 4)}"))
    events += events[:20]  # repeated rows
    d = spark.createDataFrame(events, "o long, k string, e int, a int, g string")
    pub = spark.createDataFrame([(1, "g1", 3), (1, "g1", 2), (99, "g0", 1), (1, None, 4)], "e int, g string, n int")
    got = late_events.restate(d, pub, key="k", event="e", arrival="a", order="o", group="g", count="n", max_late=4, interval=interval).collect()
    want = brute_restate(events, 4)
    assert Counter({(r["evento"], r["g"]): r["restado"] for r in got if r["restado"]}) == want
    assert {(r["evento"], r["g"]): r["publicado"] for r in got if r["publicado"]} == {(1, "g1"): 5, (99, "g0"): 1, (1, None): 4}


def test_late_events_empty(spark):
    d = spark.createDataFrame([], "o long, k string, e int, a int, g string")
    pub = spark.createDataFrame([], "e int, g string, n int")
    assert late_events.restate(d, pub, key="k", event="e", arrival="a", order="o", group="g", count="n", max_late=4).count() == 0


def test_checkpoints_precede_their_segment(spark):
    d = spark.createDataFrame([(1, "k", 0, 0, "a"), (2, "k", 3, 3, "b"), (3, "k", 2, 6, "c")], "o long, k string, e int, a int, g string")
    rows = late_events.checkpoints(d, key="k", event="e", arrival="a", order="o", carry=["g"], interval=3).orderBy("tramo").collect()
    assert [r["punto"] and r["punto"]["g"] for r in rows] == [None, "a", "b"]
    assert [r["tardio"] for r in rows] == [False, False, True]


def test_replay_uses_only_the_restored_checkpoint(spark):
    """Checkpoints after the first disturbed segment are void; undisturbed keys keep their last state."""
    state = "struct<llegada:int,orden:long,evento:int,g:string>"
    a, b, c, void = (0, 1, 0, "a"), (3, 2, 2, "b"), (6, 3, 6, "c"), (99, 9, 9, "void")
    rows = [
        ("late", 0, a, False, None), ("late", 1, b, True, a), ("late", 2, c, False, void),
        ("first", 0, b, True, None),
        ("calm", 0, a, False, None), ("calm", 2, c, False, a),
    ]
    points = spark.createDataFrame(rows, f"k string, tramo int, estado {state}, tardio boolean, punto {state}")
    got = {r["k"]: (r["publicado"] and tuple(r["publicado"]), r["estado"] and tuple(r["estado"]), r["repuesto"]) for r in late_events.replay(points, key="k").collect()}
    assert got == {"late": (a, c, True), "first": (None, b, True), "calm": (c, None, False)}


@pytest.mark.parametrize("interval", [1, 4])
def test_stored_checkpoints_equal_one_pass(spark, tmp_path, interval):
    """Deliveries in any order, restored and replayed from the folder, end in the state of one pass;
    outputs are replaced key by key; a delivery leaves the other keys' snapshots as they are."""
    import random

    rnd = random.Random(interval)
    events = []
    for i in range(500):
        arrival = rnd.randint(0, 23)
        events.append((i, None if rnd.random() < 0.02 else "hot" if rnd.random() < 0.3 else f"k{rnd.randint(0, 60)}", arrival - rnd.choice([0, 0, 1, 5, -1]), arrival, f"g{rnd.randint(0, 4)}"))
    kind = "o long, k string, e int, a int, g string"
    late_first = sorted(events, key=lambda x: -x[3])
    store = late_events.CheckpointStore(str(tmp_path / "s"), key="k", event="e", arrival="a", order="o", carry=["g"], max_late=4, interval=interval)
    counts = Counter()
    for v in range(5):
        for r in store.deliver(spark.createDataFrame(late_first[v * 100 : v * 100 + 100], kind), v).collect():
            counts[r["despues"]["evento"], r["despues"]["g"]] += 1
            if r["antes"] is not None:
                counts[r["antes"]["evento"], r["antes"]["g"]] -= 1
    assert +counts == brute_restate(events, 4)
    assert store.deliver(spark.createDataFrame(late_first[:100], kind), 5).count() == 0  # a delivery that comes again
    assert store.deliver(spark.createDataFrame([], kind), 6).count() == 0
    last = {r["k"] for r in spark.read.parquet(str(tmp_path / "s" / "version=4")).select("k").collect()}
    assert last <= {k for _, k, e, a, _ in late_first[400:] if k is not None and a - e <= 4}
    # what is restored decides: with other snapshots the replay ends elsewhere
    point = "struct<llegada:int,orden:long,evento:int,g:string>"
    forged = spark.createDataFrame([("z", 0, (99, 9, 1, "forged"), (99, 9, 1, "forged"))], f"k string, tramo int, estado {point}, hasta {point}")
    forged.write.parquet(str(tmp_path / "f" / "version=0"))
    other = late_events.CheckpointStore(str(tmp_path / "f"), key="k", event="e", arrival="a", order="o", carry=["g"], max_late=4, interval=interval)
    assert other.deliver(spark.createDataFrame([(1, "z", 20, 20, "true")], kind), 1).count() == 0


# Nested records


def as_list(v):
    if isinstance(v, str):
        try:
            p = json.loads(v)
        except ValueError:
            return []
        v = p if isinstance(p, list) else None
    return v if isinstance(v, list) else [v] if isinstance(v, dict) else []


def brute_children(reg, text):
    def plain(v):
        return "" if v is None else v if isinstance(v, str) else json.dumps(v)

    try:
        o = json.loads(text)
    except (ValueError, TypeError):
        return
    for rel in as_list(o["releases"]) if o.get("releases") is not None else [o]:
        if not rel.get("ocid"):
            continue
        tender = rel.get("tender") or {}
        for name, field in nested.TENDER_CHILDREN.items():
            for i, x in enumerate(as_list(tender.get(field))):
                if isinstance(x, dict):
                    own = plain(x.get("id"))
                    if name == "oferentes":
                        m = re.search(r"(?<!\d)\d{10,13}(?!\d)", own)
                        own = m[0] if m else ""
                    yield name, reg, rel["ocid"], "tender", i, own
        for a in as_list(rel.get("awards")):
            for i, x in enumerate(as_list(a.get("items") if isinstance(a, dict) else None)):
                if isinstance(x, dict):
                    yield "items", reg, rel["ocid"], plain(a.get("id")), i, plain(x.get("id"))


def test_names_within_the_distance_are_all_proposed(spark):
    """The index loses no pair that the edit distance accepts."""
    import random

    rnd = random.Random(6)
    known = sorted({k for each in units.ALIASES.values() for k in each if k.isalnum() or " " in k} | {"kilogramo", "unidad", "es es es es", "aaaaaaaaaa"})
    names = {"ecnitmtero ucbico", "es es es es es", "s s s s s s s", "aaaaaaaaaaa", *known}
    for k in known * 12:
        w = list(k)
        for _ in range(rnd.randint(1, 4)):
            i = rnd.randrange(len(w))
            how = rnd.random()
            if how < 0.6 and i:
                w[i - 1], w[i] = w[i], w[i - 1]
            elif how < 0.8:
                w.insert(i, w[i])
            elif len(w) > 1:
                del w[i]
        names.add("".join(w) + rnd.choice(["", "", "s", "es"]))
    want = {}
    for n in names:
        for k in known:
            short, d = min(len(n), len(k)), units.weighted_distance(n, k)
            if d == 0 or (short >= 3 and d < (0.25 if short < 4 else max(len(n), len(k)) * units.MAX_DISTANCE)):
                want[n] = min(want.get(n, (9, "")), (d, k))
    got = units.match_names(spark.createDataFrame([(n,) for n in names], "nombre string"), spark.createDataFrame([(k, k) for k in known], "alias string, unidad string"))
    assert {r["nombre"]: r["unidad"] for r in got.collect()} == {n: k for n, (_, k) in want.items()}
    assert want["ecnitmtero ucbico"][1] == "centimetro cubico"


def test_a_repeated_key_counts_with_its_last_value(spark):
    texts = [
        '{"ocid": "a", "ocid": "b", "tender": {"items": [{"id": 1, "id": 2}]}}',
        '{"ocid": "a", "tender": {"items": [{"id": 1}]}, "tender": {"items": [{"x": 1, "x": 2, "id": "z"}, {"id": 5, "id": null}]}}',
        '{"releases": [{"ocid": "c", "tender": {"lots": [{"id": 1}], "lots": {"id": 3}}}], "x": {"k": 1, "k": 2}}',
        '{"ocid": "d", "awards": [{"id": 1, "id": 9, "items": [{"id": 4}]}], "ocid": "e"}',
        '{"ocid": "f", "tender": {"tenderers": [{"id": "1791240502001", "id": "EC-RUC-0990004196001-1"}]}}',
    ]
    valid = '{"ocid": "g", "n": 1, "s": "t", "tender": {"items": [{"id": 1}]}}'
    texts += [valid.replace(a, b) for a, b in [('"n": 1', "'n': 1"), ("1,", "NaN,"), ("1,", "01,"), ("1,", "1,,"), ("1,", "1.,"), ('"t"', '"\t"'), ('"t"', '"\\q"'), ("}]}}", "}]}},"), ("}]}}", "}]}"), ('"t"', "t"), ("1,", "Infinity,"), ('"g"', '"g" /* c */')]]
    rows = list(enumerate(texts))
    got = {tuple(r) for r in nested.flatten_children(spark.createDataFrame(rows, "r long, t string"), row="r", text="t").collect()}
    want = {(x[0], x[1], x[2], x[3], x[4], x[5]) for i, t in rows for x in brute_children(i, t) if "NaN" not in t and "Infinity" not in t}
    assert got == want and {r[1] for r in got} == {0, 1, 2, 3, 4}


def test_children_of_odd_records(spark):
    item = {"id": 7}
    records = [
        {"ocid": "a", "tender": {"items": [item, None, {"id": "x"}], "tenderers": {"id": "EC-RUC-1791240502001-14583"}, "lots": "", "enquiries": None}},
        {"ocid": "b", "tender": {"items": json.dumps([None, item])}, "awards": {"id": 5, "items": [item]}},
        {"ocid": "c", "tender": None, "awards": [{"items": [{"no": 1}]}, None]},
        {"ocid": None, "tender": {"items": [item]}},
        {"tender": {"items": [item]}},
        {"releases": [{"ocid": "d", "tender": {"lots": [item]}}, {"ocid": "d", "tender": {"lots": [item]}}]},
        {"releases": []},
        {"ocid": "e", "tender": {"items": [1, "two", [3], item]}},
    ]
    texts = [json.dumps(r) for r in records] + [None, "", "{", json.dumps(records[0])[:-9], json.dumps(records[0]) + " x", "{}", "[]", "7"]
    d = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "r int, t string, tabla string")
    got = sorted(map(tuple, nested.flatten_children(d, row="r", text="t").collect()))
    want = sorted({x for i, t in enumerate(texts[:8]) for x in brute_children(i, t)})
    assert got == want
    assert nested.flatten_children(d.limit(0), row="r", text="t").count() == 0


def test_children_of_all_records(spark, data):
    got = list(map(tuple, problems.p2_found(spark, data).collect()))
    want = {x for r in table(spark, data, "detalle_mes").collect() for x in brute_children(r["reg_id"], r["registro"])}
    assert len(got) == len(set(got)) and set(got) == want


# Snapshots

FOTO = "foto int, s long, ocid string, estado string, monto double, extra string"


def changes(spark, rows):
    d = spark.createDataFrame(rows, FOTO)
    compare = {"estado": F.lower(snapshots.clean_text(F.col("estado"))), "monto": snapshots.clean_amount(F.col("monto"))}
    return sorted((r["entrega"], r["clave"], r["cambio"]) for r in snapshots.snapshot_changes(d, delivery="foto", key="ocid", sequence="s", compare=compare).collect())


def test_snapshot_changes(spark):
    rows = [
        (1, 1, "a", "Abierto ", 1.0, "x"), (1, 2, "b", "abierto", 2.0, "x"), (1, 3, "c", None, None, "x"), (1, 4, None, "z", 1.0, "x"), (1, 5, " ", "z", 1.0, "x"),
        (2, 1, " a ", "ABIERTO", 1.0000001, "y"), (2, 2, "b", "abierto", 2.01, "x"), (2, 3, "c", "", None, "x"), (2, 4, "d", "abierto", 1.0, "x"), (2, 5, "d", "cerrado", 1.0, "x"), (2, 5, "d", "cerrado", 1.0, "x"),
        (4, 1, "d", "cerrado", 1.0, "x"),
        (5, 1, None, "x", 1.0, "x"),
        (None, 1, "a", "x", 1.0, "x"),
    ]
    assert changes(spark, rows) == [(2, "b", "cambio"), (2, "d", "alta"), (4, "a", "baja"), (4, "b", "baja"), (4, "c", "baja"), (5, "d", "baja")]


def test_snapshot_single_and_empty(spark):
    assert changes(spark, [(1, 1, "a", "x", 1.0, "x")]) == []
    assert changes(spark, []) == []


# Orphans


def test_orphans(spark):
    child = spark.createDataFrame([(i, p, k) for i, (p, k) in enumerate([(202401, "A"), (202406, "A"), (202401, "B"), (202401, " B "), (202401, "Z"), (202401, None), (202401, ""), (None, "A"), (None, "C"), (202401, "C")])], "fila int, p int, k string")
    parent = spark.createDataFrame([("A", None, 202405), ("A", None, 202405), ("B", 202403, None), ("C", None, None), (None, None, None)], "k string, alta int, baja int")
    refs = orphans.references(child, row="fila", period=F.col("p"), fields={"f": snapshots.clean_text(F.col("k"))})
    par = orphans.parents({"f": (parent, F.col("k"))})
    got = {(r["fila"], r["clase"]) for r in orphans.orphan_rows(refs, par).collect()}
    assert got == {(1, "borrado"), (2, "posterior"), (3, "posterior"), (4, "ausente"), (7, "posterior")}
    none = orphans.parents({"f": (parent.limit(0), F.col("k"))})
    assert {r["clase"] for r in orphans.orphan_rows(refs, none).collect()} == {"ausente"}
    assert orphans.orphan_rows(refs.limit(0), par).count() == 0
    total = orphans.orphan_report(refs, par).agg(F.sum("n_referencias"), F.sum("n_huerfanas")).first()
    assert tuple(total) == (8, 5)


@pytest.mark.parametrize("text, key", [("EC-RUC-1791240502001-14583", "1791240502001"), ("ec-ruc-1791240502001", "1791240502001"), (" 1791240502001 ", "1791240502001"), ("", None), (" ", None), (None, None)])
def test_tax_id_key(spark, text, key):
    d = spark.createDataFrame([(text,)], "t string")
    assert d.select(orphans.tax_id_key(F.col("t"))).first()[0] == key


# Units

UNITS = [("kg", None, "kilogramo", 1), ("KGS.", None, "kilogramo", 1), (" Litros ", None, "litro", 1), ("galon", None, "litro", Decimal("3.785411784")), ("caja de 24 und", None, "unidad", 24), ("CAJA X 50PARES", None, "unidad", 100),
         ("balde (1/2 gal)", None, "litro", Decimal("1.892705892")), ("funda 2,5 kg", None, "kilogramo", Decimal("2.5")), ("rollo 1500 ft²", None, "metro cuadrado", Decimal("139.35456")), ("saco 1 qq.", None, "kilogramo", Decimal("45.359237")),
         ("caja", "Tubo, presentación caja de 12 UNIDADES", "unidad", 12), ("cajas", "Guante (caja x 1 gruesa)", "unidad", 144), (None, "Vidrio, medida en m2", "metro cuadrado", 1), ("n/a", "Suero (precio por GALÓN)", "litro", Decimal("3.785411784")),
         ("-", "Suero - cantidad expresada en c.c.", "litro", Decimal("0.001")), ("m³", None, "litro", 1000), ("miles de unidades", None, "unidad", 1000), ("metro lineal", None, "metro", 1), ('"', None, "metro", Decimal("0.0254")), ("@", None, "kilogramo", Decimal("11.33980925")),
         ("kilogrammos", None, "kilogramo", 1), ("hectareas", None, "metro cuadrado", 10000), ("pies cuadrados", None, "metro cuadrado", Decimal("0.09290304")), ("caneca", None, "litro", Decimal("18.92705892")), ("frasco x 0.75lts", None, "litro", Decimal("0.75"))]
NONE = [("mes", "Soporte por 12 meses"), ("global", "Suero, presentación frasco de 500 ml"), ("servicio", None), ("hora", None), ("caja", "Bombilla, empaque de 12"), (None, None), ("", ""), ("sin unidad", "Plancha de zinc"), ("libro", None), ("0 kg", None), ("x" * 50_000, None)]


def test_units(spark, data):
    conv = table(spark, data, "unidad_conv")
    rows = [(i, u, t, 41.49, 10.93, 1.0) for i, (u, t, *_) in enumerate(UNITS)] + [(100 + i, u, t, 41.49, 10.93, 1.0) for i, (u, t) in enumerate(NONE)]
    d = spark.createDataFrame(rows + rows[:2], "i int, u string, t string, q double, p double, factor double")
    got = [(r["i"], r["unidad_base"], r["cantidad_milesimas"], r["precio_diezmilesimas"]) for r in units.convert(d, conv, unit="u", description="t", quantity="q", price="p").collect()]
    half = lambda x: int(x.quantize(Decimal(1), ROUND_HALF_UP))
    want = [(i, b, half(Decimal("41.49") * f * 1000), half(Decimal("10.93") / f * 10000)) for i, (_, _, b, f) in enumerate(UNITS)]
    assert sorted(got) == sorted(want + want[:2])
    assert units.convert(d.limit(0), conv, unit="u", description="t", quantity="q", price="p").count() == 0


def test_weighted_distance():
    d = units.weighted_distance
    assert d("kilo", "kilo") == 0
    assert d("galones", "galon") == 0.5 and d("metros", "metro") == 0.25
    assert d("libro", "libra") == 1 and d("litor", "litro") == pytest.approx(0.6)


@pytest.mark.parametrize("name", ["p1_found", "p3_found", "p4_found", "p6_found", "p7_found"])
def test_found_has_no_repeats(spark, data, name):
    d = problems.QUERIES[name](spark, data)
    n = d.count()
    assert n > 0 and d.distinct().count() == n
