import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from tamizal.operators import timestamps as ts

GYE, MAD, NYC = "America/Guayaquil", "Europe/Madrid", "America/New_York"


def us(*args):
    return int((datetime(*args, tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))


CASES = [
    ("2024-02-26", GYE, "DMY", us(2024, 2, 26, 5), "unica"),
    (" 2024-02-26 ", GYE, "DMY", us(2024, 2, 26, 5), "unica"),
    ("2024/02/26", GYE, "DMY", us(2024, 2, 26, 5), "unica"),
    ("20240226", GYE, "DMY", us(2024, 2, 26, 5), "unica"),
    ("26/02/2024", GYE, "DMY", us(2024, 2, 26, 5), "unica"),
    ("02/26/2024", NYC, "MDY", us(2024, 2, 26, 5), "unica"),
    ("26/02/2024", NYC, "MDY", None, None),
    ("26 de febrero de 2024, 10:45", GYE, "DMY", us(2024, 2, 26, 15, 45), "unica"),
    ("Feb 26, 2024 12:15 AM", NYC, "MDY", us(2024, 2, 26, 5, 15), "unica"),
    ("26/2/2024 12:15 PM", GYE, "DMY", us(2024, 2, 26, 17, 15), "unica"),
    ("26.02.2024 08:00", MAD, "DMY", us(2024, 2, 26, 7), "unica"),
    ("26-feb-2024 10h59", GYE, "DMY", us(2024, 2, 26, 15, 59), "unica"),
    ("02/26/24 10:59", NYC, "MDY", us(2024, 2, 26, 15, 59), "unica"),
    ("Fri, 01 Aug 2025 10:59:37 -0500", MAD, "DMY", us(2025, 8, 1, 15, 59, 37), "explicita"),
    ("20240226T200000-0500", MAD, "DMY", us(2024, 2, 27, 1), "explicita"),
    ("20240226200000", GYE, "DMY", us(2024, 2, 27, 1), "unica"),
    ("2024-02-26T00:00:00.123456789Z", GYE, "DMY", us(2024, 2, 26, 0, 0, 0, 123456), "explicita"),
    ("2024-02-26T00:00:00.7", GYE, "DMY", us(2024, 2, 26, 5, 0, 0, 700000), "unica"),
    ("1683562605", MAD, "DMY", 1683562605 * 10**6, "explicita"),
    ("1684141140856", MAD, "DMY", 1684141140856 * 1000, "explicita"),
    ("2024-02-26 10:00:00 ECT", GYE, "DMY", us(2024, 2, 26, 15), "explicita"),
    ("2024-07-01 10:00:00 GALT", "Pacific/Galapagos", "DMY", us(2024, 7, 1, 16), "explicita"),
    ("2024-11-03 01:56:00 EDT", NYC, "MDY", us(2024, 11, 3, 5, 56), "explicita"),
    ("2024-11-03 01:56:00 EST", NYC, "MDY", us(2024, 11, 3, 6, 56), "explicita"),
    ("2024-11-03 01:30:00", NYC, "MDY", us(2024, 11, 3, 5, 30), "ambigua"),
    ("2024-03-10 02:30:00", NYC, "MDY", us(2024, 3, 10, 7, 30), "inexistente"),
    ("2024-10-27 02:30:00", MAD, "DMY", us(2024, 10, 27, 0, 30), "ambigua"),
    ("2024-03-31 02:54", MAD, "DMY", us(2024, 3, 31, 1, 54), "inexistente"),
    ("2024-02-30", GYE, "DMY", None, None),
    ("0000-00-00", GYE, "DMY", None, None),
    ("31/04/2025 10:00", GYE, "DMY", None, None),
    ("2024-13-05 09:00", GYE, "DMY", None, None),
    ("2024-01-05 25:00", GYE, "DMY", None, None),
    ("13:00 PM", GYE, "DMY", None, None),
    ("por definir", GYE, "DMY", None, None),
    ("N/D", GYE, "DMY", None, None),
    ("", GYE, "DMY", None, None),
    (None, GYE, "DMY", None, None),
    ("2024-02-26", None, "DMY", None, None),
    ("2024-02-26", "Atlantis/Nowhere", "DMY", None, None),
    ("2024-02-26T00:00:00Z", None, None, us(2024, 2, 26), "explicita"),
    ("x" * 200_000, GYE, "DMY", None, None),
]


def test_cases(spark):
    d = spark.createDataFrame([(i, *c[:3], "clash") for i, c in enumerate(CASES)], "i int, v string, z string, o string, instante_us string")
    out = {r["i"]: r for r in ts.normalise_timestamps(d, value="v", zone="z", order="o").collect()}
    wrong = [(c[0], out[i]["instante_us"], c[3], out[i]["lectura"]) for i, c in enumerate(CASES) if (out[i]["instante_us"], out[i]["lectura"]) != c[3:]]
    assert not wrong


def test_local_clock(spark):
    d = spark.createDataFrame([("2024-03-01T02:00:00Z", GYE), ("2024-03-01", GYE)], "v string, z string").selectExpr("*", "'DMY' o")
    rows = ts.normalise_timestamps(d, value="v", zone="z", order="o", with_local=True).collect()
    assert [r["local_us"] for r in rows] == [us(2024, 2, 29, 21), us(2024, 3, 1)]


def test_empty(spark):
    d = spark.createDataFrame([], "v string, z string, o string")
    assert ts.normalise_timestamps(d, value="v", zone="z", order="o").count() == 0


FORMATS = [
    (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"), (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d"), (r"\d{8}", "%Y%m%d"), (r"\d{14}", "%Y%m%d%H%M%S"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "%Y-%m-%d %H:%M:%S"), (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}", "%Y-%m-%dT%H:%M"),
    (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}", "%Y-%m-%dT%H:%M:%S.%f"), (r"\d{2}/\d{2}/\d{4}", "{}%Y"), (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}", "{}%Y %H:%M"),
    (r"\d{2}/\d{2}/\d{2} \d{2}:\d{2}", "{}%y %H:%M"), (r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2} [AP]M", "{}%Y %I:%M %p"), (r"\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}", "{}%Y %H:%M"),
    (r"\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}", "{}%Y %H:%M:%S"), (r"[A-Z][a-z]{2} \d{1,2}, \d{4}", "%b %d, %Y"), (r"[A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d{2} [AP]M", "%b %d, %Y %I:%M %p"),
    (r"\d{1,2} de \w+ de \d{4}", "%d de %m de %Y"), (r"\d{1,2} de \w+ de \d{4}, \d{2}:\d{2}", "%d de %m de %Y, %H:%M"), (r"\d{2}-[a-z]{3}-\d{4} \d{2}h\d{2}", "%d-%m-%Y %Hh%M"),
    (r"[A-Z][a-z]{2}, \d{2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}", "%a, %d %b %Y %H:%M:%S %z"), (r"\d{8}T\d{6}[+-]\d{4}", "%Y%m%dT%H%M%S%z"),
    (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} [+-]\d{4}", "%Y-%m-%d %H:%M:%S %z"), (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})", "iso"),
]
SPANISH = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
ABBREVIATED = {"ECT": -5, "COT": -5, "GALT": -6, "EST": -5, "EDT": -4, "CET": 1, "CEST": 2, "UTC": 0}


def plain(text, zone, order):
    """A slow reading of its own: formats tried one after another, zones by fold and round trip."""
    t = text.strip()
    if re.fullmatch(r"\d{10}|\d{13}", t):
        return int(t) * (10**6 if len(t) == 10 else 1000)
    t = re.sub(r"(\.\d{6})\d+(?=Z)", r"\1", t)
    shift = None
    if m := re.fullmatch(r"(.*) ([A-Z]{3,4})", t):
        if m[2] in ABBREVIATED:
            t, shift = m[1], ABBREVIATED[m[2]]
    for pattern, form in FORMATS:
        if re.fullmatch(pattern, t):
            if "%m de" in form or "%m-%Y" in form and "h" in form:
                t = re.sub(r"[a-z]{3,}", lambda m: next((str(k + 1) for k, n in enumerate(SPANISH) if n[:3] == m[0][:3]), "99"), t)
            sep = "." if "." in pattern[:8] else "-" if "-" in pattern[:8] else "/"
            form = form.replace("{}", f"%m{sep}%d{sep}" if order == "MDY" else f"%d{sep}%m{sep}")
            try:
                d = datetime.fromisoformat(t) if form == "iso" else datetime.strptime(t, form)
            except ValueError:
                return None
            if shift is not None:
                d = d.replace(tzinfo=timezone(timedelta(hours=shift)))
            if d.tzinfo is None:
                d = d.replace(tzinfo=ZoneInfo(zone))  # fold=0: the first of two, and the offset before a gap
            return int((d.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))
    return None


def test_against_plain_reading(spark, data):
    from tamizal.plans import problems
    from tamizal.session import table

    sources = {r["fuente_id"]: r for r in table(spark, data, "fuente").collect()}
    rows = table(spark, data, "proceso_resumen").select("fila_id", "fuente_id", "fecha", "publicado", "cierra").collect()
    got = {(r["fila_id"], r["campo"]): r["instante_us"] for r in problems.p6_instants(spark, data).collect()}
    wrong = []
    for r in rows:
        s = sources[r["fuente_id"]]
        for c in ("fecha", "publicado", "cierra"):
            if r[c] is not None and got[r["fila_id"], c] != plain(r[c], s["zona"], s["orden_fecha"]):
                wrong.append((r[c], s["zona"], got[r["fila_id"], c], plain(r[c], s["zona"], s["orden_fecha"])))
    assert not wrong, wrong[:10]


@pytest.mark.parametrize("zone", ["UTC", GYE, MAD, NYC, "Pacific/Galapagos"])
def test_intervals_cover_the_line(zone):
    rows = ts._zone_rows(zone)
    assert len(rows) == ts.LAST_YEAR - ts.FIRST_YEAR + 1
    assert all(r[2] for r in rows)
    assert rows[0][2][0][0] < -(1 << 60) and rows[-1][2][-1][1] > 1 << 60


def test_restated_counts_against_plain_python(spark, data):
    """p1_found from plain Python over the same rows."""
    from collections import Counter

    from tamizal.plans import problems
    from tamizal.session import table

    sources = {r["fuente_id"]: r for r in table(spark, data, "fuente").collect()}
    best = {}
    for r in table(spark, data, "proceso_resumen").collect():
        s = sources[r["fuente_id"]]
        at = r["fecha"] and plain(r["fecha"], s["zona"], s["orden_fecha"])
        if at is None or at == "":
            continue
        there = (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=at)).astimezone(ZoneInfo(s["zona"]))
        event, arrival = there.year * 12 + there.month - 1, r["anio"] * 12 + r["mes"] - 1
        if arrival - event <= 4 and (r["ocid"] not in best or (arrival, r["fila_id"]) > best[r["ocid"]][0]):
            best[r["ocid"]] = ((arrival, r["fila_id"]), event, r["comprador_ruc"])
    change = Counter((e // 12, e % 12 + 1, b) for _, e, b in best.values() if b is not None)
    for r in {tuple(x) for x in table(spark, data, "hecho_mes").collect()}:
        if r[2] is not None:
            change[r[0], r[1], r[2]] -= r[5] or 0
    got = {(r["anio"], r["mes"], r["comprador_ruc"]): r["n_cambio"] for r in problems.p1_found(spark, data).collect()}
    assert got == {k: v for k, v in change.items() if v}
