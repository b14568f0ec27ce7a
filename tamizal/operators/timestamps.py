"""Mixed timestamp formats and zones -> one instant (microseconds since 1970-01-01 UTC).

A text is first taken apart on the JVM (one regular expression per family of forms, no Python per
row).  A text that carries no zone is then resolved by an as-of join of its local time to the
zone-offset intervals of its source's zone: the intervals come from the public time zone database,
exploded to one row per zone and local year so that the join is an equality join.  Exactly one
matching interval gives the offset, two mean the hour occurs twice (the first is taken), none means
the hour was skipped (the offset before the change is taken).

The interval table has at most (zones of the tz database, about 600) x (years, 201) rows, whatever
the data hold, because names outside the database produce no rows; that bound is why it may be
broadcast.  The plan has no shuffle of the values.

Defined cases: null, blank, placeholder and impossible texts give a null instant; a value without
zone whose source has no known zone gives null; repeated rows each get their own result; columns of
the input that carry the names of the results are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIRST_YEAR, LAST_YEAR = 1900, 2100
_OPEN = 1 << 62

#: Abbreviations that the tz database no longer carries, seconds east of UTC.
LEGACY_ABBREVIATIONS = {
    "America/Guayaquil": {"ect": -18000},
    "Pacific/Galapagos": {"galt": -21600},
    "America/Bogota": {"cot": -18000, "cost": -14400},
    "America/Lima": {"pet": -18000, "pest": -14400},
    "America/Caracas": {"vet": -14400},
    "America/La_Paz": {"bot": -14400},
    "America/Santiago": {"clt": -14400, "clst": -10800},
    "America/Asuncion": {"pyt": -14400, "pyst": -10800},
    "America/Montevideo": {"uyt": -10800, "uyst": -7200},
    "America/Sao_Paulo": {"brt": -10800, "brst": -7200},
    "America/Argentina/Buenos_Aires": {"art": -10800, "arst": -7200},
}
#: Abbreviations with one meaning everywhere, used where the source's zone has none.
WORLD_ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "ut": 0, "z": 0, "wet": 0, "west": 3600, "cet": 3600, "cest": 7200,
    "eet": 7200, "eest": 10800, "est": -18000, "edt": -14400, "cdt": -18000,
    "mst": -25200, "mdt": -21600, "pst": -28800, "pdt": -25200, "ect": -18000, "galt": -21600,
    "cot": -18000,
}
#: Month by the first three letters, accents removed (Spanish, English, Portuguese).
MONTHS = {
    "ene": 1, "jan": 1, "feb": 2, "fev": 2, "mar": 3, "abr": 4, "apr": 4, "may": 5, "mai": 5,
    "jun": 6, "jul": 7, "ago": 8, "aug": 8, "sep": 9, "set": 9, "oct": 10, "out": 10, "nov": 11,
    "dic": 12, "dec": 12, "dez": 12,
}

_ZONE = r"(z|(?:utc|gmt)?[+-]\d{1,2}(?::?\d{2})?|[a-z]{2,5})?"
_CLOCK = r"(?:[t, ]+(\d{1,2})(?:[:h.](\d{2})(?:[:.m](\d{2})(?:[.,](\d+))?)?s?)? ?([ap]\.? ?m\.?)? ?" + _ZONE + r")?$"
_LETTERS = "[a-záéíóúüñç]"
#: family -> (pattern, replacement giving y|m|d|hour|minute|second|fraction|ampm|zone)
_FAMILIES = {
    "iso": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _CLOCK, "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    "compact": (
        r"^(\d{4})(\d{2})(\d{2})(?:[t ]?(\d{2})(\d{2})(\d{2})?(?:[.,](\d+))?)?()? ?" + _ZONE + "$",
        "$1|$2|$3|$4|$5|$6|$7||$9",
    ),
    "numeric": (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})" + _CLOCK, "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    "dayname": (
        rf"^(?:{_LETTERS}+\.?,? )?(\d{{1,2}})(?: de |[-/. ])({_LETTERS}+)\.?(?: del? |, |[-/. ])(\d{{4}})" + _CLOCK,
        "$3|$2|$1|$4|$5|$6|$7|$8|$9",
    ),
    "monthname": (
        rf"^(?:{_LETTERS}+\.?,? )?({_LETTERS}+)\.? (\d{{1,2}}),? (\d{{4}})" + _CLOCK,
        "$3|$1|$2|$4|$5|$6|$7|$8|$9",
    ),
}

INTERVALS = T.StructType(
    [
        T.StructField("zona", T.StringType()),
        T.StructField("anio", T.IntegerType()),
        T.StructField(
            "tramos",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("desde", T.LongType()),
                        T.StructField("hasta", T.LongType()),
                        T.StructField("desfase", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField("siglas", T.MapType(T.StringType(), T.LongType())),
    ]
)


def _zone_rows(name: str) -> list[tuple]:
    """Every (year, intervals) of one zone; [] when the tz database has no such zone."""
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    try:
        zone = ZoneInfo(name)
    except Exception:  # unknown, blank or malformed names
        return []
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def state(day_s: int) -> tuple[int, str]:
        at = (epoch + timedelta(seconds=day_s)).astimezone(zone)
        return int(at.utcoffset().total_seconds()), at.tzname().lower()

    step = 7 * 86400
    t = int((datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds())
    end = int((datetime(LAST_YEAR + 1, 1, 10, tzinfo=timezone.utc) - epoch).total_seconds())
    now, changes = state(t), []
    siglas = {now[1]: now[0]}
    while t < end:
        nxt = state(t + step)
        if nxt != now:
            lo, hi = t, t + step
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if state(mid) == now else (lo, mid)
            after = state(hi)
            if after[0] != now[0]:
                changes.append((hi, now[0], after[0]))
            siglas[after[1]] = after[0]
            now, t = after, hi
        else:
            t += step
    siglas = {k: v for k, v in siglas.items() if k.isalpha() and k != "lmt"} | LEGACY_ABBREVIATIONS.get(name, {})
    first = changes[0][1] if changes else now[0]
    utc = [(-_OPEN, first)] + [(at, off) for at, _, off in changes]
    spans = []
    for k, (start, off) in enumerate(utc):
        stop = utc[k + 1][0] if k + 1 < len(utc) else None
        spans.append((start if k == 0 else (start + off) * 1_000_000, _OPEN if stop is None else (stop + off) * 1_000_000, off))
    rows = []
    for year in range(FIRST_YEAR, LAST_YEAR + 1):
        a = int((datetime(year, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds() - 3 * 86400) * 1_000_000
        b = int((datetime(year + 1, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds() + 3 * 86400) * 1_000_000
        a = -_OPEN if year == FIRST_YEAR else a
        b = _OPEN if year == LAST_YEAR else b
        rows.append((name, year, [s for s in spans if s[0] < b and s[1] > a], siglas))
    return rows


def zone_intervals(zones: DataFrame, column: str = "zona") -> DataFrame:
    """(zona, anio, tramos, siglas): the zones' offset intervals exploded by local year."""

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name in frame["zona"]:
                rows = _zone_rows(name)
                if rows:
                    yield pd.DataFrame(rows, columns=["zona", "anio", "tramos", "siglas"])

    names = zones.select(F.col(column).alias("zona")).where(F.col("zona").isNotNull()).distinct()
    return names.mapInPandas(build, INTERVALS)


def _int(x: Column) -> Column:
    return x.try_cast("int")


def normalise_timestamps(
    df: DataFrame,
    *,
    value: str,
    zone: str,
    order: str,
    prefix: str = "",
    intervals: DataFrame | None = None,
    with_local: bool = False,
) -> DataFrame:
    """Adds `{prefix}instante_us` (long), `{prefix}lectura` (string) and, on demand,
    `{prefix}local_us` (the wall clock of the source's zone, as microseconds).

    value, zone and order name columns of df: the text, the IANA zone of values that name none and
    DMY or MDY for numeric dates that do not start with the year (anything but MDY means DMY).
    lectura is explicita, unica, ambigua, inexistente or null when the text denotes no time.
    """
    kept = [c for c in df.columns if c not in {f"{prefix}instante_us", f"{prefix}lectura", f"{prefix}local_us"}]
    raw = F.col(f"`{value}`").cast("string")
    text = F.lower(F.trim(F.regexp_replace(raw, r"[\s\u00a0\u2007\u2009\u202f\ufeff]+", " ")))
    d = df.select(*[F.col(f"`{c}`") for c in kept], text.alias("__t"), F.col(f"`{zone}`").alias("__z"), F.upper(F.trim(F.col(f"`{order}`"))).alias("__o"))

    epoch = F.col("__t").rlike(r"^-?(\d{9,10}|\d{13}|\d{16}|\d{19})$")
    family = F.when(epoch, F.lit("epoch"))
    for name in ("iso", "numeric", "compact", "dayname", "monthname"):
        family = family.when(F.col("__t").rlike(_FAMILIES[name][0]), F.lit(name))
    d = d.withColumn("__f", family)
    parts = F.lit(None).cast("string")
    for name, (pattern, into) in _FAMILIES.items():
        parts = F.when(F.col("__f") == name, F.regexp_replace(F.col("__t"), pattern, into)).otherwise(parts)
    d = d.withColumn("__p", F.split(parts, r"\|", -1))

    def part(k: int) -> Column:
        return F.nullif(F.col("__p")[k], F.lit(""))

    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    year = _int(part(0)) + F.when(F.length(part(0)) == 2, F.when(_int(part(0)) < 70, 2000).otherwise(1900)).otherwise(0)
    mdy = (F.col("__f") == "numeric") & (F.col("__o") == "MDY")
    second, third = F.when(mdy, part(2)).otherwise(part(1)), F.when(mdy, part(1)).otherwise(part(2))
    month = F.when(second.rlike(r"^\d+$"), _int(second)).otherwise(F.try_element_at(months, F.translate(F.substring(second, 1, 3), "áéíóú", "aeiou")))
    d = d.withColumns(
        {
            "__dia": F.unix_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(third, 2, "0")).try_cast("date")),
            "__ok": year.isNotNull() & month.isNotNull() & third.isNotNull() & (year >= 1),
            "__h": F.coalesce(_int(part(3)), F.lit(0)),
            "__mi": F.coalesce(_int(part(4)), F.lit(0)),
            "__s": F.coalesce(_int(part(5)), F.lit(0)),
            "__us": F.coalesce(_int(F.rpad(F.substring(part(6), 1, 6), 6, "0")), F.lit(0)),
            "__ap": F.substring(part(7), 1, 1),
            "__tz": part(8),
        }
    )
    h, mi, s, ap = F.col("__h"), F.col("__mi"), F.col("__s"), F.col("__ap")
    clock_ok = (mi < 60) & (s < 60) & F.when(ap.isNotNull(), h.between(1, 12)).otherwise((h < 24) | ((h == 24) & (mi == 0) & (s == 0) & (F.col("__us") == 0)))
    hour = F.when(ap.isNull(), h).otherwise(h % 12 + F.when(ap == "p", 12).otherwise(0))
    wall = (F.col("__dia").cast("long") * 86400 + hour * 3600 + mi * 60 + s) * 1_000_000 + F.col("__us")
    d = d.withColumn("__w", F.when(F.col("__ok") & clock_ok, wall))
    d = d.withColumn("__y", F.least(F.greatest(F.year(F.date_from_unix_date(F.col("__dia"))), F.lit(FIRST_YEAR)), F.lit(LAST_YEAR)))

    if intervals is None:
        intervals = zone_intervals(df.select(F.col(f"`{zone}`").alias("zona")))
    iv = intervals.select(F.col("zona").alias("__iz"), F.col("anio").alias("__iy"), F.col("tramos").alias("__tr"), F.col("siglas").alias("__si"))
    # at most ~600 x 201 rows (see above), hence the hint; values without a date join any year of their zone
    d = d.join(F.broadcast(iv), (F.col("__z") == F.col("__iz")) & (F.coalesce(F.col("__y"), F.lit(LAST_YEAR)) == F.col("__iy")), "left")

    tz = F.col("__tz")
    shift = F.regexp_replace(tz, "^(utc|gmt)(?=[+-])", "")
    digits = F.regexp_replace(shift, "[+:-]", "")
    hours = _int(F.when(F.length(digits) <= 2, digits).otherwise(F.expr("left(__dg, length(__dg) - 2)")))
    minutes = _int(F.when(F.length(digits) <= 2, F.lit("0")).otherwise(F.expr("right(__dg, 2)")))
    d = d.withColumn("__dg", digits)
    sign = F.when(shift.startswith("-"), -1).otherwise(1)
    world = F.create_map(*[F.lit(x) for k, v in WORLD_ABBREVIATIONS.items() for x in (k, v)])
    named = F.coalesce(F.try_element_at(F.col("__si"), tz), F.try_element_at(world, tz).cast("long"))
    fixed = F.when(shift.rlike(r"^[+-]\d"), F.when((hours <= 18) & (minutes < 60), (sign * (hours * 3600 + minutes * 60)).cast("long"))).otherwise(named)
    d = d.withColumn("__fx", F.when(tz.isNotNull(), fixed))

    hits = F.filter("__tr", lambda x: (x["desde"] <= F.col("__w")) & (F.col("__w") < x["hasta"]))
    d = d.withColumn("__hit", F.when(tz.isNull() & F.col("__w").isNotNull(), hits))
    d = d.withColumn("__n", F.size("__hit"))
    before = F.element_at(F.filter("__tr", lambda x: x["hasta"] <= F.col("__w")), -1)["desfase"]
    offset = (
        F.when(tz.isNotNull(), F.col("__fx"))
        .when(F.col("__n") == 1, F.col("__hit")[0]["desfase"])
        .when(F.col("__n") > 1, F.array_max(F.transform("__hit", lambda x: x["desfase"])))
        .when(F.col("__n") == 0, before)
    )
    long_t = F.col("__t").try_cast("long")
    width = F.length(F.regexp_replace(F.col("__t"), "^-", ""))
    from_epoch = F.when(width <= 10, long_t * 1_000_000).when(width == 13, long_t * 1000).when(width == 16, long_t).otherwise(F.floor(long_t / F.lit(1000)).cast("long"))
    is_epoch = F.col("__f") == "epoch"
    d = d.withColumn("__i", F.when(is_epoch, from_epoch).otherwise(F.col("__w") - offset * 1_000_000))
    reading = F.when(F.col("__i").isNull(), F.lit(None)).when(is_epoch | tz.isNotNull(), "explicita").when(F.col("__n") == 1, "unica").when(F.col("__n") > 1, "ambigua").otherwise("inexistente")
    out = [*[F.col(f"`{c}`") for c in kept], F.col("__i").alias(f"{prefix}instante_us"), reading.alias(f"{prefix}lectura")]
    if with_local:
        there = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(F.col("__i")), F.when(F.col("__tr").isNotNull(), F.col("__z")).otherwise("UTC")))
        local = F.when(F.col("__i").isNull(), None).when(is_epoch | tz.isNotNull(), F.when(F.col("__tr").isNotNull(), there)).otherwise(F.col("__w"))
        out.append(local.alias(f"{prefix}local_us"))
    return d.select(*out)
