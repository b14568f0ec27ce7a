"""Quantities recorded in different units -> common base units.

Only the distinct spellings are interpreted.  Each is split into a count and a unit name ("caja de
24 und" -> 24, "und"); the distinct unit names are mapped to known ones through an inverted index of
character n-grams, and every candidate is verified by an edit distance whose weights make the usual
spelling noise (plural endings, doubled or dropped letters, swapped neighbours) cheap.  The resulting
alias dictionary is joined to all rows.

Defined cases: a null or blank spelling has no measure; so has one whose name is too far from every
known name, and one with a count but no name; time, services and lump sums are known names without
measure and end the search (the description is not consulted); zero counts have no measure; names
tied at equal distance take the alphabetically first unit; results outside the range of a 64-bit
integer are null.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .snapshots import BLANK

BROADCAST_SPELLINGS = 200_000
#: Longest weighted distance, relative to the longer name; exact for names under four letters.
MAX_DISTANCE = 0.15
#: Customary spellings of the canonical units.
ALIASES = {
    "kilogramo": ["kg", "kgs", "kgr", "kilo", "kilos", "kgrs"],
    "gramo": ["g", "gr", "grs", "gms"],
    "libra": ["lb", "lbs"],
    "onza": ["oz", "ozs"],
    "arroba": ["@", "arr"],
    "quintal": ["qq", "qqs", "qtl"],
    "tonelada": ["t", "tm", "ton", "tons", "tonelada metrica"],
    "litro": ["l", "lt", "lts", "ltr", "ltrs"],
    "mililitro": ["ml", "mls", "cc", "cm3", "centimetro cubico"],
    "galón": ["gal", "gals", "gl", "gls", "gln", "glns"],
    "caneca": [],
    "metro cúbico": ["m3", "mt3", "mts3"],
    "metro": ["m", "mt", "mts", "metro lineal"],
    "centímetro": ["cm", "cms"],
    "pulgada": ["pulg", "plg", "in", "inch", '"'],
    "pie": ["pies", "ft", "feet"],
    "yarda": ["yd", "yds"],
    "kilómetro": ["km", "kms"],
    "metro cuadrado": ["m2", "mt2", "mts2"],
    "pie cuadrado": ["ft2"],
    "hectárea": ["ha", "has"],
    "unidad": ["u", "un", "und", "unds", "uni", "unid", "c/u", "cada uno", "ea"],
    "par": ["pares", "prs"],
    "docena": ["doc", "docs", "dz", "dna"],
    "ciento": ["cto"],
    "gruesa": ["grz"],
    "millar": ["mil", "miles", "mll", "mil unidades", "miles de unidades"],
}
#: Names of what is not measured.
UNMEASURED = ["global", "glb", "servicio", "serv", "mes", "meses", "hora", "horas", "hr", "hrs", "dia", "dias", "semana", "año", "jornada", "suma alzada"]

_PHRASES = [
    r"(?:presentaci[oó]n|medid[ao] en|expresad[ao] en|cotiza por|precio por|unidad de medida:?|contenido:?) +(.+?) *\)?\.? *$",
    r"\(([^()]*[0-9][^()]*)\) *\.?$",
    r"(?:^|[ ,])((?:[a-zñáéíóú]+ )?(?:de |x )?[0-9]+(?:[.,/][0-9]+)? ?[a-zñáéíóúü][a-zñáéíóúü0-9.²³]*(?: (?:cuadrad|c[uú]bic|lineal)[a-z]*)?)$",
]
_SPLIT = r"^(?:[^0-9]*?)([0-9]+(?:[.,][0-9]+)*(?: ?/ ?[0-9]+)?) *(?:de )?([^0-9 ].*)$"


def spelling(c: Column) -> Column:
    """The form under which equal spellings meet: lower case, single inner blanks, no outer ones."""
    t = F.regexp_replace(F.regexp_replace(F.lower(c), BLANK, ""), r"[\s\u00a0]+", " ")
    return F.nullif(F.translate(t, "²³", "23"), F.lit(""))


def with_phrase(d: DataFrame, description: str, name: str) -> DataFrame:
    """Adds the part of a description that states a measure, or null.

    Step by step, so that each pattern runs at most once over a text, and the later ones only where
    the earlier ones found nothing.
    """
    first, *others = _PHRASES
    d = d.withColumn("__t", F.translate(F.lower(F.col(description)), "²³\u00a0\t\r\n", "23    "))
    d = d.withColumn(name, F.regexp_extract("__t", first, 1))
    for p in others:
        d = d.withColumn(name, F.when(F.col(name) == "", F.regexp_extract("__t", p, 1)).otherwise(F.col(name)))
    return d.withColumn(name, F.nullif(F.trim(F.col(name)), F.lit(""))).drop("__t")


def plain_name(c: Column) -> Column:
    """A unit name without accents and full stops."""
    t = F.translate(F.regexp_replace(c, r"[.()]", ""), "áéíóúüñ", "aeiouun")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def _count(text: Column) -> Column:
    """'0,5', '1/2', '1.500' and '20' as numbers."""
    t = F.regexp_replace(text, " ", "")
    t = F.when(t.rlike(r"^[1-9][0-9]{0,2}([.,][0-9]{3})+$"), F.regexp_replace(t, "[.,]", "")).otherwise(F.regexp_replace(t, ",", "."))
    over = F.split(t, "/")
    number = lambda x: x.try_cast("double")
    return F.when(F.size(over) == 2, F.try_divide(number(F.get(over, F.lit(0))), number(F.get(over, F.lit(1))))).otherwise(number(t))


def split_spelling(d: DataFrame) -> DataFrame:
    """Adds cuenta and nombre (the unit's plain name) to spellings in `texto`."""
    t = F.regexp_replace(F.col("texto"), r"[()]", " ")
    n, unit = F.regexp_extract(t, _SPLIT, 1), F.regexp_extract(t, _SPLIT, 2)
    lead = t.rlike(r"^ *[^0-9 ]") & ~t.rlike("[0-9] *$")
    plain = F.when(t.rlike(r"^[a-zñáéíóúü./ ]*[23]?$") | ~t.rlike("[0-9]"), t)
    return d.withColumn("cuenta", F.when(n != "", _count(n)).when(lead | t.isNotNull(), F.lit(1.0))).withColumn("nombre", F.nullif(F.when(n != "", plain_name(unit)).otherwise(plain_name(plain)), F.lit("")))


def grams(c: Column, n: int = 2) -> Column:
    """The distinct n-grams of a name with marked ends (short names keep at least one)."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))), lambda k: F.substring(padded, k, F.lit(n))))


def weighted_distance(a: str, b: str) -> float:
    """Edit distance; plural endings, doubled letters, dropped vowels and swaps cost less than 1."""
    la, lb = len(a), len(b)

    def gap(s: str, k: int) -> float:
        """Cost of the letter s[k] that the other name lacks."""
        c, end = s[k], k + 1 == len(s) or s[k + 1] == " "
        if c == "s" and end:
            return 0.25
        if c == "e" and k + 1 < len(s) and s[k + 1] == "s" and (k + 2 == len(s) or s[k + 2] == " "):
            return 0.25
        if c in " -":
            return 0.4
        if k and s[k - 1] == c:
            return 0.4
        return 0.7 if c in "aeiou" else 1.0

    rows = [[0.0] * (lb + 1) for _ in range(la + 1)]
    for i in range(1, la + 1):
        rows[i][0] = rows[i - 1][0] + gap(a, i - 1)
    for j in range(1, lb + 1):
        rows[0][j] = rows[0][j - 1] + gap(b, j - 1)
    for i in range(1, la + 1):
        for j in range(1, lb + 1):
            best = min(rows[i - 1][j] + gap(a, i - 1), rows[i][j - 1] + gap(b, j - 1), rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, rows[i - 2][j - 2] + 0.6)
            rows[i][j] = best
    return rows[la][lb]


def known_names(spark: SparkSession, units: DataFrame) -> DataFrame:
    """(alias, unidad): canonical names, their customary spellings, and what is not measured."""
    fixed = [(a, u) for u, each in ALIASES.items() for a in each] + [(a, None) for a in UNMEASURED]
    own = units.where("unidad is not null").select(F.lower("unidad").alias("alias"), F.col("unidad"))
    both = own.unionByName(spark.createDataFrame(fixed, "alias string, unidad string"))
    return both.select(plain_name(F.col("alias")).alias("alias"), "unidad").distinct()


def allowed_distance(a: Column, b: Column) -> Column:
    """The distance that two names have to stay under; those under four letters have to be equal."""
    return F.when(F.least(F.length(a), F.length(b)) < 4, F.lit(0.25)).otherwise(F.greatest(F.length(a), F.length(b)) * MAX_DISTANCE)


def least_shared(c: Column, n_grams: Column, allowed: Column) -> Column:
    """The least number of its 2-grams that a name shares with any other within the allowed distance.

    Per unit of cost an edit destroys at most 5 grams of a name (a swap 3 for 0.6, a doubled letter
    or blank 2 for 0.4); only its plural letters, of which each can be dropped once, go for 0.25 and
    destroy 2, which is 0.75 more than that rate.
    """
    plurals = F.regexp_count(c, F.lit(r"s(?= |\z)|e(?=s(?: |\z))"))
    return n_grams - 5 * allowed - 0.75 * plurals - 1e-9


def match_names(names: DataFrame, known: DataFrame) -> DataFrame:
    """(nombre, unidad): every distinct name within the allowed distance of a known one.

    The inverted index (n-gram -> known names) proposes the known names that share enough n-grams for
    the allowed distance; the edit distance decides.  The index has the size of the fixed vocabulary.
    """
    # every known name is in the index under each of its n-grams; its size does not follow the data
    known = known.withColumn("ga", grams(F.col("alias"))).withColumn("na", F.size("ga"))
    # a letter that the other name lacks costs at least 0.25, so a name over three times as long as
    # the longest known one is always beyond MAX_DISTANCE
    longest = 3 * (known.agg(F.max(F.length("alias"))).first()[0] or 0)
    asked = names.where(F.length("nombre") <= longest).withColumn("gn", F.when(F.length("nombre") <= longest, grams(F.col("nombre"))))
    asked = asked.withColumn("nn", F.size("gn"))
    index = known.select("alias", "unidad", "na", F.explode("ga").alias("g"))
    shared = asked.select("nombre", "nn", F.explode("gn").alias("g")).join(index, "g").groupBy("nombre", "alias", "unidad").agg(F.count(F.lit(1)).alias("c"), F.first("na").alias("na"), F.first("nn").alias("nn"))
    allowed = allowed_distance(F.col("nombre"), F.col("alias"))
    near = shared.where((F.col("c") >= least_shared(F.col("nombre"), F.col("nn"), allowed)) & (F.col("c") >= least_shared(F.col("alias"), F.col("na"), allowed)))
    # the longer of two names sets the allowed distance; where its own grams may all be destroyed (few
    # distinct ones or many plural letters) the index cannot propose, so these go to the distance as they are
    loose = lambda c, n: least_shared(c, n, F.length(c) * MAX_DISTANCE) <= 0
    some = known.select("alias", "unidad", "na")
    pairs = asked.select("nombre", "nn").join(F.broadcast(some), loose(F.col("nombre"), F.col("nn")) | loose(F.col("alias"), F.col("na")))  # known names are few
    # letters are lacked at 0.25 or more
    pairs = pairs.where(F.abs(F.length("nombre") - F.length("alias")) * 0.25 < allowed)
    near = near.select("nombre", "alias", "unidad").unionByName(pairs.select("nombre", "alias", "unidad")).distinct()

    @F.pandas_udf("double")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([weighted_distance(x, y) for x, y in zip(a, b)])

    scored = near.withColumn("d", distance("nombre", "alias"))
    ok = scored.where((F.col("d") == 0) | ((F.col("d") < allowed) & (F.least(F.length("nombre"), F.length("alias")) >= 3)))
    best = ok.groupBy("nombre").agg(F.min(F.struct("d", F.coalesce("unidad", F.lit("")).alias("u"))).alias("m"))
    return best.select("nombre", F.col("m.u").alias("unidad"))


def dictionary(spellings: DataFrame, units: DataFrame) -> DataFrame:
    """(texto, unidad_base, factor_k, medible): the measure of every distinct spelling.

    factor_k is thousandths of the base unit in one recorded unit; medible is false for known names
    that are not measured.  Spellings that give no measure have no row.
    """
    parts = split_spelling(spellings)
    known = known_names(spellings.sparkSession, units)
    names = parts.where("nombre is not null").select("nombre").distinct()
    hits = match_names(names, known)
    conv = units.groupBy("unidad").agg(F.min("unidad_base").alias("unidad_base"), F.min("factor").alias("factor"))
    d = parts.join(hits, "nombre").join(conv, "unidad", "left")
    factor = (F.col("factor").cast("decimal(20,12)") * F.col("cuenta").try_cast("decimal(14,6)")) * F.lit(1000)
    d = d.select("texto", "unidad_base", factor.try_cast("decimal(21,12)").alias("factor_k"), (F.col("unidad") != "").alias("medible"))
    return d.where(~F.col("medible") | (F.col("factor_k") > 0))


def convert(df: DataFrame, units: DataFrame, *, unit: str, description: str, quantity: str, price: str) -> DataFrame:
    """Adds unidad_base, cantidad_milesimas and precio_diezmilesimas to the rows whose measure can be
    told; the other rows are left out."""
    ensure_checkpoint_dir(df.sparkSession)
    d = with_phrase(df.withColumn("__u", spelling(F.col(unit))), description, "__f")
    texts = d.select("__u", "__f").distinct().select(F.explode(F.array("__u", "__f")).alias("texto")).where("texto is not null").distinct().checkpoint()
    words = dictionary(texts, units).checkpoint()
    n = words.count()

    def look(left: DataFrame, key: str, tag: str) -> DataFrame:
        side = words.select(F.col("texto").alias(key), *[F.col(c).alias(f"{tag}{c}") for c in ("unidad_base", "factor_k", "medible")])
        # beyond the checked size the join is shuffled, and adaptive execution splits its hot spellings
        return left.join(F.broadcast(side) if n <= BROADCAST_SPELLINGS else side, key, "left")

    d = look(look(d, "__u", "__a"), "__f", "__b")
    own = F.col("__amedible").isNotNull()
    pick = lambda c: F.when(own, F.col(f"__a{c}")).otherwise(F.col(f"__b{c}"))
    d = d.withColumn("unidad_base", pick("unidad_base")).withColumn("__k", pick("factor_k")).where(F.col("unidad_base").isNotNull() & F.col("__k").isNotNull())
    q, p = F.col(quantity).cast("double"), F.col(price).cast("double")
    amount = F.coalesce(F.round(q.try_cast("decimal(17,5)") * F.col("__k"), 0).try_cast("long"), F.floor(q * F.col("__k").cast("double") + 0.5).try_cast("long"))
    unit_price = F.coalesce((F.round(p.try_cast("decimal(18,6)") * 1000 / F.col("__k"), 4) * 10000).try_cast("long"), F.floor(p * 1e7 / F.col("__k").cast("double") + 0.5).try_cast("long"))
    out = d.withColumn("cantidad_milesimas", amount).withColumn("precio_diezmilesimas", unit_price)
    return out.drop("__u", "__f", "__k", *[f"__{t}{c}" for t in "ab" for c in ("unidad_base", "factor_k", "medible")])
