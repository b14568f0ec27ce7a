"""Scalar functions as Column expressions, inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Province by the first two digits of a tax id.
PROVINCES = {
    "01": "AZUAY", "02": "BOLIVAR", "03": "CAÑAR", "04": "CARCHI", "05": "COTOPAXI",
    "06": "CHIMBORAZO", "07": "EL ORO", "08": "ESMERALDAS", "09": "GUAYAS", "10": "IMBABURA",
    "11": "LOJA", "12": "LOS RIOS", "13": "MANABI", "14": "MORONA SANTIAGO", "15": "NAPO",
    "16": "PASTAZA", "17": "PICHINCHA", "18": "TUNGURAHUA", "19": "ZAMORA CHINCHIPE",
    "20": "GALAPAGOS", "21": "SUCUMBIOS", "22": "ORELLANA",
    "23": "SANTO DOMINGO DE LOS TSACHILAS", "24": "SANTA ELENA", "30": "EXTERIOR", "88": "EXTERIOR",
}


def number(c: Column) -> Column:
    """Text as double; anything that is not a plain number is null."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:nan|inf|infinity)$"), t.try_cast("double"))


#: The state that each release tag means, the furthest one first.
TAG_STATES = {"contract": "cerrado", "award": "adjudicado", "tender": "abierto", "planning": "planificacion"}


def tag_state(c: Column, states: dict[str, str] | None = None, other: str = "desconocido") -> Column:
    """The state of the furthest tag in a JSON array (or comma list) of tags (F2)."""
    t = F.trim(c)
    tags = F.coalesce(F.from_json(t, "array<string>"), F.transform(F.split(F.regexp_replace(t, r'[\[\]"]', ""), ","), lambda x: F.trim(x)))
    out = F.lit(other)
    for tag, state in reversed((states or TAG_STATES).items()):
        out = F.when(F.array_contains(tags, tag), F.lit(state)).otherwise(out)
    return out


def before(c: Column, mark: str) -> Column:
    """The text before a mark, trimmed; '' is null."""
    return F.nullif(F.trim(F.substring_index(c, mark, 1)), F.lit(""))


def digits_only(c: Column) -> Column:
    """Whether a text consists of figures (and has any)."""
    return (F.length(c) > 0) & (F.translate(c, "0123456789", "") == "")


def tax_id(c: Column) -> Column:
    """10 to 13 digits, bare or behind the source's mark, where a sequence may follow.

    The mark may be in any case; a sequence without the mark, and anything else, is null.
    """
    t = F.trim(c)
    marked = F.upper(F.left(t, F.lit(7))) == "EC-RUC-"
    parts = F.split(F.when(marked, F.substr(t, F.lit(8))).otherwise(t), "-", -1)
    number = parts[0]
    plain = (F.size(parts) == 1) | (marked & (F.size(parts) == 2) & digits_only(F.get(parts, F.lit(1))))
    return F.when(plain & digits_only(number) & F.length(number).between(10, 13), number)


def is_natural(c: Column) -> Column:
    """Whether the third figure of a tax id stands for a person (F6); false without figures."""
    return F.coalesce(digits_only(c) & (F.substring(c, 3, 1) < "6") & (F.length(c) >= 3), F.lit(False))


def is_public(c: Column) -> Column:
    """Whether the third figure of a tax id stands for a public body."""
    return F.coalesce(digits_only(c) & (F.substring(c, 3, 1) == "6"), F.lit(False))


def province(c: Column) -> Column:
    """Province of a tax id."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in PROVINCES.items() for x in kv]), F.substring(c, 1, 2))


def masked(c: Column, shown: int = 4, mark: str = ".") -> Column:
    """All but the last characters replaced."""
    return F.concat(F.repeat(F.lit(mark), F.greatest(F.length(c) - shown, F.lit(0))), F.right(c, F.lit(shown)))


def banded(c: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Half-open bands: the label of the first edge above the value (F9 without its values)."""
    out = None
    for edge, label in edges:
        out = F.when(c < edge, F.lit(label)) if out is None else out.when(c < edge, F.lit(label))
    return F.when(c.isNotNull(), out.otherwise(F.lit(last)))


def day(c: Column) -> Column:
    """The date in the first ten characters, or null."""
    return F.left(c, F.lit(10)).try_cast("date")


def percent(c: Column) -> Column:
    """'40,00%' -> 0.4, rounded to four places; '' is null."""
    t = F.regexp_replace(F.regexp_replace(F.trim(c), "%", ""), ",", ".")
    return F.round(F.nullif(t, F.lit("")).try_cast("double") / 100, 4)


def code_prefix(c: Column, size: int = 5, least: int = 3) -> Column:
    """The first digits of a code, null when it has too few."""
    digits = F.regexp_replace(c.cast("string"), r"\D", "")
    return F.when(F.length(digits) >= least, F.left(digits, F.lit(size)))


def coerce(c: Column, kind: str) -> Column:
    """Declared-type coercion: what does not fit is null."""
    return {"texto": lambda: c.cast("string"), "decimal": lambda: number(c), "entero": lambda: number(c).try_cast("bigint"), "logico": lambda: c.try_cast("boolean")}[kind]()


def or_zero_falls(a: Column, b: Column) -> Column:
    """a, unless it is null or 0, then b (H8: an absent amount and a zero both fall through)."""
    return F.coalesce(F.nullif(a, F.lit(0).cast("double")), b)


def short_amount(c: Column) -> Column:
    """1234567 -> '$1.2 M', 5400 -> '$5 K', 12 -> '$12'; an undeclared amount says so."""
    part = lambda x, places: F.replace(F.format_number(x, places), F.lit(","), F.lit("."))
    big = F.when(c >= 1e6, F.concat(F.lit("$"), part(c / 1e6, 1), F.lit(" M"))).when(c >= 1e3, F.concat(F.lit("$"), part(c / 1e3, 0), F.lit(" K")))
    return F.when(c.isNull(), F.lit("no declarado")).otherwise(F.coalesce(big, F.concat(F.lit("$"), part(c, 0))))


def node_of(code: Column, five: Column, four: Column) -> Column:
    """The node a code hangs on, given whether its 5 and its 4 first figures are in the tree."""
    return F.when(five, F.left(code, F.lit(5))).when(four, F.left(code, F.lit(4)))


def process_code(ocid: Column, prefix: str) -> Column:
    """The source's own code of a process: its id without the publisher's prefix and the last part,
    which stands for the body and the number in the id (F26)."""
    t = F.when(ocid.startswith(prefix + "-"), F.substr(ocid, F.lit(len(prefix) + 2))).otherwise(ocid)
    return F.regexp_replace(t, "-[^-]*$", "")


def looks_like_code(c: Column) -> Column:
    """Capital letters and figures joined by hyphens, or no blank at all."""
    return c.rlike("^[A-Z0-9]+-[A-Z0-9-]+$") | ~c.contains(" ")
