"""Where the inventory's queries and the SQL that defines them are registered by name.

Amounts are summed as decimals and given out as doubles, so the order of summation does not matter;
medians are rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def dec(c: str | Column, scale: int = 4) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(18,{scale})")


def money(c: str | Column, scale: int = 4) -> Column:
    """An exact sum, as a double."""
    return F.sum(dec(c, scale)).cast("double")


def filled(c: str) -> Column:
    """A text without outer blanks; '' is null."""
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def json_elements(x: str) -> str:
    """SQL for the elements of a JSON list, of one object, or of text that holds a list."""
    return f"(case json_type({x}) when 'ARRAY' then json_extract({x}, '$[*]') when 'OBJECT' then [{x}] when 'VARCHAR' then (case when json_valid({x} ->> '$') then (case when json_type({x} ->> '$') = 'ARRAY' then json_extract(({x} ->> '$'), '$[*]') end) end) end)"


def json_objects(x: str) -> str:
    """SQL for those elements that are objects."""
    return f"list_filter({json_elements(x)}, lambda o: json_type(o) = 'OBJECT')"


def tax_id_sql(x: str) -> str:
    """SQL for a tax id: a sequence may follow only behind the source's mark."""
    return f"coalesce(nullif(regexp_extract(trim({x}), '^EC-RUC-(\\d{{10,13}})(?:-\\d+)?$', 1, 'i'), ''), nullif(regexp_extract(trim({x}), '^(\\d{{10,13}})$', 1), ''))"


def number_sql(x: str) -> str:
    """SQL for a text as a number."""
    return f"try_cast({x} as double)"


#: SQL for (reg_id, anio, mes, pos, r, ocid): a row per release of every readable record.
RELEASES_SQL = f"""r0 as (select reg_id, anio, mes, registro::json j from detalle_mes where json_valid(registro)), r1 as (select reg_id, anio, mes, case when coalesce(json_type(j, '$.releases'), 'NULL') <> 'NULL' then {json_elements("(j -> '$.releases')")} else [j] end l from r0), r2 as (select reg_id, anio, mes, l, unnest(range(len(l))) pos from r1), rel as (select reg_id, anio, mes, pos::int pos, l[pos + 1] r, l[pos + 1] ->> '$.ocid' ocid from r2 where l[pos + 1] ->> '$.ocid' <> '')"""
