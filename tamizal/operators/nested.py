"""Deeply nested records -> flat child tables that keep their parent.

The JVM turns the JSON text of changing shape into one well-typed nested column (a list of releases,
each with its lists of children); the flattening itself works on the Arrow buffers of that column:
list offsets give the place of a child in its array, the parent-index kernel says which list a child
came from, and keys are propagated by vectorised take.  No row is parsed or looped over in Python.
Repeats can only come from one record, and a record never leaves its row, so they are removed inside
the batch without a shuffle.

Defined cases: null, empty and unreadable texts give nothing, and so does a release without `ocid`;
text that holds a JSON array is that array; an object delivered without an array is at place 0; null
elements are counted but not given; elements and fields of any other shape give nothing; a missing
id is ''; of a key that an object repeats the last value counts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Name of the child table -> field of the release's tender.
TENDER_CHILDREN = {"items": "items", "oferentes": "tenderers", "consultas": "enquiries", "lotes": "lots"}
#: Standard JSON only; text that is not goes to the column of unreadable records.
STRICT = {"columnNameOfCorruptRecord": "__bad", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
TAX_ID = r"(?<![0-9])([0-9]{10,13})(?![0-9])"


def _elements(text: Column) -> Column:
    """The elements (as JSON text) of a JSON array, of one object, or of nothing."""
    t = F.trim(text)
    return F.when(t.startswith("["), F.from_json(t, "array<string>")).when(t.startswith("{"), F.array(t))


def _children(text: Column, tax_id: bool = False) -> Column:
    """list<struct<es: is an object, id: its id as text>>."""

    def child(x: Column) -> Column:
        own = F.coalesce(F.from_json(x, "id string")["id"], F.lit(""))
        return F.struct(F.coalesce(F.trim(x).startswith("{"), F.lit(False)).alias("es"), (F.regexp_extract(own, TAX_ID, 1) if tax_id else own).alias("id"))

    return F.transform(_elements(text), child)


def nested_releases(df: DataFrame, *, row: str, text: str) -> DataFrame:
    """(row, releases): the records that are valid JSON as a whole, in one typed nested column."""
    d = df.select(F.col(row).cast("long").alias("reg_id"), F.col(text).alias("__t"))
    d = d.withColumn("__p", F.from_json("__t", "releases string, ocid string, tender string, awards string, __bad string", STRICT))
    # the first test is strict about the text, the second about what follows the first value
    d = d.where(F.col("__p.__bad").isNull() & (F.json_array_length(F.concat(F.lit("["), F.col("__t"), F.lit("]"))) == 1))
    inner = F.transform(_elements(F.col("__p.releases")), lambda r: F.from_json(r, "ocid string, tender string, awards string"))
    own = F.array(F.struct(*[F.col(f"__p.{c}").alias(c) for c in ("ocid", "tender", "awards")]))
    d = d.select("reg_id", F.when(F.col("__p.releases").isNotNull(), inner).otherwise(own).alias("__r"))
    kept = F.filter("__r", lambda r: r["ocid"].isNotNull() & (r["ocid"] != ""))
    fields = ", ".join(f"{f} string" for f in TENDER_CHILDREN.values())
    parsed = F.transform(
        kept,
        lambda r: F.struct(
            r["ocid"].alias("ocid"),
            F.from_json(r["tender"], fields).alias("t"),
            F.transform(_elements(r["awards"]), lambda a: F.from_json(a, "id string, items string")).alias("a"),
        ),
    )
    release = F.transform(
        parsed,
        lambda r: F.struct(
            r["ocid"].alias("ocid"),
            *[_children(r["t"][field], name == "oferentes").alias(name) for name, field in TENDER_CHILDREN.items()],
            F.transform(r["a"], lambda a: F.struct(F.coalesce(a["id"], F.lit("")).alias("id"), _children(a["items"]).alias("items"))).alias("awards"),
        ),
    )
    return d.select("reg_id", release.alias("releases"))


def _flatten(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def explode(lists):
        """Flat values of a list array, the index of the list of each, and its place in that list."""
        parent = pc.list_parent_indices(lists)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype("int64")
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
        place = np.arange(len(parent), dtype="int64") - np.repeat(starts, lengths)
        return pc.list_flatten(lists), parent, pa.array(place, pa.int32())

    def rows(table: str, children, reg_id, ocid, father):
        value, parent, place = explode(children)
        keep = pc.fill_null(pc.struct_field(value, "es"), False)
        value, parent, place = value.filter(keep), parent.filter(keep), place.filter(keep)
        n = len(parent)
        return pa.table(
            {
                "tabla": pa.array([table], pa.string()).take(pa.array(np.zeros(n, dtype="int64"))),
                "reg_id": reg_id.take(parent),
                "ocid": ocid.take(parent),
                "padre": father.take(parent),
                "pos": place,
                "hijo_id": pc.struct_field(value, "id"),
            }
        )

    def whole(column):
        return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

    for batch in batches:
        rel, parent, _ = explode(whole(batch.column("releases")))
        reg_id = whole(batch.column("reg_id")).take(parent)
        ocid = pc.struct_field(rel, "ocid")
        keep = pc.is_valid(ocid)
        rel, reg_id, ocid = rel.filter(keep), reg_id.filter(keep), ocid.filter(keep)
        tender = pa.array(["tender"] * len(rel), pa.string())
        out = [rows(t, pc.struct_field(rel, t), reg_id, ocid, tender) for t in ("items", "oferentes", "consultas", "lotes")]
        award, of, _ = explode(pc.struct_field(rel, "awards"))
        out.append(rows("items", pc.struct_field(award, "items"), reg_id.take(of), ocid.take(of), pc.struct_field(award, "id")))
        flat = pa.concat_tables(out)
        yield from flat.group_by(flat.column_names, use_threads=False).aggregate([]).to_batches()


def flatten_children(df: DataFrame, *, row: str, text: str) -> DataFrame:
    """(tabla, reg_id, ocid, padre, pos, hijo_id) for every child object of every release."""
    return nested_releases(df, row=row, text=text).mapInArrow(_flatten, "tabla string, reg_id bigint, ocid string, padre string, pos int, hijo_id string")
