"""Projections that turn nested records into flat tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cell(column: Column, kind: T.DataType) -> Column:
    """One table cell: primitive lists joined by a comma (nulls as None), other nested values as JSON, scalars unchanged."""
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.StructType, T.MapType)):
        if isinstance(kind.elementType, T.BooleanType):
            shown = lambda x: F.when(x, "True").when(~x, "False")
        else:
            shown = lambda x: x.cast("string")
        return F.array_join(F.transform(column, lambda x: F.coalesce(shown(x), F.lit("None"))), ", ")
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(column, {"ignoreNullFields": "false"})
    return column


def flatten_item(df: DataFrame, item: str, prefix: str = "") -> DataFrame:
    """The struct column ``item`` flattened one level: ``field`` or ``field_child`` columns, cells as in ``cell``.

    A null or blank scalar of the item becomes an empty string; children keep
    their nulls.  Two fields that would take one name are an error.
    """
    kind = df.schema[item].dataType
    columns: list[Column] = []
    for f in kind.fields:
        name, value = f"{prefix}{f.name}", F.col(item)[f.name]
        if isinstance(f.dataType, T.StructType):
            columns += [cell(value[c.name], c.dataType).alias(f"{name}_{c.name}") for c in f.dataType.fields]
        else:
            shown = cell(value, f.dataType)
            text = isinstance(f.dataType, T.StringType)
            columns.append((F.when(value.isNull() | (F.trim(shown) == ""), F.lit("")).otherwise(shown) if text else shown).alias(name))
    names = [c._jc.toString().rsplit(" AS ", 1)[-1].strip("`") for c in columns]
    kept = [c for c in df.columns if c != item]
    if clash := {n for n in names if names.count(n) > 1} | set(names) & set(kept):
        raise ValueError(f"columns with one name: {sorted(clash)}")
    return df.select(*kept, *columns)


def item_rows(df: DataFrame, children: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per child of an array column; a parent without children keeps one row with nulls.

    Children must be structs or scalars; child fields may not repeat parent
    columns.
    """
    element = df.schema[children].dataType.elementType
    parents = [c for c in (columns or df.columns) if c != children]
    rows = df.select(*parents, F.posexplode_outer(children).alias("child_pos", "child"))
    if not isinstance(element, T.StructType):
        return rows
    if clash := set(parents) & set(element.fieldNames()):
        raise ValueError(f"columns of parent and child with one name: {sorted(clash)}")
    return rows.select(*parents, "child_pos", "child.*")


def error_lineage(df: DataFrame, errors: str) -> DataFrame:
    """Adds ``error_count``, ``error_kinds`` (sorted, distinct, "; ") and ``error_text`` (in order, " | ") of an array of messages."""
    from docketlake.functions.measures import error_kind

    listed = F.coalesce(F.col(errors), F.array().cast("array<string>"))
    return df.withColumns({
        "error_count": F.size(listed),
        "error_kinds": F.array_join(F.array_sort(F.array_distinct(F.transform(listed, error_kind))), "; "),
        "error_text": F.array_join(listed, " | "),
    })


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Declared columns in their order, absent ones as null strings, extra ones last."""
    extra = [c for c in df.columns if c not in columns]
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns), *extra)


def titled(df: DataFrame, titles: Mapping[str, str], exclude: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Columns renamed to their titles; excluded ones dropped, ordered ones first.

    Unknown names and two columns of one title are errors.
    """
    if unknown := [c for c in (*exclude, *order) if c not in df.columns]:
        raise ValueError(f"unknown columns: {unknown}")
    kept = [*order, *(c for c in df.columns if c not in order and c not in exclude)]
    names = [titles.get(c, c) for c in kept]
    if len(set(names)) < len(names):
        raise ValueError(f"columns with one title: {sorted({n for n in names if names.count(n) > 1})}")
    return df.select(*(F.col(c).alias(n) for c, n in zip(kept, names)))


def coerced(df: DataFrame, numeric: Sequence[str], whole: bool = True) -> DataFrame:
    """Blank cells to null and numeric columns to double; a column of whole numbers only becomes bigint.

    Whether a column is whole is decided over all its rows in one small aggregate.
    """
    out = df.withColumns({c: F.nullif(F.trim(c), F.lit("")).try_cast("double") for c in numeric})
    if not whole or not numeric:
        return out
    probe = out.agg(*(F.coalesce(F.bool_and(F.col(c) == F.round(c)), F.lit(False)).alias(c) for c in numeric)).first()
    return out.withColumns({c: F.col(c).cast("bigint") for c in numeric if probe[c]})


def partition_path(scope: Column, values: Mapping[str, Column], target_id: Column) -> Column:
    """Folder of a document: ``_shared``, ``by_<fields>/<slug>/...`` or ``_targets/<id>`` where a field is missing."""
    from docketlake.functions.text import slug

    known = F.lit(True)
    for v in values.values():
        known = known & (F.coalesce(slug(v), F.lit("")) != "")
    by = F.concat_ws("/", F.lit("by_" + "_".join(values)), *(slug(v) for v in values.values()))
    return F.when(scope == "shared", "_shared").when(known, by).otherwise(F.concat(F.lit("_targets/"), target_id))


def document_names(df: DataFrame, plain: Column, owner: Column, order: Sequence[Column]) -> DataFrame:
    """Adds ``name``: the plain name for the first claimant, a suffix from the owner's hash for the others."""
    from pyspark.sql import Window

    w = Window.partitionBy("plain_name").orderBy(*order)
    named = df.withColumn("plain_name", plain).withColumn("claim", F.row_number().over(w))
    return named.withColumn("name", F.when(F.col("claim") == 1, F.col("plain_name")).otherwise(F.concat("plain_name", F.lit("_"), F.substring(F.sha2(owner, 256), 1, 8)))).drop("claim")


def numbered_list(entries: Column) -> Column:
    """Values of a map with numeric keys, in the order of the numbers."""
    return F.transform(F.array_sort(F.transform(F.map_entries(entries), lambda e: F.struct(e["key"].try_cast("int").alias("k"), e["value"].alias("v")))), lambda e: e["v"])
