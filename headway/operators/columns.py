"""Projection, renaming and schema conformance."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from headway.operators.joins import semi_filter


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns."""
    return df.select(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns, unless the new name is already taken."""
    free = {old: new for old, new in mapping.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(free)


def keep_first(df: DataFrame) -> DataFrame:
    """Of columns with the same name keep the first."""
    unique = [f"{name}#{i}" for i, name in enumerate(df.columns)]
    first = {name: alias for name, alias in reversed(list(zip(df.columns, unique)))}
    ordered = dict.fromkeys(df.columns)
    return df.toDF(*unique).select(*[F.col(f"`{first[name]}`").alias(name) for name in ordered])


def order_columns(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Declared columns first and in order, all others after them by name."""
    known = [name for name in declared if name in df.columns]
    return df.select(*known, *sorted(set(df.columns) - set(known)))


def conform(
    df: DataFrame, schema: T.StructType, strict: bool = False, lead: Sequence[str] = ()
) -> DataFrame:
    """Give a frame all columns of a schema, in its order, after the ``lead`` columns.

    Missing columns are null in the declared type.  Present columns keep their type, or with
    ``strict`` are cast where the value allows it.  Columns outside the schema come last by name.
    """

    def column(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType.simpleString()
        if field.name not in present:
            return f"CAST(NULL AS {kind}) AS {name}"
        return f"TRY_CAST({name} AS {kind}) AS {name}" if strict else name

    present = set(df.columns)
    extra = sorted(present - set(schema.names) - set(lead))
    declared = [column(field) for field in schema.fields if field.name not in lead]
    return df.selectExpr(*[f"`{name}`" for name in lead], *declared, *[f"`{name}`" for name in extra])


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where none of the columns is null; these filters reach the scan."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def missing_values(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is null."""
    return df.where(F.col(column).isNull())


def only_routes(df: DataFrame, routes: Iterable[str] | DataFrame) -> DataFrame:
    """Rows of some routes, given as a list of ids or as a table of (feed, route_id)."""
    if isinstance(routes, DataFrame):
        shared = [name for name in routes.columns if name in df.columns]
        return semi_filter(df, routes, shared)
    return df.where(F.col("route_id").isin(*list(routes)))


def union_tables(*frames: DataFrame, declared: Sequence[str] = ()) -> DataFrame:
    """All rows of the frames; columns are matched by name and missing ones are null.

    There is no union by position: it silently mixes columns.
    """
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return order_columns(first, declared or frames[0].columns)
