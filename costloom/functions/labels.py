"""Flags, labels and classifiers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Environment by name pattern, first hit wins, with its sort order.
ENVIRONMENTS = [("dev", "Development", 3), ("staging", "Staging", 2), ("prod", "Production", 1)]
OTHER_ENVIRONMENT = ("Other", 4)

GUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def flag(test: Column) -> Column:
    """1 where ``test`` is true, else 0 (NULL counts as false)."""
    return F.when(test, 1).otherwise(0)


def yes_no(column: str) -> Column:
    return F.when(F.col(column) == 1, "Yes").otherwise("No")


def _environment(column: str, position: int) -> Column:
    name = F.lower(F.col(column))
    out = None
    for pattern in ENVIRONMENTS:
        hit, value = name.contains(pattern[0]), F.lit(pattern[position])
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(F.lit(OTHER_ENVIRONMENT[position - 1]))


def environment(column: str) -> Column:
    return _environment(column, 1)


def environment_order(column: str) -> Column:
    return _environment(column, 2)


def blank_to(column: str, default: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))


def gigabytes(column: str) -> Column:
    return F.round(F.col(column) / F.lit(1e9), 4)


def type_label(column: str | Column) -> Column:
    """Resource type with spaces, however the source spelled it."""
    return F.replace(F.col(column) if isinstance(column, str) else column, F.lit("_"), F.lit(" "))


def with_nested_text(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Add text fields, by dotted path, of a column that is either a struct or JSON text.

    JSON is parsed once into a column of its own, which Spark does not fold into the
    field reads. A field the struct does not have reads as NULL.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StringType):
        kind = _schema_of(paths.values())
        value = F.from_json(value, kind)
    parsed = df.withColumn("__parsed", value)
    fields = {name: _field(F.col("__parsed"), kind, path.split(".")) for name, path in paths.items()}
    return parsed.withColumns(fields).drop("__parsed")


def _schema_of(paths: Iterable[str]) -> T.StructType:
    """Smallest struct of strings holding the given dotted paths."""
    tree: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        tree.setdefault(head, []).extend([rest] if rest else [])
    return T.StructType([
        T.StructField(name, _schema_of(rest) if rest else T.StringType()) for name, rest in tree.items()
    ])


def _field(value: Column, kind: T.DataType, steps: list[str]) -> Column:
    for step in steps:
        if not isinstance(kind, T.StructType) or step not in kind.fieldNames():
            return F.lit(None).cast("string")
        value, kind = value.getField(step), kind[step].dataType
    return value.cast("string")


def map_or_json(df: DataFrame, column: str) -> Column:
    """A string map from a column that is either a map already or JSON text."""
    if isinstance(df.schema[column].dataType, T.MapType):
        return F.col(column)
    return F.from_json(F.col(column), "map<string,string>")
