"""Which identity and which resource a usage line belongs to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .labels import GUID

# Precedence of the resource a line is charged to, and the surrogate
# a resource of that type falls back to when the dimension does not know it.
RESOURCE_FIELDS = [
    ("JOB", "job_id"),
    ("PIPELINE", "dlt_pipeline_id"),
    ("WAREHOUSE", "warehouse_id"),
    ("CLUSTER", "cluster_id"),
    ("APP", "app_id"),
    ("NOTEBOOK", "notebook_id"),
    ("ENDPOINT", "endpoint_id"),
    ("NETWORKING", "networking_client"),
    ("DATA QUALITY MONITORING", "schema_id"),
]
UNKNOWN_RESOURCE = {
    "JOB": -3,
    "PIPELINE": -4,
    "CLUSTER": -5,
    "WAREHOUSE": -6,
    "APP": -7,
    "NOTEBOOK": -8,
    "ENDPOINT": -9,
    "NETWORKING": -10,
    "DATA QUALITY MONITORING": -11,
}
UNDEFINED_RESOURCE = -2
UNKNOWN_WORKSPACE = -3
UNKNOWN_ENTITY = -1
UNKNOWN_IDENTITIES = [0, -1, -3, -4]

IDENTITY_ORDER = ["run_as_cd", "run_by_cd", "created_by_cd", "owned_by_cd"]


def charged_identity() -> Column:
    """Monitors are created rather than run; everything else follows the fixed order."""
    return F.when(F.col("product_lb") == "DATA_QUALITY_MONITORING", F.col("created_by_cd")).otherwise(
        F.coalesce(*IDENTITY_ORDER)
    )


def in_metadata(field: str) -> Column:
    return F.col(f"usage_metadata.{field}")


def _present(kind: str, column: Column) -> Column:
    named = column.isNotNull()
    return named | (F.col("product_lb") == kind) if kind == "NETWORKING" else named


def resource_type(compat: bool = False, code: Callable[[str], Column] = in_metadata) -> Column:
    """Type of the charged resource; the product label when no resource is named.

    Type names carry spaces as in the resource dimension; ``compat`` keeps
    underscores, which the dimension does not have, so those lines stay unresolved. ``code`` gives
    the column of a metadata field, where lines have these as columns of their own.
    """
    out = None
    for kind, field in RESOURCE_FIELDS:
        label = kind.replace(" ", "_") if compat else kind
        hit = _present(kind, code(field))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    other = F.col("product_lb")
    if not compat:
        other = F.when(other == "PREDICTIVE_OPTIMIZATION", "PREDICTIVE OPTIMIZATION").otherwise(other)
    return out.otherwise(other)


def resource_source(compat: bool = False, code: Callable[[str], Column] = in_metadata) -> Column:
    """Natural key of the charged resource, in the order of the type rule.

    ``compat`` prefers a schema id over a networking client; ``code`` as for the type.
    """
    fields = [(k, f) for k, f in RESOURCE_FIELDS]
    if compat:
        fields = [x for x in fields if x[0] != "NETWORKING"] + [x for x in fields if x[0] == "NETWORKING"]
    parts = []
    for kind, field in fields:
        column = code(field)
        if kind == "NETWORKING":
            column = F.coalesce(column, F.when(F.col("product_lb") == kind, kind))
        parts.append(column)
    return F.coalesce(*parts, F.col("product_lb"))


def unknown_resource(kind_of: str | Column) -> Column:
    name, out = F.col(kind_of) if isinstance(kind_of, str) else kind_of, None
    for kind, key in UNKNOWN_RESOURCE.items():
        hit = F.replace(name, F.lit("_"), F.lit(" ")) == kind
        out = F.when(hit, key) if out is None else out.when(hit, key)
    return out.otherwise(UNDEFINED_RESOURCE)


def unknown_identity(login: str) -> Column:
    """Fallback by the shape of the login: none, service principal GUID, e-mail, other."""
    name = F.col(login)
    return (
        F.when(name.isNull() | (name == ""), 0)
        .when(F.regexp_like(name, F.lit(GUID)), -4)
        .when(name.contains("@"), -3)
        .otherwise(-1)
    )
