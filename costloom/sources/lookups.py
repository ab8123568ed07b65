"""Small reference files: applications with their domains, and the people directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names of the people directory export.
PEOPLE = [
    "IDENTITY", "LAST_NAME", "FIRST_NAME", "MANAGER", "ACTIVE", "EMAIL", "JOB_TITLE", "JOB_PROFILE",
    "JOB_FAMILY_GROUP", "HR_DIVISION", "HR_BUSINESS_UNIT", "FUNCTIONAL_MANAGER", "FINANCE_DIVISION",
    "COUNTRY",
]


def read_lookup(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A landed lookup, CSV with a header or Parquet by its ending."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", "true")
        return (reader.schema(schema) if schema else reader).csv(path)
    return spark.read.parquet(path)


def applications(apps: DataFrame, domains: DataFrame, sub_domains: DataFrame) -> DataFrame:
    """Applications with the names of their domain and sub-domain; unknown ones stay NULL."""
    return (
        apps.select("application_cd", "application_lb", "domain_id", "sub_domain_id")
        .join(domains.select("domain_id", "domain_lb"), "domain_id", "left")
        .join(sub_domains.select("sub_domain_id", "sub_domain_lb"), "sub_domain_id", "left")
        .select("application_cd", "application_lb", "domain_lb", "sub_domain_lb")
    )


def people(export: DataFrame) -> DataFrame:
    return export.select(*PEOPLE)
