"""Landed directory pages (users, service principals) flattened to rows.

A page is one JSON text with a ``Resources`` list, as the directory interface
returns it. Fetching pages is left to whatever lands them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_EMAIL = "struct<primary:boolean,type:string,value:string>"
USER = (
    "struct<id:string,active:boolean,userName:string,displayName:string,"
    f"name:struct<givenName:string,familyName:string>,externalId:string,emails:array<{_EMAIL}>>"
)
PRINCIPAL = "struct<id:string,active:boolean,applicationId:string,displayName:string,externalId:string>"


def _entries(pages: DataFrame, kind: str, body: str) -> DataFrame:
    parsed = F.from_json(F.col(body), f"struct<Resources:array<{kind}>>")["Resources"]
    return pages.select("account_id", F.explode(parsed).alias("r"))


def _active():
    return F.when(F.col("r.active"), 1).otherwise(0)


def flatten_users(pages: DataFrame, body: str = "body") -> DataFrame:
    primary = F.try_element_at(F.filter("r.emails", lambda e: e["primary"]), F.lit(1))["value"]
    return _entries(pages, USER, body).select(
        F.coalesce("r.id", F.lit("")).alias("user_cd"),
        F.col("account_id").alias("account_cd"),
        F.col("r.userName").alias("username_lb"),
        F.col("r.displayName").alias("display_name_lb"),
        F.col("r.name.givenName").alias("first_name_lb"),
        F.col("r.name.familyName").alias("last_name_lb"),
        _active().alias("is_active_fl"),
        F.col("r.externalId").alias("external_cd"),
        primary.alias("primary_email_lb"),
        F.current_timestamp().alias("sys_load_dt"),
    )


def flatten_service_principals(pages: DataFrame, body: str = "body") -> DataFrame:
    return _entries(pages, PRINCIPAL, body).select(
        F.coalesce("r.id", F.lit("")).alias("sp_cd"),
        F.col("account_id").alias("account_cd"),
        F.coalesce("r.applicationId", F.lit("")).alias("application_cd"),
        F.col("r.displayName").alias("display_name_lb"),
        _active().alias("is_active_fl"),
        F.col("r.externalId").alias("external_cd"),
        F.current_timestamp().alias("sys_load_dt"),
    )
