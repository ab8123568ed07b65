"""Loads driven by a stored mark: the batch form that does without streams.

Each load reads what arrived after its mark, derives the keys that changed, merges
and moves the mark last. A load that stops half-way leaves the mark alone and is
repeated; merging the same rows again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import cdc, incremental as inc
from ..operators.keys import with_new_keys
from ..operators.latest import latest
from ..operators.merge import merge
from . import identities as ids
from .silver import LOAD, BillingEntity, billing_entity, usage_fact

ARRIVED = "sal_load_dt"
_IDENTITIES = ("run_as", "run_by", "created_by", "owned_by")


def newest_since(feed: DataFrame, keys: Sequence[str], mark: dt.datetime, load: str = ARRIVED,
                 ties: Sequence[str] = ()) -> DataFrame:
    """Latest arrival per key after the mark. Serves snapshots that pile up (prices,
    workspaces, users, service principals)."""
    return latest(inc.incremental(feed, load, mark), keys, load, ties)


def usage_with_origin(landed: DataFrame) -> DataFrame:
    """Usage lines with one identity and the field it came from."""
    origin = None
    for name in _IDENTITIES:
        hit = F.col(f"{name}_cd").isNotNull()
        origin = F.when(hit, name) if origin is None else origin.when(hit, name)
    return usage_fact(landed).withColumns({
        "identity_origin_lb": origin.otherwise("No identity found"),
        "run_as_cd": F.coalesce(*[f"{n}_cd" for n in _IDENTITIES]),
    }).drop("run_by_cd", "created_by_cd", "owned_by_cd")


def merge_usage(usage: DataFrame, fresh: DataFrame) -> DataFrame:
    """Billing lines never change: one that arrives again only has its load time moved."""
    return merge(
        usage, fresh, ["record_cd", "ingestion_dt"],
        update={LOAD: F.col(f"s.{LOAD}")}, evolve=True,
    )


def merge_entities(dim: DataFrame, landed: DataFrame, spec: BillingEntity) -> DataFrame:
    """Entities of a batch of lines merged into their dimension: the earliest line of the
    batch speaks for an entity, tags compare by content."""
    found = billing_entity(landed, spec, keep="first")
    guard = [c for c in ("product_lb", spec.label[0] if spec.label else None, spec.owner, "tags")
             if c and c in dim.columns]
    now = F.current_timestamp()
    return merge(
        dim, with_new_keys(found, dim, spec.keys, spec.id_col), spec.keys, guard=guard,
        update={**{c: F.col(f"s.{c}") for c in guard}, "sys_update_dt": now},
        insert={"sys_create_dt": now, "sys_update_dt": now},
    )


def merge_workspaces(dim: DataFrame, rows: DataFrame) -> DataFrame:
    """Workspaces of a partial snapshot: what is missing from it is left as it is."""
    return ids.merge_workspace_rows(dim, rows, full=False)


@dataclass
class Versions:
    """Result of one history load."""

    history: DataFrame
    current: DataFrame
    mark: DataFrame


def load_versions(
    history: DataFrame,
    current: DataFrame,
    feed: DataFrame,
    keys: Sequence[str],
    seq: str,
    mark: dt.datetime,
    load: str = ARRIVED,
    immutable: Sequence[str] = (),
) -> Versions:
    """Windows of every entity that changed since the mark, merged into its history; open
    windows merged into the current table.

    All versions of a changed entity are windowed again, since a new one closes its
    predecessor. A stored version keeps its values; only window and deletion columns
    move. ``immutable`` columns of the current table are set on insert alone.
    """
    keys = list(keys)
    touched = cdc.affected_keys(inc.incremental(feed, load, mark), keys)
    windows = cdc.scd2(feed.join(touched, keys, "left_semi"), keys, seq, inclusive_end=True)
    window_cols = [cdc.TO, cdc.CURRENT]
    deletion = [c for c in ("is_deleted_fl", "delete_dt") if c in history.columns]
    now = F.current_timestamp()
    stamp = {"sys_update_dt": now} if "sys_update_dt" in history.columns else {}
    audit = {c: now for c in ("sys_create_dt", "sys_update_dt") if c in history.columns}
    merged = merge(
        history, windows, [*keys, cdc.FROM], guard=window_cols,
        update={**{c: F.col(f"s.{c}") for c in [*window_cols, *deletion]}, **stamp}, insert=audit,
    )
    opened = cdc.current_of(merged.join(touched, keys, "left_semi"))
    tracked = [c for c in current.columns
               if c in opened.columns and c not in keys and c not in immutable and not c.startswith("sys_")]
    stamp = {"sys_update_dt": now} if "sys_update_dt" in current.columns else {}
    audit = {c: now for c in ("sys_create_dt", "sys_update_dt") if c in current.columns}
    latest_state = merge(
        current, opened, keys, guard=tracked,
        update={**{c: F.col(f"s.{c}") for c in tracked}, **stamp}, insert=audit,
    )
    arrived = feed.join(touched, keys, "left_semi")
    return Versions(merged, latest_state, inc.next_mark(arrived, load, mark))
