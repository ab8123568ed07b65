"""The daily run, from landed tables to reporting views.

Order: streams (append facts, change-fed dimensions) - workspaces, directory and
visibility - prices and cost - tag keys, resources, tags - attributed cost. Each
step reads and writes tables under one root; a step that fails can be run again, as
every step ends in the same tables whether it ran once or twice. A full refresh builds
a new generation, with fresh tables and checkpoints, next to the current one and takes
its place when it is complete.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import closure as groups, incremental as inc, tags
from ..operators.keys import with_sentinels
from ..operators.latest import latest_snapshot
from ..operators.merge import ACTION
from ..schemas import (
    GROUP_SENTINELS, IDENTITY_SENTINELS, LANDED, RESOURCE_SENTINELS, SERVICE_PRINCIPAL_SENTINELS,
    TAG_KEY_SENTINELS, USER_SENTINELS, WORKSPACE_SENTINELS,
)
from ..sources.load_index import LoadIndex
from ..sources.schemas_seen import SeenSchemas
from ..sources.tables import Tables, touched_days
from ..streaming import flows
from ..streaming.ingest import read_appended, run_all
from . import costing, gold, identities as ids, resources as res, silver

LOAD_DAY, REQUEST_DAY, START_DAY = "load_day_dt", "request_day_dt", "start_day_dt"
ENTITY = ["account_cd", "workspace_cd", "served_entity_cd"]
RULED = {"tf_billing_usage": silver.USAGE_RULES, "tf_serving_usage": silver.SERVING_RULES}
CLOSURE = ("tr_dbx_group_edge", "tr_dbx_group_reach", "tr_dbx_group_closure")
AUDIT = "sys_create_dt timestamp, sys_update_dt timestamp"
# Empty form of the merged dimensions: surrogate first, then natural key and labels.
EMPTY = {
    "td_workspace": "workspace_id bigint, account_cd string, workspace_cd string, workspace_lb string, "
                    "workspace_url_lb string, create_dt timestamp, status_lb string, is_deleted_fl int, " + AUDIT,
    "td_billing_list_price": "account_cd string, sku_name_lb string, cloud_lb string, currency_code_lb string, "
                             "usage_unit_lb string, default_price_nb double, effective_list_price_nb double, "
                             "price_start_dt timestamp, price_end_dt timestamp, " + AUDIT,
    "td_dbx_user": "user_id bigint, account_cd string, user_cd string, username_lb string, display_name_lb string, "
                   "first_name_lb string, last_name_lb string, is_active_fl int, external_cd string, "
                   "primary_email_lb string, " + AUDIT,
    "td_dbx_service_principal": "sp_id bigint, account_cd string, sp_cd string, application_cd string, "
                                "display_name_lb string, is_active_fl int, external_cd string, " + AUDIT,
    "td_identity": "identity_id bigint, account_cd string, source_cd string, identity_type_lb string, "
                   "display_name_lb string, identity_cd string, first_name_lb string, last_name_lb string, "
                   "primary_email_lb string, is_active_fl int, external_cd string, " + AUDIT,
    "td_dbx_group": "group_id bigint, account_cd string, group_cd string, display_name_lb string, "
                    "is_active_fl int, " + AUDIT,
    "tr_dbx_group_member": "account_cd string, group_cd string, member_cd string, member_type_lb string, "
                           "is_deleted_fl int, " + AUDIT,
    "tr_dbx_group_reach": "account_cd string, group_cd string, inner_cd string",
    "tr_dbx_group_closure": "account_cd string, group_cd string, member_cd string",
    "td_resource": "resource_id bigint, resource_type_lb string, source_cd string, account_cd string, "
                   "region_lb string, workspace_cd string, display_name_lb string, owned_by_cd string, "
                   "is_active_fl int, " + AUDIT,
    "td_tag_key": "tag_key_id bigint, tag_key_cd string, raw_key_lb string, " + AUDIT,
    "tr_resource_tag": "resource_id bigint, tag_key_id bigint, tag_value_lb string, " + AUDIT,
    "_marks": "table_name string, account_id string, last_processed_dt timestamp, sys_update_dt timestamp",
}
SEEDS = {
    "td_workspace": (WORKSPACE_SENTINELS, "workspace_id"),
    "td_dbx_user": (USER_SENTINELS, "user_id"),
    "td_dbx_service_principal": (SERVICE_PRINCIPAL_SENTINELS, "sp_id"),
    "td_identity": (IDENTITY_SENTINELS, "identity_id"),
    "td_dbx_group": (GROUP_SENTINELS, "group_id"),
    "td_resource": (RESOURCE_SENTINELS, "resource_id"),
    "td_tag_key": (TAG_KEY_SENTINELS, "tag_key_id"),
}
DIMENSION_TABLES = {
    "lakeflow_jobs": "td_lakeflow_job",
    "lakeflow_pipelines": "td_lakeflow_pipeline",
    "compute_clusters": "td_compute_cluster",
    "compute_warehouses": "td_compute_warehouse",
    "serving_served_entities": "td_serving_entity",
}


def _usage_rows(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return silver.usage_fact(landed, extra).withColumn(LOAD_DAY, F.to_date(silver.LOAD))


def _serving_rows(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return silver.source_view(landed, silver.SERVING_USAGE, extra).withColumn(REQUEST_DAY, F.to_date("request_dt"))


def _served_days(landed: DataFrame) -> DataFrame:
    return _serving_rows(landed).select(*ENTITY, REQUEST_DAY).distinct()


def _history_rows(landed: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return silver.source_view(landed, silver.QUERY_HISTORY, extra).withColumn(START_DAY, F.to_date("start_dt"))


def changed_days(requests: DataFrame, late_requests: DataFrame, late_cost: DataFrame | None = None,
                 late_statements: DataFrame | None = None, late_entities: DataFrame | None = None) -> set[dt.date]:
    """Days whose shares change through late rows; a late entity touches every day it has requests on."""
    day = F.to_date("request_dt").alias("day")
    parts = [late_requests.select(day)]
    if late_cost is not None:
        parts.append(late_cost.select(F.col("usage_dt").alias("day")))
    if late_statements is not None:
        parts.append(late_statements.select(F.to_date("start_dt").alias("day")))
    if late_entities is not None:
        parts.append(requests.join(late_entities.select(*ENTITY), ENTITY, "left_semi").select(day))
    return {d for d in touched_days(reduce(DataFrame.unionByName, parts), "day") if d is not None}


@dataclass
class Daily:
    """One daily run. ``landed`` is the folder of append-only and snapshot tables, one
    sub-folder each; ``root`` holds tables and checkpoints."""

    spark: SparkSession
    landed: str
    root: str
    currency: str | None = "USD"
    landed_schemas: dict[str, str] = field(default_factory=lambda: dict(LANDED))

    def __post_init__(self) -> None:
        self._generations = Tables(self.spark, f"{self.root}/generations")
        known = self._generations.read("current")
        self._use(known.first()[0] if known is not None else 1)

    def _use(self, generation: int) -> None:
        self.generation = generation
        self.home = f"{self.root}/generation-{generation:04d}"
        self.tables = Tables(self.spark, f"{self.home}/tables")
        self.index = LoadIndex(self.tables)
        self.schemas = SeenSchemas(self.tables)

    def _checkpoint(self, name: str) -> str:
        return f"{self.home}/checkpoints/{name}"

    def _stream(self, name: str) -> DataFrame:
        return read_appended(self.spark, f"{self.landed}/{name}", self.schemas.schema(name, self.landed_schemas[name]))

    def _carrying(self, name: str, rows: Callable[..., DataFrame]) -> flows.Prepare:
        """``rows`` of a feed together with the fields that landed without being declared."""
        extra = self.schemas.extra(name, self.landed_schemas[name])
        return lambda landed: rows(landed, extra)

    def snapshot(self, name: str) -> DataFrame:
        """The newest full snapshot of each account. A run is a folder, and the column
        ``snapshot_run`` where the extraction wrote one."""
        schema = f"{self.landed_schemas[name]}, snapshot_run string"
        rows = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.landed}/{name}")
        folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
        dated = rows.withColumn("snapshot_run", F.coalesce("snapshot_run", folder))
        return latest_snapshot(dated, "snapshot_run", ["account_id"]).drop("snapshot_run")

    def current(self, name: str) -> DataFrame:
        """A table, or its empty form with sentinels when it was never written."""
        stored = self.tables.read(name)
        if stored is not None:
            return stored
        empty = self.spark.createDataFrame([], EMPTY[name])
        return with_sentinels(empty, *SEEDS[name]) if name in SEEDS else empty

    def arrived_usage(self, mark: dt.datetime) -> DataFrame:
        """Usage loaded after ``mark``; older load days are not read."""
        stored = self._appended("tf_billing_usage", "billing_usage", _usage_rows)
        recent = stored.filter(F.col(LOAD_DAY) >= F.lit(mark.date()))
        return inc.incremental(recent, silver.LOAD, mark).drop(LOAD_DAY)

    def serving(self) -> DataFrame:
        return self._appended("tf_serving_usage", "serving_endpoint_usage", _serving_rows).drop(flows.BATCH)

    def _appended(self, name: str, landed: str, rows: flows.Prepare) -> DataFrame:
        known = self.schemas.schema(landed, self.landed_schemas[landed])
        schema = self._carrying(landed, rows)(self.spark.createDataFrame([], known)).schema
        return flows.read_appended_batches(self.spark, self.tables.folder(name), schema)

    # -- steps -------------------------------------------------------------

    def run_streams(self) -> None:
        """Append facts and fold every change feed: one stream for each landed table, whatever it feeds. A stream
        starts with all fields that were ever seen in its feed."""
        feeds = ["query_history", "billing_usage", "serving_endpoint_usage", *(s.table for s in silver.CHANGE_FED)]
        self.schemas.look({n: (f"{self.landed}/{n}", self.landed_schemas[n]) for n in feeds})
        history, usage = self._carrying("query_history", _history_rows), self._carrying("billing_usage", _usage_rows)
        serving = self._carrying("serving_endpoint_usage", _serving_rows)
        folds = {
            "query_history": [
                flows.index_fold(history, self.index, "tf_query_history", START_DAY),
                flows.scd1_by_day_fold(history, self.tables, "tf_query_history", silver.QUERY_HISTORY.keys, silver.QUERY_HISTORY.seq, START_DAY)],
            "billing_usage": [self._appending("tf_billing_usage", usage, LOAD_DAY)],
            "serving_endpoint_usage": [
                flows.index_fold(serving, self.index, "tf_serving_usage", REQUEST_DAY),
                flows.append_fold(_served_days, self.tables.folder("_served_days")),
                self._appending("tf_serving_usage", serving, REQUEST_DAY)],
        }
        running = {}
        for spec in silver.BILLING_ENTITIES:
            folds["billing_usage"].append(flows.scd1_fold(
                lambda batch, s=spec: silver.extract_entity(batch, s), self.tables, f"td_billing_{spec.name}", spec.keys, "ingestion_dt",
                silver.ENTITY_ORDER, spec.id_col, lambda df, s=spec: with_sentinels(df, s.sentinels, s.id_col)))
        for spec in silver.CHANGE_FED:
            name = DIMENSION_TABLES[spec.table]
            view = self._carrying(spec.table, lambda batch, extra, s=spec: silver.source_view(batch, s, extra))
            folds[spec.table] = [
                flows.index_fold(view, self.index, name, spec.seq),
                flows.scd1_fold(view, self.tables, name, spec.keys, spec.seq, (), spec.id_col,
                                lambda df, s=spec: with_sentinels(df, s.sentinels, s.id_col)),
                flows.scd2_fold(view, self.tables, f"{name}_history", spec.keys, spec.seq)]
        for landed, parts in folds.items():
            running[landed] = flows.feed_flow(self._stream(landed), parts, self._checkpoint(landed))
        run_all(running)
        parts = [f"_expectations_{n}" for n in RULED]
        if number := sum(max(self.tables.versions(n), default=0) for n in parts):
            found = [df for n in parts if (df := self.tables.read(n)) is not None]
            self.tables.replace("_expectations", reduce(DataFrame.unionByName, found), version=number)

    def _appending(self, name: str, rows: flows.Prepare, day: str) -> flows.Fold:
        """Append to a fact; what a batch breaks of the fact's rules is counted on the way and kept under the batch's number."""
        kept = f"_expectations_{name}"

        def report(found: DataFrame, batch_id: int) -> None:
            found = found.select(F.lit(name).alias("table_name"), "*", F.current_timestamp().alias(silver.LOAD))
            known = self.tables.read(kept, before=batch_id + 1)
            self.tables.replace(kept, found if known is None else known.unionByName(found), version=batch_id + 1)

        return flows.observed_fold(
            rows, RULED[name], report, lambda watched: flows.append_fold(watched, self.tables.folder(name), [day]))

    def _fold(self, name: str, merge: Callable[..., DataFrame], source: DataFrame) -> DataFrame:
        """Merge ``source`` into a table; if no row is inserted, updated or closed, nothing is written."""
        merged = merge(self.current(name), source, actions=True)
        if self.tables.exists(name) and merged.filter(F.col(ACTION) != "keep").isEmpty():
            return self.tables.read(name)
        return self.tables.replace(name, merged.drop(ACTION))

    def run_workspaces(self) -> None:
        self._fold("td_workspace", ids.merge_workspaces, self.snapshot("access_workspaces"))

    def run_identities(self) -> None:
        users = ids.parse_users(self.snapshot("account_users"))
        robots = ids.parse_service_principals(self.snapshot("account_service_principals"))
        landed_groups = self.snapshot("account_groups")
        self._fold("td_dbx_user", ids.merge_users, users)
        self._fold("td_dbx_service_principal", ids.merge_service_principals, robots)
        self._fold("td_identity", ids.merge_identities, ids.unify_identities(users, robots))
        self._fold("td_dbx_group", ids.merge_groups, ids.parse_groups(landed_groups))
        self._fold("tr_dbx_group_member", ids.merge_group_members, ids.parse_group_edges(landed_groups))

    def run_visibility(self) -> None:
        """Who is in which group at any depth, inside each account. Pairs of users are made when they are read.

        The three tables of a state (edges, groups that a group reaches, its members) carry one version number, and the
        row that names it comes last, so a run that stops half-way starts again from the old state. Without
        changed memberships nothing is written; else only groups above a change are derived again.
        """
        scope = ["account_cd"]
        edges = self.current("tr_dbx_group_member").filter("is_deleted_fl = 0").select(*scope, "group_cd", "member_cd", "member_type_lb")
        state = self.tables.read("_closure_state")
        if state is None:
            reach, apply = groups.reachable_groups(edges, scope), None
        else:
            before, reach, closed = (self.tables.read(n, before=state.first()[0] + 1) for n in CLOSURE)
            changed = groups.changed_edges(before, edges, scope).checkpoint()
            if changed.isEmpty():
                return
            reach, touched = groups.reach_apply(reach, edges, changed, scope)
            apply = lambda now: groups.closure_apply(closed, now, edges, changed, touched, scope)
        number = 1 + max(v for n in CLOSURE for v in (0, *self.tables.versions(n)))
        self.tables.replace(CLOSURE[0], edges, version=number)
        reach = self.tables.replace(CLOSURE[1], reach, version=number)
        self.tables.replace(CLOSURE[2], apply(reach) if apply else groups.members_of(reach, edges, scope), version=number)
        self.tables.replace("_closure_state", self.spark.range(1).select(F.lit(number).alias("version_nb")))

    def run_cost(self) -> None:
        """Price what arrived since the stored mark.

        The mark moves last, so a run that stops half-way is repeated in full, and folding the
        same lines again changes nothing.
        """
        prices = self._fold("td_billing_list_price", costing.merge_prices, self.snapshot("billing_list_prices"))
        marks = self.current("_marks")
        mark = inc.stored_mark(marks, "tf_billing_cost")
        arrived = self.arrived_usage(mark).persist()
        try:
            days = touched_days(arrived, costing.COST_DAY)
            if not days:
                return
            lines = silver.dedupe_usage(arrived, origin=flows.BATCH).drop(flows.BATCH)
            fresh = costing.costed(lines, prices, self.currency)
            stored = self.tables.days("tf_billing_cost", costing.COST_DAY, days)
            merged = fresh if stored is None else costing.merge_cost(stored, fresh)
            self.index.record("tf_billing_cost", self.tables.next_load("tf_billing_cost"), lines, costing.COST_DAY, "usage_dt")
            self.tables.overwrite_days("tf_billing_cost", merged, costing.COST_DAY)
            self.tables.replace(
                "_marks", inc.upsert_mark(marks, "tf_billing_cost", inc.next_mark(arrived, silver.LOAD, mark)))
        finally:
            arrived.unpersist()

    def _dimensions(self) -> dict[str, DataFrame]:
        names = [*DIMENSION_TABLES.values(), *[f"td_billing_{s.name}" for s in silver.BILLING_ENTITIES]]
        found = {n: self.tables.read(n) for n in names}
        return {n: df for n, df in found.items() if df is not None}

    def run_resources(self) -> None:
        """Resources, tag keys and the tags that resources carry; the dense grid is made when it is read."""
        dims = self._dimensions()
        unified = res.unify_resources({**dims, "td_workspace": self.current("td_workspace")})
        resources = self._fold("td_resource", res.merge_resources, unified)
        maps = res.tag_maps(dims)
        keys = self._fold("td_tag_key", res.merge_tag_keys, tags.tag_keys(maps))
        held = tags.resource_labels(tags.attach_resource(maps, resources), keys)
        self._fold("tr_resource_tag", res.merge_bridge, held)

    def run_attribution(self, days: list[dt.date] | None = None) -> None:
        """Recompute attributed cost for the given usage days (default: all). A late
        statement or a corrected line changes every share of its day. Of each fact only the folders are
        read that hold rows of these days."""
        if not self.tables.exists("tf_billing_cost"):
            return
        if days is None:
            cost, history, usage = self.tables.read("tf_billing_cost"), self.tables.read("tf_query_history"), self.serving()
        else:
            folders = self.index.folders("tf_billing_cost", days)
            cost = self.tables.days("tf_billing_cost", costing.COST_DAY, folders).filter(F.col("usage_dt").isin(days))
            history = self.tables.days("tf_query_history", START_DAY, days)
            usage = self.serving().filter(F.col(REQUEST_DAY).isin(days))
        if history is not None:
            queries = costing.query_attribution(history.drop(START_DAY), costing.warehouse_pool(cost))
            self.tables.overwrite_days("mvf_query_cost_attribution", queries, "usage_dt", days)
        requests = costing.serving_attribution(
            usage.drop(REQUEST_DAY), self.tables.read("td_serving_entity"), costing.endpoint_pool(cost))
        self.tables.overwrite_days("mvf_serving_cost_attribution", requests, "usage_dt", days)

    def _index_facts(self) -> None:
        """Facts that were stored before there was an index are indexed once, from their days."""
        facts = {"tf_billing_cost": (costing.COST_DAY, "usage_dt", lambda: self.tables.read("tf_billing_cost")),
                 "tf_query_history": (START_DAY, None, lambda: self.tables.read("tf_query_history")),
                 "tf_serving_usage": (REQUEST_DAY, None, self.serving)}
        for name, (folder, day, read) in facts.items():
            if self.tables.holds(name) and not self.index.known(name):
                self.index.record(name, "stored", read(), folder, day)
        if self.tables.holds("tf_serving_usage") and not self.tables.holds("_served_days"):
            self.serving().select(*ENTITY, REQUEST_DAY).distinct().write.parquet(f"{self.tables.folder('_served_days')}/{flows.BATCH}=-1")

    def stale_days(self, since: dt.datetime) -> list[dt.date]:
        """Usage days whose shares may have changed after ``since``: days with cost lines, statements
        or requests loaded since, and days of requests whose served entity was. Facts are not read: the index of
        loads knows their days, and entities are looked up only when one was loaded."""
        parts = [self.index.since(n, since) for n in ("tf_billing_cost", "tf_query_history", "tf_serving_usage")]
        entities = self.tables.read("td_serving_entity")
        if entities is not None and self.tables.holds("_served_days") and not self.index.since("td_serving_entity", since).isEmpty():
            late = inc.incremental(entities, silver.LOAD, since)
            empty = _served_days(self.spark.createDataFrame([], self.landed_schemas["serving_endpoint_usage"]))
            served = flows.read_appended_batches(self.spark, self.tables.folder("_served_days"), empty.schema)
            parts.append(served.join(late.select(*ENTITY), ENTITY, "left_semi").select(F.col(REQUEST_DAY).alias("day_dt")))
        return sorted(d for d in touched_days(reduce(DataFrame.unionByName, parts), "day_dt") if d is not None)

    def run_stale_attribution(self) -> None:
        """Recompute the stale days. The mark is the newest load that the index knows, and moves last."""
        self._index_facts()
        marks = self.current("_marks")
        since = inc.stored_mark(marks, "attribution")
        reached = self.index.reached(["tf_billing_cost", "tf_query_history", "tf_serving_usage", "td_serving_entity"])
        if reached is None or reached <= since:
            return
        days = self.stale_days(since)
        if days:
            self.run_attribution(days)
        value = self.spark.range(1).select(F.lit(reached).cast("timestamp").alias("last_processed_dt"))
        self.tables.replace("_marks", inc.upsert_mark(marks, "attribution", value))

    def run(self, full: bool = False) -> None:
        """All steps. ``full`` reads everything that ever landed into a new generation; if one of its steps fails, this
        object goes on with the current generation, as all readers do, and the next full refresh begins anew."""
        steps = (self.run_streams, self.run_workspaces, self.run_identities, self.run_visibility, self.run_cost,
                 self.run_resources, self.run_stale_attribution)
        current = self.generation
        if full:
            self._use(self._unused_generation())
        try:
            for step in steps:
                step()
            if full:
                now = self.spark.range(1).select(F.lit(self.generation).alias("generation_nb"))
                self._generations.replace("current", now)
        except BaseException:
            self._use(current)
            raise

    def _unused_generation(self) -> int:
        """The number of a generation that no earlier refresh, complete or not, has written to."""
        number, home = self.generation + 1, Tables(self.spark, self.root)
        while home.holds(f"generation-{number:04d}"):
            number += 1
        return number

    # -- reporting ---------------------------------------------------------

    def gold(self) -> dict[str, DataFrame]:
        read = self.current
        workspaces, resources, people = read("td_workspace"), read("td_resource"), read("td_identity")
        entities = self.tables.read("td_serving_entity")
        return {
            "vd_pbi_resource": gold.resource_dim(resources),
            "vd_pbi_identity": gold.identity_dim(people),
            "vd_pbi_workspace": gold.workspace_dim(workspaces),
            "vd_pbi_tag_key": gold.tag_key_dim(read("td_tag_key")),
            "vd_pbi_serving_entity": gold.serving_entity_dim(entities),
            "vd_pbi_dbx_group": gold.group_dim(read("td_dbx_group")),
            "vr_pbi_resource_tag": gold.resource_tag_grid(read("tr_resource_tag"), resources, read("td_tag_key")),
            "vr_pbi_dbx_group_member": gold.group_member_bridge(read("tr_dbx_group_member")),
            "vr_pbi_dbx_user_security": gold.visibility_pairs(
                read("td_dbx_user"), read("tr_dbx_group_member"), read("tr_dbx_group_closure")),
            "vf_pbi_billing_cost": gold.billing_cost_fact(
                self.tables.read("tf_billing_cost"), workspaces, resources, people),
            "vf_pbi_query_cost": gold.query_cost_fact(
                self.tables.read("mvf_query_cost_attribution"), workspaces, resources, people),
            "vf_pbi_serving_cost": gold.serving_cost_fact(
                self.tables.read("mvf_serving_cost_attribution"), workspaces, resources, people, entities),
        }

    def register_views(self) -> list[str]:
        """Expose the reporting views to Spark SQL."""
        views = self.gold()
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)
