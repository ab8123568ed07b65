"""Test tables reshaped into billing data.

Each view is one SQL text that Spark and DuckDB both run; ``<..>`` marks the few
words that differ. Views may use other views. ``bronze`` frames below wrap a view
in the nested shape in which the landed tables arrive.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# word -> (Spark, DuckDB)
DIALECT = {
    "<K>": ("cast(get_json_object(props,'$.k') as int)", "cast(json_extract_string(props,'$.k') as int)"),
    "<TS>": ("timestamp_ntz", "timestamp"),
    "<DAY>": ("day", "day"),
}

VIEWS: dict[str, str] = {}

VIEWS["fx_usage"] = """
select u.*, concat(u.line_key,'-',u.dup_nb) as record_cd from (
 select l_orderkey*10+l_linenumber as line_key,
  cast(row_number() over (partition by l_orderkey,l_linenumber order by l_partkey,l_suppkey,l_quantity,l_extendedprice,l_discount,l_tax,l_shipdate) as int) as dup_nb,
  concat('acct-',n.n_regionkey) as account_cd, concat('ws-',n.n_nationkey) as workspace_cd, p.p_brand as sku_name_lb,
  case when l_suppkey%3=0 then 'AWS' when l_suppkey%3=1 then 'AZURE' else 'GCP' end as cloud_lb,
  cast(l_shipdate as date) as usage_dt, cast(l_shipdate as date)+cast(l_partkey%3 as int) as ingestion_dt,
  l_shipdate as usage_end_dt,
  case when l_linestatus='O' then 'DBU' else 'GB' end as usage_unit_lb,
  cast(l_quantity as decimal(18,4)) as usage_quantity_nb,
  case when l_linenumber=1 then 'JOBS' when l_linenumber=2 then 'DLT' when l_linenumber=3 then 'SQL'
    when l_linenumber=4 then 'ALL_PURPOSE' when l_linenumber=5 then 'MODEL_SERVING' when l_linenumber=6 then 'NETWORKING'
    when l_suppkey%2=0 then 'DATA_QUALITY_MONITORING' else 'PREDICTIVE_OPTIMIZATION' end as product_lb,
  case when l_linenumber=1 then concat('job-',l_partkey) end as job_cd,
  case when l_linenumber=2 then concat('pl-',l_partkey) end as pipeline_cd,
  case when l_linenumber=3 then concat('wh-',l_suppkey) end as warehouse_cd,
  case when l_linenumber in (1,4) and l_partkey%4<2 then concat('cl-',l_suppkey) end as cluster_cd,
  case when l_linenumber=4 and l_partkey%4=2 then concat('app-',l_suppkey) end as app_cd,
  case when l_linenumber=4 and l_partkey%4=3 then concat('nb-',l_suppkey) end as notebook_cd,
  case when l_linenumber=5 then concat('ep-',l_suppkey) end as endpoint_cd,
  case when l_linenumber=6 and l_partkey%2=0 then concat('net-',l_suppkey) end as network_client_cd,
  case when l_linenumber=7 and l_suppkey%2=0 and l_partkey%5>0 then concat('dq-',l_suppkey) end as dqm_cd,
  case when o_custkey%10=0 then cast(null as varchar(60)) when o_custkey%10=1 then ''
    when o_custkey%10=2 then '0a1b2c3d-0000-1111-2222-333344445555'
    when o_custkey%10=3 then concat('ghost',o_custkey,'@x.org')
    when o_custkey%10=4 then concat('odd-',o_custkey) else concat('user',o_custkey,'@x.org') end as run_as_cd,
  case when o_custkey%20=0 then concat('user',o_custkey+5,'@x.org') end as run_by_cd,
  case when o_custkey%3=0 then concat('user',o_custkey,'@x.org') end as created_by_cd,
  cast(null as varchar(60)) as owned_by_cd,
  case when l_returnflag='A' then 1 else 0 end as is_serverless_fl,
  case when l_discount>0.05 then 1 else 0 end as is_photon_fl
 from {lineitem} join {orders} on l_orderkey=o_orderkey join {customer} c on o_custkey=c_custkey
 join {nation} n on c_nationkey=n_nationkey join {part} p on l_partkey=p_partkey) u
"""

# Yearly half-open windows 1996..2000 for what was ever billed, the last one open; 1995
# usage stays unpriced. A second currency checks the currency filter.
VIEWS["fx_price"] = """
select account_cd, sku_name_lb, cloud_lb, currency_code_lb, 'DBU' as usage_unit_lb,
 cast(make_date(y,1,1) as <TS>) as price_start_dt,
 case when y<2000 then cast(make_date(y+1,1,1) as <TS>) end as price_end_dt,
 cast(f*(0.10+y%10*0.01) as decimal(18,4)) as default_price_nb,
 case when y%2=0 then cast(f*(0.08+y%10*0.01) as decimal(18,4)) end as effective_list_price_nb
from (select account_cd, sku_name_lb, cloud_lb, y, currency_code_lb, case when currency_code_lb='USD' then 1 else 2 end as f
 from (select account_cd, sku_name_lb, cloud_lb, y, <BOTH> as currency_code_lb
  from (select distinct account_cd, sku_name_lb, cloud_lb, cast(year(usage_dt) as int) as y from {fx_usage}) a where y between 1996 and 2000) b) c
"""
DIALECT["<BOTH>"] = ("explode(array('USD','EUR'))", "unnest(['USD','EUR'])")

VIEWS["fx_cost"] = """
select u.*, cast(u.usage_quantity_nb*coalesce(p.effective_list_price_nb,p.default_price_nb) as decimal(38,8)) as line_cost_usd
from {fx_usage} u left join (select * from {fx_price} where currency_code_lb='USD') p
 on u.account_cd=p.account_cd and u.sku_name_lb=p.sku_name_lb and u.cloud_lb=p.cloud_lb
 and u.usage_end_dt>=p.price_start_dt and (p.price_end_dt is null or u.usage_end_dt<p.price_end_dt)
"""

# A thousand windows of a day each for every SKU, the last one open.
VIEWS["fx_price_daily"] = """
select account_cd, sku_name_lb, cloud_lb, 'USD' as currency_code_lb,
 cast(date '1996-01-01'+n as <TS>) as price_start_dt, case when n<999 then cast(date '1996-01-01'+n+1 as <TS>) end as price_end_dt,
 cast(0.10+n%50*0.01 as decimal(18,4)) as default_price_nb,
 case when n%7=0 then cast(0.05+n%30*0.01 as decimal(18,4)) end as effective_list_price_nb
from (select account_cd, sku_name_lb, cloud_lb, <DAYS> as n from (select distinct account_cd, sku_name_lb, cloud_lb from {fx_usage}) k) d
where n%11<>3
"""
DIALECT["<DAYS>"] = ("explode(sequence(0,999))", "unnest(cast(range(1000) as int[]))")

# Two days of memberships: some end, some are added, groups in groups among them.
VIEWS["fx_edge_before"] = """
select * from {fx_edge} where substr(member_cd,length(member_cd),1) not in ('3','7') or (group_cd like 'r%' and member_type_lb='Users')
"""
VIEWS["fx_edge_after"] = """
select * from {fx_edge} where substr(member_cd,length(member_cd),1) not in ('1','7') or (group_cd like 'n%' and member_type_lb='Groups')
"""

# Logins with a low balance are unknown; some belong to two identities.
VIEWS["fx_identity"] = """
select c_custkey*2+1 as identity_id, concat('acct-',n_regionkey) as account_cd, concat('user',c_custkey,'@x.org') as identity_cd,
 c_name as display_name_lb, cast('USER' as varchar(20)) as identity_type_lb, concat('u-',c_custkey) as source_cd,
 case when c_custkey%4=0 then 0 else 1 end as is_active_fl
from {customer} join {nation} on c_nationkey=n_nationkey where c_acctbal>2000
union all
select c_custkey*2 as identity_id, concat('acct-',n_regionkey), concat('user',c_custkey,'@x.org'), concat(c_name,' (2)'),
 'SERVICE PRINCIPAL', concat('s-',c_custkey), case when c_custkey%4=0 then 1 else 0 end
from {customer} join {nation} on c_nationkey=n_nationkey where c_acctbal>5000
"""

VIEWS["fx_workspace"] = """
select n_nationkey+1 as workspace_id, concat('acct-',n_regionkey) as account_cd, concat('ws-',n_nationkey) as workspace_cd,
 case n_nationkey%4 when 0 then concat(lower(n_name),'-dev') when 1 then concat(lower(n_name),'-staging')
  when 2 then concat(lower(n_name),'-prod') else lower(n_name) end as workspace_lb,
 case when n_nationkey%6=0 then 1 else 0 end as is_deleted_fl from {nation} where n_regionkey<>4
"""

# Resources of the usage lines; those not used since 2000 are unknown to the dimension.
VIEWS["fx_resource"] = """
select (t*100000000+number_nb)*100+nation_nb as resource_id, resource_type_lb, source_cd, account_cd, workspace_cd,
 concat(lower(resource_type_lb),' ',number_nb) as display_name_lb,
 case when number_nb%3=0 then cast(null as varchar(60)) else concat('user',number_nb,'@x.org') end as owned_by_cd,
 case when number_nb%8=0 then 0 else 1 end as is_active_fl
from (select t, resource_type_lb, source_cd, account_cd, workspace_cd, cast(substr(workspace_cd,4) as int) as nation_nb,
  cast(substr(source_cd, instr(source_cd,'-')+1) as bigint) as number_nb
 from (select account_cd, workspace_cd, usage_dt,
  case when job_cd is not null then 1 when pipeline_cd is not null then 2 when warehouse_cd is not null then 3 when cluster_cd is not null then 4
   when app_cd is not null then 5 when notebook_cd is not null then 6 when endpoint_cd is not null then 7 when network_client_cd is not null then 8 else 9 end as t,
  case when job_cd is not null then 'JOB' when pipeline_cd is not null then 'PIPELINE' when warehouse_cd is not null then 'WAREHOUSE'
   when cluster_cd is not null then 'CLUSTER' when app_cd is not null then 'APP' when notebook_cd is not null then 'NOTEBOOK'
   when endpoint_cd is not null then 'ENDPOINT' when network_client_cd is not null then 'NETWORKING' else 'DATA QUALITY MONITORING' end as resource_type_lb,
  coalesce(job_cd,pipeline_cd,warehouse_cd,cluster_cd,app_cd,notebook_cd,endpoint_cd,network_client_cd,dqm_cd) as source_cd
  from {fx_usage}) x where source_cd is not null group by t, resource_type_lb, source_cd, account_cd, workspace_cd having max(usage_dt)>=date '2000-01-01') y
"""

# What the billing fact view must show, column for column.
VIEWS["fx_gold_cost"] = """
select c.record_cd, c.ingestion_dt, c.usage_dt, c.account_cd, coalesce(w.workspace_id,-3) as workspace_id, c.product_lb, c.sku_name_lb,
 c.usage_unit_lb, c.usage_quantity_nb, c.line_cost_usd,
 case when c.is_serverless_fl=1 then 'Yes' else 'No' end as is_serverless_fl,
 case when c.is_photon_fl=1 then 'Yes' else 'No' end as is_photon_fl,
 c.job_cd, c.cluster_cd, c.warehouse_cd, c.pipeline_cd, c.app_cd, c.notebook_cd, c.endpoint_cd, c.network_client_cd, c.dqm_cd,
 c.login_cd as run_as_cd,
 coalesce(r.resource_id, case c.type_lb when 'JOB' then -3 when 'PIPELINE' then -4 when 'CLUSTER' then -5 when 'WAREHOUSE' then -6
   when 'APP' then -7 when 'NOTEBOOK' then -8 when 'ENDPOINT' then -9 when 'NETWORKING' then -10
   when 'DATA QUALITY MONITORING' then -11 when 'DATA_QUALITY_MONITORING' then -11 else -2 end) as resource_id,
 coalesce(i.identity_id, case when c.login_cd is null or c.login_cd='' then 0
   when <GUID> then -4 when c.login_cd like '%@%' then -3 else -1 end) as identity_id
from (select u.*,
  case when product_lb='DATA_QUALITY_MONITORING' then created_by_cd
   else coalesce(run_as_cd,run_by_cd,created_by_cd,owned_by_cd) end as login_cd,
  case when job_cd is not null then 'JOB' when pipeline_cd is not null then 'PIPELINE' when warehouse_cd is not null then 'WAREHOUSE'
   when cluster_cd is not null then 'CLUSTER' when app_cd is not null then 'APP' when notebook_cd is not null then 'NOTEBOOK'
   when endpoint_cd is not null then 'ENDPOINT' when network_client_cd is not null or product_lb='NETWORKING' then 'NETWORKING'
   when dqm_cd is not null then 'DATA QUALITY MONITORING' else product_lb end as type_lb,
  coalesce(job_cd,pipeline_cd,warehouse_cd,cluster_cd,app_cd,notebook_cd,endpoint_cd,network_client_cd,
   case when product_lb='NETWORKING' then 'NETWORKING' end, dqm_cd, product_lb) as source_cd
 from {fx_cost} u) c
left join {fx_workspace} w on w.account_cd=c.account_cd and w.workspace_cd=c.workspace_cd
left join {fx_resource} r on r.account_cd=c.account_cd and r.workspace_cd=c.workspace_cd
 and r.resource_type_lb=c.type_lb and r.source_cd=c.source_cd
left join (select account_cd, identity_cd, identity_id from (select f.*, row_number() over (partition by account_cd,identity_cd
  order by is_active_fl desc, identity_id) as rn from {fx_identity} f) z where rn=1) i
 on i.account_cd=c.account_cd and i.identity_cd=c.login_cd
"""
DIALECT["<GUID>"] = tuple(
    f"{fn}(c.login_cd,'^[0-9a-fA-F]{{{{8}}}}-[0-9a-fA-F]{{{{4}}}}-[0-9a-fA-F]{{{{4}}}}-[0-9a-fA-F]{{{{4}}}}-[0-9a-fA-F]{{{{12}}}}$')"
    for fn in ("regexp_like", "regexp_matches")
)

# Billed lines of the days the events fall in: cost of warehouses and endpoints.
VIEWS["fx_billed"] = """
select concat(l_orderkey,'-',l_linenumber) as record_cd, date '2024-01-01'+cast(day(l_shipdate)-1 as int) as usage_dt,
 concat('acct-',l_partkey%2) as account_cd, concat('ws-',l_partkey%2) as workspace_cd,
 case when l_linenumber=3 then concat('wh-',l_suppkey%9) end as warehouse_cd,
 case when l_linenumber=5 then concat('ep-',l_suppkey%4) end as endpoint_cd,
 cast(l_extendedprice as decimal(18,4)) as line_cost_usd
from {lineitem}
"""
VIEWS["fx_query"] = """
select concat('st-',event_id) as statement_cd, concat('acct-',user_id%2) as account_cd, concat('ws-',user_id%2) as workspace_cd,
 ts as start_dt, cast(ts as date) as usage_dt, user_id, concat('wh-',<K>%10) as warehouse_cd,
 case when event_type='view' then 1 else 0 end as cache_fl, cast(floor(value*1000) as bigint) as total_ms,
 case when event_type='click' then cast(floor(value*100) as bigint) end as queue_ms,
 case when event_type='signup' then cast(floor(value*50) as bigint) end as start_ms,
 case when event_type='error' then 'FAILED' else 'FINISHED' end as status_lb,
 case when user_id%7=0 then '' when user_id%7=1 then cast(null as varchar(20)) else concat('app ',user_id%7) end as client_lb,
 cast(floor(value*977001703) as bigint) as read_bytes_nb,
 concat('user',user_id,'@x.org') as executed_by_lb
from {events}
"""
VIEWS["fx_entity_version"] = """
select concat('acct-',user_id%2) as account_cd, concat('ws-',user_id%2) as workspace_cd, concat('se-',user_id%20) as served_entity_cd,
 case when user_id%20<18 then concat('ep-',user_id%5) end as endpoint_cd, event_type as entity_type_lb, ts as change_time, event_id,
 case when event_type='error' then ts end as delete_dt from {events}
"""
VIEWS["fx_entity"] = """
select account_cd, workspace_cd, served_entity_cd, endpoint_cd, entity_type_lb, change_time, delete_dt,
 case when delete_dt is null then 0 else 1 end as is_deleted_fl,
 cast(substr(served_entity_cd,4) as bigint)+1 as entity_id from (
 select v.*, row_number() over (partition by account_cd,workspace_cd,served_entity_cd order by change_time desc, event_id desc) as rn
 from {fx_entity_version} v) x where rn=1
"""
VIEWS["fx_serving"] = """
select concat('rq-',event_id) as request_cd, concat('acct-',user_id%2) as account_cd, concat('ws-',user_id%2) as workspace_cd,
 ts as request_dt, cast(ts as date) as usage_dt, user_id, concat('se-',user_id%20) as served_entity_cd,
 case when event_type='click' then cast(null as bigint) when user_id%5=0 then 0 else cast(floor(value*10) as bigint) end as input_token_nb,
 case when event_type='view' and user_id%5<>0 then cast(floor(value) as bigint) end as output_token_nb,
 case when event_type='error' then 500 else 200 end as status_code_nb,
 concat('user',user_id,'@x.org') as requester_lb from {events}
"""
VIEWS["fx_change"] = """
select concat('acct-',user_id%2) as account_cd, concat('ws-',user_id%3) as workspace_cd, concat('e-',user_id) as entity_cd,
 ts as change_time, event_id, event_type as name_lb, value as size_nb,
 case when event_type='error' then ts end as delete_time from {events}
"""
VIEWS["fx_tag"] = """
select p_partkey as resource_id, case p_partkey%4 when 0 then 'app_id' when 1 then 'APP_ID' when 2 then ' App_Id' else 'AppId' end as raw_key_lb,
 concat('A',p_size) as tag_value_lb from {part}
union all select p_partkey, case p_partkey%2 when 0 then 'env' else 'ENV' end, p_type from {part} where p_size>30
union all select p_partkey, 'team', p_brand from {part} where p_size<12
"""
VIEWS["fx_edge"] = """
select concat('r',n_regionkey) as group_cd, concat('n',n_nationkey) as member_cd, 'Groups' as member_type_lb from {nation}
union all select concat('n',c_nationkey),concat('c',c_custkey),'Users' from {customer}
union all select concat('n',s_nationkey),concat('s',s_suppkey),'ServicePrincipals' from {supplier}
union all select concat('r',n_regionkey),concat('c',c_custkey),'Users' from {customer} join {nation} on c_nationkey=n_nationkey where c_acctbal>9000
union all select concat('n',n_nationkey),concat('r',n_regionkey),'Groups' from {nation} where n_nationkey=n_regionkey
"""
VIEWS["fx_daily"] = """
select usage_dt, sum(line_cost_usd) as cost from {fx_cost} group by usage_dt
"""

_NEEDS = re.compile(r"\{(\w+)\}")


def needs(name: str) -> list[str]:
    return list(dict.fromkeys(_NEEDS.findall(VIEWS[name])))


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(name):
        for n in needs(name):
            if n in VIEWS:
                visit(n)
        if name not in out:
            out.append(name)

    for n in names:
        visit(n)
    return out


def _dialect(text: str, engine: int) -> str:
    for word, pair in DIALECT.items():
        text = text.replace(word, pair[engine])
    return text


def sql(body: str, *views: str, **extra: str) -> str:
    """DuckDB query with the needed views as common table expressions. ``extra`` adds
    named steps of its own, in order."""
    names = {t: t for t in [*TABLES, *VIEWS]}
    steps = [f"{v} as ({_dialect(VIEWS[v], 1).format(**names)})" for v in _order(views)]
    steps += [f"{name} as ({_dialect(text, 1)})" for name, text in extra.items()]
    head = "with recursive " + ",\n".join(steps) + "\n" if steps else ""
    return head + _dialect(body, 1)


_PLANS: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Keep the unevaluated frame per session and folder, so its files are listed once."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _once(spark, sf_dir, name, lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# What Spark runs in place of some words of a view, with the same rows. Its planner keeps the order of joins that it is told, which for the
# usage lines would shuffle every line by order, customer, part and order again; and it numbers the copies of a line after all columns
# are spelled out, which would sort these instead of what they are made from. A resource is in use since a day if one of its lines is, so
# older lines need not be grouped.
_COPY = "row_number() over (partition by l_orderkey,l_linenumber order by l_partkey,l_suppkey,l_quantity,l_extendedprice,l_discount,l_tax,l_shipdate)"
_IN_SPARK = {"fx_usage": [
    (_COPY, "copy_nb"), ("n.n_", "n_"), ("p.p_brand", "p_brand"),
    ("""from {lineitem} join {orders} on l_orderkey=o_orderkey join {customer} c on o_custkey=c_custkey
 join {nation} n on c_nationkey=n_nationkey join {part} p on l_partkey=p_partkey""".replace("n.n_", "n_"),
     f"""from (select *, {_COPY} as copy_nb from ({{lineitem}} join {{part}} on l_partkey=p_partkey)
 join ({{orders}} join {{customer}} on o_custkey=c_custkey join {{nation}} on c_nationkey=n_nationkey) on l_orderkey=o_orderkey)"""),
], "fx_resource": [
    ("where source_cd is not null group by", "where source_cd is not null and usage_dt>=date '2000-01-01' group by"),
    (" having max(usage_dt)>=date '2000-01-01'", ""),
]}


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A view as a DataFrame; views that it uses may be ``given``, as when they were written once."""

    def build() -> DataFrame:
        frames = {
            n: given[n] if n in given else view(spark, sf_dir, n) if n in VIEWS else table(spark, sf_dir, n) for n in needs(name)
        }
        text = VIEWS[name]
        for word, other in _IN_SPARK.get(name, []):
            text = text.replace(word, other)
        return spark.sql(_dialect(text, 0), **frames)

    return build() if given else _once(spark, sf_dir, name, build)


# ---- landed shapes ---------------------------------------------------------

def landed_usage(usage: DataFrame) -> DataFrame:
    c = F.col
    return usage.select(
        c("account_cd").alias("account_id"),
        c("workspace_cd").alias("workspace_id"),
        c("record_cd").alias("record_id"),
        c("sku_name_lb").alias("sku_name"),
        c("cloud_lb").alias("cloud"),
        c("usage_end_dt").alias("usage_start_time"),
        c("usage_end_dt").alias("usage_end_time"),
        c("usage_dt").alias("usage_date"),
        F.create_map(F.lit("product"), c("product_lb")).alias("custom_tags"),
        c("usage_unit_lb").alias("usage_unit"),
        c("usage_quantity_nb").alias("usage_quantity"),
        F.struct(
            c("cluster_cd").alias("cluster_id"),
            c("warehouse_cd").alias("warehouse_id"),
            F.lit(None).cast("string").alias("node_type"),
            c("job_cd").alias("job_id"),
            c("notebook_cd").alias("notebook_id"),
            F.concat(F.lit("/nb/"), "notebook_cd").alias("notebook_path"),
            c("pipeline_cd").alias("dlt_pipeline_id"),
            c("endpoint_cd").alias("endpoint_id"),
            F.upper("endpoint_cd").alias("endpoint_name"),
            c("app_cd").alias("app_id"),
            F.upper("app_cd").alias("app_name"),
            c("network_client_cd").alias("networking_client"),
            c("dqm_cd").alias("schema_id"),
        ).alias("usage_metadata"),
        F.struct(
            c("run_as_cd").alias("run_as"), c("run_by_cd").alias("run_by"),
            c("created_by_cd").alias("created_by"), c("owned_by_cd").alias("owned_by"),
        ).alias("identity_metadata"),
        F.lit("ORIGINAL").alias("record_type"),
        c("ingestion_dt").alias("ingestion_date"),
        c("product_lb").alias("billing_origin_product"),
        F.struct(
            F.lit("CORE").alias("jobs_tier"),
            (c("is_serverless_fl") == 1).alias("is_serverless"),
            F.when(c("is_photon_fl") == 1, True).alias("is_photon"),
        ).alias("product_features"),
        F.lit("COMPUTE_TIME").alias("usage_type"),
    )


def landed_history(queries: DataFrame) -> DataFrame:
    c = F.col
    null = lambda t: F.lit(None).cast(t)
    return queries.select(
        c("statement_cd").alias("statement_id"),
        c("account_cd").alias("account_id"),
        c("workspace_cd").alias("workspace_id"),
        c("status_lb").alias("execution_status"),
        F.lit("SELECT").alias("statement_type"),
        c("executed_by_lb").alias("executed_by"),
        c("user_id").cast("string").alias("executed_by_user_id"),
        c("executed_by_lb").alias("executed_as"),
        c("user_id").cast("string").alias("executed_as_user_id"),
        F.to_json(F.struct(c("warehouse_cd").alias("warehouse_id"))).alias("compute"),
        F.to_json(F.struct(
            F.struct(F.concat(F.lit("job-"), "user_id").alias("job_id")).alias("job_info"),
            F.when(c("cache_fl") == 1, F.concat(F.lit("db-"), "user_id")).alias("dashboard_id"),
        )).alias("query_source"),
        null("map<string,string>").alias("query_tags"),
        c("client_lb").alias("client_application"),
        null("string").alias("client_driver"),
        c("start_dt").alias("start_time"),
        c("start_dt").alias("end_time"),
        c("total_ms").alias("total_duration_ms"),
        null("bigint").alias("execution_duration_ms"),
        null("bigint").alias("compilation_duration_ms"),
        c("start_ms").alias("waiting_for_compute_duration_ms"),
        c("queue_ms").alias("waiting_at_capacity_duration_ms"),
        null("bigint").alias("read_rows"),
        null("bigint").alias("produced_rows"),
        c("read_bytes_nb").alias("read_bytes"),
        null("bigint").alias("written_rows"),
        null("bigint").alias("written_bytes"),
        (c("cache_fl") == 1).alias("from_result_cache"),
        c("start_dt").alias("update_time"),
    )


def landed_serving(requests: DataFrame) -> DataFrame:
    c = F.col
    return requests.select(
        c("account_cd").alias("account_id"),
        c("workspace_cd").alias("workspace_id"),
        F.lit("eu").alias("region"),
        c("request_cd").alias("databricks_request_id"),
        F.lit(None).cast("string").alias("client_request_id"),
        c("served_entity_cd").alias("served_entity_id"),
        c("requester_lb").alias("requester"),
        c("status_code_nb").alias("status_code"),
        c("request_dt").alias("request_time"),
        c("input_token_nb").alias("input_token_count"),
        c("output_token_nb").alias("output_token_count"),
        F.lit(None).cast("bigint").alias("input_character_count"),
        F.lit(None).cast("bigint").alias("output_character_count"),
        F.lit(None).cast("string").alias("usage_context"),
        (c("status_code_nb") == 200).alias("request_streaming"),
    )


def landed_entities(versions: DataFrame) -> DataFrame:
    c = F.col
    text = lambda n: F.lit(None).cast("string").alias(n)
    return versions.select(
        c("account_cd").alias("account_id"),
        c("workspace_cd").alias("workspace_id"),
        c("served_entity_cd").alias("served_entity_id"),
        F.lit("eu").alias("region"),
        c("endpoint_cd").alias("endpoint_id"),
        F.upper("endpoint_cd").alias("endpoint_name"),
        F.upper("served_entity_cd").alias("served_entity_name"),
        c("entity_type_lb").alias("entity_type"),
        text("entity_name"), text("entity_version"),
        F.lit(1).alias("endpoint_config_version"),
        text("task"), text("created_by"),
        text("external_model_config"), text("foundation_model_config"),
        text("custom_model_config"), text("feature_spec_config"),
        c("change_time"),
        c("delete_dt").alias("endpoint_delete_time"),
    )
