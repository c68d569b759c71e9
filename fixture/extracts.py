"""Raw extracts as projections of the test tables.

The same text runs on Spark and on the oracle; ``{orders}`` and the like stand for the base
tables. All rows of the base tables take part.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tidewatch import Settings, Warehouse

AS_OF = date(2000, 6, 1)
BASE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
BASE_TABLES = tuple(BASE_SCHEMAS)

SQL = {
    "partners": """
select concat('P', cast(n_nationkey as varchar(10))) as partner_id,
       concat(' ', n_name) as partner_name,
       upper(r_name) as partner_type
from {nation} join {region} on n_regionkey = r_regionkey
""",
    "entities": """
select concat('E', cast(c_custkey as varchar(20))) as entity_id,
       concat(c_name, ' Ltd ') as entity_name,
       concat('P', cast(c_nationkey as varchar(10))) as partner_id,
       concat(' ', c_mktsegment) as entity_type,
       case c_custkey % 8 when 0 then 'Approved' when 2 then 'pending ' when 4 then 'EXPIRED'
            else 'rejected' end as kyc_status
from {customer}
""",
    # four in ten customers are registered under an address they raise no ticket from
    "investors": """
select concat('C', cast(c_custkey as varchar(20))) as investor_id,
       concat('U', cast(c_custkey as varchar(20))) as user_id,
       case when c_custkey % 10 >= 6 then concat('private.', c_name, '@mail.example')
            when c_custkey % 50 = 1
            then concat('customer#', lpad(cast(c_custkey - 1 as varchar(20)), 9, '0'))
            when c_custkey % 3 = 0 then concat(' ', upper(c_name), ' ')
            else c_name end as email,
       concat(' ', c_name) as full_name,
       concat('E', cast(c_custkey - c_custkey % 2 as varchar(20))) as entity_id,
       c_mktsegment as country,
       first_at as created_at,
       case when c_custkey % 5 < 2 then null
            else concat('S', cast(c_custkey % 10 as varchar(20))) end as relationship_manager_id
from {customer} left join (
  select o_custkey, min(case when o_orderstatus <> 'P' then o_orderdate end) as first_at
  from {orders} group by o_custkey) as firsts on c_custkey = o_custkey
""",
    "rms": """
select concat('S', cast(s_suppkey as varchar(20))) as rm_id,
       concat('P', cast(s_nationkey as varchar(10))) as partner_id,
       concat(s_name, ' ') as name,
       concat('CUSTOMER#', lpad(cast(case when s_suppkey % 20 = 0 then s_suppkey * 10
                                          else s_suppkey * 10 + 7 end as varchar(20)), 9, '0'))
         as email
from {supplier}
""",
    "tickets": """
select o_orderkey as ticket_id,
       case when o_custkey % 10 = 8
            then concat('ops', cast(o_custkey as varchar(20)),
                        case when o_custkey % 20 = 8 then '@corp.com' else '@corp.io' end)
            when o_custkey % 2 = 0
            then concat(' Customer#', lpad(cast(o_custkey as varchar(20)), 9, '0'))
            else concat('CUSTOMER#', lpad(cast(o_custkey as varchar(20)), 9, '0'), ' ')
            end as requester_email,
       concat('Requester ', cast(o_custkey as varchar(20))) as requester_name,
       concat('Order ', cast(o_orderkey as varchar(20)), ' ') as subject,
       case o_orderstatus when 'F' then 'Resolved' when 'O' then ' open' else 'pending' end as status,
       case o_orderpriority when '1-URGENT' then 'Urgent' when '2-HIGH' then 'HIGH '
            when '3-MEDIUM' then 'medium' else 'low' end as priority,
       o_orderdate as created_at,
       case when o_orderstatus = 'F' and last_at >= o_orderdate then last_at end as resolved_at,
       tags,
       case when o_orderkey % 9 < 4 then null when o_orderkey % 9 = 4 then '  '
            else concat('Nation_', cast(o_orderkey % 27 as varchar(10))) end as partner_label
from {orders} left join (
  select l_orderkey, max(l_shipdate) as last_at,
         concat(chr(min(ascii(l_returnflag))), ', ', chr(max(ascii(l_linestatus))), ',,',
                chr(max(ascii(l_returnflag)))) as tags
  from {lineitem} group by l_orderkey) as lines on o_orderkey = l_orderkey
""",
    # a part that no first line names is a close without a date, half of them completed
    "closes": """
select concat('K', cast(p_partkey as varchar(20))) as close_id,
       concat('F', cast(p_partkey % 50 as varchar(20))) as fund_id,
       concat(p_name, ' ') as fund_name,
       case when p_partkey % 97 = 0 then null
            else concat('P', cast(p_partkey % 26 as varchar(10))) end as partner_id,
       p_size as close_number,
       cast(first_ship as date) as scheduled_close_date,
       case when p_type = 'PROMO' then 'Cancelled'
            when first_ship < date '2000-01-01' then 'completed '
            when first_ship is null and p_partkey % 2 = 0 then 'completed '
            else 'UPCOMING' end as close_status,
       cast(round(p_retailprice, 0) as bigint) as total_committed_aum
from {part} left join (
  select l_partkey, max(case when l_linenumber = 1 then l_shipdate end) as first_ship
  from {lineitem} group by l_partkey) as ships on p_partkey = l_partkey
""",
    "label_synonyms": """
select n_name as label_raw, concat('P', cast(n_nationkey as varchar(10))) as partner_id,
       n_name as partner_name from {nation}
union all
select lower(n_name), concat('P', cast(n_nationkey as varchar(10))), n_name from {nation}
union all
select concat(' Nation_', cast(n_nationkey as varchar(10))),
       concat('P', cast(n_nationkey as varchar(10))), n_name from {nation}
""",
    "tag_themes": """
select * from (values ('r', 'returns', 'Returns', 1), ('a', 'returns', 'Returns', 1),
                      ('f', 'line_state', 'Line state', 2), ('o', 'line_state', 'Line state', 2))
  as t(tag, theme, theme_label, theme_sort_order)
""",
}

# tickets as texts, some of which are not of their column's type
TEXTS = """
select case when ticket_id % 50 = 7 then concat('no. ', cast(ticket_id as varchar(20)))
            else cast(ticket_id as varchar(20)) end as ticket_id,
       requester_email,
       case when ticket_id % 40 = 3 then 'yesterday' when ticket_id % 40 = 4 then ' '
            else cast(cast(created_at as date) as varchar(20)) end as created_on,
       case when ticket_id % 30 = 11 then '12 or so' else concat(' ', cast(ticket_id % 90 as varchar(9)), ' ')
            end as minutes
from {raw_tickets}
"""


class _Lazy(dict):
    """Raw extracts that are planned when first asked for."""

    def __init__(self, plan: Callable[[str], DataFrame]):
        super().__init__()
        self._plan = plan

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._plan(name)
        return self[name]


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    @lru_cache(None)
    def base(name: str) -> DataFrame:
        return base_table(spark, sf_dir, name)

    def plan(name: str) -> DataFrame:
        used = {t: base(t) for t in BASE_TABLES if "{" + t + "}" in SQL[name]}
        return spark.sql(SQL[name], **used)

    return _Lazy(plan)


def warehouse(spark: SparkSession, sf_dir: str, **settings) -> Warehouse:
    return Warehouse(raw_extracts(spark, sf_dir), Settings(as_of=AS_OF, **settings))
