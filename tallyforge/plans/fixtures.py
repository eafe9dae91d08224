"""Derived input tables of the driver queries: portable SQL over the given tables, run as views in Spark and as CTEs in
the oracle. Faults are planted by arithmetic on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators import selection as S

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"]

FIXTURES = {
    "chat": """
select conv_id + k * 1000000 as line, pos, role, content, weight from (
  select conv_id, turn + 1 as pos, role,
         case when role = 'assistant' and (conv_id * 31 + turn) % 13 = 0 then substr(text, 1, length(text) - 1) else text end as content,
         case when role = 'assistant' then (case when (conv_id + turn) % 17 = 0 then 0 else 1 end)
              else (case when (conv_id + turn) % 19 = 0 then 1 else 0 end) end as weight
  from conversations
  union all
  select distinct conv_id, cast(0 as bigint), 'system', 'You answer from the record.', 0 from conversations where conv_id % 4 <> 3
) m cross join (select 0 as k union all select 1) c
where k = 0 or conv_id % 9 = 0
""",
    "traj": """
select event_id as line, 0 as pos, 'system' as role, 'Use tools.' as content, cast(null as varchar(9)) as call_id, cast(null as varchar(9)) as tool_name, cast(null as varchar(9)) as args, 0 as weight from events
union all select event_id, 1, 'user', 'What is the value?', null, null, null, 0 from events
union all select event_id, 2, 'assistant', null, 'c' || cast(event_id as string), event_type, case when event_id % 31 = 0 then '{bad' else props end, 1 from events
union all select event_id, 3, 'tool', 'value ' || cast(cast(value as decimal(12,2)) as string), case when event_id % 29 = 0 then 'zz' else 'c' || cast(event_id as string) end, null, null, 0 from events
union all select event_id, 4, 'assistant', 'Value is ' || cast(cast(value + (case when event_id % 23 = 0 then 1 else 0 end) as decimal(12,2)) as string) || '.', null, null, null, 1 from events
""",
    "ledger": """
select event_id, cast(user_id as string) as session_id, ts, cast(ts as date) as dt,
       case when event_type = 'purchase' then 'write' when event_type in ('view','click') then 'read' else 'other' end as tool,
       'p' || cast(cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20 as string) as path,
       event_type <> 'error' as ok
from events
""",
    "beats": """
select 's' || cast(user_id as string) as session_id, event_id,
       row_number() over (partition by user_id order by ts, event_id) as seq,
       case when event_id % 37 = 0 then null else ts end as ts,
       case when event_id % 41 = 0 then 'paused' when event_type = 'error' then 'blocked' when event_type = 'purchase' then 'done'
            when event_type = 'signup' then 'starting' else 'working' end as status,
       case when event_id % 2 = 0 then 'worktree' else 'ref' end as origin
from events
""",
    "nights": """
select cast(ts as date) as night, case when user_id % 3 = 0 then 'v3' when user_id % 3 = 1 then 'v5' else 'a1' end as arm,
       mode, user_id as account_id, event_id,
       case when event_type = 'view' then 'no_action' when event_type = 'signup' then null else event_type end as output_type,
       event_type = 'error' as is_error, event_type <> 'error' as emitted,
       case when user_id % 3 = 2 then cast(floor(value * 10) as int) end as wall_ms,
       cast(event_id % 5 as string) as envelope_hash,
       case when event_id % 6 = 0 then null else cast(event_id % 4 as int) end as tool_calls, cast(case when event_id % 4 = 3 then event_id % 2 else 0 end as int) as tool_errors,
       cast(event_id % 3 as int) as max_parallel, cast(event_id % 7 as int) as iterations, event_id % 1000 as prompt_tokens, event_id % 300 as completion_tokens,
       event_id % 50 = 0 as truncated, case when event_id % 9 > 0 then cast(event_id % 9 as int) end as importance,
       case when event_id % 2 = 0 then 'p1' else 'p2' end as provider, 'm' || cast(user_id % 2 as string) as model_id
from events cross join (select 'live-shadow' as mode union all select 'retro-replay') v
where mode = 'live-shadow' or user_id % 3 = 2
""",
    "pool": """
select o_orderkey as id, o_custkey as account_id, cast(o_orderdate as date) as night, o_orderpriority as class,
       case when o_orderstatus = 'F' then o_orderkey end as trajectory_id
from orders
""",
    "meta": """
select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as line,
       case when l_partkey % 97 = 0 then -l_orderkey else l_orderkey end as source_row_id,
       l_partkey % 500 as cf_group, l_returnflag as gold_class, cast(l_shipdate as date) as night,
       case when l_linenumber = 1 then 'real_trajectory' when l_linenumber = 2 then 'twins' else 'replay' end as block,
       case when l_linenumber = 2 then l_orderkey end as twin_of,
       l_quantity / 4.0 as weight
from lineitem
""",
    "qa": """
select o_orderkey as line,
       'Did ' || translate(cast(o_custkey as string), '0123456789', 'ABCDEFGHIJ') || 'CO order today?' as question,
       case when o_orderstatus = 'F' then 'Yes, an order was logged.' when o_orderstatus = 'O' then 'No order was logged.'
            else 'I cannot see that from here.' end as answer,
       o_orderkey % 10 = 0 as marked
from orders
""",
    "swarm": """
select o_orderkey as seq, 'l' || cast(cast(floor(o_orderkey / 10) as bigint) % 4 as string) as lane, 'e' || cast(o_orderkey as string) as event_id, cast(o_orderdate as string) as observed_at,
       case when o_orderkey % 10 < 4 then 'attempt' when o_orderkey % 10 < 6 then 'attempt_cost' when o_orderkey % 10 = 6 then 'contribution' when o_orderkey % 10 = 7 then 'conflict' when o_orderkey % 10 = 8 then 'budget' else 'flow' end as category,
       'attempt-' || cast(o_orderkey - case when o_orderkey % 10 in (4, 5) then 4 when o_orderkey % 10 = 6 and o_orderkey % 7 > 0 then 6 else 0 end as string) as attempt_id,
       'team/r' || cast(o_orderkey % 9 as string) as role_id, case when o_orderkey % 13 = 0 then 'RUNNING' else 'COMPLETED' end as state,
       case when o_orderkey % 6 = 0 then null else cast(o_totalprice as double) end as usd, o_orderkey % 12 = 0 as accepted,
       'c' || cast(o_orderkey % 70 as string) as conflict_id, case when o_orderkey % 3 = 0 then 'critical' else 'minor' end as severity, case when o_orderkey % 11 < 3 then 'open' else 'closed' end as status,
       'b' || cast(o_orderkey % 120 as string) as budget_id, case cast(floor(o_orderkey / 40) as bigint) % 5 when 0 then 'agents' when 1 then 'corpus' when 2 then 'training' when 3 then 'shadow' else 'evaluation' end as cost_category,
       case when o_orderkey % 20 = 9 then 'terminal_decision' else 'handoff' end as flow_type, case when o_orderkey % 4 = 1 then 'accepted' else 'rejected' end as disposition
from orders
""",
    "swarm_cost": """
select o_orderkey as attempt_id, o_custkey % 8 as role_id, o_orderpriority as cost_category, o_orderdate as observed_at,
       case when o_orderkey % 6 = 0 then null else o_totalprice end as value_usd,
       case when o_orderkey % 18 = 0 then o_totalprice * 0.5 end as corrected_usd
from orders
""",
}


#: The place of a row in ``meta``, which Spark reads as a column: its window would bring the table to one task.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE = f"row_number() over (order by {', '.join(LINE_ORDER)})"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a derived one."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "meta":
        S.number_rows(load(spark, sf_dir, "lineitem"), LINE_ORDER, "place").createOrReplaceTempView("numbered_lineitem")
        return spark.sql(FIXTURES[name].replace(LINE, "place").replace("from lineitem", "from numbered_lineitem"))
    for table in TABLES:
        if f"from {table}" in FIXTURES[name]:
            load(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(FIXTURES[name])


def with_tables(*names: str) -> str:
    """The head of an oracle query that uses derived tables; more CTEs may follow after a comma."""
    return "WITH " + ", ".join(f"{n} AS ({FIXTURES[n].strip()})" for n in names)
