"""Driver queries of the swarm ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import swarm as S
from tallyforge.plans.fixtures import load, with_tables
from tallyforge.plans.registry import query

c = F.col
_RUN = "6ba7b810-9dad-11d1-80b4-00c04fd430c"
_SWARM = with_tables("swarm") + """, fix AS (SELECT lane, attempt_id, arg_max({'u': usd, 'a': accepted}, seq) AS f FROM swarm WHERE category = 'attempt_cost' GROUP BY ALL),
att AS (SELECT s.*, CASE WHEN f IS NULL THEN s.usd ELSE f.u END AS eff, CASE WHEN f IS NULL THEN s.accepted ELSE f.a END AS acc FROM swarm s LEFT JOIN fix USING (lane, attempt_id) WHERE category = 'attempt'),
bud AS (SELECT lane, budget_id, arg_max({'c': cost_category, 'u': usd, 'a': accepted}, seq) AS b FROM swarm WHERE category = 'budget' GROUP BY ALL)"""


def ledger(spark, sf):  # noqa: ANN001, ANN201
    """The ledger with each row's fields as JSON, as it is written."""
    cost = F.struct(c("usd").alias("value_usd"), c("accepted").alias("accepted_unknown"))
    session = F.concat(F.lit("s-"), "attempt_id").alias("runtime_session_id")
    bodies = {
        "attempt": F.struct(c("attempt_id").alias("execution_attempt_id"), c("role_id").alias("logical_role_id"), F.lit("S5").alias("wave"), F.lit("probe").alias("task_id"), "state", cost.alias("cost"), session),
        "attempt_cost": F.struct(c("attempt_id").alias("execution_attempt_id"), cost.alias("cost"), session),
        "contribution": F.struct(c("attempt_id").alias("execution_attempt_id"), "disposition"),
        "conflict": F.struct("conflict_id", "severity", "status"),
        "budget": F.struct("budget_id", "cost_category", cost.alias("cost")),
        "flow": F.struct("flow_type", c("attempt_id").alias("from_ref"), F.lit("human").alias("to_ref"), F.lit("report.md").alias("artifact"), F.sha2("event_id", 256).alias("artifact_sha256"), F.when(c("flow_type") != "handoff", "FINALIZED_SHIPPED").alias("terminal_state"), F.when(c("flow_type") != "handoff", c("event_id")).alias("signed_by")),
    }
    rows = load(spark, sf, "swarm")
    kept = ["lane", "seq", "event_id", "category", "observed_at"]
    parts = [rows.where(c("category") == category).select(*kept, F.to_json(body, {"ignoreNullFields": "false"}).alias("data")) for category, body in bodies.items()]
    return reduce(DataFrame.unionByName, parts)


def runs(events):  # noqa: ANN001, ANN201
    return events.select("lane", F.concat(F.lit(_RUN), F.substring("lane", 2, 1)).alias("run_id")).distinct()


query(
    "agg_19_attempt_costs",
    _SWARM + " SELECT lane, count(*) AS attempts, count(eff) AS known, count(*) - count(eff) AS unknown, round_even(coalesce(sum(eff), 0), 2) AS known_usd, round_even(count(eff) / count(*), 4) AS coverage, CASE WHEN count(eff) = count(*) THEN 1.0 END AS dollar_coverage FROM att GROUP BY lane",
)(lambda spark, sf: S.attempt_costs(ledger(spark, sf)))
query(
    "agg_19_category_costs",
    _SWARM + """, k AS (SELECT lane, unnest(['agents', 'corpus', 'training', 'evaluation', 'shadow', 'infrastructure']) AS cost_category FROM (SELECT DISTINCT lane FROM swarm)), e AS (SELECT lane, b.c AS cost_category, b.u AS usd, 1 AS one FROM bud)
SELECT lane, cost_category, round_even(coalesce(sum(usd), 0), 2) AS known_usd, count(one) - count(usd) AS unknown_entries, count(one) AS entries FROM k LEFT JOIN e USING (lane, cost_category) GROUP BY ALL""",
)(lambda spark, sf: S.category_costs(ledger(spark, sf)))
query(
    "agg_20_decision_packet",
    _SWARM
    + """, a AS (SELECT lane, count(*) AS attempts, count(DISTINCT role_id) AS roles, count(*) FILTER (state = 'RUNNING') AS incomplete_attempts, count(*) FILTER (eff IS NULL AND NOT acc) AS unknown_costs FROM att GROUP BY lane),
m AS (SELECT lane, list_distinct(list(b.c)) AS has, coalesce(string_agg(DISTINCT b.c, ',' ORDER BY b.c) FILTER (b.u IS NULL AND NOT b.a), '') AS unreconciled_categories FROM bud GROUP BY lane),
x AS (SELECT lane, conflict_id, arg_max({'v': severity, 's': status}, seq) AS x FROM swarm WHERE category = 'conflict' GROUP BY ALL), f AS (SELECT lane, count(*) AS conflicts, count(*) FILTER (x.v = 'critical' AND x.s = 'open') AS critical_conflicts FROM x GROUP BY lane),
g AS (SELECT s.lane, count(*) AS contributions, count(*) FILTER (disposition = 'accepted') AS accepted_contributions, count(*) FILTER (NOT EXISTS (SELECT 1 FROM att WHERE att.lane = s.lane AND att.attempt_id = s.attempt_id)) AS orphan_contributions FROM swarm s WHERE category = 'contribution' GROUP BY s.lane),
t AS (SELECT lane, arg_max(event_id, seq) AS signed_by FROM swarm WHERE category = 'flow' AND flow_type = 'terminal_decision' GROUP BY lane),
p AS (SELECT l.lane, CASE WHEN signed_by IS NOT NULL THEN 'FINALIZED_SHIPPED' END AS terminal_state, signed_by, attempts, roles, greatest(0, attempts - roles) AS retries, contributions, accepted_contributions, conflicts, signed_by IS NULL AS no_terminal, incomplete_attempts, unknown_costs,
array_to_string(list_filter(['agents', 'corpus', 'evaluation', 'infrastructure', 'shadow', 'training'], lambda z: NOT list_contains(has, z)), ',') AS missing_categories, unreconciled_categories, critical_conflicts, orphan_contributions
FROM (SELECT DISTINCT lane FROM swarm) l LEFT JOIN a USING (lane) LEFT JOIN m USING (lane) LEFT JOIN f USING (lane) LEFT JOIN g USING (lane) LEFT JOIN t USING (lane))
SELECT *, NOT no_terminal AND incomplete_attempts + unknown_costs + critical_conflicts + orphan_contributions = 0 AND missing_categories = '' AND unreconciled_categories = '' AS complete FROM p""",
)(lambda spark, sf: S.decision_packet(ledger(spark, sf)))


@query(
    "evt_08_swarm_agents",
    _SWARM + f" SELECT attempt_id AS id, '{_RUN}' || substr(lane, 2, 1) AS run_id, 'S5' AS stage, 'reader' AS role, substr(role_id, 6) || '-' || left(attempt_id, 8) AS title, 'probe' AS goal, CASE WHEN state = 'RUNNING' THEN 'active' ELSE 'ended' END AS status, eff AS cost_usd, 's-' || attempt_id AS ledger_session_id FROM att",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    events = ledger(spark, sf)
    return S.agent_rows(events, runs(events))


@query(
    "evt_08_swarm_events",
    _SWARM
    + f""", e AS (SELECT 'attempt' AS kind, '{_RUN}' || substr(lane, 2, 1) AS run_id, observed_at AS ts, substr(role_id, 6) || '-' || left(attempt_id, 8) || ' attempt ' || lower(state) AS headline, (eff IS NOT NULL)::INT AS priced, attempt_id FROM att)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id, run_id, ts, 'agent_dispatched' AS kind, headline, priced
FROM (SELECT *, sha1(from_hex(replace(run_id, '-', '')) || encode('agent_dispatched|' || attempt_id)) AS h FROM e)
UNION ALL SELECT event_id, '{_RUN}' || substr(lane, 2, 1), observed_at, 'steering_event', CASE category WHEN 'budget' THEN 'swarm_budget_state' ELSE 'swarm_' || category END || ' recorded for ' || lane, 0 FROM swarm WHERE category NOT IN ('attempt', 'flow')""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    events = ledger(spark, sf)
    return S.run_events(events, runs(events)).select("id", "run_id", "ts", "kind", "headline", c("detail").contains("cost_usd").cast("int").alias("priced"))


@query(
    "evt_08_swarm_handoffs",
    _SWARM + f" SELECT event_id AS id, '{_RUN}' || substr(lane, 2, 1) AS run_id, attempt_id AS from_agent_id, 'human' AS to_agent_id, 'type=HANDOFF; confidence=certain; evidence=report.md#' || sha256(event_id) || '; sync_version=swarm-local-v1' AS summary FROM swarm WHERE category = 'flow' AND flow_type = 'handoff'",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    events = ledger(spark, sf)
    return S.handoff_rows(events, runs(events)).select("id", "run_id", "from_agent_id", "to_agent_id", "summary")
