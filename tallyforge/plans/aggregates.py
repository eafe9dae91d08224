"""Driver queries of the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators import aggregates as A
from tallyforge.plans.fixtures import load, with_tables
from tallyforge.plans.registry import query

c = F.col
NIGHTS, LEDGER, BEATS, POOL, META, TRAJ, COST, CHAT = (with_tables(n) for n in ("nights", "ledger", "beats", "pool", "meta", "traj", "swarm_cost", "chat"))


@query(
    "agg_01_aggregate_arm",
    NIGHTS
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY night, arm, mode ORDER BY wall_ms NULLS LAST) AS k, count(wall_ms) OVER (PARTITION BY night, arm, mode) AS m, row_number() OVER (PARTITION BY night, arm, mode ORDER BY importance NULLS LAST) AS ki, count(importance) OVER (PARTITION BY night, arm, mode) AS mi FROM nights),
tt AS (SELECT night, arm, mode, string_agg(t || '=' || n, ',' ORDER BY n DESC, t) AS top_tools FROM (SELECT *, row_number() OVER (PARTITION BY night, arm, mode ORDER BY n DESC, t) AS k FROM (SELECT night, arm, mode, 't' || event_id % 8 AS t, count(*) AS n FROM nights WHERE event_id % 8 > 0 GROUP BY ALL)) WHERE k <= 5 GROUP BY ALL),
h AS (SELECT night, arm, mode, string_agg(output_type || '=' || n, ',' ORDER BY output_type || '=' || n) AS output_types FROM (SELECT night, arm, mode, output_type, count(*) AS n FROM nights WHERE output_type IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT night, arm, mode, count(*) AS records, count(DISTINCT account_id) AS accounts, count(*) FILTER (is_error) AS errors, round_even(count(*) FILTER (is_error) / count(*), 4) AS error_rate, count(*) FILTER (emitted) AS emitted, count(*) FILTER (NOT emitted) AS never_emitted, count(*) FILTER (output_type = 'no_action') AS no_action, round_even(count(*) FILTER (output_type = 'no_action') / count(*), 4) AS no_action_rate,
count(*) FILTER (emitted AND output_type <> 'no_action') AS actionable, sha256(string_agg(DISTINCT envelope_hash, chr(10) ORDER BY envelope_hash)) AS envelopes, count(DISTINCT envelope_hash) AS envelope_hashes, round_even(avg(wall_ms), 4) AS latency_mean,
CAST(sum(coalesce(tool_calls, 0)) AS BIGINT) AS tool_calls_total, CAST(sum(tool_errors) AS BIGINT) AS tool_errors_total, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens_total, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens_total,
round_even(sum(iterations) / count(*), 4) AS iterations_mean, round_even(sum(prompt_tokens) / count(*), 4) AS prompt_tokens_mean, round_even(sum(completion_tokens) / count(*), 4) AS completion_tokens_mean,
count(*) FILTER (tool_errors > 0) AS records_with_tool_error, count(*) FILTER (coalesce(tool_calls, 0) = 0) AS zero_tool_call_records, round_even(count(*) FILTER (coalesce(tool_calls, 0) = 0) / count(*), 4) AS zero_tool_call_rate,
max(max_parallel) AS max_parallel_calls, count(*) FILTER (truncated) AS truncated_records, string_agg(DISTINCT provider, ',' ORDER BY provider) AS providers, string_agg(DISTINCT model_id, ',' ORDER BY model_id) AS serving_model_ids,
max(importance) FILTER (ki = CAST(round_even((mi - 1) * 0.5, 0) AS BIGINT) + 1) AS importance_p50, any_value(top_tools) AS top_tools,
CAST(max(wall_ms) FILTER (m > 0 AND k = CAST(round_even((m - 1) * 0.5, 0) AS BIGINT) + 1) AS DOUBLE) AS latency_p50, CAST(max(wall_ms) FILTER (m > 0 AND k = CAST(round_even((m - 1) * 0.95, 0) AS BIGINT) + 1) AS DOUBLE) AS latency_p95, any_value(output_types) AS output_types
FROM r LEFT JOIN h USING (night, arm, mode) LEFT JOIN tt USING (night, arm, mode) GROUP BY night, arm, mode""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    names = F.when(c("event_id") % 8 > 0, F.array(F.concat(F.lit("t"), (c("event_id") % 8).cast("string"))))
    return A.aggregate_arm(load(spark, sf, "nights").withColumn("tool_names", names), ["night", "arm", "mode"])


@query("agg_02_absent_latency", NIGHTS + " SELECT night, arm, count(wall_ms) > 0 AS has_latency FROM nights GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.aggregate_arm(load(spark, sf, "nights"), ["night", "arm"]).select("night", "arm", c("latency_mean").isNotNull().alias("has_latency"))


@query("agg_03_set_hash", NIGHTS + " SELECT night, arm, sha256(string_agg(DISTINCT envelope_hash, chr(10) ORDER BY envelope_hash)) AS set_hash, count(DISTINCT envelope_hash) AS members FROM nights GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.set_identity(load(spark, sf, "nights"), ["night", "arm"], "envelope_hash")


@query(
    "agg_04_rank_percentile",
    "WITH r AS (SELECT o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS k, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) SELECT o_orderpriority, max(o_totalprice) FILTER (k = CAST(round_even((n - 1) * 0.5, 0) AS BIGINT) + 1) AS p50, max(o_totalprice) FILTER (k = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT) + 1) AS p95, max(o_totalprice) FILTER (k = n // 2 + 1) AS upper_median FROM r GROUP BY ALL",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.rank_percentiles(load(spark, sf, "orders"), "o_orderpriority", "o_totalprice", {"p50": 0.5, "p95": 0.95})


@query(
    "agg_05_paired_compare",
    NIGHTS
    + """, l AS (SELECT night, account_id, arg_max(output_type, event_id) AS o FROM nights WHERE mode = 'live-shadow' AND event_id % 2 = 0 GROUP BY ALL), i AS (SELECT night, account_id, arg_max(output_type, event_id) AS o FROM nights WHERE mode = 'live-shadow' AND event_id % 2 = 1 GROUP BY ALL)
SELECT night, count(*) AS pairs, count(*) FILTER (l.o = i.o) AS match, count(*) FILTER (i.o <> 'no_action' AND l.o = 'no_action') AS missed, count(*) FILTER (i.o <> 'no_action' AND l.o <> 'no_action' AND l.o <> i.o) AS different, count(*) FILTER (l.o <> 'no_action' AND i.o = 'no_action') AS false_alarm, count(*) FILTER (l.o IS NULL) AS never_emitted FROM l JOIN i USING (night, account_id) GROUP BY night""".replace("arg_max(output_type, event_id)", "arg_max_null(output_type, event_id)"),
)
def _(spark, sf):  # noqa: ANN001, ANN202
    live = load(spark, sf, "nights").where("mode = 'live-shadow'")
    last = lambda df: df.groupBy("night", "account_id").agg(F.max_by("output_type", "event_id").alias("output_type"))
    return A.paired_compare(last(live.where("event_id % 2 = 0")), last(live.where("event_id % 2 = 1")))


@query(
    "agg_06_style_concentration",
    """WITH o AS (SELECT array_to_string(list_slice(regexp_extract_all(lower(text), '[a-z0-9'']+'), 1, 6), ' ') AS o FROM documents), g AS (SELECT o, count(*) AS n FROM o WHERE o <> '' GROUP BY o), t AS (SELECT * FROM g ORDER BY n DESC, o LIMIT 3)
SELECT (SELECT count(*) FROM g) AS openings, (SELECT o FROM t ORDER BY n DESC, o LIMIT 1) AS top, round_even((SELECT max(n) FROM t) / (SELECT sum(n) FROM g), 4) AS top1_share, round_even((SELECT sum(n) FROM t) / (SELECT sum(n) FROM g), 4) AS top3_share, 'pass' AS verdict""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.style_concentration(load(spark, sf, "documents"), "text")


@query("agg_07_rare_tokens", "WITH t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9'']+')) AS token FROM documents) SELECT token, count(*) AS df FROM t GROUP BY token HAVING count(*) < greatest(2, 0.05 * (SELECT count(*) FROM documents))")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.rare_tokens(load(spark, sf, "documents"), "doc_id", "text")


@query("agg_08_fillability", POOL + ", p(class, share) AS (VALUES ('1-URGENT', 0.5), ('2-HIGH', 0.3), ('9-NONE', 0.1)) SELECT p.class, greatest(5, CAST(round_even(share * 1000, 0) AS INTEGER)) AS needed, coalesce(n, 0) AS available, CASE WHEN coalesce(n, 0) >= greatest(5, CAST(round_even(share * 1000, 0) AS INTEGER)) THEN 'pass' ELSE 'fail' END AS verdict FROM p LEFT JOIN (SELECT class, count(*) AS n FROM pool GROUP BY class) q ON q.class = p.class")
def _(spark, sf):  # noqa: ANN001, ANN202
    plan = spark.createDataFrame([("1-URGENT", 0.5), ("2-HIGH", 0.3), ("9-NONE", 0.1)], "class string, share double")
    return A.fillability(load(spark, sf, "pool"), plan, 1000, 5)


@query("agg_08_fillability_state", POOL + ", n AS (SELECT class, count(*) AS n FROM pool GROUP BY class), p(class, share) AS (VALUES ('1-URGENT', 0.1), ('2-HIGH', 0.9), ('9-NONE', 0.1)), d AS (SELECT p.class, coalesce(n, 0) >= greatest(5, CAST(round_even(share * (SELECT count(*) FROM pool), 0) AS INTEGER)) AS ok FROM p LEFT JOIN n USING (class)), t AS (SELECT (SELECT count(*) FROM pool) AS r, count(*) FILTER (NOT ok) AS u, string_agg(class, ',' ORDER BY class) FILTER (NOT ok) AS un FROM d) SELECT 3 AS classes_planned, r AS pool_rows, u AS unfillable, un AS unfillable_classes, 1 AS inadmissible, '9-NONE' AS inadmissible_classes, 'fail' AS verdict FROM t UNION ALL SELECT 3, r, u, un, 0, '', 'fail' FROM t UNION ALL SELECT 0, r, 0, '', 0, '', 'suspect' FROM t")
def _(spark, sf):  # noqa: ANN001, ANN202
    plan = spark.createDataFrame([("1-URGENT", 0.1), ("2-HIGH", 0.9), ("9-NONE", 0.1)], "class string, share double")
    pool = load(spark, sf, "pool")
    n = pool.count()
    return A.fillability_state(pool, plan, n, 5, ["1-URGENT", "2-HIGH"]).unionByName(A.fillability_state(pool, plan, n, 5)).unionByName(A.fillability_state(pool, None, n, 5, ["x"]))


@query("agg_09_anchor_census", POOL + ", a AS (SELECT night, count(*) AS actual, count(*) + day(night) % 7 - 3 AS claimed FROM pool GROUP BY night) SELECT night, claimed, actual FROM a WHERE claimed < 0.8 * actual - 2 OR claimed > 1.25 * actual + 2")
def _(spark, sf):  # noqa: ANN001, ANN202
    pool = load(spark, sf, "pool")
    anchors = pool.groupBy("night").agg(F.count("*").alias("n")).select("night", (c("n") + F.day("night") % 7 - 3).alias("claimed"))
    return A.anchor_census(anchors, pool)


@query("agg_10_marker_hits", "SELECT marker, CAST(sum(len(regexp_extract_all(text, marker))) AS BIGINT) AS hits, count(*) FILTER (regexp_matches(text, marker)) AS surfaces FROM documents CROSS JOIN (VALUES ('clown'), ('license'), ('token')) m(marker) GROUP BY marker")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.marker_hits(load(spark, sf, "documents"), ["clown", "license", "token"])


@query("agg_11_window_hygiene", POOL + " SELECT CASE WHEN id % 2 = 0 THEN 'pool' ELSE 'corpus' END AS origin, count(*) AS rows, CASE WHEN id % 2 = 0 THEN 'suspect' ELSE 'fail' END AS verdict FROM pool WHERE day(night) = 13 GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    pool = load(spark, sf, "pool").withColumn("origin", F.when(c("id") % 2 == 0, "pool").otherwise("corpus"))
    return A.window_hygiene(pool, pool.where(F.day("night") == 13).select("night").distinct(), "pool")


_SEEN = with_tables("ledger") + ", r AS (SELECT tool, CASE WHEN ok THEN 'ok' END AS output_type, dt AS night FROM ledger)"


@query("agg_12_observed_surface", _SEEN + " SELECT kind, value, count(*) AS n FROM (SELECT 'tool' AS kind, tool AS value FROM r UNION ALL SELECT 'output', output_type FROM r UNION ALL SELECT 'night', CAST(night AS VARCHAR) FROM r) WHERE value IS NOT NULL GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.observed_surface(load(spark, sf, "ledger").select("tool", F.when(c("ok"), "ok").alias("output_type"), c("dt").alias("night")))


@query("agg_12_stamp_keys", "SELECT 'stamp_key' AS kind, k AS value, count(*) AS n FROM (SELECT unnest(CASE WHEN event_id % 3 = 0 THEN ['model', 'k'] ELSE ['k'] END) AS k FROM events WHERE event_id % 5 > 0) GROUP BY ALL UNION ALL SELECT 'unstamped', 'none', count(*) FROM events WHERE event_id % 5 = 0 UNION ALL SELECT 'tool', event_type, count(*) FROM events GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("event_id")
    stamp = F.when(k % 5 == 0, F.when(k % 2 == 0, "{bad")).when(k % 3 == 0, '{"model": {"a": 1}, "k": null}').otherwise(c("props"))
    rows = load(spark, sf, "events").select(c("event_type").alias("tool"), F.lit(None).cast("string").alias("output_type"), F.lit(None).cast("date").alias("night"), stamp.alias("stamp"))
    return A.observed_surface(rows)


@query("agg_13_contract_parity", "SELECT event_type AS tool, 'called_not_offered' AS code, count(*) AS calls, 'fail' AS verdict FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY ALL UNION ALL SELECT 'search', 'offered_unobserved', 0, 'info' UNION ALL SELECT o_orderstatus, 'rogue_output', count(*), 'fail' FROM orders WHERE o_orderstatus NOT IN ('F', 'P') GROUP BY ALL UNION ALL SELECT o_orderpriority, 'forbidden_class', count(*), 'fail' FROM orders WHERE o_orderpriority IN ('2-HIGH', '9-NONE') GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    orders = load(spark, sf, "orders")
    offered = spark.createDataFrame([("view",), ("click",), ("search",)], "tool string")
    return A.contract_parity(load(spark, sf, "events").select(c("event_type").alias("tool"), F.lit(1).alias("calls")), offered, orders.select(c("o_orderstatus").alias("output_type")), ["F", "P"], orders.select(c("o_orderpriority").alias("gold_class")), ["2-HIGH", "9-NONE"])


@query(
    "agg_14_emit_lint",
    """WITH e AS (SELECT event_id AS k, event_id % 13 = 0 AS bad, event_id % 2 = 0 AS own FROM events WHERE event_type = 'purchase')
SELECT (SELECT count(*) FROM events) AS records, count(*) FILTER (NOT bad AND own AND k % 5 = 0) AS bad_archetype, count(*) FILTER (NOT bad AND k % 7 = 0) AS nonempty_drafts, count(*) FILTER (NOT bad AND k % 3 > 0) AS importance_drift,
count(*) FILTER (NOT bad AND own AND k % 1000 > 0 AND (k % 1000 < 200 OR k % 1000 > 900)) AS rationale_out_of_band, 'fail' AS verdict FROM e""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("line")
    sequence = F.struct(F.when(k % 5 == 0, "C").when(k % 5 == 1, "").otherwise("A").alias("archetype"), F.repeat(F.lit("r"), (k % 1000).cast("int")).alias("rationale"))
    args = F.struct(F.when(k % 2 == 0, "winback_enrollment").otherwise("other").alias("output_type"), F.struct(sequence.alias("sequence")).alias("payload"), F.lit("B").alias("archetype"), F.when(k % 7 == 0, "draft").otherwise("").alias("draft_body"), (k % 3).alias("importance_score"))
    calls = load(spark, sf, "traj").withColumn("args", F.when(k % 13 == 0, "{bad").otherwise(F.to_json(args)))
    return A.emit_lint(calls, tool="purchase")


@query("agg_15_staleness", "SELECT event_id AS key, round_even((epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(date_trunc('second', ts))) / 3600, 1) + 0.0 AS hours, CASE WHEN round_even((epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(date_trunc('second', ts))) / 3600, 1) > 0 THEN 'stale' ELSE 'fresh' END AS state FROM events")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.staleness(load(spark, sf, "events").select(c("event_id").alias("key"), "ts"), "2024-01-20 00:00:00")


@query("agg_16_census_ratio", "SELECT c_custkey AS key, CAST(c_custkey % 15 + 1 AS BIGINT) AS recorded, coalesce(n, 0) AS actual, round_even(coalesce(n, 0) / (c_custkey % 15 + 1), 4) AS ratio, CASE WHEN round_even(coalesce(n, 0) / (c_custkey % 15 + 1), 4) BETWEEN 0.8 AND 1.25 THEN 'pass' ELSE 'fail' END AS verdict FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL) ON o_custkey = c_custkey")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.census_ratio(load(spark, sf, "customer").select(c("c_custkey").alias("key"), (c("c_custkey") % 15 + 1).alias("recorded")), load(spark, sf, "orders").select(c("o_custkey").alias("key")))


@query("agg_17_readiness", "WITH o AS (SELECT c_nationkey AS org, count(*) FILTER (o_orderstatus = 'F') AS facts, count(*) FILTER (o_orderstatus <> 'F') AS zeros FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL) SELECT org, facts, zeros, 40 * facts + 10 * zeros AS dose, round_even(facts / (facts + zeros), 4) AS fact_share, CASE WHEN round_even(facts / (facts + zeros), 4) >= 0.5 THEN 'A' WHEN round_even(facts / (facts + zeros), 4) >= 0.25 THEN 'B' ELSE 'C' END AS tier FROM o")
def _(spark, sf):  # noqa: ANN001, ANN202
    book = load(spark, sf, "orders").join(load(spark, sf, "customer"), c("c_custkey") == c("o_custkey")).select(c("c_nationkey").alias("org"), (c("o_orderstatus") == "F").alias("fact"))
    return A.readiness(book)


@query(
    "agg_17_recommend",
    """WITH o AS (SELECT c_nationkey AS org, count(DISTINCT c_custkey) AS accounts, count(*) FILTER (o_orderstatus = 'O' AND c_nationkey % 3 > 0) AS transcripts, count(*) FILTER (o_orderstatus = 'P') AS reviews, count(DISTINCT c_custkey) FILTER (o_orderkey % 4 = 0) AS facts, count(DISTINCT c_custkey) FILTER (o_orderkey % 9 = 0) AS zeros FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
t AS (SELECT *, CASE WHEN accounts > 0 AND transcripts > 0 AND reviews > 0 THEN 'A' WHEN accounts >= 220 THEN 'B' ELSE 'C' END AS tier FROM o)
SELECT org, tier, 40 * facts + 10 * zeros AS dose, round_even(facts / accounts, 3) AS fact_share, CASE tier WHEN 'C' THEN 'decline' WHEN 'B' THEN 'behavioral_deferred' ELSE CASE WHEN facts / accounts < 0.25 THEN 'behavioral_dominant' ELSE 'full' END END AS recommendation FROM t""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    both = load(spark, sf, "orders").join(load(spark, sf, "customer"), c("c_custkey") == c("o_custkey"))
    who = lambda test: F.countDistinct(F.when(test, c("c_custkey")))
    of = both.groupBy(c("c_nationkey").alias("org")).agg(F.countDistinct("c_custkey").alias("accounts"), F.count_if(c("o_orderstatus") == "O").alias("t"), F.count_if(c("o_orderstatus") == "P").alias("reviews"), who(c("o_orderkey") % 4 == 0).alias("facts"), who(c("o_orderkey") % 9 == 0).alias("zeros"))
    return A.recommend(of.withColumn("transcripts", F.when(c("org") % 3 == 0, 0).otherwise(c("t"))))


@query("agg_18_project_cost", "SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS key, round_even(l_quantity * 1000000.0 * l_linenumber / 1e6 * 0.5 * 1.0 * 2.0 * 1.1 + 1.5, 4) AS usd, CASE WHEN round_even(l_quantity * 1000000.0 * l_linenumber / 1e6 * 0.5 * 1.0 * 2.0 * 1.1 + 1.5, 4) > 60 THEN 'stop' WHEN round_even(l_quantity * 1000000.0 * l_linenumber / 1e6 * 0.5 * 1.0 * 2.0 * 1.1 + 1.5, 4) <= 20 THEN 'auto' ELSE 'ask' END AS action FROM lineitem")
def _(spark, sf):  # noqa: ANN001, ANN202
    runs = load(spark, sf, "lineitem").select(F.concat_ws("-", *[c(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey")]).alias("key"), (c("l_quantity").cast("double") * 1e6).alias("tokens"), c("l_linenumber").alias("epochs"), F.lit(1.0).alias("unroll"))
    return A.project_cost(runs, 0.5, 60, 20, dual=2.0, calibration=1.1, eval_cap=1.5)


@query("agg_19_cost_summary", COST + " SELECT role_id, count(*) AS attempts, count(coalesce(corrected_usd, value_usd)) AS known, round_even(count(coalesce(corrected_usd, value_usd)) / count(*), 4) AS coverage, CASE WHEN count(coalesce(corrected_usd, value_usd)) = count(*) THEN round(sum(coalesce(corrected_usd, value_usd)), 2) END AS usd FROM swarm_cost WHERE role_id % 2 = 1 OR attempt_id % 6 <> 0 GROUP BY role_id")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.cost_summary(load(spark, sf, "swarm_cost").where("role_id % 2 = 1 or attempt_id % 6 <> 0"))


@query("agg_20_lane_packet", COST + " SELECT cost_category AS lane, count(*) AS attempts, count(DISTINCT role_id) AS roles, count(*) - count(DISTINCT role_id) AS retries, CASE WHEN count(*) FILTER (value_usd IS NULL) > 0 AND bool_or(attempt_id % 7 = 0) THEN 'unknown_cost,failed_attempt' WHEN count(*) FILTER (value_usd IS NULL) > 0 THEN 'unknown_cost' WHEN bool_or(attempt_id % 7 = 0) THEN 'failed_attempt' ELSE '' END AS blockers, count(*) FILTER (value_usd IS NULL) = 0 AND NOT bool_or(attempt_id % 7 = 0) AS complete FROM swarm_cost GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.lane_packet(load(spark, sf, "swarm_cost").withColumn("lane", c("cost_category")).withColumn("failed", c("attempt_id") % 7 == 0))


@query("agg_21_flow_summary", "SELECT event_type AS edge_type, conf AS confidence, count(*) AS edges FROM (SELECT event_type, CASE WHEN value > 30 THEN 'high' WHEN value > 10 THEN 'medium' ELSE 'low' END AS conf FROM events) GROUP BY ROLLUP (event_type, conf)")
def _(spark, sf):  # noqa: ANN001, ANN202
    conf = F.when(c("value") > 30, "high").when(c("value") > 10, "medium").otherwise("low")
    return A.flow_summary(load(spark, sf, "events").select(c("event_type").alias("edge_type"), conf.alias("confidence")))


@query("agg_21_outcome_matrix", "SELECT user_id % 4 AS runtime, event_type AS kind, count(*) FILTER (value <= 20) AS low, count(*) FILTER (value > 20) AS high FROM events GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "events").select((c("user_id") % 4).alias("runtime"), c("event_type").alias("kind"), F.when(c("value") <= 20, "low").otherwise("high").alias("outcome"))
    return A.outcome_matrix(rows, ["low", "high"])


@query("agg_22_fleet_status", BEATS + ", n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY (ts IS NOT NULL) DESC, ts DESC NULLS LAST, (origin = 'worktree') DESC, event_id DESC) AS r FROM beats) WHERE r = 1) SELECT count(*) AS sessions, count(*) FILTER (status = 'blocked') AS blocked, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'paused') AS degraded, CASE WHEN count(*) FILTER (status = 'blocked') > 0 THEN 3 WHEN count(*) FILTER (status = 'paused') > 0 THEN 1 ELSE 0 END AS code FROM n")
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.operators.joins import newest_beat

    return A.fleet_status(newest_beat(load(spark, sf, "beats")))


@query("agg_23_worst_verdict", "SELECT o_custkey, CASE WHEN bool_or(coalesce(v = 'fail', false)) THEN 'fail' WHEN bool_or(coalesce(v NOT IN ('pass', 'info'), true)) THEN 'suspect' ELSE 'pass' END AS verdict FROM (SELECT o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN 'fail' WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'info' ELSE 'pass' END AS v FROM orders) GROUP BY o_custkey")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    v = F.when(k % 11 == 0, "fail").when(k % 7 == 0, None).when(k % 2 == 0, "info").otherwise("pass")
    return load(spark, sf, "orders").withColumn("v", v).groupBy("o_custkey").agg(T.worst_verdict(c("v")).alias("verdict"))


@query("agg_24_session_activity", LEDGER + ", f AS (SELECT session_id, path, min((ts, event_id)) AS first_at, count(*) AS n FROM ledger GROUP BY ALL) SELECT session_id, string_agg(path, ',' ORDER BY first_at) AS paths, CAST(sum(n) AS BIGINT) AS tools FROM f GROUP BY session_id")
def _(spark, sf):  # noqa: ANN001, ANN202
    return A.session_activity(load(spark, sf, "ledger"))


@query("agg_25_project_usage", "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS input_tokens, CASE WHEN event_id % 5 > 0 THEN event_id END AS output_tokens, CASE WHEN event_id % 3 > 0 THEN event_id % 3 END AS turns FROM events")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("event_id")
    usage = F.struct(F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("input_tokens"), F.when(k % 5 > 0, k).alias("output_tokens"), F.when(k % 3 > 0, F.array_repeat(F.struct(k.alias("n")), (k % 3).cast("int"))).alias("iterations"))
    return A.project_usage(load(spark, sf, "events").withColumn("usage", F.to_json(usage)), "usage", ["input_tokens", "output_tokens"])


@query("agg_26_mixture_report", "WITH s AS (SELECT lang AS slice, count(*) AS records, CAST(sum(length(text) // 4) AS BIGINT) AS tokens FROM documents GROUP BY lang), t(slice, target) AS (VALUES ('en', 0.6), ('de', 0.05), ('fr', 0.15)) SELECT s.slice, records, tokens, round_even(tokens / (SELECT sum(tokens) FROM s), 4) AS share, CAST(target AS DOUBLE) AS target, CASE WHEN target IS NULL THEN 'suspect' WHEN abs(round_even(tokens / (SELECT sum(tokens) FROM s), 4) - target) > 0.05 THEN 'fail' ELSE 'pass' END AS verdict FROM s LEFT JOIN t ON t.slice = s.slice")
def _(spark, sf):  # noqa: ANN001, ANN202
    corpus = load(spark, sf, "documents").select(c("lang").alias("slice"), F.floor(F.length("text") / 4).alias("tokens"))
    return A.mixture_report(corpus, {"en": 0.6, "de": 0.05, "fr": 0.15})


_ARMS = "WITH a AS (SELECT doc_id % 3 AS arm, count(*) AS n, sum(quality) AS q, sum(toxic) AS t FROM labels GROUP BY ALL)"


@query("agg_28_lexicographic_gates", _ARMS + " SELECT arm, round_even(((q / n) + 3.8416 / (2 * n) - 1.96 * sqrt((q / n) * (1 - q / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 4) AS low, round_even(((q / n) + 3.8416 / (2 * n) + 1.96 * sqrt((q / n) * (1 - q / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 4) AS high, CASE WHEN t / n > (SELECT min(t / n) FROM a) THEN 'fail_toxic' WHEN q / n < (SELECT max(q / n) FROM a) - 0.02 THEN 'fail_quality' ELSE 'pass' END AS verdict FROM a")
def _(spark, sf):  # noqa: ANN001, ANN202
    arms = load(spark, sf, "labels").groupBy((c("doc_id") % 3).alias("arm")).agg(F.count("*").alias("n"), F.sum("quality").alias("quality"), F.sum("toxic").alias("toxic"))
    return A.lexicographic_gates(arms)


@query("agg_28_grader_disagreement", "SELECT count(*) AS pairs, count(*) FILTER (quality <> toxic) AS disagree, CASE WHEN count(*) = 0 OR count(*) FILTER (quality <> toxic) / count(*) > 0.1 THEN 'suspect' ELSE 'pass' END AS verdict FROM labels")
def _(spark, sf):  # noqa: ANN001, ANN202
    x = load(spark, sf, "labels")
    return A.grader_disagreement(x.select(c("doc_id").alias("key"), c("quality").alias("verdict")), x.select(c("doc_id").alias("key"), c("toxic").alias("verdict")))


@query("agg_29_consolidate_verdicts", "WITH v AS (SELECT doc_id // 4 AS item, CASE WHEN toxic = 1 THEN 'fail' WHEN quality = 0 THEN 'suspect' ELSE 'pass' END AS verdict FROM labels), g AS (SELECT item, verdict, CASE verdict WHEN 'fail' THEN 2 WHEN 'suspect' THEN 1 ELSE 0 END AS r, count(*) AS n FROM v GROUP BY ALL) SELECT item, arg_max(verdict, (n, r)) AS verdict, CAST(sum(n) AS BIGINT) AS votes, count(*) > 1 AS split FROM g GROUP BY item")
def _(spark, sf):  # noqa: ANN001, ANN202
    v = F.when(c("toxic") == 1, "fail").when(c("quality") == 0, "suspect").otherwise("pass")
    return A.consolidate_verdicts(load(spark, sf, "labels").select(F.floor(c("doc_id") / 4).alias("item"), v.alias("verdict")))


@query("agg_30_status_board", "SELECT o_custkey AS org, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderpriority = '1-URGENT') AS urgent, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderpriority = '2-HIGH') AS high FROM orders GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    r = load(spark, sf, "orders").select(c("o_custkey").alias("org"), c("o_orderpriority").alias("stage"), c("o_orderstatus").alias("status"), c("o_orderdate").alias("ts"), c("o_orderkey").alias("id"))
    return A.status_board(r, ["1-URGENT", "2-HIGH"]).withColumnsRenamed({"1-URGENT": "urgent", "2-HIGH": "high"})
