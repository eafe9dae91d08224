"""Driver queries of sources, derived events, flows, streaming twins and the check framework."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators import events as E
from tallyforge.operators import verify as V
from tallyforge.plans import checks as K
from tallyforge.plans.fixtures import load, with_tables
from tallyforge.plans.registry import query
from tallyforge.plans.verify import ALL_RULES_SQL
from tallyforge.sources import readers as R
from tallyforge.sources.files import shared_folder
from tallyforge.sources.snapshots import SnapshotTable
from tallyforge.streaming import jobs as J

c = F.col
LEDGER, BEATS, NIGHTS, POOL, CHAT, COST, META = (with_tables(n) for n in ("ledger", "beats", "nights", "pool", "chat", "swarm_cost", "meta"))


@query("src_01_parse_chat", "SELECT doc_id AS line, doc_id % 3 = 0 AS ok, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS n_messages FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    message = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), c("text").alias("content"))).alias("messages")))
    raw = F.when(c("doc_id") % 3 == 0, message).when(c("doc_id") % 3 == 1, "[1]").otherwise("{bad")
    parsed = R.parse_chat(load(spark, sf, "documents").select(c("doc_id").alias("line"), raw.alias("raw")))
    return parsed.select("line", "ok", F.coalesce(F.array_size("messages"), F.lit(0)).alias("n_messages"))


@query("src_02_meta", META + " SELECT gold_class, block, count(*) AS n, count(twin_of) AS twins FROM meta GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return load(spark, sf, "meta").groupBy("gold_class", "block").agg(F.count("*").alias("n"), F.count("twin_of").alias("twins"))


@query("src_02_sidecar", "SELECT (SELECT count(*) FROM documents) AS records, count(*) AS declared, (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS unmatched, 'fail' AS verdict, count(DISTINCT CASE WHEN doc_id % 3 > 0 THEN source END) AS accounts FROM documents WHERE doc_id % 10 > 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    at = f"{_folder(spark)}.jsonl"
    docs = load(spark, sf, "documents").orderBy("doc_id")
    turns = F.array(F.struct(F.lit("user").alias("role"), c("text").alias("content")))
    docs.select(F.to_json(F.struct(turns.alias("messages"))).alias("value")).write.text(at)  # sorted part files, one after the other
    rows = docs.where("doc_id % 10 > 0").select(F.to_json(F.struct((c("doc_id") + 1).alias("line"), F.when(c("doc_id") % 3 > 0, c("source")).alias("account_id"))).alias("value"))
    rows.write.text(at.replace(".jsonl", ".meta.jsonl"))
    _, side, aligned = R.read_with_sidecar(spark, at)
    return aligned.drop("sidecar").crossJoin(side.agg(F.countDistinct("account_id").alias("accounts")))


@query("src_03_normalize_pool", POOL + " SELECT class AS pool, CAST(id AS VARCHAR) AS id, class FROM pool WHERE id % 3 <> 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    row = F.struct(F.when(c("id") % 2 == 0, c("id").cast("string")).alias("row_id"), c("id").cast("string").alias("id"), "class")
    rows = F.array(row)
    doc = F.when(c("id") % 3 == 1, F.to_json(F.struct(rows.alias("rows")))).when(c("id") % 3 == 2, F.to_json(F.struct(rows.alias("action_pool"), F.array().cast("array<string>").alias("no_action_readchain_pool")))).otherwise("{}")
    return R.normalize_pool(load(spark, sf, "pool").select(c("class").alias("pool"), doc.alias("doc"))).select("pool", "id", "class")


@query("src_04_population", "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS id FROM customer")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.population_ids(load(spark, sf, "customer").select(F.when(c("c_custkey") % 2 == 0, F.concat(F.lit("a"), c("c_custkey").cast("string"))).alias("account_id"), c("c_custkey").alias("id")))


@query("src_05_recent_days", LEDGER + " SELECT event_id, dt FROM ledger WHERE dt IN (SELECT DISTINCT dt FROM ledger ORDER BY dt DESC LIMIT 5)")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.recent_days(load(spark, sf, "ledger"), 5).select("event_id", "dt")


@query("src_06_discover_nights", NIGHTS + " SELECT 'runs/' || night || s AS path, night, s AS variant, CASE s WHEN '-live' THEN 'live-shadow' WHEN '-retro' THEN 'retro-replay' ELSE 'shadow-replay' END AS mode FROM (SELECT DISTINCT night FROM nights) CROSS JOIN (VALUES ('-live'), ('-retro'), (''), ('-x')) v(s)")
def _(spark, sf):  # noqa: ANN001, ANN202
    suffix = F.explode(F.array(*map(F.lit, ["-live", "-retro", "", "-x", "_old"])))
    nights = load(spark, sf, "nights").select("night").distinct().withColumn("s", suffix)
    return R.discover_nights(nights.select(F.concat(F.lit("runs/"), c("night").cast("string"), c("s")).alias("path")))


@query("src_07_scrape_reports", "SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, '' AS hash, length(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g'))) AS chars FROM pages")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.scrape_reports(load(spark, sf, "pages"))


@query(
    "src_07_report_tables",
    """SELECT page_id, 1 AS "table", 2 AS row, 'Name' AS name, 'm' || page_id AS value FROM pages UNION ALL SELECT page_id, 1, 2, 'Loss & step', (page_id % 7) || ' x' FROM pages
UNION ALL SELECT page_id, 1, 3, 'Name', 'left' FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id, 2, 1, 'total', CAST(page_id AS VARCHAR) FROM pages""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    n = c("page_id").cast("string")
    roster = F.concat(F.lit('<table border="1"><tr><th scope=col>Name</th><th>Loss &amp; step</th></tr><tr><td>m'), n, F.lit("</td><td> <b>"), (c("page_id") % 7).cast("string"), F.lit("</b>\n x</td></tr>"))
    html = F.concat("html", roster, F.when(c("page_id") % 2 == 0, "<tr><td>left").otherwise(""), F.lit("</table><TABLE><tr><td>total<td>"), n, F.lit("</TABLE><script>'<table><tr><td>no</td>'</script>"))
    return R.report_tables(load(spark, sf, "pages").withColumn("html", html))


def _md(spark, sf):  # noqa: ANN001, ANN202
    n = c("doc_id").cast("string")
    body = F.concat(F.lit("# Notes\n| A | B |\n|---|---|\n| x"), n, F.lit(" | 1 |\n| y | "), n, F.lit(" |\nprose\n# Other\n| A | B |\n|---|---|\n| z | 2 |\n1. first\n2) second\n1. again"))
    return load(spark, sf, "documents").select(c("doc_id").alias("doc"), body.alias("text"))


@query("src_08_md_tables", "SELECT doc_id AS doc, 4 AS line, 'x' || doc_id AS a, '1' AS b FROM documents UNION ALL SELECT doc_id, 5, 'y', CAST(doc_id AS VARCHAR) FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.read_md_tables(_md(spark, sf), "Notes").select("doc", "line", c("cells")["a"].alias("a"), c("cells")["b"].alias("b"))


@query("src_08_equal_headers", "SELECT doc_id AS doc, 3 AS line, CAST(doc_id AS VARCHAR) AS a, '2' AS second, '3' AS third, 3 AS names FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    body = F.concat(F.lit("# T\n| A | a | A |\n| "), c("doc_id").cast("string"), F.lit(" | 2 | 3 |"))
    rows = R.read_md_tables(load(spark, sf, "documents").select(c("doc_id").alias("doc"), body.alias("text")), "T")
    return rows.select("doc", "line", c("cells")["a"].alias("a"), c("cells")["a#2"].alias("second"), c("cells")["a#3"].alias("third"), F.size("cells").alias("names"))


@query("src_09_lessons", "SELECT doc_id AS doc, 1 AS code, 'first || again' AS body FROM documents UNION ALL SELECT doc_id, 2, 'second' FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.parse_lessons(_md(spark, sf))


@query("src_09_register", "SELECT doc_id AS doc, doc_id % 5 + 1 AS code, 'late' AS body, CASE WHEN doc_id % 2 = 0 THEN 'minor' ELSE 'critical' END AS severity FROM documents UNION ALL SELECT doc_id, 9, 'lost || again', 'minor' FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    state = F.when(c("doc_id") % 2 == 0, "**Fixed in 2**").otherwise("open")
    body = F.concat(F.lit("# Errors\n| Code | Error | Status |\n|---|---|---|\n| E-"), (c("doc_id") % 5 + 1).cast("string"), F.lit(". | late | "), state, F.lit(" |\n| none | x | open |\n| 9 | lost | open |\n| **9** | again | Improved |"))
    return R.parse_register(load(spark, sf, "documents").select(c("doc_id").alias("doc"), body.alias("text")), "Errors")


@query("src_10_transcript_texts", "SELECT conv_id AS session, turn AS line, role, text FROM conversations")
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "conversations")
    one = F.to_json(F.struct(c("role").alias("type"), F.struct(c("text").alias("content")).alias("message")))
    many = F.to_json(F.struct(F.struct("role", F.array(F.struct(F.lit("text").alias("type"), "text")).alias("content")).alias("message")))
    raw = F.when(c("turn") % 2 == 0, one).otherwise(many)
    return R.transcript_blocks(rows.select(c("conv_id").alias("session"), c("turn").alias("line"), raw.alias("raw"))).select("session", "line", "role", "text")


@query("src_10_transcripts", "SELECT conv_id AS session, turn AS line, 0 AS pos, CASE WHEN turn % 2 = 0 THEN 'text' ELSE 'tool_use' END AS type FROM conversations UNION ALL SELECT conv_id, turn, 1, 'thinking' FROM conversations WHERE turn % 2 = 1")
def _(spark, sf):  # noqa: ANN001, ANN202
    plain = F.to_json(F.struct(F.struct(c("text").alias("content")).alias("message")))
    block = lambda kind: F.struct(F.lit(kind).alias("type"), F.lit("b").alias("text"))
    blocks = F.to_json(F.struct(F.struct(F.array(block("tool_use"), block("thinking")).alias("content")).alias("message")))
    rows = load(spark, sf, "conversations").select(c("conv_id").alias("session"), c("turn").alias("line"), F.when(c("turn") % 2 == 0, plain).otherwise(blocks).alias("raw"))
    return R.transcript_blocks(rows).select("session", "line", "pos", "type")


@query("src_11_loss_curve", "SELECT user_id AS run, event_id AS step, CASE WHEN e THEN value ELSE value * 2 END AS loss, CASE WHEN e THEN 'eval' ELSE 'train' END AS label FROM (SELECT *, bool_or(event_type = 'purchase') OVER (PARTITION BY user_id) AS e FROM events) WHERE NOT e OR event_type = 'purchase'")
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "events").select(c("user_id").alias("run"), c("event_id").alias("step"), (c("value") * 2).alias("train_loss"), F.when(c("event_type") == "purchase", c("value")).alias("eval_loss"))
    return R.loss_curve(rows)


@query(
    "src_11_metrics",
    """SELECT user_id AS run, CASE WHEN event_id % 7 > 1 THEN event_id END AS step, CASE WHEN event_id % 7 > 2 THEN value END AS train_loss, CASE WHEN event_id % 7 = 2 THEN value * 2 END AS eval_loss, event_id % 7 < 2 AS skipped FROM events""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    k, e, v = c("event_id") % 7, c("event_id").cast("string"), c("value").cast("string")
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    raw = (
        F.when(k == 0, "step 12 done").when(k == 1, line('{"step": "', e, '", "loss": ', v, "}"))
        .when(k == 2, line('{"global_step": ', e, ', "eval/loss": ', (c("value") * 2).cast("string"), "}"))
        .when(k == 3, line('{"step": null, "steps": ', e, '.0, "train/loss": ', v, "}"))
        .when(k == 4, line('{"epoch": ', e, ', "loss": true, "training_loss": ', v, "}"))
        .otherwise(line('{"step": ', e, ', "loss": ', v, ', "lr": 0.1}'))
    )
    return R.parse_metrics(load(spark, sf, "events").select(c("user_id").alias("run"), raw.alias("raw")))


@query("src_12_org_configs", "SELECT n_name AS slug, CAST(CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE n_nationkey // 2 END AS VARCHAR) AS org_id, CASE WHEN n_nationkey % 6 = 0 THEN 'missing_field' WHEN count(*) OVER (PARTITION BY CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE n_nationkey // 2 END) > 1 THEN 'shared_org' END AS fault FROM nation")
def _(spark, sf):  # noqa: ANN001, ANN202
    n = load(spark, sf, "nation").select(c("n_name").alias("slug"), F.when(c("n_nationkey") % 6 != 0, F.floor(c("n_nationkey") / 2).cast("string")).alias("org_id"), c("n_name").alias("name"))
    return R.build_org_configs(n.unionByName(n.withColumn("slug", F.concat(F.lit("_"), c("slug"))).withColumn("org_id", F.lit("x")))).select("slug", "org_id", "fault")


@query("src_13_spec_rows", "SELECT p_partkey, p_partkey IS NOT NULL AS complete FROM part")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.build_spec_rows(load(spark, sf, "part"), ["p_partkey"]).where(F.length("body") > 2).select("p_partkey", "complete")


@query("src_14_recent_window", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 5 DAY ORDER BY ts DESC, event_id LIMIT 4000")
def _(spark, sf):  # noqa: ANN001, ANN202
    return R.recent_window(load(spark, sf, "events"), "ts", "2024-01-20 00:00:00", 5, 4000).select("event_id", "ts")


# --- events, flows, artifacts ----------------------------------------------------------------------------------------

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'passed' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'blocked' ELSE 'pending' END END"


@query("evt_01_stage_events", f"WITH o AS (SELECT o_orderkey AS id, {_STATUS} AS s, o_orderkey % 3 = 0 AS free FROM orders) SELECT id, 'started' AS kind FROM o WHERE s <> 'blocked' UNION ALL SELECT id, s FROM o WHERE s IN ('passed', 'failed') UNION ALL SELECT id, 'cost' FROM o WHERE s IN ('passed', 'failed') AND NOT free")
def _(spark, sf):  # noqa: ANN001, ANN202
    return E.stage_events(load(spark, sf, "orders").select(c("o_orderkey").alias("id"), F.expr(_STATUS).alias("status"), F.when(c("o_orderkey") % 3 != 0, c("o_totalprice")).alias("cost"))).select("id", "kind")


@query("evt_02_finding_events", "SELECT CASE WHEN o_orderstatus = 'F' THEN 'finding.fail' WHEN o_orderstatus = 'O' THEN 'finding.info' ELSE 'finding.suspect' END AS kind, o_orderpriority AS severity, count(*) AS n, count(DISTINCT o_orderkey) AS ids FROM orders GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    v = F.when(c("o_orderstatus") == "F", "fail").when(c("o_orderstatus") == "O", "info").otherwise("suspect")
    rows = E.finding_events(load(spark, sf, "orders").select(c("o_orderkey").alias("id"), v.alias("verdict"), c("o_orderpriority").alias("severity"), c("o_orderdate").alias("ts")))
    return rows.groupBy("kind", "severity").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


_ID = "(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode({})) AS h))"


@query("evt_02_finding_ids", f"SELECT {_ID.format("'finding|' || o_orderkey")} AS event_id, CASE WHEN o_orderstatus = 'F' THEN 'finding.fail' WHEN o_orderstatus = 'O' THEN 'finding.info' ELSE 'finding.suspect' END AS kind FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    v = F.when(c("o_orderstatus") == "F", "fail").when(c("o_orderstatus") == "O", "info").otherwise("suspect")
    return E.finding_events(load(spark, sf, "orders").select(c("o_orderkey").alias("id"), v.alias("verdict"), c("o_orderpriority").alias("severity"), c("o_orderdate").alias("ts"))).select("event_id", "kind")


@query(
    "evt_03_night_previews",
    NIGHTS
    + """, a AS (SELECT night, arm, count(DISTINCT account_id) AS c, count(*) AS n, count(*) FILTER (is_error) AS e FROM nights WHERE day(night) % 4 <> 0 AND (arm <> 'v5' OR day(night) % 3 > 0) GROUP BY ALL), r AS (SELECT DISTINCT night FROM nights)
SELECT CAST(r.night AS VARCHAR) AS night, x.arm, CASE WHEN x.arm IS NULL THEN 'roster_only' ELSE 'night_result' END AS kind, CASE WHEN x.arm IS NULL THEN 'roster only' ELSE x.arm || ': ' || x.n || ' records, ' || x.e || ' errors' END AS headline,
'{"challenger":"' || x.arm || CASE WHEN i.arm IS NULL THEN '' ELSE '","incumbent":"v5' END || '","accounts_compared":' || x.c || ',"records":' || x.n || ',"errors":' || x.e || CASE WHEN i.arm IS NULL THEN '' ELSE ',"incumbent_records":' || i.n || ',"incumbent_errors":' || i.e END || '}' AS preview
FROM r LEFT JOIN a x ON x.night = r.night AND x.arm <> 'v5' LEFT JOIN a i ON i.night = x.night AND i.arm = 'v5'""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    n = load(spark, sf, "nights")
    of = n.where((F.day("night") % 4 != 0) & ((c("arm") != "v5") | (F.day("night") % 3 > 0))).groupBy("night", "arm").agg(F.countDistinct("account_id").alias("accounts"), F.count("*").alias("records"), F.count_if("is_error").alias("errors"))
    return E.night_previews(of, n, "v5").withColumn("night", c("night").cast("string"))


@query("evt_03_night_events", NIGHTS + ", r AS (SELECT DISTINCT night FROM nights), a AS (SELECT night, arm, count(*) AS n, count(*) FILTER (is_error) AS e FROM nights WHERE day(night) % 4 <> 0 GROUP BY ALL) SELECT r.night, arm, CASE WHEN arm IS NULL THEN 'roster only' ELSE arm || ': ' || n || ' records, ' || e || ' errors' END AS headline FROM r LEFT JOIN a ON a.night = r.night")
def _(spark, sf):  # noqa: ANN001, ANN202
    n = load(spark, sf, "nights")
    of = n.where(F.day("night") % 4 != 0).groupBy("night", "arm").agg(F.count("*").alias("records"), F.count_if("is_error").alias("errors"))
    return E.night_events(of, n.select("night").distinct())


@query("evt_04_promote_nights", NIGHTS + " SELECT night, arm, event_id, mode = 'retro-replay' AS historical, mode <> 'retro-replay' AND emitted AS promotable FROM nights")
def _(spark, sf):  # noqa: ANN001, ANN202
    return E.promote_nights(load(spark, sf, "nights"), ["night", "arm", "event_id"])


_STATE = "CASE status WHEN 'working' THEN 'running' WHEN 'blocked' THEN 'blocked' WHEN 'done' THEN 'finished' WHEN 'starting' THEN 'starting' ELSE 'unknown' END"


@query("evt_05_cloud_agent_rows", BEATS + f" SELECT session_id, event_id, {_STATE} AS state, 'seq ' || seq || ' ' || {_STATE} AS summary FROM beats")
def _(spark, sf):  # noqa: ANN001, ANN202
    return E.cloud_agent_rows(load(spark, sf, "beats"))


@query(
    "evt_05_fleet_rows",
    """WITH r AS (SELECT user_id, arg_max({'e': event_type, 'k': event_id}, (event_id)) AS x FROM events GROUP BY user_id), s AS (SELECT user_id, x.k AS k, CASE x.e WHEN 'view' THEN 'ACTIVE' WHEN 'click' THEN 'BLOCKED' WHEN 'purchase' THEN 'DONE' ELSE 'ODD' END AS s FROM r)
SELECT 's' || user_id AS session_id, CASE WHEN s IN ('ACTIVE', 'BLOCKED') THEN 'active' WHEN s = 'DONE' THEN 'ended' ELSE 'stale' END AS status, CASE WHEN s = 'BLOCKED' AND k % 2 = 0 THEN 'needs-decision' END AS blocker, lower(s) || CASE WHEN s = 'BLOCKED' AND k % 2 = 0 THEN ' · needs-decision' ELSE '' END || CASE WHEN k % 3 > 0 THEN ' · task ' || k ELSE '' END AS summary FROM s""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    k, e = c("event_id"), c("event_type")
    status = F.when(e == "view", "ACTIVE").when(e == "click", "BLOCKED").when(e == "purchase", "DONE").otherwise("ODD")
    beats = load(spark, sf, "events").select(F.concat(F.lit("s"), c("user_id").cast("string")).alias("session_id"), k.alias("seq"), "ts", status.alias("status"), F.when(k % 2 == 0, "needs-decision").otherwise("needs-coffee").alias("blocker"), F.when(k % 3 > 0, F.concat(F.lit(" task\n"), k.cast("string"))).otherwise(" ").alias("task"))
    return E.fleet_rows(beats).drop("last_seen_at")


@query("evt_06_session_agents", LEDGER + ", s AS (SELECT session_id, count(*) AS n, count(DISTINCT tool) AS t, arg_max(tool, (ts, event_id)) AS x FROM ledger WHERE CAST(session_id AS INTEGER) % 5 > 0 GROUP BY ALL) SELECT a.session_id, CASE WHEN CAST(a.session_id AS INTEGER) % 3 <> 0 THEN 'r' || a.session_id END AS run_id, coalesce(n, 0) AS rows, coalesce(t, 0) AS tools, CASE WHEN x IS NULL THEN 'stale' WHEN x = 'other' THEN 'ended' ELSE 'active' END AS status FROM (SELECT DISTINCT session_id FROM ledger) a LEFT JOIN s ON s.session_id = a.session_id")
def _(spark, sf):  # noqa: ANN001, ANN202
    ledger = load(spark, sf, "ledger")
    sessions = ledger.select("session_id").distinct().withColumn("run_id", F.when(c("session_id").cast("int") % 3 != 0, F.concat(F.lit("r"), c("session_id"))))
    rows = ledger.where("cast(session_id as int) % 5 > 0").withColumn("tool", F.when(c("tool") == "other", "end").otherwise(c("tool")))
    return E.session_agents(sessions, rows).drop("spawned_at", "last_seen_at")


@query("evt_07_dispatch_events", f"SELECT {_ID.format("'agent_dispatched|' || event_id")} AS event_id, 'agent_dispatched' AS kind, 'dispatch ' || CASE event_type WHEN 'view' THEN 'stopped' WHEN 'error' THEN 'failed' ELSE 'finished' END AS headline, CASE WHEN event_id % 7 = 0 THEN '{{}}' WHEN event_id % 3 = 0 THEN '{{\"verdict\":\"' || event_type || '\"}}' ELSE '{{\"cost_usd\":' || (event_id % 10) || '.25,\"verdict\":\"' || event_type || '\"}}' END AS detail FROM events")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("event_id")
    o = F.when(c("event_type") == "view", "stopped").when(c("event_type") == "error", "error").otherwise("ok")
    body = F.to_json(F.struct(F.when(k % 3 > 0, k % 10 + 0.25).alias("cost_usd"), c("event_type").alias("verdict"), F.lit("x").alias("prompt_file"), F.lit(None).cast("string").alias("usage")), {"ignoreNullFields": "false"})
    return E.dispatch_events(load(spark, sf, "events").select(k.alias("id"), o.alias("outcome"), "ts", F.when(k % 7 == 0, "oops").otherwise(body).alias("detail"))).drop("ts")


@query("evt_06_project_agents", LEDGER + ", s AS (SELECT session_id, min(ts) AS a, max(ts) AS b FROM ledger GROUP BY ALL) SELECT session_id, 'r' || session_id AS run_id, 'spawned' AS kind, a AS ts FROM s WHERE CAST(session_id AS INTEGER) % 3 <> 0 UNION ALL SELECT session_id, 'r' || session_id, 'finished', b FROM s WHERE CAST(session_id AS INTEGER) % 3 <> 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    ledger = load(spark, sf, "ledger")
    sessions = ledger.select("session_id").distinct().withColumn("run_id", F.when(c("session_id").cast("int") % 3 != 0, F.concat(F.lit("r"), c("session_id"))))
    return E.project_agents(sessions, ledger)


@query("evt_07_dispatch_rows", "SELECT event_id AS id, CASE event_type WHEN 'view' THEN 'stopped' WHEN 'error' THEN 'failed' ELSE 'finished' END AS state, CASE WHEN event_id % 3 <> 0 THEN round_even(CAST(event_id % 100 AS DOUBLE) / 8, 2) END AS cost FROM events")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = F.when(c("event_type") == "view", "stopped").when(c("event_type") == "error", "error").otherwise("ok")
    return E.dispatch_rows(load(spark, sf, "events").select(c("event_id").alias("id"), o.alias("outcome"), F.when(c("event_id") % 3 != 0, c("event_id") % 100 / 8).alias("cost")))


@query("evt_08_project_swarm", COST + " SELECT DISTINCT 'agent' AS family, CAST(role_id AS VARCHAR) AS key FROM swarm_cost UNION ALL SELECT 'event', CAST(attempt_id AS VARCHAR) FROM swarm_cost UNION ALL SELECT 'handoff', CAST(attempt_id AS VARCHAR) FROM swarm_cost WHERE corrected_usd IS NOT NULL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return E.project_swarm(load(spark, sf, "swarm_cost"))


@query("evt_09_iteration_digest", "WITH p AS (SELECT o_custkey AS run, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderpriority = '1-URGENT') AS a, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderpriority = '2-HIGH') AS b FROM orders GROUP BY ALL) SELECT run, a AS s1, coalesce(b, a) AS s2 FROM p")
def _(spark, sf):  # noqa: ANN001, ANN202
    r = load(spark, sf, "orders").select(c("o_custkey").alias("run"), c("o_orderpriority").alias("stage"), c("o_orderstatus").alias("value"), F.struct("o_orderdate", "o_orderkey").alias("ts"))
    return E.iteration_digest(r, ["1-URGENT", "2-HIGH"])


@query(
    "evt_09_nested_digest",
    """WITH r AS (SELECT o_custkey AS run, o_orderpriority AS stage, (o_orderdate, o_orderkey) AS ts, o_orderkey AS k, o_orderstatus AS s FROM orders)
SELECT run, arg_max(CASE WHEN k % 3 = 0 THEN s ELSE 'm' || k END, ts) FILTER (stage = '1-URGENT' AND k % 5 > 0) AS model, arg_max(k * 2, ts) FILTER (stage = '2-HIGH' AND k % 5 > 0) AS records, count(*) FILTER (k % 5 = 0) AS unreadable FROM r GROUP BY run""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    body = F.when(k % 5 == 0, "[1]").when(k % 3 == 0, F.to_json(F.struct(F.struct(F.lit("").alias("id")).alias("model"), c("o_orderstatus").alias("model_id"), F.struct(F.struct((k * 2).alias("records")).alias("counts")).alias("build"))))
    body = body.otherwise(F.to_json(F.struct(F.struct(F.concat(F.lit("m"), k.cast("string")).alias("id")).alias("model"), (k * 2).alias("n"))))
    reports = load(spark, sf, "orders").select(c("o_custkey").alias("run"), c("o_orderpriority").alias("stage"), F.struct("o_orderdate", "o_orderkey").alias("ts"), body.alias("body"))
    return E.nested_digest(reports, {"model": ("1-URGENT", ["$.model.id", "$.model_id"], "string"), "records": ("2-HIGH", ["$.build.counts.records", "$.n"], "long")})


@query("flw_01_spawn_edges", "SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 'w' || doc_id ELSE 'review' END AS to_key, CASE WHEN doc_id % 4 = 0 THEN 'high' ELSE 'medium' END AS confidence FROM documents WHERE doc_id % 4 < 2")
def _(spark, sf):  # noqa: ANN001, ANN202
    t = F.when(c("doc_id") % 4 == 0, F.concat(F.lit("Dispatches: w"), c("doc_id").cast("string"), F.lit(" for review"))).when(c("doc_id") % 4 == 1, "Work for review").otherwise("none")
    return E.spawn_edges(load(spark, sf, "documents").select(c("doc_id").alias("id"), t.alias("text")))


@query("flw_02_artifact_edges", "SELECT 'ARTIFACT' AS edge_type, doc_id AS id, unnest(['a' || (doc_id % 5), 'b.md']) AS to_key FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    t = F.concat(F.lit("# x\nconsumes: a"), (c("doc_id") % 5).cast("string"), F.lit(", b.md\nend"))
    return E.header_edges(load(spark, sf, "documents").select(c("doc_id").alias("id"), t.alias("text")), "consumes", "ARTIFACT")


@query("flw_03_addendum_edges", "SELECT 'ADDENDUM' AS edge_type, doc_id AS id, 'd' || (doc_id - 1) AS to_key FROM documents WHERE doc_id % 6 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    t = F.when(c("doc_id") % 6 == 0, F.concat(F.lit("Corrects: d"), (c("doc_id") - 1).cast("string"))).otherwise("plain corrects: x")
    return E.header_edges(load(spark, sf, "documents").select(c("doc_id").alias("id"), t.alias("text")), "corrects", "ADDENDUM")


@query("flw_04_handoff_edges", "SELECT doc_id AS id, source AS author, CASE WHEN doc_id % 3 = 0 THEN 'r' || doc_id ELSE 'successor:' || doc_id END AS to_key FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    d = load(spark, sf, "documents").select(c("doc_id").alias("id"), c("source").alias("author"))
    return E.handoff_edges(d, d.where("id % 3 = 0").select("id", F.concat(F.lit("r"), c("id").cast("string")).alias("reader")))


@query(
    "flw_05_table_edges",
    """SELECT 'GATE' AS edge_type, CAST(user_id AS VARCHAR) AS from_key, CASE WHEN event_id % 3 = 0 THEN 'human' ELSE 'u' || (user_id + 1) END AS to_key, event_id AS ref FROM events WHERE event_type = 'view'
UNION ALL SELECT 'STEER', CAST(user_id + event_id % 2 AS VARCHAR), CAST(user_id AS VARCHAR), event_id FROM events WHERE event_type = 'click' AND event_id % 2 = 1
UNION ALL SELECT 'PROJECTION', CAST(user_id AS VARCHAR), event_type, min(event_id) FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY user_id, event_type""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").withColumnsRenamed({"user_id": "run_id", "event_id": "id"})
    gates = e.where("event_type = 'view'").withColumn("approver", F.when(c("id") % 3 != 0, F.concat(F.lit("u"), (c("run_id") + 1).cast("string"))))
    steers = e.where("event_type = 'click'").withColumn("author", c("run_id") + c("id") % 2)
    return E.table_edges(gates, steers, e.where("event_type not in ('view', 'click')").withColumn("target", c("event_type")))


@query("flw_01_report_edges", "SELECT 'REPORT' AS edge_type, 's' || c_custkey AS from_key, 'p' || (c_custkey % 10) AS to_key FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 7 > 1 UNION ALL SELECT 'UNCLAIMED', 's' || c_custkey, NULL FROM customer WHERE c_custkey % 7 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("c_custkey")
    name = lambda p, n: F.concat(F.lit(p), n.cast("string"))
    of = load(spark, sf, "customer")
    sessions = of.select(name("s", k).alias("session"), F.when(k % 2 == 0, "done").otherwise("live").alias("state"))
    records = of.where(k % 7 != 0).select(name("s", k).alias("child"), F.explode(F.when(k % 7 == 1, F.array(F.lit("p0"), F.lit("x"))).otherwise(F.array(name("p", k % 10)))).alias("parent"))
    free = E.unclaimed_sessions(sessions, records).select(F.lit("UNCLAIMED").alias("edge_type"), c("session").alias("from_key"), F.lit(None).cast("string").alias("to_key"))
    return E.report_edges(sessions, records).unionByName(free)


@query(
    "flw_02_ledger_and_owner_edges",
    LEDGER
    + """, w AS (SELECT * FROM ledger WHERE ok AND tool = 'write'), f AS (SELECT r.path, r.session_id AS reader, (SELECT arg_max(w.session_id, (w.ts, w.event_id)) FROM w WHERE w.path = r.path AND (w.ts < r.ts OR (w.ts = r.ts AND w.event_id < r.event_id))) AS writer FROM ledger r WHERE ok AND tool = 'read')
SELECT DISTINCT writer AS from_key, reader AS to_key, path, 'ledger' AS basis FROM f WHERE writer <> reader UNION ALL SELECT DISTINCT 'o' || (doc_id % 9), source, 'a' || (doc_id % 9), 'header' FROM documents WHERE doc_id % 9 <> 4""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("doc_id")
    docs = load(spark, sf, "documents").select(k.alias("id"), c("source").alias("reader"), F.concat(F.lit("Consumes: a"), (k % 9).cast("string"), F.lit(", nowhere.md\n"), F.col("text")).alias("text"))
    owners = spark.range(9).select(F.concat(F.lit("a"), c("id").cast("string")).alias("path"), F.explode(F.when(c("id") == 4, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array(F.concat(F.lit("o"), c("id").cast("string"))))).alias("owner"))
    return E.artifact_edges(load(spark, sf, "ledger"), docs, owners)


@query("flw_03_addendum_by_heading", "SELECT 'ADDENDUM' AS edge_type, doc_id AS id, CASE WHEN doc_id % 6 = 0 THEN 'd' || (doc_id - 1) ELSE source END AS to_key, CASE WHEN doc_id % 6 = 0 THEN 'high' ELSE 'medium' END AS confidence FROM documents WHERE doc_id % 6 < 2")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("doc_id")
    other = F.concat(F.lit("## Addendum to DOC-"), c("source"))
    t = F.when(k % 6 == 0, F.concat(F.lit("corrects: d"), (k - 1).cast("string"), F.lit("\n"), other)).when(k % 6 == 1, other).when(k % 6 == 2, F.concat(other, F.lit(" and doc-x"))).otherwise(F.concat(F.lit("# Notes on doc-"), c("source")))
    return E.addendum_edges(load(spark, sf, "documents").select(k.alias("id"), F.concat(t, F.lit("\n"), F.regexp_replace("text", "#", "")).alias("text")))


@query("flw_06_project_edges", "SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'unsupported' WHEN event_type = 'view' THEN 'handoff' ELSE 'event' END AS family FROM events")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").select("event_id", F.when(c("event_type") == "view", "HANDOFF").otherwise("GATE").alias("edge_type"), F.when(c("user_id") % 5 != 0, c("user_id")).alias("run_id"))
    return E.project_edges(e).select("event_id", "family")


@query("art_01_agent_artifacts", "WITH p AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS p, arg_max(text, turn) FILTER (role = 'assistant') AS o FROM conversations GROUP BY ALL) SELECT conv_id, 'prompt' AS kind, p AS content, CASE WHEN p IS NULL THEN 'not_recorded' END AS reason FROM p UNION ALL SELECT conv_id, 'output', o, CASE WHEN o IS NULL THEN 'not_recorded' END FROM p UNION ALL SELECT conv_id, k, NULL, 'not_recorded' FROM p CROSS JOIN (VALUES ('tool_calls'), ('thinking')) v(k)")
def _(spark, sf):  # noqa: ANN001, ANN202
    return E.agent_artifacts(load(spark, sf, "conversations"))


@query(
    "art_01_transcript_artifacts",
    """WITH p AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS prompt, arg_max(text, turn) FILTER (role = 'assistant') AS output, string_agg('tool' || turn, chr(10) ORDER BY turn) FILTER (role = 'assistant') AS tool_calls, string_agg('mull ' || text, chr(10) ORDER BY turn) FILTER (role = 'assistant') AS thinking FROM conversations GROUP BY conv_id),
k AS (SELECT conv_id, unnest(['prompt', 'output', 'tool_calls', 'thinking']) AS kind, unnest([prompt, output, tool_calls, thinking]) AS content FROM p)
SELECT conv_id, kind, CASE WHEN conv_id % 10 <> 0 THEN content END AS content, CASE WHEN conv_id % 10 = 0 THEN 'excluded_by_policy' WHEN content IS NULL THEN 'not_recorded' END AS reason FROM k""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "conversations")
    block = lambda kind, text, name: F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), name.cast("string").alias("name"))
    both = F.array(block("thinking", F.concat(F.lit("mull "), c("text")), F.lit(None)), block("tool_use", F.lit(None), F.concat(F.lit("tool"), c("turn").cast("string"))), block("text", c("text"), F.lit(None)))
    raw = F.when(c("role") == "assistant", F.to_json(F.struct(F.struct("role", both.alias("content")).alias("message")))).otherwise(F.to_json(F.struct(c("role").alias("type"), F.struct(c("text").alias("content")).alias("message"))))
    blocks = R.transcript_blocks(rows.select(c("conv_id").alias("session"), c("turn").alias("line"), raw.alias("raw"))).withColumnRenamed("session", "conv_id")
    return E.agent_artifacts(rows.where("conv_id % 3 > 0 or role = 'user'"), blocks, rows.where("conv_id % 10 = 0"))


@query("val_03_challengers", "SELECT o_orderkey AS id, 'no_challenger' AS code FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 4 > 0 UNION ALL SELECT -1 - o_orderkey, 'ratio' FROM orders WHERE 1 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    base = load(spark, sf, "orders").select(k.alias("id"), F.lit(1).alias("numerator"), F.lit(2).alias("denominator"), F.lit(False).alias("blocking"), F.lit("opinion").alias("basis"), (c("o_orderstatus") == "O").alias("load_bearing"), F.lit("m1").alias("method"), F.lit(None).cast(dict(load(spark, sf, "orders").dtypes)["o_orderkey"]).alias("challenges"))
    rivals = base.where("load_bearing and id % 4 < 2").select((-1 - c("id")).alias("id"), F.lit(0).alias("numerator"), "denominator", "blocking", "basis", F.lit(False).alias("load_bearing"), F.when(c("id") % 4 == 0, "m2").otherwise("m1").alias("method"), c("id").alias("challenges"))
    return E.validate_claims(base.unionByName(rivals))


@query("val_04_costs", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'known_and_accepted' WHEN 1 THEN 'negative_cost' ELSE 'zero_without_evidence' END AS code FROM events WHERE event_id % 5 < 3")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("event_id") % 5
    cost = F.struct(F.when(k == 1, -1.0).when(k == 2, 0.0).when(k == 3, 0.0).when(k == 0, 2.0).alias("value_usd"), (k.isin(0, 4)).alias("accepted_unknown"), F.when(k == 3, "log").alias("evidence"))
    return E.validate_swarm_events(load(spark, sf, "events").select("event_id", F.lit("attempt").alias("category"), F.to_json(F.struct(cost.alias("cost"))).alias("data")), {"attempt": ["cost"]})


@query("val_03_validate_claims", "SELECT o_orderkey AS id, 'ratio' AS code FROM orders WHERE o_custkey > o_orderkey UNION ALL SELECT o_orderkey, 'block_basis' FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    basis = F.when(c("o_orderkey") % 2 == 0, "opinion").otherwise("deterministic")
    return E.validate_claims(load(spark, sf, "orders").select(c("o_orderkey").alias("id"), c("o_custkey").alias("numerator"), c("o_orderkey").alias("denominator"), (c("o_orderstatus") == "F").alias("blocking"), basis.alias("basis")))


@query("val_04_validate_swarm_events", "SELECT event_id, CASE WHEN event_type NOT IN ('view', 'click') THEN 'unknown_category' WHEN event_id % 13 = 0 THEN 'unreadable' ELSE 'missing_field' END AS code FROM events WHERE event_type <> 'view' OR event_id % 13 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    data = F.when(c("event_id") % 13 == 0, "{bad").otherwise(c("props"))
    return E.validate_swarm_events(load(spark, sf, "events").select("event_id", c("event_type").alias("category"), data.alias("data")), {"view": ["k"], "click": ["k", "cost"]})


@query("val_05_shadow_window", NIGHTS + ", d AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-01-15', INTERVAL 1 DAY)) AS DATE) AS night), r AS (SELECT night, avg(CAST(is_error AS INTEGER)) AS r FROM nights WHERE day(night) <> 7 GROUP BY ALL) SELECT count(*) AS nights, count(*) FILTER (r IS NULL) AS missing, round_even(sum(coalesce(r, 0)) / count(*), 4) AS rate, CASE WHEN count(*) FILTER (r IS NULL) > 0 THEN 'suspect' WHEN sum(coalesce(r, 0)) / count(*) > 0.5 THEN 'fail' ELSE 'pass' END AS verdict FROM d LEFT JOIN r ON r.night = d.night")
def _(spark, sf):  # noqa: ANN001, ANN202
    return E.shadow_window_check(load(spark, sf, "nights").where(F.day("night") != 7), "2024-01-01", "2024-01-14", 0.5)


# --- batch twins of the streaming jobs --------------------------------------------------------------------------------


@query("str_01_liveness", BEATS + ", b AS (SELECT session_id, arg_max({'s': status, 't': ts}, ((ts IS NOT NULL), coalesce(ts, TIMESTAMP '1970-01-01'), event_id)) AS x FROM beats GROUP BY ALL) SELECT session_id, x.s AS status, x.t IS NULL OR epoch(TIMESTAMP '2024-01-10 00:00:00') - epoch(date_trunc('second', x.t)) > 900 AS stale FROM b")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.liveness(load(spark, sf, "beats"), "2024-01-10 00:00:00", 15)


_LEGAL = "(p = 'starting' AND status IN ('working', 'blocked', 'done')) OR (p = 'working' AND status IN ('blocked', 'done')) OR (p = 'blocked' AND status IN ('working', 'done')) OR p = status"


@query("str_02_attempt_transitions", BEATS + f", k AS (SELECT *, lag(status) OVER (PARTITION BY session_id ORDER BY seq) AS p FROM beats WHERE status <> 'paused') SELECT session_id, seq, p AS prev, status FROM k WHERE p IS NOT NULL AND NOT ({_LEGAL})")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.attempt_transitions(load(spark, sf, "beats"))


@query("str_03_lease_breaks", BEATS + ", k AS (SELECT session_id, seq, ts, lag(ts) OVER w AS p, lag(seq) OVER w AS q FROM beats WHERE event_id % 7 <> 0 WINDOW w AS (PARTITION BY session_id ORDER BY seq)), f AS (SELECT session_id, seq, CASE WHEN ts IS NULL THEN 'no_time' WHEN q + 1 <> seq THEN 'sequence' WHEN epoch(date_trunc('second', ts)) - epoch(date_trunc('second', p)) > 1800 THEN 'late' END AS f FROM k) SELECT session_id, arg_min(f, seq) FILTER (f IS NOT NULL) AS fault, CAST(min(seq) FILTER (f IS NOT NULL) AS VARCHAR) AS seq FROM f GROUP BY session_id")
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.operators.selection import lease_chain

    return lease_chain(load(spark, sf, "beats").where("event_id % 7 <> 0"))


@query("win_10_lease_lengths", BEATS + ", k AS (SELECT *, lag(ts) OVER w AS p, lag(seq) OVER w AS q, lead(seq) OVER w IS NULL AS z FROM beats WINDOW w AS (PARTITION BY session_id ORDER BY seq)), f AS (SELECT session_id, seq, CASE WHEN ts IS NULL THEN 'no_time' WHEN epoch(date_trunc('second', ts)) - epoch(date_trunc('second', p)) > 3000000 THEN 'late' WHEN event_id % 11 = 0 THEN 'length' WHEN ts <= p THEN 'early' WHEN z AND epoch(TIMESTAMP '2024-06-01 00:00:00') - epoch(date_trunc('second', ts)) >= 3000000 THEN 'expired' END AS f FROM k) SELECT session_id, arg_min(f, seq) FILTER (f IS NOT NULL) AS fault, CAST(min(seq) FILTER (f IS NOT NULL) AS VARCHAR) AS seq FROM f GROUP BY session_id")
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.operators.selection import lease_chain

    late = F.when(c("event_id") % 11 == 0, F.expr("ts + interval 1 hour")).otherwise(F.expr("ts + interval 3000000 seconds"))
    return lease_chain(load(spark, sf, "beats").withColumn("expires_at", late), 3_000_000, "2024-06-01 00:00:00")


@query("str_04_dedupe_events", "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'a' ELSE event_type END AS body, event_id % 10 = 0 AND event_type <> 'a' AS collision FROM events")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").select("event_id", c("event_type").alias("body"), "ts")
    again = e.withColumn("body", F.when(c("event_id") % 10 == 0, "a").otherwise(c("body")))
    return J.dedupe_events(e.unionByName(again))


@query("str_04_append_new", "SELECT 'new' AS family, event_id, event_type AS body FROM events WHERE event_id % 3 > 0 UNION ALL SELECT 'collision', event_id, event_type || '!' FROM events WHERE event_id % 10 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").select("event_id", c("event_type").alias("body"), "ts")
    batch = e.unionByName(e.where("event_id % 10 = 0").select("event_id", F.concat("body", F.lit("!")).alias("body"), (c("ts") + F.expr("interval 1 second")).alias("ts")))
    new, other = J.append_new(batch, e.where("event_id % 3 = 0"))
    return new.select(F.lit("new").alias("family"), "event_id", "body").unionByName(other.select(F.lit("collision").alias("family"), "event_id", "body"))


def _fed(spark, batches, sink, path):  # noqa: ANN001, ANN202
    """The table that a ``foreachBatch`` sink writes from some batches, the last one fed twice as after a restart."""
    for i, batch in [*enumerate(batches), (len(batches) - 1, batches[-1])]:
        sink(batch, i)
    return SnapshotTable(spark, path).read()


def _folder(spark) -> str:  # noqa: ANN001
    return f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"


@query("str_06_timeline_sink", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'closed' ELSE o_orderstatus END AS status FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("status"))
    path = _folder(spark)
    return _fed(spark, [o.where("id % 2 = 0"), o, o.where("id % 3 = 0").withColumn("status", F.lit("closed"))], J.upsert_sink(path, ["id"]), path)


@query("str_07_finding_sink", "WITH f AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 4 = 0) SELECT CAST(k AS VARCHAR) AS id, CASE WHEN k % 8 = 0 THEN 'resolved' ELSE 'open' END AS status FROM f")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").where("o_orderkey % 4 = 0").select(c("o_orderkey").alias("id"), F.lit("audit").alias("check"))
    path = _folder(spark)
    rows = _fed(spark, [o, o.where("id % 8 <> 0")], J.finding_sink(path), path)
    return rows.groupBy("id").agg(F.max_by("status", "batch").alias("status"))


@query("str_04_collision_sink", "SELECT 'kept' AS family, event_id, event_type AS body FROM events UNION ALL SELECT 'collision', event_id, event_type || '!' FROM events WHERE event_id % 10 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").select("event_id", c("event_type").alias("body"), "ts")
    other = e.where("event_id % 10 = 0").select("event_id", F.concat("body", F.lit("!")).alias("body"), "ts")
    kept, clash = _folder(spark), _folder(spark)
    first = _fed(spark, [e.where("event_id % 4 = 0"), e.unionByName(e), other], J.collision_sink(kept, clash), kept)
    both = SnapshotTable(spark, clash).read()
    return first.select(F.lit("kept").alias("family"), "event_id", "body").unionByName(both.select(F.lit("collision").alias("family"), "event_id", "body"))


@query("str_05_activity_windows", "SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.activity_windows(load(spark, sf, "events"), "1 day")


@query("str_05_session_windows", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.session_windows(load(spark, sf, "events"), "6 hours")


@query("str_08_night_aggregates", "SELECT CAST(ts AS DATE) AS night, CASE user_id % 3 WHEN 0 THEN 'v3' WHEN 1 THEN 'v5' ELSE 'a1' END AS arm, count(*) AS records, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    arm = F.when(c("user_id") % 3 == 0, "v3").when(c("user_id") % 3 == 1, "v5").otherwise("a1")
    return J.night_aggregates(load(spark, sf, "events").select("ts", arm.alias("arm"), (c("event_type") == "error").alias("is_error")), None)


# --- checks ----------------------------------------------------------------------------------------------------------


@query(
    "chk_01_run_battery",
    CHAT + ALL_RULES_SQL + """ SELECT * FROM (VALUES ('verify', 'fail', '', 8, (SELECT count(*) FROM v)), ('style', 'pass', '', 1, NULL), ('broken', 'suspect', 'ValueError', NULL, NULL), ('shortcut', 'not_mechanized', '', NULL, NULL)) t("check", verdict, note, rows, violations)""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.operators.aggregates import style_concentration
    from tallyforge.plans.verify import verify_corpus

    def broken():  # noqa: ANN202
        raise ValueError

    return K.run_battery(spark, {"verify": lambda: verify_corpus(spark, sf), "style": lambda: style_concentration(load(spark, sf, "documents"), "text"), "broken": broken, "shortcut": None})


@query("chk_02_run_hook", CHAT + " SELECT 'masks' AS \"check\", 'fail' AS verdict, '' AS note, 1 AS rows, count(*) AS violations FROM chat WHERE (role = 'assistant' AND weight <= 0) OR (role <> 'assistant' AND weight <> 0)")
def _(spark, sf):  # noqa: ANN001, ANN202
    K.register_check("pre-s5", "masks", lambda chat: V.report(V.rule_masks(chat), ["masks"], chat))
    return K.run_hook(spark, "pre-s5", load(spark, sf, "chat"))


@query("chk_03_validate_kind", CHAT + " SELECT line, count(*) AS n FROM chat WHERE (role = 'assistant' AND weight <= 0) OR (role <> 'assistant' AND weight <> 0) GROUP BY line")
def _(spark, sf):  # noqa: ANN001, ANN202
    K.VALIDATORS["chat"] = V.rule_masks
    return K.validate_kind("chat", load(spark, sf, "chat")).groupBy("line").agg(F.count("*").alias("n"))


@query("chk_04_make_findings", CHAT + ", v AS (SELECT line, CASE WHEN role = 'assistant' THEN 'masked_out' ELSE 'mask_leak' END || ':' || pos AS d FROM chat WHERE (role = 'assistant' AND weight <= 0) OR (role <> 'assistant' AND weight <> 0)) SELECT left(sha256('lineage' || chr(31) || 'masks' || chr(31) || line || chr(31) || d), 16) AS id, 'lineage' AS auditor, 'warn' AS severity, 'masks' AS rule, line, 'fail' AS verdict FROM v")
def _(spark, sf):  # noqa: ANN001, ANN202
    return K.make_findings(V.rule_masks(load(spark, sf, "chat")), "lineage", "warn")


@query("chk_05_recipe_comparison", "SELECT '{\"changed\":\"' || CASE WHEN lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <> o_orderstatus THEN 'o_orderstatus' ELSE '' END || '\",\"o_custkey\":' || o_custkey || ',\"o_orderkey\":' || o_orderkey || ',\"verdict\":\"pass\"}' AS artifact FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.operators.selection import recipe_diff

    return K.recipe_comparison(recipe_diff(load(spark, sf, "orders"), "o_custkey", "o_orderkey", ["o_orderstatus"]))


@query("fn_17_canonical_sha", "SELECT o_orderkey, sha256(t) AS whole, left(sha256(t), 12) AS short FROM (SELECT o_orderkey, '{\"a\":' || o_orderkey || ',\"b\":' || CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '\"' || o_orderstatus || '\"' END || '}' AS t FROM orders)")
def _(spark, sf):  # noqa: ANN001, ANN202
    fields = {"b": F.when(c("o_orderkey") % 5 != 0, c("o_orderstatus")), "a": c("o_orderkey")}
    return load(spark, sf, "orders").select("o_orderkey", T.canonical_sha(**fields).alias("whole"), T.evidence_sha12(**fields).alias("short"))


@query("fn_15_is_marked", "SELECT doc_id, contains(text || CASE WHEN doc_id % 7 = 0 THEN '[CONTRADICTION-OK]' ELSE '' END, '[CONTRADICTION-OK]') OR doc_id % 5 = 0 OR doc_id % 11 IN (1, 2) AS value FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("doc_id")
    system = F.concat("text", F.when(k % 7 == 0, "[CONTRADICTION-OK]").otherwise(""))
    tags = F.when(k % 5 == 0, F.array(F.lit(" Counter-Instance "))).otherwise(F.array(F.lit("x")))
    record = F.when(k % 11 == 1, '{"counter-instance": true}').when(k % 11 == 2, '{"meta": {"contradiction": 1}}').when(k % 11 == 3, '{"contradiction": false, "metadata": {"contradiction_marker": ""}}').otherwise("{bad")
    return load(spark, sf, "documents").select("doc_id", T.is_marked(system, tags, record).alias("value"))


@query(
    "fn_in_sql",
    r"""WITH d AS (SELECT doc_id, text, source, trim(regexp_replace(text, '[ \t\n\r\x0B\f]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, sha256(lower(s)) AS prompt, left(sha256(lower(regexp_replace(text, '[ \t\n\r\x0B\f]+', '', 'g'))), 16) AS surface, round_even(doc_id / 7.0, 4) AS share, length(text) // 4 AS least, greatest(CAST(ceil(length(text) / 4.0) AS BIGINT), 1) AS most,
nullif(array_to_string(regexp_extract_all(lower(text), '[a-z0-9'']+')[1:3], ' '), '') AS opening, regexp_replace('id ' || doc_id || ' 123-45-6789', '\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b', '[redacted-ssn]') AS clean,
CASE WHEN doc_id % 3 = 0 THEN 'failed' WHEN doc_id % 2 = 0 THEN 'running' ELSE 'queued' END AS status, CASE WHEN doc_id % 2 = 0 THEN 'minor' ELSE 'critical' END AS severity, regexp_matches(source, '^[A-Za-z0-9(][A-Za-z0-9._/§#:@=,()+-]{0,199}$') AS pointer, CASE WHEN source = 'src0' THEN 1.0 ELSE 0.5 END AS likeness FROM d""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.functions import sql

    sql.register(spark)
    return spark.sql(
        """SELECT doc_id, prompt_fingerprint(text) AS prompt, fp16(norm_surface(text)) AS surface, pct4(doc_id, 7) AS share, est_tokens_floor(length(text)) AS least, est_tokens_ceil(length(text)) AS most, opening(text, 3) AS opening,
scrub_pii(concat('id ', doc_id, ' 123-45-6789')) AS clean, run_status(doc_id % 3 = 0, doc_id % 2 = 0, null) AS status, error_severity(CASE WHEN doc_id % 2 = 0 THEN ' **Fixed' ELSE 'open' END) AS severity, valid_pointer(source) AS pointer,
jaccard(array('src0'), array_distinct(array('src0', source))) AS likeness FROM {docs}""",
        docs=load(spark, sf, "documents"),
    )


@query("fn_24_stage_status", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR (o_orderkey % 7 = 1 AND o_orderkey % 2 = 0) THEN 'blocked_on_gate' WHEN o_orderkey % 7 = 2 THEN 'failed' WHEN o_orderkey % 7 = 3 AND o_orderkey % 2 = 1 THEN 'running' ELSE 'passed' END AS value FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    status = F.when(k % 7 == 0, "BLOCKED_ON_GATE").when(k % 7 == 1, "gate_pending").when(k % 7 == 2, "no_go").when(k % 7 == 3, "dispatched").otherwise("ok")
    return load(spark, sf, "orders").select("o_orderkey", T.stage_status(F.when(k % 2 == 0, "review").otherwise("train"), status, ["review"]).alias("value"))


@query("fn_24_run_status", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'failed' WHEN o_orderkey % 3 = 1 AND o_orderkey % 5 = 0 THEN 'finished' WHEN o_orderkey % 3 = 1 THEN 'running' ELSE 'queued' END AS value FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    return load(spark, sf, "orders").select("o_orderkey", T.run_status(k % 3 == 0, k % 3 == 1, k % 5 == 0).alias("value"))


@query("fn_25_classify_runtime", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'cursor_sdk_dispatch' WHEN o_orderkey % 3 = 0 THEN 'tier2_dispatch' WHEN o_orderkey % 2 = 0 THEN 'machine_wide_session' ELSE 'interactive_run_session' END AS value FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    return load(spark, sf, "orders").select("o_orderkey", T.classify_runtime(F.when(k % 4 == 0, "c1").otherwise(""), F.when(k % 3 == 0, "S5"), F.when(k % 2 == 1, k)).alias("value"))


@query(
    "fn_29_best_spec",
    """WITH g AS (SELECT event_id AS id, list_distinct(list_filter(regexp_extract_all(lower('The ' || event_type || ' rate fell on mobile' || CASE WHEN event_id % 2 = 0 THEN ' checkout pages' ELSE '' END), '[a-z][a-z0-9-]{3,}'), lambda x: x NOT IN ('this', 'that', 'with', 'from', 'what', 'data', 'check', 'report', 'factory', 'investigate'))) AS w FROM events),
s(spec, m) AS (VALUES ('clicks', ['click', 'rate', 'fell']), ('pages', ['checkout', 'pages', 'mobile', 'rate']), ('views', ['view', 'rate', 'fell', 'mobile'])),
x AS (SELECT id, spec, len(list_intersect(w, m)) AS k, len(w) AS n FROM g, s), b AS (SELECT id, arg_min({'s': spec, 'v': round_even(k / n, 4)}, (-k, spec)) AS b FROM x WHERE k > 0 GROUP BY id)
SELECT g.id, CASE WHEN b.v >= 0.6 THEN b.s END AS spec, CASE WHEN b.v >= 0.6 THEN b.v END AS share FROM g LEFT JOIN b ON b.id = g.id""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    from tallyforge.operators.joins import best_spec

    specs = spark.createDataFrame([("views", "View rate fell, on mobile"), ("clicks", "The click rate fell"), ("pages", "checkout pages: mobile rate"), ("none", "a b c")], "spec string, mission string")
    text = F.concat(F.lit("The "), c("event_type"), F.lit(" rate fell on mobile"), F.when(c("event_id") % 2 == 0, " checkout pages").otherwise(""))
    return best_spec(load(spark, sf, "events").select(c("event_id").alias("id"), text.alias("text")), specs)
