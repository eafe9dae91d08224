"""Driver queries of windows, selection, set operations and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyforge.operators import seal
from tallyforge.operators import selection as S
from tallyforge.plans.fixtures import load, with_tables
from tallyforge.plans.registry import query
from tallyforge.sources.files import shared_folder
from tallyforge.sources.snapshots import SnapshotTable

c = F.col
NIGHTS, BEATS, POOL = with_tables("nights"), with_tables("beats"), with_tables("pool")


@query("win_01_latest_status", "SELECT c_custkey AS id, coalesce(s, 'open') AS status FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM orders GROUP BY ALL) ON o_custkey = c_custkey")
def _(spark, sf):  # noqa: ANN001, ANN202
    st = load(spark, sf, "orders").select(c("o_custkey").alias("id"), c("o_orderstatus").alias("status"), F.struct("o_orderdate", "o_orderkey").alias("seq"))
    return S.latest_status(load(spark, sf, "customer").select(c("c_custkey").alias("id")), st)


@query("win_02_transition_findings", "SELECT o_orderkey AS id, 'open' AS status FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, 'resolved' FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 3 <> 0 AND o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select(c("o_orderkey").alias("id"), c("o_orderpriority").alias("check"), F.when(c("o_orderstatus") == "O", "open").otherwise("waived").alias("status"))
    return S.transition_findings(o.where("id % 5 = 0"), o.where("id % 3 = 0"), o.select("check").where(c("check").isin("1-URGENT", "2-HIGH")))


@query("win_03_append_findings", "SELECT o_custkey, o_orderkey AS seq FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1 AND o_custkey % 3 <> 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select("o_custkey", c("o_orderkey").alias("seq"))
    return S.append_new(o.where("o_custkey % 3 = 0"), o, "o_custkey")


@query("win_04_dedupe_nights", NIGHTS + ", r AS (SELECT night, arm, mode, event_id % 4 AS ref FROM nights), q AS (SELECT night, arm, ref, min(CASE mode WHEN 'live-shadow' THEN 0 ELSE 2 END) AS k FROM r GROUP BY ALL) SELECT night, arm, CASE WHEN min(k) = 0 THEN 'live-shadow' ELSE 'retro-replay' END AS mode, string_agg(ref, ',' ORDER BY k, ref) AS refs FROM q GROUP BY night, arm")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.dedupe_nights(load(spark, sf, "nights").select("night", "arm", "mode", (c("event_id") % 4).alias("ref")))


_EDGES = "WITH e AS (SELECT event_type AS edge_type, user_id % 50 AS from_key, event_id % 7 AS to_key, CASE WHEN value > 30 THEN 'high' WHEN value > 10 THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN value > 30 THEN 3 WHEN value > 10 THEN 2 ELSE 1 END AS r, 'e' || (event_id % 11) AS evidence FROM events)"


@query("win_05_dedupe_edges", _EDGES + " SELECT edge_type, from_key, to_key, confidence, string_agg(DISTINCT evidence, ',' ORDER BY evidence) AS evidence FROM (SELECT *, max(r) OVER (PARTITION BY edge_type, from_key, to_key) AS t FROM e) WHERE r = t GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    conf = F.when(c("value") > 30, "high").when(c("value") > 10, "medium").otherwise("low")
    e = load(spark, sf, "events").select(c("event_type").alias("edge_type"), (c("user_id") % 50).alias("from_key"), (c("event_id") % 7).alias("to_key"), conf.alias("confidence"), F.concat(F.lit("e"), (c("event_id") % 11).cast("string")).alias("evidence"))
    return S.dedupe_edges(e)


@query("win_07_merge_boards", "SELECT user_id AS session, arg_max(event_type, event_id) AS goal, max(event_id) AS seq FROM events GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.merge_boards(load(spark, sf, "events").select(c("user_id").alias("session"), c("event_type").alias("goal"), c("event_id").alias("seq")))


@query("win_07_agent_index", "WITH r AS (SELECT 't ' || (user_id % 7) AS title, event_id AS id, CASE WHEN event_id % 4 = 0 THEN user_id END AS run_id, ts FROM events WHERE user_id % 11 > 0) SELECT title, arg_max({'i': id, 'r': run_id}, (run_id IS NOT NULL, ts, id)).i AS id, arg_max({'i': id, 'r': run_id}, (run_id IS NOT NULL, ts, id)).r AS run_id FROM r GROUP BY title")
def _(spark, sf):  # noqa: ANN001, ANN202
    title = F.when(c("user_id") % 11 > 0, F.concat(F.lit(" t \t"), (c("user_id") % 7).cast("string"))).otherwise(" ")
    rows = load(spark, sf, "events").select(title.alias("title"), c("event_id").alias("id"), F.when(c("event_id") % 4 == 0, c("user_id")).alias("run_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_seen_at"))
    return S.agent_index(rows).select("title", "id", "run_id")


_SEAL = "WITH r AS (SELECT CAST(c_custkey AS VARCHAR) AS id, row_number() OVER (ORDER BY sha256('7:' || c_custkey), CAST(c_custkey AS VARCHAR)) AS k, count(*) OVER () AS n FROM customer), s AS (SELECT id, left(sha256(id), 16) AS fingerprint FROM r WHERE k <= greatest(5, CAST(round_even(0.2 * n, 0) AS BIGINT)))"


@query("win_08_seal_heldout", _SEAL + " SELECT id, fingerprint FROM s")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.seal_heldout(load(spark, sf, "customer"), "c_custkey", "7")


@query("win_08_write_once", _SEAL + " SELECT fingerprint, (SELECT count(*) FROM customer) AS population, (SELECT left(sha256(string_agg(f, chr(10) ORDER BY f)), 16) FROM (SELECT left(sha256(CAST(c_custkey AS VARCHAR)), 16) AS f FROM customer)) AS population_fingerprint, '7' AS seed FROM s")
def _(spark, sf):  # noqa: ANN001, ANN202
    folder = f"{shared_folder(spark)}/seal-{uuid.uuid4().hex}"
    people = load(spark, sf, "customer")
    seal.seal_once(people, folder, "c_custkey", "7")
    again = seal.seal_once(people.where("c_custkey % 2 = 0"), folder, "c_custkey", "8", fraction=0.5)  # the first seal stands
    m = seal.read_manifest(spark, folder)
    return again.select("fingerprint", F.lit(m["population_size"]).cast("long").alias("population"), F.lit(m["population_fingerprint"]).alias("population_fingerprint"), F.lit(m["seed"]).alias("seed"))


@query("win_09_is_held_out", _SEAL + " SELECT o_orderkey, CAST(o_custkey AS VARCHAR) IN (SELECT id FROM s) AS held_out FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    sealed = S.seal_heldout(load(spark, sf, "customer"), "c_custkey", "7")
    return S.is_held_out(load(spark, sf, "orders"), "o_custkey", sealed).select("o_orderkey", "held_out")


@query(
    "win_10_lease_chain",
    BEATS
    + """, x AS (SELECT *, CASE WHEN ts IS NULL THEN 'no_time' WHEN lag(seq) OVER w + 1 <> seq THEN 'sequence' WHEN epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER w)) > 86400 THEN 'late' END AS fault FROM beats WHERE event_id % 5 <> 0 WINDOW w AS (PARTITION BY session_id ORDER BY seq))
SELECT session_id, arg_min(fault, seq) AS fault, CAST(min(seq) FILTER (fault IS NOT NULL) AS VARCHAR) AS seq FROM x GROUP BY session_id""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.lease_chain(load(spark, sf, "beats").where("event_id % 5 <> 0"), 86400)


@query(
    "win_11_run_lineage",
    """SELECT id, org, coalesce(d, 0) + 1 AS iteration, CASE WHEN p IS NULL THEN 'first' ELSE 'retrain' END AS kind, CAST(p AS VARCHAR) AS predecessor FROM (SELECT o_orderkey AS id, o_custkey AS org, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS d, last_value(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END IGNORE NULLS) OVER w AS p FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.run_lineage(load(spark, sf, "orders").select(c("o_orderkey").alias("id"), c("o_custkey").alias("org"), c("o_orderdate").alias("ts"), (c("o_orderstatus") == "F").alias("terminal")))


@query(
    "win_12_recipe_diff",
    """SELECT o_custkey, o_orderkey, concat_ws(',', CASE WHEN lag(o_orderstatus) OVER w <> o_orderstatus THEN 'o_orderstatus' END, CASE WHEN lag(o_orderpriority) OVER w <> o_orderpriority THEN 'o_orderpriority' END, CASE WHEN lag(o_orderdate) OVER w <> o_orderdate THEN 'o_orderdate' END) AS changed, CASE WHEN len(list_filter([lag(o_orderstatus) OVER w <> o_orderstatus, lag(o_orderpriority) OVER w <> o_orderpriority, lag(o_orderdate) OVER w <> o_orderdate], lambda x: x)) > 2 THEN 'warn' ELSE 'pass' END AS verdict FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.recipe_diff(load(spark, sf, "orders"), "o_custkey", "o_orderkey", ["o_orderstatus", "o_orderpriority", "o_orderdate"], 2)


@query("win_13_hazard_hits", "SELECT doc_id AS spec, 'insult' AS hazard FROM documents WHERE (contains(lower(text), 'clown') OR contains(lower(text), 'moron')) AND NOT contains(lower(text), 'scum') UNION ALL SELECT doc_id, 'license' FROM documents WHERE contains(lower(text), 'mit license')")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.hazard_hits(load(spark, sf, "documents").withColumnRenamed("doc_id", "spec"), [("insult", ["Clown", "moron"], ["scum"]), ("license", ["MIT License"], [])])


@query("win_14_uncited_rows", "SELECT doc_id AS spec, 2 AS line_number FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, 4 FROM documents WHERE doc_id % 2 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    body = F.when(c("doc_id") % 2 == 0, "head\n| S-1 | x |\n| S-2 | y [3] |\n| S-3 | z |").otherwise("plain")
    return S.uncited_rows(load(spark, sf, "documents").select(c("doc_id").alias("spec"), body.alias("text")))


@query(
    "win_15_select_capped",
    POOL
    + """, h AS (SELECT *, sha256('11:' || id) AS h FROM pool), a AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY h, id) AS a FROM h), k AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY h, id) AS c FROM a WHERE a <= 2)
SELECT id, account_id, night, class FROM k WHERE c <= 60 ORDER BY h, id LIMIT 200""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.select_capped(load(spark, sf, "pool"), 200, 2, 0.3, "11").select("id", "account_id", "night", "class")


@query("win_16_apply_doses", "SELECT doc_id AS id, lang AS slice, CAST(unnest(range(1, CASE lang WHEN 'es' THEN 7 WHEN 'fr' THEN 2 ELSE 1 END + 1)) AS INTEGER) AS copy FROM documents WHERE lang <> 'de' OR (instr('0123456789abcdef', left(md5('3:' || doc_id), 1)) - 1) % 2 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.apply_doses(load(spark, sf, "documents").select(c("doc_id").alias("id"), c("lang").alias("slice")), {"es": 7, "fr": 2}, ["de"], "3")


@query("win_17_blocked_on", "SELECT o_custkey AS org, o_orderkey AS idx, first_value(CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS blocked_on FROM orders")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.blocked_on(load(spark, sf, "orders").select(c("o_custkey").alias("org"), c("o_orderkey").alias("idx"), c("o_orderpriority").alias("gate"), (c("o_orderkey") % 5 != 0).alias("approved")))


@query("top_01_top_k", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, min(event_id) LIMIT 25")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.top_k(load(spark, sf, "events"), "user_id", 25, "event_id")


@query("top_03_order_fleet", BEATS + " SELECT session_id, event_id, status, CASE status WHEN 'blocked' THEN 0 WHEN 'failed' THEN 1 WHEN 'done' THEN 3 ELSE 2 END AS severity FROM beats")
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.order_fleet(load(spark, sf, "beats")).select("session_id", "event_id", "status", "severity")


_USER = "SELECT DISTINCT sha256(text) AS k FROM conversations WHERE role = 'user' AND conv_id % {} = 0"


@query("set_01_overlap", f"{_USER.format(2)} INTERSECT {_USER.format(3)}")
def _(spark, sf):  # noqa: ANN001, ANN202
    u = load(spark, sf, "conversations").where("role = 'user'")
    return S.overlap(u.where("conv_id % 2 = 0").select(F.sha2("text", 256).alias("k")), u.where("conv_id % 3 = 0").select(F.sha2("text", 256).alias("k")))


@query("set_02_set_diff", "SELECT user_id, 'left' AS side FROM (SELECT user_id FROM events WHERE event_type = 'view' EXCEPT ALL SELECT user_id FROM events WHERE event_type = 'click') UNION ALL SELECT user_id, 'right' FROM (SELECT user_id FROM events WHERE event_type = 'click' EXCEPT ALL SELECT user_id FROM events WHERE event_type = 'view')")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events")
    return S.set_diff(e.where("event_type = 'view'").select("user_id"), e.where("event_type = 'click'").select("user_id"))


@query("set_03_union_all", "SELECT event_id, user_id, NULL::VARCHAR AS event_type FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, NULL, event_type FROM events WHERE event_type = 'click'".replace("user_id, NULL", "CAST(user_id AS VARCHAR) AS user_id, NULL"))
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").withColumn("user_id", c("user_id").cast("string"))
    return S.union_all(e.where("event_type = 'view'").select("event_id", "user_id"), e.where("event_type = 'click'").select("event_id", "event_type"))


@query(
    "win_15_over_generate",
    POOL
    + """, h AS (SELECT *, sha256('11:' || id) AS h FROM pool), a AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY h, id) AS a FROM h), k AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY h, id) AS c FROM a WHERE a <= 2),
d AS (SELECT * FROM k WHERE c <= 60 ORDER BY h, id LIMIT 200) SELECT id, row_number() OVER (ORDER BY h, id) <= 100 AS picked FROM d""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return S.over_generate(load(spark, sf, "pool"), 100, 2, 0.3, "11").select("id", "picked")


@query("set_04_disjoint", "SELECT count(*) AS shared, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS verdict FROM (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0 INTERSECT SELECT p_partkey FROM part WHERE p_partkey % 3 = 0)")
def _(spark, sf):  # noqa: ANN001, ANN202
    p = load(spark, sf, "part").select("p_partkey")
    return S.disjoint(p.where("p_partkey % 2 = 0"), p.where("p_partkey % 3 = 0"))


@query("snk_01_upsert", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return S.upsert(o.where("o_orderkey % 5 = 0"), o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")), ["o_orderkey"])


@query("snk_01_snapshot_table", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'Y' WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, 3 AS versions, true AS same FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    table = SnapshotTable(spark, f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}")
    into = lambda old, new: S.upsert(old, new, ["o_orderkey"])
    table.replace(o.where("o_orderkey % 5 = 0"), ["o_orderkey"])
    for i, (part, mark) in enumerate([("o_orderkey % 3 = 0", "X"), ("o_orderkey % 6 = 0", "Y"), ("o_orderkey % 6 = 0", "Y")]):
        table.merge(o.where(part).withColumn("o_orderstatus", F.lit(mark)), ["o_orderkey"], into, "load", min(i, 1))
    before = table.read(0).agg(F.count("*").alias("n")).crossJoin(o.where("o_orderkey % 5 = 0").agg(F.count("*").alias("m"))).select((c("n") == c("m")).alias("same"))
    return table.read().withColumn("versions", F.lit(len(table.versions()))).crossJoin(before)


@query("snk_02_insert_ignore", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderstatus ELSE 'new' END AS o_orderstatus FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 3 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.insert_ignore(o.where("o_orderkey % 5 = 0"), o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


@query("snk_03_copy_catalog", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'")
def _(spark, sf):  # noqa: ANN001, ANN202
    _, lines = S.copy_catalog(load(spark, sf, "orders"), load(spark, sf, "lineitem"), c("o_orderstatus") != "P", "o_orderkey", "l_orderkey")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey")


@query("snk_03_natural_keys", "SELECT l_orderkey, l_linenumber, arg_max(l_quantity, (l_partkey, l_suppkey, l_extendedprice)) AS l_quantity FROM lineitem GROUP BY l_orderkey, l_linenumber")
def _(spark, sf):  # noqa: ANN001, ANN202
    lines = load(spark, sf, "lineitem").select(F.struct("l_partkey", "l_suppkey", "l_extendedprice").alias("id"), "l_orderkey", "l_linenumber", "l_quantity")
    return S.copy_natural(lines, ["l_orderkey", "l_linenumber"])


@query("snk_04_changed_only", "SELECT doc_id, sha256(text) AS sha FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    d = load(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return S.changed_only(d, d.where("doc_id % 7 <> 0").withColumn("sha", F.when(c("doc_id") % 11 == 0, None).otherwise(c("sha"))), "doc_id", "sha")


@query("snk_05_attribute_first", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'old' ELSE v END AS source_run_id FROM customer LEFT JOIN (SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderpriority)) AS v FROM orders GROUP BY ALL) ON o_custkey = c_custkey")
def _(spark, sf):  # noqa: ANN001, ANN202
    t = load(spark, sf, "customer").select("c_custkey", F.when(c("c_custkey") % 4 == 0, "old").alias("source_run_id"))
    claims = load(spark, sf, "orders").select(c("o_custkey").alias("c_custkey"), c("o_orderpriority").alias("value"), c("o_orderdate").alias("ts"))
    return S.attribute_first(t, claims, "c_custkey", "source_run_id")


@query("snk_06_patch_links", "SELECT user_id, CASE WHEN user_id % 4 = 0 THEN 'view' WHEN n = 1 THEN v END AS parent, coalesce(n > 1 OR (user_id % 4 = 0 AND v <> 'view'), false) AS conflict FROM (SELECT user_id, count(DISTINCT event_type) FILTER (event_id % 50 = 0) AS n, min(event_type) FILTER (event_id % 50 = 0) AS v FROM events GROUP BY user_id)")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events")
    agents = e.select("user_id").distinct().withColumn("parent", F.when(c("user_id") % 4 == 0, "view"))
    return S.patch_links(agents, e.where("event_id % 50 = 0").select("user_id", c("event_type").alias("value")), "user_id", "parent")
