"""Driver queries of the join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import joins as J
from tallyforge.plans.fixtures import load, with_tables
from tallyforge.plans.registry import query
from tallyforge.sources import files

c = F.col
META, LEDGER, BEATS, TRAJ, QA = (with_tables(n) for n in ("meta", "ledger", "beats", "traj", "qa"))


@query("jon_01_align", META + " SELECT a.line, a.source_row_id, b.gold_class FROM meta a JOIN meta b USING (line) WHERE a.line % 7 <> 0 AND b.line % 5 <> 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    m = files.staged(load(spark, sf, "meta").select("line", "source_row_id", "gold_class"), "aligned")  # numbered once for both sides
    return J.align(m.where("line % 7 <> 0").select("line", "source_row_id"), m.where("line % 5 <> 0").select("line", "gold_class"))


@query("jon_02_lineage_misses", META + " SELECT line, source_row_id FROM meta WHERE source_row_id NOT IN (SELECT o_orderkey FROM orders)")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.lineage_misses(load(spark, sf, "meta").select("line", "source_row_id"), load(spark, sf, "pool"))


@query("jon_03_heldout_leaks", "SELECT o_orderkey AS row_id, left(sha256('c' || o_custkey), 16) AS fingerprint FROM orders WHERE o_custkey % 10 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "orders").select(c("o_orderkey").alias("row_id"), F.concat(F.lit("order of C"), c("o_custkey").cast("string"), F.lit(":x")).alias("text"))
    sealed = load(spark, sf, "customer").where("c_custkey % 10 = 0").select(J.T.fp16(F.concat(F.lit("c"), c("c_custkey").cast("string"))).alias("fingerprint"))
    return J.heldout_leaks(rows, sealed)


@query("jon_03_meta_keys", "SELECT o_orderkey AS row_id, left(sha256('c' || o_custkey), 16) AS fingerprint FROM orders WHERE o_custkey % 10 = 0 AND o_orderkey % 3 > 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    who = F.concat(F.lit("C"), c("o_custkey").cast("string"))
    rows = load(spark, sf, "orders").select(c("o_orderkey").alias("row_id"), F.lit(None).cast("string").alias("text"), F.when(c("o_orderkey") % 3 == 1, who).alias("account_id"), F.when(c("o_orderkey") % 3 == 2, F.concat(who, F.lit(":night 3"))).alias("cf_group"))
    sealed = load(spark, sf, "customer").where("c_custkey % 10 = 0").select(J.T.fp16(F.concat(F.lit("c"), c("c_custkey").cast("string"))).alias("fingerprint"))
    return J.heldout_leaks(rows, sealed, keys=["account_id", "cf_group"])


_CONV = "SELECT conv_id AS line, sha256(lower(regexp_replace(text, '[ \\t\\n\\r]+', '', 'g'))) AS surface, sha256(text) AS sha FROM (SELECT conv_id, text FROM conversations WHERE role = 'user' UNION ALL SELECT conv_id + 1000000, ' ' || text FROM conversations WHERE role = 'user' AND conv_id % 9 = 0)"


@query(
    "jon_04_reserved_leaks",
    f"WITH x AS ({_CONV}), k AS (SELECT 'surface' AS surface, surface AS key, line FROM x UNION ALL SELECT 'sha', sha, line FROM x) SELECT surface, key, min(line) FILTER (line < 1000000) AS train_line, min(line) FILTER (line >= 1000000) AS reserved_line FROM k GROUP BY ALL HAVING count(*) FILTER (line < 1000000) > 0 AND count(*) FILTER (line >= 1000000) > 0",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    users = load(spark, sf, "conversations").where("role = 'user'").select(c("conv_id").alias("line"), "text")
    rows = users.unionByName(users.where("line % 9 = 0").select((c("line") + 1000000).alias("line"), F.concat(F.lit(" "), c("text")).alias("text")))
    keyed = rows.select("line", F.sha2(J.T.norm_surface(c("text")), 256).alias("surface"), F.sha2("text", 256).alias("sha"))
    return J.reserved_leaks(keyed.where("line < 1000000"), keyed.where("line >= 1000000"), ["surface", "sha"])


_PRINT = "SELECT left(sha256(string_agg(f, chr(10) ORDER BY f)), 16) FROM (SELECT left(sha256(CAST(c_custkey AS VARCHAR)), 16) AS f FROM customer WHERE {})"


@query(
    "jon_05_population_drift",
    f"""WITH s AS (SELECT count(*) AS sealed, count(*) FILTER (c_custkey % 50 <> 0) AS resolved FROM customer WHERE c_custkey % 5 = 0), p AS (SELECT *, (SELECT count(*) FROM customer WHERE c_custkey % 50 <> 0) AS population, ({_PRINT.format('c_custkey % 50 <> 0')}) AS population_fingerprint FROM s)
SELECT *, 'not_evaluated' AS drift, 'suspect' AS verdict FROM p UNION ALL SELECT *, 'drifted', 'fail' FROM p UNION ALL SELECT *, 'clean', 'suspect' FROM p""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    pop = load(spark, sf, "customer").select("c_custkey", J.T.fp16(c("c_custkey").cast("string")).alias("fingerprint"))
    sealed, now = pop.where("c_custkey % 5 = 0"), pop.where("c_custkey % 50 <> 0")
    of = J.sorted_digest(now, "fingerprint")
    then, same = (x.first().fingerprint[:16] for x in (J.sorted_digest(pop, "fingerprint"), of))
    return J.population_drift(sealed, now, None, of).unionByName(J.population_drift(sealed, now, then, of)).unionByName(J.population_drift(sealed, now, same, of))


@query(
    "jon_06_contradictions",
    QA
    + """, s AS (SELECT min(line) AS line, question, left(answer, 3) AS a, marked FROM qa GROUP BY question, left(answer, 3), marked)
SELECT x.line AS line_a, y.line AS line_b, CASE WHEN x.a = 'I c' OR y.a = 'I c' THEN 'stance_vs_decline' ELSE 'stance' END AS axis, x.marked OR y.marked AS marked FROM s x JOIN s y ON x.question = y.question AND x.line < y.line AND x.a <> y.a""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.contradictions(load(spark, sf, "qa"))


@query("jon_06_divergent_grounding", QA + ", s AS (SELECT DISTINCT question, left(answer, 3) AS a, marked, line % 3 AS k FROM qa) SELECT count(*) AS pairs FROM s x JOIN s y ON x.question = y.question AND x.k < y.k")
def _(spark, sf):  # noqa: ANN001, ANN202
    facts = F.concat(F.lit(" more boxes of cable from the northern depot today for 1"), (c("line") % 3).cast("string"), F.lit("00 units?"))
    return J.divergent_grounding(load(spark, sf, "qa").withColumn("question", F.concat(F.regexp_replace("question", " today.*", ""), facts)))


@query("jon_06_contradiction_report", QA + """, s AS (SELECT min(line) AS line, question, left(answer, 3) AS a, marked FROM qa GROUP BY question, left(answer, 3), marked), b AS (SELECT count(*) AS n FROM s GROUP BY question),
p AS (SELECT x.marked OR y.marked AS m FROM s x JOIN s y ON x.question = y.question AND x.line < y.line AND x.a <> y.a)
SELECT CAST((SELECT sum(n * (n - 1) // 2) FROM b) AS BIGINT) AS comparisons, count(*) FILTER (NOT m) AS unmarked, count(*) FILTER (m) AS marked, CASE WHEN (SELECT sum(n * (n - 1) // 2) FROM b) > 2000000 THEN 'suspect' WHEN count(*) FILTER (NOT m) > 0 THEN 'fail' ELSE 'pass' END AS verdict FROM p""")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.contradiction_report(load(spark, sf, "qa"))


_ASOF = LEDGER + """, r AS (SELECT * FROM ledger WHERE ok AND tool = 'read'), w AS (SELECT * FROM ledger WHERE ok AND tool = 'write')"""


@query(
    "jon_07_artifact_flows",
    _ASOF
    + """ SELECT path, writer, reader, event_id FROM (SELECT r.path, r.session_id AS reader, r.event_id, (SELECT arg_max(w.session_id, (w.ts, w.event_id)) FROM w WHERE w.path = r.path AND (w.ts < r.ts OR (w.ts = r.ts AND w.event_id < r.event_id))) AS writer FROM r) WHERE writer <> reader""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.artifact_flows(load(spark, sf, "ledger"))


@query("jon_07_artifact_flows_last", _ASOF + ", l AS (SELECT path, arg_max(session_id, (ts, event_id)) AS writer, max(ts) AS wts FROM w GROUP BY path) SELECT path, writer, session_id AS reader, event_id FROM r JOIN l USING (path) WHERE wts <= ts AND writer <> session_id")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.artifact_flows(load(spark, sf, "ledger"), mode="last")


@query(
    "jon_08_unique_in_window",
    "SELECT s.event_id AS key, CAST(CASE WHEN count(p.event_id) = 1 THEN min(p.event_id) END AS VARCHAR) AS ref FROM events s LEFT JOIN events p ON p.event_type = s.event_type AND p.user_id = s.user_id AND p.ts BETWEEN s.ts - INTERVAL 2 SECOND AND s.ts + INTERVAL 36002 SECOND AND p.event_id % 3 <> 0 WHERE s.event_id % 3 = 0 GROUP BY s.event_id",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events").withColumn("label", F.concat_ws(":", "event_type", c("user_id").cast("string")))
    spans = e.where("event_id % 3 = 0").select(c("event_id").alias("key"), "label", c("ts").alias("start"), (c("ts") + F.expr("interval 36000 seconds")).alias("end"))
    return J.match_unique_in_window(spans, e.where("event_id % 3 <> 0").select("label", "ts", c("event_id").alias("ref"))).withColumn("ref", c("ref").cast("string"))


_PFX = "left(trim(regexp_replace(text, '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g')), 200)"


@query(
    "jon_09_prompt_prefix",
    f"WITH d AS (SELECT doc_id, {_PFX} AS p, doc_id * 100 AS at FROM documents) SELECT r.doc_id AS key, CAST(CASE WHEN count(t.doc_id) = 1 THEN min(t.doc_id) WHEN count(t.doc_id) FILTER (abs(t.at - r.at) <= 300) = 1 THEN min(t.doc_id) FILTER (abs(t.at - r.at) <= 300) END AS VARCHAR) AS ref FROM d r LEFT JOIN d t ON t.p = r.p AND t.doc_id % 2 = 0 WHERE r.doc_id % 2 = 1 GROUP BY r.doc_id",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    d = load(spark, sf, "documents").select("doc_id", c("text").alias("prompt"), F.timestamp_seconds(c("doc_id") * 100).alias("ts"))
    return J.match_prompt_prefix(d.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "key"), d.where("doc_id % 2 = 0").withColumnRenamed("doc_id", "ref")).withColumn("ref", c("ref").cast("string"))


_LABELS = ["clown", "idiot", "moron", "pathetic", "scum", "worthless", "trash", "disgusting"]


@query(
    "jon_10_match_label",
    f"WITH w AS (SELECT DISTINCT doc_id AS key, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS label FROM documents), k AS (SELECT * FROM w WHERE label IN ({', '.join(repr(x) for x in _LABELS)})) SELECT d.doc_id AS key, CASE WHEN count(k.label) = 1 THEN min(k.label) END AS label FROM documents d LEFT JOIN k ON k.key = d.doc_id GROUP BY d.doc_id",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.match_label(spark.createDataFrame([(x,) for x in _LABELS], "label string"), load(spark, sf, "documents").select(c("doc_id").alias("key"), "text"))


@query("jon_10_match_spawn_label", "SELECT doc_id AS key, CASE WHEN doc_id % 4 = 0 THEN source WHEN doc_id % 4 = 1 THEN lang || '_agent' END AS label FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    d = load(spark, sf, "documents")
    labels = d.select(c("source").alias("label")).union(d.select(F.concat("lang", F.lit("_Agent"))))
    kinds = F.when(c("doc_id") % 4 == 0, F.concat(F.lit("You are the "), c("source"), F.lit(", not "), c("lang"), F.lit("_agent. "))).when(c("doc_id") % 4 == 1, F.concat(F.lit("You are "), c("lang"), F.lit("_agent: ")))
    kinds = kinds.when(c("doc_id") % 4 == 2, F.concat(F.lit("You are "), F.repeat(F.lit("x "), 75), c("source"), F.lit(" "))).otherwise(F.concat(F.lit("Ask "), c("source"), F.lit(" ")))
    return J.match_spawn_label(labels, d.select(c("doc_id").alias("key"), F.concat(kinds, F.lit("~ "), F.when(c("doc_id") % 4 != 1, F.regexp_replace("text", "[A-Za-z0-9]", ".")).otherwise("")).alias("text")))


_PATH = "array_to_string(list_filter(string_split(split_part(url, '/', 3) || '/' || split_part(url, '/', 4) || '/' || split_part(split_part(url, '/', 5), '?', 1), '/'), lambda x: x <> ''), '/')"


def _paths(spark, sf):  # noqa: ANN001, ANN202
    parts = F.split("url", "/")
    at = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    whole = F.concat_ws("/", at(3), at(4), F.element_at(F.split(at(5), r"\?"), 1))
    return load(spark, sf, "pages").select("page_id", F.array_join(F.filter(F.split(whole, "/"), lambda x: x != ""), "/").alias("path"))


@query(
    "jon_11_owner_of",
    f"""WITH p AS (SELECT page_id, {_PATH} AS path FROM pages), s AS (SELECT DISTINCT split_part(path, '/', 1) AS scope, length(path) % 2 AS owner FROM p UNION SELECT DISTINCT split_part(path, '/', 1) || '/' || split_part(path, '/', 2), 7 FROM p WHERE path LIKE '%/%'),
h AS (SELECT DISTINCT p.path, s.owner, rank() OVER (PARTITION BY p.path ORDER BY length(scope) DESC) AS r FROM (SELECT DISTINCT path FROM p) p JOIN s ON p.path = s.scope OR starts_with(p.path, s.scope || '/')),
b AS (SELECT path, CASE WHEN count(DISTINCT owner) = 1 THEN min(owner) END AS owner FROM h WHERE r = 1 GROUP BY path) SELECT page_id, p.path, CAST(owner AS VARCHAR) AS owner FROM p LEFT JOIN b ON b.path = p.path""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    p = _paths(spark, sf)
    head = F.split("path", "/")
    scopes = p.select(head[0].alias("scope"), (F.length("path") % 2).alias("owner")).union(p.where(c("path").contains("/")).select(F.concat_ws("/", head[0], head[1]), F.lit(7)))
    return J.owner_of(p, scopes).select("page_id", "path", c("owner").cast("string").alias("owner"))


_NEWEST = BEATS + ", n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY (ts IS NOT NULL) DESC, ts DESC NULLS LAST, (origin = 'worktree') DESC, event_id DESC) AS r FROM beats) WHERE r = 1)"


@query("win_06_newest_beat", _NEWEST + " SELECT session_id, event_id, seq, ts, status, origin FROM n")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.newest_beat(load(spark, sf, "beats"))


@query(
    "jon_12_fleet_view",
    with_tables("beats", "ledger")
    + """, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY (ts IS NOT NULL) DESC, ts DESC NULLS LAST, (origin = 'worktree') DESC, event_id DESC) AS r FROM beats WHERE user_id_mod <> 0) WHERE r = 1),
l AS (SELECT 's' || session_id AS session_id, arg_max(tool, (ts, event_id)) AS last_tool FROM ledger WHERE CAST(session_id AS INTEGER) % 5 <> 0 GROUP BY ALL)
SELECT coalesce(l.session_id, n.session_id) AS session_id, last_tool, status, 'h' || CASE WHEN length(coalesce(l.session_id, n.session_id)) % 2 = 0 THEN coalesce(l.session_id, n.session_id) END AS head, CASE WHEN last_tool IS NULL THEN 'beat' WHEN status IS NULL THEN 'ledger' ELSE 'both' END AS source FROM l FULL JOIN n ON n.session_id = l.session_id""".replace("FROM beats WHERE user_id_mod <> 0", "FROM beats WHERE CAST(substr(session_id, 2) AS INTEGER) % 3 <> 0"),
)
def _(spark, sf):  # noqa: ANN001, ANN202
    ledger = load(spark, sf, "ledger").where("cast(session_id as int) % 5 <> 0").withColumn("session_id", F.concat(F.lit("s"), c("session_id")))
    beats = load(spark, sf, "beats")
    heads = beats.select("session_id").distinct().where("length(session_id) % 2 = 0").withColumn("head", F.concat(F.lit("h"), c("session_id")))
    return J.fleet_view(ledger, beats.where("cast(substring(session_id, 2) as int) % 3 <> 0"), heads)


@query("jon_13_gate_outcomes", "SELECT c_custkey AS request_id, coalesce(d, 'pending') AS decision, n AS rejection_note FROM customer LEFT JOIN (SELECT o_custkey, arg_max(CASE WHEN o_orderstatus = 'F' THEN 'rejected' ELSE 'approved' END, (o_orderdate, o_orderkey)) AS d, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'F') AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey")
def _(spark, sf):  # noqa: ANN001, ANN202
    dec = load(spark, sf, "orders").select(c("o_custkey").alias("request_id"), c("o_orderkey").alias("decision_id"), c("o_orderdate").alias("ts"), F.when(c("o_orderstatus") == "F", "rejected").otherwise("approved").alias("decision"), c("o_orderpriority").alias("note"))
    return J.gate_outcomes(load(spark, sf, "customer").select(c("c_custkey").alias("request_id")), dec)


@query("jon_14_resolve_claims", _NEWEST + ", t AS (SELECT max(ts) AS now FROM beats), k AS (SELECT page_id AS path, CASE WHEN page_id % 4 = 0 THEN NULL ELSE 's' || (page_id % 40) END AS holder FROM pages) SELECT path, holder, CASE WHEN holder IS NULL THEN 'FREE' WHEN holder = 's5' THEN 'MINE' WHEN coalesce(epoch(TIMESTAMP '2024-01-15 00:00:00') - epoch(date_trunc('second', n.ts)) <= 604800 AND status IN ('working', 'blocked'), false) THEN 'LIVE' ELSE 'STALE' END AS state FROM k LEFT JOIN n ON n.session_id = k.holder")
def _(spark, sf):  # noqa: ANN001, ANN202
    claims = load(spark, sf, "pages").select(c("page_id").alias("path"), F.when(c("page_id") % 4 != 0, F.concat(F.lit("s"), (c("page_id") % 40).cast("string"))).alias("holder"))
    return J.resolve_claims(claims, load(spark, sf, "beats"), "s5", "2024-01-15 00:00:00", 60 * 24 * 7)


@query("jon_15_decision_outcomes", "SELECT o_orderkey AS decision_id, coalesce(n, 0) AS n, outcome FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, arg_max(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_returnflag)) AS outcome FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY ALL) ON l_orderkey = o_orderkey")
def _(spark, sf):  # noqa: ANN001, ANN202
    out = load(spark, sf, "lineitem").where("l_orderkey % 3 = 0").select(c("l_orderkey").alias("decision_id"), c("l_returnflag").alias("outcome"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("seq"))
    return J.decision_outcomes(load(spark, sf, "orders").select(c("o_orderkey").alias("decision_id")), out).select("decision_id", "n", "outcome")


@query(
    "jon_11_owner_by_glob",
    """SELECT page_id, 'lib/m' || (page_id % 7) || CASE WHEN page_id % 2 = 0 THEN '/a.py' ELSE '/sub/b.py' END AS path, CASE WHEN page_id % 7 = 3 THEN 'deep' WHEN page_id % 2 = 0 THEN 'flat' ELSE 'root' END AS owner FROM pages""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("page_id")
    p = load(spark, sf, "pages").select("page_id", F.concat(F.lit("lib/m"), (k % 7).cast("string"), F.when(k % 2 == 0, "/a.py").otherwise("/sub/b.py")).alias("path"))
    scopes = spark.createDataFrame([("lib", "root")], "scope string, owner string")
    globs = spark.createDataFrame([("lib/*/*.py", "flat"), ("lib/m3/**.py", "deep"), ("other/**", "none")], "scope string, owner string")
    return J.owner_of(p, scopes, globs).select("page_id", "path", "owner")


@query(
    "jon_16_audit_twins",
    META
    + """, r AS (SELECT source_row_id, count(*) AS n, min(gold_class) AS g, min(cf_group) AS c, min(night) AS d, min(weight) AS w FROM meta WHERE block = 'real_trajectory' GROUP BY ALL),
t AS (SELECT m.*, r.source_row_id AS src, n, g, c, d, w FROM meta m LEFT JOIN r ON r.source_row_id = twin_of WHERE twin_of IS NOT NULL)
SELECT count(*) AS twins, count(*) FILTER (src IS NULL) AS missing, count(*) FILTER (n > 1) AS duplicate, count(*) FILTER (g <> gold_class) AS gold_class_differs, count(*) FILTER (c <> cf_group) AS cf_group_differs, count(*) FILTER (d <> night) AS night_differs, count(*) FILTER (w <> weight) AS weight_differs,
round_even((SELECT count(*) FROM r WHERE source_row_id IN (SELECT twin_of FROM meta)) / (SELECT count(*) FROM r), 4) AS real_covered, round_even(count(src) / count(*), 4) AS twins_resolved, round_even(count(*) FILTER (g = gold_class AND c = cf_group AND d = night AND w = weight) / count(*), 4) AS twins_clean, 'fail' AS verdict FROM t""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.audit_twins(load(spark, sf, "meta"), ["gold_class", "cf_group", "night", "weight"])


_TWINS = META + """, chained AS (SELECT *, CASE WHEN line % 17 = 0 THEN NULL WHEN block = 'twins' AND line % 5 = 0 THEN ['read', 'emit_output'] WHEN block = 'twins' AND line % 5 = 1 THEN ['list', 'emit_output', 'read'] ELSE ['list', 'read', 'emit_output'] END AS chain FROM meta),
rc AS (SELECT source_row_id, arg_min({'c': chain}, line).c AS rc FROM chained WHERE block = 'real_trajectory' GROUP BY source_row_id), tp AS (SELECT line, twin_of AS source_row_id, coalesce(rc, []) AS a, coalesce(chain, []) AS b FROM chained JOIN rc ON rc.source_row_id = twin_of WHERE block = 'twins'),
td AS (SELECT line, source_row_id, coalesce(list_min([i FOR i IN range(1, greatest(len(a), len(b)) + 1) IF a[i] IS DISTINCT FROM b[i]]), 0) AS first_difference, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 WHEN a = b THEN 3 ELSE 2 END AS common, len(b) AS steps FROM tp)"""


def _chained(meta):  # noqa: ANN001, ANN202
    list_, read, emit = (F.lit(x) for x in ("list", "read", "emit_output"))
    k, twin = c("line") % 5, c("block") == "twins"
    chain = F.when(c("line") % 17 != 0, F.when(twin & (k == 0), F.array(read, emit)).when(twin & (k == 1), F.array(list_, emit, read)).otherwise(F.array(list_, read, emit)))
    return meta.withColumn("chain", chain)


@query("jon_16_twin_chains", _TWINS + " SELECT line, source_row_id, CAST(first_difference AS INTEGER) AS first_difference, common, CAST(steps AS INTEGER) AS steps FROM td")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.twin_chains(_chained(load(spark, sf, "meta")))


@query(
    "jon_16_twin_lineage",
    _TWINS
    + """, re AS (SELECT count(*) AS real, count(*) - count(DISTINCT source_row_id) AS duplicate_real_sources FROM meta WHERE block = 'real_trajectory'),
pa AS (SELECT twin_of, count(*) AS t FROM meta WHERE block = 'twins' GROUP BY twin_of), so AS (SELECT count(*) AS unique_paired_sources, sum(t) AS twins, count(*) FILTER (t > 1) AS duplicate_twin_sources, count(*) FILTER (twin_of NOT IN (SELECT source_row_id FROM meta WHERE block = 'real_trajectory')) AS missing_sources FROM pa),
la AS (SELECT source_row_id, arg_max({'g': gold_class, 'n': night, 's': source_row_id}, line) AS r FROM meta WHERE block = 'real_trajectory' GROUP BY source_row_id),
mi AS (SELECT sum((gold_class <> r.g)::INT + (night <> r.n)::INT + (m.source_row_id <> r.s)::INT) AS identity_mismatches FROM meta m JOIN la ON la.source_row_id = m.twin_of WHERE block = 'twins'),
sh AS (SELECT count(*) FILTER (line % 3 > 0) AS c, count(*) FILTER (line % 4 = 0) AS r, count(*) FILTER (line % 3 = 2) AS e FROM meta WHERE block = 'twins')
SELECT real, CAST(twins AS BIGINT) AS twins, unique_paired_sources, real - unique_paired_sources AS unpaired_real, duplicate_real_sources, duplicate_twin_sources, missing_sources, CAST(identity_mismatches AS BIGINT) AS identity_mismatches, (SELECT count(*) FROM td WHERE first_difference > 0) AS chain_differences,
c AS twins_with_calls, r AS twins_with_results, e AS twins_with_output, round_even(unique_paired_sources / twins, 4) AS selected_share, round_even(unique_paired_sources / real, 4) AS real_share, round_even((twins - missing_sources) / twins, 4) AS resolved_share, 'fail' AS source_identity,
CASE WHEN twins = unique_paired_sources THEN 'pass' ELSE 'fail' END AS one_to_one_selected, CASE WHEN real = unique_paired_sources THEN 'pass' ELSE 'fail' END AS one_to_one_all FROM re, so, mi, sh""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    meta = _chained(files.staged(load(spark, sf, "meta").select("line", "source_row_id", "gold_class", "night", "block", "twin_of"), "lineage"))  # numbered once
    k, none = c("line"), F.lit(None).cast("string")
    said = lambda role, tool: F.struct(F.lit(role).alias("role"), tool.alias("tool_name"))
    calls = F.when(k % 3 > 0, said("assistant", F.when(k % 3 == 2, "emit_output").otherwise("read")))
    messages = meta.select("line", F.inline(F.array_compact(F.array(calls, F.when(k % 4 == 0, said("tool", none)), said("user", none)))))
    return J.audit_twin_lineage(meta, messages, ["source_row_id", "gold_class", "night"])


@query("jon_17_resolve_edges", "SELECT event_id, user_id AS from_key, user_id + 1 AS to_key, CAST(CASE WHEN user_id % 4 <> 0 AND (user_id + 1) % 4 <> 0 AND user_id // 10 <> (user_id + 1) // 10 THEN NULL WHEN user_id % 4 <> 0 AND user_id IN (SELECT user_id FROM events) THEN user_id // 10 WHEN (user_id + 1) % 4 <> 0 AND user_id + 1 IN (SELECT user_id FROM events) THEN (user_id + 1) // 10 END AS VARCHAR) AS run_id FROM events WHERE user_id + 1 IN (SELECT user_id FROM events)")
def _(spark, sf):  # noqa: ANN001, ANN202
    e = load(spark, sf, "events")
    users = e.select(c("user_id").alias("agent")).distinct()
    edges = e.select("event_id", c("user_id").alias("from_key"), (c("user_id") + 1).alias("to_key")).join(users.select(c("agent").alias("to_key")), "to_key", "left_semi")
    agents = users.where("agent % 4 <> 0").withColumn("run_id", F.floor(c("agent") / 10))
    return J.resolve_edges(edges, agents).select("event_id", "from_key", "to_key", c("run_id").cast("string").alias("run_id"))


@query(
    "jon_18_parent_edges",
    """WITH a AS (SELECT c_custkey AS k FROM customer) SELECT 'a' || k AS child, CASE WHEN k % 3 = 1 THEN 'a' || (k - 1) WHEN k % 6 = 0 THEN 'boss' ELSE 'lead' END AS parent, CASE WHEN k % 3 = 1 THEN 'folder' WHEN k % 6 = 0 THEN 'dispatch' ELSE 'goal' END AS basis, CASE WHEN k % 3 = 1 OR k % 6 = 0 THEN 'high' ELSE 'medium' END AS confidence FROM a WHERE (k % 3 = 1 AND k - 1 IN (SELECT k FROM a)) OR (k % 3 <> 1 AND k % 6 = 0) OR (k % 3 <> 1 AND k % 6 <> 0 AND k % 5 = 0)""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    a = load(spark, sf, "customer").select(c("c_custkey").alias("k"))
    name = lambda n: F.concat(F.lit("a"), n.cast("string"))
    # every third agent lives in a folder of its own with the next one below it; the others apart
    folder = F.when(c("k") % 3 == 1, F.concat(F.lit("run/f"), (c("k") - 1).cast("string"), F.lit("/sub"))).otherwise(F.concat(F.lit("run/f"), c("k").cast("string")))
    agents = a.select(name(c("k")).alias("agent"), folder.alias("folder"))
    dispatches = a.where("k % 6 = 0").select(F.lit("boss").alias("parent"), name(c("k")).alias("child"))
    twice = F.explode(F.when(c("k") % 5 == 0, F.array(F.lit("lead"))).otherwise(F.array(F.lit("lead"), F.lit("other"))))
    goals = a.where("k > 1").select(twice.alias("parent"), name(c("k")).alias("child"))
    return J.parent_edges(J.parent_candidates(agents, dispatches, goals))


@query("jon_19_pair_tool_results", TRAJ + " SELECT a.line, a.call_id, a.tool_name, t.content AS result FROM traj a LEFT JOIN traj t ON t.line = a.line AND t.role = 'tool' AND t.call_id = a.call_id WHERE a.role = 'assistant' AND a.call_id IS NOT NULL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.pair_tool_results(load(spark, sf, "traj"))


@query("jon_20_bridge", "WITH o AS (SELECT DISTINCT n_name AS slug, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE n_nationkey END AS org_id FROM nation), s AS (SELECT * FROM o WHERE org_id IN (SELECT org_id FROM o GROUP BY org_id HAVING count(*) = 1)) SELECT c_custkey, n_name AS slug, CAST(org_id AS VARCHAR) AS org_id FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN s ON s.slug = n_name")
def _(spark, sf):  # noqa: ANN001, ANN202
    n = load(spark, sf, "nation")
    orgs = n.select(c("n_name").alias("slug"), F.when(c("n_nationkey") % 5 == 0, 0).otherwise(c("n_nationkey")).alias("org_id"))
    runs = load(spark, sf, "customer").join(n, c("c_nationkey") == c("n_nationkey")).select("c_custkey", c("n_name").alias("slug"))
    return J.bridge(runs, orgs).select("c_custkey", "slug", c("org_id").cast("string").alias("org_id"))


@query("jon_21_orphans", "SELECT l_orderkey AS attempt_id, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0)")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.orphans(load(spark, sf, "lineitem").select(c("l_orderkey").alias("attempt_id"), "l_linenumber"), load(spark, sf, "orders").where("o_orderkey % 4 <> 0").select(c("o_orderkey").alias("attempt_id")))


@query("jon_22_snapshot_diff", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'created' WHEN o_orderkey % 5 = 0 THEN 'deleted' ELSE 'modified' END AS change FROM orders WHERE NOT (o_orderkey % 7 = 0 AND o_orderkey % 5 = 0) AND (o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 3 = 0)")
def _(spark, sf):  # noqa: ANN001, ANN202
    o = load(spark, sf, "orders").select("o_orderkey", c("o_orderstatus").alias("digest"))
    after = o.where("o_orderkey % 5 <> 0").withColumn("digest", F.when(c("o_orderkey") % 3 == 0, "new").otherwise(c("digest")))
    return J.snapshot_diff(o.where("o_orderkey % 7 <> 0"), after, "o_orderkey")


@query("jon_23_scope_overlaps", f"WITH p AS (SELECT page_id AS id, {_PATH} AS path FROM pages) SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM p a JOIN p b ON a.id <> b.id AND (a.path = b.path OR starts_with(a.path, b.path || '/'))")
def _(spark, sf):  # noqa: ANN001, ANN202
    return J.scope_overlaps(_paths(spark, sf).withColumnRenamed("page_id", "id"))


@query("jon_23_lane_crossings", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'left' ELSE 'right' END AS lane, CASE WHEN o_orderkey % 2 = 0 THEN 'right' ELSE 'left' END AS crosses FROM orders WHERE o_orderkey % 3 = 0")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = c("o_orderkey")
    mine, other = F.when(k % 2 == 0, "left").otherwise("right"), F.when(k % 2 == 0, "right").otherwise("left")
    path = F.when(k % 3 == 0, F.concat(F.lit("work/"), other, F.lit("_lane/x"))).when(k % 3 == 1, F.concat(F.lit("work/"), mine, F.lit("_lane/"), other, F.lit("_lane"))).otherwise(F.concat(F.lit("work/"), other, F.lit("_lane2")))
    return J.lane_crossings(load(spark, sf, "orders").select(k.alias("id"), mine.alias("lane"), path.alias("path")), {"left": "left_lane", "right": "right_lane"})


@query("jon_24_artifact_closure", "SELECT doc_id AS path, CASE WHEN doc_id % 11 = 0 THEN 'undeclared' WHEN doc_id % 13 = 0 THEN 'missing' ELSE 'stale' END AS fault FROM documents WHERE (doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0) AND NOT (doc_id % 11 = 0 AND doc_id % 13 = 0)")
def _(spark, sf):  # noqa: ANN001, ANN202
    d = load(spark, sf, "documents").select(c("doc_id").alias("path"), F.sha2("text", 256).alias("sha"))
    return J.artifact_closure(d.where("path % 11 <> 0").withColumn("sha", F.when(c("path") % 17 == 0, "old").otherwise(c("sha"))), d.where("path % 13 <> 0"))
