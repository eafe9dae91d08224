"""Driver queries of the corpus verifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import verify as V
from tallyforge.operators import verify_pass as VP
from tallyforge.plans.fixtures import FIXTURES, load, with_tables
from tallyforge.plans.registry import query

CHAT, TRAJ, META = with_tables("chat"), with_tables("traj"), with_tables("meta")
DECLARED = ["view", "click", "purchase", "signup"]
_DECLARED = "('view', 'click', 'purchase', 'signup')"
_TERMINAL = ".!?\"''`)]}:;$*_%…»。？！"


@query(
    "ver_01_parse",
    """WITH r AS (SELECT event_id AS line, CASE WHEN event_id % 11 = 0 THEN '{bad' WHEN event_id % 7 = 0 THEN '[1]' WHEN event_id % 5 = 0 THEN '{"messages":[]}' WHEN event_id % 3 = 0 THEN '{"messages":[1]}' ELSE '{"messages":[{"role":"user"}]}' END AS k FROM events)
SELECT 'parse' AS rule, line, CASE k WHEN '{bad' THEN 'invalid_json' WHEN '[1]' THEN 'not_object' WHEN '{"messages":[]}' THEN 'no_messages' ELSE 'bad_message' END AS detail FROM r WHERE k <> '{"messages":[{"role":"user"}]}'""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    e = F.col("event_id")
    raw = (
        F.when(e % 11 == 0, "{bad").when(e % 7 == 0, "[1]").when(e % 5 == 0, '{"messages":[]}').when(e % 3 == 0, '{"messages":[1]}').otherwise('{"messages":[{"role":"user"}]}')
    )
    return V.rule_parse(load(spark, sf, "events").select(e.alias("line"), raw.alias("raw")))


_ROLES_SQL = """, a AS (SELECT line, count(*) FILTER (role = 'system') AS s, arg_min(role, pos) AS f, arg_max(role, pos) AS l, count(*) FILTER (role = 'user') AS u, count(*) FILTER (role = 'assistant') AS a FROM chat GROUP BY line),
roles AS (SELECT 'role_sequence' AS rule, line, 'system_count' AS detail FROM a WHERE s <> 1
UNION ALL SELECT 'role_sequence', line, 'system_not_first' FROM a WHERE s = 1 AND f <> 'system'
UNION ALL SELECT 'role_sequence', line, 'no_user' FROM a WHERE u = 0
UNION ALL SELECT 'role_sequence', line, 'no_assistant' FROM a WHERE a = 0
UNION ALL SELECT 'role_sequence', line, 'not_ending_on_assistant' FROM a WHERE l <> 'assistant'
UNION ALL SELECT 'role_sequence', line, 'adjacent_assistants' FROM (SELECT line, role, lag(role) OVER (PARTITION BY line ORDER BY pos) AS p FROM chat) WHERE role = 'assistant' AND p = 'assistant')"""
_MASKS_SQL = """, masks AS (SELECT 'masks' AS rule, line, d || ':' || pos AS detail FROM (SELECT *, CASE WHEN weight IS NULL THEN 'missing' WHEN role = 'assistant' AND weight <= 0 THEN 'masked_out' WHEN role <> 'assistant' AND weight <> 0 THEN 'mask_leak' END AS d FROM chat) WHERE d IS NOT NULL)"""
_CONTENT_SQL = f""", t AS (SELECT *, rtrim(content, ' ' || chr(9) || chr(10) || chr(13)) AS w FROM chat WHERE role = 'assistant'),
content AS (SELECT 'content' AS rule, line, d || ':' || pos AS detail FROM (SELECT *, CASE WHEN coalesce(w, '') = '' THEN 'empty' WHEN ((length(w) - length(replace(w, '```', ''))) // 3) % 2 = 1 THEN 'unclosed_code_fence'
 WHEN ((length(w) - length(replace(w, '**', ''))) // 2) % 2 = 1 THEN 'unbalanced_bold_emphasis' WHEN NOT contains('{_TERMINAL}', right(w, 1)) THEN 'no_terminal_punctuation' END AS d FROM t) WHERE d IS NOT NULL)"""
_CAPS_SQL = """, z AS (SELECT line, count(*) AS n, sum(length(coalesce(content, ''))) // 4 AS t FROM chat GROUP BY line),
caps AS (SELECT 'caps' AS rule, line, 'messages' AS detail FROM z WHERE n > 6 UNION ALL SELECT 'caps', line, 'tokens' FROM z WHERE t > 1500)"""
_DUP_SQL = """, raw AS (SELECT line, string_agg(pos || role || coalesce(content, '') || weight, chr(10) ORDER BY pos) AS raw FROM chat GROUP BY line),
dup AS (SELECT 'duplicates' AS rule, min(line) AS line, CAST(count(*) AS VARCHAR) AS detail FROM raw GROUP BY sha256(raw) HAVING count(*) > 1)"""


def raw_lines(chat):  # noqa: ANN001, ANN201
    """One text line per record, as a file would hold it."""
    one = F.struct("pos", F.concat(F.col("pos").cast("string"), F.col("role"), F.coalesce("content", F.lit("")), F.col("weight").cast("string")).alias("t"))
    return chat.groupBy("line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["t"]), "\n").alias("raw"))


@query("ver_02_role_sequence", CHAT + _ROLES_SQL + " SELECT * FROM roles")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_roles(load(spark, sf, "chat"))


def _broken_traj(spark, sf):  # noqa: ANN001, ANN202
    """The trajectories with planted faults of pairing: a user message in place of a result, results without a call, last
    calls without a result, and messages of two calls whose results come in another order."""
    e = F.col("line")
    t = load(spark, sf, "traj")
    t = t.withColumn("role", F.when((e % 37 == 0) & (F.col("pos") == 3), "user").otherwise(F.col("role")))
    t = t.where(~((e % 43 == 0) & (e % 37 != 0) & (e % 29 != 0) & (e % 41 != 0) & F.col("pos").isin(3, 4)))
    extra = t.where((e % 41 == 0) & (F.col("pos") == 2)).withColumns({"pos": F.lit(5), "role": F.lit("tool")})
    pairs = load(spark, sf, "conversations").groupBy(F.col("conv_id").alias("line")).agg(F.min("turn").alias("t")).select((-1 - e).alias("line"))
    rows = [("assistant", 0, 0, "a"), ("assistant", 0, 1, "b"), ("tool", 1, 0, "b"), ("tool", 2, 0, "a"), ("assistant", 3, 0, "c")]
    two = pairs.select("line", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(p).alias("pos"), F.lit(k).alias("call"), F.lit(i).alias("call_id")) for r, p, k, i in rows])).alias("r")).select("line", "r.role", "r.pos", "r.call", "r.call_id")
    cols = ["line", "role", "pos", "call", "call_id"]
    return t.unionByName(extra).withColumn("call", F.lit(0)).select(cols).unionByName(two.select(cols))


@query(
    "ver_03_tool_pairing",
    """SELECT 'tool_pairing' AS rule, event_id AS line, 'pending_at_user' AS detail FROM events WHERE event_id % 37 = 0
UNION ALL SELECT 'tool_pairing', event_id, 'unknown_result' FROM events WHERE event_id % 37 <> 0 AND event_id % 29 = 0
UNION ALL SELECT 'tool_pairing', event_id, 'unanswered' FROM events WHERE event_id % 37 <> 0 AND event_id % 29 = 0 AND event_id % 41 <> 0
UNION ALL SELECT 'tool_pairing', event_id, 'orphan_result' FROM events WHERE event_id % 41 = 0 AND (event_id % 37 = 0 OR event_id % 29 <> 0)
UNION ALL SELECT DISTINCT 'tool_pairing', -1 - conv_id, 'out_of_order' FROM conversations""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_tool_pairing(_broken_traj(spark, sf))


@query(
    "ver_04_tool_struct",
    TRAJ
    + f""" SELECT 'tool_struct' AS rule, line, 'undeclared_tool' AS detail FROM traj WHERE role = 'assistant' AND tool_name IS NOT NULL AND tool_name NOT IN {_DECLARED}
UNION ALL SELECT 'tool_struct', line, 'bad_arguments' FROM traj WHERE role = 'assistant' AND call_id IS NOT NULL AND (NOT json_valid(args) OR json_type(CASE WHEN json_valid(args) THEN args ELSE '1' END) <> 'OBJECT')
UNION ALL SELECT 'tool_struct', line, 'not_function' FROM traj WHERE role = 'assistant' AND call_id IS NOT NULL AND line % 47 = 0""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_tool_struct(load(spark, sf, "traj").withColumn("call_type", F.when(F.col("line") % 47 != 0, "function")), DECLARED)


@query("ver_05_weights", "WITH w AS (SELECT o_orderkey AS line, CASE WHEN o_orderkey % 12 = 7 THEN NULL WHEN o_orderkey % 12 < 2 THEN 'x' ELSE CAST(o_orderkey % 12 - 3 AS VARCHAR) END AS w FROM orders) SELECT 'weights' AS rule, line, CASE WHEN w IS NULL THEN 'missing' WHEN w = 'x' THEN 'not_numeric' ELSE 'not_positive' END AS detail FROM w WHERE w IS NULL OR w IN ('x', '-1', '0')")
def _(spark, sf):  # noqa: ANN001, ANN202
    k = F.col("o_orderkey") % 12
    text = F.when(k == 7, None).when(k == 0, "true").when(k == 1, '"2"').otherwise((k - 3).cast("string"))
    return V.rule_weights(load(spark, sf, "orders").select(F.col("o_orderkey").alias("line"), F.parse_json(text).alias("weight")))


@query("ver_05_weights_of_numbers", META + " SELECT 'weights' AS rule, line, CASE WHEN weight IS NULL THEN 'missing' WHEN weight <= 0 THEN 'not_positive' ELSE 'too_large' END AS detail FROM meta WHERE weight IS NULL OR weight <= 0 OR weight > 10")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_weights(load(spark, sf, "meta"))


@query("ver_06_masks", CHAT + _MASKS_SQL + " SELECT * FROM masks")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_masks(load(spark, sf, "chat"))


@query("ver_07_content", CHAT + _CONTENT_SQL + " SELECT * FROM content")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_content(load(spark, sf, "chat"))


@query(
    "ver_08_caps",
    CHAT + _CAPS_SQL + """ SELECT * FROM caps UNION ALL SELECT 'caps', line, 'calls:' || pos FROM chat WHERE role = 'assistant' AND line % 20 > 16
UNION ALL SELECT 'caps', line, 'tools' FROM chat WHERE line % 70 > 64 GROUP BY line""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    chat = load(spark, sf, "chat")
    many = lambda n: F.explode(F.sequence(F.lit(0), F.col("line") % n)).alias("k")
    calls = chat.where("role = 'assistant'").select("line", "pos", many(20)).where("k > 0")
    tools = chat.select("line").distinct().select("line", many(70)).where("k > 0").withColumnRenamed("k", "tool")
    return V.rule_caps(chat, calls, tools, messages=6, tokens=1500)


@query(
    "ver_09_grounding",
    TRAJ
    + """, n AS (SELECT line, role, unnest(regexp_extract_all(coalesce(content, ''), '[0-9]+(?:\\.[0-9]+)?')) AS c FROM traj), a AS (SELECT line, unnest(regexp_extract_all(coalesce(args, ''), '[0-9]+(?:\\.[0-9]+)?')) AS c FROM traj),
g AS (SELECT line, c FROM n WHERE role <> 'assistant' UNION SELECT line, c FROM a),
u AS (SELECT DISTINCT line, c FROM n WHERE line % 2 = 0 AND role = 'assistant' AND (contains(c, '.') OR length(c) >= 3) AND NOT EXISTS (SELECT 1 FROM g WHERE g.line = n.line AND g.c = n.c))
SELECT 'grounding' AS rule, line, string_agg(c, ',' ORDER BY c) AS detail FROM u GROUP BY line""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    traj = load(spark, sf, "traj")
    return V.rule_grounding(traj, traj.where("line % 2 = 0 and pos = 0").select("line"))


@query(
    "ver_10_probe_markers",
    r"""SELECT 'probe_markers' AS rule, doc_id AS line, 'canary' AS detail FROM (SELECT doc_id, text || CASE WHEN doc_id % 50 = 0 THEN ' Do not train' ELSE '' END AS t FROM documents) WHERE regexp_matches(t, '(?i)do[ _\t-]*not[ _\t-]*train|held[ _\t-]out|probe[ _\t-]only|canary[ _\t-]?string')
UNION ALL SELECT 'probe_markers', doc_id, 'key:' || CASE WHEN doc_id % 40 = 0 THEN '__Is_Probe' ELSE 'split' END FROM documents WHERE doc_id % 40 < 2""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    planted = F.concat("text", F.when(F.col("doc_id") % 50 == 0, " Do not train").otherwise(""))
    key = F.when(F.col("doc_id") % 40 == 0, "__Is_Probe").when(F.col("doc_id") % 40 == 1, "split").otherwise("messages")
    return V.rule_probe_markers(load(spark, sf, "documents").select(F.col("doc_id").alias("line"), planted.alias("content"), F.array(F.lit("tools"), key).alias("keys")), keys_col="keys")


@query("ver_11_duplicates", "SELECT 'duplicates' AS rule, min(doc_id) AS line, CAST(count(*) AS VARCHAR) AS detail FROM documents GROUP BY sha256(text) HAVING count(*) > 1")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_duplicates(load(spark, sf, "documents").select(F.col("doc_id").alias("line"), F.col("text").alias("raw")))


@query(
    "ver_12_manifest",
    """WITH c AS (SELECT doc_id AS line, sha256(text) AS c FROM documents WHERE doc_id % 41 <> 0), m AS (SELECT doc_id AS line, CASE WHEN doc_id % 37 = 0 THEN 'x' ELSE sha256(text) END AS m FROM documents WHERE doc_id % 43 <> 0)
SELECT 'manifest' AS rule, line, d AS detail FROM (SELECT coalesce(c.line, m.line) AS line, CASE WHEN c IS NULL THEN 'not_in_corpus' WHEN m IS NULL THEN 'not_in_manifest' WHEN c <> m THEN 'hash_differs' END AS d FROM c FULL JOIN m ON c.line = m.line) WHERE d IS NOT NULL""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "documents").select(F.col("doc_id").alias("line"), F.sha2("text", 256).alias("sha"))
    meta = rows.where("line % 43 <> 0").withColumn("sha", F.when(F.col("line") % 37 == 0, "x").otherwise(F.col("sha")))
    return V.rule_manifest(rows.where("line % 41 <> 0"), meta)


@query("ver_12_manifest_state", "SELECT count(*) FILTER (doc_id % 41 <> 0) AS rows, count(*) FILTER (doc_id % 43 <> 0) AS declared, count(*) FILTER ((doc_id % 41 = 0) <> (doc_id % 43 = 0)) AS faults, 'fail' AS verdict FROM documents UNION ALL SELECT count(*), 0, 0, 'not_run' FROM documents UNION ALL SELECT count(*), 0, 0, 'suspect' FROM documents")
def _(spark, sf):  # noqa: ANN001, ANN202
    rows = load(spark, sf, "documents").select(F.col("doc_id").alias("line"), F.sha2("text", 256).alias("sha"))
    whole = V.manifest_state(rows.where("line % 41 <> 0"), rows.where("line % 43 <> 0"))
    return whole.unionByName(V.manifest_state(rows, None)).unionByName(V.manifest_state(rows, None, required=True))


_SQUASH = "lower(trim(regexp_replace({}, '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g')))"


@query(
    "ver_13_contamination",
    f"SELECT 'contamination' AS rule, doc_id AS line, 'probe_prompt' AS detail FROM documents WHERE doc_id % 2 = 1 AND {_SQUASH.format('text')} IN (SELECT {_SQUASH.format('text')} FROM documents WHERE doc_id % 2 = 0)",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    docs = load(spark, sf, "documents").select(F.col("doc_id").alias("line"), "text")
    return V.rule_contamination(docs.where("line % 2 = 1"), docs.where("line % 2 = 0"))


RULES = ["role_sequence", "masks", "content", "caps", "duplicates", "probe_markers", "contamination", "manifest"]


def verify_corpus(spark, sf):  # noqa: ANN001, ANN201
    chat = load(spark, sf, "chat")
    raw = raw_lines(chat)
    parts = [V.rule_roles(chat), V.rule_masks(chat), V.rule_content(chat), V.rule_caps(chat, messages=6, tokens=1500), V.rule_duplicates(raw)]
    users = chat.where("role = 'user'").select("line", F.col("content").alias("text"))
    parts += [V.rule_probe_markers(chat), V.rule_contamination(users.where("line < 1000000"), users.where("line >= 1000000"))]
    sums = raw.select("line", F.sha2("raw", 256).alias("sha"))
    parts.append(V.rule_manifest(sums, sums.where("line % 11 <> 0")))
    return V.report(V.union(*parts), RULES, chat)


_KEY = "lower(trim(regexp_replace(content, '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g')))"
_REST_SQL = f""", probe AS (SELECT 'probe_markers' AS rule, line, 'canary' AS detail FROM chat WHERE regexp_matches(content, '(?i)do[ _\\t-]*not[ _\\t-]*train|held[ _\\t-]out|probe[ _\\t-]only|canary[ _\\t-]?string')),
cont AS (SELECT 'contamination' AS rule, line, 'probe_prompt' AS detail FROM chat WHERE role = 'user' AND line < 1000000 AND {_KEY} IN (SELECT {_KEY} FROM chat WHERE role = 'user' AND line >= 1000000)),
mani AS (SELECT DISTINCT 'manifest' AS rule, line, 'not_in_manifest' AS detail FROM chat WHERE line % 11 = 0)"""
ALL_RULES_SQL = _ROLES_SQL + _MASKS_SQL + _CONTENT_SQL + _CAPS_SQL + _DUP_SQL + _REST_SQL + ", v AS (" + " UNION ALL ".join(f"SELECT * FROM {x}" for x in ("roles", "masks", "content", "caps", "dup", "probe", "cont", "mani")) + ")"
query(
    "ver_14_report",
    CHAT
    + ALL_RULES_SQL
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY line, detail) AS k FROM v), n(rule) AS (VALUES ('role_sequence'), ('masks'), ('content'), ('caps'), ('duplicates'), ('probe_markers'), ('contamination'), ('manifest'))
SELECT n.rule, count(k.rule) AS violations, count(DISTINCT line) AS lines, coalesce(string_agg(line, ',' ORDER BY k) FILTER (k <= 20), '') AS first_lines, CASE WHEN count(k.rule) > 0 THEN 'fail' ELSE 'pass' END AS verdict
FROM n LEFT JOIN k ON k.rule = n.rule GROUP BY n.rule""",
)(verify_corpus)


def whole_corpus(spark, sf):  # noqa: ANN001, ANN201
    """Chat records, and tool trajectories behind them, with a weight for each record."""
    k = F.col("line") % 14
    both = load(spark, sf, "chat").unionByName(load(spark, sf, "traj").withColumn("line", F.col("line") + 10_000_000), allowMissingColumns=True)
    return both.withColumn("record_weight", F.when(k != 5, (k - 1).cast("double")))


def whole_pass(spark, sf):  # noqa: ANN001, ANN201
    return VP.keep(VP.digest(whole_corpus(spark, sf), DECLARED, messages_cap=6, tokens_cap=1500))


_WHOLE = (
    f"WITH chat0 AS ({FIXTURES['chat'].strip()}), traj AS ({FIXTURES['traj'].strip()}), chat AS (SELECT line, pos, role, content, weight, NULL AS call_id, NULL AS tool_name, NULL AS args FROM chat0 UNION ALL SELECT line + 10000000, pos, role, content, weight, call_id, tool_name, args FROM traj)"
    + _ROLES_SQL + _MASKS_SQL + _CONTENT_SQL.replace("WHEN coalesce(w, '') = '' THEN 'empty'", "WHEN coalesce(w, '') = '' AND call_id IS NOT NULL THEN NULL WHEN coalesce(w, '') = '' THEN 'empty'") + _CAPS_SQL
    + _DUP_SQL.replace("|| weight,", "|| weight || coalesce(call_id, '') || coalesce(tool_name, '') || coalesce(args, ''),")
    + _REST_SQL
    + f""", pairing AS (SELECT 'tool_pairing' AS rule, 10000000 + event_id AS line, d AS detail FROM events, (VALUES ('unknown_result'), ('unanswered')) v(d) WHERE event_id % 29 = 0),
struct AS (SELECT 'tool_struct' AS rule, line, 'undeclared_tool' AS detail FROM chat WHERE role = 'assistant' AND tool_name IS NOT NULL AND tool_name NOT IN {_DECLARED}
UNION ALL SELECT 'tool_struct', line, 'bad_arguments' FROM chat WHERE role = 'assistant' AND call_id IS NOT NULL AND (NOT json_valid(args) OR json_type(CASE WHEN json_valid(args) THEN args ELSE '1' END) <> 'OBJECT')),
weights AS (SELECT DISTINCT 'weights' AS rule, line, CASE WHEN line % 14 = 5 THEN 'missing' WHEN line % 14 < 2 THEN 'not_positive' ELSE 'too_large' END AS detail FROM chat WHERE line % 14 IN (0, 1, 5, 12, 13)),
num AS (SELECT line, role, unnest(regexp_extract_all(coalesce(content, ''), '[0-9]+(?:\\.[0-9]+)?')) AS c FROM traj), arg AS (SELECT line, unnest(regexp_extract_all(coalesce(args, ''), '[0-9]+(?:\\.[0-9]+)?')) AS c FROM traj),
giv AS (SELECT line, c FROM num WHERE role <> 'assistant' UNION SELECT line, c FROM arg), sig AS (SELECT DISTINCT line, c FROM num WHERE role = 'assistant' AND (contains(c, '.') OR length(c) >= 3)),
ground AS (SELECT 'grounding' AS rule, line + 10000000 AS line, string_agg(c, ',' ORDER BY c) AS detail FROM sig WHERE NOT EXISTS (SELECT 1 FROM giv WHERE giv.line = sig.line AND giv.c = sig.c) GROUP BY line),
v AS (""" + " UNION ALL ".join(f"SELECT * FROM {x}" for x in ("roles", "pairing", "struct", "weights", "masks", "content", "caps", "ground", "dup", "probe", "cont", "mani")) + ")"
)
query(
    "ver_14_whole_report",
    _WHOLE
    + f""", k AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY line, detail) AS k FROM v), n(rule) AS (VALUES {", ".join(f"('{r}')" for r in VP.RULES)})
SELECT n.rule, count(k.rule) AS violations, count(DISTINCT line) AS lines, coalesce(string_agg(line, ',' ORDER BY k) FILTER (k <= 20), '') AS first_lines, CASE WHEN n.rule = 'parse' THEN 'not_run' WHEN count(k.rule) > 0 THEN 'fail' ELSE 'pass' END AS verdict,
(SELECT count(DISTINCT line) FROM chat) AS checked, 1.0 AS coverage FROM n LEFT JOIN k ON k.rule = n.rule GROUP BY n.rule""",
)(lambda spark, sf: _whole_report(spark, sf))


def _whole_report(spark, sf):  # noqa: ANN001, ANN202
    records = whole_pass(spark, sf)
    # probes are prompts of the copies; only originals are held against them
    probes = records.where("line between 1000000 and 9999999").select(F.explode("prompts").alias("h"))
    own = records.withColumn("prompts", F.when(F.col("line") < 1_000_000, F.col("prompts")).otherwise(F.array().cast("array<string>")))
    return VP.report(own, None, probes, records.where("line % 11 <> 0").select("line", "sha"))


query(
    "ver_14_lanes",
    _WHOLE
    + """, size AS (SELECT line, sum(length(coalesce(content, ''))) // 4 AS t FROM chat GROUP BY line)
SELECT lane, count(*) AS records, CAST(sum(coalesce(n, 0)) AS BIGINT) AS numbers_checked, 0 AS ends_on_call, CASE WHEN lane = 'grounded' THEN (SELECT count(DISTINCT tool_name) FROM traj) ELSE 0 END AS tools, CAST(sum(t) AS BIGINT) AS tokens
FROM (SELECT line, CASE WHEN line >= 10000000 THEN 'grounded' ELSE 'ungrounded' END AS lane, t, n FROM size LEFT JOIN (SELECT line + 10000000 AS line, count(*) AS n FROM num WHERE role = 'assistant' AND (contains(c, '.') OR length(c) >= 3) GROUP BY ALL) USING (line)) GROUP BY lane""",
)(lambda spark, sf: VP.lanes(whole_pass(spark, sf)))


@query(
    "ver_14_corpus_stats",
    CHAT
    + f""", s AS (SELECT line, count(*) AS n, sum(length(coalesce(content, ''))) // 4 AS t FROM chat GROUP BY line), r AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS k FROM s),
p AS (SELECT line, arg_min(content, pos) AS content FROM chat WHERE role = 'user' GROUP BY line), d AS (SELECT count(*) - count(DISTINCT {_KEY}) AS d FROM p)
SELECT count(*) AS records, CAST(sum(n) AS BIGINT) AS messages, min(t) AS tokens_min, max(t) AS tokens_max, CAST(sum(t) AS BIGINT) AS tokens_total, (SELECT count(*) FROM chat WHERE weight > 0) AS weighted, (SELECT count(*) FROM chat WHERE weight = 0) AS masked, (SELECT d FROM d) AS duplicate_prompts, (SELECT t FROM r WHERE k = (SELECT count(*) // 2 FROM s)) AS tokens_median FROM s""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.corpus_stats(load(spark, sf, "chat"))


@query("top_02_sample_violations", CHAT + _MASKS_SQL + " SELECT rule, line, detail, total FROM (SELECT *, count(*) OVER (PARTITION BY rule) AS total, row_number() OVER (PARTITION BY rule ORDER BY line, detail) AS k FROM masks) WHERE k <= 20")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.sample_violations(V.rule_masks(load(spark, sf, "chat")), 20)


@query("agg_27_weight_distribution", CHAT + " SELECT role, CAST(weight AS DOUBLE) AS weight, count(*) AS messages FROM chat GROUP BY ALL")
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.weight_distribution(load(spark, sf, "chat"))


@query("ren_01_mask_convention", CHAT + " SELECT line, CASE WHEN count(w) = count(*) THEN 'explicit' WHEN count(w) = 0 THEN 'implicit' ELSE 'partial' END AS convention FROM (SELECT *, CASE WHEN line % 3 = 0 OR (line % 3 = 1 AND pos = 1) THEN NULL ELSE weight END AS w FROM chat) GROUP BY line")
def _(spark, sf):  # noqa: ANN001, ANN202
    hidden = F.when((F.col("line") % 3 == 0) | ((F.col("line") % 3 == 1) & (F.col("pos") == 1)), None).otherwise(F.col("weight"))
    return V.mask_convention(load(spark, sf, "chat").withColumn("weight", hidden))


@query(
    "ren_02_render",
    CHAT
    + """, c AS (SELECT *, length(coalesce(content, '')) AS n, role = 'assistant' AND weight > 0 AS t FROM chat)
SELECT 'render' AS rule, line, 'mask_leak:' || pos AS detail FROM c WHERE role <> 'assistant' AND weight <> 0 UNION ALL SELECT 'render', line, 'empty_target:' || pos FROM c WHERE t AND n = 0
UNION ALL SELECT 'render', line, 'short_target:' || pos FROM c WHERE t AND n > 0 AND n <= 4 UNION ALL SELECT 'render', line, 'no_target' FROM c GROUP BY line HAVING count(*) FILTER (t) = 0 UNION ALL SELECT DISTINCT 'render', line, 'record_weight_0' FROM c WHERE line % 13 = 0""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_render(load(spark, sf, "chat").withColumn("record_weight", F.when(F.col("line") % 13 == 0, 0.0).otherwise(1.0)))


@query(
    "ren_03_render_tools",
    TRAJ
    + f""" SELECT 'render_tools' AS rule, line, 'result_without_call:' || pos AS detail FROM traj t WHERE role = 'tool' AND NOT EXISTS (SELECT 1 FROM traj a WHERE a.line = t.line AND a.role = 'assistant' AND a.pos < t.pos AND a.call_id = t.call_id)
UNION ALL SELECT 'render_tools', line, 'undeclared_tool:' || pos FROM traj WHERE role = 'assistant' AND tool_name IS NOT NULL AND tool_name NOT IN {_DECLARED}""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.rule_render_tools(load(spark, sf, "traj"), DECLARED)


@query(
    "ren_04_loss_share",
    CHAT
    + """, s AS (SELECT line, sum(length(coalesce(content, ''))) AS n, sum(CASE WHEN role = 'assistant' AND weight > 0 THEN length(coalesce(content, '')) ELSE 0 END) AS l FROM chat GROUP BY line)
SELECT count(*) AS records, round_even(sum(l) / sum(n), 4) AS share, min(round_even(l / n, 4)) AS share_min, max(round_even(l / n, 4)) AS share_max, (SELECT x FROM (SELECT round_even(l / n, 4) AS x, row_number() OVER (ORDER BY l / n) - 1 AS k FROM s WHERE n > 0) WHERE k = (SELECT count(*) // 2 FROM s WHERE n > 0)) AS share_median,
CASE WHEN sum(l) = 0 THEN 'fail' WHEN min(round_even(l / n, 4)) = 0 THEN 'suspect' ELSE 'pass' END AS verdict FROM s""",
)
def _(spark, sf):  # noqa: ANN001, ANN202
    return V.loss_share(load(spark, sf, "chat"))
