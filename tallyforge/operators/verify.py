"""The corpus verifier: rules over chat records, each a violations table ``rule, line, detail``.

Messages are rows ``line, pos, role, content, weight`` (tool trajectories also ``call_id, tool_name, args``). Every rule is a
filter, a window per record or an aggregate per record; a record's messages are bounded by its caps, so no rule gathers
more than one record in a place. ``report`` turns violations to counts and a verdict; nothing to check is suspect.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T

#: Roles, and the most messages, calls, tools, estimated tokens and weight of a record.
LEGAL_ROLES = ["system", "user", "assistant", "tool"]
CAP_MESSAGES, CAP_CALLS, CAP_TOOLS, CAP_TOKENS = 64, 16, 64, 32_768
WEIGHT_MAX = 10.0
#: Keys and phrases that label held-out probes.
PROBE_KEYS = ["probe", "is_probe", "holdout", "is_holdout", "held_out", "split", "eval", "is_eval", "do_not_train"]
PROBE_CANARY = r"(?i)do[ _\t-]*not[ _\t-]*train|held[ _\t-]out|probe[ _\t-]only|canary[ _\t-]?string"


def _out(df: DataFrame, rule: str, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.col("line").cast("long").alias("line"), detail.alias("detail"))


def rule_parse(raw: DataFrame) -> DataFrame:
    """Rows ``line, raw``: invalid JSON, no object, no message list, or a message that is no object."""
    v = F.try_parse_json("raw")
    kind = F.when(v.isNull(), "invalid_json").when(~F.schema_of_variant(v).startswith("OBJECT"), "not_object")
    messages = F.try_variant_get(v, "$.messages", "array<variant>")
    kind = kind.when(messages.isNull() | (F.size(messages) == 0), "no_messages").when(
        F.exists(messages, lambda m: ~F.schema_of_variant(m).startswith("OBJECT")), "bad_message"
    )
    return _out(raw.withColumn("k", kind).where("k is not null"), "parse", F.col("k"))


def rule_roles(chat: DataFrame) -> DataFrame:
    """Illegal role; not exactly one system message, first; no user; no assistant; not ending on assistant; two assistants in a row."""
    w = Window.partitionBy("line").orderBy("pos")
    each = chat.withColumn("prev", F.lag("role").over(w))
    two = each.where("role = 'assistant' and prev = 'assistant'")
    of = chat.groupBy("line").agg(
        F.count_if(F.col("role") == "system").alias("systems"),
        F.min_by("role", "pos").alias("first"),
        F.max_by("role", "pos").alias("last"),
        F.count_if(F.col("role") == "user").alias("users"),
        F.count_if(F.col("role") == "assistant").alias("assistants"),
        F.count_if(~F.coalesce(F.col("role").isin(LEGAL_ROLES), F.lit(False))).alias("illegal"),
    )
    tests = [
        ("illegal_role", F.col("illegal") > 0),
        ("system_count", F.col("systems") != 1),
        ("system_not_first", (F.col("systems") == 1) & (F.col("first") != "system")),
        ("no_user", F.col("users") == 0),
        ("no_assistant", F.col("assistants") == 0),
        ("not_ending_on_assistant", F.col("last") != "assistant"),
    ]
    codes = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests])))
    return _out(of.withColumn("d", codes), "role_sequence", F.col("d")).unionByName(_out(two, "role_sequence", F.lit("adjacent_assistants")))


def rule_tool_pairing(traj: DataFrame) -> DataFrame:
    """Calls must be answered in order by tool messages: an orphan, unknown or misordered answer, new calls or a user or
    system message while answers are pending (which are dropped then), and calls left unanswered that are not the
    record's last message. An unanswered last message is the record's label and stands. A message with several calls is
    several rows of one ``pos``, in the order of ``call`` where there is such a column."""
    index = F.col("call") if "call" in traj.columns else F.lit(0)
    ordered = F.array_sort(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), index.alias("call"), "role", "call_id")))
    errors = pairing_errors(F.col("m"))
    return _out(traj.groupBy("line").agg(ordered.alias("m")).withColumn("d", F.explode(errors)), "tool_pairing", F.col("d"))


def pairing_errors(messages: Column) -> Column:
    """The pairing faults of one record, from its ordered messages: structs with ``pos, role, call_id``."""
    none = F.array().cast("array<string>")
    state = F.struct(none.alias("pending"), F.lit(-1).alias("owner"), none.alias("errors"))

    def step(s: Column, m: Column) -> Column:
        pending, errors = s["pending"], s["errors"]
        waiting = F.size(pending) > 0
        calls = (m["role"] == "assistant") & m["call_id"].isNotNull()
        again = calls & (m["pos"] == s["owner"])
        answer = m["role"] == "tool"
        known = F.coalesce(F.array_contains(pending, m["call_id"]), F.lit(False))
        speaks = m["role"].isin("user", "system")
        err = (
            F.when(answer & ~waiting, "orphan_result")
            .when(answer & ~known, "unknown_result")
            .when(answer & (F.try_element_at(pending, F.lit(1)) != m["call_id"]), "out_of_order")
            .when(calls & ~again & waiting, "pending_at_assistant")
            .when(speaks & waiting, F.concat(F.lit("pending_at_"), m["role"]))
        )
        place = F.array_position(pending, m["call_id"]).cast("int")
        rest = F.concat(F.slice(pending, F.lit(1), F.greatest(place - 1, F.lit(0))), F.slice(pending, F.greatest(place, F.lit(0)) + 1, F.size(pending)))
        after = (
            F.when(answer & known, rest)
            .when(again, F.concat(pending, F.array(m["call_id"])))
            .when(calls, F.array(m["call_id"]))
            .when(speaks, none)
            .otherwise(pending)
        )
        said = T.let(err, lambda e: F.when(e.isNotNull(), F.concat(errors, F.array(e))).otherwise(errors))
        return F.struct(after.alias("pending"), F.when(calls, m["pos"]).otherwise(s["owner"]).alias("owner"), said.alias("errors"))

    def close(s: Column) -> Column:
        left = (F.size(s["pending"]) > 0) & (s["owner"] != F.element_at(messages, -1)["pos"])
        return F.when(left, F.concat(s["errors"], F.array(F.lit("unanswered")))).otherwise(s["errors"])

    return F.aggregate(messages, state, step, close)


def rule_tool_struct(traj: DataFrame, declared: list[str]) -> DataFrame:
    """Call id present and unique in its record, type ``function`` (where there is a column ``call_type``), declared name,
    arguments a JSON object in a string."""
    kind = F.coalesce(F.col("call_type") != "function", F.lit(True)) if "call_type" in traj.columns else F.lit(False)
    calls = traj.where("role = 'assistant' and (call_id is not null or tool_name is not null or args is not null)")
    w = Window.partitionBy("line", "call_id")
    args = F.try_parse_json("args")
    tests = [
        ("no_id", F.col("call_id").isNull()),
        ("duplicate_id", F.count("*").over(w) > 1),
        ("not_function", kind),
        ("undeclared_tool", ~F.coalesce(F.col("tool_name").isin(declared), F.lit(False))),
        ("bad_arguments", args.isNull() | ~F.schema_of_variant(args).startswith("OBJECT")),
    ]
    codes = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests]))
    return _out(calls.withColumn("codes", codes).withColumn("d", F.explode("codes")), "tool_struct", F.col("d"))


def rule_weights(meta: DataFrame) -> DataFrame:
    """Record weight absent, no number (a boolean or a text, in a variant column too), not positive, or above the maximum."""
    fault = weight_fault(F.col("weight"), dict(meta.dtypes)["weight"])
    return _out(meta.withColumn("d", fault).where("d is not null"), "weights", F.col("d"))


def weight_fault(weight: Column, kind: str) -> Column:
    """What is wrong with a record's weight, null if nothing; ``kind`` is the column's type."""
    other = F.lit(kind in ("boolean", "string"))
    w = weight.cast("double") if kind != "variant" else F.try_variant_get(weight, "$", "double")
    if kind == "variant":
        other = F.schema_of_variant(weight).isin("BOOLEAN", "STRING") | F.schema_of_variant(weight).rlike("^(OBJECT|ARRAY)")
    return F.when(weight.isNotNull() & other, "not_numeric").when(w.isNull() | F.isnan(w), "missing").when(w <= 0, "not_positive").when(w > WEIGHT_MAX, "too_large")


def rule_masks(chat: DataFrame) -> DataFrame:
    """Every message needs a numeric weight; assistants above 0, all others exactly 0."""
    w = F.col("weight").cast("double")
    d = F.when(w.isNull(), "missing").when((F.col("role") == "assistant") & (w <= 0), "masked_out").when((F.col("role") != "assistant") & (w != 0), "mask_leak")
    return _out(chat.withColumn("d", d).where("d is not null"), "masks", F.concat_ws(":", F.col("d"), F.col("pos").cast("string")))


def rule_content(chat: DataFrame, calls: Column | None = None) -> DataFrame:
    """Assistant content null or blank without tool calls, else its truncation signal."""
    blank = F.col("content").isNull() | (T.squash(F.col("content")) == "")
    has_calls = calls if calls is not None else F.lit(False)
    d = F.when(blank & has_calls, None).when(blank, "empty").otherwise(T.truncation_signal(F.col("content")))
    return _out(chat.where("role = 'assistant'").withColumn("d", d).where("d is not null"), "content", F.concat_ws(":", F.col("d"), F.col("pos").cast("string")))


def rule_caps(chat: DataFrame, calls: DataFrame | None = None, tools: DataFrame | None = None, messages: int = CAP_MESSAGES, tokens: int = CAP_TOKENS, turn_calls: int = CAP_CALLS, record_tools: int = CAP_TOOLS) -> DataFrame:
    """More messages or estimated tokens (characters div 4) than a record may have; more calls in a message (``calls``: a
    row ``line, pos`` per call) or declared tools (``tools``: a row ``line, tool`` each)."""
    of = chat.groupBy("line").agg(F.count("*").alias("n"), F.floor(F.sum(F.length(F.coalesce("content", F.lit("")))) / 4).alias("t"))
    codes = F.explode(F.array_compact(F.array(F.when(F.col("n") > messages, F.lit("messages")), F.when(F.col("t") > tokens, F.lit("tokens")))))
    out = _out(of.withColumn("d", codes), "caps", F.col("d"))
    if calls is not None:
        out = out.unionByName(_out(calls.groupBy("line", "pos").agg(F.count("*").alias("n")).where(F.col("n") > turn_calls), "caps", F.concat(F.lit("calls:"), F.col("pos").cast("string"))))
    if tools is not None:
        out = out.unionByName(_out(tools.groupBy("line").agg(F.countDistinct("tool").alias("n")).where(F.col("n") > record_tools), "caps", F.lit("tools")))
    return out


def rule_grounding(traj: DataFrame, tooled: DataFrame | None = None) -> DataFrame:
    """Significant numbers of assistant text that occur in no system, user or tool text nor call argument of the record.
    Only records with tools (``tooled``: their ``line``; all if not given) are held to it."""
    traj = traj if tooled is None else traj.join(tooled.select("line").distinct(), "line", "left_semi")
    numbers = traj.select("line", "role", T.significant_numbers(F.coalesce("content", F.lit(""))).alias("c"), T.significant_numbers(F.coalesce("args", F.lit(""))).alias("a"))
    own = F.when(F.col("role") == "assistant", F.col("c")).otherwise(F.array().cast("array<string>"))
    given = F.when(F.col("role") == "assistant", F.col("a")).otherwise(F.concat("c", "a"))
    of = numbers.groupBy("line").agg(F.flatten(F.collect_list(own)).alias("said"), F.flatten(F.collect_list(given)).alias("given"))
    loose = F.array_sort(F.array_except("said", "given"))
    return _out(of.withColumn("x", loose).where("size(x) > 0"), "grounding", F.array_join("x", ","))


def rule_probe_markers(records: DataFrame, text_col: str = "content", keys_col: str | None = None) -> DataFrame:
    """Canary phrases in any content; with ``keys_col`` (an array of a record's keys) also marker keys, in any case and with
    any leading underscores."""
    out = _out(records.where(F.col(text_col).rlike(PROBE_CANARY)), "probe_markers", F.lit("canary"))
    if keys_col is None:
        return out
    keyed = records.withColumn("_key", F.explode(keys_col)).where(F.lower(F.regexp_replace("_key", "^_+", "")).isin(PROBE_KEYS))
    return out.unionByName(_out(keyed, "probe_markers", F.concat(F.lit("key:"), F.col("_key"))))


def rule_duplicates(raw: DataFrame) -> DataFrame:
    """Byte-identical lines: the first line of each, with its copies counted."""
    of = raw.groupBy(F.sha2("raw", 256).alias("h")).agg(F.count("*").alias("n"), F.min("line").alias("line")).where("n > 1")
    return _out(of, "duplicates", F.col("n").cast("string"))


def rule_manifest(corpus: DataFrame, meta: DataFrame) -> DataFrame:
    """``line, sha`` of both sides: lines missing on one side, and unequal hashes."""
    c, m = corpus.select("line", F.col("sha").alias("c")), meta.select("line", F.col("sha").alias("m"))
    d = F.when(F.col("c").isNull(), "not_in_corpus").when(F.col("m").isNull(), "not_in_manifest").when(F.col("c") != F.col("m"), "hash_differs")
    return _out(c.join(m, "line", "full_outer").withColumn("d", d).where("d is not null"), "manifest", F.col("d"))


def manifest_state(corpus: DataFrame, meta: DataFrame | None, required: bool = False) -> DataFrame:
    """One row ``rows, declared, faults, verdict``: without a manifest the check did not run (suspect if one is required);
    unequal row counts or any fault of ``rule_manifest`` fail."""
    size = corpus.agg(F.count("*").alias("rows"))
    if meta is None:
        return size.select("rows", F.lit(0).cast("long").alias("declared"), F.lit(0).cast("long").alias("faults"), F.lit("suspect" if required else "not_run").alias("verdict"))
    declared, faults = meta.agg(F.count("*").alias("declared")), rule_manifest(corpus, meta).agg(F.count("*").alias("faults"))
    bad = (F.col("rows") != F.col("declared")) | (F.col("faults") > 0)
    empty = "suspect" if required else "not_run"
    return size.crossJoin(declared).crossJoin(faults).withColumn("verdict", F.when(F.col("declared") == 0, empty).when(bad, "fail").otherwise("pass"))


def rule_contamination(prompts: DataFrame, probes: DataFrame, text_col: str = "text") -> DataFrame:
    """Prompts whose fingerprint is a probe's. Both sides are hashed and joined on the hash."""
    keys = probes.select(T.prompt_fingerprint(F.col(text_col)).alias("h")).distinct()
    return _out(prompts.withColumn("h", T.prompt_fingerprint(F.col(text_col))).join(keys, "h", "left_semi"), "contamination", F.lit("probe_prompt"))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def report(violations: DataFrame, rules: list[str], records: DataFrame, examples: int = 20) -> DataFrame:
    """Per rule: ``violations, lines, first_lines, verdict``; rules without violations are listed too. ``records`` is the corpus: when it is
    empty every verdict is suspect."""
    spark = violations.sparkSession
    names = spark.createDataFrame([(r,) for r in rules], "rule string")
    counts = violations.groupBy("rule").agg(F.count("*").alias("n"), F.countDistinct("line").alias("l"))
    few = first_of_each(violations, examples).groupBy("rule").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))), lambda x: x["line"].cast("string")), ",").alias("f"))
    of = counts.join(few, "rule")
    size = records.agg(F.count("*").alias("total"))
    return names.join(of, "rule", "left").crossJoin(size).select(
        "rule",
        F.coalesce("n", F.lit(0)).cast("long").alias("violations"),
        F.coalesce("l", F.lit(0)).cast("long").alias("lines"),
        F.coalesce("f", F.lit("")).alias("first_lines"),
        F.when(F.col("total") == 0, "suspect").when(F.col("n") > 0, "fail").otherwise("pass").alias("verdict"),
    )


def first_of_each(violations: DataFrame, n: int) -> DataFrame:
    """The first ``n`` violations of each rule by line, numbered ``k``: first of each of 64 parts of a rule, then of those, so
    a rule that most records break is no single sort."""
    order = ["line", "detail"]
    part = F.pmod(F.xxhash64("line"), F.lit(64))
    some = violations.withColumn("_p", part).withColumn("k", F.row_number().over(Window.partitionBy("rule", "_p").orderBy(*order))).where(F.col("k") <= n).drop("_p")
    return some.withColumn("k", F.row_number().over(Window.partitionBy("rule").orderBy(*order))).where(F.col("k") <= n)


def sample_violations(violations: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` of each rule by line, with the rule's true total."""
    totals = violations.groupBy("rule").agg(F.count("*").alias("total"))
    return first_of_each(violations, n).drop("k").join(totals, "rule").select(*violations.columns, "total")


def corpus_stats(chat: DataFrame) -> DataFrame:
    """Records, messages, weighted and masked messages, prompts (first user messages) that repeat an earlier one, and
    estimated tokens: least, upper median, most and in all. The median is read from a table of distinct token counts."""
    prompts = chat.where("role = 'user'").groupBy("line").agg(F.min_by("content", "pos").alias("p"))
    again = prompts.groupBy(T.prompt_fingerprint(F.coalesce("p", F.lit(""))).alias("h")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_prompts"))
    of = chat.groupBy("line").agg(F.count("*").alias("n"), F.floor(F.sum(F.length(F.coalesce("content", F.lit("")))) / 4).alias("t"))
    total = of.agg(F.count("*").alias("records"), F.sum("n").alias("messages"), F.min("t").alias("tokens_min"), F.max("t").alias("tokens_max"), F.sum("t").alias("tokens_total"))
    masks = chat.agg(F.count_if(F.col("weight") > 0).alias("weighted"), F.count_if(F.coalesce(F.col("weight") == 0, F.lit(True))).alias("masked"))
    spread = of.groupBy("t").agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(Window.orderBy("t"))).crossJoin(total.select("records"))
    median = spread.where(F.col("upto") > F.floor(F.col("records") / 2)).agg(F.min("t").alias("tokens_median"))
    return total.crossJoin(masks).crossJoin(again).crossJoin(median)


def weight_distribution(chat: DataFrame) -> DataFrame:
    return chat.groupBy("role", F.col("weight").cast("double").alias("weight")).agg(F.count("*").alias("messages"))


# --- what a renderer will train on -------------------------------------------------------------------------------


def mask_convention(chat: DataFrame) -> DataFrame:
    """Per record: explicit (all messages weighted), implicit (none), partial."""
    of = chat.groupBy("line").agg(F.count("*").alias("n"), F.count("weight").alias("w"))
    return of.select("line", F.when(F.col("w") == F.col("n"), "explicit").when(F.col("w") == 0, "implicit").otherwise("partial").alias("convention"))


def rule_render(chat: DataFrame) -> DataFrame:
    """Weighted non-assistant, empty or one-token target, a record without any target, a record of weight 0 (where there is
    a column ``record_weight``), negative weights."""
    w = F.col("weight").cast("double")
    target = (F.col("role") == "assistant") & (w > 0)
    size = F.length(F.coalesce("content", F.lit("")))
    tests = [
        ("mask_leak", (F.col("role") != "assistant") & (w != 0)),
        ("empty_target", target & (size == 0)),
        ("short_target", target & (size > 0) & (F.ceil(size / 4) < 2)),
        ("bad_weight", w.isNull() | F.isnan(w) | (w < 0)),
    ]
    codes = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests]))
    each = chat.withColumn("codes", codes).withColumn("d", F.explode("codes"))
    none = chat.groupBy("line").agg(F.count_if(target).alias("t")).where("t = 0")
    out = _out(each, "render", F.concat_ws(":", F.col("d"), F.col("pos").cast("string"))).unionByName(_out(none, "render", F.lit("no_target")))
    if "record_weight" in chat.columns:
        out = out.unionByName(_out(chat.where("record_weight = 0").select("line").distinct(), "render", F.lit("record_weight_0")))
    return out


def rule_render_tools(traj: DataFrame, declared: list[str]) -> DataFrame:
    """A tool result needs a call with its id before it; called names must be declared."""
    w = Window.partitionBy("line").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.collect_set(F.when(F.col("role") == "assistant", F.col("call_id"))).over(w)
    d = (
        F.when((F.col("role") == "tool") & ~F.coalesce(F.array_contains(seen, F.col("call_id")), F.lit(False)), "result_without_call")
        .when((F.col("role") == "assistant") & F.col("tool_name").isNotNull() & ~F.col("tool_name").isin(declared), "undeclared_tool")
    )
    return _out(traj.withColumn("d", d).where("d is not null"), "render_tools", F.concat_ws(":", F.col("d"), F.col("pos").cast("string")))


def loss_share(chat: DataFrame) -> DataFrame:
    """The share of characters that carry loss, at four places: in all, and over records the least, upper median and most; a
    verdict: without records suspect, without any loss fail, with a record of none suspect."""
    size = F.length(F.coalesce("content", F.lit("")))
    loss = F.when((F.col("role") == "assistant") & (F.col("weight") > 0), size).otherwise(0)
    of = chat.groupBy("line").agg(F.sum(size).alias("n"), F.sum(loss).alias("l"))
    share = of.select(T.pct4(F.col("l"), F.col("n")).alias("s"), "n", "l")
    total = share.agg(F.count("*").alias("records"), T.pct4(F.sum("l"), F.sum("n")).alias("share"), F.min("s").alias("share_min"), F.max("s").alias("share_max"))
    known = share.where("s is not null").groupBy("s").agg(F.count("*").alias("c"))  # at most 10001 shares
    spread = known.withColumn("upto", F.sum("c").over(Window.orderBy("s"))).withColumn("all", F.sum("c").over(Window.partitionBy()))
    median = spread.where(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min("s").alias("share_median"))
    verdict = F.when(F.col("records") == 0, "suspect").when(F.coalesce(F.col("share"), F.lit(0.0)) == 0, "fail").when(F.col("share_min") == 0, "suspect").otherwise("pass")
    return total.crossJoin(median).withColumn("verdict", verdict)
