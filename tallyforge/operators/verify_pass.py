"""The whole verifier in one pass over the messages.

All rules that look at one record only are folded over its messages: one shuffle brings a record together, one expression
gives its violations, its lane and its hashes. That digest, small beside the corpus, is written to the shared folder; the
rules that look across records (duplicates, probe contamination, manifest) and the report read it and not the corpus.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators import verify as V
from tallyforge.sources.files import shared_folder

RULES = ["parse", "role_sequence", "tool_pairing", "tool_struct", "weights", "masks", "content", "caps", "grounding", "probe_markers", "duplicates", "contamination", "manifest"]
_FAULT = "array<struct<rule:string,detail:string>>"
_FIELDS = {"pos": "int", "call": "int", "role": "string", "content": "string", "weight": "double", "call_id": "string", "tool_name": "string", "args": "string", "call_type": "string"}


def _faults(rule: str, details: Column) -> Column:
    """An array of details, nulls left out, as faults of a rule."""
    return F.transform(F.array_compact(details), lambda d: F.struct(F.lit(rule).alias("rule"), d.alias("detail"))).cast(_FAULT)


def _at(d: Column, m: Column) -> Column:
    return F.concat_ws(":", d, m["pos"].cast("string"))


def _count(a: Column, test) -> Column:  # noqa: ANN001
    return F.size(F.filter(a, lambda x: F.coalesce(test(x), F.lit(False))))


def _roles(heads: Column) -> Column:
    role = lambda name: (lambda x: x["role"] == name)
    systems = _count(heads, role("system"))
    tests = [
        ("illegal_role", _count(heads, lambda x: ~F.coalesce(x["role"].isin(V.LEGAL_ROLES), F.lit(False))) > 0),
        ("system_count", systems != 1),
        ("system_not_first", (systems == 1) & (F.element_at(heads, 1)["role"] != "system")),
        ("no_user", _count(heads, role("user")) == 0),
        ("no_assistant", _count(heads, role("assistant")) == 0),
        ("not_ending_on_assistant", F.element_at(heads, -1)["role"] != "assistant"),
    ]
    pairs = F.zip_with(heads, F.slice(heads, F.lit(2), F.size(heads)), lambda a, b: F.when((a["role"] == "assistant") & (b["role"] == "assistant"), F.lit("adjacent_assistants")))
    return _faults("role_sequence", F.concat(F.array(*[F.when(c, F.lit(n)) for n, c in tests]), pairs))


def _mask(x: Column) -> Column:
    w = x["weight"]
    d = F.when(w.isNull(), "missing").when((x["role"] == "assistant") & (w <= 0), "masked_out").when((x["role"] != "assistant") & (w != 0), "mask_leak")
    return F.when(d.isNotNull(), _at(d, x))


def _content(x: Column) -> Column:
    """Inside a lambda Spark evaluates an expression as often as it is written, so each text is bound to a name first."""
    calls = x["call_id"].isNotNull() | x["tool_name"].isNotNull()
    of = T.let(
        x["content"].isNull() | ~x["content"].rlike(r"[^ \t\n\r\x0B\f]"),
        lambda blank: F.when(blank & calls, None).when(blank, "empty").otherwise(T.truncation_signal(x["content"])),
    )
    return F.when(x["role"] == "assistant", T.let(of, lambda d: F.when(d.isNotNull(), _at(d, x))))


def _struct(calls: Column, declared: list[str], typed: bool) -> Column:
    def codes(x: Column) -> Column:
        loose = T.let(F.try_parse_json(x["args"]), lambda args: args.isNull() | ~F.schema_of_variant(args).startswith("OBJECT"))
        tests = [
            ("no_id", x["call_id"].isNull()),
            ("duplicate_id", F.size(F.filter(calls, lambda y: y["call_id"].eqNullSafe(x["call_id"]))) > 1),
            ("not_function", F.coalesce(x["call_type"] != "function", F.lit(True)) if typed else F.lit(False)),
            ("undeclared_tool", ~F.coalesce(x["tool_name"].isin(declared), F.lit(False))),
            ("bad_arguments", loose),
        ]
        return F.array(*[F.when(c, F.lit(n)) for n, c in tests])

    return _faults("tool_struct", F.flatten(F.transform(calls, codes)))


def digest(messages: DataFrame, declared: list[str], record_keys: DataFrame | None = None, messages_cap: int = V.CAP_MESSAGES, tokens_cap: int = V.CAP_TOKENS, calls_cap: int = V.CAP_CALLS) -> DataFrame:
    """One row per record: ``line, faults, lane, numbers, ends_on_call, tools, tokens, sha, prompts``.

    ``messages`` has a row for each message, ``line, pos, role, content, weight``, and where there are tools ``call_id,
    tool_name, args`` and maybe ``call_type``, a message of several calls as several rows of one ``pos`` numbered by
    ``call``. A column ``record_weight`` is the record's weight, an array column ``keys`` its fields. Records with calls are
    the grounded lane: numbers of their assistants must occur in what they were given."""
    has = messages.columns
    message = F.struct(*[(F.col(c).cast(t) if c in has else F.lit(0 if c == "call" else None).cast(t)).alias(c) for c, t in _FIELDS.items()])
    more = [F.first("record_weight", True).alias("record_weight")] if "record_weight" in has else []
    more += [F.flatten(F.collect_list("keys")).alias("keys")] if "keys" in has else []
    of = messages.groupBy(F.col("line").cast("long").alias("line")).agg(F.array_sort(F.collect_list(message)).alias("m"), *more)
    m = F.col("m")
    of = of.withColumn("heads", F.filter(m, lambda x, i: (i == 0) | (x["pos"] != F.coalesce(F.try_element_at(m, F.when(i > 0, i))["pos"], F.lit(-1)))))
    of = of.withColumn("calls", F.filter(m, lambda x: (x["role"] == "assistant") & (x["call_id"].isNotNull() | x["tool_name"].isNotNull() | x["args"].isNotNull())))
    heads, calls = F.col("heads"), F.col("calls")
    of = of.withColumn("tokens", F.floor(F.aggregate(heads, F.lit(0).cast("long"), lambda s, x: s + F.length(F.coalesce(x["content"], F.lit("")))) / 4))
    tooled = F.size(calls) > 0
    numbers = lambda x, f: T.significant_numbers(F.coalesce(x[f], F.lit("")))
    said = F.flatten(F.transform(F.filter(heads, lambda x: x["role"] == "assistant"), lambda x: numbers(x, "content")))
    given = F.concat(F.flatten(F.transform(F.filter(heads, lambda x: x["role"] != "assistant"), lambda x: numbers(x, "content"))), F.flatten(F.transform(m, lambda x: numbers(x, "args"))))
    none = F.array().cast("array<string>")
    of = of.withColumn("said", F.when(tooled, said).otherwise(none)).withColumn("loose", F.array_sort(F.array_except("said", F.when(tooled, given).otherwise(none))))
    per_message = F.transform(F.array_distinct(F.transform(calls, lambda x: x["pos"])), lambda p: F.when(F.size(F.filter(calls, lambda x: x["pos"] == p)) > calls_cap, F.concat(F.lit("calls:"), p.cast("string"))))
    caps = F.array(F.when(F.size(heads) > messages_cap, F.lit("messages")), F.when(F.col("tokens") > tokens_cap, F.lit("tokens")))
    parts = [
        _roles(heads),
        _faults("tool_pairing", V.pairing_errors(m)),
        _struct(calls, declared, "call_type" in has),
        _faults("masks", F.transform(heads, _mask)),
        _faults("content", F.transform(heads, _content)),
        _faults("caps", F.concat(caps, per_message)),
        _faults("grounding", F.array(F.when(F.size("loose") > 0, F.array_join("loose", ",")))),
        _faults("probe_markers", F.transform(heads, lambda x: F.when(x["content"].rlike(V.PROBE_CANARY), F.lit("canary")))),
    ]
    if "record_weight" in has:
        parts.append(_faults("weights", F.array(V.weight_fault(F.col("record_weight"), dict(messages.dtypes)["record_weight"]))))
    if "keys" in has:
        marked = F.filter(F.array_distinct("keys"), lambda k: F.lower(F.regexp_replace(k, "^_+", "")).isin(V.PROBE_KEYS))
        parts.append(_faults("probe_markers", F.transform(marked, lambda k: F.concat(F.lit("key:"), k))))
    line = F.transform(m, lambda x: F.concat_ws("\x1f", *[F.coalesce(x[c].cast("string"), F.lit("")) for c in _FIELDS if c != "call"]))
    last = F.element_at(heads, -1)
    return of.select(
        "line",
        F.concat(*parts).alias("faults"),
        F.when(tooled, "grounded").otherwise("ungrounded").alias("lane"),
        F.size("said").alias("numbers"),
        F.coalesce((last["role"] == "assistant") & (last["call_id"].isNotNull() | last["tool_name"].isNotNull()), F.lit(False)).alias("ends_on_call"),
        F.array_distinct(F.array_compact(F.transform(calls, lambda x: x["tool_name"]))).alias("tools"),
        "tokens",
        F.sha2(F.array_join(line, "\x1e"), 256).alias("sha"),
        F.transform(F.filter(heads, lambda x: x["role"] == "user"), lambda x: T.prompt_fingerprint(F.coalesce(x["content"], F.lit("")))).alias("prompts"),
    )


def keep(records: DataFrame) -> DataFrame:
    """The digest as files of the shared folder."""
    path = f"{shared_folder(records.sparkSession)}/verified-{uuid.uuid4().hex}"
    records.write.parquet(path)
    return records.sparkSession.read.schema(records.schema).parquet(path)


def violations(records: DataFrame, raw: DataFrame | None = None, probes: DataFrame | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """``rule, line, detail`` of all rules that can run: ``raw`` (``line, raw``) is parsed, ``probes`` are prompt fingerprints
    (``h``) that no record may hold, ``manifest`` is ``line, sha``."""
    out = records.select(F.explode("faults").alias("f"), "line").select("f.rule", "line", "f.detail")
    again = records.groupBy("sha").agg(F.count("*").alias("n"), F.min("line").alias("line")).where("n > 1")
    out = out.unionByName(again.select(F.lit("duplicates").alias("rule"), "line", F.col("n").cast("string").alias("detail")))
    if raw is not None:
        out = out.unionByName(V.rule_parse(raw))
    if probes is not None:
        held = records.select("line", F.explode("prompts").alias("h")).join(probes.select("h").distinct(), "h", "left_semi")
        out = out.unionByName(held.select(F.lit("contamination").alias("rule"), "line", F.lit("probe_prompt").alias("detail")))
    return out.unionByName(V.rule_manifest(records.select("line", "sha"), manifest)) if manifest is not None else out


def report(records: DataFrame, raw: DataFrame | None = None, probes: DataFrame | None = None, manifest: DataFrame | None = None, weighted: bool = True) -> DataFrame:
    """``V.report`` of all thirteen rules, with ``checked`` (records) and ``coverage`` (of the lines of ``raw``, else of what was
    checked). A rule whose input is not given is ``not_run``; where lines could not be read no rule passes."""
    found = violations(records, raw, probes, manifest)
    off = [r for r, given in (("parse", raw), ("contamination", probes), ("manifest", manifest), ("weights", weighted or None)) if given is None]
    checked = records.agg(F.count("*").alias("checked"))
    lines = raw.agg(F.count("*").alias("_lines")) if raw is not None else checked.select(F.col("checked").alias("_lines"))
    out = V.report(found, RULES, records).crossJoin(checked).crossJoin(lines)  # one row each
    verdict = F.when(F.col("rule").isin(off), "not_run").when((F.col("verdict") == "pass") & (F.col("checked") < F.col("_lines")), "suspect").otherwise(F.col("verdict"))
    return out.withColumn("verdict", verdict).withColumn("coverage", T.pct4(F.col("checked"), F.col("_lines"))).drop("_lines")


def lanes(records: DataFrame) -> DataFrame:
    """Per lane: records, numbers checked, records that end on a call, distinct tools and estimated tokens."""
    of = records.groupBy("lane").agg(F.count("*").alias("records"), F.sum("numbers").alias("numbers_checked"), F.count_if("ends_on_call").alias("ends_on_call"), F.sum("tokens").alias("tokens"))
    tools = records.select("lane", F.explode("tools").alias("t")).groupBy("lane").agg(F.countDistinct("t").alias("tools"))
    return of.join(tools, "lane", "left").select("lane", "records", "numbers_checked", "ends_on_call", F.coalesce("tools", F.lit(0)).cast("long").alias("tools"), "tokens")
