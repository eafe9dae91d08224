"""Derived timelines, flow edges and artifacts: projections of reports and logs with deterministic ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators.project import dispatch_detail
from tallyforge.operators import joins as J

NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def stage_events(reports: DataFrame) -> DataFrame:
    """``id, status, cost`` to 0 to 3 events: started, passed or failed, cost. Blocked reports have none, pending gates start only."""
    ev = lambda kind: F.struct(F.lit(kind).alias("kind"))
    live = F.col("status") != "blocked"
    done = F.when(F.col("status") == "passed", ev("passed")).when(F.col("status") == "failed", ev("failed"))
    events = F.array_compact(F.array(F.when(live, ev("started")), F.when(live, done), F.when(live & F.col("status").isin("passed", "failed") & F.col("cost").isNotNull(), ev("cost"))))
    out = reports.select("id", F.explode(events).alias("e")).select("id", "e.kind")
    # passed and failed share an id, so that a later verdict replaces an earlier one
    slot = F.when(F.col("kind").isin("passed", "failed"), "outcome").otherwise(F.col("kind"))
    return out.withColumn("event_id", T.uuid5(NAMESPACE, F.concat_ws("|", F.col("id").cast("string"), slot)))


def finding_events(findings: DataFrame) -> DataFrame:
    """Findings to event rows of a closed column set."""
    kind = F.when(F.col("verdict") == "fail", "finding.fail").when(F.col("verdict") == "suspect", "finding.suspect").otherwise("finding.info")
    return findings.select(T.uuid5(NAMESPACE, F.concat(F.lit("finding|"), F.col("id").cast("string"))).alias("event_id"), kind.alias("kind"), "severity", "ts")


def night_events(nights: DataFrame, roster: DataFrame) -> DataFrame:
    """``night, arm, records, errors``, with the nights of a roster on which no arm ran as marker rows."""
    text = F.format_string("%s: %d records, %d errors", "arm", "records", "errors")
    out = roster.join(nights, "night", "left")
    return out.select("night", "arm", F.when(F.col("arm").isNull(), "roster only").otherwise(text).alias("headline"))


def promote_nights(events: DataFrame, allowed: list[str]) -> DataFrame:
    """Allowed columns of night events; replayed nights are marked historical and never promotable."""
    historical = F.col("mode").startswith("retro")
    return events.select(*allowed, historical.alias("historical"), (~historical & F.col("emitted")).alias("promotable"))


def cloud_agent_rows(beats: DataFrame) -> DataFrame:
    """Heartbeats to agent rows: status mapped to the closed set, a summary line."""
    state = F.when(F.col("status") == "working", "running").when(F.col("status") == "blocked", "blocked").when(F.col("status") == "done", "finished").when(F.col("status") == "starting", "starting").otherwise("unknown")
    return beats.select("session_id", "event_id", state.alias("state"), F.concat_ws(" ", F.lit("seq"), F.col("seq").cast("string"), state).alias("summary"))


#: What a blocked session may say it waits for.
BLOCKERS = ["needs-decision", "needs-credential", "needs-human-action", "dependency-missing", "rate-limited", "ambiguous-instruction"]


def fleet_rows(beats: DataFrame) -> DataFrame:
    """The newest heartbeat of each session, ``session_id, seq, ts, status, blocker, task``, as an agent row: a blocked session is still
    active and says so in ``blocker`` only, a failed one has ended, a kind of blocker that is not listed is dropped, and a
    status that is not known is stale. The summary joins what is there."""
    last = beats.groupBy("session_id").agg(F.max_by(F.struct("seq", "ts", "status", "blocker", "task"), F.struct("seq", "ts")).alias("b")).select("session_id", "b.*")
    status = F.when(F.col("status").isin("ACTIVE", "BLOCKED"), "active").when(F.col("status").isin("DONE", "FAILED"), "ended").otherwise("stale")
    blocker = F.when((F.col("status") == "BLOCKED") & F.col("blocker").isin(BLOCKERS), F.col("blocker"))
    said = F.concat_ws(" · ", F.lower("status"), blocker, F.nullif(T.clean_text(F.col("task"), 120), F.lit("")))
    return last.select("session_id", status.alias("status"), blocker.alias("blocker"), said.alias("summary"), F.col("ts").alias("last_seen_at"))


def session_agents(sessions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every session, with a run or without, as an agent row: first and last time seen, rows, distinct tools, and whether it has ended
    (its last row says so)."""
    end = F.max_by(F.col("tool"), F.struct("ts", "event_id"))
    of = ledger.groupBy("session_id").agg(F.min("ts").alias("spawned_at"), F.max("ts").alias("last_seen_at"), F.count("*").alias("rows"), F.countDistinct("tool").alias("tools"), end.alias("_last"))
    out = sessions.join(of, "session_id", "left")
    return out.select("session_id", "run_id", "spawned_at", "last_seen_at", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("tools", F.lit(0)).cast("long").alias("tools"), F.when(F.col("_last").isNull(), "stale").when(F.col("_last") == "end", "ended").otherwise("active").alias("status"))


def dispatch_events(dispatch: DataFrame) -> DataFrame:
    """``id, outcome, ts, detail`` (JSON text) to dispatch event rows with repeatable ids; the detail is projected to what may be
    shown (``project.dispatch_detail``). Stopped is not failed."""
    state = F.when(F.col("outcome") == "stopped", "stopped").when(F.col("outcome") == "error", "failed").otherwise("finished")
    key = F.concat(F.lit("agent_dispatched|"), F.col("id").cast("string"))
    return dispatch.select(T.uuid5(NAMESPACE, key).alias("event_id"), F.lit("agent_dispatched").alias("kind"), "ts", F.concat_ws(" ", F.lit("dispatch"), state).alias("headline"), dispatch_detail(F.col("detail")).alias("detail"))


def night_previews(nights: DataFrame, roster: DataFrame, incumbent: str) -> DataFrame:
    """Night events with their preview: ``night, arm, accounts, records, errors`` beside the incumbent's of the same night, as JSON
    text: challenger and incumbent, accounts compared (of the arm), records and errors of both. A night of the roster
    without any arm is a marker row without a preview; one without the incumbent leaves its numbers out."""
    base = nights.where(F.col("arm") == incumbent).select("night", F.col("records").alias("_r"), F.col("errors").alias("_e"), F.lit(incumbent).alias("_i"))
    of = roster.select("night").distinct().join(nights.where(F.col("arm") != incumbent), "night", "left").join(base, "night", "left")
    preview = F.to_json(F.struct(F.col("arm").alias("challenger"), F.col("_i").alias("incumbent"), F.col("accounts").alias("accounts_compared"), "records", "errors", F.col("_r").alias("incumbent_records"), F.col("_e").alias("incumbent_errors")))
    text = F.format_string("%s: %d records, %d errors", "arm", "records", "errors")
    kind = F.when(F.col("arm").isNull(), "roster_only").otherwise("night_result")
    return of.select("night", "arm", kind.alias("kind"), F.when(F.col("arm").isNull(), "roster only").otherwise(text).alias("headline"), F.when(F.col("arm").isNotNull(), preview).alias("preview"))


def project_agents(sessions: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sessions with a run get spawned and finished events at their first and last row; run-less ones none."""
    span = ledger.groupBy("session_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    both = F.explode(F.array(F.struct(F.lit("spawned").alias("kind"), F.col("first").alias("ts")), F.struct(F.lit("finished").alias("kind"), F.col("last").alias("ts"))))
    return sessions.where("run_id is not null").join(span, "session_id").select("session_id", "run_id", both.alias("e")).select("session_id", "run_id", "e.kind", "e.ts")


def dispatch_rows(dispatch: DataFrame) -> DataFrame:
    """Dispatch results: a null cost stays null, stopped is not failed."""
    state = F.when(F.col("outcome") == "stopped", "stopped").when(F.col("outcome") == "error", "failed").otherwise("finished")
    return dispatch.select("id", state.alias("state"), F.when(F.col("cost").isNotNull(), F.bround(F.col("cost"), 2)).alias("cost"))


def project_swarm(swarm: DataFrame) -> DataFrame:
    """Swarm rows to one table of agents, run events and handoffs, by ``family``."""
    agents = swarm.select(F.lit("agent").alias("family"), F.col("role_id").cast("string").alias("key")).distinct()
    events = swarm.select(F.lit("event").alias("family"), F.col("attempt_id").cast("string").alias("key"))
    handoffs = swarm.where("corrected_usd is not null").select(F.lit("handoff").alias("family"), F.col("attempt_id").cast("string").alias("key"))
    return agents.unionByName(events).unionByName(handoffs)


def iteration_digest(reports: DataFrame, stages: list[str]) -> DataFrame:
    """Per run the value of each stage, each falling back to the stage before."""
    wide = reports.groupBy("run").pivot("stage", stages).agg(F.max_by("value", "ts"))
    return wide.select("run", *[F.coalesce(*[F.col(f"`{s}`") for s in reversed(stages[: i + 1])]).alias(f"s{i + 1}") for i in range(len(stages))])


def nested_digest(reports: DataFrame, picks: dict[str, tuple[str, list[str], str]]) -> DataFrame:
    """One row per run from its stage reports ``run, stage, ts, body`` (JSON text): each pick names a column and says from which
    stage's latest report, by which paths in order, and as what kind. A report that can't be read, a stage that
    did not run or paths that lead nowhere leave it null; ``unreadable`` counts reports that are no JSON objects."""
    v = F.try_parse_json("body")
    ok = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    rows = reports.withColumn("_v", F.when(ok, v))
    last = lambda stage, value: F.max_by(value, F.when((F.col("stage") == stage) & F.col("_v").isNotNull(), F.struct("ts", "body")))
    columns = [last(stage, T.pick_path(F.col("_v"), paths, kind)).alias(name) for name, (stage, paths, kind) in picks.items()]
    return rows.groupBy("run").agg(*columns, F.count_if(F.col("_v").isNull()).alias("unreadable"))


def report_edges(sessions: DataFrame, records: DataFrame) -> DataFrame:
    """Finished sessions report to who dispatched them: ``session, state`` and dispatch records ``parent, child`` to REPORT
    edges from child to parent. Sessions that no record names have none (see ``unclaimed_sessions``)."""
    done = sessions.where(F.col("state").isin("done", "finished")).select(F.col("session").alias("child")).distinct()
    of = records.groupBy("child").agg(F.countDistinct("parent").alias("n"), F.min("parent").alias("parent")).where("n = 1")
    return done.join(of, "child").select(F.lit("REPORT").alias("edge_type"), F.col("child").alias("from_key"), F.col("parent").alias("to_key"))


def unclaimed_sessions(sessions: DataFrame, records: DataFrame) -> DataFrame:
    """Sessions that no dispatch record names as a child."""
    return sessions.join(records.select(F.col("child").alias("session")).distinct(), "session", "left_anti")


def spawn_edges(records: DataFrame) -> DataFrame:
    """``id, text``: certain edges from dispatch text (``dispatches: x``), inferred ones from goal text (``for x``) where none is certain."""
    certain = F.regexp_extract("text", r"(?i)dispatches: ([a-z0-9_-]+)", 1)
    goal = F.regexp_extract("text", r"(?i)\bfor ([a-z]+)", 1)
    to = F.when(certain != "", certain).when(goal != "", goal)
    return records.select("id", to.alias("to_key"), F.when(certain != "", "high").otherwise("medium").alias("confidence")).where("to_key is not null")


def header_edges(docs: DataFrame, header: str, edge_type: str) -> DataFrame:
    """Edges from header lines ``header: a, b`` of documents, one per named target."""
    lines = docs.select("id", F.explode(F.split("text", "\n")).alias("s")).where(F.lower("s").startswith(header + ":"))
    targets = F.explode(F.transform(F.split(F.substr("s", F.lit(len(header) + 2)), ","), lambda x: F.trim(x)))
    return lines.select(F.lit(edge_type).alias("edge_type"), "id", targets.alias("to_key")).where("to_key <> ''").distinct()


def artifact_edges(ledger: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """ARTIFACT edges ``from_key, to_key, path, basis``: the last writer before each read of a path (certain), and, for paths
    that ``consumes:`` headers name (``id, reader, text``), the one declared owner of the path (``path, owner``); named
    paths without a sole owner have none."""
    seen = J.artifact_flows(ledger).select(F.col("writer").alias("from_key"), F.col("reader").alias("to_key"), "path", F.lit("ledger").alias("basis"))
    named = header_edges(docs, "consumes", "ARTIFACT").select("id", F.col("to_key").alias("path")).join(docs.select("id", "reader"), "id")
    sole = owners.groupBy("path").agg(F.countDistinct("owner").alias("n"), F.min("owner").alias("owner")).where("n = 1")
    said = named.join(sole, "path").where("owner <> reader").select(F.col("owner").alias("from_key"), F.col("reader").alias("to_key"), "path", F.lit("header").alias("basis"))
    return seen.unionByName(said).distinct()


def addendum_edges(docs: DataFrame) -> DataFrame:
    """``id, text``: ADDENDUM edges from ``corrects:`` headers; a document without one, whose headings call it an addendum,
    correction or erratum and name exactly one other document (``doc-<name>``), gets an inferred edge."""
    sure = header_edges(docs, "corrects", "ADDENDUM").withColumn("confidence", F.lit("high"))
    heads = docs.join(sure.select("id").distinct(), "id", "left_anti").select("id", F.explode(F.split("text", "\n")).alias("s")).where(F.col("s").rlike(r"(?i)^#+ .*\b(addendum|correction|erratum)\b"))
    named = heads.select("id", F.explode(F.regexp_extract_all(F.lower("s"), F.lit(r"\bdoc-([a-z0-9]+)"), F.lit(1))).alias("to_key"))
    sole = named.groupBy("id").agg(F.countDistinct("to_key").alias("n"), F.min("to_key").alias("to_key")).where("n = 1")
    return sure.unionByName(sole.select(F.lit("ADDENDUM").alias("edge_type"), "id", "to_key", F.lit("medium").alias("confidence")))


def table_edges(gates: DataFrame, steers: DataFrame, projections: DataFrame) -> DataFrame:
    """Edges from table rows: ``edge_type, from_key, to_key, ref``. A gate request goes from its run to its approver, or to
    ``human`` while it has none (``run_id, approver, id``); a steering event from its author to the run, unless the run
    steered itself (``run_id, author, id``); a projection from the run to the table it wrote, once per table
    (``run_id, target, id``). Rows without a run have no edge."""
    gate = gates.where("run_id is not null").select(F.lit("GATE").alias("edge_type"), F.col("run_id").cast("string").alias("from_key"), F.coalesce(F.col("approver").cast("string"), F.lit("human")).alias("to_key"), F.col("id").alias("ref"))
    steer = steers.where("run_id is not null and author is not null and cast(author as string) <> cast(run_id as string)").select(F.lit("STEER").alias("edge_type"), F.col("author").cast("string").alias("from_key"), F.col("run_id").cast("string").alias("to_key"), F.col("id").alias("ref"))
    written = projections.where("run_id is not null and target is not null").groupBy(F.col("run_id").cast("string").alias("from_key"), F.col("target").cast("string").alias("to_key")).agg(F.min("id").alias("ref"))
    return gate.unionByName(steer).unionByName(written.select(F.lit("PROJECTION").alias("edge_type"), "from_key", "to_key", "ref"))


def handoff_edges(docs: DataFrame, readers: DataFrame) -> DataFrame:
    """Author to consumer of each document; unread ones to a placeholder successor."""
    return docs.join(readers, "id", "left").select("id", "author", F.coalesce("reader", F.concat(F.lit("successor:"), F.col("id").cast("string"))).alias("to_key"))


def project_edges(edges: DataFrame) -> DataFrame:
    """Edges to handoff rows, event rows, and run-less rows as unsupported, by ``family``."""
    family = F.when(F.col("run_id").isNull(), "unsupported").when(F.col("edge_type") == "HANDOFF", "handoff").otherwise("event")
    return edges.withColumn("family", family)


def agent_artifacts(messages: DataFrame, blocks: DataFrame | None = None, excluded: DataFrame | None = None, most: int = 200) -> DataFrame:
    """Four artifacts per conversation (prompt, tool_calls, thinking, output): content or a reason, never both.

    Tool calls are the names and thinking the texts of transcript ``blocks`` (``conv_id, line, role, pos, type, text, name``)
    in order, at most the first ``most`` of each (a limit of the artifact). A prompt or output that the messages lack is
    the user's first and the assistant's last text block. Conversations in ``excluded`` are withheld by policy."""
    of = messages.groupBy("conv_id").agg(
        F.min_by(F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "user", F.col("turn"))).alias("prompt"),
        F.max_by(F.when(F.col("role") == "assistant", F.col("text")), F.when(F.col("role") == "assistant", F.col("turn"))).alias("output"),
    )
    text = lambda c: F.lit(None).cast("string").alias(c)
    if blocks is None:
        of = of.select("*", text("tool_calls"), text("thinking"))
    else:
        kept = blocks.where(F.col("type").isin("tool_use", "thinking")).withColumn("k", F.row_number().over(Window.partitionBy("conv_id", "type").orderBy("line", "pos"))).where(F.col("k") <= most)
        joined = lambda t, v: F.nullif(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("type") == t, F.struct("line", "pos", F.col(v).alias("v"))))), lambda x: x["v"]), "\n"), F.lit(""))
        told = kept.groupBy("conv_id").agg(joined("tool_use", "name").alias("tool_calls"), joined("thinking", "text").alias("thinking"))
        ends = blocks.where("type = 'text'").groupBy("conv_id").agg(*[f(F.when(F.col("role") == r, F.col("text")), F.when(F.col("role") == r, F.struct("line", "pos"))).alias(n) for f, r, n in ((F.min_by, "user", "_first"), (F.max_by, "assistant", "_last"))])
        of = of.join(told, "conv_id", "full_outer").join(ends, "conv_id", "full_outer").withColumn("prompt", F.coalesce("prompt", "_first")).withColumn("output", F.coalesce("output", "_last"))
    barred = excluded.select("conv_id").distinct().withColumn("_barred", F.lit(True)) if excluded is not None else None
    of = of.join(barred, "conv_id", "left") if barred is not None else of.withColumn("_barred", F.lit(None).cast("boolean"))
    kinds = [(k, F.col(k)) for k in ("prompt", "tool_calls", "thinking", "output")]
    reason = lambda v: F.when(F.col("_barred"), "excluded_by_policy").when(v.isNull(), "not_recorded")
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.when(F.col("_barred").isNull(), T.redact_secrets(v)).alias("content"), reason(v).alias("reason")) for k, v in kinds]))
    return of.select("conv_id", rows.alias("a")).select("conv_id", "a.kind", "a.content", "a.reason")


# --- swarm validation ----------------------------------------------------------------------------------------------


def validate_claims(claims: DataFrame) -> DataFrame:
    """``id, numerator, denominator, blocking, basis``: violations by code. Where claims carry ``load_bearing, method`` and
    ``challenges`` (the id they challenge), a positive load-bearing claim needs a challenger with another method."""
    tests = [
        ("ratio", F.col("numerator") > F.col("denominator")),
        ("block_basis", F.col("blocking") & (F.col("basis") != "deterministic")),
        ("duplicate_id", F.count("*").over(Window.partitionBy("id")) > 1),
    ]
    codes = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests]))
    out = claims.withColumn("codes", codes).select("id", F.explode("codes").alias("code")).distinct()
    if {"load_bearing", "method", "challenges"} <= set(claims.columns):
        rivals = claims.where("challenges is not null").select(F.col("challenges").alias("id"), F.col("method").alias("other"))
        needs = claims.where("load_bearing and numerator > 0").select("id", "method")
        met = needs.join(rivals, "id").where("other <> method").select("id").distinct()
        out = out.unionByName(needs.join(met, "id", "left_anti").select("id", F.lit("no_challenger").alias("code")).distinct())
    return out


def validate_swarm_events(events: DataFrame, required: dict[str, list[str]]) -> DataFrame:
    """``event_id, category, data`` (JSON): fields missing from or unknown to the category's exact set; then costs (an object
    ``cost``): a known value that is also accepted as unknown, a negative one, and a zero without evidence."""
    v = F.try_parse_json("data")
    value = F.try_variant_get(v, "$.cost.value_usd", "double")
    accepted = F.coalesce(F.try_variant_get(v, "$.cost.accepted_unknown", "boolean"), F.lit(False))
    proof = F.coalesce(F.try_variant_get(v, "$.cost.evidence", "string"), F.lit(""))
    keys = F.json_object_keys("data")
    want = F.try_element_at(F.create_map(*[x for k, v in required.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]), F.col("category"))
    code = F.when(want.isNull(), "unknown_category").when(keys.isNull(), "unreadable").when(F.size(F.array_except(want, keys)) > 0, "missing_field").when(F.size(F.array_except(keys, want)) > 0, "unknown_field")
    code = code.when(value.isNotNull() & accepted, "known_and_accepted").when(value < 0, "negative_cost").when((value == 0) & (proof == ""), "zero_without_evidence")
    return events.select("event_id", code.alias("code")).where("code is not null")


def shadow_window_check(nights: DataFrame, start: str, end: str, most_invalid: float) -> DataFrame:
    """Every calendar night of a fixed window must be observed and the mean invalid rate low; each night counts once."""
    spark = nights.sparkSession
    calendar = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("night"))
    of = nights.groupBy("night").agg(F.avg(F.col("is_error").cast("int")).alias("rate"))
    j = calendar.join(of, "night", "left")
    return j.agg(F.count("*").alias("nights"), F.count_if(F.col("rate").isNull()).alias("missing"), F.bround(F.sum(F.coalesce("rate", F.lit(0.0))) / F.count("*"), 4).alias("rate")).withColumn(
        "verdict", F.when(F.col("missing") > 0, "suspect").when(F.col("rate") > most_invalid, "fail").otherwise("pass")
    )
