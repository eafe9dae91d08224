"""Aggregations: nightly reductions, parity and fillability counts, ledgers. Partial aggregates are formed before each
shuffle; arrays are gathered only where their size is bounded by the group's key (a night's accounts, a batch's nodes)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators import fingerprints


def _rank_of(count: Column, fraction: float) -> Column:
    return F.bround((count - 1) * F.lit(fraction), 0).cast("long") + 1


def nearest_ranks(rows: DataFrame, keys: list[str], value: str, picks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Values at ranks (from 1, given the number of values) of each group. Values are counted first, so the window runs
    over a group's distinct values and not over its rows."""
    w = Window.partitionBy(*keys)
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    spread = counts.withColumn("_upto", F.sum("_c").over(w.orderBy("_v"))).withColumn("_n", F.sum("_c").over(w))
    return spread.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") >= rank(F.col("_n")), F.col("_v"))).alias(name) for name, rank in picks.items()])


#: Optional columns of a record, and the totals and means they give.
TOTALS = {"tool_calls": "tool_calls_total", "tool_errors": "tool_errors_total", "prompt_tokens": "prompt_tokens_total", "completion_tokens": "completion_tokens_total"}
MEANS = {"iterations": "iterations_mean", "prompt_tokens": "prompt_tokens_mean", "completion_tokens": "completion_tokens_mean"}


def _optional(columns: list[str], n: Column) -> list[Column]:
    """Metrics of the columns that a night's records have; a missing value counts as zero, as no call was made."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    has = lambda *c: all(x in columns for x in c)
    out = [F.sum(zero(c)).alias(name) for c, name in TOTALS.items() if has(c)]
    out += [T.pct4(F.sum(zero(c)), n).alias(name) for c, name in MEANS.items() if has(c)]
    if has("tool_errors"):
        out.append(F.count_if(zero("tool_errors") > 0).alias("records_with_tool_error"))
    if has("tool_calls"):
        out += [F.count_if(zero("tool_calls") == 0).alias("zero_tool_call_records"), T.pct4(F.count_if(zero("tool_calls") == 0), n).alias("zero_tool_call_rate")]
    if has("max_parallel"):
        out.append(F.max(zero("max_parallel")).alias("max_parallel_calls"))
    if has("truncated"):
        out.append(F.count_if("truncated").alias("truncated_records"))
    for c, name in (("provider", "providers"), ("model_id", "serving_model_ids")):
        if has(c):
            out.append(F.array_join(F.array_sort(F.collect_set(c)), ",").alias(name))  # the few services of a night
    return out


def top_counts(rows: DataFrame, keys: list[str], values: Column, name: str, most: int = 5) -> DataFrame:
    """The most frequent entries of an array column in each group, as ``entry=count`` joined by commas."""
    counts = rows.select(*keys, F.explode(values).alias("_t")).groupBy(*keys, "_t").agg(F.count("*").alias("_c"))
    best = counts.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_c").desc(), "_t"))).where(F.col("_k") <= most)
    entries = F.transform(F.array_sort(F.collect_list(F.struct("_k", "_t", "_c"))), lambda x: F.concat_ws("=", x["_t"], x["_c"].cast("string")))
    return best.groupBy(*keys).agg(F.array_join(entries, ",").alias(name))


def aggregate_arm(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Night by arm: records, accounts, errors, emits, no-action, their rates, the output histogram, envelope set hash and
    nearest-rank latency; latency is null where no row recorded one. Where records carry tool calls and errors,
    parallel calls, iterations, tokens, truncation, importance, services or tool names, their totals, means, rates,
    sets and the five most used tools follow."""
    n = F.count("*")
    of = rows.groupBy(*keys).agg(
        n.alias("records"),
        F.countDistinct("account_id").alias("accounts"),
        F.count_if("is_error").alias("errors"),
        T.pct4(F.count_if("is_error"), n).alias("error_rate"),
        F.count_if("emitted").alias("emitted"),
        (n - F.count_if("emitted")).alias("never_emitted"),
        F.count_if(F.col("output_type") == "no_action").alias("no_action"),
        T.pct4(F.count_if(F.col("output_type") == "no_action"), n).alias("no_action_rate"),
        F.count_if(F.col("emitted") & (F.col("output_type") != "no_action")).alias("actionable"),
        F.countDistinct("envelope_hash").alias("envelope_hashes"),
        F.bround(F.avg("wall_ms"), 4).alias("latency_mean"),
        *_optional(rows.columns, n),
    )
    sets = fingerprints.set_fingerprint(rows, "envelope_hash", keys).withColumnRenamed("fingerprint", "envelopes").drop("members")
    of = of.join(sets, keys, "left").withColumn("envelopes", F.coalesce("envelopes", F.sha2(F.lit(""), 256)))
    ranks = nearest_ranks(rows, keys, "wall_ms", {"latency_p50": lambda c: _rank_of(c, 0.5), "latency_p95": lambda c: _rank_of(c, 0.95)})
    of = of.join(ranks.withColumns({c: F.col(c).cast("double") for c in ("latency_p50", "latency_p95")}), keys, "left")
    if "importance" in rows.columns:
        of = of.join(nearest_ranks(rows, keys, "importance", {"importance_p50": lambda c: _rank_of(c, 0.5)}), keys, "left")
    if "tool_names" in rows.columns:
        of = of.join(top_counts(rows, keys, F.col("tool_names"), "top_tools"), keys, "left")
    kinds = rows.where("output_type is not null").groupBy(*keys, "output_type").agg(F.count("*").alias("c"))
    entries = F.array_sort(F.collect_list(F.concat_ws("=", "output_type", F.col("c").cast("string"))))
    return of.join(kinds.groupBy(*keys).agg(F.array_join(entries, ",").alias("output_types")), keys, "left")


def set_identity(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The fingerprint of each group's distinct values, built in parts where they are many."""
    return fingerprints.set_fingerprint(rows, column, keys).withColumnRenamed("fingerprint", "set_hash")


def rank_percentiles(rows: DataFrame, key: str, value: str, fractions: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles and the upper median of each group."""
    picks: dict[str, Callable[[Column], Column]] = {n: (lambda c, f=f: _rank_of(c, f)) for n, f in fractions.items()}
    return nearest_ranks(rows, [key], value, {**picks, "upper_median": lambda c: F.floor(c / 2) + 1})


def paired_compare(arm: DataFrame, incumbent: DataFrame) -> DataFrame:
    """Per night: an arm's outputs against the incumbent's for the same account."""
    a, b = F.col("a.output_type"), F.col("b.output_type")
    real = lambda x: x.isNotNull() & (x != "no_action")
    pairs = arm.alias("a").join(incumbent.alias("b"), ["night", "account_id"])
    return pairs.groupBy("night").agg(
        F.count("*").alias("pairs"),
        F.count_if(a == b).alias("match"),
        F.count_if(real(b) & (a == "no_action")).alias("missed"),
        F.count_if(real(a) & real(b) & (a != b)).alias("different"),
        F.count_if(real(a) & (b == "no_action")).alias("false_alarm"),
        F.count_if(a.isNull()).alias("never_emitted"),
    )


def style_concentration(texts: DataFrame, column: str, top1: float = 0.30, top3: float = 0.60) -> DataFrame:
    """The most frequent openings: shares of the first and of the first three, and a verdict; no text is suspect."""
    of = texts.select(T.opening(F.col(column)).alias("o")).where("o is not null").groupBy("o").agg(F.count("*").alias("n"))
    total = of.agg(F.sum("n").alias("total"), F.count("*").alias("openings"))
    top = of.orderBy(F.col("n").desc(), "o").limit(3)
    best = top.agg(F.max("n").alias("n1"), F.sum("n").alias("n3"), F.min_by("o", F.struct(-F.col("n"), F.col("o"))).alias("top"))
    s1, s3 = T.pct4(F.col("n1"), F.col("total")), T.pct4(F.col("n3"), F.col("total"))
    verdict = F.when(F.col("total").isNull(), "suspect").when((s1 >= top1) | (s3 >= top3), "fail").otherwise("pass")
    return total.crossJoin(best).select("openings", "top", s1.alias("top1_share"), s3.alias("top3_share"), verdict.alias("verdict"))


def rare_tokens(texts: DataFrame, id_col: str, column: str, ratio: float = 0.05) -> DataFrame:
    """Tokens in fewer documents than ``max(2, ratio * documents)``, with that number."""
    tokens = texts.select(id_col, F.explode(F.array_distinct(T.words(F.col(column)))).alias("token"))
    size = texts.agg(F.count("*").alias("total"))
    return tokens.groupBy("token").agg(F.count("*").alias("df")).crossJoin(size).where(F.col("df") < F.greatest(F.lit(2.0), F.col("total") * ratio)).select("token", "df")


def fillability(pool: DataFrame, plan: DataFrame, total: int, floor: int) -> DataFrame:
    """``class, share`` planned against rows available: the dose each class needs, and whether the pool fills it."""
    need = F.greatest(F.lit(floor), F.bround(F.col("share") * total, 0).cast("int"))
    have = pool.groupBy("class").agg(F.count("*").alias("available"))
    out = plan.join(have, "class", "left").withColumn("available", F.coalesce("available", F.lit(0))).withColumn("needed", need)
    return out.select("class", "needed", "available", F.when(F.col("available") >= F.col("needed"), "pass").otherwise("fail").alias("verdict"))


def fillability_state(pool: DataFrame, plan: DataFrame | None, total: int, floor: int, allowed: list[str] | None = None) -> DataFrame:
    """One row: classes planned, pool rows counted, planned classes the pool can't fill and those the served contract forbids
    (``allowed``: what it enables), with their names, and a verdict. No plan, no pool rows or no contract to hold it
    against leave it suspect; a class that can't be filled or is forbidden fails."""
    spark = pool.sparkSession
    names = lambda column: F.array_join(F.array_sort(F.collect_list(column)), ",")
    plan = plan if plan is not None else spark.createDataFrame([], "class string, share double")
    doses = fillability(pool, plan, total, floor)
    forbidden = ~F.col("class").isin(allowed) if allowed is not None else F.lit(False)
    of = doses.agg(
        F.count("*").alias("classes_planned"), F.count_if(F.col("verdict") == "fail").alias("unfillable"), names(F.when(F.col("verdict") == "fail", F.col("class"))).alias("unfillable_classes"),
        F.count_if(forbidden).alias("inadmissible"), names(F.when(forbidden, F.col("class"))).alias("inadmissible_classes"),
    )  # a plan names a few classes
    size = pool.agg(F.count("*").alias("pool_rows"))
    unknown = (F.col("classes_planned") == 0) | (F.col("pool_rows") == 0) | F.lit(allowed is None)
    verdict = F.when((F.col("pool_rows") > 0) & (F.col("unfillable") > 0) | (F.col("inadmissible") > 0), "fail").when(unknown, "suspect").otherwise("pass")
    return of.crossJoin(size).select("classes_planned", "pool_rows", "unfillable", "unfillable_classes", "inadmissible", "inadmissible_classes", verdict.alias("verdict"))


def anchor_census(anchors: DataFrame, pool: DataFrame) -> DataFrame:
    """``night, claimed`` outside 0.8 x - 2 to 1.25 x + 2 of the pool's actual rows of the night."""
    actual = pool.groupBy("night").agg(F.count("*").alias("actual"))
    of = anchors.join(actual, "night", "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return of.where((F.col("claimed") < 0.8 * F.col("actual") - 2) | (F.col("claimed") > 1.25 * F.col("actual") + 2))


def marker_hits(surfaces: DataFrame, markers: list[str], column: str = "text") -> DataFrame:
    """How often each marker (a bounded list) occurs in all surfaces, and in how many."""
    counts = F.explode(F.array(*[F.struct(F.lit(m).alias("marker"), F.regexp_count(F.col(column), F.lit(m)).alias("n")) for m in markers]))
    return surfaces.select(counts.alias("c")).groupBy("c.marker").agg(F.sum("c.n").alias("hits"), F.count_if(F.col("c.n") > 0).alias("surfaces"))


def window_hygiene(rows: DataFrame, windows: DataFrame, warn: str) -> DataFrame:
    """Rows of anomalous nights by origin: ``warn``'s warn, the others' fail."""
    hit = rows.join(windows, "night", "left_semi").groupBy("origin").agg(F.count("*").alias("rows"))
    return hit.withColumn("verdict", F.when(F.col("origin") == warn, "suspect").otherwise("fail"))


def observed_surface(reviews: DataFrame) -> DataFrame:
    """``kind, value, n``: histograms of tools and output types, and nights seen; where rows carry a ``stamp`` (JSON text) of what
    served them, also of its keys, with rows without a readable one as the value null of the kind ``unstamped``."""
    one = lambda k, v: F.array(F.struct(F.lit(k).alias("kind"), v.cast("string").alias("value")))
    parts = [one(k, F.col(c)) for k, c in (("tool", "tool"), ("output", "output_type"), ("night", "night"))]
    if "stamp" in reviews.columns:
        keys = F.map_keys(F.try_variant_get(F.try_parse_json("stamp"), "$", "map<string,variant>"))
        parts.append(F.when(keys.isNull(), one("unstamped", F.lit("none"))).otherwise(F.transform(keys, lambda k: F.struct(F.lit("stamp_key").alias("kind"), k.alias("value")))))
    return reviews.select(F.explode(F.concat(*parts)).alias("s")).where("s.value is not null").groupBy("s.kind", "s.value").agg(F.count("*").alias("n"))


def contract_parity(observed: DataFrame, offered: DataFrame, outputs: DataFrame | None = None, allowed: list[str] | None = None, gold: DataFrame | None = None, forbidden: list[str] | None = None) -> DataFrame:
    """``tool, calls`` observed against tools offered: called but not offered fails, offered but unobserved is info. Rows of
    ``outputs`` (``output_type``) outside ``allowed`` are rogue, rows of ``gold`` (``gold_class``) within ``forbidden`` are
    forbidden; both fail, with their counts as calls."""
    o, e = observed.groupBy("tool").agg(F.sum("calls").alias("calls")), offered.select("tool", F.lit(1).alias("offered")).distinct()
    code = F.when(F.col("offered").isNull(), "called_not_offered").when(F.col("calls").isNull(), "offered_unobserved")
    out = o.join(e, "tool", "full_outer").withColumn("code", code).where("code is not null")
    out = out.select("tool", "code", F.coalesce("calls", F.lit(0)).alias("calls"))
    for df, column, code, bad in ((outputs, "output_type", "rogue_output", lambda x: ~x.isin(allowed or [])), (gold, "gold_class", "forbidden_class", lambda x: x.isin(forbidden or []))):
        if df is not None:
            found = df.where(F.col(column).isNotNull() & bad(F.col(column))).groupBy(F.col(column).cast("string").alias("tool")).agg(F.count("*").alias("calls"))
            out = out.unionByName(found.select("tool", F.lit(code).alias("code"), "calls"))
    return out.withColumn("verdict", F.when(F.col("code") == "offered_unobserved", "info").otherwise("fail"))


#: The archetypes and importance that are served, and the length of a rationale.
ARCHETYPES, SERVED_IMPORTANCE, RATIONALE = ["A", "B"], 0, (200, 900)


def emit_lint(messages: DataFrame, tool: str = "emit_output", kind: str = "winback_enrollment") -> DataFrame:
    """The arguments of the last call of ``tool`` in each record: records, and of readable ones unknown archetypes and
    rationales out of bounds (of outputs of that kind), drafts that are not empty, and other than served importance;
    with a verdict, which is suspect without records."""
    records = messages.select("line").distinct().agg(F.count("*").alias("records"))
    last = messages.where(F.col("tool_name") == tool).groupBy("line").agg(F.max_by("args", "pos").alias("args"))
    v = F.try_parse_json("args")
    get = lambda path: F.try_variant_get(v, path, "string")
    own = get("$.output_type") == kind
    archetype = F.coalesce(F.nullif(get("$.payload.sequence.archetype"), F.lit("")), get("$.archetype"))
    size = F.length(get("$.payload.sequence.rationale"))
    drafted = (F.coalesce(get("$.draft_subject"), F.lit("")) != "") | (F.coalesce(get("$.draft_body"), F.lit("")) != "")
    found = last.agg(
        F.count_if(own & archetype.isNotNull() & ~archetype.isin(ARCHETYPES)).alias("bad_archetype"),
        F.count_if(drafted).alias("nonempty_drafts"),
        F.count_if(F.try_variant_get(v, "$.importance_score", "double") != SERVED_IMPORTANCE).alias("importance_drift"),
        F.count_if(own & (size > 0) & ~size.between(*RATIONALE)).alias("rationale_out_of_band"),
    )
    faults = F.col("bad_archetype") + F.col("nonempty_drafts") + F.col("importance_drift") + F.col("rationale_out_of_band")
    return records.crossJoin(found).withColumn("verdict", F.when(F.col("records") == 0, "suspect").when(faults > 0, "fail").otherwise("pass"))


def staleness(snapshots: DataFrame, export: str) -> DataFrame:
    """Hours by which each snapshot is older than an export, at one place; later ones are fresh."""
    hours = F.bround((F.unix_timestamp(F.lit(export).cast("timestamp")) - F.unix_timestamp("ts")) / 3600, 1) + 0.0  # no negative zero
    return snapshots.select("key", hours.alias("hours"), F.when(hours > 0, "stale").otherwise("fresh").alias("state"))


def census_ratio(recorded: DataFrame, pool: DataFrame) -> DataFrame:
    """``key, recorded`` against counted rows: ratios outside 0.8 to 1.25."""
    of = recorded.join(pool.groupBy("key").agg(F.count("*").alias("actual")), "key", "left").withColumn("ratio", T.pct4(F.coalesce("actual", F.lit(0)), F.col("recorded")))
    return of.select("key", "recorded", F.coalesce("actual", F.lit(0)).alias("actual"), "ratio", F.when(F.col("ratio").between(0.8, 1.25), "pass").otherwise("fail").alias("verdict"))


def readiness(book: DataFrame) -> DataFrame:
    """Per org: facts, zero rows, the QA dose 40 fact + 10 zero, fact share and tier A, B or C."""
    of = book.groupBy("org").agg(F.count_if("fact").alias("facts"), F.count_if(~F.col("fact")).alias("zeros"))
    share = T.pct4(F.col("facts"), F.col("facts") + F.col("zeros"))
    return of.select("org", "facts", "zeros", (40 * F.col("facts") + 10 * F.col("zeros")).alias("dose"), share.alias("fact_share"), F.when(share >= 0.5, "A").when(share >= 0.25, "B").otherwise("C").alias("tier"))


#: Accounts of a substantial book, and the share of accounts with facts below which it is thin.
SUBSTANTIAL_BOOK, THIN_BOOK = 220, 0.25


def recommend(census: DataFrame) -> DataFrame:
    """``org, accounts, transcripts, reviews, facts, zeros`` (counts) to tier, QA dose, fact share and what to build: A has accounts,
    transcripts and reviews, B a substantial book only, C neither. C is declined, B deferred in its behavioural part, a
    thin book of tier A is mostly behavioural, all else is full."""
    tier = F.when((F.col("accounts") > 0) & (F.col("transcripts") > 0) & (F.col("reviews") > 0), "A").when(F.col("accounts") >= SUBSTANTIAL_BOOK, "B").otherwise("C")
    share = F.when(F.col("accounts") > 0, F.col("facts") / F.col("accounts")).otherwise(0.0)
    advice = F.when(tier == "C", "decline").when(tier == "B", "behavioral_deferred").when(share < THIN_BOOK, "behavioral_dominant").otherwise("full")
    return census.select("org", tier.alias("tier"), (40 * F.col("facts") + 10 * F.col("zeros")).alias("dose"), F.bround(share, 3).alias("fact_share"), advice.alias("recommendation"))


def project_cost(runs: DataFrame, rate: float, cap: float, approve: float, dual: float = 1.0, calibration: float = 1.0, eval_cap: float = 0.0) -> DataFrame:
    """``key, tokens, epochs, unroll`` to a projected cost and what to do with it. ``dual`` is 2 for two models at once,
    ``calibration`` corrects by what earlier runs really cost, ``eval_cap`` is what evaluation may cost on top."""
    cost = F.bround(F.col("tokens") * F.col("epochs") / 1e6 * rate * F.col("unroll") * dual * calibration + eval_cap, 4)
    return runs.select("key", cost.alias("usd"), F.when(cost > cap, "stop").when(cost <= approve, "auto").otherwise("ask").alias("action"))


def cost_summary(attempts: DataFrame) -> DataFrame:
    """Per role: the latest correction of each attempt wins; known and unknown counts; total only when all are known."""
    value = F.coalesce("corrected_usd", "value_usd")
    of = attempts.groupBy("role_id").agg(F.count("*").alias("attempts"), F.count(value).alias("known"), F.sum(value).alias("usd"))
    full = F.col("known") == F.col("attempts")
    return of.select("role_id", "attempts", "known", T.pct4(F.col("known"), F.col("attempts")).alias("coverage"), F.bround(F.when(full, F.col("usd")), 2).alias("usd"))


def lane_packet(attempts: DataFrame) -> DataFrame:
    """Per lane: attempts, roles, retries, unknown costs, blockers by kind and whether the lane is complete."""
    of = attempts.groupBy("lane").agg(F.count("*").alias("attempts"), F.countDistinct("role_id").alias("roles"), F.count_if(F.col("value_usd").isNull()).alias("unknown"), F.count_if("failed").alias("failed"))
    blockers = F.array_join(F.array_compact(F.array(F.when(F.col("unknown") > 0, F.lit("unknown_cost")), F.when(F.col("failed") > 0, F.lit("failed_attempt")))), ",")
    return of.select("lane", "attempts", "roles", (F.col("attempts") - F.col("roles")).alias("retries"), blockers.alias("blockers"), (blockers == "").alias("complete"))


def flow_summary(edges: DataFrame) -> DataFrame:
    """Edges by type and confidence, with totals per type and in all (null keys)."""
    return edges.rollup("edge_type", "confidence").agg(F.count("*").alias("edges"))


def outcome_matrix(rows: DataFrame, outcomes: list[str]) -> DataFrame:
    return rows.groupBy("runtime", "kind").pivot("outcome", outcomes).agg(F.count(F.lit(1))).na.fill(0)


def fleet_status(view: DataFrame) -> DataFrame:
    """Sessions by status, and a severity code: blocked 3, failed 4, degraded 1, else 0 (the highest wins)."""
    of = view.agg(F.count("*").alias("sessions"), F.count_if(F.col("status") == "blocked").alias("blocked"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status").isNull() | (F.col("status") == "paused")).alias("degraded"))
    return of.withColumn("code", F.when(F.col("failed") > 0, 4).when(F.col("blocked") > 0, 3).when(F.col("degraded") > 0, 1).otherwise(0))


def session_activity(ledger: DataFrame) -> DataFrame:
    """Per session: distinct paths in the order first seen, and the number of tool rows."""
    first = ledger.groupBy("session_id", "path").agg(F.min(F.struct("ts", "event_id")).alias("at"), F.count("*").alias("n"))
    paths = F.transform(F.array_sort(F.collect_list(F.struct("at", "path"))), lambda x: x["path"])
    return first.groupBy("session_id").agg(F.array_join(paths, ",").alias("paths"), F.sum("n").alias("tools"))


def project_usage(df: DataFrame, json_col: str, keys: list[str]) -> DataFrame:
    """Token keys of a usage object, and its turns, the number of ``iterations``; absent ones are null."""
    v = F.try_parse_json(F.col(json_col))
    turns = F.size(F.try_variant_get(v, "$.iterations", "array<variant>"))
    return df.select("event_id", *[F.try_variant_get(v, f"$.{k}", "long").alias(k) for k in keys], F.when(turns >= 0, turns).alias("turns"))


def mixture_report(corpus: DataFrame, targets: dict[str, float], tolerance: float = 0.05) -> DataFrame:
    """Records, tokens and token share of each slice against its target; off by more than the tolerance fails."""
    of = corpus.groupBy("slice").agg(F.count("*").alias("records"), F.sum("tokens").alias("tokens"))
    share = T.pct4(F.col("tokens"), F.sum("tokens").over(Window.partitionBy()))
    goal = F.try_element_at(F.create_map(*[F.lit(x) for k, v in targets.items() for x in (k, v)]), F.col("slice"))
    out = of.select("slice", "records", "tokens", share.alias("share"), goal.alias("target"))
    return out.withColumn("verdict", F.when(F.col("target").isNull(), "suspect").when(F.abs(F.col("share") - F.col("target")) > tolerance, "fail").otherwise("pass"))


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The Wilson score interval of a share."""
    p = hits / n
    mid, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (mid - half) / (1 + z * z / n), (mid + half) / (1 + z * z / n)


def lexicographic_gates(arms: DataFrame, margin: float = 0.02) -> DataFrame:
    """``arm, n, quality, toxic`` counts: a toxic share above the least one of all arms (zero margin) fails first, then a
    quality share more than ``margin`` below the best; with the quality share's Wilson interval."""
    low, high = wilson(F.col("quality"), F.col("n"))
    best = F.max(F.col("quality") / F.col("n")).over(Window.partitionBy())  # over the few arms
    least = F.min(F.col("toxic") / F.col("n")).over(Window.partitionBy())
    verdict = F.when(F.col("toxic") / F.col("n") > least, "fail_toxic").when(F.col("quality") / F.col("n") < best - margin, "fail_quality").otherwise("pass")
    return arms.select("arm", F.bround(low, 4).alias("low"), F.bround(high, 4).alias("high"), verdict.alias("verdict"))


def grader_disagreement(a: DataFrame, b: DataFrame, limit: float = 0.10) -> DataFrame:
    """``key, verdict`` of two graders: disagreements among shared keys, and a verdict."""
    both = a.select("key", F.col("verdict").alias("x")).join(b.select("key", F.col("verdict").alias("y")), "key")
    n, d = F.count("*"), F.count_if(~F.col("x").eqNullSafe(F.col("y")))
    return both.agg(n.alias("pairs"), d.alias("disagree"), F.when((n == 0) | (d / n > limit), "suspect").otherwise("pass").alias("verdict"))


def consolidate_verdicts(votes: DataFrame) -> DataFrame:
    """Per item the verdict with most votes; ties go to the worse one; ``split`` marks items whose readers disagree."""
    rank = F.when(F.col("verdict") == "fail", 2).when(F.col("verdict") == "suspect", 1).otherwise(0)
    of = votes.groupBy("item", "verdict", rank.alias("rank")).agg(F.count("*").alias("n"))
    return of.groupBy("item").agg(F.max_by("verdict", F.struct("n", "rank")).alias("verdict"), F.sum("n").alias("votes"), (F.count("*") > 1).alias("split"))


def status_board(reports: DataFrame, stages: list[str]) -> DataFrame:
    """Latest status of each org and stage, stages as columns."""
    return reports.groupBy("org").pivot("stage", stages).agg(F.max_by("status", F.struct("ts", "id")))
