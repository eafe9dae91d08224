"""Join-shaped operators. Equi joins go by keys that Spark shuffles; theta joins are given a blocking key first; sides
are broadcast only where a parameter bounds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators.fingerprints import sorted_digest
from tallyforge.sources import files


#: Words that say nothing about what a mission covers.
STOP_WORDS = ["the", "a", "an", "and", "or", "of", "for", "to", "in", "on", "is", "are", "why", "what", "how", "this", "that", "it", "its", "with", "from", "by", "run", "factory", "org", "data", "check", "report", "investigate", "not"]


def align(corpus: DataFrame, meta: DataFrame) -> DataFrame:
    """Corpus and meta rows of the same line."""
    return corpus.join(meta, "line")


def lineage_misses(meta: DataFrame, pools: DataFrame, source: str = "source_row_id") -> DataFrame:
    """Meta rows that cite a source row of no pool; a null source is skipped."""
    keys = pools.select(F.col("id").alias(source)).distinct()
    return meta.where(F.col(source).isNotNull()).join(keys, source, "left_anti")


def heldout_leaks(rows: DataFrame, sealed: DataFrame, text_col: str = "text", keys: list[str] | None = None) -> DataFrame:
    """``row_id`` and text to sealed fingerprints found in it: words of the text, their part before a colon, and UUIDs, lowered
    and hashed. ``keys`` names meta columns that hold identifiers; they are hashed as they are, lowered, and by their
    part before a colon. Only fingerprints are returned."""
    low = F.lower(F.col(text_col))
    tokens = F.regexp_extract_all(low, F.lit(r"[a-z0-9][a-z0-9:_-]*"), F.lit(0))
    uuids = F.regexp_extract_all(low, F.lit(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"), F.lit(0))
    head = lambda t: F.element_at(F.split(t, ":"), 1)
    own = [F.col(k).cast("string") for k in keys or []]
    meta = F.array_compact(F.array(*own, *map(F.lower, own), *[head(F.lower(k)) for k in own])) if own else F.array().cast("array<string>")
    every = F.array_distinct(F.concat(F.coalesce(F.concat(tokens, F.transform(tokens, head), uuids), F.array().cast("array<string>")), meta))
    found = rows.select("row_id", F.explode(every).alias("t")).select("row_id", T.fp16(F.col("t")).alias("fingerprint")).distinct()
    return found.join(sealed.select("fingerprint").distinct(), "fingerprint", "left_semi").select("row_id", "fingerprint")


def reserved_leaks(train: DataFrame, reserved: DataFrame, surfaces: list[str]) -> DataFrame:
    """For each surface column: values on both sides with the first line of each. A surface without reserved values gives
    one row with null lines: it was not evaluated."""
    out = None
    for s in surfaces:
        side = lambda df, name: df.where(F.col(s).isNotNull()).groupBy(F.col(s).cast("string").alias("key")).agg(F.min("line").alias(name))  # noqa: B023, E731
        right = side(reserved, "reserved_line")
        hits = side(train, "train_line").join(right, "key").select(F.lit(s).alias("surface"), "key", "train_line", "reserved_line")
        empty = right.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(s).alias("surface"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("train_line"), F.lit(None).cast("long").alias("reserved_line"))
        out = hits.unionByName(empty) if out is None else out.unionByName(hits).unionByName(empty)
    return out


def population_drift(sealed: DataFrame, population: DataFrame, sealed_fingerprint: str | None = None, of: DataFrame | None = None) -> DataFrame:
    """``fingerprint`` rows on both sides: how many sealed hashes the population still resolves, the hash of its sorted
    fingerprints (``of``: its ``sorted_digest``, where it is known already), and a verdict. None resolved fails: the sides hash different identifiers. With the population's fingerprint as it was
    sealed a population that has changed since is ``drifted`` and fails; without one that was not evaluated, and a sealed
    hash that is gone is suspect."""
    now = population.select("fingerprint").distinct()
    flagged = sealed.select("fingerprint").distinct().join(now.withColumn("there", F.lit(True)), "fingerprint", "left")
    of = (of or sorted_digest(now, "fingerprint")).select(F.col("members").alias("population"), F.left("fingerprint", F.lit(16)).alias("population_fingerprint"))
    counts = flagged.agg(F.count("*").alias("sealed"), F.count("there").alias("resolved")).crossJoin(of)
    drift = F.lit("not_evaluated") if sealed_fingerprint is None else F.when(F.col("population_fingerprint") == sealed_fingerprint, "clean").otherwise("drifted")
    verdict = F.when(((F.col("sealed") > 0) & (F.col("resolved") == 0)) | (F.col("drift") == "drifted"), "fail").when(F.col("resolved") < F.col("sealed"), "suspect").otherwise("pass")
    return counts.withColumn("drift", drift).withColumn("verdict", verdict)


def _prefix_tokens(ranked: Column, similarity: float) -> Column:
    """The tokens, rarest first, of which two sets of at least that Jaccard similarity must share one."""
    n = F.size(ranked)
    return F.slice(ranked, F.lit(1), F.greatest(n - F.ceil(F.lit(similarity) * n - 1e-9).cast("int") + 1, F.lit(1)))


def contradiction_rows(qa: DataFrame, ratio: float = 0.05) -> DataFrame:
    """Distinct rows with what contradictions compare. A subject is the question's name tokens that occur in fewer questions
    than ``max(2, ratio * questions)``. Rows equal in all of it are one, with their first line."""
    q, a = F.col("question"), F.col("answer")
    names, tokens = T.name_tokens(q), F.array_distinct(T.stems(q))
    asked = qa.groupBy("question").agg(F.count("*").alias("n"))  # a question's text is read once, however often it is asked
    total = qa.count()
    common = asked.select(F.explode(tokens).alias("t"), "n").groupBy("t").agg(F.sum("n").alias("df")).where(F.col("df") >= max(2, ratio * total))
    often = F.broadcast(common.agg(F.collect_set("t").alias("often")))  # at most mean tokens / ratio of them
    questions = asked.crossJoin(often).select(
        "question",
        F.array_join(F.array_sort(F.array_except(names, F.col("often"))), " ").alias("subject"),
        T.grounding_key(q).alias("facts"),
        tokens.alias("prompt"),
        T.ask_tokens(q).alias("ask"),
        T.is_yes_no(q).alias("yes_no"),
    )
    said = qa.groupBy("question", "answer", "marked").agg(F.min("line").alias("line"))
    answers = said.select("question", "line", "marked", T.stance(a).alias("stance"), T.sole_date(a).alias("date"), T.unit_claims(a).alias("units"))
    # a null question is a row as any other
    rows = answers.join(questions.withColumnRenamed("question", "_q"), F.col("question").eqNullSafe(F.col("_q")))
    return rows.groupBy("subject", "facts", "prompt", "ask", "yes_no", "stance", "date", "units", "marked").agg(F.min("line").alias("line"))


#: Rows of one block that are compared pair by pair; larger blocks are parted by prefix tokens.
BLOCK = 64


def _meeting(one: DataFrame, block: list[str], similarity: float, most: int) -> DataFrame:
    """Rows with the ``key`` under which those of one block meet: one key for a block of up to ``most`` rows; in a larger block the
    prefix tokens of the asks, rarest first, of which any two asks of that similarity share one."""
    large = one.groupBy(*block).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*block)
    few = one.join(large, block, "left_anti").withColumn("key", F.lit(""))
    many = one.join(large, block, "left_semi")
    asks = many.select("ask").distinct()
    freq = many.select(F.explode("ask").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    ranked = F.transform(F.array_sort(F.collect_list(F.struct("df", "t"))), lambda x: x["t"])  # one question's words
    keys = asks.withColumn("t", F.explode("ask")).join(freq, "t").groupBy("ask").agg(ranked.alias("r"))
    parted = many.join(keys, "ask").withColumn("key", F.explode(_prefix_tokens(F.col("r"), similarity)))
    return few.select(*one.columns, "key").unionByName(parted.select(*one.columns, "key"))


def contradictions(qa: DataFrame, similarity: float = 0.70, most: int = BLOCK) -> DataFrame:
    """Pairs that ask the same question of the same named subject and disagree: ``line_a, line_b, axis, marked``.

    Blocked by the rare name tokens of the subject and the facts supplied. The rows of a small block meet each other; in
    a larger one two rows meet only if they share a prefix token of their asks, rarest first, which any two asks of that
    similarity do, so a block of many unlike questions (such as those without a subject) is not compared pair by pair.
    Then prompt similarity, then the axis. Rows with equal answers are first put together, so a popular subject meets once
    per distinct answer and not once per pair of rows; lines are the first of each side.
    """
    return _contradicting(files.staged(contradiction_rows(qa), "answers"), similarity, most)


def _contradicting(one: DataFrame, similarity: float, most: int) -> DataFrame:
    side = _meeting(one, ["subject", "facts"], similarity, most)
    x, y = side.alias("x"), side.alias("y")
    same = (
        (F.col("x.subject") == F.col("y.subject"))
        & (F.col("x.facts") == F.col("y.facts"))
        & (F.col("x.key") == F.col("y.key"))
        & (F.col("x.line") < F.col("y.line"))
        & (T.jaccard(F.col("x.ask"), F.col("y.ask")) >= similarity)
        & (T.jaccard(F.col("x.prompt"), F.col("y.prompt")) >= similarity)
    )
    of = lambda s: F.struct(*[F.col(f"{s}.{c}").alias(c) for c in ("yes_no", "stance", "date", "units")])
    pairs = x.join(y, same).select(F.col("x.line").alias("line_a"), F.col("y.line").alias("line_b"), T.conflict_axis(of("x"), of("y")).alias("axis"), (F.col("x.marked") | F.col("y.marked")).alias("marked"))
    return pairs.where("axis is not null").distinct()  # a pair may share several prefix tokens


def divergent_grounding(qa: DataFrame, similarity: float = 0.70, most: int = BLOCK) -> DataFrame:
    """How many pairs ask alike of one subject from different facts, and so are not held against each other: ``pairs``. Rows that
    are equal in all that is compared are one; pairs meet by subject, and in a subject of many rows by a prefix token of
    their asks."""
    one = files.staged(contradiction_rows(qa).select("line", "subject", "facts", "prompt", "ask"), "grounds")
    side = _meeting(one, ["subject"], similarity, most)
    x, y = side.alias("x"), side.alias("y")
    same = (F.col("x.subject") == F.col("y.subject")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.line") < F.col("y.line")) & (F.col("x.facts") != F.col("y.facts"))
    like = (T.jaccard(F.col("x.ask"), F.col("y.ask")) >= similarity) & (T.jaccard(F.col("x.prompt"), F.col("y.prompt")) >= similarity)
    return x.join(y, same & like).select(F.col("x.line").alias("a"), F.col("y.line").alias("b")).distinct().agg(F.count("*").alias("pairs"))


def contradiction_report(qa: DataFrame, budget: int = 2_000_000) -> DataFrame:
    """Comparisons that blocks by subject would take, same-question pairs that conflict (unmarked and marked), and a
    verdict: no rows, or more comparisons than the budget, are suspect; an unmarked conflict fails."""
    one = files.staged(contradiction_rows(qa), "answers")
    blocks = one.groupBy("subject").agg(F.count("*").alias("n"))
    size = blocks.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0)).cast("long").alias("comparisons"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    found = _contradicting(one, 0.70, BLOCK).agg(F.count_if(~F.col("marked")).alias("unmarked"), F.count_if("marked").alias("marked"))
    verdict = F.when((F.col("rows") == 0) | (F.col("comparisons") > budget), "suspect").when(F.col("unmarked") > 0, "fail").otherwise("pass")
    return size.crossJoin(found).select("comparisons", "unmarked", "marked", verdict.alias("verdict"))


def best_spec(gaps: DataFrame, specs: DataFrame, least: float = 0.6) -> DataFrame:
    """``id, text`` against ``spec, mission``: the spec whose mission holds the largest share of a gap's content words, with
    that share; null below ``least``. Joined by word; of equal shares the first spec by name."""
    words = lambda c: F.array_distinct(F.filter(F.regexp_extract_all(F.lower(c), F.lit("[a-z][a-z0-9-]{3,}"), F.lit(0)), lambda w: ~w.isin(STOP_WORDS)))
    asked = gaps.select("id", words(F.col("text")).alias("w")).select("id", F.size("w").alias("n"), F.explode_outer("w").alias("word"))
    known = specs.select("spec", F.explode(words(F.col("mission"))).alias("word")).distinct()
    shared = asked.join(known, "word").groupBy("id", "n", "spec").agg(F.count("*").alias("k"))
    best = shared.groupBy("id").agg(F.min_by(F.struct("spec", F.bround(F.col("k") / F.col("n"), 4).alias("share")), F.struct(-F.col("k"), "spec")).alias("b"))
    return gaps.select("id").join(best.where(F.col("b.share") >= least), "id", "left").select("id", "b.spec", "b.share")


def artifact_flows(ledger: DataFrame, mode: str = "asof") -> DataFrame:
    """Write-to-read edges ``path, writer, reader, event_id``: a read takes the last write of its path before it, unless the
    reader wrote it. With ``mode="last"`` only the path's last write counts, and reads before it have none."""
    rows = ledger.where("ok and tool in ('read', 'write')")
    if mode == "last":
        last = rows.where("tool = 'write'").groupBy("path").agg(F.max_by(F.struct("session_id", "ts", "event_id"), F.struct("ts", "event_id")).alias("w"))
        found = rows.where("tool = 'read'").join(last, "path").where("w.ts <= ts")
    else:
        w = Window.partitionBy("path").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
        written = F.last(F.when(F.col("tool") == "write", F.struct("session_id", "ts")), True).over(w)
        found = rows.withColumn("w", written).where("tool = 'read' and w is not null")
    return found.where("w.session_id <> session_id").select("path", F.col("w.session_id").alias("writer"), F.col("session_id").alias("reader"), "event_id")


def match_unique_in_window(spans: DataFrame, points: DataFrame, slack: int = 2) -> DataFrame:
    """``key, label, start, end`` against ``label, ts, ref``: the one point of a label within the span (slack seconds each side), or
    null when none or several fit.

    Points and both ends of each span are put in one order of time per label; the number of points up to an end and the
    last point before it tell how many lie between and which one it is, so no pair of span and point is formed.
    """
    pad = F.expr(f"interval {slack} seconds")
    end = lambda at, side: spans.select("key", "label", at.alias("ts"), F.lit(side).alias("side"), F.lit(None).cast(points.schema["ref"].dataType).alias("ref"))
    dots = points.select(F.lit(None).cast(spans.schema["key"].dataType).alias("key"), "label", "ts", F.lit(1).alias("side"), "ref").where("ts is not null and ref is not null")
    rows = end(F.col("start") - pad, 0).unionByName(dots).unionByName(end(F.col("end") + pad, 2))
    w = Window.partitionBy("label").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("n", F.count("ref").over(w)).withColumn("last", F.last("ref", True).over(w)).where("side <> 1")
    of = seen.groupBy("key").agg(F.max(F.when(F.col("side") == 2, F.col("n"))).alias("upto"), F.max(F.when(F.col("side") == 0, F.col("n"))).alias("before"), F.max_by("last", "side").alias("ref"))
    return of.select("key", F.when(F.col("upto") - F.col("before") == 1, F.col("ref")).alias("ref"))


def match_prompt_prefix(records: DataFrame, transcripts: DataFrame, prefix: int = 200, seconds: int = 300) -> DataFrame:
    """``key, prompt, ts`` against ``ref, prompt, ts``: equal squashed prefixes; of several only a sole one within the time.
    Matches are counted, not paired, so a popular or empty prompt costs no more than its rows."""
    cut = F.left(T.squash(F.col("prompt")), F.lit(prefix))
    r = records.select("key", cut.alias("p"), F.col("ts").alias("at"))
    t = transcripts.select("ref", cut.alias("p"), "ts")
    sole = t.groupBy("p").agg(F.count("*").alias("n"), F.min("ref").alias("any"))
    span = F.expr(f"interval {seconds} seconds")
    second = F.date_trunc("second", "at")
    near = match_unique_in_window(
        r.select("key", F.col("p").alias("label"), (second - span).alias("start"), (second + span).alias("end")), t.select(F.col("p").alias("label"), F.date_trunc("second", "ts").alias("ts"), "ref"), slack=0
    ).select("key", F.col("ref").alias("close"))
    return r.join(sole, "p", "left").join(near, "key", "left").select("key", F.when(F.col("n") == 1, F.col("any")).otherwise(F.col("close")).alias("ref"))


#: How a prompt that spawns an agent begins, and where its label must end.
SPAWN_PREFIX, SPAWN_END = "You are", 160


def match_spawn_label(labels: DataFrame, prompts: DataFrame) -> DataFrame:
    """``key, text`` of prompts that spawn an agent (``You are ...``) to the label they name, or null: the first known label
    in the text, as a whole token, that ends within the first characters."""
    # a token that runs past the limit is cut there, and so names nothing unless it ends there
    whole = F.when(F.substring("text", SPAWN_END + 1, 1).rlike("[A-Za-z0-9_-]"), F.regexp_replace(F.left("text", F.lit(SPAWN_END)), "[A-Za-z0-9_-]+$", "")).otherwise(F.col("text"))
    asked = prompts.where(F.col("text").startswith(SPAWN_PREFIX)).select("key", whole.alias("text"))
    words = asked.select("key", F.posexplode_outer(F.regexp_extract_all(F.lower(F.left("text", F.lit(SPAWN_END))), F.lit("[a-z0-9][a-z0-9_-]*"), F.lit(0))).alias("at", "label"))
    known = labels.select(F.lower("label").alias("label")).distinct()
    first = words.join(known, "label").groupBy("key").agg(F.min_by("label", "at").alias("label"))
    return prompts.select("key").join(first, "key", "left")


def match_label(labels: DataFrame, prompts: DataFrame) -> DataFrame:
    """``key, text`` against labels: the one label that is a word of the text, or null. Texts are split to words and joined by
    word, so no pair of text and label is compared that shares none."""
    words = prompts.select("key", F.explode_outer(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)))).alias("label"))
    known = labels.select(F.lower("label").alias("label"), F.lit(1).alias("known")).distinct()
    of = words.join(known, "label", "left").groupBy("key").agg(F.count("known").alias("n"), F.min(F.when(F.col("known") == 1, F.col("label"))).alias("label"))
    return of.select("key", F.when(F.col("n") == 1, F.col("label")).alias("label"))


def prefixes(path: Column) -> Column:
    """All directory prefixes of a path, itself included."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def owner_of(paths: DataFrame, scopes: DataFrame, globs: DataFrame | None = None) -> DataFrame:
    """``path`` against ``scope, owner`` (a file or directory): the most specific scope wins, a tie between owners gives none.
    ``globs`` are further scopes with ``*`` (within a directory) or ``**``; each is looked for only under the directory
    before its first wildcard, and is as specific as it is long."""
    parts = paths.select("path").distinct().withColumn("scope", F.explode(prefixes(F.col("path"))))
    hits = parts.join(scopes.select("scope", "owner").distinct(), "scope")
    if globs is not None:
        fixed = F.regexp_replace(F.col("scope"), r"/?[^/*]*\*.*$", "")
        shape = F.regexp_replace(F.regexp_replace(F.regexp_replace("scope", r"([.+?()\[\]{}|^$])", r"\\$1"), r"\*\*", "\u0001"), r"\*", "[^/]*")
        known = globs.select("scope", "owner").distinct().select(F.col("scope").alias("glob"), "owner", fixed.alias("scope"), F.concat(F.lit("^"), F.replace(shape, F.lit("\u0001"), F.lit(".*")), F.lit("$")).alias("shape"))
        under = parts.unionByName(paths.select("path").distinct().withColumn("scope", F.lit("")))
        found = under.join(known, "scope").where(F.rlike("path", F.col("shape"))).select("path", F.col("glob").alias("scope"), "owner")
        hits = hits.select("path", "scope", "owner").unionByName(found)
    hits = hits.withColumn("r", F.rank().over(Window.partitionBy("path").orderBy(F.length("scope").desc())))
    best = hits.where("r = 1").groupBy("path").agg(F.countDistinct("owner").alias("n"), F.min("owner").alias("owner"))
    return paths.join(best.select("path", F.when(F.col("n") == 1, F.col("owner")).alias("owner")), "path", "left")


def fleet_view(ledger: DataFrame, beats: DataFrame, heads: DataFrame) -> DataFrame:
    """All sessions of dispatch ledger (last row each) and heartbeats (newest each), with their branch head: rows of either
    side are kept and ``source`` says where they came from."""
    last = ledger.groupBy("session_id").agg(F.max_by("tool", F.struct("ts", "event_id")).alias("last_tool"))
    beat = newest_beat(beats).select("session_id", "status")
    source = F.when(F.col("last_tool").isNull(), "beat").when(F.col("status").isNull(), "ledger").otherwise("both")
    return last.join(beat, "session_id", "full_outer").join(heads, "session_id", "left").withColumn("source", source)


def newest_beat(beats: DataFrame) -> DataFrame:
    """The newest heartbeat of a session: with a timestamp before without, then by time, then worktree before ref."""
    order = [F.col("ts").isNotNull().desc(), F.col("ts").desc(), (F.col("origin") == "worktree").desc(), F.col("event_id").desc()]
    return beats.withColumn("r", F.row_number().over(Window.partitionBy("session_id").orderBy(*order))).where("r = 1").drop("r")


def resolve_claims(claims: DataFrame, beats: DataFrame, me: str, now: str, minutes: int = 30) -> DataFrame:
    """``path, holder`` to FREE, MINE, LIVE or STALE; a holder without a readable fresh active beat is stale."""
    beat = newest_beat(beats).select(F.col("session_id").alias("holder"), "status", "ts")
    fresh = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("ts") <= 60 * minutes) & F.col("status").isin("working", "blocked")
    state = F.when(F.col("holder").isNull(), "FREE").when(F.col("holder") == me, "MINE").when(F.coalesce(fresh, F.lit(False)), "LIVE").otherwise("STALE")
    return claims.join(beat, "holder", "left").select("path", "holder", state.alias("state"))


def gate_outcomes(requests: DataFrame, decisions: DataFrame) -> DataFrame:
    """Requests with their latest decision, and the note of the latest rejection."""
    of = decisions.groupBy("request_id").agg(
        F.max_by("decision", F.struct("ts", "decision_id")).alias("decision"),
        F.max_by("note", F.struct(F.col("decision") == "rejected", "ts", "decision_id")).alias("n"),
        F.count_if(F.col("decision") == "rejected").alias("r"),
    )
    return requests.join(of, "request_id", "left").select("request_id", F.coalesce("decision", F.lit("pending")).alias("decision"), F.when(F.col("r") > 0, F.col("n")).alias("rejection_note"))


def decision_outcomes(decisions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Append-only decisions with the count and last of their append-only outcomes."""
    of = outcomes.groupBy("decision_id").agg(F.count("*").alias("n"), F.max_by("outcome", "seq").alias("outcome"))
    return decisions.join(of, "decision_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def first_difference(a: Column, b: Column) -> Column:
    """The place, from 1, at which two ordered chains differ; 0 if they are equal. A chain that ends early differs there, a
    null chain counts as empty."""
    none = F.array().cast("array<string>")
    x, y = F.coalesce(a, none), F.coalesce(b, none)
    n = F.greatest(F.size(x), F.size(y))
    places = F.filter(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: ~F.try_element_at(x, i).eqNullSafe(F.try_element_at(y, i)))
    return F.coalesce(F.try_element_at(places, F.lit(1)), F.lit(0))


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two chains: the table of the two, row by row."""
    none = F.array().cast("array<string>")
    x, y = F.coalesce(a, none), F.coalesce(b, none)
    zeros = F.transform(F.concat(F.array(F.lit("")), y), lambda _: F.lit(0))

    def row(above: Column, step: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(y))
        grown = lambda r, j: F.concat(r, F.array(F.greatest(F.element_at(r, -1), F.element_at(above, j + 1), F.element_at(above, j) + (F.element_at(y, j).eqNullSafe(step)).cast("int"))))
        return F.aggregate(at, F.array(F.lit(0)), grown)

    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0).otherwise(F.element_at(F.aggregate(x, zeros, row), -1))


def twin_chains(meta: DataFrame) -> DataFrame:
    """Each twin whose source is a retained real row: ``line, source_row_id, first_difference, common, steps`` of the two ordered tool
    chains. Of several real rows of one source the one with the smallest line counts."""
    real = meta.where("block = 'real_trajectory' and source_row_id is not null").groupBy(F.col("source_row_id").alias("twin_of")).agg(F.min_by("chain", "line").alias("_chain"))
    pairs = meta.where("block = 'twins'").join(real, "twin_of")
    return pairs.select("line", F.col("twin_of").alias("source_row_id"), first_difference(F.col("_chain"), F.col("chain")).alias("first_difference"), common_subsequence(F.col("_chain"), F.col("chain")).alias("common"), F.size(F.coalesce("chain", F.array().cast("array<string>"))).alias("steps"))


#: Fixed value: the tool by which a record gives its output.
EMIT_TOOL = "emit_output"


def audit_twin_lineage(meta: DataFrame, messages: DataFrame, fields: list[str], emit: str = EMIT_TOOL) -> DataFrame:
    """One row of twin lineage: counts of real rows and twins, of sources paired, unpaired, repeated and missing, of identity
    fields that differ and of chains that do (which is what a twin is for, and no fault); twins with tool calls, with
    results and with the output tool; three shares and a verdict for each question: source identity, one twin for
    each selected source, one for all real rows. ``messages`` has ``line, role, tool_name`` and a row for each call.
    ``meta`` is read a few times: write it first where it is dear to compute. Twins and real rows move once, by their source."""
    real, twins = meta.where("block = 'real_trajectory'"), meta.where("block = 'twins'")
    last, chain = F.max_by(F.struct(*fields), "line").alias("_last"), F.min_by("chain", "line").alias("_chain")
    by_source = real.where("source_row_id is not null").groupBy(F.col("source_row_id").alias("twin_of")).agg(F.count("*").alias("_n"), last, chain)
    differs = F.lit(0)
    for f in fields:
        differs = differs + (~F.col(f).eqNullSafe(F.col("_last")[f])).cast("int")
    found = F.col("_n").isNotNull()
    compared = twins.where("twin_of is not null").join(by_source, "twin_of", "left").select("twin_of", "_n", F.when(found, differs).alias("_d"), (found & (first_difference(F.col("_chain"), F.col("chain")) > 0)).alias("_c"))
    paired = compared.groupBy("twin_of").agg(F.count("*").alias("_t"), F.max("_n").alias("_n"), F.sum("_d").alias("_d"), F.count_if("_c").alias("_c"))  # lies by twin_of already
    nowhere = twins.where("twin_of is null").agg(F.max("twin_of").alias("twin_of"), F.count("*").alias("_t")).where("_t > 0")  # one group, which no shuffle need bring together
    sources = paired.unionByName(nowhere, allowMissingColumns=True).agg(
        F.count("*").alias("unique_paired_sources"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("twins"),
        F.count_if(F.col("_t") > 1).alias("duplicate_twin_sources"),
        F.count_if(F.col("_n").isNull()).alias("missing_sources"),
        F.count_if(F.col("twin_of").isNull()).alias("_null"),
        F.coalesce(F.sum("_d"), F.lit(0)).alias("identity_mismatches"),
        F.coalesce(F.sum("_c"), F.lit(0)).alias("chain_differences"),
    )
    called = (F.col("role") == "assistant") & F.col("tool_name").isNotNull()
    bit = lambda is_so, n: F.when(is_so, n).otherwise(0)
    has = bit(called, 1) + bit(F.col("role") == "tool", 2) + bit(called & (F.col("tool_name") == emit), 4)
    marks = messages.select("line", has.alias("_has")).unionByName(twins.select("line", F.lit(8).alias("_has"))).where("line is not null")  # a twin's line has 8, so no join is needed
    twin_with = lambda n: F.count_if(F.col("_has").bitwiseAND(n + 8) == n + 8)
    counts = marks.groupBy("line").agg(F.bit_or("_has").alias("_has")).agg(twin_with(1).alias("twins_with_calls"), twin_with(2).alias("twins_with_results"), twin_with(4).alias("twins_with_output"))
    every = real.agg(F.count("*").alias("real"), (F.count("*") - F.countDistinct("source_row_id") - F.max(F.col("source_row_id").isNull().cast("int"))).alias("duplicate_real_sources"))
    one = every.crossJoin(sources).crossJoin(counts).fillna({"duplicate_real_sources": 0})  # one row each
    identity = (F.col("duplicate_real_sources") == 0) & (F.col("duplicate_twin_sources") == 0) & (F.col("identity_mismatches") == 0) & (F.col("_null") == 0)
    verdict = lambda ok: F.when(F.col("twins") == 0, "suspect").when(ok, "pass").otherwise("fail")
    return one.select(
        "real", "twins", "unique_paired_sources", (F.col("real") - F.col("unique_paired_sources")).alias("unpaired_real"),
        "duplicate_real_sources", "duplicate_twin_sources", "missing_sources", "identity_mismatches", "chain_differences", "twins_with_calls", "twins_with_results", "twins_with_output",
        T.pct4(F.col("unique_paired_sources"), F.col("twins")).alias("selected_share"), T.pct4(F.col("unique_paired_sources"), F.col("real")).alias("real_share"), T.pct4(F.col("twins") - F.col("missing_sources"), F.col("twins")).alias("resolved_share"),
        verdict(identity).alias("source_identity"), verdict((F.col("twins") == F.col("unique_paired_sources")) & (F.col("duplicate_twin_sources") == 0) & (F.col("_null") == 0)).alias("one_to_one_selected"), verdict(F.col("real") == F.col("unique_paired_sources")).alias("one_to_one_all"),
    )


def audit_twins(meta: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Rows with ``twin_of`` against the real rows of that source: twins, missing and duplicate ones, each of the ``fields``
    that differs (``<field>_differs``), the share of real rows that have a twin, of twins with a real row and of twins
    that agree in all fields, and a verdict: no twins are suspect, missing or differing ones fail, duplicates are
    suspect."""
    fields = fields or ["gold_class"]
    same = meta.where("block = 'real_trajectory'")
    real = same.groupBy(F.col("source_row_id").alias("twin_of")).agg(F.count("*").alias("n"), *[F.min(f).alias(f"_{f}") for f in fields])
    twins = meta.where("twin_of is not null").join(real, "twin_of", "left")
    differs = {f: F.coalesce(F.col("n").isNotNull() & ~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(False)) for f in fields}
    clean = F.col("n").isNotNull()
    for d in differs.values():
        clean = clean & ~d
    of = twins.agg(
        F.count("*").alias("twins"),
        F.count_if(F.col("n").isNull()).alias("missing"),
        F.count_if(F.col("n") > 1).alias("duplicate"),
        *[F.count_if(d).alias(f"{f}_differs") for f, d in differs.items()],
        F.count_if(clean).alias("_clean"),
    )
    have = real.join(meta.select("twin_of").distinct(), "twin_of", "left_semi").agg(F.count("*").alias("_have")).crossJoin(real.agg(F.count("*").alias("_real")))
    wrong = F.col("missing")
    for f in fields:
        wrong = wrong + F.col(f"{f}_differs")
    return of.crossJoin(have).select(
        "twins", "missing", "duplicate", *[f"{f}_differs" for f in fields],
        T.pct4(F.col("_have"), F.col("_real")).alias("real_covered"),
        T.pct4(F.col("twins") - F.col("missing"), F.col("twins")).alias("twins_resolved"),
        T.pct4(F.col("_clean"), F.col("twins")).alias("twins_clean"),
        F.when(F.col("twins") == 0, "suspect").when(wrong > 0, "fail").when(F.col("duplicate") > 0, "suspect").otherwise("pass").alias("verdict"),
    )


def resolve_edges(edges: DataFrame, agents: DataFrame) -> DataFrame:
    """``from_key, to_key`` with the run of both agents: inferred when they agree or one alone is known."""
    a = agents.select(F.col("agent").alias("from_key"), F.col("run_id").alias("ra"))
    b = agents.select(F.col("agent").alias("to_key"), F.col("run_id").alias("rb"))
    run = F.when(F.col("ra").isNull() | (F.col("ra") == F.col("rb")), F.col("rb")).when(F.col("rb").isNull(), F.col("ra"))
    return edges.join(a, "from_key", "left").join(b, "to_key", "left").withColumn("run_id", run).drop("ra", "rb")


def parent_candidates(agents: DataFrame, dispatches: DataFrame, goals: DataFrame) -> DataFrame:
    """Claims on children from three sources: ``agents`` (``agent, folder``: the agent of the nearest folder above), dispatch
    records (``parent, child``) and agents named in goal texts (``parent, child``)."""
    above = agents.select(F.col("agent").alias("child"), F.posexplode(prefixes(F.col("folder"))).alias("depth", "p"))
    home = agents.select(F.col("agent").alias("parent"), F.array_join(F.filter(F.split("folder", "/"), lambda x: x != ""), "/").alias("p"))
    owners = above.join(home, "p").where("child <> parent")
    nearest = owners.withColumn("r", F.rank().over(Window.partitionBy("child").orderBy(F.col("depth").desc()))).where("r = 1").select("child", "parent", F.lit("folder").alias("basis"))
    named = lambda df, basis: df.where("child <> parent").select("child", "parent", F.lit(basis).alias("basis"))
    return nearest.unionByName(named(dispatches, "dispatch")).unionByName(named(goals, "goal"))


def parent_edges(candidates: DataFrame) -> DataFrame:
    """``child, parent, basis``: folder before dispatch before goal text; the first basis with exactly one claimant wins."""
    rank = F.when(F.col("basis") == "folder", 0).when(F.col("basis") == "dispatch", 1).otherwise(2)
    of = candidates.groupBy("child", "basis", rank.alias("rank")).agg(F.countDistinct("parent").alias("n"), F.min("parent").alias("parent")).where("n = 1")
    best = of.groupBy("child").agg(F.min_by(F.struct("parent", "basis"), "rank").alias("b"))
    return best.select("child", "b.parent", "b.basis", F.when(F.col("b.basis") == "goal", "medium").otherwise("high").alias("confidence"))


def pair_tool_results(messages: DataFrame) -> DataFrame:
    """Tool calls with the results of the same id in the record; unanswered calls have null."""
    calls = messages.where("role = 'assistant' and call_id is not null").select("line", "call_id", "tool_name")
    results = messages.where("role = 'tool'").groupBy("line", "call_id").agg(F.min_by("content", "pos").alias("result"))
    return calls.join(results, ["line", "call_id"], "left")


def bridge(runs: DataFrame, orgs: DataFrame) -> DataFrame:
    """``slug`` to ``org_id`` where the catalogue maps one to one; other slugs stay unmapped."""
    w = lambda c: F.count("*").over(Window.partitionBy(c))
    sole = orgs.select("slug", "org_id").distinct().withColumn("a", w("slug")).withColumn("b", w("org_id")).where("a = 1 and b = 1").select("slug", "org_id")
    return runs.join(sole, "slug", "left")


def orphans(contributions: DataFrame, attempts: DataFrame) -> DataFrame:
    return contributions.join(attempts.select("attempt_id").distinct(), "attempt_id", "left_anti")


def snapshot_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``key, digest`` of two snapshots: created, modified and deleted keys."""
    b, a = before.select(key, F.col("digest").alias("b"), F.lit(1).alias("in_b")), after.select(key, F.col("digest").alias("a"), F.lit(1).alias("in_a"))
    change = F.when(F.col("in_b").isNull(), "created").when(F.col("in_a").isNull(), "deleted").when(~F.col("a").eqNullSafe(F.col("b")), "modified")
    return b.join(a, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def lane_crossings(scopes: DataFrame, markers: dict[str, str]) -> DataFrame:
    """``id, lane, path``: scopes whose path holds another lane's marker (a path component) and not their own."""
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    other = F.array_compact(F.array(*[F.when(F.array_contains(parts, m) & (F.col("lane") != lane), F.lit(lane)) for lane, m in markers.items()]))
    own = F.coalesce(F.array_contains(parts, F.try_element_at(F.create_map(*[F.lit(x) for kv in markers.items() for x in kv]), F.col("lane"))), F.lit(False))
    return scopes.where(~own).select("id", "lane", F.explode(other).alias("crosses"))


def scope_overlaps(scopes: DataFrame) -> DataFrame:
    """``id, path``: pairs in which one path is a component prefix of the other (or equal), the smaller id first. All
    pairs are the result by definition; scopes are the few declared paths of roles, not documents."""
    parts = scopes.select("id", "path", F.explode(prefixes(F.col("path"))).alias("p"))
    outer = scopes.select(F.col("id").alias("other"), F.array_join(F.filter(F.split("path", "/"), lambda x: x != ""), "/").alias("p"))
    pairs = parts.join(outer, "p").where("id <> other")
    return pairs.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()


def artifact_closure(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """``path, sha`` declared and actual: missing, stale and undeclared artifacts."""
    d, a = declared.select("path", F.col("sha").alias("d"), F.lit(1).alias("in_d")), actual.select("path", F.col("sha").alias("a"), F.lit(1).alias("in_a"))
    fault = F.when(F.col("in_a").isNull(), "missing").when(F.col("in_d").isNull(), "undeclared").when(~F.col("a").eqNullSafe(F.col("d")), "stale")
    return d.join(a, "path", "full_outer").select("path", fault.alias("fault")).where("fault is not null")
