"""The ledger of a swarm of agents: effective costs, budgets, the decision packet of each lane, and the rows it projects to.

The ledger is append-only: ``lane, seq, event_id, category, observed_at, data``, with a JSON text whose fields depend on the
category. What is said twice under one id counts as it was said last, by ``seq`` within the lane.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T

#: What money is spent on, states in which an attempt has ended, and ledger categories shown as steering events.
COST_CATEGORIES = ["agents", "corpus", "training", "evaluation", "shadow", "infrastructure"]
ENDED_STATES = ["COMPLETED", "BLOCKED", "TIMED_OUT", "FAILED", "UNRESUMABLE"]
STEERING = {"attempt_cost": "swarm_attempt_cost", "contribution": "swarm_contribution", "conflict": "swarm_conflict", "budget": "swarm_budget_state", "cloud_lease": "swarm_cloud_lease", "delegation": "swarm_delegation"}
#: Fixed value: the version that handoffs name as their writer.
SYNC_VERSION = "swarm-local-v1"


def _read(events: DataFrame, category: str, **fields: str) -> DataFrame:
    """Events of a category with fields of their data as columns: ``name="path"`` or ``name="path:type"``."""
    wanted = [(name, *path.partition(":")[::2]) for name, path in fields.items()]
    read = T.let(F.try_parse_json("data"), lambda v: F.struct(*[F.try_variant_get(v, f"$.{path}", kind or "string").alias(name) for name, path, kind in wanted]))
    return events.where(F.col("category") == category).select("lane", "seq", "event_id", "observed_at", read.alias("_d")).select("lane", "seq", "event_id", "observed_at", "_d.*")


def _latest(rows: DataFrame, key: str) -> DataFrame:
    w = Window.partitionBy("lane", key).orderBy(F.desc("seq"), F.desc("event_id"))
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def attempts(events: DataFrame) -> DataFrame:
    """Each attempt with its effective cost and session: those of its latest correction, if there is one, null included."""
    base = _read(events, "attempt", attempt_id="execution_attempt_id", role_id="logical_role_id", task_id="task_id", wave="wave", state="state", usd="cost.value_usd:double", accepted="cost.accepted_unknown:boolean", session="runtime_session_id")
    fix = _latest(_read(events, "attempt_cost", attempt_id="execution_attempt_id", f_usd="cost.value_usd:double", f_accepted="cost.accepted_unknown:boolean", f_session="runtime_session_id"), "attempt_id")
    both = base.join(fix.select("lane", "attempt_id", "f_usd", "f_accepted", "f_session", F.lit(True).alias("corrected")), ["lane", "attempt_id"], "left")
    pick = lambda name: F.when(F.col("corrected"), F.col(f"f_{name}")).otherwise(F.col(name)).alias(name)
    return both.select("lane", "seq", "event_id", "observed_at", "attempt_id", "role_id", "task_id", "wave", "state", pick("usd"), F.coalesce(pick("accepted"), F.lit(False)).alias("accepted"), pick("session"), F.coalesce("corrected", F.lit(False)).alias("corrected"))


def budgets(events: DataFrame) -> DataFrame:
    """The latest row of each budget."""
    return _latest(_read(events, "budget", budget_id="budget_id", cost_category="cost_category", usd="cost.value_usd:double", accepted="cost.accepted_unknown:boolean"), "budget_id").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def category_costs(events: DataFrame) -> DataFrame:
    """Per lane and cost category, all six always listed: what the latest budgets know, and how many do not."""
    of = budgets(events).groupBy("lane", "cost_category").agg(F.count("*").alias("entries"), F.count("usd").alias("_known"), F.sum("usd").alias("_usd"))
    every = events.select("lane").distinct().select("lane", F.explode(F.array(*map(F.lit, COST_CATEGORIES))).alias("cost_category"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return every.join(of, ["lane", "cost_category"], "left").select("lane", "cost_category", F.bround(F.coalesce("_usd", F.lit(0.0)), 2).alias("known_usd"), (zero("entries") - zero("_known")).alias("unknown_entries"), zero("entries").alias("entries"))


def attempt_costs(events: DataFrame) -> DataFrame:
    """Per lane: attempts, those of known and unknown cost, what is known, its coverage, and the coverage in dollars, which is 1 only
    when every cost is known and else null."""
    made = attempts(events)
    rows = made.groupBy("lane").agg(F.count("*").alias("attempts"))
    one = _latest(made, "attempt_id").groupBy("lane").agg(F.count("usd").alias("known"), F.sum("usd").alias("_usd"))
    return rows.join(one, "lane").select("lane", "attempts", "known", (F.col("attempts") - F.col("known")).alias("unknown"), F.bround(F.coalesce("_usd", F.lit(0.0)), 2).alias("known_usd"), T.pct4(F.col("known"), F.col("attempts")).alias("coverage"), F.when(F.col("known") == F.col("attempts"), 1.0).alias("dollar_coverage"))


def _names(values: Column) -> Column:
    """A set of a few fixed names as text."""
    return F.array_join(F.array_sort(F.collect_set(values)), ",")


def decision_packet(events: DataFrame) -> DataFrame:
    """One row per lane: its terminal decision, counts, the seven kinds of blockers and whether it is complete.

    ``no_terminal`` (no terminal decision), ``incomplete_attempts`` (not ended), ``unknown_costs`` (neither known nor accepted as
    unknown), ``missing_categories`` and ``unreconciled_categories`` (without a budget; with one neither known nor
    accepted), ``critical_conflicts`` (open, as last said) and ``orphan_contributions`` (of no attempt of the lane)."""
    made, spent = attempts(events), budgets(events)
    one = _latest(made, "attempt_id")
    work = made.groupBy("lane").agg(F.count("*").alias("attempts"), F.countDistinct("role_id").alias("roles"), F.count_if(~F.coalesce(F.col("state").isin(ENDED_STATES), F.lit(False))).alias("incomplete_attempts"))
    costs = one.groupBy("lane").agg(F.count_if(F.col("usd").isNull() & ~F.col("accepted")).alias("unknown_costs"))
    money = spent.groupBy("lane").agg(F.collect_set("cost_category").alias("_has"), _names(F.when(F.col("usd").isNull() & ~F.col("accepted"), F.col("cost_category"))).alias("unreconciled_categories"))
    said = _latest(_read(events, "conflict", conflict_id="conflict_id", severity="severity", status="status"), "conflict_id")
    fights = said.groupBy("lane").agg(F.count("*").alias("conflicts"), F.count_if((F.col("severity") == "critical") & (F.col("status") == "open")).alias("critical_conflicts"))
    gave = _read(events, "contribution", attempt_id="execution_attempt_id", disposition="disposition")
    known = one.select("lane", "attempt_id", F.lit(True).alias("_known"))
    given = gave.join(known, ["lane", "attempt_id"], "left").groupBy("lane").agg(F.count("*").alias("contributions"), F.count_if(F.col("disposition") == "accepted").alias("accepted_contributions"), F.count_if(F.col("_known").isNull()).alias("orphan_contributions"))
    ends = _read(events, "flow", flow_type="flow_type", terminal_state="terminal_state", signed_by="signed_by").where("flow_type = 'terminal_decision'")
    end = ends.groupBy("lane").agg(F.max_by(F.struct("terminal_state", "signed_by"), F.struct("seq", "event_id")).alias("_end"))
    lanes = events.select("lane").distinct()
    of = reduce(lambda a, b: a.join(b, "lane", "left"), (work, costs, money, fights, given, end), lanes)  # a row for each lane
    zeros = ["attempts", "roles", "incomplete_attempts", "unknown_costs", "conflicts", "critical_conflicts", "contributions", "accepted_contributions", "orphan_contributions"]
    of = of.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in zeros})
    have = F.coalesce("_has", F.array().cast("array<string>"))
    of = of.withColumn("missing_categories", F.array_join(F.array_except(F.array(*map(F.lit, sorted(COST_CATEGORIES))), have), ",")).withColumn("unreconciled_categories", F.coalesce("unreconciled_categories", F.lit("")))
    of = of.withColumn("no_terminal", F.col("_end").isNull())
    blocked = F.col("no_terminal") | (F.col("missing_categories") != "") | (F.col("unreconciled_categories") != "")
    for c in ("incomplete_attempts", "unknown_costs", "critical_conflicts", "orphan_contributions"):
        blocked = blocked | (F.col(c) > 0)
    return of.select(
        "lane", F.col("_end.terminal_state").alias("terminal_state"), F.col("_end.signed_by").alias("signed_by"), "attempts", "roles", F.greatest(F.lit(0), F.col("attempts") - F.col("roles")).alias("retries"),
        "contributions", "accepted_contributions", "conflicts", "no_terminal", "incomplete_attempts", "unknown_costs", "missing_categories", "unreconciled_categories", "critical_conflicts", "orphan_contributions", (~blocked).alias("complete"),
    )


def agent_rows(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Attempts as agent rows; ``runs`` has ``lane, run_id``."""
    title = F.concat_ws("-", F.element_at(F.split("role_id", "/"), -1), F.left("attempt_id", F.lit(8)))
    status = F.when(F.col("state").isin("PENDING", "RUNNING"), "active").otherwise("ended")
    return attempts(events).join(runs, "lane").select(F.col("attempt_id").alias("id"), "run_id", F.col("wave").alias("stage"), F.lit("reader").alias("role"), title.alias("title"), F.col("task_id").alias("goal"), status.alias("status"), F.col("usd").alias("cost_usd"), F.col("session").alias("ledger_session_id"))


def run_events(events: DataFrame, runs: DataFrame) -> DataFrame:
    """``id, run_id, ts, kind, headline, detail``: a dispatch event for each attempt, with an id that a second projection makes again
    and a detail without nulls, and a steering event for each other row that has one."""
    role, state = F.element_at(F.split("role_id", "/"), -1), F.lower("state")
    title = F.concat_ws("-", role, F.left("attempt_id", F.lit(8)))
    detail = F.to_json(F.struct(F.col("usd").alias("cost_usd"), F.col("session").alias("ledger_session_id"), F.lit("reader").alias("role_family"), role.alias("spec_slug"), state.alias("verdict")))  # null fields are left out
    sent = attempts(events).join(runs, "lane").select(T.uuid5_in(F.col("run_id"), F.concat_ws("|", F.lit("agent_dispatched"), "attempt_id")).alias("id"), "run_id", F.col("observed_at").alias("ts"), F.lit("agent_dispatched").alias("kind"), F.concat_ws(" ", title, F.lit("attempt"), state).alias("headline"), detail.alias("detail"))
    subtype = F.create_map(*[F.lit(x) for pair in STEERING.items() for x in pair])[F.col("category")]
    other = events.where(F.col("category").isin(list(STEERING))).join(runs, "lane")
    steer = other.select(F.col("event_id").cast("string").alias("id"), "run_id", F.col("observed_at").alias("ts"), F.lit("steering_event").alias("kind"), F.concat_ws(" ", subtype, F.lit("recorded for"), "lane").alias("headline"), F.to_json(F.struct("category", "lane")).alias("detail"))
    return sent.unionByName(steer)


def handoff_rows(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Handoff flows with their evidence."""
    flows = _read(events, "flow", flow_type="flow_type", from_ref="from_ref", to_ref="to_ref", artifact="artifact", sha="artifact_sha256").where("flow_type = 'handoff'")
    summary = F.concat(F.lit("type=HANDOFF; confidence=certain; evidence="), F.coalesce("artifact", F.lit("")), F.lit("#"), F.coalesce("sha", F.lit("")), F.lit(f"; sync_version={SYNC_VERSION}"))
    return flows.join(runs, "lane").select(F.col("event_id").cast("string").alias("id"), "run_id", F.col("from_ref").alias("from_agent_id"), F.col("to_ref").alias("to_agent_id"), "artifact", summary.alias("summary"), F.col("observed_at").alias("created_at"))
