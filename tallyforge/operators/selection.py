"""Windows, de-duplication, sealing, selection and set operations."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T


#: Rows that one task sorts where a whole table is numbered.
SORTED_AT_ONCE = 500_000


def number_rows(rows: DataFrame, order: list[str], name: str = "line", size: int = SORTED_AT_ONCE) -> DataFrame:
    """Rows with their place, from 1, in that order of the whole table. The first column of the order is a number without nulls;
    its quantiles cut the table in parts of about ``size`` rows, the parts' counts give where each part's places begin, and
    only the rows of one part are sorted together (those of one value of the first column are never parted)."""
    first, parts = F.col(order[0]), -(-rows.count() // size)
    cuts = sorted(set(rows.select(first.cast("double").alias("x")).approxQuantile("x", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    if cuts:
        cut = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_x", outputCol="_b")
        rows = cut.transform(rows.withColumn("_x", first.cast("double"))).withColumn("_b", F.col("_b").cast("int")).drop("_x")
    else:
        rows = rows.withColumn("_b", F.lit(0))
    starts, upto = [0] * (len(cuts) + 1), 0
    count = {r["_b"]: r["count"] for r in rows.groupBy("_b").count().collect()} if cuts else {}  # a row for each part
    for b in range(len(starts)):
        starts[b], upto = upto, upto + count.get(b, 0)
    place = F.row_number().over(Window.partitionBy("_b").orderBy(*order))
    dealt = rows.repartitionById(len(starts), F.col("_b"))
    return dealt.withColumn(name, place + F.element_at(F.lit(starts).cast("array<bigint>"), F.col("_b") + 1)).drop("_b")


def latest_status(findings: DataFrame, status: DataFrame) -> DataFrame:
    """``id`` with the status of the highest ``seq``; open where there is none."""
    last = status.groupBy("id").agg(F.max_by("status", "seq").alias("status"))
    return findings.join(last, "id", "left").select("id", F.coalesce("status", F.lit("open")).alias("status"))


def transition_findings(old: DataFrame, new: DataFrame, ran: DataFrame) -> DataFrame:
    """New findings get an open row; open ones whose check ran without finding them again get a resolved row."""
    opened = new.join(old.select("id"), "id", "left_anti").select("id", F.lit("open").alias("status"))
    gone = old.where("status = 'open'").join(ran.select("check").distinct(), "check", "left_semi").join(new.select("id"), "id", "left_anti")
    return opened.distinct().unionByName(gone.select("id", F.lit("resolved").alias("status")))


def append_new(board: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The batch's first row of each key that the board lacks."""
    w = Window.partitionBy(key).orderBy("seq")
    return batch.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").join(board.select(key).distinct(), key, "left_anti")


def dedupe_nights(rows: DataFrame) -> DataFrame:
    """``night, arm, mode, ref``: one row per night and arm, live before shadow before retro, with all refs merged in order."""
    rank = F.when(F.col("mode").startswith("live"), 0).when(F.col("mode").startswith("shadow"), 1).when(F.col("mode").startswith("retro"), 2).otherwise(3)
    refs = rows.groupBy("night", "arm", "ref").agg(F.min(rank).alias("rank"))
    of = rows.groupBy("night", "arm").agg(F.min_by("mode", rank).alias("mode"))
    merged = refs.groupBy("night", "arm").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "ref"))), lambda x: x["ref"].cast("string")), ",").alias("refs"))
    return of.join(merged, ["night", "arm"])


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """One row per edge with its strongest confidence, and the evidence of that confidence united."""
    rank = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).otherwise(1)
    top = F.max(rank).over(Window.partitionBy("edge_type", "from_key", "to_key"))
    best = edges.withColumn("_r", rank).withColumn("_t", top).where("_r = _t")
    return best.groupBy("edge_type", "from_key", "to_key", "confidence").agg(F.array_join(F.array_sort(F.collect_set("evidence")), ",").alias("evidence"))


def merge_boards(rows: DataFrame) -> DataFrame:
    return rows.groupBy("session").agg(F.max_by(F.struct("goal", "seq"), F.struct("seq", "goal")).alias("b")).select("session", "b.goal", "b.seq")


def agent_index(rows: DataFrame) -> DataFrame:
    """``title, run_id, last_seen_at, id``: of the rows of one title (white space squashed, empty ones dropped) one that belongs to a run
    comes first, then the one seen last."""
    title = T.squash(F.col("title"))
    best = F.max_by(F.struct("id", "run_id", "last_seen_at"), F.struct(F.col("run_id").isNotNull(), F.coalesce(F.col("last_seen_at").cast("string"), F.lit("")), "id"))
    return rows.where(title != "").groupBy(title.alias("title")).agg(best.alias("b")).select("title", "b.id", "b.run_id", "b.last_seen_at")


def seal_heldout(population: DataFrame, key: str, seed: str, fraction: float = 0.2, least: int = 5) -> DataFrame:
    """The first ``max(least, round_half_even(fraction * n))`` distinct keys by sha256 of ``seed:key``; refuses fewer than
    ``least`` keys. The same population and seed give the same seal."""
    ids = population.select(F.col(key).cast("string").alias("id")).where("id is not null").distinct().withColumn("h", F.sha2(F.concat(F.lit(seed + ":"), F.col("id")), 256))
    n = ids.count()
    if n < least:
        raise ValueError(f"{n} keys are too few to seal")
    take = max(least, round(fraction * n))
    return first_by_hash(ids, "h", take).select("id", F.substring(F.sha2("id", 256), 1, 16).alias("fingerprint"))


def first_by_hash(rows: DataFrame, column: str, take: int) -> DataFrame:
    """The ``take`` rows with the smallest hex hashes (ties by ``id``). Rows are counted by the first four digits; parts below
    the one in which the boundary lies are taken whole, and only that one is sorted: a share of all rows does not pass
    through one task."""
    part = F.substring(column, 1, 4)
    upto, boundary, before = 0, None, 0
    for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():  # at most 65536 parts
        if upto + r.n > take:
            boundary, before = r.p, upto
            break
        upto += r.n
    if boundary is None:
        return rows
    return rows.where(part < boundary).unionByName(rows.where(part == boundary).orderBy(column, "id").limit(take - before))


def is_held_out(rows: DataFrame, key: str, sealed: DataFrame) -> DataFrame:
    flags = sealed.select("fingerprint").distinct().withColumn("held_out", F.lit(True))
    return rows.withColumn("fingerprint", T.fp16(F.col(key).cast("string"))).join(flags, "fingerprint", "left").withColumn("held_out", F.coalesce("held_out", F.lit(False)))


def lease_chain(beats: DataFrame, lease_s: int = 1800, now: str | None = None) -> DataFrame:
    """Per holder: the first break of its lease chain, or null: sequence not +1, or not issued after the lease before began
    and before it ran out. With ``now`` the last lease must still be active. Where beats carry ``expires_at`` a lease
    must last exactly ``lease_s``."""
    w = Window.partitionBy("session_id").orderBy("seq")
    fault = (
        F.when(F.col("ts").isNull(), "no_time")
        .when(F.lag("seq").over(w) + 1 != F.col("seq"), "sequence")
        .when(F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(w)) > lease_s, "late")
    )
    if "expires_at" in beats.columns:
        fault = F.coalesce(fault, F.when(~F.coalesce(F.unix_timestamp("expires_at") - F.unix_timestamp("ts") == lease_s, F.lit(False)), "length"), F.when(F.col("ts") <= F.lag("ts").over(w), "early"))
    if now is not None:
        over = F.lead("seq").over(w).isNull() & (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("ts") >= lease_s)
        fault = F.coalesce(fault, F.when(over, "expired"))
    each = beats.withColumn("fault", fault)
    return each.groupBy("session_id").agg(F.min(F.when(F.col("fault").isNotNull(), F.struct("seq", "fault"))).alias("f")).select("session_id", F.col("f.fault").alias("fault"), F.col("f.seq").cast("string").alias("seq"))


def run_lineage(runs: DataFrame) -> DataFrame:
    """Per org in time order: the iteration grows after each terminal run; first run or retrain; the digest before."""
    w = Window.partitionBy("org").orderBy("ts", "id")
    done = F.sum(F.col("terminal").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    before = F.last(F.when(F.col("terminal"), F.col("id")), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return runs.select("id", "org", (F.coalesce(done, F.lit(0)) + 1).alias("iteration"), F.when(before.isNull(), "first").otherwise("retrain").alias("kind"), before.cast("string").alias("predecessor"))


def recipe_diff(runs: DataFrame, key: str, order: str, variables: list[str], most: int = 4) -> DataFrame:
    """Variables that changed against the run before, compared only where both are known; more than ``most`` warn."""
    w = Window.partitionBy(key).orderBy(order)
    changed = F.array_compact(F.array(*[F.when(F.lag(v).over(w).isNotNull() & F.col(v).isNotNull() & (F.lag(v).over(w) != F.col(v)), F.lit(v)) for v in variables]))
    out = runs.withColumn("changed", changed)
    return out.select(key, order, F.array_join("changed", ",").alias("changed"), F.when(F.size("changed") > most, "warn").otherwise("pass").alias("verdict"))


def hazard_hits(specs: DataFrame, hazards: list[tuple[str, list[str], list[str]]], column: str = "text") -> DataFrame:
    """Specs with any trigger of a hazard and none of its countermeasures, case-insensitive. Hazards are a bounded list."""
    low = F.lower(F.col(column))

    def any_of(words: list[str]) -> Column:
        out = F.lit(False)
        for word in words:
            out = out | low.contains(word.lower())
        return out

    hits = F.array_compact(F.array(*[F.when(any_of(t) & ~any_of(c), F.lit(h)) for h, t, c in hazards]))
    return specs.select("spec", F.explode(hits).alias("hazard"))


def uncited_rows(specs: DataFrame, column: str = "text", row: str = r"^\| S-", citation: str = r"\[[0-9]+\]") -> DataFrame:
    """Table rows of a spec that lack a citation, with their line numbers."""
    lines = specs.select("spec", F.posexplode(F.split(column, "\n")).alias("n", "line"))
    return lines.where(F.col("line").rlike(row) & ~F.col("line").rlike(citation)).select("spec", (F.col("n") + 1).alias("line_number"))


def select_capped(pool: DataFrame, k: int, per_account: int, share: float, seed: str) -> DataFrame:
    """A deterministic pick of ``k``: at most ``per_account`` of an account and ``share * k`` of a class, in hash order."""
    h = F.sha2(F.concat_ws(":", F.lit(seed), F.col("id").cast("string")), 256)


    def first(df: DataFrame, column: str, most: int) -> DataFrame:
        """The first ``most`` of each value, first in 64 parts of it, so a popular value is no single sort."""
        for by in ([column, F.substring("h", 1, 2)], [column]):
            df = df.withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy("h", "id"))).where(F.col("_k") <= most).drop("_k")
        return df

    capped = first(first(pool.withColumn("h", h), "account_id", per_account), "class", int(share * k))
    return first_by_hash(capped, "h", k).drop("h")


def over_generate(pool: DataFrame, k: int, per_account: int, share: float, seed: str, over: float = 2.0) -> DataFrame:
    """Candidates for ``k`` places: up to ``over * k`` rows under the caps of an account and a class (of ``over * k``), of which the first
    ``k`` in hash order are ``picked``. The same seed gives the same candidates and picks."""
    drafted = select_capped(pool, int(over * k), per_account, share, seed)
    h = F.sha2(F.concat_ws(":", F.lit(seed), F.col("id").cast("string")), 256)
    chosen = first_by_hash(drafted.withColumn("h", h), "h", k).select("id", F.lit(True).alias("picked"))
    return drafted.join(chosen, "id", "left").withColumn("picked", F.coalesce("picked", F.lit(False)))


def apply_doses(corpus: DataFrame, doses: dict[str, int], halve: list[str], seed: str) -> DataFrame:
    """Rows of a slice repeated by its dose, or half of them by hash parity; ``copy`` numbers the repeats."""
    dose = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in doses.items() for x in (k, v)]), F.col("slice")), F.lit(1))
    even = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("id").cast("string"))), 1, 1), 16, 10).cast("int") % 2 == 0
    return corpus.where(~F.col("slice").isin(halve) | even).withColumn("copy", F.explode(F.sequence(F.lit(1), dose)))


def blocked_on(stages: DataFrame) -> DataFrame:
    """``org, idx, stage, gate, approved``: the first unapproved gate before each stage."""
    w = Window.partitionBy("org").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    return stages.select("org", "idx", F.first(F.when(~F.col("approved"), F.col("gate")), True).over(w).alias("blocked_on"))


def top_k(df: DataFrame, column: str, k: int, order: str) -> DataFrame:
    """The ``k`` most frequent values; ties by first occurrence."""
    of = df.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return of.orderBy(F.col("n").desc(), "first").limit(k).select(column, "n")


def order_fleet(view: DataFrame) -> DataFrame:
    """Rank sessions for display: blocked, failed, live, done; without a time first; oldest first."""
    rank = F.when(F.col("status") == "blocked", 0).when(F.col("status") == "failed", 1).when(F.col("status") == "done", 3).otherwise(2)
    return view.withColumn("severity", rank).orderBy("severity", F.col("ts").asc_nulls_first(), "session_id")


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows on one side only, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def union_all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def disjoint(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many distinct rows two sets share, and a verdict."""
    return a.intersect(b).agg(F.count("*").alias("shared")).withColumn("verdict", F.when(F.col("shared") == 0, "pass").otherwise("fail"))


# --- sinks: the new state of a target table ------------------------------------------------------------------------


def upsert(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target after merging rows by key: given columns of a row win where not null, others stay."""
    other = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in other])
    r = rows.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in other if c in rows.columns])
    pick = [F.coalesce(f"_r_{c}", f"_t_{c}").alias(c) if c in rows.columns else F.col(f"_t_{c}").alias(c) for c in other]
    return t.join(r, keys, "full_outer").select(*keys, *pick)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(rows.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def copy_catalog(parents: DataFrame, children: DataFrame, keep: Column, parent_key: str, child_key: str) -> tuple[DataFrame, DataFrame]:
    """Parents that pass, and the children that follow them."""
    kept = parents.where(keep)
    return kept, children.join(kept.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def copy_natural(table: DataFrame, keys: list[str], surrogate: str = "id") -> DataFrame:
    """A table whose rows are known by a natural key, for a copy into another database: the surrogate id, which would clash
    there, is dropped, and of rows of one key the one with the largest id is kept."""
    rest = [c for c in table.columns if c not in (*keys, surrogate)]
    last = F.max_by(F.struct(F.lit(1).alias("_one"), *rest), surrogate).alias("r")
    return table.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col(f"r.{c}") for c in table.columns if c != surrogate])


def changed_only(new: DataFrame, old: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows whose content hash differs from the stored one, or that are not stored."""
    before = old.select(key, F.col(digest).alias("_old"))
    return new.join(before, key, "left").where(~F.col(digest).eqNullSafe(F.col("_old"))).drop("_old")


def attribute_first(target: DataFrame, claims: DataFrame, key: str, column: str) -> DataFrame:
    """Set a null column from the earliest claim; a set one stays."""
    first = claims.groupBy(key).agg(F.min_by("value", F.struct("ts", "value")).alias("_v"))
    return target.join(first, key, "left").withColumn(column, F.coalesce(column, "_v")).drop("_v")


def patch_links(agents: DataFrame, links: DataFrame, key: str, column: str) -> DataFrame:
    """Fill a null link from one agreed candidate; ``conflict`` marks rows whose link differs and was kept."""
    cand = links.groupBy(key).agg(F.countDistinct("value").alias("_n"), F.min("value").alias("_v"))
    j = agents.join(cand, key, "left")
    conflict = F.coalesce((F.col("_n") > 1) | (F.col(column).isNotNull() & (F.col(column) != F.col("_v"))), F.lit(False))
    return j.withColumn("conflict", conflict).withColumn(column, F.coalesce(column, F.when(F.col("_n") == 1, F.col("_v")))).drop("_n", "_v")
