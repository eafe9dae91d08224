"""Mix sources to target weights by Poisson replication; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A variate of a larger rate is the sum of variates of equal parts of it, each at most this.
PART_RATE = 1000.0
#: Names that the operator adds while it works.
_OWN = "__mix_"


def unit(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 48 bits of the md5 of the parts, joined by colons."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def poisson_thresholds(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... copies, far enough that the rest is below 1e-15."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    logs = F.aggregate(
        F.sequence(F.lit(1), top),
        F.array(F.lit(0.0)),
        lambda acc, k: F.concat(acc, F.array(F.element_at(acc, -1) + F.ln(rate) - F.ln(k.cast("double")))),
    )
    return F.aggregate(
        logs,
        F.array().cast("array<double>"),
        lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + F.exp(x - rate))),
    )


def source_rates(docs: DataFrame, targets: dict[str, float], source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Per listed source with any text: ``source, rate, parts, thresholds`` (those of one part of the rate). The rate makes
    the expected characters of the source its target share of all characters of listed sources. At most
    ``len(targets)`` rows."""
    weights = F.create_map(*[F.lit(x) for s, w in targets.items() for x in (s, float(w))])
    sizes = (
        docs.groupBy(F.col(source_col).cast("string").alias("source"))
        .agg(F.sum(F.length(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("chars"))
        .where(F.col("source").isin(list(targets)) & (F.col("chars") > 0))
        .withColumn("weight", F.try_element_at(weights, F.col("source")))
        .where("weight > 0")
    )
    every = Window.partitionBy()  # over at most len(targets) rows
    sizes = sizes.withColumn("all_chars", F.sum("chars").over(every)).withColumn("all_weight", F.sum("weight").over(every))
    rate = F.col("weight") / F.col("all_weight") * F.col("all_chars") / F.col("chars")
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int")
    return sizes.select("source", rate.alias("rate")).withColumn("parts", parts).withColumn("thresholds", poisson_thresholds(F.col("rate") / F.col("parts")))


def mix(docs: DataFrame, targets: dict[str, float], seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keys: bool = False) -> DataFrame:
    """Each document as often as a Poisson variate of its source's rate says, in a globally shuffled order.

    The variate inverts the distribution at a number hashed from (seed, id), so it is the same on every run and on every
    partitioning. Documents of sources that are not listed, of a null source, or of a listed source without any
    characters come once; a listed weight of 0 leaves its source out. Rows that repeat an id get the same count; a
    null id is hashed by the text. Null and empty texts are replicated like others. No rate is too large: beyond
    ``PART_RATE`` the variate is a sum over parts, each with a hash of its own.
    The order is by a hash of (seed, id, copy): rows are dealt out by it and sorted within partitions, which no key
    can skew. Columns stay as they are; with ``keys`` the copy number ``copy`` and that hash ``shuffle_key`` follow.
    """
    if any(w < 0 for w in targets.values()):
        raise ValueError("weights must not be negative")
    own = {n: _OWN + n for n in ("id", "source", "parts", "thresholds", "copy", "key", "n")}
    ident = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    rates = source_rates(docs, targets, source_col, text_col).select(
        F.col("source").alias(own["source"]), F.col("parts").alias(own["parts"]), F.col("thresholds").alias(own["thresholds"])
    )
    dropped = [s for s, w in targets.items() if w == 0]
    plain = F.when(F.col(source_col).cast("string").isin(dropped), 0).otherwise(1) if dropped else F.lit(1)
    variate = lambda u: F.size(F.filter(F.col(own["thresholds"]), lambda c: c <= u)).cast("long")
    first = variate(F.col(own["n"]))
    others = F.transform(F.sequence(F.lit(2), F.greatest(F.col(own["parts"]), F.lit(2))), lambda k: variate(unit(F.lit(str(seed)), F.col(own["id"]), F.lit("part"), k.cast("string"))))
    several = F.aggregate(others, first, lambda a, x: a + x)
    count = F.when(F.col(own["thresholds"]).isNull(), plain).when(F.col(own["parts"]) > 1, several).otherwise(first)
    rows = (
        docs.withColumn(own["id"], ident)
        .withColumn(own["n"], unit(F.lit(str(seed)), F.col(own["id"])))
        .join(F.broadcast(rates), F.col(source_col).cast("string") == F.col(own["source"]), "left")  # at most len(targets) rows
        .withColumn(own["n"], count)
        .where(F.col(own["n"]) > 0)
        .withColumn(own["copy"], F.explode(F.sequence(F.lit(1), F.col(own["n"]).cast("int"))))
        .withColumn(own["key"], F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), F.col(own["id"]), F.col(own["copy"]).cast("string"))))
        .repartition(F.col(own["key"]))
        .sortWithinPartitions(own["key"])
    )
    extra = [F.col(own["copy"]).alias("copy"), F.col(own["key"]).alias("shuffle_key")] if keys else []
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)
