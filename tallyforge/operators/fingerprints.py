"""Order-free fingerprints of sets of any size."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import sha256
from tallyforge.session import ship
from tallyforge.sources import files

#: Values hashed at once; larger sets are hashed in parts of about this size.
LEAF = 4096
#: Values that one task hashes of a set whose sorted values make one text.
RUN = 1 << 18


def _joined(lines: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(lines)), "\n"), 256)


def set_fingerprint(rows: DataFrame, column: str, by: list[str] | None = None, leaf: int = LEAF) -> DataFrame:
    """``*by, fingerprint, members`` for the distinct values of a column, null left out, in any order.

    Up to ``leaf`` values it is the sha256 of the sorted values joined by newlines. A larger set is split by the first hex
    digits of its values' sha256, as many as bring the parts to about ``leaf`` values; each part is hashed the same way,
    and the up to sixteen parts under each shorter prefix are hashed to one, up to the root. So no step holds more than a part
    or sixteen hashes, and equal sets have equal fingerprints however their rows are spread. Null keys are keys. Without
    ``by`` there is one row, also for an empty set."""
    key = F.struct(*(by or [F.lit(0).alias("_all")])).alias("_k")
    values = rows.select(key, F.col(column).cast("string").alias("_v")).where("_v is not null").distinct()
    digits = F.when(F.col("members") > leaf, F.ceil(F.log(16.0, F.col("members") / leaf) - 1e-9)).otherwise(0).cast("int")
    size = values.groupBy("_k").agg(F.count("*").alias("members")).withColumn("_d", digits)
    each = values.join(size.select("_k", "_d"), "_k")
    parts = each.groupBy("_k", F.substring(F.sha2("_v", 256), F.lit(1), F.col("_d")).alias("_p")).agg(_joined(F.col("_v")).alias("_h"))
    for depth in range(size.agg(F.max("_d")).first()[0] or 0, 0, -1):
        deep = parts.where(F.length("_p") == depth)
        up = deep.groupBy("_k", F.left("_p", F.lit(depth - 1)).alias("_p")).agg(_joined(F.concat_ws(":", F.right("_p", F.lit(1)), "_h")).alias("_h"))
        parts = parts.where(F.length("_p") < depth).unionByName(up)
    out = size.join(parts, "_k")
    if by:
        return out.select("_k.*", F.col("_h").alias("fingerprint"), "members")
    one = rows.sparkSession.range(1).join(out.select("_h", "members"), F.lit(True), "left")  # at most one row each
    return one.select(F.coalesce("_h", F.sha2(F.lit(""), 256)).alias("fingerprint"), F.coalesce("members", F.lit(0)).cast("long").alias("members"))


def sorted_digest(rows: DataFrame, column: str, run: int = RUN) -> DataFrame:
    """One row ``fingerprint, members``: the sha256 of a column's distinct values, sorted and joined by newlines, whatever their
    number; null left out. It is what ``set_fingerprint`` gives for sets of up to ``leaf`` values.

    Such a hash can only be computed from front to back. A set of over ``run`` values is written in ranges of about that
    many, and each range is hashed by a task of its own from where the range before it ended: no task holds more than a
    range, and the hash's state of some hundred bytes is all that passes from one to the next."""
    spark = rows.sparkSession
    values = rows.select(F.col(column).cast("string").alias("_v")).where("_v is not null").distinct()
    members = values.count()
    joined = F.array_join(F.array_sort(F.collect_list("_v")), "\n")
    if members <= run:
        return values.agg(F.sha2(joined, 256).alias("fingerprint"), F.count("*").alias("members"))
    ship(spark)
    at = f"{files.shared_folder(spark)}/sorted-{uuid.uuid4().hex}"
    values.repartitionByRange(-(-members // run), "_v").withColumn("_p", F.spark_partition_id()).write.partitionBy("_p").parquet(at)
    state, gap = sha256.START, ""
    for part in sorted((n for n in files.names(spark, at) if n.startswith("_p=")), key=lambda n: int(n[3:])):
        text = spark.read.schema("_v string").parquet(f"{at}/{part}").agg(F.concat(F.lit(gap), joined).alias("t"))
        state, gap = bytes(text.select(F.udf(sha256.absorber(state), "binary")("t").alias("s")).first().s), "\n"
    files.delete(spark, at)
    return spark.range(1).select(F.lit(sha256.digest(state)).alias("fingerprint"), F.lit(members).cast("long").alias("members"))
