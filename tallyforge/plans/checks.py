"""The check framework: a battery of named checks, hooks, validators by kind, and findings with deterministic ids.

A check is a function that returns a DataFrame with a ``verdict`` column (and any counts). One that fails, or that
returns no verdict at all, is suspect: what could not be evaluated never reads as pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import text as T

Check = Callable[[], DataFrame]
HOOKS: dict[str, dict[str, Callable[..., DataFrame]]] = {"pre-s4": {}, "pre-s5": {}, "pre-s6g": {}, "pre-s7": {}}
VALIDATORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def run_battery(spark: SparkSession, checks: dict[str, Check | None]) -> DataFrame:
    """``check, verdict, note, rows, violations``: a check of None is not mechanised. Each check runs by itself, aggregated by Spark
    to its worst verdict; its rows, and their ``violations`` where it has such a column, are observed while it runs. One
    that fails, while it is planned or while it runs, is suspect with the error's name and no counts."""
    schema = "check string, verdict string, note string, rows long, violations long"
    out = None
    for name, check in checks.items():
        if check is None:
            row = (name, "not_mechanized", "", None, None)
        else:
            try:
                df, seen = check(), Observation()
                counts = [F.count(F.lit(1)).alias("rows"), (F.sum("violations") if "violations" in df.columns else F.max(F.lit(None).cast("long"))).alias("violations")]
                verdict = df.observe(seen, *counts).agg(T.worst_verdict(F.col("verdict")).alias("verdict")).first()[0]  # one row; it runs here, so a check that fails while it runs is caught
                row = (name, verdict, "", seen.get["rows"], seen.get["violations"])
            except Exception as e:  # noqa: BLE001
                row = (name, "suspect", type(e).__name__, None, None)
        one = spark.createDataFrame([row], schema)
        out = one if out is None else out.unionByName(one)
    return out


def register_check(hook: str, name: str, function: Callable[..., DataFrame]) -> None:
    HOOKS[hook][name] = function


def run_hook(spark: SparkSession, hook: str, *inputs: DataFrame) -> DataFrame:
    """All checks of a hook over the same inputs; a hook without checks gives one suspect row."""
    checks = {n: (lambda f=f: f(*inputs)) for n, f in HOOKS[hook].items()}
    return run_battery(spark, checks) if checks else spark.range(1).select(F.lit(hook).alias("check"), F.lit("suspect").alias("verdict"), F.lit("no checks").alias("note"), F.lit(0).cast("long").alias("rows"), F.lit(None).cast("long").alias("violations"))


def validate_kind(kind: str, df: DataFrame) -> DataFrame:
    if kind not in VALIDATORS:
        raise ValueError(f"no validator for {kind}")
    return VALIDATORS[kind](df)


def make_findings(violations: DataFrame, auditor: str, severity: str) -> DataFrame:
    """``rule, line, detail`` to findings whose id is a hash of what they say, so a second run makes the same ids."""
    body = F.concat_ws("\x1f", F.lit(auditor), "rule", F.col("line").cast("string"), "detail")
    return violations.select(T.fp16(body).alias("id"), F.lit(auditor).alias("auditor"), F.lit(severity).alias("severity"), "rule", "line", F.lit("fail").alias("verdict"))


def recipe_comparison(diff: DataFrame) -> DataFrame:
    """Changed-variable rows as one JSON text per run."""
    return diff.select(F.to_json(F.struct(*[F.col(c) for c in sorted(diff.columns)])).alias("artifact"))
