"""Projections that decide what may leave: allow-lists, scrubbing, refusal, and row validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import text as T


def allow_list(df: DataFrame, keys: list[str]) -> DataFrame:
    """Only listed columns; listed ones that are absent are left out."""
    return df.select(*[k for k in keys if k in df.columns])


def scrub_columns(df: DataFrame, content: list[str]) -> DataFrame:
    """Personal data scrubbed from content columns; identifier columns are exempt, as a phone shape fits digits of ids."""
    return df.withColumns({c: T.scrub_pii(F.col(c)) for c in content})


def redact_or_withhold(df: DataFrame, column: str = "content", limit: int = 8 << 20, literals: list[str] | None = None) -> DataFrame:
    """Redacted content, or null with a reason; content is never passed on as it was. ``too_long`` is longer than ``limit``
    characters and not searched at all; ``redaction_failed`` still holds something of a credential's shape, or one of the
    literals, after redaction."""
    clean = T.redact_secrets(F.col(column), literals)
    left = F.lit(False)
    for shape in T.SECRET_SHAPES:
        left = left | (F.instr("_clean", "eyJ") > 0) & F.col("_clean").rlike(shape) if shape.startswith("eyJ") else left | F.col("_clean").rlike(shape)
    for value in literals or []:
        left = left | F.contains("_clean", F.lit(value))
    reason = F.when(F.col(column).isNull(), "no_content").when(F.length(column) > limit, "too_long").when(F.col("_clean").isNull() | left, "redaction_failed")
    made = df.withColumn("_clean", F.when(F.length(column) <= limit, clean)).withColumn("reason", reason)
    return made.withColumn(column, F.when(F.col("reason").isNull(), F.col("_clean"))).drop("_clean")


def rows_with_keys(df: DataFrame, json_col: str, keys: list[str], depth: int = 12) -> DataFrame:
    """Rows whose JSON text has one of the keys at any depth; a sink refuses the set if there are any."""
    return df.where(T.has_json_key(F.col(json_col), keys, depth))


def assert_no_keys(df: DataFrame, json_col: str, keys: list[str], depth: int = 12) -> DataFrame:
    """``df``, failing at run time at the first row with a sensitive key."""
    bad = T.has_json_key(F.col(json_col), keys, depth)
    return df.withColumn(json_col, F.when(bad, F.raise_error(F.lit("sensitive key in " + json_col)).cast("string")).otherwise(F.col(json_col)))


def scrub_json_columns(df: DataFrame, columns: list[str], exempt: list[str] | None = None) -> DataFrame:
    """Personal data scrubbed from the text values of JSON columns at any depth; ``exempt`` fields keep their values."""
    return df.withColumns({c: T.scrub_json(F.col(c), exempt) for c in columns})


def project_detail(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Head and tail of a text within their limits, and the source, nulls kept as nulls."""
    return df.select("doc_id", F.left(F.col(text_col), F.lit(4000)).alias("head"), F.right(F.col(text_col), F.lit(500)).alias("tail"), "source")


#: Fields of a dispatch's detail that may be shown, and how much of its longest texts.
DETAIL_KEYS = ["spec_slug", "spec_version", "role_family", "model", "max_turns", "budget_usd", "cost_usd", "verdict", "exit_code", "final_response", "usage", "stderr_tail", "ledger_session_id"]
RESPONSE_CHARS, STDERR_CHARS = 4000, 500


def dispatch_detail(detail: Column) -> Column:
    """A detail (JSON text) with its listed fields only, in their listed order: null ones dropped, the response cut to its head and the
    error output to its tail, personal data scrubbed at any depth. What can't be read gives an empty object."""

    def project(v: Column) -> Column:
        def one(key: str) -> Column:
            value = F.try_variant_get(v, f"$.{key}", "variant")
            if key in ("final_response", "stderr_tail"):
                text = F.try_variant_get(v, f"$.{key}", "string")
                value = (F.left(text, F.lit(RESPONSE_CHARS)) if key == "final_response" else F.right(text, F.lit(STDERR_CHARS))).cast("variant")
            said = F.to_json(value)
            return F.when(said.isNotNull() & (said != "null"), F.concat(F.lit(f'"{key}":'), said))

        return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*[one(k) for k in DETAIL_KEYS])), ","), F.lit("}"))

    return T.scrub_json(T.let(F.try_parse_json(detail), project), ["ledger_session_id"])


def validate(df: DataFrame, id_col: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Rules ``(code, path, violated)`` to one row per violation: ``row_id, code, path``. A condition that is null counts as
    violated."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(code).alias("code"), F.lit(path).alias("path"))) for code, path, bad in rules]))
    return df.select(F.col(id_col).alias("row_id"), F.explode(found).alias("v")).select("row_id", "v.code", "v.path")
