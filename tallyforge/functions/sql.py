"""The scalar functions under their names in SQL: temporary functions of a session whose bodies are SQL, so Catalyst inlines
them like any expression."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyforge.functions import text as T


def _quoted(text: str) -> str:
    """A SQL literal of a text: backslashes and quotes escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chain(value: str, pairs: list[tuple[str, str]]) -> str:
    for shape, mark in pairs:
        value = f"regexp_replace({value}, {_quoted(shape)}, {_quoted(mark)})"
    return value


_SPACE = _quoted(r"[ \t\n\r\x0B\f]+")
#: name, parameters, result, body; a body may use the functions before it.
FUNCTIONS: list[tuple[str, str, str, str]] = [
    ("squash", "t STRING", "STRING", f"trim(regexp_replace(t, {_SPACE}, ' '))"),
    ("norm_surface", "t STRING", "STRING", f"lower(regexp_replace(t, {_SPACE}, ''))"),
    ("prompt_fingerprint", "t STRING", "STRING", "sha2(lower(squash(t)), 256)"),
    ("fp16", "t STRING", "STRING", "substring(sha2(t, 256), 1, 16)"),
    ("pct4", "n DOUBLE, d DOUBLE", "DOUBLE", "CASE WHEN d <> 0 THEN bround(n / d, 4) END"),
    ("est_tokens_floor", "chars BIGINT", "BIGINT", "floor(chars / 4)"),
    ("est_tokens_ceil", "chars BIGINT", "BIGINT", "greatest(ceil(chars / 4), 1)"),
    ("jaccard", "a ARRAY<STRING>, b ARRAY<STRING>", "DOUBLE", "CASE WHEN size(array_union(a, b)) > 0 THEN size(array_intersect(a, b)) / size(array_union(a, b)) ELSE 0.0D END"),
    ("opening", "t STRING, n INT", "STRING", "nullif(array_join(slice(regexp_extract_all(lower(t), '[a-z0-9\\']+', 0), 1, n), ' '), '')"),
    ("scrub_pii", "t STRING", "STRING", _chain("t", [(shape, mark) for mark, shape in T.PII_SHAPES])),
    ("valid_pointer", "ref STRING", "BOOLEAN", f"coalesce(ref RLIKE {_quoted('^[A-Za-z0-9(][A-Za-z0-9._/§#:@=,()+-]{0,199}$')}, false)"),
    ("run_status", "failed BOOLEAN, started BOOLEAN, finished BOOLEAN", "STRING", "CASE WHEN failed THEN 'failed' WHEN started AND finished THEN 'finished' WHEN started THEN 'running' ELSE 'queued' END"),
    ("error_severity", "status STRING", "STRING", f"CASE WHEN lower(regexp_replace(trim(status), {_quoted(r'^[*]+')}, '')) RLIKE '^(fixed|improved)' THEN 'minor' ELSE 'critical' END"),
    ("money_to_usd", "units BIGINT, nanos BIGINT", "DOUBLE", "bround(coalesce(units, 0) + coalesce(nanos, 0) / 1e9D, 4)"),
]


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session, in place of any of the same name; their names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [f[0] for f in FUNCTIONS]
