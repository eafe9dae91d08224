"""Personal data and sensitive keys inside JSON texts."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.operators import project as P


def flags(spark, texts, keys, **how):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", T.has_json_key(F.col("t"), keys, **how).alias("x")).orderBy("i").collect()]


def test_keys_are_found_however_they_are_written(spark):
    yes = [
        '{"output": 1}',
        '{"a": {"b": [{"c": [[{"output"\n\t\r : null}]]}]}}',
        '[1, "x", {"\\u006futput": 2}]',
        json.dumps({"a": [{"output": "x"}]}, indent=8),
        '{"a": 1, "a": 2, "output" : 3}',  # no readable object
        '{"output": 1',
    ]
    no = [None, "", "output", '"output"', '{"outputs": "output"}', '{"t": "he said \\"output\\": no"}', '{"a": ["output", 1.5, true, null]}', "[]", "{}"]
    assert flags(spark, yes, ["output", "thinking"]) == [True] * len(yes)
    assert flags(spark, no, ["output", "thinking"]) == [False] * len(no)
    assert flags(spark, ['{"a.b|(c": 1}', '{"axb": 1}', '{"a.b|(c" :'], ["a.b|(c"]) == [True, False, True]


def test_what_is_too_deep_is_refused(spark):
    deep = lambda n: "[" * n + "1" + "]" * n
    assert flags(spark, [deep(11), deep(13)], ["k"], depth=12) == [False, True]
    assert flags(spark, ['{"a":' * 30 + '{"k":1}' + "}" * 30], ["k"]) == [True]


def test_a_sink_fails_at_a_sensitive_key(spark):
    good = spark.createDataFrame([('{"a": {"b": 1}}',)], "t string")
    bad = good.unionByName(spark.createDataFrame([('{"a": [{"prompt"\n: 1}]}',)], "t string"))
    assert P.assert_no_keys(good, "t", ["prompt"]).count() == 1
    with pytest.raises(Exception, match="sensitive key"):
        P.assert_no_keys(bad, "t", ["prompt"]).collect()


def scrubbed(spark, texts, exempt=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", T.scrub_json(F.col("t"), exempt).alias("x")).orderBy("i").collect()]


def python_scrub(x, exempt, name=None):
    """The scrub on parsed values, with the shapes as plain regular expressions."""
    import re

    if isinstance(x, dict):
        return {k: python_scrub(v, exempt, k) for k, v in x.items()}
    if isinstance(x, list):
        return [python_scrub(v, exempt) for v in x]
    if isinstance(x, str) and name not in exempt:
        x = re.sub(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}".replace("\\\\", "\\"), "[redacted-email]", x)
        x = re.sub(r"\b\d{3}-\d{2}-\d{4}\b", "[redacted-ssn]", x)
        x = re.sub(r"(?:\+?1[-. \t\n]?)?\(?\d{3}\)?[-. \t\n]?\d{3}[-. \t\n]?\d{4}\b", "[redacted-phone]", x)
    return x


def test_nested_texts_are_scrubbed_and_identifiers_kept(spark):
    value = {
        "id": "212-555-0100",
        "a.b@c.example": "key stays",
        "notes": [{"said": "mail a.b@c.example\\ or \"x@y.example\"", "n": 2125550100}, ["ssn 123-45-6789", None, True, 1.50]],
        "deep": {"x": {"y": {"z": ["call 212\n555\t0100", "tab\there", "é \u2028", "\\", "\\\"", ""]}}},
        "run": {"id": "+1 (212) 555-0100"},
    }
    texts = [json.dumps(value), json.dumps(value, indent=2), json.dumps(value, ensure_ascii=False, separators=(",", ":"))]
    want = python_scrub(value, ["id"])
    got = scrubbed(spark, texts, ["id"])
    assert [json.loads(g) for g in got] == [want] * 3
    assert "2125550100" in got[0] and "1.5" in got[0] and "212-555-0100" in got[0]
    assert json.loads(scrubbed(spark, texts)[0])["id"] == "[redacted-phone]"


def test_other_texts_are_scrubbed_flat(spark):
    assert scrubbed(spark, [None, "", "write a@b.example", '{"a": "x@y.example"', '"x@y.example"', "12"]) == [None, "", "write [redacted-email]", '{"a": "[redacted-email]"', '"[redacted-email]"', "12"]


def test_long_and_hostile_texts_end(spark):
    n = 100_000
    texts = [json.dumps({"a": "\\\"" * n}), json.dumps({"a": ["b@"] * 20_000}), '{"a":' * 500 + "1" + "}" * 500, '"' * n, json.dumps("a" * n + "@b.example")]
    begin = time.time()
    assert len(scrubbed(spark, texts)) == len(texts)
    assert len(flags(spark, texts, ["password"])) == len(texts)
    assert time.time() - begin < 60
