"""HTML and Markdown reports, sidecars, metrics, twin chains, SQL functions, counted checks and streams."""

import difflib
import json
import random
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from tallyforge.functions import sql
from tallyforge.functions import text as T
from tallyforge.operators import joins as J
from tallyforge.operators import verify as V
from tallyforge.operators import verify_pass as VP
from tallyforge.plans import catalog
from tallyforge.plans import checks as K
from tallyforge.plans.fixtures import load
from tallyforge.plans.verify import DECLARED, whole_corpus
from tallyforge.sources import readers as R
from tallyforge.streaming import jobs

SF = "/root/testdata/sf0.001"


class Tables(HTMLParser):
    """The tables of a page without nesting, by the parser of the standard library."""

    def __init__(self):
        super().__init__()
        self.rows, self.table, self.cell = [], 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table, self.row = self.table + 1, 0
        if tag == "tr":
            self.row += 1
            self.rows.append([self.table, self.row, False, []])
        if tag in ("td", "th"):
            self.rows[-1][2] |= tag == "th"
            self.rows[-1][3].append("")
            self.cell = True

    def handle_endtag(self, tag):
        if tag in ("td", "th", "table", "tr"):
            self.cell = None

    def handle_data(self, data):
        if self.cell:
            self.rows[-1][3][-1] += data


def test_html_tables_equal_a_parser(spark):
    rng = random.Random(1)
    pages = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 3)):
            rows = []
            for r in range(rng.randint(1, 4)):
                tag = rng.choice(["td", "TH"]) if r == 0 else "td"
                cell = lambda: rng.choice(["a", " b  c ", "<b>x</b> y", "1 &amp; 2 &lt;z&gt;", "", "é\n\tü", "&quot;q&quot;"])
                rows.append("<tr>" + "".join(f'<{tag} class="n">{cell()}</{tag}>' for _ in range(rng.randint(1, 4))) + "</tr>\n")
            parts.append('<p>text</p><Table border="1"><thead>' + "".join(rows) + "</TABLE >")
        pages.append((i, "<html>" + "<i>between</i>".join(parts) + "</html>"))
    want = []
    for i, html in pages:
        p = Tables()
        p.feed(html)
        want += [(i, t, r, h, [" ".join(x.split()) for x in cells]) for t, r, h, cells in p.rows]
    got = R.html_tables(spark.createDataFrame(pages, "page_id int, html string")).collect()
    assert sorted((r.page_id, r.table, r.row, r.header, r.cells) for r in got) == sorted(want)


def test_scripts_and_hostile_pages(spark):
    n = 200_000
    rep = lambda s: s * (n // len(s))
    hostile = [rep("<title>"), rep("<script>"), rep("<"), rep("<script"), rep("<table>"), rep("<tr>"), rep("<td "), rep("<table><tr>"), rep("&amp;"), rep("</script>"), rep("<style>x</style>")]
    odd = [(100, "a<script>x<y>z</script>b<STYLE q=1>c</style>d"), (101, "a<script>never"), (102, "</script>a < b"), (103, None), (104, ""), (105, "<title>T</TITLE><title>U</title>x"), (106, "<title>none"), (107, "a" * 64 + " x")]
    begin = time.time()
    df = spark.createDataFrame([*enumerate(hostile), *odd], "page_id int, html string")
    plain = {r.page_id: r.t for r in df.select("page_id", R.plain_text(F.col("html")).alias("t")).collect()}
    titles = {r.page_id: r.title for r in R.scrape_reports(df).collect()}
    assert R.html_tables(df).count() > 0 and time.time() - begin < 60
    assert plain[100] == "a b d" and plain[101] == "a never" and plain[102] == "a < b" and plain[103] is None and plain[104] == ""
    assert titles[105] == "T" and titles[106] == "" and titles[0] == ""


def test_equal_headers_do_not_end_a_scan(spark):
    text = "# H\n|A|a|a#2|A|\n|--|--|--|--|\n|1|2|3|4|"
    got = R.read_md_tables(spark.createDataFrame([(1, text)], "doc int, text string"), "H").first()
    assert got.cells == {"a": "1", "a#2": "2", "a#4": "4"}


def test_a_corpus_of_part_files_is_numbered_through(spark, tmp_path):
    corpus, n = str(tmp_path / "x.jsonl"), 60
    ids = spark.range(n).repartitionByRange(7, "id").sortWithinPartitions("id")
    ids.select(F.concat(F.lit('{"messages": [{"role": "user", "content": "'), F.col("id").cast("string"), F.lit('"}]}')).alias("value")).write.text(corpus)
    ids.where("id <> 41").select(F.to_json(F.struct((F.col("id") + 1).alias("line"))).alias("value")).write.text(corpus.replace(".jsonl", ".meta.jsonl"))
    rows, _, state = R.read_with_sidecar(spark, corpus)
    assert {r.line: r.messages[0].content for r in rows.select("line", "messages").collect()} == {i + 1: str(i) for i in range(n)}
    assert rows.select("file").distinct().count() == 7 and tuple(state.drop("sidecar").first()) == (n, n - 1, 1, "fail")


def test_a_written_corpus_is_no_single_file(spark):
    """The query's corpus and its side table are written by as many tasks as sort it."""
    from tallyforge.plans import catalog
    from tallyforge.sources import files

    before = set(files.names(spark, files.shared_folder(spark)))
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        catalog.QUERIES["src_02_sidecar"](spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)
    folder = files.shared_folder(spark)
    made = [n for n in files.names(spark, folder) if n not in before]
    assert len(made) == 2
    for name in made:
        assert len([n for n in files.names(spark, f"{folder}/{name}") if n.startswith("part-")]) > 1


def test_sidecars_are_found_and_aligned(spark, tmp_path):
    corpus, meta = tmp_path / "c.jsonl", tmp_path / "c.meta.jsonl"
    corpus.write_text("\n".join(json.dumps({"messages": []}) for _ in range(3)) + "\n")
    assert R.find_sidecar(spark, str(corpus)) is None
    rows, side, state = R.read_with_sidecar(spark, str(corpus))
    assert side is None and state.first().verdict == "not_run" and rows.count() == 3
    meta.write_text("\n".join(json.dumps({"account_id": i}) for i in range(3)))
    _, side, state = R.read_with_sidecar(spark, str(corpus))
    assert (state.first().verdict, state.first().sidecar) == ("pass", str(meta)) and side.count() == 3
    meta.write_text("\n".join(json.dumps({"line": i}) for i in (1, 3, 4, 5)))
    assert tuple(R.read_with_sidecar(spark, str(corpus))[2].drop("sidecar").first()) == (3, 4, 3, "fail")
    meta.write_text("")
    assert R.read_with_sidecar(spark, str(corpus))[2].first().verdict == "suspect"


def test_metrics_by_alias(spark, tmp_path):
    lines = ['{"step": 1, "loss": 2.5}', "", "[1]", "epoch 3", '{"global_step": 2, "eval/loss": 1}', '{"loss": 1}', '{"step": "7", "epoch": 4.9, "train/loss": "x", "train_loss": 3}', '{"step": true}']
    (tmp_path / "m.jsonl").write_text("\n".join(lines))
    got = sorted(((r.step, r.train_loss, r.eval_loss, r.skipped) for r in R.read_metrics(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, 2.5, None, False), (2, None, 1.0, False), (4, 3.0, None, False), *[(None, None, None, True)] * 4], key=str)
    assert R.loss_curve(R.read_metrics(spark, str(tmp_path))).count() == 1  # the run has an evaluation loss


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_chains_compare_in_order(spark):
    rng = random.Random(3)
    chain = lambda: rng.choice([None, [], *[[rng.choice(["a", "b", "c", None]) for _ in range(rng.randint(1, 7))] for _ in range(8)]])
    rows = [(i, chain(), chain()) for i in range(150)]
    df = spark.createDataFrame(rows, "i int, a array<string>, b array<string>")
    got = {r.i: (r.f, r.c) for r in df.select("i", J.first_difference(F.col("a"), F.col("b")).alias("f"), J.common_subsequence(F.col("a"), F.col("b")).alias("c")).collect()}
    for i, a, b in rows:
        a, b = a or [], b or []
        first = next((k + 1 for k in range(max(len(a), len(b))) if (a[k] if k < len(a) else "end") != (b[k] if k < len(b) else "end")), 0)
        if first and first <= min(len(a), len(b)) or len(a) == len(b):
            assert got[i][0] == first
        assert got[i][1] == brute_lcs(a, b) >= difflib.SequenceMatcher(None, a, b).find_longest_match().size


def test_twin_lineage_of_clean_and_empty_tables(spark):
    schema = "line long, block string, source_row_id string, twin_of string, account string, chain array<string>"
    meta = spark.createDataFrame([(1, "real_trajectory", "s1", None, "a", ["x"]), (2, "twins", "s1", "s1", "a", ["y"]), (3, "replay", "s1", None, "b", None)], schema)
    said = spark.createDataFrame([(2, "assistant", "emit_output"), (2, "tool", None), (1, "assistant", "x")], "line long, role string, tool_name string")
    got = J.audit_twin_lineage(meta, said, ["source_row_id", "account"]).first()
    assert (got.source_identity, got.one_to_one_selected, got.one_to_one_all, got.chain_differences, got.twins_with_output) == ("pass", "pass", "pass", 1, 1)
    bad = meta.unionByName(spark.createDataFrame([(4, "twins", "s1", "s1", "z", []), (5, "twins", None, None, None, None)], schema))
    got = J.audit_twin_lineage(bad, said, ["account"]).first()
    assert (got.source_identity, got.one_to_one_selected, got.duplicate_twin_sources, got.identity_mismatches) == ("fail", "fail", 1, 1)
    assert J.audit_twin_lineage(meta.limit(0), said, ["account"]).first().source_identity == "suspect"


def test_twin_lineage_equals_a_count_by_hand(spark):
    """Repeated and null sources on both sides, null chains and fields, lines with many messages."""
    rng = random.Random(3)
    some = lambda n: rng.choice([None, *(f"s{i}" for i in range(n))])
    rows = [(i, rng.choice(["real_trajectory", "twins", "replay"]), some(30), some(40), some(2), rng.choice([None, [], ["x"], ["x", "y"]])) for i in range(300)]
    said = [(rng.randrange(330), rng.choice(["user", "assistant", "tool", None]), rng.choice([None, "read", "emit_output"])) for _ in range(500)]
    meta = spark.createDataFrame(rows, "line long, block string, source_row_id string, twin_of string, account string, chain array<string>")
    got = J.audit_twin_lineage(meta, spark.createDataFrame(said, "line long, role string, tool_name string"), ["source_row_id", "account"]).first()
    real, twins = ([r for r in rows if r[1] == b] for b in ("real_trajectory", "twins"))
    first, last, of = {r[2]: r for r in reversed(real) if r[2]}, {r[2]: r for r in real if r[2]}, [r[3] for r in twins]
    pairs = [r for r in twins if r[3] in last]
    assert (got.real, got.twins, got.unique_paired_sources, got.missing_sources) == (len(real), len(twins), len(set(of)), len(set(of) - set(last)))
    assert (got.duplicate_real_sources, got.duplicate_twin_sources) == (len(real) - len({r[2] for r in real}), sum(of.count(s) > 1 for s in set(of)))
    assert got.identity_mismatches == sum((r[2] != r[3]) + (r[4] != last[r[3]][4]) for r in pairs) > 0
    assert got.chain_differences == sum((r[5] or []) != (first[r[3]][5] or []) for r in pairs) > 0
    lines = {r[0] for r in twins}
    having = lambda is_so: len(lines & {line for line, role, tool in said if is_so(role, tool)})
    want = [having(lambda r, t: r == "assistant" and t), having(lambda r, _: r == "tool"), having(lambda r, t: r == "assistant" and t == "emit_output")]
    assert [got.twins_with_calls, got.twins_with_results, got.twins_with_output] == want


def test_twin_lineage_moves_twins_and_real_rows_once(spark):
    """Its query numbers meta once and writes it; the operator then joins twins and real rows once."""
    plan = catalog.QUERIES["jon_16_twin_lineage"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.count("Join LeftOuter") == 1 and "LeftSemi" not in plan


def test_functions_in_sql_equal_their_columns(spark):
    assert len(sql.register(spark)) >= 10
    docs = load(spark, SF, "documents").withColumn("status", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit(" **Improved "), "lang"))).withColumn("yes", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 2 == 0))
    t = F.col("text")
    both = {
        "squash(text)": T.squash(t), "norm_surface(text)": T.norm_surface(t), "prompt_fingerprint(text)": T.prompt_fingerprint(t), "fp16(text)": T.fp16(t),
        "opening(text, 6)": T.opening(t), "scrub_pii(text)": T.scrub_pii(t), "valid_pointer(source)": T.valid_pointer(F.col("source")), "error_severity(status)": T.error_severity(F.col("status")),
        "run_status(yes, not yes, null)": T.run_status(F.col("yes"), ~F.col("yes"), F.lit(None).cast("boolean")), "est_tokens_ceil(n_chars)": T.est_tokens_ceil(F.col("n_chars")), "est_tokens_floor(n_chars)": T.est_tokens_floor(F.col("n_chars")),
        "money_to_usd(doc_id, n_chars * 1000000)": T.money_to_usd(F.col("doc_id"), F.col("n_chars") * 1_000_000), "pct4(doc_id, n_chars % 3)": T.pct4(F.col("doc_id"), F.col("n_chars") % 3),
    }
    rows = docs.select(*[F.expr(e).eqNullSafe(column).alias(f"c{i}") for i, (e, column) in enumerate(both.items())])
    assert all(all(r) for r in rows.collect())


def test_one_pass_equals_the_rules_one_by_one(spark):
    corpus = whole_corpus(spark, SF).withColumn("call_type", F.when(F.col("line") % 47 != 0, "function")).withColumn("keys", F.when(F.col("line") % 40 == 0, F.array(F.lit("__Is_Probe"), F.lit("x"))))
    extra = spark.createDataFrame([(-1, i, r, c) for i, (r, c) in enumerate([("assistant", " "), ("assistant", "Do not train"), ("robot", "x"), ("system", None), ("tool", "?")])], "line long, pos long, role string, content string")
    calls = spark.createDataFrame([(-2, 0, "assistant", k, f"c{k % 17}", "view") for k in range(18)], "line long, pos long, role string, call int, call_id string, tool_name string")
    corpus = corpus.unionByName(extra, allowMissingColumns=True).unionByName(calls, allowMissingColumns=True).withColumn("call", F.coalesce("call", F.lit(0)))
    heads = corpus.where("call = 0")
    records = VP.keep(VP.digest(corpus, DECLARED, messages_cap=6, tokens_cap=1500))
    weights = corpus.groupBy("line").agg(F.first("record_weight", True).alias("weight"))
    called = corpus.where("call_id is not null and role = 'assistant'")
    want = V.union(
        V.rule_roles(heads), V.rule_tool_pairing(corpus), V.rule_tool_struct(corpus, DECLARED), V.rule_weights(weights), V.rule_masks(heads),
        V.rule_content(heads, F.col("call_id").isNotNull()), V.rule_caps(heads, called.select("line", "pos"), messages=6, tokens=1500), V.rule_grounding(heads, called),
        V.rule_probe_markers(heads), V.rule_probe_markers(corpus.where("keys is not null and pos = 0 and call = 0").withColumn("content", F.lit("")), keys_col="keys"),
    )
    got = VP.violations(records).where("rule <> 'duplicates'")
    assert want.count() > 100 and got.exceptAll(want).collect() == [] and want.exceptAll(got).collect() == []


def test_one_pass_report_says_what_did_not_run(spark):
    chat = spark.createDataFrame([(1, 0, "system", "s", 0.0), (1, 1, "user", "Hello?", 0.0), (1, 2, "assistant", "Yes.", 1.0)], "line long, pos long, role string, content string, weight double")
    records = VP.keep(VP.digest(chat, []))
    got = {r.rule: r for r in VP.report(records, weighted=False).collect()}
    assert {r for r, x in got.items() if x.verdict == "not_run"} == {"parse", "contamination", "manifest", "weights"}
    assert {x.verdict for r, x in got.items() if r not in ("parse", "contamination", "manifest", "weights")} == {"pass"} and got["masks"].coverage == 1.0
    raw = spark.createDataFrame([(1, '{"messages":[{"role":"user"}]}'), (2, "{bad")], "line long, raw string")
    got = {r.rule: r for r in VP.report(records, raw, weighted=False).collect()}
    assert got["parse"].verdict == "fail" and got["masks"].verdict == "suspect" and got["masks"].coverage == 0.5
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    empty = {x.verdict for x in VP.report(VP.keep(VP.digest(chat.limit(0), []))).collect()}
    assert empty == {"suspect", "not_run"}


def test_battery_counts_what_it_saw(spark):
    check = lambda: spark.createDataFrame([("a", 3, "fail"), ("b", 0, "pass")], "rule string, violations long, verdict string")
    bare = lambda: spark.createDataFrame([("pass",)], "verdict string")
    got = {r["check"]: tuple(r)[1:] for r in K.run_battery(spark, {"c": check, "bare": bare, "none": None}).collect()}
    assert got == {"c": ("fail", "", 2, 3), "bare": ("pass", "", 1, None), "none": ("not_mechanized", "", None, None)}


def test_late_rows_of_a_stream_are_counted(spark, tmp_path):
    schema = "ts timestamp, arm string, is_error boolean"
    src = str(tmp_path / "in")
    spark.createDataFrame([], schema).write.parquet(src)
    q = jobs.night_aggregates(jobs.read_log(spark, src, schema), "1 day", "nights").writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    day = 86_400
    for batch in ([(0, "a", False), (5, "a", True)], [(10 * day, "a", False)], [(1, "a", True), (2, "b", False), (10 * day + 1, "b", True)], [(20 * day, "a", False)]):
        spark.createDataFrame(batch, "s long, arm string, is_error boolean").select(F.timestamp_seconds(F.col("s") + 1_700_006_400).alias("ts"), "arm", "is_error").coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
    got = jobs.progress_counts(q.recentProgress, "nights")
    q.stop()
    assert (got["input"], got["late"], got["rows"], got["errors"]) == (7, 2, 7, 3)
    rows = {(str(r.night), r.arm, r.records, r.errors) for r in spark.table("late").collect()}
    assert ("2023-11-15", "a", 2, 1) in rows and not [r for r in rows if r[1] == "b" and r[0] == "2023-11-15"]


def test_repeated_key_starts_take_no_time(spark):
    n = 200_000
    texts = [p * (n // len(p)) for p in ("-----BEGIN PRIVATE KEY-----", "eyJ", "eyJ" + "a" * 20 + ".", "-----BEGIN ", "-----END PRIVATE KEY-----", "sk-", "ghp_", "AKIA")]
    key, jwt = "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----", "eyJ" + "a" * 20 + "." + "b" * 20 + "." + "c" * 9
    texts += [f"x {key} y {key} z -----BEGIN PRIVATE KEY----- open", f"pre{jwt} eyJshort.{jwt} end", f"eyJeyJ{jwt}"]
    begin = time.time()
    got = [r.t for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.redact_secrets(F.col("t")).alias("t")).orderBy("i").collect()]
    assert time.time() - begin < 30
    assert got[8] == "x [REDACTED] y [REDACTED] z -----BEGIN PRIVATE KEY----- open" and got[0] == texts[0]
    assert got[9] == "pre[REDACTED] eyJshort.[REDACTED] end" and got[10] == "[REDACTED]"


def test_texts_are_bound_where_a_lambda_names_them_twice():
    """Inside a lambda an expression is evaluated as often as it is written, so the content rule writes each search once."""
    message = F.struct(F.lit("assistant").alias("role"), F.lit("a **b").alias("content"), F.lit(None).cast("string").alias("call_id"), F.lit(None).cast("string").alias("tool_name"), F.lit(2).alias("pos"))
    written = str(T.let(message, VP._content)._jc.toString())
    assert written.count("regexp_replace") + written.count("RLIKE") + written.count("rlike") <= 2


def test_content_faults_of_the_pass_are_those_of_the_rule(spark):
    texts = ["a.", "", None, " \t\n\r\x0b\f", "**a", "``` x", "a", " a. \n", " ", "**a** ```b```!"]
    rows = [(i, 1, "assistant", t, "c" if call else None, None) for i, (t, call) in enumerate((t, call) for t in texts for call in (True, False))]
    chat = spark.createDataFrame(rows, "line long, pos int, role string, content string, call_id string, tool_name string")
    got = chat.withColumn("d", T.let(F.struct(*chat.columns), VP._content)).where("d is not null")
    want = V.rule_content(chat, F.col("call_id").isNotNull())
    assert sorted((r.line, r.d) for r in got.collect()) == sorted((r.line, r.detail) for r in want.collect()) != []
