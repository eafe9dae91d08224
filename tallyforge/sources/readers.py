"""Scans: chat corpora with line numbers, side tables, logs by day, night folders, reports and Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.functions import text as T
from tallyforge.sources import files

MODES = {"-live": "live-shadow", "-retro": "retro-replay"}


def numbered_lines(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """``file, line, raw`` of text files, lines from 1, blank ones counted but left out. Lines are numbered within each split,
    and the splits' counts (one row per split) are summed to offsets, so no file meets in one task. With ``across`` the
    files of the path are one text, in the order of their names."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("raw"), (F.trim("value") != "").alias("some"))
    counts = rows.groupBy("file", "block").agg(F.count("*").alias("n"))
    order = Window.orderBy("file", "block") if across else Window.partitionBy("file").orderBy("block")  # a row for each split
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("file", "block", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
    return rows.withColumn("i", within).join(offsets, ["file", "block"]).where("some").select("file", (F.col("offset") + F.col("i")).alias("line"), "raw")


def parse_chat(lines: DataFrame) -> DataFrame:
    """``raw`` lines to ``ok, messages, tools, weight, rec``: unreadable lines and non-objects survive with ``ok`` false. The VARIANT is kept, as
    a missing field and a null one differ."""
    v = F.try_parse_json("raw")
    ok = v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    messages = F.try_variant_get(v, "$.messages", "array<struct<role:string,content:string,weight:double>>")
    return lines.withColumn("rec", v).withColumns({"ok": F.coalesce(ok, F.lit(False)), "messages": messages, "tools": F.try_variant_get(v, "$.tools", "array<variant>"), "weight": F.try_variant_get(v, "$.weight", "double")})


def read_chat_corpus(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    return parse_chat(numbered_lines(spark, path, across))


META_SCHEMA = "line long, account_id string, candidate_id string, cf_group string, sha256_record string, source_row_id string, night date, gold_class string, block string, twin_of string, chain string"


def read_meta(spark: SparkSession, path: str, across: bool = False) -> DataFrame:
    """A sidecar by its schema; a line number that the rows do not carry is taken from their place."""
    lines = numbered_lines(spark, path, across)
    row = F.from_json("raw", META_SCHEMA)
    return lines.select(F.coalesce(row["line"], F.col("line")).alias("line"), *[row[n].alias(n) for n in [x.split()[0] for x in META_SCHEMA.split(", ")][1:]])


def find_sidecar(spark: SparkSession, corpus: str) -> str | None:
    """The side file beside a corpus: ``x.meta.jsonl`` for ``x.jsonl``, else the corpus' name with ``.meta.jsonl`` behind it; None if
    there is none."""
    path = (corpus[: -len(".jsonl")] if corpus.endswith(".jsonl") else corpus) + ".meta.jsonl"
    return path if files.exists(spark, path) else None


def read_with_sidecar(spark: SparkSession, corpus: str, meta: str | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """A corpus, its side file's rows (given or found beside it; None without one), and one row that says how they
    align: ``records, declared, unmatched, sidecar, verdict``. Each record needs the row of its line and the other way
    round; unequal lengths fail, no side file is ``not_run``. Either side may be a folder of part files; its lines are
    counted on from one to the next by name."""
    rows = read_chat_corpus(spark, corpus, across=True)
    path = meta or find_sidecar(spark, corpus)
    size = rows.agg(F.count("*").alias("records"))
    if path is None:
        return rows, None, size.select("records", F.lit(0).cast("long").alias("declared"), F.lit(0).cast("long").alias("unmatched"), F.lit(None).cast("string").alias("sidecar"), F.lit("not_run").alias("verdict"))
    side = read_meta(spark, path, across=True)
    both = rows.select("line", F.lit(1).alias("_c")).join(side.select("line", F.lit(1).alias("_m")), "line", "full_outer")
    of = both.agg(F.count("_c").alias("records"), F.count("_m").alias("declared"), F.count_if(F.col("_c").isNull() | F.col("_m").isNull()).alias("unmatched"))
    verdict = F.when((F.col("records") == 0) | (F.col("declared") == 0), "suspect").when((F.col("unmatched") > 0) | (F.col("records") != F.col("declared")), "fail").otherwise("pass")
    return rows, side, of.select("records", "declared", "unmatched", F.lit(path).alias("sidecar"), verdict.alias("verdict"))


POOL_ROW = "struct<row_id:string,id:string,night:string,class:string,account_id:string>"


def normalize_pool(docs: DataFrame, column: str = "doc") -> DataFrame:
    """Pool documents of either container shape to rows ``pool, id, night, class, account_id``; a document of neither shape gives none."""
    v = F.try_parse_json(column)
    part = lambda name: F.try_variant_get(v, f"$.{name}", f"array<{POOL_ROW}>")
    empty = F.array().cast(f"array<{POOL_ROW}>")
    rows = F.concat(*[F.coalesce(part(n), empty) for n in ("rows", "action_pool", "no_action_readchain_pool")])
    return docs.select("pool", F.explode(rows).alias("r")).select("pool", F.coalesce("r.row_id", "r.id").alias("id"), "r.night", "r.class", "r.account_id")


def population_ids(records: DataFrame, names: tuple[str, ...] = ("item_id", "account_id", "candidate_id", "id")) -> DataFrame:
    """The first present identifier of each record."""
    return records.select(F.coalesce(*[F.col(n).cast("string") for n in names if n in records.columns]).alias("id")).where("id is not null")


def read_population(spark: SparkSession, path: str) -> DataFrame:
    return population_ids(spark.read.option("multiLine", not path.endswith(".jsonl")).json(path))


def recent_days(log: DataFrame, n: int, day: str = "dt") -> DataFrame:
    """Rows of the last ``n`` days that occur. The days are a small aggregate, joined back so that a partition column
    prunes files."""
    days = log.select(day).distinct().orderBy(F.col(day).desc()).limit(n)
    return log.join(F.broadcast(days), day, "left_semi")  # at most n rows


def discover_nights(paths: DataFrame, column: str = "path") -> DataFrame:
    """``YYYY-MM-DD[-variant]`` folders to ``night, variant, mode``; other folders are left out."""
    name = F.element_at(F.split(F.col(column), "/"), -1)
    variant = F.regexp_extract(name, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(-[a-z]+)?$", 1)
    mode: Column = F.lit("shadow-replay")
    for suffix, value in MODES.items():
        mode = F.when(variant == suffix, value).otherwise(mode)
    return paths.where(name.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(-[a-z]+)?$")).select(column, F.left(name, F.lit(10)).cast("date").alias("night"), variant.alias("variant"), mode.alias("mode"))


def _strip_tags(html: Column) -> Column:
    """Tags, comments and declarations as spaces. Only the text up to its last closing bracket is searched, where every
    opening one finds an end, so brackets that are never closed cost nothing."""
    tail = F.substring_index(html, ">", -1)
    head = F.left(html, F.length(html) - F.length(tail))
    return F.concat(F.regexp_replace(head, r"<[^>]*>", " "), tail)


def _without_scripts(html: Column) -> Column:
    """Scripts and styles as spaces. The text is cut at their end tags; in each piece but the last the first opening tag
    begins what goes."""

    def kept(piece: Column) -> Column:
        at = F.regexp_instr(piece, F.lit("(?i)<(?:script|style)"))
        opened = (at > 0) & F.contains(F.substr(piece, at), F.lit(">"))
        return F.when(opened, F.concat(F.left(piece, at - 1), F.lit(" "))).otherwise(F.concat(piece, F.lit("</x>")))

    pieces = F.split(html, "(?i)</(?:script|style)>", -1)
    return F.concat(F.array_join(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), kept), ""), F.element_at(pieces, -1))


def _between(html: Column, opening: str, closing: str) -> Column:
    """What stands between the first opening tag and the next closing one; empty without both."""
    low = F.lower(html)
    at = F.instr(low, opening)
    rest = F.when(at > 0, F.substr(html, at + len(opening))).otherwise("")
    end = F.instr(F.lower(rest), closing)
    return F.when(end > 0, F.left(rest, end - 1)).otherwise("")


def plain_text(html: Column) -> Column:
    """The text of a page or of a piece of it: no scripts, styles and tags, white space squashed."""
    return F.trim(F.regexp_replace(_strip_tags(_without_scripts(html)), r"[ \t\n\r]+", " "))


def scrape_reports(pages: DataFrame, id_col: str = "page_id", column: str = "html") -> DataFrame:
    """Plain text of a report without scripts and styles, white space squashed; its first 64-digit hash; its title. Every step
    takes time in proportion to the page, whatever it holds."""
    plain = plain_text(F.col(column))
    return pages.select(id_col, _between(F.col(column), "<title>", "</title>").alias("title"), F.regexp_extract(plain, r"\b([0-9a-f]{64})\b", 1).alias("hash"), F.length(plain).alias("chars"))


#: Character references that are read as characters.
_REFERENCES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def html_tables(pages: DataFrame, id_col: str = "page_id", column: str = "html") -> DataFrame:
    """Rows of the tables of a page: ``id, table, row, header, cells``, tables and rows from 1. A row is a header if it has any
    ``th``. Cells are plain text with the usual character references read. End tags may be left out; a table inside a
    table ends the outer one there and counts by itself. Pages without tables give none."""
    inside = lambda text, tag: F.slice(F.split(text, f"(?i)<{tag}(?=[\\s/>])[^<>]*+>?", -1), F.lit(2), F.size(F.split(text, f"(?i)<{tag}(?=[\\s/>])[^<>]*+>?", -1)))
    upto = lambda x, tag: F.element_at(F.split(x, f"(?i)</{tag}\\s*+>", 2), 1)

    def cell(x: Column) -> Column:
        text = plain_text(upto(x, "t[dh]"))
        for name, value in _REFERENCES.items():
            text = F.replace(text, F.lit(name), F.lit(value))
        return F.trim(text)

    tables = pages.select(id_col, F.posexplode(F.transform(inside(_without_scripts(F.col(column)), "table"), lambda x: upto(x, "table"))).alias("table", "_t"))
    rows = tables.select(id_col, (F.col("table") + 1).alias("table"), F.posexplode(F.transform(inside(F.col("_t"), "tr"), lambda x: upto(x, "tr"))).alias("row", "_r"))
    return rows.select(id_col, "table", (F.col("row") + 1).alias("row"), F.col("_r").rlike(r"(?i)<th(?=[\s/>])").alias("header"), F.transform(inside(F.col("_r"), "t[dh]"), cell).alias("cells"))


def report_tables(pages: DataFrame, id_col: str = "page_id", column: str = "html") -> DataFrame:
    """Cells of a report's tables by the names of their header row, ``id, table, row, name, value``: the roster has a row for each
    member, a summary without a header row has a name and a value in each row."""
    rows = html_tables(pages, id_col, column)
    seen = Window.partitionBy(id_col, "table").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    headed = rows.withColumn("_h", F.last(F.when(F.col("header") & (F.size("cells") > 1), F.col("cells")), True).over(seen))
    listed = headed.where(F.col("_h").isNotNull() & ~F.col("header")).select(id_col, "table", "row", F.posexplode("cells").alias("_i", "value"), "_h")
    roster = listed.select(id_col, "table", "row", F.coalesce(F.try_element_at("_h", F.col("_i") + 1), F.lit("")).alias("name"), "value")
    summary = headed.where(F.col("_h").isNull() & (F.size("cells") == 2)).select(id_col, "table", "row", F.col("cells")[0].alias("name"), F.col("cells")[1].alias("value"))
    return roster.unionByName(summary)


def read_md_tables(docs: DataFrame, heading: str, id_col: str = "doc", column: str = "text") -> DataFrame:
    """Rows of pipe tables under a heading: ``doc, line, cells`` as a map by lower-cased header. Separators and prose are skipped.
    Of columns with one header the first keeps the name; the others get their number behind a hash sign (``a#3``), and one whose name
    is still taken is left out."""
    lines = docs.select(id_col, F.posexplode(F.split(column, "\n")).alias("line", "s")).withColumn("s", F.trim("s"))
    w = Window.partitionBy(id_col).orderBy("line")
    seen = w.rowsBetween(Window.unboundedPreceding, 0)
    title = F.when(F.col("s").startswith("#"), F.trim(F.regexp_replace("s", "^#+", "")))
    table = F.col("s").startswith("|")
    part = lines.withColumn("h", F.last(title, True).over(seen)).withColumn("first", table & ~F.coalesce(F.lag(table).over(w), F.lit(False)))
    cells = F.transform(F.split(F.regexp_replace("s", r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    keyed = part.withColumn("cells", cells).withColumn("header", F.last(F.when(F.col("first"), F.transform("cells", lambda x: F.lower(x))), True).over(seen))
    rows = keyed.where((F.col("h") == heading) & table & ~F.col("first") & ~F.col("s").rlike(r"^[|: -]+$") & (F.size("cells") == F.size("header")))
    named = F.transform("header", lambda h, i: F.when(F.array_position(F.col("header"), h) == i + 1, h).otherwise(F.concat_ws("#", h, (i + 1).cast("string"))))
    rows = rows.withColumn("header", named)
    free = F.filter(F.arrays_zip("header", "cells"), lambda x, i: F.array_position(F.col("header"), x["header"]) == i + 1)
    return rows.select(id_col, (F.col("line") + 1).alias("line"), F.map_from_entries(F.transform(free, lambda x: F.struct(x["header"], x["cells"]))).alias("cells"))


def parse_lessons(docs: DataFrame, id_col: str = "doc", column: str = "text") -> DataFrame:
    """Numbered items of a document: ``doc, code, body``, items of one number joined by a double bar in order."""
    lines = docs.select(id_col, F.posexplode(F.split(column, "\n")).alias("line", "s"))
    items = lines.where(F.col("s").rlike(r"^[0-9]+[.)] ")).select(id_col, "line", F.regexp_extract("s", r"^([0-9]+)", 1).cast("int").alias("code"), F.regexp_extract("s", r"^[0-9]+[.)] (.*)$", 1).alias("b"))
    of = items.groupBy(id_col, "code").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "b"))), lambda x: x["b"]), " || ").alias("body"))
    return of


def parse_register(docs: DataFrame, heading: str, id_col: str = "doc", column: str = "text", status: str = "status") -> DataFrame:
    """A register of errors in a pipe table: ``doc, code, body, severity``. The code is the leading number of the first cell, rows without
    one are skipped, rows of one code are joined by a double bar in order, and the severity is that of their last status."""
    rows = read_md_tables(docs, heading, id_col, column)
    first = F.map_values("cells")[0]
    cells = rows.select(id_col, "line", F.try_to_number(F.regexp_extract(first, r"^[^0-9]{0,3}([0-9]{1,9})", 1), F.lit("999999999")).cast("int").alias("code"), F.coalesce(F.try_element_at(F.map_values("cells"), F.lit(2)), F.lit("")).alias("b"), F.col("cells")[status].alias("s"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "b"))), lambda x: x["b"]), " || ")
    return cells.where("code is not null").groupBy(id_col, "code").agg(joined.alias("body"), F.max_by("s", "line").alias("s")).select(id_col, "code", "body", T.error_severity(F.coalesce("s", F.lit(""))).alias("severity"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of the transcripts of a folder; a session is a file by its name without the ending."""
    lines = numbered_lines(spark, path)
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.jsonl?$", "")
    return transcript_blocks(lines.select(name.alias("session"), "line", "raw"))


def transcript_blocks(messages: DataFrame, column: str = "raw") -> DataFrame:
    """Transcript lines whose content is a text or a list of blocks, to ``session, line, role, pos, type, text, id,
    name``. The role is that of the message, or the line's own ``type`` in transcripts that put it there."""
    v = F.try_parse_json(column)
    kind = "array<struct<type:string,text:string,id:string,name:string>>"
    one = F.array(F.struct(F.lit("text").alias("type"), F.try_variant_get(v, "$.message.content", "string").alias("text"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("name")))
    blocks = F.coalesce(F.try_variant_get(v, "$.message.content", kind), one)
    role = F.coalesce(F.try_variant_get(v, "$.message.role", "string"), F.try_variant_get(v, "$.type", "string"))
    return messages.select("session", "line", role.alias("role"), F.posexplode(blocks).alias("pos", "b")).select("session", "line", "role", "pos", "b.type", "b.text", "b.id", "b.name")


def loss_curve(rows: DataFrame) -> DataFrame:
    """``run, step, train_loss, eval_loss`` to the points of each run: evaluation loss where a run has any, else training loss."""
    has = F.max(F.col("eval_loss").isNotNull()).over(Window.partitionBy("run"))
    points = rows.withColumn("loss", F.when(has, F.col("eval_loss")).otherwise(F.col("train_loss"))).withColumn("label", F.when(has, "eval").otherwise("train"))
    return points.where("step is not null and loss is not null").select("run", "step", "loss", "label")


#: Names by which training logs call the step and the losses, the first that holds a number counts.
STEP_KEYS = ["step", "global_step", "steps", "epoch"]
EVAL_LOSS_KEYS = ["eval_loss", "eval/loss", "validation_loss", "valid_loss"]
TRAIN_LOSS_KEYS = ["loss", "train_loss", "train/loss", "training_loss"]


def parse_metrics(lines: DataFrame, column: str = "raw") -> DataFrame:
    """``run, raw`` lines of training logs to ``run, step, train_loss, eval_loss, skipped``. A line that is no JSON object or has no
    step is kept without losses and with ``skipped`` true, so that it can be counted; blank lines are dropped."""
    v = F.try_parse_json(column)

    def number(names: list[str]) -> Column:
        def one(name: str) -> Column:
            at = F.try_variant_get(v, f"$['{name}']", "variant")
            return F.when(F.schema_of_variant(at).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"), F.try_variant_get(v, f"$['{name}']", "double"))

        return F.coalesce(*[one(n) for n in names])

    step = F.floor(number(STEP_KEYS))
    losses = [F.when(step.isNotNull(), number(names)).alias(name) for name, names in (("train_loss", TRAIN_LOSS_KEYS), ("eval_loss", EVAL_LOSS_KEYS))]
    rows = lines.where(F.trim(column) != "").select("run", step.alias("step"), *losses)
    return rows.withColumn("skipped", F.col("step").isNull())


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics files of a folder; a run is a file."""
    return parse_metrics(numbered_lines(spark, path).select(F.col("file").alias("run"), "raw"))


def build_org_configs(configs: DataFrame, strict: bool = False) -> DataFrame:
    """``slug, org_id, name`` with a fault for a missing field, a slug or an org that is not unique; names that begin with an
    underscore are skipped. ``strict`` fails at the first fault."""
    n = lambda k: F.count("*").over(Window.partitionBy(k))
    fault = F.when(F.col("org_id").isNull() | F.col("name").isNull(), "missing_field").when(n("slug") > 1, "duplicate_slug").when(n("org_id") > 1, "shared_org")
    out = configs.where(~F.col("slug").startswith("_")).withColumn("fault", fault)
    return out.withColumn("slug", F.when(F.col("fault").isNotNull(), F.raise_error("fault")).otherwise(F.col("slug"))) if strict else out


def build_spec_rows(specs: DataFrame, promoted: list[str]) -> DataFrame:
    """Promoted columns beside the whole record as JSON, and whether all promoted ones are there."""
    whole = F.to_json(F.struct(*[F.col(c) for c in specs.columns]))
    ok = F.lit(True)
    for c in promoted:
        ok = ok & F.col(c).isNotNull()
    return specs.select(*promoted, whole.alias("body"), ok.alias("complete"))


def recent_window(df: DataFrame, ts: str, now: str, days: int, cap: int) -> DataFrame:
    """The newest rows since ``days`` before ``now``, at most ``cap`` (a limit of this operator)."""
    return df.where(F.col(ts) >= F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))).orderBy(F.col(ts).desc(), "event_id").limit(cap)
