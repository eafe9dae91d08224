"""Scalar functions on text, numbers and records, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a complete answer may end on.
TERMINAL_CHARS = ".!?\"'`)]}:;$*_%…»。？！"
#: Words of negation, function words, and openers of yes-no questions.
NEGATIONS = ["no", "not", "never", "none", "nothing", "without", "zero", "cannot", "nor", "neither", "nobody", "nowhere"]
FUNCTION_WORDS = [
    "a", "an", "the", "is", "are", "was", "were", "be", "been", "am", "do", "does", "did", "has", "have", "had", "can", "could",
    "will", "would", "should", "shall", "i", "we", "you", "they", "it", "me", "my", "our", "us", "their", "them", "its", "of", "on",
    "in", "at", "to", "for", "from", "with", "by", "as", "that", "this", "these", "those", "there", "here", "and", "or", "so", "any",
    "anything", "anyone", "please", "just", "right", "now", "s",
]
YES_NO_OPENERS = ["do", "does", "did", "is", "are", "was", "were", "has", "have", "had", "can", "could", "will", "would", "should", "am", "any", "anything", "anyone", "shall", "must"]
#: Shapes of structured personal data, in the order they are replaced.
PII_SHAPES = [
    ("[redacted-email]", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("[redacted-ssn]", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("[redacted-phone]", r"(?:\+?1[-. \t\n]?)?\(?[0-9]{3}\)?[-. \t\n]?[0-9]{3}[-. \t\n]?[0-9]{4}\b"),
]
#: Shapes of credentials, then assignments whose value is masked.
SECRET_SHAPES = [
    r"sk-[A-Za-z0-9_-]{16,}",
    r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{20,}",
    r"AKIA[0-9A-Z]{16}",
    r"xox[baprs]-[A-Za-z0-9-]{10,}",
    r"crsr_[A-Za-z0-9_-]{16,}",
    r"fw_[A-Za-z0-9]{16,}",
    r"eyJ[A-Za-z0-9_-]{15,}\.[A-Za-z0-9_-]{15,}\.[A-Za-z0-9_-]{5,}",
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----",
]
SECRET_ASSIGNMENT = (
    r"(?i)\b(password|passwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|auth(?:orization)?)\b"
    r"([ \t\n]*[=:][ \t\n]*|[ \t\n]+Bearer[ \t\n]+)(['\"]?)([^ \t\n'\"]{8,})"
)
#: Answers that affirm, phrases that decline, answers that deny.
AFFIRM = r"^(yes|yep|yeah|correct|that'?s right|indeed|confirmed)\b"
DECLINE = (
    r"i +(can'?t|cannot|do +not|don'?t) +(see|find|confirm|have|know|tell|verify)|(isn'?t|is +not) +(something +)?i +can +see|not +(visible|something +i +can +see)"
    r"|not +in +(the +)?(data|record|records|snapshot|log|logs)|my +view +(stops|ends|doesn'?t)|(the +)?snapshot +(ends|stops|doesn'?t)"
    r"|no +(data|visibility|record|records|information) +(on|for|about)|outside +(what|the) +|all +i +can +see|that'?s +not +something +i +can"
)
DENY = r"^(no|nope|not quite|that'?s not right|incorrect|none)\b"
MARK = "[REDACTED]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Lower-case tokens of letters, digits and apostrophes."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9']+"), F.lit(0))


def significant_numbers(text: Column) -> Column:
    """Distinct sorted numbers with three or more integer digits or a decimal part; thousands commas are dropped first."""
    flat = F.regexp_replace(text, r"(?<=[0-9]),(?=[0-9]{3}(?:$|[^0-9A-Za-z_]))", "")
    found = F.regexp_extract_all(flat, F.lit(r"[0-9]+(?:\.[0-9]+)?"), F.lit(0))
    return F.array_sort(F.array_distinct(F.filter(found, lambda n: n.contains(".") | (F.length(n) >= 3))))


def occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def truncation_signal(text: Column) -> Column:
    """The first sign that a text was cut off (names are fixed values), or null."""
    sign = lambda whole: (
        F.when(whole == "", "empty")
        .when(occurrences(whole, "```") % 2 == 1, "unclosed_code_fence")
        .when(occurrences(whole, "**") % 2 == 1, "unbalanced_bold_emphasis")
        .when(~F.lit(TERMINAL_CHARS).contains(F.right(whole, F.lit(1))), "no_terminal_punctuation")
    )
    return let(F.rtrim(F.regexp_replace(text, r"[ \t\n\r]+$", "")), sign)


def squash(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\x0B\f]+", " "))


def prompt_fingerprint(text: Column) -> Column:
    return F.sha2(F.lower(squash(text)), 256)


def norm_surface(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[ \t\n\r\x0B\f]+", ""))


def fp16(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def opening(text: Column, n: int = 6) -> Column:
    """The first ``n`` word tokens, or null without any."""
    return F.nullif(F.array_join(F.slice(words(text), 1, n), " "), F.lit(""))


def _bare(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, "'+$", ""), "'s$", "")


def _cut(bare: Column) -> Column:
    n = F.length(bare)
    return (
        F.when((n > 5) & bare.endswith("ing"), F.substring(bare, F.lit(1), n - 3))
        .when((n > 4) & bare.endswith("ed"), F.substring(bare, F.lit(1), n - 2))
        .when((n > 3) & bare.endswith("s") & ~bare.endswith("ss"), F.substring(bare, F.lit(1), n - 1))
        .otherwise(bare)
    )


def stem(token: Column) -> Column:
    """A crude suffix strip, the same on both sides of every comparison."""
    return let(_bare(token), _cut)


def stems(text: Column) -> Column:
    return F.transform(F.transform(words(text), _bare), _cut)


def _stem_of(word: str) -> str:
    """``stem`` of a constant."""
    for tail, least in (("ing", 6), ("ed", 5), ("s", 4)):
        if word.endswith(tail) and len(word) >= least and not word.endswith("ss"):
            return word[: -len(tail)]
    return word


FUNCTION_STEMS = sorted({*FUNCTION_WORDS, *map(_stem_of, FUNCTION_WORDS)})


def name_tokens(text: Column) -> Column:
    """Stems of words written as names: all capitals, or a capital that does not begin a sentence."""
    caps = F.filter(F.regexp_extract_all(text, F.lit(r"[A-Za-z][A-Za-z0-9'&.]*"), F.lit(0)), lambda w: w.rlike(r"[A-Z][^A-Za-z]*[A-Z]") & ~w.rlike("[a-z]"))
    inner = F.regexp_extract_all(text, F.lit(r"(?=[A-Z])(?<=[^.!?:;|(\s]\s{0,64})(?<![A-Za-z][A-Za-z0-9'&.]{0,64})([A-Z][A-Za-z0-9'&.]+)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform(F.concat(caps, inner), stems)), lambda t: t != "")))


def question_sentence(text: Column) -> Column:
    """The last sentence with a question mark, else the last sentence."""
    sentences = F.filter(F.split(text, r"(?<=[.!?])[ \t\n]+"), lambda s: F.trim(s) != "")
    last = lambda s: F.coalesce(F.try_element_at(F.filter(s, lambda x: x.contains("?")), F.lit(-1)), F.try_element_at(s, F.lit(-1)), text)
    return F.trim(let(sentences, last))


def ask_tokens(text: Column) -> Column:
    """Content stems of the question; all its stems if none is content."""
    plain = F.array(*map(F.lit, FUNCTION_STEMS))
    some = lambda got: let(F.array_except(got, plain), lambda content: F.when(F.size(content) > 0, content).otherwise(got))
    return F.array_sort(let(F.array_distinct(stems(question_sentence(text))), some))


def is_yes_no(text: Column) -> Column:
    return F.coalesce(F.try_element_at(words(question_sentence(text)), F.lit(1)).isin(YES_NO_OPENERS), F.lit(False))


def grounding_key(text: Column) -> Column:
    """The numbers and the negations a prompt supplies."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"[0-9]++(?:[.,][0-9]++)*+"), F.lit(0)), lambda n: F.replace(n, F.lit(","), F.lit("")))
    negations = F.filter(words(text), lambda w: w.isin(NEGATIONS) | w.endswith("n't"))
    part = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), " ")
    return F.concat(part(numbers), F.lit("|"), part(negations))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def stance(answer: Column) -> Column:
    """AFFIRM, DECLINE, DENY or UNCLEAR by the first sentence; a leading yes outranks a later hedge."""
    first = F.trim(F.lower(F.element_at(F.split(answer, r"(?<=[.!?])[ \t\n]+"), 1)))
    return let(first, lambda s: F.when(s.rlike(AFFIRM), "AFFIRM").when(s.rlike(DECLINE), "DECLINE").when(s.rlike(DENY), "DENY").otherwise("UNCLEAR"))


def sole_date(answer: Column) -> Column:
    dates = F.array_distinct(F.regexp_extract_all(answer, F.lit(r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"), F.lit(0)))
    return F.when(F.size(dates) == 1, F.element_at(dates, 1))


def unit_claims(answer: Column) -> Column:
    """Sorted ``unit=value`` of the units that carry one value only."""
    low = F.lower(answer)
    pattern = F.lit(r"([0-9]++(?:[.,][0-9]++)*+)[ \t\n]+([a-z]{3,})")
    pairs = F.array_distinct(F.transform(F.regexp_extract_all(low, pattern, F.lit(0)), lambda m: F.struct(F.regexp_extract(m, "([a-z]{3,})$", 1).alias("u"), F.replace(F.regexp_extract(m, "^([0-9]++(?:[.,][0-9]++)*+)", 1), F.lit(","), F.lit("")).alias("v"))))
    sole = lambda all_of: F.filter(all_of, lambda p: F.size(F.filter(all_of, lambda q: q["u"] == p["u"])) == 1)
    return F.array_sort(F.transform(let(pairs, sole), lambda p: F.concat(p["u"], F.lit("="), p["v"])))


def conflict_axis(a: Column, b: Column) -> Column:
    """The first axis on which two answers conflict, or null: stance of two yes-no questions, sole date, then the first
    unit by name with different sole values. Both are structs of ``yes_no, stance, date, units``."""
    sa, sb = a["stance"], b["stance"]
    parts = lambda x: F.transform(x["units"], lambda p: F.split(p, "="))
    differ = F.exists(parts(a), lambda u: F.exists(parts(b), lambda v: (u[0] == v[0]) & (u[1] != v[1])))
    stances = a["yes_no"] & b["yes_no"] & (sa != "UNCLEAR") & (sb != "UNCLEAR") & (sa != sb)
    declined = (sa == "DECLINE") | (sb == "DECLINE")
    return F.when(stances, F.when(declined, "stance_vs_decline").otherwise("stance")).when(a["date"] != b["date"], "date_claim").when(differ, "numeric_claim")


def canonical_sha(**fields: Column) -> Column:
    """sha256 of the JSON object of the fields, keys sorted, without spaces, nulls kept."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def evidence_sha12(**fields: Column) -> Column:
    return F.left(canonical_sha(**fields), F.lit(12))


def scrub_pii(text: Column) -> Column:
    for mark, shape in PII_SHAPES:
        text = F.regexp_replace(text, shape, mark)
    return text


def variant_walk(v: Column, depth: int = 12) -> Column:
    """What lies inside a VARIANT: a struct of ``keys``, all names of object fields down to ``depth`` levels, and ``deeper``,
    whether there is more below. Each level's values come from those before as maps and arrays of VARIANT."""
    nothing = F.array().cast("array<variant>")

    def fields(x: Column) -> Column:
        return F.coalesce(F.map_values(F.try_variant_get(x, "$", "map<string,variant>")), nothing)

    def down(s: Column, _: Column) -> Column:
        named = F.transform(s["level"], lambda x: F.coalesce(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")), F.array().cast("array<string>")))
        below = F.transform(s["level"], lambda x: F.concat(fields(x), F.coalesce(F.try_variant_get(x, "$", "array<variant>"), nothing)))
        return F.struct(F.flatten(below).alias("level"), F.array_union(s["keys"], F.flatten(named)).alias("keys"))

    start = F.struct(F.array(v).alias("level"), F.array().cast("array<string>").alias("keys"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, down, lambda s: F.struct(s["keys"].alias("keys"), F.exists(s["level"], lambda x: F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)")).alias("deeper")))
    return F.when(v.isNotNull(), end)


def has_json_key(text: Column, keys: list[str], depth: int = 12) -> Column:
    """Whether a JSON text has a field of one of these names at any depth, names compared as parsed. It fails closed: a text
    nested deeper than ``depth`` counts as having one, and one that is no JSON (or repeats a key in an object) does if it
    holds a quoted name before a colon. A null text has none."""

    def inside(v: Column) -> Column:
        walk = variant_walk(v, depth)
        loose = text.rlike('"(?:' + "|".join(r"\Q" + k.replace(r"\E", r"\E\\E\Q") + r"\E" for k in keys) + r')"[ \t\n\r]*+:') if keys else F.lit(False)
        return F.when(v.isNull(), loose).otherwise(let(walk, lambda w: F.arrays_overlap(w["keys"], F.array(*map(F.lit, keys)).cast("array<string>")) | w["deeper"]))

    return F.coalesce(let(F.try_parse_json(text), inside), F.lit(False))


def scrub_json(text: Column, exempt: list[str] | None = None) -> Column:
    """Structured personal data scrubbed from every text value of a JSON text, at any depth; names of fields, numbers and the
    values of ``exempt`` fields (identifiers) stay as they are, and so does all white space. A text that is no JSON is
    scrubbed as it is.

    Raw control characters can't occur in JSON, so escaped backslashes and quotes are held as such while the text is cut at
    its quotes; each value is unescaped before it is scrubbed, so a shape is found however it is written."""
    held = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    back = lambda t: F.replace(F.replace(t, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    tokens = F.regexp_extract_all(held, F.lit('"[^"]*+"|[^"]++'), F.lit(0))
    names = [f'"{k}"' for k in exempt or []]

    def clean(parts: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            following, before = F.coalesce(F.try_element_at(parts, i + 2), F.lit("")), F.coalesce(F.try_element_at(parts, F.when(i > 0, i)), F.lit(""))
            owner = F.coalesce(F.try_element_at(parts, F.when(i > 1, i - 1)), F.lit(""))
            name = following.rlike("^[ \\t\\n\\r]*+:")
            kept = before.rlike(":[ \\t\\n\\r]*$") & owner.isin(names) if names else F.lit(False)
            value = F.try_variant_get(F.try_parse_json(back(t)), "$", "string")
            new = let(value, lambda x: let(scrub_pii(x), lambda y: F.when(y != x, F.to_json(y.cast("variant"))).otherwise(back(t))))
            return F.when(~t.startswith('"') | name | kept, back(t)).otherwise(F.coalesce(new, back(t)))

        return F.array_join(F.transform(parts, one), "")

    return F.when(F.try_parse_json(text).isNull(), scrub_pii(text)).otherwise(let(tokens, clean))


def _keys_masked(shape: str) -> Callable[[Column], Column]:
    """Key blocks masked in the text up to its last end mark, where every start finds an end."""
    last = shape[shape.index("-----END") :]

    def masked(t: Column) -> Column:
        upto = F.regexp_extract(t, rf"^[\s\S]*{last}", 0)
        return F.when(t.contains("PRIVATE KEY-----"), let(upto, lambda h: F.concat(F.regexp_replace(h, shape, MARK), F.substr(t, F.length(h) + 1)))).otherwise(t)

    return masked


def redact_secrets(text: Column, literals: list[str] | None = None) -> Column:
    """Mask listed literals (longest first), credential shapes, then values of sensitive assignments."""
    for value in sorted(set(literals or []), key=lambda v: (-len(v), v)):
        text = F.replace(text, F.lit(value), F.lit(MARK))
    for shape in SECRET_SHAPES:
        if shape.startswith("eyJ"):
            # from the first start in a run of its characters only: one further in has the same rest behind the run
            run, _, rest = shape[len("eyJ") :].partition("{15,}")
            text = F.regexp_replace(text, rf"(?<!{run})((?:(?!eyJ){run})*+)eyJ{run}{{15,}}+{rest}", "$1" + MARK.replace("[", "\\[").replace("]", "\\]"))
        elif shape.startswith("-----BEGIN"):
            text = let(text, _keys_masked(shape))
        else:
            text = F.regexp_replace(text, shape, MARK)
    return F.regexp_replace(text, SECRET_ASSIGNMENT, "$1$2$3" + MARK.replace("[", "\\[").replace("]", "\\]"))


def uuid5(namespace: str, name: Column) -> Column:
    """Version-5 UUID of a text in a namespace given as hex."""
    return uuid5_in(F.lit(namespace), name)


def uuid5_in(namespace: Column, name: Column) -> Column:
    """The same with a namespace in a column."""
    h = F.sha1(F.concat(F.unhex(F.replace(namespace, F.lit("-"), F.lit(""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 8)), 1, 1)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def pct4(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator != 0, F.bround(numerator / denominator, 4))


def rank_percentile(ordered: Column, fraction: float) -> Column:
    """Nearest rank ``sorted[round_half_even(f * (n - 1))]``; null for an empty array."""
    n = F.size(ordered)
    return F.when(n > 0, F.element_at(ordered, F.bround((n - 1) * F.lit(fraction), 0).cast("int") + 1))


def upper_median(ordered: Column) -> Column:
    n = F.size(ordered)
    return F.when(n > 0, F.element_at(ordered, F.floor(n / 2).cast("int") + 1))


def est_tokens_floor(chars: Column) -> Column:
    return F.floor(chars / 4)


def est_tokens_ceil(chars: Column) -> Column:
    return F.greatest(F.ceil(chars / 4), F.lit(1))


def parse_ts_any(text: Column) -> Column:
    """A timestamp from ISO text (``T`` or space, ``Z``, offset or none for UTC) or epoch seconds or milliseconds, else null."""
    number = F.when(text.rlike(r"^[0-9]{9,13}(\.[0-9]+)?$"), text.try_cast("double"))
    seconds = F.when(number > 1e11, number / 1000).otherwise(number)
    return F.coalesce(F.timestamp_seconds(seconds), text.try_cast("timestamp"))


def parse_progress(text: Column) -> Column:
    """A share between 0 and 1 from ``a/b``, ``n%`` or a plain fraction, else null."""
    a, b = (F.regexp_extract(text, r"^\s*([0-9]+)\s*/\s*([0-9]+)\s*$", i).try_cast("double") for i in (1, 2))
    percent = F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*%\s*$", 1).try_cast("double")
    plain = F.regexp_extract(text, r"^\s*([0-9]+(?:\.[0-9]+)?)\s*$", 1).try_cast("double")
    return F.coalesce(F.when(b > 0, F.least(a / b, F.lit(1.0))), percent / 100, F.when(plain <= 1, plain))


def progress_of_pair(done: Column, total: Column) -> Column:
    """A share from two fields; missing or zero totals are unknown, not 0."""
    return F.when((total > 0) & (done >= 0), F.least(done / total, F.lit(1.0)))


def pick_path(record: Column, paths: list[str], kind: str = "string") -> Column:
    """The first of several paths of a VARIANT that holds a value of this kind, neither null nor an empty text."""
    found = [F.try_variant_get(record, p, kind) for p in paths]
    return F.coalesce(*[F.nullif(x, F.lit("")) if kind == "string" else x for x in found])


def pick_alias(*columns: Column) -> Column:
    """The first alias that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def status_bucket(status: Column) -> Column:
    low = F.lower(status)
    return (
        F.when(low.isin("blocked", "waiting", "stuck"), "blocked")
        .when(low.isin("failed", "error", "crashed"), "failed")
        .when(low.isin("done", "complete", "completed", "finished"), "done")
        .otherwise("live")
    )


def age_words(minutes: Column) -> Column:
    return (
        F.when(minutes.isNull(), "unknown")
        .when(minutes < 0, "in the future")
        .when(minutes < 1, "just now")
        .when(minutes < 60, F.concat(F.floor(minutes).cast("string"), F.lit("m ago")))
        .when(minutes < 1440, F.concat(F.floor(minutes / 60).cast("string"), F.lit("h ago")))
        .otherwise(F.concat(F.floor(minutes / 1440).cast("string"), F.lit("d ago")))
    )


def parse_verdict(text: Column) -> Column:
    """The last ``VERDICT: x`` line, in lower case, or null."""
    return F.lower(F.try_element_at(F.regexp_extract_all(text, F.lit(r"(?im)^[ \t*#>]*verdict[ \t]*:[ \t*]*([A-Za-z_]+)"), F.lit(1)), F.lit(-1)))


def last_json_number(text: Column, key: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(rf'"{key}"[ \t]*:[ \t]*(-?[0-9]+)'), F.lit(1)), F.lit(-1)).try_cast("long")


def money_to_usd(units: Column, nanos: Column) -> Column:
    return F.bround(F.coalesce(units, F.lit(0)) + F.coalesce(nanos, F.lit(0)) / 1e9, 4)


def strip_format_chars(text: Column) -> Column:
    return F.regexp_replace(text, "[​-‏‪-‮⁠-⁤﻿]", "")


def capsule_ok(text: Column) -> Column:
    return (F.size(F.split(text, "\n", -1)) <= 150) & (est_tokens_ceil(F.length(text)) <= 4000)


def all_clear(*flags: Column) -> Column:
    out = F.lit(True)
    for f in flags:
        out = out & F.coalesce(f, F.lit(False))
    return out


def clean_text(text: Column, limit: int) -> Column:
    """Terminal escapes and control characters dropped, white space squashed, cut with an ellipsis."""
    bare = squash(F.regexp_replace(F.regexp_replace(text, r"\x1B\[[0-9;?]*[A-Za-z]", ""), r"[\x00-\x08\x0E-\x1F\x7F]", ""))
    return F.when(F.length(bare) > limit, F.concat(F.substring(bare, 1, limit - 1), F.lit("…"))).otherwise(bare)


def cap_bytes(text: Column, cap: int = 512 << 10, head: int = 384 << 10, tail: int = 96 << 10) -> Column:
    """Head and tail with a marker when the UTF-8 form is larger than ``cap``; cut characters are dropped."""
    raw = F.encode(text, "UTF-8")
    n = F.octet_length(text)
    part = lambda start, size: F.regexp_replace(F.make_valid_utf8(F.decode(F.substring(raw, start, size), "UTF-8")), "�", "")
    cut = F.concat(part(F.lit(1), F.lit(head)), F.lit("\n[... "), (n - head - tail).cast("string"), F.lit(" bytes left out ...]\n"), part(n - tail + 1, F.lit(tail)))
    return F.when(n > cap, cut).otherwise(text)


def redact_path(path: Column, prefixes: list[str], placeholder: str = "[path]") -> Column:
    """``..`` resolved; paths under a safe prefix pass, all others become the placeholder."""
    norm = F.aggregate(
        F.filter(F.split(path, "/"), lambda p: ~p.isin("", ".")),
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p != "..", F.concat(acc, F.array(p))).when(F.size(acc) > 0, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(F.array(F.lit("..")).cast("array<string>")),
    )
    clean = F.array_join(norm, "/")
    safe = F.lit(False)
    for p in prefixes:
        safe = safe | (clean == p.rstrip("/")) | clean.startswith(p.rstrip("/") + "/")
    return F.when(path.isNull(), F.lit(None)).when(safe, clean).otherwise(placeholder)


def valid_pointer(ref: Column, limit: int = 200) -> Column:
    return F.coalesce(ref.rlike(rf"^[A-Za-z0-9(][A-Za-z0-9._/§#:@=,()+-]{{0,{limit - 1}}}$"), F.lit(False))


def valid_pointers(refs: Column, limit: int = 200, most: int = 8) -> Column:
    """A list of at most ``most`` references, each one valid; a null list is not."""
    return F.coalesce((F.size(refs) <= most) & F.forall(refs, lambda r: valid_pointer(r, limit)), F.lit(False))


VERDICT_RANK = {"pass": 0, "info": 0, "suspect": 1, "fail": 2}


def worst_verdict(verdict: Column) -> Column:
    """Aggregate: any fail wins, then anything unknown, null or suspect, else pass; no rows at all are suspect."""
    rank = F.when(verdict == "fail", 2).when(verdict.isin("pass", "info"), 0).otherwise(1)
    worst = F.max(rank)
    return F.when(worst == 2, "fail").when(worst == 0, "pass").otherwise("suspect")


#: Marks that make a lesson critical.
CRITICAL_MARKS = ["[CORRECTED", "[FALSIFIED", "[MANDATORY", "NO-GO", "regressed"]


def lesson_severity(text: Column, marks: list[str] | None = None) -> Column:
    """critical if a lesson carries one of the marks (as written; a program may have more of its own), else minor."""
    found = F.lit(False)
    for mark in CRITICAL_MARKS if marks is None else marks:
        found = found | text.contains(mark)
    return F.when(found, "critical").otherwise("minor")


def error_severity(status: Column) -> Column:
    """minor once an error is fixed or improved, else critical."""
    low = F.lower(F.regexp_replace(F.trim(status), r"^\*+", ""))
    return F.when(low.startswith("fixed") | low.startswith("improved"), "minor").otherwise("critical")


def merge_infra(old: Column, new: Column) -> Column:
    """Map union in which non-empty new values override; empty and null values are skipped."""
    fresh = F.map_filter(new, lambda k, v: v.isNotNull() & (v != ""))
    kept = F.map_filter(old, lambda k, v: v.isNotNull() & (v != "") & ~F.map_contains_key(fresh, k))
    return F.map_concat(kept, fresh)


def map_text(m: Column) -> Column:
    """``key=value`` pairs in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")


#: Tags and the system token by which a record declares itself a deliberate counter-instance.
MARK_TAGS = ["contradiction", "contradiction-ok", "contradiction_ok", "counter-instance", "counter_instance", "counterinstance"]
SYSTEM_MARK = "[CONTRADICTION-OK]"


#: Keys by which a record, or its meta, does so.
MARK_KEYS = ["contradiction_marker", "counter_instance", "counter-instance", "contradiction"]


def is_marked(system: Column, tags: Column, record: Column | None = None) -> Column:
    """A deliberate counter-instance by its system text, its tags, or a true key of ``record`` (JSON text), its ``meta`` or
    its ``metadata``."""
    keyed = F.lit(False)
    if record is not None:
        v = F.try_parse_json(record)
        values = [F.try_variant_get(v, f"$.{at}['{k}']" if at else f"$['{k}']", "string") for at in ("", "meta", "metadata") for k in MARK_KEYS]
        for x in values:
            keyed = keyed | F.coalesce(~x.isin("", "false", "0", "null", "[]", "{}"), F.lit(False))
    tagged = F.exists(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.lower(F.trim(t)).isin(MARK_TAGS))
    return F.coalesce(system.contains(SYSTEM_MARK), F.lit(False)) | tagged | keyed


def run_status(failed: Column, started: Column, finished: Column) -> Column:
    """failed before finished before running before queued; unknown flags count as false."""
    on = lambda f: F.coalesce(f, F.lit(False))
    return F.when(on(failed), "failed").when(on(started) & on(finished), "finished").when(on(started), "running").otherwise("queued")


def stage_status(stage: Column, status: Column, gates: list[str]) -> Column:
    """The status of a stage row from its report: a pending human gate blocks, refusals and rejections fail, a training that
    was only dispatched still runs, all else passed."""
    blocked = (status == "BLOCKED_ON_GATE") | (stage.isin(gates) & (status == "gate_pending"))
    return (
        F.when(blocked, "blocked_on_gate")
        .when(status.isin("REFUSED", "error", "no_go", "empty"), "failed")
        .when((stage == "train") & (status == "dispatched"), "running")
        .otherwise("passed")
    )


def classify_runtime(dispatch_id: Column, stage: Column, run_id: Column) -> Column:
    """Where an agent row came from, by its four writers (fixed values): an id of a dispatch, a stage, no run at all, or a
    run."""
    given = lambda x: F.coalesce(x != "", F.lit(False))
    return F.when(given(dispatch_id), "cursor_sdk_dispatch").when(given(stage), "tier2_dispatch").when(run_id.isNull(), "machine_wide_session").otherwise("interactive_run_session")


def first_match(text: Column, patterns: list[tuple[str, str]], otherwise: str) -> Column:
    """The name of the first pattern that a text holds."""
    out = F.lit(otherwise)
    for name, pattern in reversed(patterns):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out
