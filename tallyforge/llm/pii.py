"""Personal data by candidate gradient boosting; DataFrame functions only.

High-recall generators propose overlapping spans; boosted depth-2 trees score each proposal by its format and context;
a threshold for each kind of generator, calibrated on held-out documents, selects what is redacted. Validated base spans
always stand.

Two sources teach the trees, each with half of the weight whatever the input's size. Proposals of the documents are
positive where a base validator passes, negative where a checksum or a range fails, and unlabelled (left out) otherwise.
Sentences made from a fixed list of phrasings (``synthetic``) carry looser personal data and look-alikes of it, labelled
by construction: obfuscated addresses, national telephone numbers, account codes; dates, order numbers, versions, hex
digits, codes with wrong check digits.

Training reads every proposal: they are counted per distinct feature row, and each round takes one aggregation of
gradients over that small table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import stage
from tallyforge.llm.spans import SPAN, joined, let, matches, named

#: The base kinds in their order.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]
#: Loose generators: obfuscated addresses, digit groups, and codes of letters and digits.
LOOSE = ["email_like", "number_like", "code_like"]
_LOOSE_PATTERNS = [
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+ ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z]{2,12}",
    r"\(?[0-9]++\)?(?:[\x20./-]{1,2}\(?[0-9]++\)?)*+",
    r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Z0-9])",
]
#: Words right before a proposal of each loose kind that speak for it.
_CONTEXT = [
    r"(?i)(?<![a-z])(?:e-?mail|mail|contact|write|reach|address)(?:[\x20-]?(?:me|us|to|at|is|address)){0,2}[^a-z0-9]*$",
    r"(?i)(?<![a-z])(?:phone|telephone|tel|mobile|cell|call|fax|dial|ring)(?:[\x20-]?(?:no|number|is|at|me|us|on)){0,2}[^a-z0-9]*$",
    r"(?i)(?<![a-z])(?:iban|account|konto|bank|pay|transfer)(?:[\x20-]?(?:no|number|is|to|details)){0,2}[^a-z0-9]*$",
]
_STRICT_EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"
_PHONE_SHAPE = r"^(?:1[\x20.-])?\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$|^\(?0[0-9]{1,4}\)?[\x20/-]{1,2}[0-9]{3,8}(?:[\x20-][0-9]{2,5})?$"

#: Features and the number of values of each; their product bounds the table of distinct feature rows.
FEATURES = {"kind": 3, "digits": 9, "groups": 5, "prev": 5, "next": 5, "spread": 3, "size": 5, "context": 2, "check": 3}
ROUNDS, LEARNING_RATE, L2 = 12, 0.6, 0.001
#: Held-out precision that the threshold of each kind must reach.
PRECISION = 0.97
#: Sentences made for training.
SYNTHETIC = 6000


def luhn(hit: Column) -> Column:
    """Whether the digits of ``hit`` pass the Luhn check."""
    digits = F.split(F.reverse(F.regexp_replace(hit, "[^0-9]", "")), "")

    def worth(d: Column, i: Column) -> Column:
        n = F.try_to_number(d, F.lit("9")).cast("int")
        return F.when(i % 2 == 0, n).otherwise(n * 2 - F.when(n > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.filter(digits, lambda d: d != ""), worth), F.lit(0), lambda a, v: a + v) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.length(F.regexp_replace(hit, "[^0-9]", ""))


_IP_OK = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"


def base_spans(text: Column) -> list[Column]:
    """Validated spans of each base kind, in the order of ``BASE``."""
    some = lambda ok, spans: F.when(ok, spans).otherwise(F.array().cast(SPAN))
    digit = text.rlike("[0-9]")
    email = some(text.contains("@"), matches(text, EMAIL))
    ip = F.filter(some(digit, matches(text, IP)), lambda s: s["hit"].rlike(_IP_OK))
    card = F.filter(some(digit, matches(text, CARD)), lambda s: F.when(_digits(s["hit"]).between(16, 19), luhn(s["hit"])).otherwise(False))
    phone = F.filter(some(text.contains("+"), matches(text, PHONE)), lambda s: _digits(s["hit"]).between(8, 15))
    return [email, ip, card, phone]


def iban(hit: Column) -> Column:
    """Whether an account code's check digits are right: its number, first four characters last, is 1 modulo 97."""
    chars = F.split(F.concat(F.substring(hit, 5, 40), F.substring(hit, 1, 4)), "")
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    step = lambda a, c: ((a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97).cast("int")
    return F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0), step) == 1


def _char(c: Column) -> Column:
    return (
        F.when(c.isNull() | (c == ""), 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[A-Za-z]$"), 2).when(c.rlike("^[0-9]$"), 3).otherwise(4)
    )


def _bin(x: Column, edges: list[int]) -> Column:
    out = F.lit(0)
    for i, e in enumerate(edges):
        out = F.when(x >= e, i + 1).otherwise(out)
    return out


def _proposal(kind: int, s: Column) -> Column:
    hit = s["hit"]
    digits = _digits(hit)
    card = F.when(digits.between(13, 19), luhn(hit)).otherwise(False)
    label, check = [
        lambda: (F.when(hit.rlike(_STRICT_EMAIL), 1), F.when(hit.rlike(_STRICT_EMAIL) | hit.rlike(r"[(\[]at[)\]]"), 2).when(~hit.rlike(r" \. ?| ?\. "), 1).otherwise(0)),
        lambda: (
            F.when((F.endswith(s["before"], F.lit("+")) & digits.between(8, 15)) | hit.rlike(_IP_OK) | (card & (digits >= 16)), 1).when((digits >= 16) | hit.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), 0),
            F.when(card | hit.rlike(_IP_OK), 2).when(hit.rlike(_PHONE_SHAPE), 1).otherwise(0),
        ),
        lambda: (F.lit(None), F.when(iban(hit), 2).otherwise(0)),
    ][kind]()
    before = F.regexp_replace(s["before"], r"\+$", "")  # the plus sign is what the validator looks at
    return F.struct(
        s["start"].alias("start"),
        s["end"].alias("end"),
        F.lit(kind).alias("kind"),
        _bin(digits, [1, 7, 8, 11, 13, 16, 17, 20]).alias("digits"),
        F.least(F.size(F.split(hit, "[^A-Za-z0-9]+")) - 1, F.lit(4)).alias("groups"),
        _char(F.right(before, F.lit(1))).alias("prev"),
        _char(F.left(s["after"], F.lit(1))).alias("next"),
        _bin(F.size(F.array_distinct(F.split(F.regexp_replace(hit, "[^0-9]", ""), ""))), [3, 6]).alias("spread"),
        _bin(F.length(hit), [8, 12, 16, 24]).alias("size"),
        F.right(s["before"], F.lit(32)).rlike(_CONTEXT[kind]).cast("int").alias("context"),
        check.alias("check"),
        label.cast("int").alias("y"),
    )


def _proposal_of(kind: int):  # noqa: ANN202
    return lambda s: _proposal(kind, s)


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One narrow pass over the texts: ``doc_id, base, loose`` and the columns to keep; base spans named and proposals with
    features. Numbers of fewer than seven digits are not proposed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def both(t: Column) -> Column:
        base = F.concat(*[named(s, k, i) for i, (k, s) in enumerate(zip(BASE, base_spans(t), strict=True))])
        guard = [t.rlike(r"@|\(at\)|\[at\]"), t.rlike("[0-9]"), t.rlike("[A-Z]{2}[0-9]{2}")]
        empty = F.array().cast(SPAN)
        spans = [F.when(g, matches(t, p)).otherwise(empty) for g, p in zip(guard, _LOOSE_PATTERNS, strict=True)]
        spans[1] = F.filter(spans[1], lambda s: _digits(s["hit"]) >= 7)
        loose = F.concat(*[F.transform(s, _proposal_of(k)) for k, s in enumerate(spans)])
        return F.struct(base.alias("base"), loose.alias("loose"))

    kept = keep or []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *kept, let(text, both).alias("s")).select("doc_id", *kept, "s.base", "s.loose")


#: Phrasings of the synthetic sentences: text before, text after.
_AROUND = [("please call ", " before noon"), ("Tel. ", ""), ("phone: ", ", thanks"), ("fax ", " or post"), ("mail me at ", " today"), ("contact ", "; we reply"), ("write to ", "."), ("IBAN ", " as agreed"), ("pay to ", " now"), ("account ", "."), ("see ", " for more"), ("the number ", " was noted"), ("from ", " on"), ("total ", " units"), ("id=", "&x"), ("", "")]


def synthetic(spark: SparkSession, n: int = SYNTHETIC, seed: int = 9) -> DataFrame:
    """``doc_id, text, truth, size``: sentences around one made item of that many characters, which is personal data (1) or
    looks like it (0)."""
    draw = lambda k, m: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), F.col("id")), F.lit(m))
    digits = lambda k, m: F.lpad(draw(k, 10**m).cast("string"), m, "0")
    words = F.array(*map(F.lit, ["anna", "jon", "lee", "kim", "smith", "garcia", "novak", "weber", "mail", "web", "shop", "acme", "corp", "uni"]))
    word = lambda k: F.element_at(words, (draw(k, 14) + 1).cast("int"))
    tld = F.element_at(F.array(*map(F.lit, ["com", "org", "net", "de", "info"])), (draw(5, 5) + 1).cast("int"))
    card = F.concat(digits(6, 14))
    with_check = F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(card, d.cast("string"))), luhn), 1)
    bank = F.concat(F.upper(F.left(word(7), F.lit(2))), F.upper(F.left(word(8), F.lit(2))), digits(9, 14))
    coded = F.transform(F.sequence(F.lit(2), F.lit(98)), lambda d: F.concat(F.element_at(F.array(*map(F.lit, ["GB", "DE", "FR", "NL"])), (draw(10, 4) + 1).cast("int")), F.lpad(d.cast("string"), 2, "0"), bank))
    upper = lambda k: F.upper(F.hex(draw(k, 1 << 40)))
    cat = F.concat
    lit = F.lit
    items = [
        (1, cat(word(11), lit("."), word(12), lit(" (at) "), word(13), lit("."), tld)),
        (1, cat(word(11), lit("[at]"), word(13), lit("[dot]"), tld)),
        (1, cat(word(11), digits(14, 2), lit(" @ "), word(13), lit("."), tld)),
        (0, cat(word(11), lit(" @ "), word(12), lit(" . "), word(13))),
        (0, cat(lit("2 @ "), word(12), lit(" . "), word(13))),
        (1, cat(lit("("), digits(15, 3), lit(") "), digits(16, 3), lit("-"), digits(17, 4))),
        (1, cat(digits(15, 3), lit("-"), digits(16, 3), lit("-"), digits(17, 4))),
        (1, cat(lit("0"), digits(15, 2), lit(" "), digits(16, 7))),
        (1, cat(lit("0"), digits(15, 3), lit("/"), digits(16, 6))),
        (1, cat(lit("1 ("), digits(15, 3), lit(") "), digits(16, 3), lit("-"), digits(17, 4))),
        (1, with_check),
        (0, cat(lit("20"), digits(18, 2), lit("0"), (draw(19, 9) + 1).cast("string"), lit("1"), digits(20, 1))),
        (0, cat(lit("20"), digits(18, 2), lit("-0"), (draw(19, 9) + 1).cast("string"), lit("-1"), digits(20, 1))),
        (0, digits(21, 7)),
        (0, digits(21, 9)),
        (0, cat(lit("978-"), digits(22, 1), lit("-"), digits(23, 2), lit("-"), digits(24, 6), lit("-"), digits(25, 1))),
        (0, cat(digits(21, 3), lit(" "), digits(22, 3), lit(" "), digits(23, 3))),
        (0, cat(digits(21, 2), lit("."), digits(22, 2), lit("."), digits(23, 5))),
        (0, cat(lit("ae"), digits(21, 8), lit("fc"))),
        (0, cat(lit("x="), digits(21, 12), lit("b"))),
        (0, digits(21, 15)),
        (1, F.element_at(F.filter(coded, iban), 1)),
        (1, F.element_at(F.filter(coded, iban), 1)),
        (0, F.element_at(F.filter(coded, lambda c: ~iban(c)), 1)),
        (0, cat(lit("AB12"), upper(26), lit("CDE"))),
        (0, cat(lit("KX77"), upper(27), upper(28))),
    ]
    # the form is picked first: a row makes its own item and none of the others
    made, form = F.lit(None), draw(1, len(items))
    for i, (y, x) in enumerate(items):
        made = F.when(form == i, F.struct(lit(y).alias("y"), x.alias("item"))).otherwise(made)
    around = F.array(*[F.struct(lit(a).alias("a"), lit(b).alias("b")) for a, b in _AROUND])
    rows = spark.range(n).select("id", made.alias("m"), F.element_at(around, (draw(2, len(_AROUND)) + 1).cast("int")).alias("w"))
    return rows.select(F.col("id").alias("doc_id"), F.concat("w.a", "m.item", "w.b").alias("text"), F.col("m.y").alias("truth"), F.length("m.item").alias("size"))


@dataclass
class Trees:
    """Depth-2 trees: (feature, value, (left split, right split), four leaf weights); a row goes left at value or below.
    ``thresholds`` holds the least score that is chosen, by kind."""

    bias: float = 0.0
    trees: list[tuple] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=lambda: [1.1] * len(LOOSE))

    def raw(self, row: Column | None = None) -> Column:
        get = (lambda f: row[f]) if row is not None else F.col
        out = F.lit(self.bias)
        for root, low, high, w in self.trees:
            left = F.when(get(low[0]) <= low[1], w[0]).otherwise(w[1])
            right = F.when(get(high[0]) <= high[1], w[2]).otherwise(w[3])
            out = out + F.when(get(root[0]) <= root[1], left).otherwise(right)
        return out

    def score(self, row: Column | None = None) -> Column:
        return F.round(1 / (1 + F.exp(-self.raw(row))), 3)

    def chosen(self, row: Column) -> Column:
        return self.score(row) >= F.element_at(F.array(*map(F.lit, self.thresholds)), row["kind"] + 1)


def _best(cells: dict[tuple[str, int], tuple[float, float]]) -> tuple[tuple[str, int], float, float, float]:
    """The split with the largest gain, both sides' weights, and the gain."""
    best = (("kind", FEATURES["kind"]), 0.0, 0.0, -math.inf)
    for name, n in FEATURES.items():
        values = [cells.get((name, v), (0.0, 0.0)) for v in range(n)]
        g_all, h_all = sum(c[0] for c in values), sum(c[1] for c in values)
        g = h = 0.0
        for v in range(n):
            g, h = g + values[v][0], h + values[v][1]
            got = g * g / (h + L2) + (g_all - g) ** 2 / (h_all - h + L2)
            if got > best[3] + 1e-12:
                best = ((name, v), -LEARNING_RATE * g / (h + L2), -LEARNING_RATE * (g_all - g) / (h_all - h + L2), got)
    return best


def _tree(joint: dict[tuple[str, int, str, int], tuple[float, float]]) -> tuple:
    """The best root with the best split below each side, from gradient sums of all pairs of feature values."""

    def side(name: str, low: int, high: int) -> dict[tuple[str, int], tuple[float, float]]:
        out: dict[tuple[str, int], tuple[float, float]] = {}
        for (f, v, g, w), (x, h) in joint.items():
            if f == name and low <= v <= high:
                a = out.get((g, w), (0.0, 0.0))
                out[g, w] = (a[0] + x, a[1] + h)
        return out

    best, top = None, -math.inf
    for name, n in FEATURES.items():
        for v in range(n - 1):
            left, right = _best(side(name, 0, v)), _best(side(name, v + 1, n))
            gain = sum(x[3] for x in (left, right) if x[3] > -math.inf)
            if gain > top + 1e-12:
                top = gain
                best = ((name, v), left[0], right[0], (left[1], left[2], right[1], right[2]))
    return best


def fit(loose: DataFrame, rounds: int = ROUNDS) -> Trees:
    """Boost on labelled proposals (columns of ``FEATURES``, ``y``, ``fold`` and ``made``, whether synthetic; fold 0 calibrates,
    the rest trains). Both origins weigh the same, and positives as much as negatives within each. Without positives
    and negatives the thresholds stay above every score."""
    names = list(FEATURES)
    table = stage(loose.where("y is not null").groupBy(*names, "y", "made", (F.col("fold") == 0).alias("held")).agg(F.count("*").alias("n")), "features")
    groups = table.groupBy("y", "made", "held").agg(F.sum("n").alias("total"))  # at most eight rows
    weighed = stage(table.join(F.broadcast(groups), ["y", "made", "held"]).withColumn("n", F.col("n") / F.col("total")), "features")
    model = Trees()
    train = weighed.where("not held").coalesce(1)  # bounded by the feature values; no shuffle in each round
    total = train.agg(F.sum("n"), F.sum(F.col("n") * F.col("y"))).first()
    if not total[0] or not total[1] or total[0] == total[1]:
        return model
    model.bias = math.log(total[1] / (total[0] - total[1]))
    # each pair of features once; the sums are the same the other way round
    pair = lambda f, g: F.struct(F.lit(f).alias("f"), F.col(f).alias("v"), F.lit(g).alias("bf"), F.col(g).alias("bv"))
    pairs = F.explode(F.array(*[pair(f, g) for i, f in enumerate(names) for g in names[i:]]))
    for _ in range(rounds):
        p = 1 / (1 + F.exp(-model.raw()))
        rows = train.select((F.col("n") * (p - F.col("y"))).alias("g"), (F.col("n") * p * (1 - p)).alias("h"), *names)
        sums = rows.select("g", "h", pairs.alias("a")).groupBy("a.f", "a.v", "a.bf", "a.bv").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        joint: dict[tuple[str, int, str, int], tuple[float, float]] = {}
        for r in sums.collect():  # at most the square of the features' values
            joint[r.f, r.v, r.bf, r.bv] = joint[r.bf, r.bv, r.f, r.v] = (r.g, r.h)
        model.trees.append(_tree(joint))
    held = weighed.where("held").groupBy("kind", model.score().alias("s")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y")).collect()  # at most 1001 scores of each kind
    for kind in range(len(LOOSE)):
        n = y = 0.0
        for r in sorted((r for r in held if r.kind == kind), key=lambda r: -r.s):
            n, y = n + r.n, y + r.y
            if y >= PRECISION * n and r.s >= 0.5:
                model.thresholds[kind] = r.s
    return model


def train(held: DataFrame) -> Trees:
    """The model for staged proposals of all documents (``fold, loose``) and the synthetic sentences."""
    spark = held.sparkSession
    made = stage(synthetic(spark), "synthetic")
    made = proposals(made, keep=["truth", "size"]).select(F.pmod(F.xxhash64("doc_id"), F.lit(5)).alias("fold"), "truth", "size", F.explode("loose").alias("p"))
    whole = 5 * (F.col("p.end") - F.col("p.start")) >= 4 * F.col("size")  # a proposal of a part of the item is none of personal data
    made = made.select("fold", *[f"p.{f}" for f in FEATURES], F.when(whole, F.col("truth")).otherwise(0).alias("y"), F.lit(True).alias("made"))
    real = held.select("fold", F.explode("loose").alias("p")).select("fold", *[f"p.{f}" for f in FEATURES], "p.y", F.lit(False).alias("made"))
    return fit(real.unionByName(made))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, found``, an array of ``start, rank, end, kind`` sorted by start, then rank. All
    validated base spans, and the proposals that reach their kind's threshold and touch no base span.

    Null texts count as empty; empty texts have no spans; a null id is searched like others; repeated rows repeat
    their results; other columns are ignored; an empty table gives none.
    """
    held = stage(proposals(docs, id_col, text_col).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(5))), "proposals")
    model = train(held)
    base = F.col("base")

    def chosen(p: Column) -> Column:
        return model.chosen(p) & ~F.exists(base, lambda b: (b["start"] < p["end"]) & (p["start"] < b["end"]))

    more = F.transform(
        F.filter("loose", chosen),
        lambda p: F.struct(p["start"].alias("start"), (p["kind"] + len(BASE)).alias("rank"), p["end"].alias("end"), F.element_at(F.array(*map(F.lit, LOOSE)), p["kind"] + 1).alias("kind")),
    )
    return held.select("doc_id", F.array_sort(F.concat(base, more)).alias("found"))


def _of_rank(rank: int) -> Column:
    return F.filter("found", lambda s: s["rank"] == rank)


def digest(found: DataFrame) -> DataFrame:
    """Counts and the hash of the base spans by kind, then start; all spans by start."""
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    by_kind = F.concat(*[_of_rank(i) for i in range(len(BASE))])
    every = F.concat(*[_of_rank(i) for i in range(len(BASE) + len(LOOSE))])
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(by_kind), 256).alias("base_sha256"), joined(every).alias("spans"))
