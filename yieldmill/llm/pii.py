"""Personal data by boosted candidates, in DataFrame operations only.

Four strict patterns with checks give the base spans; they always stay.  High-
recall generators propose further, overlapping spans: loose addresses, numbers,
dotted numbers, keys.  Boosted trees judge a proposal by its format and by the
text around it.  They learn from evidence in these documents:

* Personal: proposals that cover a base span, and the same spans disguised as people
  write them to escape a pattern (``a (at) b.c``, other separators, no plus sign).
* Secret: keys of letters and digits that an assignment to a token, key or password
  precedes; each is also shown with that context masked, so that format counts.
* Neither: all other proposals.  Some are so for certain, as no kind has their shape
  (words, versions, short numbers).

A bounded sample of both classes, from half of the examples, fits the trees, which
become one SQL expression.  All evidence outside that sample, leaving out proposals
that nothing is known of, calibrates the threshold: the lowest score above even odds
from which ``PRECISION`` of it is personal or secret.  Scores are whole steps of ``1 /
SCORE_STEPS``, so this is one aggregation whose result does not grow with the
documents.  All proposals above the threshold are added, unless a base span overlaps
them; a key that only holds one, such as a run of its digits, is added as well.
Overlapping spans are redacted as one.

All patterns are written so that a search is linear in the text: a run of
characters is entered at its start only and never given back.

Defined results: null and empty texts have no spans; without examples of both
kinds nothing is added; repeated rows and null ids get one result row each; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldmill.llm import boosting
from yieldmill.session import materialise

# The base kinds in their order, and the pattern of each.  A search may start
# inside a run of characters only where the last match ended (\G).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "contact": r"(?:(?<![^\s<>()\[\]@])|\G)[^\s<>()\[\]@]++(?:@|\x20?[(\[]at[)\]]\x20?)[^\s<>()\[\]@]++",
    "number": r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])++",
    "dotted": r"(?:(?<![0-9.])|\G)[0-9]++(?:\.[0-9]++)++",
    "key": r"(?:(?<![A-Za-z0-9_=+/-])|\G)[A-Za-z0-9_=+/-]{12,}+",
}
KINDS = [*BASE, *PROPOSED]
# A text without the first pattern has no match of the second; it costs less to test.
NEEDS = {"email": "@", "phone": "[+]", "contact": r"@|[(\[]at[)\]]"}
BEFORE = 24  # characters before a span that serve as context
FIT_ROWS = 8_192  # bound of the sample that the trees are fitted to
SCORE_STEPS = 1_024  # of one unit of the score
PRECISION = 0.98
ROUNDS, DEPTH = 24, 3

LEAST_DIGITS, MOST_DIGITS = 9, 19  # of a number that may be a phone's or a card's
LEAST_KEY = 20  # characters of a secret

# Words that announce personal data, and those that announce a secret.
CUES = r"(?i)(mail|phone|tel|call|mobil|fax|card|account|address|contact|login|user)\W{0,3}$"
SECRETS = r"(?i)(token|secret|passw(or)?d|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer)[\"']?\s?[=:]?\s?[\"']?$"


def found(text: Column, kind: str) -> Column:
    """Matches of a kind, in order: kind, number, text before since the last match, match, next text."""
    pattern = (BASE | PROPOSED)[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.split(text, pattern, -1)
    both = F.transform(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g"),
                     F.slice(gaps, 2, F.size(matches)).alias("n")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("number"),
            F.length(x["g"]).alias("gap"),
            x["m"].alias("match"),
            F.right(x["g"], F.lit(BEFORE)).alias("before"),
            F.left(x["n"], F.lit(1)).alias("after"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,number:int,gap:int,match:string,before:string,after:string>>")
    able = text.rlike(NEEDS.get(kind, "[0-9]"))
    return F.when(able & (F.size(matches) > 0), both).otherwise(none)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    places = F.transform(F.split(F.reverse(number), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    doubled = F.transform(
        places, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def passes(kind: Column, match: Column) -> Column:
    """The checks of the base kinds; a match that fails is dropped."""
    number = digits(match)
    # Parts of up to 255: leading zeros aside, three digits at most.
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.length(number).between(12, 19) & luhn(number))
        .when(kind == "phone", F.length(number).between(9, 15))
        .otherwise(False)
    )


def count_of(column: str, characters: str) -> Column:
    return F.length(column) - F.length(F.regexp_replace(column, f"[{characters}]", ""))


def features() -> list[Column]:
    """Format of the match and of the text around it, as numbers."""
    size = F.greatest(F.length("match"), F.lit(1))
    flag = lambda test: test.cast("int")
    exprs = [
        F.length("match"),
        count_of("match", "0-9"),
        count_of("match", "0-9") / size,
        count_of("match", "A-Z"),
        count_of("match", "a-z"),
        count_of("match", "."),
        count_of("match", "@"),
        count_of("match", r"\x20"),
        count_of("match", r"\-"),
        count_of("match", "()"),
        count_of("match", "=/+_"),
        flag(F.startswith("match", F.lit("+"))),
        F.length(F.regexp_extract("match", r"^\D*(\d*)", 1)),
        F.length(F.regexp_extract("match", r"(\d*)\D*$", 1)),
        F.size(F.split("match", r"[\x20().-]+")),
        F.size(F.array_distinct(F.split("match", ""))),
        F.regexp_count("match", F.lit("[0-9][A-Za-z]|[A-Za-z][0-9]")),
        count_of("match", "aeiouAEIOU") / size,
        flag(F.col("before").rlike(CUES)),
        flag(F.col("before").rlike(SECRETS)),
        flag(F.col("before").rlike(r"[A-Za-z0-9]$")),
        flag(F.col("before").rlike(r"[=:\"]\s?$")),
        flag(F.col("after").rlike("[A-Za-z0-9]")),
    ]
    return [e.cast("double") for e in exprs]


def trees_as_column(model: boosting.Trees, columns: Sequence[Column]) -> Column:
    """The raw score of the trees as one expression."""

    def branch(tree: int, node: int) -> Column:
        inner = 2**model.depth - 1
        if node >= inner:
            return F.lit(float(model.value[tree, node - inner]))
        threshold = float(model.threshold[tree, node])
        if not np.isfinite(threshold):
            return branch(tree, 2 * node + 1)
        test = columns[int(model.feature[tree, node])] > threshold
        return F.when(test, branch(tree, 2 * node + 2)).otherwise(branch(tree, 2 * node + 1))

    return reduce(lambda a, b: a + b, (branch(t, 0) for t in range(len(model.value))), F.lit(model.start))


def evidence() -> Column:
    """1 for proposals known as personal or secret, 0 for those that cannot be, else null."""
    kind, match, number = F.col("kind"), F.col("match"), F.length(digits(F.col("match")))
    parts = F.size(F.split("match", r"\."))
    dot = match.rlike(r"[A-Za-z0-9]\.[A-Za-z]")
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    possible = (
        F.when(kind == "contact", dot)
        .when(kind == "number", number >= LEAST_DIGITS)
        .when(kind == "dotted", parts == 4)
        .otherwise(match.rlike("[0-9]"))
    )
    personal = F.col("on_base") & possible & ((kind != "number") | (number <= MOST_DIGITS))
    secret = (kind == "key") & mixed & (F.length(match) >= LEAST_KEY) & F.col("before").rlike(SECRETS)
    return F.when(personal | secret, 1).when(~F.col("on_base") & ~possible, 0)


def disguised() -> Column:
    """Ways to write a base span that its pattern does not find."""
    match, kind = F.col("match"), F.col("kind")
    other = lambda pattern, by: F.regexp_replace(match, pattern, by)
    plain = other(r"^\+", "")
    return (
        F.when(kind == "email", F.array(other("@", " (at) "), other("@", "[at]"), other("(@[A-Za-z0-9-]+)", "$1_")))
        .when(
            kind == "phone",
            F.array(
                plain,
                other(r"[\x20()-]+", "."),
                F.regexp_replace(plain, r"[\x20().-]+", " "),
                F.translate(F.regexp_replace(plain, r"\x20?([()])", "$1"), "-", " "),
            ),
        )
        .when(kind == "card", F.array(other(r"([0-9]{4})[\x20-]?(?=[0-9])", "$1."), other(r"([0-9]{4})[\x20-]?(?=[0-9])", "$1  ")))
        .otherwise(F.array().cast("array<string>"))
    )


def examples(some: DataFrame) -> DataFrame:
    """What the trees learn from: key, class ``y``, whether it is ``sure``, features ``x``."""
    key = F.xxhash64("row", "kind", "start")
    label = evidence()
    known = some.where("NOT base").withColumn("sure", label)
    # Proposals that lie on a base span without covering one are neither.
    known = known.where(F.col("sure").isNotNull() | ~F.col("on_base"))
    plain = known.select(key.alias("h"), F.coalesce("sure", F.lit(0)).alias("y"), F.col("sure").isNotNull().alias("sure"), "x")
    masked = known.where((F.col("sure") == 1) & ~F.col("on_base")).withColumn("before", F.lit(""))
    hidden = some.where("base").withColumn("match", F.explode(disguised()))
    more = masked.unionByName(hidden, allowMissingColumns=True)
    shown = more.select(F.xxhash64("row", "kind", "start", "match").alias("h"), F.lit(1).alias("y"), F.lit(True).alias("sure"), F.array(*features()).alias("x"))
    return plain.unionByName(shown)


def fit_sample(cases: DataFrame) -> tuple[list, Column]:
    """Cases to fit the trees to, as many of each class, and the test for those left out.

    Only rows of even hash are taken, so at least about half of each class is left
    to calibrate with.
    """
    taken, inside = [], F.lit(False)
    for y in (1, 0):
        mine = (F.col("y") == y) & (F.col("h") % 2 == 0)
        rows = cases.where(mine).select("h", "x", "y").orderBy("h", "x").limit(FIT_ROWS // 2).collect()
        if rows:
            inside = inside | (mine & (F.col("h") <= F.lit(rows[-1]["h"])))
        taken += rows
    return taken, ~inside


def fit(sample: Sequence, n_features: int) -> boosting.Trees | None:
    """Trees from the sample; none without examples of both kinds."""
    x = np.array([row["x"] for row in sample], np.float64).reshape(len(sample), n_features)
    y = np.array([row["y"] for row in sample], np.float64)
    if not len(y) or y.min() == y.max():
        return None
    return boosting.fit(x, y, rounds=ROUNDS, depth=DEPTH, rate=0.3)


def calibrate(scored: DataFrame) -> float:
    """The lowest score above even odds from which ``PRECISION`` of all rows have class 1."""
    counts = scored.groupBy("score").agg(F.count_if(F.col("y") == 1).alias("right"), F.count("*").alias("rows"))
    table = sorted((row["score"], row["right"], row["rows"]) for row in counts.collect())[::-1]
    # Equal scores stand or fall together.
    raw, right, rows = (np.array(c) for c in zip(*table)) if table else (np.zeros(0),) * 3
    good = np.flatnonzero((np.cumsum(right) >= PRECISION * np.cumsum(rows)) & (np.cumsum(right) > 0) & (raw > 0))
    return float(raw[good[-1]]) if len(good) else float("inf")


def spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None
) -> DataFrame:
    """All proposals and base spans: row, id, kind, start, end, match, base, added.

    ``row`` numbers the documents, or names a column that does; a document without any
    span has one line of nulls.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    read = docs.select(number.alias("row"), F.col(doc_id).alias("doc"), body.alias("body"))
    each = F.concat(*(found(F.col("body"), kind) for kind in KINDS))
    hits = materialise(read.select("row", "doc", F.explode_outer(each).alias("hit")).select("row", "doc", "hit.*"), "pii-hits")
    earlier = Window.partitionBy("row", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    end = F.sum((F.col("gap") + size).cast("long")).over(earlier)
    some = hits.where("kind IS NOT NULL").withColumn("end", end).withColumn("start", F.col("end") - size)
    base = passes(F.col("kind"), F.col("match"))
    some = some.withColumn("base", base).where(F.col("base") | F.col("kind").isin(*PROPOSED))
    # A proposal lies on a base span if one that starts before its end reaches into it,
    # whichever comes first.
    by_start = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max(F.when(F.col("base"), F.col("end")))
    behind = reach.over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    on_base = (F.coalesce(behind, F.lit(-1)) > F.col("start")) | (
        F.coalesce(ahead, F.lit(2**62)) < F.col("end")
    )
    # A key whose digits happen to be a base span reaches beyond it.
    around = (F.col("kind") == "key") & (F.coalesce(behind, F.lit(-1)) < F.col("end"))
    x = features()
    some = some.withColumn("open", ~on_base | around).withColumn("on_base", on_base).withColumn("x", F.when(~F.col("base"), F.array(*x)))
    some = materialise(some.drop("gap", "number"), "pii-spans")

    cases = materialise(examples(some), "pii-cases")
    sample, unseen = fit_sample(cases)
    model = fit(sample, len(x))
    score, threshold = F.lit(None).cast("double"), float("inf")
    if model is not None:
        raw = trees_as_column(model, [F.col("x")[i] for i in range(len(x))])
        score = F.round(raw * SCORE_STEPS) / SCORE_STEPS
        threshold = calibrate(cases.where(unseen & F.col("sure")).select("y", score.alias("score")))
    able = some.withColumn("score", F.when(~F.col("base") & F.col("open"), score))
    able = able.withColumn("added", F.coalesce(F.col("score") >= threshold, F.lit(False)))
    kept = able.select("row", "doc", "kind", "start", "end", "match", "base", "added")
    nothing = hits.where("kind IS NULL OR number = 0").select("row", "doc").distinct()
    none = nothing.select("row", "doc", *(F.lit(None).cast(t).alias(n) for n, t in (
        ("kind", "string"), ("start", "long"), ("end", "long"), ("match", "string"),
        ("base", "boolean"), ("added", "boolean"))))
    return kept.unionByName(none)


def summarise(found_spans: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document row: counts of the base kinds, digest of the base spans, all spans."""
    rank = F.element_at(F.create_map(*(F.lit(v) for i, k in enumerate(KINDS) for v in (k, i))), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "end", F.concat_ws(":", "kind", "start", "end").alias("text"))
    joined = lambda test: F.array_join(
        F.transform(F.sort_array(F.collect_list(F.when(test, entry))), lambda e: e["text"]), ","
    )
    return found_spans.groupBy("row", F.col("doc").alias(doc_id)).agg(
        *(F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("base") | F.col("added")).alias("spans"),
    ).drop("row")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with every selected span replaced by its kind in brackets.

    Rows are told apart by a number of their own, so ids may be null or repeated.
    """
    held = materialise(docs.withColumn("__llm_row", F.monotonically_increasing_id()), "pii-docs")
    chosen = spans(held, doc_id, text, "__llm_row").where("base OR added")
    # Overlapping spans of several kinds become one, named after the first.
    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    chosen = chosen.select("row", "kind", "start", "end").distinct()
    merged = (
        chosen.withColumn("new", (F.coalesce(before, F.lit(-1)) <= F.col("start")).cast("int"))
        .withColumn("group", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", "start").alias("kind"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__llm_cuts"))
        .withColumnRenamed("row", "__llm_row")
    )
    joined = held.join(merged, "__llm_row", "left")
    piece = lambda c, i: F.concat(
        F.substring(
            F.col(text),
            (F.when(i == 0, 0).otherwise(F.col("__llm_cuts")[i - 1]["end"]) + 1).cast("int"),
            (c["start"] - F.when(i == 0, 0).otherwise(F.col("__llm_cuts")[i - 1]["end"])).cast("int"),
        ),
        F.lit("["), c["kind"], F.lit("]"),
    )
    tail = F.substr(F.col(text), (F.element_at("__llm_cuts", -1)["end"] + 1).cast("int"))
    cut = F.concat(F.array_join(F.transform("__llm_cuts", piece), ""), tail)
    return joined.withColumn(text, F.when(F.col("__llm_cuts").isNotNull(), cut).otherwise(F.col(text))).drop("__llm_row", "__llm_cuts")
