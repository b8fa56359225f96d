"""Quality rules: robust multivariate outliers per language and source.

Each text becomes a vector of transformed statistics.  For each language and
source, the minimum-covariance-determinant estimate of centre and spread comes
from concentration steps over all rows: distances under the last estimate, the
half of the rows that lies nearest, their moments, a new estimate.  A group takes
steps until the determinant of its spread stops falling.  A step is one
aggregation: rows are summed by group and distance class, so a group of any size
reaches one task as at most ``CLASSES`` rows.  Statistics are whole numbers
(thousandths), so sums do not depend on their order and reruns agree.

The spread of the inner half is scaled to that of normal rows, whose squared
distances are chi-square with as many degrees of freedom as there are statistics.
A text beyond the ``LEVEL`` quantile of that distribution is an outlier.

A group with fewer than ``LEAST_ROWS`` rows uses the estimate of its language,
and a language with fewer that of all rows; where even those are fewer, the
method rejects nothing.

Defined results: a null or empty text has counts 0, fails the base rule and
takes no part in estimates; null languages and sources form groups of their own;
repeated rows count and are judged one by one; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldmill.llm.statistics import with_counts
from yieldmill.session import materialise

UNIT = 1000  # statistics are counted in thousandths
CLASSES = 640  # classes of the logarithm of a distance
SHARE = 0.5  # of the rows that a concentration step keeps
FALL = 1e-3  # least fall of the logarithm of the determinant that calls for another step
LEVEL = 0.999  # share of normal rows that no cut rejects

# Per statistic the smallest deviation a group is credited with, so that a group
# of near-constant values does not reject ordinary texts.
FLOORS = (0.08, 0.10, 0.12, 0.10, 0.15, 0.15, 0.12)


def statistics() -> list[Column]:
    """Transformed statistics: logarithms of sizes, roots of shares, fitted to be compared linearly."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    root = lambda a, b: F.sqrt(F.col(a) / b)
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        root("n_symbols", words),
        root("n_dup_lines", lines),
        root("n_repeat_words", words),
        root("n_stops", words),
        root("n_upper", words),
        root("n_digits", words),
    ]


P = len(FLOORS)
LEAST_ROWS = 10 * P
NAMES = [f"x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
KEYS = ["level", "_lang", "_source"]


def levels(rows: DataFrame) -> DataFrame:
    """Each row three times: for its language and source, for its language, for all."""
    none = F.lit(None).cast("string")
    return rows.withColumn(
        "_at",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("level"), F.col("lang").alias("_lang"), F.col("source").alias("_source")),
                F.struct(F.lit(1).alias("level"), F.col("lang").alias("_lang"), none.alias("_source")),
                F.struct(F.lit(2).alias("level"), none.alias("_lang"), none.alias("_source")),
            )
        ),
    ).select("*", "_at.*").drop("_at", "lang", "source")


def same_group(left: DataFrame, right: DataFrame) -> Column:
    """Null-safe equality of the group columns."""
    test = left["level"] == right["level"]
    return test & left["_lang"].eqNullSafe(right["_lang"]) & left["_source"].eqNullSafe(right["_source"])


def distance() -> Column:
    """Squared Mahalanobis distance of a row from the centre in ``mean`` under ``inverse``."""
    gap = [F.col(name) / F.lit(UNIT) - F.col("mean")[i] for i, name in enumerate(NAMES)]
    total = F.lit(0.0)
    for i in range(P):
        inner = F.lit(0.0)
        for j in range(P):
            inner = inner + F.col("inverse")[i * P + j] * gap[j]
        total = total + gap[i] * inner
    return F.greatest(total, F.lit(0.0))


def distance_class(square: Column) -> Column:
    """Class of a squared distance: steps of about 3 % from 2**-10 to 2**10 and beyond."""
    step = CLASSES / 20
    return F.least(
        F.greatest(F.floor((F.log2(square + F.lit(2.0**-12)) + 10) * step), F.lit(0)),
        F.lit(CLASSES - 1),
    ).cast("int")


GROUP_SCHEMA = (
    "level int, _lang string, _source string, n long, mean array<double>, inverse array<double>, log_det double"
)


def first_estimate(rows: DataFrame) -> DataFrame:
    """Medians and scaled median deviations, from counts of values rounded to hundredths."""
    cell = levels(rows).select(
        *KEYS,
        F.posexplode(F.array(*(F.round(F.col(n) / 10).cast("int") for n in NAMES))).alias("dim", "cell"),
    )
    counts = cell.groupBy(*KEYS, "dim", "cell").count()

    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim = table.column("dim").to_numpy()
        cells, weight = table.column("cell").to_numpy(), table.column("count").to_numpy()
        mean, inverse = np.zeros(P), np.zeros((P, P))
        for i in range(P):
            value, n = cells[dim == i], weight[dim == i]
            mean[i] = weighted_median(value, n) / 100
            away = weighted_median(np.abs(value - mean[i] * 100), n) / 100 * 1.4826
            inverse[i, i] = 1 / max(away, FLOORS[i]) ** 2
        # Not the determinant of an inner half: any step's is lower.
        return group_row(key, int(weight[dim == 0].sum()), mean, inverse, math.inf)

    return counts.groupBy(*KEYS).applyInArrow(fit, GROUP_SCHEMA)


def weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values)
    total = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(total, total[-1] / 2)])


def group_row(
    key: tuple[pa.Scalar, ...], n: int, mean: np.ndarray, inverse: np.ndarray, log_det: float
) -> pa.Table:
    level, lang, source = (part.as_py() for part in key)
    return pa.table(
        {
            "level": pa.array([level], pa.int32()),
            "_lang": pa.array([lang], pa.string()),
            "_source": pa.array([source], pa.string()),
            "n": pa.array([n], pa.int64()),
            "mean": pa.array([mean.tolist()], pa.list_(pa.float64())),
            "inverse": pa.array([inverse.ravel().tolist()], pa.list_(pa.float64())),
            "log_det": pa.array([log_det], pa.float64()),
        }
    )


def chi_square_share(x: float, p: int) -> float:
    """Share of a chi-square distribution below ``x``, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = p / 2, x / 2
    term = total = math.exp(a * math.log(half) - half - math.lgamma(a + 1))
    while term > 1e-17 * total:
        a += 1
        term *= half / a
        total += term
    return total


def chi_square_quantile(share: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, p) < share else (low, middle)
    return high


def truncated_share(share: float) -> float:
    """Variance, per dimension, of normal vectors cut at the distance that holds ``share`` of them."""
    return chi_square_share(chi_square_quantile(share, P), P + 2) / share


CUT = chi_square_quantile(LEVEL, P)  # squared distance from which a text is an outlier


def concentrate(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """One concentration step."""
    apart = levels(rows).alias("r")
    joined = apart.join(groups, same_group(apart, groups)).select(
        *(apart[name] for name in (*KEYS, *NAMES)), distance_class(distance()).alias("class")
    )
    sums = joined.groupBy(*KEYS, "class").agg(
        F.count("*").alias("rows"),
        *(F.sum(n).alias(f"s_{n}") for n in NAMES),
        *(F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"c_{i}_{j}") for i, j in PAIRS),
    )

    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("class").to_numpy())
        column = lambda name: table.column(name).to_numpy()[order].astype(np.float64)
        total = np.cumsum(column("rows"))
        kept = slice(0, int(np.searchsorted(total, SHARE * total[-1])) + 1)
        n = column("rows")[kept].sum()
        mean = np.array([column(f"s_{x}")[kept].sum() for x in NAMES]) / n
        spread = np.zeros((P, P))
        for i, j in PAIRS:
            spread[i, j] = spread[j, i] = column(f"c_{i}_{j}")[kept].sum() / n - mean[i] * mean[j]
        spread /= UNIT**2
        # The kept rows are the inner ones; widen by their cut-off as for normal data.
        spread *= 1 / truncated_share(SHARE)
        # Bring each deviation up to its floor without changing the correlations' sign.
        spread += np.diag(np.maximum(np.array(FLOORS) ** 2 - np.diag(spread), 0) + 1e-6)
        log_det = float(np.linalg.slogdet(spread)[1])
        return group_row(key, int(total[-1]), mean / UNIT, np.linalg.inv(spread), log_det)

    return sums.groupBy(*KEYS).applyInArrow(fit, GROUP_SCHEMA)


def settle(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Concentration steps until no group's determinant falls any more.

    A group whose determinant stays keeps its best estimate and takes no further
    step.  The floors bound determinants from below and a step that counts lowers
    one by ``FALL``, so the steps end.
    """
    current = materialise(groups.withColumn("falls", F.lit(True)), "quality-groups")
    while not current.where("falls").isEmpty():
        old = current.where("falls").alias("o")
        new = materialise(concentrate(rows, current.where("falls")), "quality-steps").alias("n")
        lower = F.col("n.log_det") < F.col("o.log_det")
        moved = old.join(new, same_group(old, new)).select(
            *(old[c] for c in (*KEYS, "n")),
            *(F.when(lower, new[c]).otherwise(old[c]).alias(c) for c in ("mean", "inverse", "log_det")),
            (F.col("n.log_det") < F.col("o.log_det") - FALL).alias("falls"),
        )
        current = materialise(current.where("NOT falls").unionByName(moved), "quality-groups")
    return current


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Per document: counts, ``base_failed``, squared robust ``distance`` and ``kept``."""
    named = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("_body"),
        F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"),
    )
    counted = with_counts(named, ["doc_id", "lang", "source"], "_body")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = materialise(
        counted.select(
            "doc_id",
            "lang",
            "source",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            *(F.round(x * UNIT).cast("long").alias(n) for x, n in zip(statistics(), NAMES)),
        ),
        "quality-stats",
    )
    sound = stats.where("NOT base_failed")
    groups = settle(sound, first_estimate(sound))
    # Three rows per group, never more: one estimate each for the three levels.
    usable = groups.where(F.col("n") >= LEAST_ROWS)
    pick = lambda level, prefix: usable.where(F.col("level") == level).select(
        *(F.col(c).alias(f"{prefix}{c}") for c in ("_lang", "_source", "mean", "inverse"))
    )
    own, wide, whole = pick(0, "o"), pick(1, "w"), pick(2, "a")
    out = (
        stats.join(
            own,
            stats["lang"].eqNullSafe(own["o_lang"]) & stats["source"].eqNullSafe(own["o_source"]),
            "left",
        )
        .join(wide, stats["lang"].eqNullSafe(wide["w_lang"]), "left")
        .join(F.broadcast(whole), F.lit(True), "left")  # one row at most
        .withColumn("mean", F.coalesce("omean", "wmean", "amean"))
        .withColumn("inverse", F.coalesce("oinverse", "winverse", "ainverse"))
    )
    square = F.when(~F.col("base_failed") & F.col("mean").isNotNull(), distance())
    return out.select(
        F.col("doc_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        square.alias("distance"),
        (~F.col("base_failed") & (F.coalesce(square, F.lit(0.0)) <= CUT)).alias("kept"),
    )
