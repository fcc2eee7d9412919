"""Quality rules with robust multivariate outliers, in DataFrame operations.

Each text becomes a vector of transformed statistics. Per language and source the minimum covariance
determinant (MCD) estimate is found by concentration steps: centre and covariance of the share of
rows that lies nearest by the last estimate. Rows far off by Mahalanobis distance are rejected.

Null and empty texts have no words and fail the base rule. A null language or source is a group of
its own. Repeated rows are judged alike and all kept or all rejected. Empty tables give empty
results. Other columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# The vector, and the least spread that each coordinate is given.
VECTOR = {
    "log1p(n_words)": 0.5,
    "word_chars / greatest(n_words, 1)": 0.3,
    "log1p(100 * n_symbols / greatest(word_chars, 1))": 0.15,
    "log1p(100 * n_dup_lines / greatest(n_words, 1))": 0.5,
    "n_repeat_words / greatest(n_words, 1)": 0.1,
}
SHARE = 0.75
STEPS = 4
LEAST_ROWS = 200
# A plan node with more groups than this is joined by key instead of broadcast.
BROADCAST_GROUPS = 10_000
BINS_PER_E = 64


def _one(value: Column) -> Column:
    """Explode of one element: keeps the optimizer from copying a costly value into its uses."""
    return F.explode(F.array(value))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``doc_id``, the columns ``keep`` and the five STATISTICS of each whole text.

    Windows of three words are told apart by 64-bit hashes within one text. Everything happens
    inside the row: no shuffle, and a long text costs time in proportion to n log n.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select("*", _one(F.regexp_extract_all("t", F.lit(WORD), F.lit(0))).alias("w"))
    worded = F.expr(r"filter(split(t, '\n', -1), x -> translate(x, ' \t\n\u000B\u000C\r', '') != '')")
    rows = rows.select("doc_id", *keep, "t", _one(F.transform("w", lambda x: F.xxhash64(x))).alias("h"), worded.alias("lines"))
    counted = rows.select(
        "doc_id", *keep, "h",
        F.size("h").cast("long").alias("n_words"),
        F.expr(r"char_length(translate(t, ' \t\n\u000B\u000C\r', ''))").cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
    )
    triples = F.expr("if(size(h) < 3, array(), transform(sequence(1, size(h) - 2), i -> xxhash64(h[i - 1], h[i], h[i + 1])))")
    counted = counted.select("*", _one(triples).alias("g")).drop("h")
    placed = F.expr("if(size(array_distinct(g)) = size(g), array(), sort_array(transform(g, (x, i) -> struct(x, i))))")
    counted = counted.select("*", _one(placed).alias("s")).drop("g")
    twice = "filter(s, (v, i) -> (i > 0 and s[greatest(i - 1, 0)].x = v.x) or (i < size(s) - 1 and s[least(i + 1, size(s) - 1)].x = v.x))"
    covered = f"size(array_distinct(flatten(transform({twice}, v -> array(v.i, v.i + 1, v.i + 2)))))"
    return counted.select("doc_id", *keep, *STATISTICS[:4], F.expr(covered).cast("long").alias("n_repeat_words"))


def chi_square_quantile(p: int, probability: float) -> float:
    """By bisection on the series of the regularized gamma function."""
    low, high = 0.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(p, middle) < probability else (low, middle)
    return high


def _chi_square(p: int, x: float) -> float:
    term = total = 1 / math.gamma(p / 2 + 1)
    for k in range(1, 500):
        term *= x / 2 / (p / 2 + k)
        total += term
    return total * (x / 2) ** (p / 2) * math.exp(-x / 2)


def _with_distance(rows: DataFrame, p: int) -> DataFrame:
    """``rows`` (``x0..``, ``e`` with centre ``m`` and triangle ``l``) with ``d``, the squared distance."""
    for i in range(p):
        inner = "".join(f" - e.l[{i * (i + 1) // 2 + j}] * y{j}" for j in range(i))
        rows = rows.withColumn(f"y{i}", F.expr(f"(x{i} - e.m[{i}]{inner}) / e.l[{i * (i + 1) // 2 + i}]"))
    return rows.withColumn("d", F.expr(" + ".join(f"y{i} * y{i}" for i in range(p)))).drop(*[f"y{i}" for i in range(p)])


def _triangle(moments: DataFrame, floors: list[float], widen: float) -> DataFrame:
    """From ``g, n, m`` and ``c0_0..`` the estimate ``e``: centre and Cholesky factor of the widened
    covariance, to whose diagonal the least spreads are added."""
    p = len(floors)
    for i in range(p):
        for j in range(i + 1):
            spread = f"c{i}_{j} * {widen!r}D" + (f" + {floors[i] ** 2!r}D" if i == j else "")
            inner = "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
            value = f"sqrt(greatest({spread}{inner}, 1e-12D))" if i == j else f"({spread}{inner}) / l{j}_{j}"
            moments = moments.withColumn(f"l{i}_{j}", F.expr(value))
    triangle = F.array(*[F.col(f"l{i}_{j}") for i in range(p) for j in range(i + 1)])
    return moments.select("g", "n", F.struct("m", triangle.alias("l")).alias("e"))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def robust_estimates(rows: DataFrame, floors: list[float], share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """``g, n, e``: the MCD estimate of each group ``g`` of the vectors ``x0..``.

    The start is the median and the quartile distance of each coordinate. Every step reads ``rows``
    twice: the distances, counted by bins, tell how far the nearest ``share`` reaches (up to a
    bin, 1/64 of a natural logarithm wide); the rows within give the next centre and covariance.
    All sums are combined before the shuffle, so a hot group sends one row per task and bin.
    """
    p = len(floors)
    xs = [f"x{i}" for i in range(p)]
    quartiles = rows.groupBy("g").agg(
        F.count("*").alias("n"), *[F.percentile_approx(x, [0.25, 0.5, 0.75], F.lit(2000)).alias(x) for x in xs]
    )
    start = quartiles.select(
        "g", "n", F.array(*[F.col(x)[1] for x in xs]).alias("m"),
        *[
            (F.pow((F.col(xs[i])[2] - F.col(xs[i])[0]) / 1.349, 2) if i == j else F.lit(0.0)).alias(f"c{i}_{j}")
            for i in range(p)
            for j in range(i + 1)
        ],
    )
    estimates = _written(_triangle(start, floors, 1.0), "mcd")
    widen = share / _chi_square(p + 2, chi_square_quantile(p, share))
    for _ in range(steps):
        near = _with_distance(rows.join(_small(estimates), "g"), p).withColumn("bin", F.floor(F.log1p("d") * BINS_PER_E))
        counts = near.groupBy("g", "bin").agg(F.count("*").alias("k"))
        running = counts.selectExpr(
            "g", "bin", "sum(k) over (partition by g order by bin) as upto", "sum(k) over (partition by g) as n"
        )
        reach = running.where(F.col("upto") >= F.ceil(F.col("n") * share)).groupBy("g").agg(F.min("bin").alias("last"))
        within = near.join(_small(_written(reach, "reach")), "g").where("bin <= last")
        sums = within.groupBy("g").agg(
            F.first("n").alias("n"), F.first("e.m").alias("old"), F.count("*").alias("k"),
            *[F.sum(F.expr(f"x{i} - e.m[{i}]")).alias(f"s{i}") for i in range(p)],
            *[F.sum(F.expr(f"(x{i} - e.m[{i}]) * (x{j} - e.m[{j}])")).alias(f"q{i}_{j}") for i in range(p) for j in range(i + 1)],
        )
        moments = sums.select(
            "g", "n", F.array(*[F.expr(f"old[{i}] + s{i} / k") for i in range(p)]).alias("m"),
            *[F.expr(f"q{i}_{j} / k - (s{i} / k) * (s{j} / k)").alias(f"c{i}_{j}") for i in range(p) for j in range(i + 1)],
        )
        estimates = _written(_triangle(moments, floors, widen), "mcd")
    return estimates


def _small(groups: DataFrame) -> DataFrame:
    """Broadcast if a count shows that it is small; ``groups`` lies in a written table."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def reject_outliers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    probability: float = 0.9999, least_rows: int = LEAST_ROWS, share: float = SHARE, steps: int = STEPS,
) -> DataFrame:
    """``doc_id``, STATISTICS, ``base_failed``, ``distance`` (squared), ``kept``; one row per row.

    ``base_failed``: under 50 words, or over half of them in repeated windows. The others are fitted
    per language and source; a pair of fewer than ``least_rows`` of them is judged by its language's
    estimate, such a language by that of all rows. ``kept`` is false beyond the ``probability``
    quantile of the chi-square distribution.
    """
    named = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source")
    )
    failed = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
    stats = _written(statistics(named).withColumn("base_failed", F.expr(failed)), "statistics")
    xs = [F.expr(f"cast({x} as double)").alias(f"x{i}") for i, x in enumerate(VECTOR)]
    lang, pair = F.struct(F.lit(1), "lang", F.lit(None).cast("string")), F.struct(F.lit(2), "lang", "source")
    levels = [F.to_json(pair), F.to_json(lang), F.lit("all")]
    fitted = stats.where("not base_failed").select(F.explode(F.array(*levels)).alias("g"), *xs)
    floors = list(VECTOR.values())
    estimates = robust_estimates(_written(fitted, "vectors"), floors, share, steps)
    judged = stats.select("*", *xs)
    for i, level in enumerate(levels):
        own = estimates if i == 2 else estimates.where(F.col("n") >= least_rows)
        judged = judged.join(_small(own.select(F.col("g").alias(f"g{i}"), F.col("e").alias(f"e{i}"))), level == F.col(f"g{i}"), "left")
    judged = _with_distance(judged.withColumn("e", F.coalesce("e0", "e1", "e2")), len(floors))
    cut = chi_square_quantile(len(floors), probability)
    near = F.coalesce(F.col("d") <= cut, F.lit(True))
    return judged.select("doc_id", *STATISTICS, "base_failed", F.col("d").alias("distance"), (~F.col("base_failed") & near).alias("kept"))
