"""Quality rules: robust multivariate outliers among text statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The transformed statistics, and below which spread a group's variation is not told
#: apart from rounding: a group whose texts are all alike must not reject the first
#: that differs a little.
FEATURES = ("word_length", "symbols", "dup_lines", "repeats")
SPREAD = (0.25, 0.04, 0.15, 0.15)


def _columns(text: str) -> dict[str, Column]:
    """The counts as expressions on the text and, named ``__``, its parts."""
    full = F.coalesce(F.col(text), F.lit(""))
    hashes = F.transform("__words", lambda w, i: F.xxhash64(
        w, F.get(F.col("__words"), i + 1), F.get(F.col("__words"), i + 2)))
    return {
        "__words": F.filter(F.split(full, SPACE), lambda w: w != ""),
        "__lines": F.filter(F.split(full, "\n"), lambda x: x.rlike(WORD)),
        "__windows": F.slice(hashes, F.lit(1), F.greatest(F.size("__words") - 2, F.lit(0))),
    }


def _repeated_words() -> Column:
    """Words in three-word windows that occur twice or more.

    The windows are sorted with their places, so equal ones are neighbours; the places
    found are sorted again, and each covers the words up to the next, three at most.
    """
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(places: Column) -> Column:
        return F.filter(places, lambda x, i: (x["h"] == F.when(i > 0, F.get(places, i - 1)["h"]))
                        .eqNullSafe(True) | (x["h"] == F.get(places, i + 1)["h"]).eqNullSafe(True))

    def covered(places: Column) -> Column:
        return F.aggregate(
            places, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(3), p - a["last"])).cast("bigint").alias("n"), p.alias("last")),
            lambda a: a["n"])

    # a lambda binds each array once, so it is computed once
    once = F.transform(F.array(placed), lambda p: F.sort_array(F.transform(twice(p), lambda x: x["i"])))
    count = F.get(F.transform(once, covered), F.lit(0))
    return F.when(F.size(F.array_distinct("__windows")) == F.size("__windows"), F.lit(0)).otherwise(count)


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    Words are runs of other than ASCII white space; NULL counts as an empty text. All
    are expressions within the row, over the whole text.
    """
    parts = _columns(text)
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.col("__lines")
    return (
        docs.drop(*COUNTS)
        .withColumns({"__words": parts["__words"], "__lines": parts["__lines"]})
        .withColumn("__windows", parts["__windows"])
        .withColumns({
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": F.char_length(F.array_join("__words", "")).cast("bigint"),
            "n_symbols": F.regexp_count(full, F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            "n_repeat_words": _repeated_words().cast("bigint"),
            "n_lines": F.size(lines).cast("bigint"),
        })
        .drop("__words", "__lines", "__windows")
    )


def _features() -> dict[str, Column]:
    """Ratios are spread by arcsin of the square root, which evens out their variance."""
    def ratio(part: str, whole: str) -> Column:
        return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / F.greatest(F.col(whole), F.lit(1)))))

    values = (
        F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)),
        ratio("n_symbols", "word_chars"), ratio("n_dup_lines", "n_lines"), ratio("n_repeat_words", "n_words"),
    )
    return {n: F.coalesce(v, F.lit(0.0)) for n, v in zip(FEATURES, values)}


def _chi2(x: float, p: int) -> float:
    """The chi-square distribution with an even number ``p`` of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(p // 2))


def _chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, p) < q else (low, middle)
    return low


def _factor(share: float) -> float:
    """Makes the covariance of the central ``share`` of normal data that of all of it."""
    p = len(FEATURES)
    return share / _chi2(_chi2_quantile(share, p), p + 2)


def _moments(rows: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Mean and lower Cholesky factor of the covariance per group, in columns m0.. and l00.."""
    p = len(FEATURES)
    sums = {f"m{i}": F.avg(FEATURES[i]) for i in range(p)}
    sums |= {
        f"c{i}{j}": F.covar_pop(FEATURES[i], FEATURES[j]) * _factor(share)
        for i in range(p) for j in range(i + 1)
    }
    table = rows.groupBy(*keys).agg(*[v.alias(n) for n, v in sums.items()])
    for i in range(p):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") + F.lit(SPREAD[i] ** 2 if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # a covariance plus a diagonal is positive definite: the root is at least the spread
            value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            table = table.withColumn(f"l{i}{j}", value)
    return table.drop(*[c for c in table.columns if c.startswith("c")])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    p, solved = len(FEATURES), []
    for i in range(p):
        rest = F.col(FEATURES[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def outliers(
    stats: DataFrame, groups: list[str], stored: Stored, *,
    share: float = 0.75, steps: int = 4, level: float = 0.999, slack: float = 2.5,
) -> DataFrame:
    """``stats`` with ``distance`` (squared Mahalanobis) and ``outlier``, per group.

    Minimum covariance determinant by concentration steps (Rousseeuw and Van Driessen
    1999) from a deterministic start (Hubert et al. 2012): medians and their deviations.
    Each step measures all rows, takes the ``share`` nearest of each group (by an
    approximate quantile, precise to one row in 10,000) and estimates mean and
    covariance from those. A last step reweights by the 97.5 % quantile. A row is an
    outlier if its distance exceeds ``slack`` times the chi-square quantile at ``level``:
    the statistics are not quite normal, and clean texts must stay. Every group adds
    ``SPREAD`` to its covariance, which also serves groups of a few rows.

    Rows are joined with their group's estimate; each group's sums are aggregated in the
    tasks first, so a large group takes no task of its own.
    """
    keys = [f"__g{i}" for i in range(len(groups))]
    rows = stats.withColumns({k: F.col(g) for k, g in zip(keys, groups)})

    def measured(estimate: DataFrame) -> DataFrame:
        estimate = replicated_if_small(estimate.select(*[F.col(k).alias(f"e{k}") for k in keys], *[
            c for c in estimate.columns if c not in keys]))
        same = [F.col(k).eqNullSafe(F.col(f"e{k}")) for k in keys]
        joined = rows.join(estimate, same).withColumn("distance", _distance())
        return joined.drop(*[c for c in estimate.columns])

    middle = rows.groupBy(*keys).agg(*[
        F.percentile_approx(f, 0.5, 10000).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    side = replicated_if_small(stored(middle.select(*[F.col(k).alias(f"e{k}") for k in keys], *[
        f"m{i}" for i in range(len(FEATURES))])))
    spread = rows.join(side, [F.col(k).eqNullSafe(F.col(f"e{k}")) for k in keys]).groupBy(*keys).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(FEATURES))],
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, 10000).alias(f"d{i}")
          for i, f in enumerate(FEATURES)])
    scale = {f"l{i}{j}": F.sqrt(F.pow(F.col(f"d{i}") * 1.4826, 2) + SPREAD[i] ** 2) if i == j else F.lit(0.0)
             for i in range(len(FEATURES)) for j in range(i + 1)}
    estimate = stored(spread.withColumns(scale).drop(*[f"d{i}" for i in range(len(FEATURES))]))

    for step in range(steps + 1):
        now = measured(estimate)
        if step < steps:
            cut = now.groupBy(*keys).agg(F.percentile_approx("distance", share, 10000).alias("cut"))
            cut = replicated_if_small(stored(cut.select(*[F.col(k).alias(f"e{k}") for k in keys], "cut")))
            near = now.join(cut, [F.col(k).eqNullSafe(F.col(f"e{k}")) for k in keys]).where("distance <= cut")
            estimate = stored(_moments(near, keys, share))
        else:
            near = now.where(F.col("distance") <= _chi2_quantile(0.975, len(FEATURES)))
            # a group of which nothing is near keeps the estimate it has
            better = _moments(near, keys, 0.975)
            have = estimate.join(better.select(*[F.col(k).alias(f"e{k}") for k in keys]),
                                 [F.col(k).eqNullSafe(F.col(f"e{k}")) for k in keys], "left_anti")
            estimate = stored(better.unionByName(have))
    limit = slack * _chi2_quantile(level, len(FEATURES))
    return measured(estimate).withColumn("outlier", F.col("distance") > limit).drop(*keys)


def quality_rules(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    lang_column: str = "lang", source_column: str = "source", **options,
) -> DataFrame:
    """Counts and verdict per row of ``docs``: the id, the counts, ``base_failed``, ``distance``, ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated
    windows. ``kept``: not failed, and no outlier among the texts of its language and
    source that did not fail. A NULL or empty text fails. NULL language or source forms
    a group of its own; a failed row is in no group and has no distance. Repeated rows
    count as often as they occur. An empty table gives an empty result.
    """
    stored = Stored(docs.sparkSession)
    stats = text_counts(docs.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("__text"),
        F.col(lang_column).alias("lang"), F.col(source_column).alias("source"),
    ), "__text").drop("__text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = stored(stats.withColumn("base_failed", failed).withColumns(_features()))
    judged = outliers(stats.where("not base_failed"), ["lang", "source"], stored, **options)
    rest = stats.where("base_failed").withColumns(
        {"distance": F.lit(None).cast("double"), "outlier": F.lit(True)})
    return judged.unionByName(rest).select(
        F.col("doc_id").alias(id_column), *COUNTS, "base_failed", (~F.col("outlier")).alias("kept"), "distance")
