"""Quality rules with robust multivariate outliers, in DataFrame functions only.

A text has base rules and a vector of transformed statistics. Per language and source, centre and
covariance of the vectors are estimated by the minimum-covariance-determinant method: from a start
by medians and deviations, concentration steps repeat "fit the share H of rows that lie nearest".
Texts that are far from their group by Mahalanobis distance are rejected.

Each step is an aggregation of moments per group with partial sums, and a join of the rows with a
table of one row per group, written so that its real size decides the join; a group with a third of
all rows is summed in every task. Which rows are nearest comes from counts in fixed, fine bins of
the distance, so no group is ever sorted.

Groups with fewer than ``least`` rows are pooled with the other small ones of their language, and
what is still small with the small ones of all languages.

Defined results: NULL and empty texts have no words and fail the base rules; the vectors of texts
that fail have no part in the estimates. NULL language or source is a group like others. Constant
statistics get a floor under their variance. Rows with equal ids are judged one by one. An empty
table gives an empty table. Whole texts of any length are read.
"""
from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.llm.common import SPACE, column, words
from lagwise.sources.layers import staged

#: Share of the rows that an estimate is fitted to, concentration steps.
H, STEPS = 0.75, 4
#: Squared distance from which a text is rejected. For five normal statistics, 99.9999 % lie below
#: about 38; text statistics have heavier tails, hence twice that distance.
CUTOFF = 150.0
#: Variance floor, in units of the transformed statistics.
FLOOR = 2.5e-3
NAMES = ("length", "word_length", "symbols", "dup_lines", "repeats")
#: Rows a group needs for an estimate of its own: five for each statistic, the usual least of the method.
LEAST_ROWS = 5 * len(NAMES)
_BINS = 64  # per factor e of a squared distance
_PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def _covered(windows: Column) -> Column:
    """Words in windows that equal a neighbour in the sorted list; a window covers three places."""
    repeats = F.filter(windows, lambda x, k: (x["h"] == F.get(windows, k - 1)["h"])
                       | (x["h"] == F.get(windows, k + 1)["h"]))
    return F.size(F.array_distinct(F.flatten(F.transform(
        repeats, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))


def statistics(rows: DataFrame) -> DataFrame:
    """``rows`` with text replaced by n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Three-word windows are hashed and sorted with their places, so that repeats are neighbours.
    """
    others = [c for c in rows.columns if c != "text"]
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(f"[^{SPACE}]"))
    w = F.col("w")
    windows = F.sort_array(F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda first, i: F.struct(F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                                  i.alias("i"))))
    split = rows.select(*others, words(F.col("text")).alias("w"), lines.alias("lines"),
                        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).alias("n_symbols"))
    split = split.withColumn("windows", windows)
    count = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _covered(F.col("windows")),
    }
    return split.select(*others, *(v.cast("long").alias(k) for k, v in count.items()))


def _vector() -> list[Column]:
    """Transformed statistics: logarithms of sizes, square roots of shares."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log(n), F.log((F.col("word_chars") + 1) / n), F.sqrt(F.col("n_symbols") / n),
            F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n)]


def _bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-12) * _BINS)


def _moments(rows: DataFrame) -> DataFrame:
    """Per group: centre m_i and covariance c_ij of x_i."""
    first = {f"m{i}": F.avg(f"x{i}") for i in range(len(NAMES))}
    cross = {f"c{i}{j}": F.covar_pop(f"x{i}", f"x{j}") for i, j in _PAIRS}
    return rows.groupBy("g").agg(*(v.alias(k) for k, v in (first | cross).items()))


def _factored(moments: DataFrame) -> DataFrame:
    """Per group the centre and the Cholesky factor l_ij of the covariance."""
    out = moments
    for i, j in _PAIRS:
        done = [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)]
        rest = reduce(lambda a, b: a - b, done, F.col(f"c{i}{j}") + (FLOOR if i == j else 0))
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOOR))) if i == j
                             else rest / F.col(f"l{j}{j}"))
    return out.select("g", *(f"m{i}" for i in range(len(NAMES))), *(f"l{i}{j}" for i, j in _PAIRS))


def _distance(rows: DataFrame, groups: DataFrame, keep: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with d2, the squared Mahalanobis distance from their group."""
    out = rows.join(groups, "g", how)
    for i in range(len(NAMES)):
        known = [F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)]
        out = out.withColumn(f"y{i}", reduce(
            lambda a, b: a - b, known, F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"l{i}{i}"))
    return out.select(*keep, reduce(add, (F.col(f"y{i}") * F.col(f"y{i}")
                                          for i in range(len(NAMES)))).alias("d2"))


def _cut(binned: DataFrame, share: float, by: list[str], name: str) -> DataFrame:
    """Per group the smallest bin up to which at least ``share`` of the rows lie.

    ``binned`` has one row per group and bin that occurs; the bins of a group are a few thousand at
    most, as they are logarithmic.
    """
    lists = binned.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("bin", "k"))).alias("l"),
                                    F.sum("k").alias("n"))
    least = F.ceil(F.col("n") * share)
    found = F.aggregate("l", F.struct(F.lit(0).cast("long").alias("sum"),
                                      F.lit(None).cast("long").alias("bin")),
                        lambda acc, x: F.struct(
                            (acc["sum"] + x["k"]).alias("sum"),
                            F.when(acc["sum"] >= least, acc["bin"]).otherwise(x["bin"]).alias("bin")),
                        lambda acc: acc["bin"])
    return lists.select(*by, found.alias(name))


def _start(rows: DataFrame) -> DataFrame:
    """Per group a first centre and a diagonal factor: medians and median absolute deviations,
    both read off bins of 1/64."""
    dims = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x"))
                               for i in range(len(NAMES)))))
    flat = rows.select("g", dims.alias("d")).select("g", "d.*")
    bins = staged(flat.groupBy("g", "i", F.floor(F.col("x") * _BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("k")), "bins")
    middle = _cut(bins, 0.5, ["g", "i"], "median")
    spread = bins.join(middle, ["g", "i"]).groupBy(
        "g", "i", F.abs(F.col("bin") - F.col("median")).alias("bin")).agg(F.sum("k").alias("k"))
    mad = _cut(spread, 0.5, ["g", "i"], "mad")
    both = middle.join(mad, ["g", "i"]).groupBy("g")
    zero = F.lit(0.0)

    def of(i: int, value: Column) -> Column:
        return F.max(F.when(F.col("i") == i, value))

    return both.agg(
        *(of(i, (F.col("median") + 0.5) / _BINS).alias(f"m{i}") for i in range(len(NAMES))),
        *((of(i, 1.4826 * (F.col("mad") + 0.5) / _BINS) if i == j else F.max(zero)).alias(f"l{i}{j}")
          for i, j in _PAIRS))


def estimates(rows: DataFrame) -> DataFrame:
    """Per group g the centre and factor of its rows x_0 ... by concentration steps."""
    columns = ["g", *(f"x{i}" for i in range(len(NAMES)))]
    groups = staged(_start(rows), "groups")
    for _ in range(STEPS):
        near = _distance(rows, groups, columns)
        binned = near.groupBy("g", _bin(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("k"))
        # Written, so that its real size decides the join: rows of a large group need not meet.
        limited = staged(groups.join(_cut(binned, H, ["g"], "limit"), "g"), "limits")
        core = _distance(rows, limited, [*columns, "limit"]).filter(
            _bin(F.col("d2")) <= F.col("limit"))
        groups = staged(_factored(_moments(core)), "groups")
    # The nearest share H of a normal sample is too narrow; scaling by the distance within which
    # the share lies (against its normal value, 6.63 for five statistics) makes up for it.
    near = _distance(rows, groups, columns)
    binned = near.groupBy("g", _bin(F.col("d2")).alias("bin")).agg(F.count(F.lit(1)).alias("k"))
    wide = _cut(binned, H, ["g"], "limit").select(
        "g", F.sqrt(F.greatest(F.exp(F.col("limit") / _BINS) / 6.63, F.lit(1.0))).alias("wide"))
    factors = [(F.col(f"l{i}{j}") * F.col("wide")).alias(f"l{i}{j}") for i, j in _PAIRS]
    return staged(groups.join(wide, "g").select(
        "g", *(f"m{i}" for i in range(len(NAMES))), *factors), "groups")


def _tag(value: Column) -> Column:
    """A group value as text of which no two are equal when joined, NULL included."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit("="), text), F.lit("-"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", cutoff: float = CUTOFF, least: int = LEAST_ROWS) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, d2."""
    given = docs.select(column(id_col).alias("doc_id"),
                        F.coalesce(column(text_col), F.lit("")).alias("text"),
                        _tag(column(lang_col)).alias("lang"), _tag(column(source_col)).alias("source"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = staged(statistics(given).withColumn("base_failed", failed), "statistics")
    sizes = staged(counted.filter(~F.col("base_failed")).groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n")), "sizes")
    small = sizes.filter(F.col("n") < least).groupBy("lang").agg(F.sum("n").alias("pooled"))
    key = F.when(F.col("n") >= least, F.concat("lang", "source")).when(
        F.col("pooled") >= least, F.col("lang")).otherwise("")
    names = staged(sizes.join(small, "lang", "left").select("lang", "source", key.alias("g")), "names")
    rows = staged(counted.join(names, ["lang", "source"], "left").select(
        *(c for c in counted.columns if c not in ("lang", "source")), "g",
        *(x.alias(f"x{i}") for i, x in enumerate(_vector()))), "vectors")
    groups = estimates(rows.filter(~F.col("base_failed")))
    shown = ["doc_id", *(c for c in counted.columns if c.startswith(("n_", "word_"))), "base_failed"]
    far = _distance(rows, groups, shown, "left")
    return far.select(*shown, (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias(
        "kept"), "d2")
