"""Quality by robust outliers: minimum covariance determinant of text statistics per language and source.

Statistics of each text are array and string functions. Rows that pass the base rules are points with one
coordinate per entry of ``COORDINATES``; rows of one language and source are a group. No covariance can be learned from
fewer than ``LEAST_ROWS``: such groups share one per language, and languages that are too few even then share one.
For each group the half of its rows, ``(n + p + 1) / 2`` of n with p coordinates, with the smallest determinant of
covariance is sought by concentration: from a start, the nearest half gives the next centre and covariance, until
no group's determinant falls any more. There are two starts, the medians with their deviations, and the plain mean and
covariance; the smaller determinant counts. Distances are scaled so that their median is that of chi square. The rows
within its ``INNER`` quantile then give the final centre and covariance (reweighting), scaled by their own median.
Rows farther than ``CUTOFF`` in squared Mahalanobis distance are rejected. With less than half of a group far
off, centre and covariance are those of the others.

Distances are ranked by counting them in bins of a sixteenth of an octave, so that a group with a third of all
rows needs no sort: each step is two aggregations and a join with one row per group. All rows of the bin that
holds the half's last one are inside.

Everything is DataFrame functions; no Python runs in tasks.

Defined results: NULL and empty texts have no words and fail the base. NULL language or source is a value of its own. A
group without a point has no verdict to give, and the base decides. Equal rows get equal verdicts.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netwatch.llm.tasks import saved

# White space between words, and characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
RUN = 3
FEWEST_WORDS, MOST_REPEATED = 50, 50

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Each coordinate as SQL, and the least deviation that it is taken to have in any group.
COORDINATES = {
    "mean_chars": ("ln(word_chars / n_words)", 0.10),
    "symbols": ("n_symbols / n_words", 0.12),
    "dup_lines": ("ln(1 + n_dup_lines)", 0.50),
    "repeats": ("n_repeat_words / n_words", 0.08),
}
NAMES = tuple(COORDINATES)
PAIRS = [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]
LEAST_ROWS = 50
# A step goes on if some group's log determinant falls by more than this; determinants are bounded from below.
FALL = 0.01
# The median and the 97.5 % quantile of chi square with four degrees of freedom, and the median of a
# normal's absolute value.
CHI_MEDIAN, INNER, NORMAL_MEDIAN = 3.357, 11.143, 0.6745
# The quantile that one in 60 million normal points passes. Clean texts have longer tails than a normal.
CUTOFF = 42.0
OCTAVE = 16
# Places of a coordinate that medians tell apart.
GRID = 200.0


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, with the statistics of the text added."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = docs.columns
    split = docs.select(
        *names,
        F.array_remove(F.split(whole, SPACE), "").alias("_words"),
        F.filter(F.split(whole, "\n"), lambda line: line.rlike(NOT_SPACE)).alias("_lines"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    hashed = split.select(
        *names,
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("_words") >= RUN,
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - RUN),
                lambda i: F.struct(
                    F.xxhash64(*(F.get("_words", i + k) for k in range(RUN))).alias("h"), i.alias("i")
                ),
            ),
        ).alias("_runs"),
    )
    by_hash = hashed.withColumn("_runs", F.sort_array("_runs"))
    again = F.filter(
        "_runs",
        lambda run, k: (F.get("_runs", k - 1)["h"] == run["h"]) | (F.get("_runs", k + 1)["h"] == run["h"]),
    )
    places = by_hash.withColumn("_runs", F.sort_array(F.transform(again, lambda run: run["i"])))
    reach = F.transform("_runs", lambda i, k: F.least(F.coalesce(F.get("_runs", k + 1) - i, F.lit(RUN)), F.lit(RUN)))
    repeated = F.coalesce(F.aggregate(reach, F.lit(0), lambda total, n: total + n), F.lit(0))
    return places.withColumn("n_repeat_words", repeated.cast("long")).select(*names, *STATISTICS)


def base_failed() -> Column:
    words = F.col("n_words")
    return (words < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * words)


def with_points(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Coordinates and group of each row; rows that fail the base have no coordinates."""
    points = rows.withColumns(
        {name: F.when(~F.col("base_failed"), F.expr(sql)) for name, (sql, _) in COORDINATES.items()}
    ).withColumns(
        {
            "_own": F.to_json(F.struct(F.col(lang).alias("a"), F.col(source).alias("b"))),
            "_pool": F.to_json(F.struct(F.col(lang).alias("a"))),
        }
    )
    counts = saved(points.filter(~F.col("base_failed")).groupBy("_own", "_pool").count(), "groups")
    small = F.col("count") < LEAST_ROWS
    pools = counts.filter(small).groupBy("_pool").agg(F.sum("count").alias("_size"))
    group = F.when(~small, F.col("_own")).when(F.col("_size") >= LEAST_ROWS, F.col("_pool")).otherwise(F.lit("rest"))
    large = saved(counts.join(pools, "_pool", "left").select(F.col("_own").alias("_key"), group.alias("_group")), "groups")
    return points.join(large, F.col("_own") == F.col("_key"), "left").drop("_key", "_pool").withColumn(
        "_group", F.coalesce("_group", F.lit("rest"))
    )


def moments(rows: DataFrame) -> DataFrame:
    """Centre and covariance of each group's rows, no coordinate having less than its least deviation."""
    sums = rows.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.avg(name).alias(f"m{i}") for i, name in enumerate(NAMES)),
        *(F.covar_pop(NAMES[i], NAMES[j]).alias(f"c{i}{j}") for i, j in PAIRS),
    )
    return floored(sums)


def floored(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {f"c{i}{i}": F.col(f"c{i}{i}") + F.lit(least * least) for i, (_, least) in enumerate(COORDINATES.values())}
    )


def with_whitening(params: DataFrame) -> DataFrame:
    """The inverse ``w`` of the Cholesky factor ``l`` of each covariance, and the log of its determinant."""
    for i, j in PAIRS:
        rest = reduce(add, (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        value = F.col(f"c{i}{j}") - rest
        params = params.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1e-12))) if i == j else value / F.col(f"l{j}{j}"))
    for i in range(len(NAMES)):
        params = params.withColumn(f"w{i}{i}", 1 / F.col(f"l{i}{i}"))
        for j in range(i):
            dot = reduce(add, (F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)))
            params = params.withColumn(f"w{i}{j}", -dot * F.col(f"w{i}{i}"))
    determinant = reduce(add, (2 * F.log(F.col(f"l{i}{i}")) for i in range(len(NAMES))))
    return params.select(
        "_group",
        *(f"m{i}" for i in range(len(NAMES))),
        *(f"w{i}{j}" for i, j in PAIRS),
        determinant.alias("log_det"),
    )


def distance() -> Column:
    """Squared Mahalanobis distance of a row that stands beside its group's parameters."""
    off = [F.col(name) - F.col(f"m{i}") for i, name in enumerate(NAMES)]
    rows = (reduce(add, (F.col(f"w{i}{j}") * off[j] for j in range(i + 1))) for i in range(len(NAMES)))
    return reduce(add, (row * row for row in rows))


def distance_bin() -> Column:
    return F.floor(F.log2(distance() + F.lit(1e-6)) * OCTAVE).cast("int")


def rank_bins(points: DataFrame, params: DataFrame) -> DataFrame:
    """The parameters with the bin that the nearest half of a group's rows reaches, and that of the median."""
    bins = points.join(params, "_group").groupBy("_group", distance_bin().alias("_bin")).count()
    group = Window.partitionBy("_group")
    below = F.sum("count").over(group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = bins.select("_group", "_bin", below.alias("_below"), F.sum("count").over(group).alias("_all"))
    cuts = ranked.groupBy("_group").agg(
        F.min(F.when(2 * F.col("_below") >= F.least(F.col("_all") + len(NAMES) + 1, 2 * F.col("_all")), F.col("_bin"))).alias("near"),
        F.min(F.when(2 * F.col("_below") >= F.col("_all"), F.col("_bin"))).alias("half"),
    )
    return params.join(cuts, "_group")


def nearest(points: DataFrame, params: DataFrame, label: str) -> DataFrame:
    """The parameters of each group's half that is nearest by the given ones."""
    cut = saved(rank_bins(points, params), label)
    near = points.join(cut, "_group").filter(distance_bin() <= F.col("near"))
    return saved(with_whitening(moments(near)), label)


def concentrated(points: DataFrame, start: DataFrame, label: str) -> DataFrame:
    """The parameters of the half that concentration ends at. A start is no half, so the first step always counts."""
    params = nearest(points, saved(with_whitening(start), label), label)
    while True:
        after = nearest(points, params, label)
        both = params.alias("p").join(after.alias("a"), "_group")
        fell = both.filter(F.col("a.log_det") < F.col("p.log_det") - FALL).limit(1).count()
        if not fell:
            return params
        params = after


def scale() -> Column:
    """What a group's distances are divided by, so that their median is that of chi square; 1 at least."""
    return F.greatest(F.pow(F.lit(2.0), (F.col("half") + F.lit(0.5)) / OCTAVE) / CHI_MEDIAN, F.lit(1.0))


def reweighted(points: DataFrame, params: DataFrame) -> DataFrame:
    """Centre and covariance of the rows that are not far off by the given ones."""
    cut = saved(rank_bins(points, params), "halves")
    inner = points.join(cut, "_group").filter(distance() <= INNER * scale())
    return saved(with_whitening(moments(inner)), "reweighted")


def median_start(points: DataFrame) -> DataFrame:
    """Each coordinate's median, its absolute deviation from that as a normal's, and no correlation."""
    def medians(of: DataFrame) -> DataFrame:
        cells = of.groupBy("_group", "at", F.round(F.col("x") * GRID).alias("cell")).count()
        group = Window.partitionBy("_group", "at")
        below = F.sum("count").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
        ranked = cells.select("_group", "at", "cell", below.alias("below"), F.sum("count").over(group).alias("all"))
        halves = ranked.filter(2 * F.col("below") >= F.col("all"))
        return halves.groupBy("_group", "at").agg((F.min("cell") / GRID).alias("median"))

    long = points.select("_group", F.posexplode(F.array(*NAMES)).alias("at", "x"))
    centres = saved(medians(long), "medians")
    off = long.join(centres, ["_group", "at"]).select("_group", "at", F.abs(F.col("x") - F.col("median")).alias("x"))
    spreads = medians(off).withColumnRenamed("median", "spread")
    both = centres.join(spreads, ["_group", "at"]).groupBy("_group")

    def of(i: int, name: str) -> Column:
        return F.max(F.when(F.col("at") == i, F.col(name)))

    wide = both.agg(
        *(of(i, "median").alias(f"m{i}") for i in range(len(NAMES))),
        *(F.pow(of(i, "spread") / NORMAL_MEDIAN, F.lit(2)).alias(f"c{i}{i}") for i in range(len(NAMES))),
        *(F.lit(0.0).alias(f"c{i}{j}") for i, j in PAIRS if i != j),
    )
    return floored(wide)


def judged(
    docs: DataFrame, keep: list[str], lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """The kept columns of each row, its statistics, ``base_failed``, ``distance`` and ``kept``."""
    columns = {f"_k{i}": F.col(name) for i, name in enumerate(keep)}
    own = docs.select(
        *(column.alias(name) for name, column in columns.items()),
        F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col(text).alias("_text"),
    )
    counted = with_statistics(own, "_text").drop("_text").withColumn("base_failed", base_failed())
    rows = saved(with_points(saved(counted, "statistics"), "_lang", "_source"), "points")
    points = rows.filter(~F.col("base_failed")).select("_group", *NAMES)
    fits = [
        concentrated(points, median_start(points), "medians"),
        concentrated(points, moments(points), "means"),
    ]
    both = reduce(DataFrame.unionByName, fits)
    best = both.groupBy("_group").agg(F.min_by(F.struct(*both.columns[1:]), "log_det").alias("best"))
    params = saved(rank_bins(points, reweighted(points, best.select("_group", "best.*"))), "best")
    found = rows.join(params, "_group", "left").withColumn("distance", distance() / scale())
    return found.select(
        *(F.col(f"_k{i}").alias(name) for i, name in enumerate(keep)),
        *STATISTICS,
        "base_failed",
        "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).alias("kept"),
    )
