"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Per document the base counts: words, characters in words, symbols, repeated lines,
words in repeated three-word windows. Base rules fail short texts and repetitive
ones. The documents that pass get a vector of transformed statistics; per language
and source the minimum-covariance-determinant estimate is approached by concentration
steps from several robust starts (distances from medians and quartiles under several
norms). A step takes the mean and covariance of the rows nearest to the last estimate;
steps go on while a determinant falls, and of all starts the least determinant is kept.
Documents far from it by Mahalanobis distance are rejected.

Order statistics are read from counts over a fixed grid of values and sums are
sums of whole numbers, so a result depends neither on the order of rows nor on how
they are dealt out, and a group of any size takes a bounded table.

Null and empty texts have no words and fail the base rules. Null languages and
sources are groups of their own. A group of fewer than ``LEAST_ROWS`` passing
documents takes the estimate of all of its language, and that of all rows where the
language has fewer, so every passing document has a distance. Repeated rows count each.
Rows of equal vectors get equal verdicts. ``judged`` keeps all columns and adds its
own as one struct, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from itemsync.llm.common import BLANK_WORD, written

LEAST_WORDS = 50
#: Percent of the words that may stand in repeated windows.
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Statistics are held as whole multiples of 1 / GRID.
GRID = 1024
STATISTICS = ("x0", "x1", "x2", "x3")
#: Least standard deviation of a statistic. Most rows have no symbols and no repeats, so the floors say there what
#: is far: a symbol in four words, 40 % repeated lines, half of the words repeated. One repeated line of many is not.
FLOORS = (0.05, 0.05, 0.37, 0.41)
#: Percent of a group's rows in the core, the subset of least covariance determinant.
CORE = 75
#: Makes the core's covariance that of all rows if they are normal, for 4 statistics and a core of 75 %.
CONSISTENCY = 1.485
#: Concentration steps, at most; they end where no determinant falls by this share.
STEPS = 30
LEAST_FALL = 1e-6
LEAST_ROWS = 50
#: Name of the group of all rows.
ALL = "all"
#: Squared Mahalanobis distance beyond which a document is rejected: chi-square of 4 statistics, 99.9 %.
CUT = 18.467
#: Squared distances are counted by their logarithm, in steps of 1 / DISTANCE_GRID.
DISTANCE_GRID = 64

GROUP = ("lang", "source")
#: An estimate belongs to a group and a start.
KEYS = ("group", "start")


def measured(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) as ``row``, lang, source, the base counts and ``base_failed``.

    Three-word windows are compared by 64-bit hash. Where a text has equal ones, they are sorted by
    hash and place; those equal to a neighbour cover the repeated words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*(keep or ["*"])).alias("row"), *GROUP, text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(f"({BLANK_WORD})"), F.lit(1)))
    rows = rows.withColumn("_lines", lines)
    rows = rows.select(
        "row",
        *GROUP,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.translate("_text", BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.expr(
            "transform(slice(_words, 1, greatest(size(_words) - 2, 0)),"
            " (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2)))"
        ).alias("_windows"),
    )
    ordered = F.expr(
        "if(size(array_distinct(_windows)) = size(_windows), null,"
        " array_sort(transform(_windows, (h, i) -> struct(h, i))))"
    )
    places = F.expr(
        "array_sort(transform(filter(_ordered, (e, k) ->"
        " coalesce(e.h = get(_ordered, k - 1).h, false) or coalesce(e.h = get(_ordered, k + 1).h, false)), e -> e.i))"
    )
    covered = F.expr(
        "aggregate(transform(_places, (p, k) -> least(3, coalesce(get(_places, k + 1) - p, 3))), 0L, (n, c) -> n + c)"
    )
    rows = rows.withColumn("_ordered", ordered).drop("_windows").withColumn("_places", places).drop("_ordered")
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint"))).drop("_places")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _statistics() -> list[Column]:
    """Mean word length, symbols by word, repeated lines and repeated words, transformed to be about normal."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(F.col("n_symbols") / n),
        F.log1p(10 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.log1p(10 * F.col("n_repeat_words") / n),
    ]


def _quantiles(values: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """Per key the least values ``q0``, ``q1``, .. that the stated shares of the rows do not exceed.

    ``values`` has the keys and a whole ``v``; only counts by value are sorted.
    """
    sizes = values.groupBy(*keys, "v").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = sizes.withColumn("c", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    least = [F.min(F.when(F.col("c") >= F.col("all") * share, F.col("v"))).alias(f"q{i}") for i, share in enumerate(shares)]
    return running.groupBy(*keys).agg(*least)


def _log_distance(squared: Column) -> Column:
    return F.round(F.log(F.greatest(squared, F.lit(1e-6))) * DISTANCE_GRID).cast("int")


def _core(distances: DataFrame) -> DataFrame:
    """The rows of each estimate (``squared`` is theirs) within the distance that ``CORE`` percent keep."""
    limits = _quantiles(distances.select(*KEYS, _log_distance(F.col("squared")).alias("v")), [*KEYS], [CORE / 100])
    # stored, so that the join has plain scans on both sides and can split a large group
    near = distances.join(written(limits, "limits"), [*KEYS])
    return near.where(_log_distance(F.col("squared")) <= F.col("q0"))


def _starts(vectors: DataFrame) -> DataFrame:
    """Squared distances of every row under each start.

    Statistics are scaled by quartiles; the starts are the Euclidean, the greatest and the summed
    distance from the medians, and the Euclidean one from the lower quartiles.
    """
    pieces = F.explode(F.array(*(F.struct(F.lit(i).alias("s"), F.col(x).alias("v")) for i, x in enumerate(STATISTICS))))
    long = vectors.select("group", pieces.alias("p")).select("group", "p.s", "p.v")
    quartiles = _quantiles(long, ["group", "s"], [0.25, 0.5, 0.75])
    of = lambda i, q: F.max(F.when(F.col("s") == i, F.col(q)))
    wide = quartiles.groupBy("group").agg(
        *(of(i, q).alias(f"{q}_{i}") for i in range(len(STATISTICS)) for q in ("q0", "q1", "q2"))
    )
    met = vectors.join(written(wide, "quartiles"), "group")

    def scaled(center: str) -> list[Column]:
        spread = [F.greatest((F.col(f"q2_{i}") - F.col(f"q0_{i}")) / 1.349, F.lit(FLOORS[i] * GRID)) for i in range(len(STATISTICS))]
        return [F.abs(F.col(x) - F.col(f"{center}_{i}")) / spread[i] for i, x in enumerate(STATISTICS)]

    middle, low = scaled("q1"), scaled("q0")
    total = lambda parts: sum(parts[1:], parts[0])
    starts = [total([z * z for z in middle]), F.pow(F.greatest(*middle), F.lit(2.0)), F.pow(total(middle), F.lit(2.0))]
    starts.append(total([z * z for z in low]))
    each = F.array(*(F.struct(F.lit(i).alias("start"), squared.alias("squared")) for i, squared in enumerate(starts)))
    return met.select("group", *STATISTICS, F.explode(each).alias("e")).select("group", *STATISTICS, "e.start", "e.squared")


def _estimate(core: DataFrame) -> DataFrame:
    """Mean, the Cholesky factor of the covariance of each core, and the logarithm of its determinant.

    Sums of whole numbers are exact. The floors are added to the variances.
    """
    p = range(len(STATISTICS))
    whole = lambda c: F.sum(c.cast("decimal(20,0)")).cast("double")
    x = [F.col(name).cast("bigint") for name in STATISTICS]
    sums = core.groupBy(*KEYS).agg(
        F.count("*").alias("n"),
        *(whole(x[i]).alias(f"s{i}") for i in p),
        *(whole(x[i] * x[j]).alias(f"s{i}{j}") for i in p for j in range(i + 1)),
    )
    n = F.col("n")
    out = sums.select(
        *KEYS,
        *((F.col(f"s{i}") / n).alias(f"m{i}") for i in p),
        *(
            (
                CONSISTENCY * (F.col(f"s{i}{j}") / n - F.col(f"s{i}") / n * F.col(f"s{j}") / n)
                + (F.lit((FLOORS[i] * GRID) ** 2) if i == j else F.lit(0.0))
            ).alias(f"c{i}{j}")
            for i in p
            for j in range(i + 1)
        ),
    )
    for j in p:
        used = sum((F.pow(F.col(f"l{j}{k}"), F.lit(2.0)) for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - used, F.lit(1e-6))))
        for i in range(j + 1, len(STATISTICS)):
            used = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - used) / F.col(f"l{j}{j}"))
    determinant = 2 * sum((F.log(f"l{i}{i}") for i in p), F.lit(0.0))
    return out.select(
        *KEYS, determinant.alias("log_det"), *(f"m{i}" for i in p), *(f"l{i}{j}" for i in p for j in range(i + 1))
    )


def _squared() -> Column:
    """Squared Mahalanobis distance of the vector from the joined estimate, by forward substitution."""
    solved: list[Column] = []
    for i, name in enumerate(STATISTICS):
        rest = F.col(name) - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * solved[k] for k in range(i)), F.lit(0.0))
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((y * y for y in solved), F.lit(0.0))


def _least(found: DataFrame, keys: list[str]) -> DataFrame:
    """The estimate of the least determinant for each of ``keys``, of equal ones that of the earlier start."""
    rest = [c for c in found.columns if c not in (*keys, "log_det", "start")]
    order = ["log_det", *(c for c in ("start",) if c not in keys)]
    return found.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("e")).select(*keys, "e.*")


def estimates(vectors: DataFrame, steps: int = STEPS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Stored robust estimates of the groups that have ``least_rows`` vectors."""
    sizes = vectors.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") >= least_rows).drop("n")
    usable = vectors.join(written(sizes, "groups"), "group")
    best = moving = written(_estimate(_core(_starts(usable))), "estimate")
    for _ in range(steps):
        distances = usable.join(moving, "group").select(*KEYS, *STATISTICS, _squared().alias("squared"))
        after = written(_estimate(_core(distances)), "estimate")
        before = best.select(*KEYS, F.col("log_det").alias("before"))
        fell = after.join(before, [*KEYS]).where(F.col("log_det") < F.col("before") - LEAST_FALL).drop("before")
        moving = written(fell, "moving")
        if not moving.limit(1).count():
            break
        best = written(_least(best.unionByName(moving), [*KEYS]), "best")
    return written(_least(best, ["group"]), "estimates")


def _by_group(vectors: DataFrame, steps: int, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Stored estimate of every group: its own, its language's or that of all rows, the first of ``least_rows`` rows.

    That of all rows has whatever rows there are.
    """
    sizes = written(vectors.groupBy("group", "language").agg(F.count("*").alias("n")), "sizes")
    languages = written(sizes.groupBy("language").agg(F.sum("n").alias("m")), "languages")
    level = F.when(F.col("n") >= least_rows, F.col("group")).when(F.col("m") >= least_rows, F.col("language"))
    used = sizes.join(languages, "language").select("group", F.coalesce(level, F.lit(ALL)).alias("used"))
    used = written(used, "used")
    levels = F.explode(F.array("group", "language", F.lit(ALL))).alias("group")
    wanted = written(used.select(F.col("used").alias("group")).distinct(), "wanted")
    learned = written(vectors.select(levels, *STATISTICS).join(wanted, "group"), "learned")
    found = estimates(learned, steps, least_rows=0).withColumnRenamed("group", "used").drop("start", "log_det")
    return written(used.join(found, "used").drop("used"), "estimates")


def judged(docs: DataFrame, keep: list[str] | None = None, cut: float = CUT, steps: int = STEPS) -> DataFrame:
    """``row``, lang, source, the base counts, base_failed, squared (the distance, null without one), kept."""
    base = measured(docs, keep)
    group = F.struct(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in GROUP), F.col("lang").isNull(), F.col("source").isNull())
    exact = [F.round(s * GRID).cast("int").alias(n) for s, n in zip(_statistics(), STATISTICS)]
    base = written(base.select("*", F.to_json(group).alias("group"), *exact), "measured")
    language = F.to_json(F.struct(F.coalesce("lang", F.lit("")).alias("lang"), F.col("lang").isNull()))
    vectors = base.where("not base_failed").select("group", language.alias("language"), *STATISTICS)
    vectors = written(vectors, "vectors")
    met = base.join(_by_group(vectors, steps), "group", "left").withColumn("squared", _squared())
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("squared") > cut, F.lit(False))
    return met.select(*base.columns[:-5], "squared", kept.alias("kept"))
