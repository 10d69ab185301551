"""Quality rules (operator 6): base rules, then robust multivariate outliers.

Text statistics become a vector of four numbers on a fixed grid; per language
and source a minimum-covariance-determinant estimate (centre and scatter of the
share ``H`` of the documents that lies closest together) is found by C-steps
from three starts, of which the one with the least determinant is taken, and a
document is rejected whose Mahalanobis distance is beyond a chi-square
quantile. Most documents have none of the last three numbers at all, so a
group's closest share may have no scatter in them; each number's variance is
therefore raised (``floors``) by its pooled scatter, every number trimmed on
itself, and by the counting noise of a text of median length. Neither grows with
the outliers while they are fewer than a share 1 - ``H`` of their group.
DataFrame functions only. Every C-step is two grouped aggregations
over a narrow stored table: counts by distance step, and sums of products;
both combine before the shuffle, so a hot group costs no more than a cold one.
Grid values make all sums whole numbers, so results do not depend on the order
of addition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skirmish.llm.storage import stored

H = 0.75  # share of a group that the estimate rests on
C_STEPS = 3
TAIL = 1e-6  # share of a normal group that would lie beyond the limit
MIN_GROUP = 100  # smaller groups use their language's estimate, then the estimate of all
GRID = 1024  # steps per unit of the vector
TINY = 1 / GRID  # least standard deviation, only against singular matrices
PRIOR_WORDS, PRIOR_CHARS = 50, 300  # weigh short texts' mean word length down
PRIOR_LINES = 20  # and their share of repeated lines
P = 4  # numbers of the vector

SPACE = r"[\x20\x09-\x0D]+"
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def chi2_cdf_even(x: float, dof: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi2_quantile_even(tail: float, dof: int) -> float:
    """The value that a chi-square variable exceeds with probability ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_cdf_even(mid, dof) > tail else (low, mid)
    return high


#: Columns of an estimate: centre and Cholesky factor.
ESTIMATE = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i in range(P) for j in range(i + 1)]
LIMIT = chi2_quantile_even(TAIL, P)
#: The scatter of the closest share H of a normal group is too small by this factor.
CONSISTENCY = H / chi2_cdf_even(chi2_quantile_even(1 - H, P), P + 2)


def statistics(text: Column) -> dict[str, Column]:
    """Word list and counts of a text as named columns (see ``text_statistics``)."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.translate(x, BLANK, "") != "")
    return {"words": words, "lines": lines, "word_chars": F.length(F.translate(t, BLANK, "")).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")}


def text_statistics(df: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_lines and
    n_repeat_words of every whole text."""
    s = statistics(F.col(text_col))
    cut = df.select(*keep, *[c.alias(f"_{name}") for name, c in s.items()])
    counted = cut.withColumn("_windows", F.when(
        F.size("_words") >= 5, F.transform(F.sequence(F.lit(1), F.size("_words") - 4),
                                           lambda i: F.xxhash64(F.slice("_words", i, 5)))).otherwise(F.array().cast("array<bigint>")))
    # Repeated windows by position: neighbours in the sorted (hash, position)
    # pairs. Each step is a column of its own, so none is evaluated per element.
    repeated = F.size("_windows") > F.size(F.array_distinct("_windows"))
    paired = counted.withColumn("_pairs", F.when(repeated, F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def twice(p, i):
        return ((i > 0) & (F.get("_pairs", F.greatest(i - 1, F.lit(0)))["h"] == p["h"])) | F.coalesce(
            F.get("_pairs", i + 1)["h"] == p["h"], F.lit(False))

    found = paired.withColumn("_at", F.sort_array(F.filter(F.transform(
        "_pairs", lambda p, i: F.when(twice(p, i), p["i"])), lambda x: x.isNotNull())))
    # A repeated window covers five words, or those up to the next one.
    covered = F.aggregate(F.transform("_at", lambda x, i: F.least(F.lit(5), F.coalesce(F.get("_at", i + 1) - x, F.lit(5)))),
                          F.lit(0), lambda a, b: a + b)
    return found.select(
        *[c for c in found.columns if not c.startswith("_")], F.size("_words").cast("long").alias("n_words"),
        F.col("_word_chars").alias("word_chars"), F.col("_n_symbols").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def vector() -> list[Column]:
    """The transformed statistics in steps of 1 / ``GRID``: smoothed mean word
    length, and roots of the shares of symbols, repeated lines (smoothed) and repeated words."""
    def root(a, b):
        return F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)).cast("double"))

    values = [(F.col("word_chars") + PRIOR_CHARS) / (F.col("n_words") + PRIOR_WORDS).cast("double"),
              root("n_symbols", "word_chars"), F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + PRIOR_LINES).cast("double")), root("n_repeat_words", "n_words")]
    return [F.floor(v * GRID + 0.5).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution with the scatter's
    Cholesky factor l and centre m."""
    z: list[Column] = []
    for i in range(P):
        rest = F.col(f"x{i}") / GRID - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    out = z[0] * z[0]
    for v in z[1:]:
        out = out + v * v
    return out


def _factor(moments: DataFrame, least: list[float]) -> DataFrame:
    """Centres m and Cholesky factors l from a group's n, sums s and products
    q: scatter times ``CONSISTENCY`` plus the floors."""
    out = moments
    for i in range(P):
        out = out.withColumn(f"m{i}", F.col(f"s{i}") / (F.col("n") * F.lit(GRID)))
    for i in range(P):
        for j in range(i + 1):
            cov = (F.col(f"q{i}{j}") / (F.col("n") * F.lit(GRID * GRID)) - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + least[i] ** 2
            for k in range(j):
                cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(cov) if i == j else cov / F.col(f"l{j}{j}"))
    return out.select("g", "s", *ESTIMATE)


def _moments(vectors: DataFrame) -> DataFrame:
    w = F.col("w")
    return vectors.groupBy("g", "s").agg(
        F.sum("w").alias("n"), *[F.sum(F.col(f"x{i}") * w).alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}") * w).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1)])


def _long(vectors: DataFrame, value) -> DataFrame:
    """(g, i, x, n, upto, all): how often each number i of a group has the value
    ``value(i)``, running total and total; as many rows as grid values."""
    number = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value(i).alias("x")) for i in range(P)]))
    counts = vectors.select("g", "w", number.alias("v")).groupBy("g", "v.i", "v.x").agg(F.sum("w").alias("n"))
    part = Window.partitionBy("g", "i")
    return (counts.withColumn("upto", F.sum("n").over(part.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("all", F.sum("n").over(part)))


def _quantiles(vectors: DataFrame) -> DataFrame:
    """Coordinate medians m and lower quartiles b of each group."""
    each = _long(vectors, lambda i: F.col(f"x{i}")).groupBy("g", "i").agg(
        (F.min(F.when(2 * F.col("upto") >= F.col("all"), F.col("x"))) / GRID).alias("m"),
        (F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("x"))) / GRID).alias("b"))
    return each.groupBy("g").agg(*[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for c in "mb" for i in range(P)])


def _spread(vectors: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Per group and number i: rows n{i} and squared steps t{i} from the median
    over the share ``H`` of the group that is closest in this number."""
    near = vectors.join(quantiles, "g")
    inner = _long(near, lambda i: F.abs(F.col(f"x{i}") - F.round(F.col(f"m{i}") * GRID).cast("long"))).where(
        F.col("upto") - F.col("n") < F.col("all") * H)
    own = [F.col("i") == i for i in range(P)]
    return inner.groupBy("g").agg(*[F.sum(F.when(own[i], F.col("n"))).alias(f"n{i}") for i in range(P)],
                                  *[F.sum(F.when(own[i], F.col("x") * F.col("x") * F.col("n"))).alias(f"t{i}") for i in range(P)])


def _closest(near: DataFrame) -> DataFrame:
    """(g, s, cut): the least step within which the share ``H`` of a group lies."""
    counts = near.groupBy("g", "s", "step").agg(F.sum("w").alias("n"))
    part = Window.partitionBy("g", "s")
    return (counts.withColumn("upto", F.sum("n").over(part.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("all", F.sum("n").over(part))
            .where(F.col("upto") >= F.col("all") * H).groupBy("g", "s").agg(F.min("step").alias("cut")))


def counting_noise(rows: DataFrame) -> list[float]:
    """Scatter that counting alone gives each number in a text of median length:
    the root of a share k / n has the variance c / 4n if k comes in clusters of c
    (a repeated window is five words). Medians go by eighths of a power of two,
    so at most some hundred counts reach the driver. Mean word length: none."""
    sizes = [F.col("word_chars"), F.col("n_lines") + PRIOR_LINES, F.col("n_words")]
    step = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("i"), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double")) * 8).alias("e"))
                               for i, n in enumerate(sizes)]))
    counts = rows.select(step.alias("v")).groupBy("v.i", "v.e").count().orderBy("i", "e").collect()
    noise = [0.0] * P
    for i, cluster in zip(range(1, P), (1, 1, 5)):
        own = [(r["e"], r["count"]) for r in counts if r["i"] == i]
        half, total = 0, sum(n for _, n in own)
        for e, n in own:
            half += n
            if 2 * half >= total:
                noise[i] = math.sqrt(cluster / 2 ** (e / 8)) / 2
                break
    return noise


def floors(spread: DataFrame, noise: list[float]) -> list[float]:
    """Least scatter of each number: its counting noise or, if larger, the root
    mean square distance from the medians of all groups, trimmed on itself."""
    sums = spread.agg(*[F.sum(f"{c}{i}").alias(f"{c}{i}") for c in "nt" for i in range(P)]).first()
    return [max(math.sqrt((sums[f"t{i}"] or 0) / (sums[f"n{i}"] or 1)) / GRID, noise[i], TINY) for i in range(P)]


def _starts(quantiles: DataFrame, spread: DataFrame, least: list[float]) -> DataFrame:
    """Three diagonal estimates s of each group: medians with twice the floors,
    medians with the group's own trimmed scatter, lower quartiles with twice the floors."""
    own = [F.greatest(F.sqrt(F.col(f"t{i}") / F.col(f"n{i}").cast("double")) / GRID, F.lit(x)) for i, x in enumerate(least)]
    twice = [F.lit(2 * x) for x in least]

    def start(s, centre, scatter):
        factor = [(scatter[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(P) for j in range(i + 1)]
        return F.struct(F.lit(s).alias("s"), *[F.col(f"{centre}{i}").alias(f"m{i}") for i in range(P)], *factor)

    each = F.explode(F.array(start(0, "m", twice), start(1, "m", own), start(2, "b", twice)))
    return quantiles.join(spread, "g").select("g", each.alias("e")).select("g", "e.*")


def _c_step(vectors: DataFrame, estimate: DataFrame, least: list[float]) -> DataFrame:
    """Each start's estimate from the share ``H`` of each group that lies
    closest to its last one; distances are compared in steps of 1/64."""
    near = vectors.join(estimate, "g").select("g", "s", "w", *[f"x{i}" for i in range(P)],
                                              F.floor(F.sqrt(_distance()) * 64).alias("step"))
    return _factor(_moments(near.join(stored(_closest(near), "cut"), ["g", "s"]).where("step <= cut")), least)


def _levels() -> list[Column]:
    """Group names of a row from all rows to its language and source."""
    lang = F.concat(F.length("lang").cast("string"), F.lit(":"), "lang")
    return [F.lit("0"), F.concat(F.lit("1:"), lang), F.concat(F.lit("2:"), lang, "source")]


def _groups(rows: DataFrame) -> DataFrame:
    """(lang, source, own): the group whose estimate judges them, the first
    with ``MIN_GROUP`` rows of language and source, the language, all."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    everything, lang, both = _levels()
    of_lang = F.sum("n").over(Window.partitionBy("lang"))
    return sizes.select("lang", "source", F.when(F.col("n") >= MIN_GROUP, both)
                        .when(of_lang >= MIN_GROUP, lang).otherwise(everything).alias("own"))


def mcd(vectors: DataFrame, noise: list[float]) -> DataFrame:
    """Minimum covariance determinant of weighted grid vectors (g, x.., w) per
    group g: centre m.. and Cholesky factor l.. of the scatter of the start
    that ends with the least determinant (a tie: the first). ``noise``: the
    least scatter of each number."""
    quantiles = stored(_quantiles(vectors), "quantiles")
    spread = stored(_spread(vectors, quantiles), "spread")
    least = floors(spread, noise)
    estimate = _starts(quantiles, spread, least)
    for _ in range(C_STEPS):
        estimate = stored(_c_step(vectors, estimate, least), "estimate")
    root = F.lit(1.0)
    for i in range(P):
        root = root * F.col(f"l{i}{i}")
    best = F.min_by(F.struct(*ESTIMATE), F.struct(root, F.col("s"))).alias("e")
    return estimate.groupBy("g").agg(best).select("g", "e.*")


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source") -> DataFrame:
    """Base rules and robust outliers over whole texts.

    Returns ``id_col``, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance (squared Mahalanobis distance, null
    if base_failed) and kept (false if base_failed or the distance is over the
    ``TAIL`` quantile). A null text is an empty one, which fails the base
    rules; a null language or source is an empty one; null ids stay null;
    repeated rows are judged each; other columns are not read; an empty table
    gives an empty result.
    """
    def named(column, name):
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)

    stats = text_statistics(df, text_col, [F.col(id_col).alias("id"), named(lang_col, "lang"), named(source_col, "source")])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = stored(stats.select("*", failed.alias("base_failed"), *vector()), "statistics")
    rows = stats.where("not base_failed")
    groups = stored(_groups(rows), "groups")
    wanted = stored(groups.select(F.col("own").alias("g")).distinct(), "wanted")
    xs = [f"x{i}" for i in range(P)]
    vectors = stored(rows.select("*", F.explode(F.array(*_levels())).alias("g")).join(wanted, "g", "left_semi")
                     .groupBy("g", *xs).agg(F.count("*").alias("w")), "vectors")
    estimate = stored(groups.join(mcd(vectors, counting_noise(rows)).withColumnRenamed("g", "own"), "own"), "estimates")
    judged = stats.join(estimate, ["lang", "source"], "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "distance", F.coalesce(~F.col("base_failed") & (F.col("distance") <= F.lit(LIMIT)), F.lit(False)).alias("kept"))
