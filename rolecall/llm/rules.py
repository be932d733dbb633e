"""Quality rules: base statistics of whole texts, and robust multivariate outliers.

The statistics vector is transformed towards a normal shape; per language and source, the
minimum covariance determinant (MCD) estimate gives its centre and spread: from several
starts, concentration steps recompute mean and covariance from the closest `share` of the
rows, until the determinant of the covariance stops falling; the smallest is kept. Rows
beyond a cut-off of the Mahalanobis distance are rejected. All of it is made of Spark
expressions and pre-aggregated groupings, so a group of any size is no single task.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolecall.llm.common import let, written

SPACE = r"\x20\x09-\x0D"
GROUP = ["lang", "source"]
# Spread below which a feature's deviation is no news, in units of the feature. Lines end at 1
# and repeats, by the base rule, at the root of 0.5: either's largest distance is about 100.
FLOORS = {"length": 0.5, "word": 0.1, "symbols": 0.03, "lines": 0.1, "repeats": 0.07, "upper": 0.05, "marks": 0.04}


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs at least twice."""

    def covered(places: Column) -> Column:
        steps = F.zip_with(
            places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def twins(ordered: Column) -> Column:
        n = F.size(ordered) - 1
        return F.flatten(
            F.zip_with(
                F.slice(ordered, F.lit(1), n), F.slice(ordered, F.lit(2), n),
                lambda a, b: F.when(a["gram"] == b["gram"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")),
            )
        )

    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("gram"), i.alias("at")
        ),
    )
    places = F.array_sort(F.array_distinct(let(F.array_sort(grams), twins)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(places, covered))


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the statistics of each text; NULL text has none of anything."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    word = rf"[^{SPACE}]+"

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(rf"[^{SPACE}]")))
    dup_lines = let(lines, lambda rows: F.size(rows) - F.size(F.array_distinct(rows)))
    rows = docs.select(
        F.col("doc_id"), F.col("lang").cast("string"), F.col("source").cast("string"),
        let(F.regexp_extract_all(text, F.lit(word), F.lit(0)), of_words).alias("w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit(r"[!?]")).cast("long").alias("n_marks"),
    )
    return rows.select("doc_id", *GROUP, "w.*", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_marks")


def features() -> dict[str, Column]:
    """The transformed statistics vector."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "length": F.log1p("n_words"),
        "word": F.log1p(F.col("word_chars") / words),
        "symbols": F.sqrt(F.col("n_symbols") / chars),
        "lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
        "upper": F.sqrt(F.col("n_upper") / chars),
        "marks": F.sqrt(F.col("n_marks") / chars),
    }


def chi_square(p: float, df: int) -> float:
    """Quantile by the Wilson-Hilferty approximation."""
    z = NormalDist().inv_cdf(p)
    return df * (1 - 2 / (9 * df) + z * (2 / (9 * df)) ** 0.5) ** 3


def _inverse(moments: DataFrame, names: list[str]) -> DataFrame:
    """Inverse of each row's covariance (columns c_i_j) as p_i_j, by its Cholesky factor, and
    the logarithm of its determinant. Other columns stay."""
    k = len(names)
    rows = moments

    def rest(i: int, j: int) -> str:
        return f"c_{j}_{i}" + "".join(f" - l_{i}_{m} * l_{j}_{m}" for m in range(j))

    for j in range(k):
        rows = rows.selectExpr("*", f"sqrt(greatest({rest(j, j)}, 1e-12D)) AS l_{j}_{j}")
        rows = rows.selectExpr("*", *[f"({rest(i, j)}) / l_{j}_{j} AS l_{i}_{j}" for i in range(j + 1, k)])
    for below in range(k):  # the factor's inverse, by diagonals
        diagonal = []
        for j in range(k - below):
            i = j + below
            total = ("0D" if below else "1D") + "".join(f" - l_{i}_{m} * v_{m}_{j}" for m in range(j, i))
            diagonal.append(f"({total}) / l_{i}_{i} AS v_{i}_{j}")
        rows = rows.selectExpr("*", *diagonal)
    inverse = [
        " + ".join(f"v_{m}_{i} * v_{m}_{j}" for m in range(j, k)) + f" AS p_{i}_{j}" for i in range(k) for j in range(i, k)
    ]
    determinant = " + ".join(f"2 * ln(l_{j}_{j})" for j in range(k)) + " AS logdet"
    kept = [f"`{c}`" for c in moments.columns if not c.startswith("c_")]
    return rows.selectExpr(*kept, determinant, *inverse)


def _distance(names: list[str]) -> Column:
    terms = []
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            terms.append(f"{1 if i == j else 2} * p_{i}_{j} * ({a} - m_{i}) * ({names[j]} - m_{j})")
    return F.expr(" + ".join(terms))


def mcd_estimates(
    vectors: DataFrame, names: list[str], floors: list[float], share: float = 0.75, tolerance: float = 1e-6,
    accuracy: int = 5_000,
) -> DataFrame:
    """Minimum covariance determinant of the vector `names` in each `pool` of `vectors`.

    Returns pool, n (its rows), centre m_i, precision p_i_j and logdet, the logarithm of the
    determinant before scaling. Three starts, all around the medians: deviations alone, the
    correlations of squashed deviations, and those of directions. Each takes two concentration
    steps (mean and covariance of the closest `share`); the start with the smallest determinant
    goes on until its determinant stops falling, and the smallest one is kept.

    The squared floors are added to the variances, so that a feature that hardly varies cannot
    reject by itself, and a pool of any size has an estimate. The covariance is scaled so that
    the median distance is that of a normal distribution. Distances are cut at a rank that is
    exact up to `accuracy` rows of a pool, and off by one in `accuracy` beyond.
    """
    k = len(names)
    both = [(i, j) for i in range(k) for j in range(i, k)]
    centre = [f"m_{i}" for i in range(k)]
    precision = [f"p_{i}_{j}" for i, j in both]

    def middle(expression: str, name: str, of: float = 0.5) -> str:
        return f"percentile_approx({expression}, {of}, {accuracy}) AS {name}"

    def per(rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.expr(c) for c in columns])

    def widened(i: int, j: int, variance: str) -> str:
        return f"{variance} + {floors[i] ** 2}D AS c_{i}_{j}" if i == j else f"{variance} AS c_{i}_{j}"

    def concentrate(estimates: DataFrame) -> DataFrame:
        keys = ["pool", "start"]
        near = vectors.join(estimates, "pool").select(*keys, "n", *names, _distance(names).alias("d2"))
        close = near.join(per(near, keys, middle("d2", "limit", share)), keys).filter("d2 <= limit")
        sums = per(
            close, keys, "first(n) AS n", *[f"avg({a}) AS m_{i}" for i, a in enumerate(names)],
            *[f"covar_pop({names[i]}, {names[j]}) AS c_{i}_{j}" for i, j in both],
        )
        moments = sums.selectExpr(*keys, "n", *centre, *[widened(i, j, f"c_{i}_{j}") for i, j in both])
        return written(_inverse(moments, names))

    median = per(vectors, ["pool"], "count(*) AS n", *[middle(a, f"m_{i}") for i, a in enumerate(names)])
    spread = per(
        vectors.join(median, "pool"), ["pool"], "first(n) AS n", *[f"first({m}) AS {m}" for m in centre],
        *["1.4826D * " + middle(f"abs({a} - m_{i})", f"s_{i}") for i, a in enumerate(names)],
    )
    spread = written(spread)
    scaled = [f"({a} - m_{i}) / sqrt(s_{i} * s_{i} + {floors[i] ** 2}D) AS z_{i}" for i, a in enumerate(names)]
    z = vectors.join(spread, "pool").selectExpr("pool", *scaled)
    z = z.selectExpr("*", "sqrt(" + " + ".join(f"z_{i} * z_{i}" for i in range(k)) + ") AS far")
    size = "greatest(far, 1e-9D)"
    likeness = per(
        z, ["pool"], *[f"covar_pop(tanh(z_{i}), tanh(z_{j})) AS a_{i}_{j}" for i, j in both],
        *[f"avg(z_{i} * z_{j} / ({size} * {size})) AS b_{i}_{j}" for i, j in both],
    )

    def start(name: str, of: str) -> DataFrame:
        def correlation(i: int, j: int) -> str:  # none with a feature that does not vary
            return f"coalesce({of}_{i}_{j} / nullif(sqrt({of}_{i}_{i} * {of}_{j}_{j}), 0D), 0D)" if of else "0D"

        cells = [widened(i, j, f"s_{i} * s_{j}" + ("" if i == j else f" * {correlation(i, j)}")) for i, j in both]
        return known.selectExpr("pool", f"'{name}' AS start", "n", *centre, *cells)

    known = written(spread.join(likeness, "pool"))
    starts = start("alone", "").unionByName(start("squashed", "a")).unionByName(start("directions", "b"))
    tried = concentrate(concentrate(written(_inverse(starts, names))))
    columns = ["pool", "start", "n", *centre, "logdet", *precision]
    smallest = Window.partitionBy("pool").orderBy("logdet", "start")
    best = tried.withColumn("_place", F.row_number().over(smallest)).filter("_place = 1").select(*columns)
    best = written(best.withColumn("falls", F.lit(True)))
    # Every further step lowers a determinant that the floors bound from below.
    while not best.filter("falls").isEmpty():
        after = concentrate(best.filter("falls").drop("falls", "logdet")).withColumn("_after", F.struct(*columns))
        joined = best.join(after.select("pool", "_after"), "pool", "left")
        lower = F.coalesce(F.col("_after.logdet") < F.col("logdet") - tolerance, F.lit(False))
        kept = [F.when(lower, F.col(f"_after.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
        best = written(joined.select(*kept, lower.alias("falls")))
    near = vectors.join(best, "pool").select("pool", _distance(names).alias("d2"))
    usual = chi_square(0.5, k)
    found = best.join(per(near, ["pool"], middle("d2", "usual")), "pool")
    scale = f"greatest(usual / {usual}D, 1D)"
    return found.selectExpr("pool", "n", "logdet", *centre, *[f"{p} / {scale} AS {p}" for p in precision])


def _pool(*parts: str) -> str:
    """Name of a pool; a NULL language or source is left out of it, unlike any text."""
    fields = ", ".join(f"'{p}', {p}" for p in parts)
    return f"concat('{len(parts)}', to_json(named_struct({fields})))" if parts else "'0'"


def _with_pools(sound: DataFrame, least_rows: int) -> DataFrame:
    """lang, source, `pool` by which the group is judged, and `pools` that its rows are in.

    A group of `least_rows` rows is its own pool. A smaller one is judged by all rows of its
    language, or of the table where these are too few as well.
    """
    groups = written(sound.groupBy(*GROUP).agg(F.count("*").alias("n")))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least")).select(
        F.col("lang").alias("_lang"), "n_lang", "least"
    )
    rows = groups.join(langs, F.col("lang").eqNullSafe(F.col("_lang")))
    small, few = f"n < {least_rows}", f"n_lang < {least_rows}"
    rows = written(rows.selectExpr(
        *GROUP,
        f"CASE WHEN NOT {small} THEN {_pool(*GROUP)} WHEN NOT {few} THEN {_pool('lang')} ELSE {_pool()} END AS pool",
        f"least < {least_rows} AND NOT {few} AS shared",
    ))
    needs_all = not rows.filter(F.col("pool") == F.expr(_pool())).isEmpty()
    members = f"array(pool, IF(shared, {_pool('lang')}, pool){', ' + _pool() if needs_all else ''})"
    return rows.selectExpr(*GROUP, "pool", f"array_distinct({members}) AS pools")


def quality_rules(docs: DataFrame, level: float = 1 - 1e-7, least_rows: int = 20) -> DataFrame:
    """Statistics and verdict for every row of `docs` (doc_id, text, lang, source).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, distance (squared Mahalanobis). Rows that fail the base rules take no part in
    the estimates. A language and source with fewer than `least_rows` other rows is judged by
    all rows of the language, or of the table where these are too few, too; where every row
    of a group fails the base rules, `distance` is NULL. NULL text counts as empty (and fails
    the base rules); NULL languages and sources are groups of their own; repeated rows stay;
    no rows give none. Other columns are not read.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    vector = features()
    names = list(vector)
    rows = text_statistics(docs).withColumn("base_failed", failed).withColumns(vector)
    rows = written(rows)
    sound = rows.filter("NOT base_failed").select(*GROUP, *names)
    pools = written(_with_pools(sound, least_rows).selectExpr("lang AS _lang", "source AS _source", "pool", "pools"))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    vectors = written(sound.join(pools, same).select(F.explode("pools").alias("pool"), *names))
    estimates = mcd_estimates(vectors, names, [FLOORS[n] for n in names])
    # Few small rows: one per language and source.
    judged = written(pools.join(estimates, "pool").drop("pools"))
    near = rows.join(judged, same, "left").withColumn("distance", _distance(names))
    cutoff = chi_square(level, len(names))
    return near.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"),
        "distance",
    )
