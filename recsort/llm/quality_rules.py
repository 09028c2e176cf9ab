"""Quality rules: base limits plus robust multivariate outliers (native).

Each text gets five statistics; texts that pass the base limits are judged
against the minimum-covariance-determinant (MCD) estimate of their language
and source: the location and scatter of the ``SUPPORT`` share of rows with the
smallest scatter determinant, found by concentration steps from two robust
starts, reweighted once, and the squared Mahalanobis distance of the
transformed statistics decides.

A concentration step is one pass of partial sums: rows are counted by (group,
start, distance bin) together with the sums of the statistics and their
products, and the bins up to the support share give the next estimate. No
group is ever collected, a source with a third of all rows costs a few hundred
partial rows a task, and the estimates (one row per group) come to the rows.

The scatter is scaled by the usual consistency factors (median distance of the
support, then truncation of the reweighted rows) and cut at a quantile of the
chi-square distribution. It is drawn towards a wide prior with the weight of
``PRIOR_ROWS`` rows, which counts in small groups only, and no statistic's own
spread is taken below its floor, since a statistic that is 0 in nearly all texts
has none.

Defined results:

* null text has no words and fails the base limits; null lang or source is a
  group of its own;
* a source with fewer than ``MIN_GROUP`` base-passing rows in a language is
  judged by the estimate of its whole language, a language with fewer by that of
  all rows; every row gets a verdict;
* rows are judged by themselves: ties and repeated rows get equal verdicts;
* very long texts are one row like any other; an empty table gives an empty
  table; input columns (or those of ``keep``) are in ``row``, so that they cannot
  clash.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsort.llm.common import packed, staged

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50  # per cent of the words

DIM = 5
SUPPORT = 0.75       # share of a group's rows in the concentration steps
STEPS = 6
MIN_GROUP = 100
BINS = 8             # distance bins per doubling
# Quantiles of the chi-square distribution with 5 degrees of freedom.
CHI2_MEDIAN = 4.351460
CHI2_975 = 12.832502
CUTOFF = 35.888      # one in 1,000,000
TRUNCATED = 1.0555   # 0.975 over the chi-square probability of CHI2_975 with 7 degrees of freedom
# Least standard deviations of the statistics, and those of the prior.
FLOORS = (0.3, 0.06, 0.4, 0.06, 0.08)
PRIOR = (1.5, 0.3, 1.5, 0.15, 0.2)
PRIOR_ROWS = 20
BROADCAST_BYTES = 8 << 20


def statistics(text: Column) -> list[tuple[str, Column]]:
    """The steps that give the base statistics, each naming columns of the ones before."""
    t = F.coalesce(text, F.lit(""))
    without = functools.reduce(lambda c, x: F.replace(c, F.lit(x), F.lit("")), SYMBOLS, F.col("text_"))  # faster than one translate
    word = lambda i: F.get(F.col("words"), i)
    return [
        ("text_", t),
        ("words", F.array_remove(F.split("text_", SPACE, -1), "")),
        ("n_words", F.size("words").cast("long")),
        ("word_chars", F.length(F.array_join("words", "")).cast("long")),
        ("n_symbols", (F.length("text_") - F.length(without)).cast("long")),
        ("lines", F.filter(F.split("text_", "\n", -1), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")),
        ("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")),
        ("hashes", F.when(F.size("words") < 4, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2))))),
        # For texts with a repeat: hashes of the 3-word windows with their places, sorted, so that equal ones stand together.
        ("grams", F.when(F.size("hashes") == F.size(F.array_distinct("hashes")), F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(
            F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))),
        # First words of the windows found twice or more, ascending.
        ("again", F.array_sort(F.transform(F.filter("grams", lambda g, k:
            (g["h"] == F.get(F.col("grams"), k - 1)["h"]) | (g["h"] == F.get(F.col("grams"), k + 1)["h"])), lambda g: g["i"]))),
        # Each window adds the words that the window before it did not reach.
        ("n_repeat_words", F.aggregate(F.transform("again", lambda i, k: F.when(k == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), i - F.get(F.col("again"), k - 1)))), F.lit(0), lambda a, b: a + b).cast("long")),
    ]


def with_statistics(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    keep = rows.columns
    for name, c in statistics(text):
        rows = rows.withColumn(name, c)
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") \
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))


def vector() -> list[Column]:
    """The transformed statistics x0..x4, each near a symmetric scale."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log(n).alias("x0"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n).alias("x1"),
        F.log1p(1000 * F.col("n_symbols") / n).alias("x2"),
        F.sqrt(F.col("n_dup_lines") / n).alias("x3"),
        F.sqrt(F.col("n_repeat_words") / n).alias("x4"),
    ]


X = [f"x{i}" for i in range(DIM)]
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]
GROUP = ["g"]


def _moments() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}{j}") for i, j in PAIRS]]


def _add_moments() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", *[f"s{i}" for i in range(DIM)], *[f"s{i}{j}" for i, j in PAIRS])]


def _estimate(m: DataFrame, keys: list[str], scale: float = 1.0) -> DataFrame:
    """Location m0.. and lower Cholesky factor l00.. of the scatter, from summed moments."""
    n = F.col("n")
    cov = lambda i, j: scale * (F.col(f"s{i}{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / n / n)
    prior = lambda i, j: PRIOR[i] ** 2 if i == j else 0.0
    m = m.select(*keys, "n", *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(DIM)],
                 *[((n * cov(i, j) + PRIOR_ROWS * prior(i, j)) / (n + PRIOR_ROWS)).alias(f"c{i}{j}") for i, j in PAIRS])
    return _cholesky(m, keys)


def _cholesky(m: DataFrame, keys: list[str]) -> DataFrame:
    for i, j in PAIRS:
        c = F.col(f"c{i}{j}")
        for k in range(j):
            c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # What a statistic varies by itself, the ones before it given, is never below its floor.
        m = m.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(FLOORS[i] ** 2))) if i == j else c / F.col(f"l{j}{j}"))
    logdet = sum((F.log(f"l{i}{i}") for i in range(DIM)), F.lit(0.0))
    return m.select(*keys, "n", *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i, j in PAIRS], logdet.alias("logdet"))


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for i in range(DIM):
        c = F.col(X[i]) - F.col(f"m{i}")
        for k in range(i):
            c = c - F.col(f"l{i}{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{i}", c / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(DIM)), F.lit(0.0)))


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(F.greatest(d2, F.lit(2.0 ** -10))) * BINS).cast("int")


def _upto(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Summed moments of the nearest bins that hold at least ``share`` of each group's rows."""
    w = Window.partitionBy(*keys)
    run = w.orderBy("bin")
    return (binned.withColumn("before", F.sum("n").over(run) - F.col("n")).withColumn("all", F.sum("n").over(w))
            .filter(F.col("before") < share * F.col("all")).groupBy(*keys).agg(*_add_moments()))


def fit_mcd(rows: DataFrame, hint=lambda d: d) -> DataFrame:
    """Per group ``g``: location m0.. and Cholesky factor l00.., of ``rows`` with g and x0..x4.

    ``hint`` is put on tables of one or two rows a group before they are joined.
    Starts: the classical scatter, and that of the rows nearest to the
    coordinatewise medians; the start with the smaller determinant wins.
    """
    classical = _estimate(rows.groupBy(*GROUP).agg(*_moments()), GROUP).withColumn("start", F.lit(0))
    med = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, x in enumerate(X)])
    zero = lambda i, j: ((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 if i == j else F.lit(0.0)
    median = _cholesky(med.select(*GROUP, "n", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIM)],
                                  *[zero(i, j).alias(f"c{i}{j}") for i, j in PAIRS]), GROUP).withColumn("start", F.lit(1))
    params = classical.unionByName(median).checkpoint()
    for _ in range(STEPS):
        # Cut here, so that bins are added up by (group, start, bin) and only whole bins meet by group.
        binned = (_distance(_with_params(rows, params, hint)).withColumn("bin", _bin(F.col("d2")))
                  .groupBy(*GROUP, "start", "bin").agg(*_moments())).checkpoint()
        params = _estimate(_upto(binned, [*GROUP, "start"], SUPPORT), [*GROUP, "start"])
    best = params.groupBy(*GROUP).agg(F.min_by(F.struct(*[c for c in params.columns if c not in GROUP]), F.struct("logdet", "start")).alias("p")) \
        .select(*GROUP, "p.*").checkpoint()
    # Reweighting: the median distance sets the scale, rows within the 97.5 % ellipsoid give the final estimate.
    d = _distance(_with_params(rows, best, hint)).withColumn("bin", _bin(F.col("d2"))).groupBy(*GROUP, "bin").agg(*_moments())
    d = d.checkpoint()
    return _reweighted(d).checkpoint()


def _reweighted(binned: DataFrame) -> DataFrame:
    w = Window.partitionBy(*GROUP)
    half = (binned.withColumn("before", F.sum("n").over(w.orderBy("bin")) - F.col("n")).withColumn("all", F.sum("n").over(w))
            .withColumn("mid", F.max(F.when(F.col("before") < 0.5 * F.col("all"), F.col("bin"))).over(w)))
    factor = F.greatest(F.pow(F.lit(2.0), (F.col("mid") + 1) / BINS) / CHI2_MEDIAN, F.lit(1.0))
    near = half.filter(F.pow(F.lit(2.0), F.col("bin") / BINS) <= CHI2_975 * factor)
    return _estimate(near.groupBy(*GROUP).agg(*_add_moments()), GROUP, TRUNCATED)


def _with_params(rows: DataFrame, params: DataFrame, hint) -> DataFrame:
    return rows.join(hint(params.drop("n", "logdet")), GROUP)


def _groups(fit: DataFrame) -> DataFrame:
    """Per ``own`` (language and source): ``fits``, the groups whose estimate its rows enter, and ``g``, the one that judges them."""
    sizes = fit.groupBy("lang_", "own").agg(F.count(F.lit(1)).alias("size")).checkpoint()
    langs = sizes.groupBy("lang_").agg(F.sum("size").alias("lang_size"), (F.min("size") < MIN_GROUP).alias("small"))
    all_ = langs.agg(F.coalesce(F.bool_or(F.col("small") & (F.col("lang_size") < MIN_GROUP)), F.lit(False)).alias("all_small"))
    d = sizes.join(langs, "lang_").crossJoin(F.broadcast(all_))  # one row
    own, lang, every = F.concat(F.lit("o"), "own"), F.concat(F.lit("l"), "lang_"), F.lit("a")
    big, lang_big = F.col("size") >= MIN_GROUP, F.col("lang_size") >= MIN_GROUP
    fits = F.array_compact(F.array(F.when(big, own), F.when(F.col("small") & lang_big, lang), F.when(F.col("all_small"), every)))
    return d.select("own", fits.alias("fits"), F.when(big, own).when(lang_big, lang).otherwise(every).alias("g")).checkpoint()


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """``row`` (all input columns, or those of ``keep``), the base statistics, base_failed, distance and kept, for every row."""
    named = lambda c: F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("?"))
    src = packed(docs, lang_=named(lang_col), source_=named(source_col), text=text_col)
    if keep is not None:
        src = src.withColumn("row", F.struct(*[F.col(f"row.`{c}`").alias(c) for c in keep]))
    rows = staged(with_statistics(src, F.col("text")).drop("text"), "quality-stats").withColumn("own", F.concat_ws("\x1f", "lang_", "source_"))
    fit = rows.filter("NOT base_failed").select("lang_", "own", *vector())
    groups = _groups(fit)
    # Tables of one or two rows a group, some 30 numbers and the names, are broadcast if all of them are within the bound.
    n, names = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("own")), F.lit(0))).first()
    hint = F.broadcast if 2 * (n * 400 + 4 * names) <= BROADCAST_BYTES else lambda d: d
    params = fit_mcd(staged(fit.join(hint(groups.select("own", "fits")), "own").select(F.explode("fits").alias("g"), *X), "quality-vectors"), hint)
    by_source = groups.select("own", "g").join(params, "g").select("own", *[f"m{i}" for i in range(DIM)], *[f"l{i}{j}" for i, j in PAIRS]).checkpoint()
    out = _distance(rows.select("*", *vector()).join(hint(by_source), "own", "left"))
    kept = ~F.col("base_failed") & (F.col("d2").isNull() | (F.col("d2") <= CUTOFF))
    return out.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.col("d2").alias("distance"), kept.alias("kept"))
