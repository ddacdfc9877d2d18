"""Quality rules: robust multivariate outliers per language and source.

Base rules reject short and self-repeating texts.  The other documents have a
vector of transformed statistics (``FEATURES``); for every (lang, source) the
minimum-covariance-determinant estimate of its centre and scatter is fitted, and
a document whose squared Mahalanobis distance exceeds the chi-square quantile of
``1 - TAIL`` is rejected.

The estimate is the one of least determinant among ``STARTS`` runs, which begin
with the core nearest to the medians in units of the median deviations, nearest
to the means in units of the deviations, and nearest to the medians in length
and word length alone.  Concentration steps (estimate from the core, core of the
``CORE`` nearest) are made with every start; after ``TRIAL`` estimates the start of
least determinant goes on alone until no log determinant moves by more than
``TOLERANCE``, ``STEPS`` times at most.

Everything is DataFrame expressions and aggregates.  Texts are read once and
not shuffled; only the statistics (a few numbers per document) are stored and
aggregated, every step with map-side partial aggregates, so a hot source is
combined before any shuffle.  Order statistics are approximate percentiles of
fixed accuracy.  The fitted table has one row per (lang, source).

Every (lang, source) has its own estimate, of any size.  In each step its moments
are mixed with those of its language with weight ``n^2 / (n^2 + PRIOR^2)`` for its
n usable documents (``PRIOR``: five a statistic), and a language's likewise with
those of the corpus.  Mixed moments include the distance of the two centres, so a
small source of its own shape widens its estimate instead of being rejected.
``FLOOR`` bounds the standard deviations from below, so that a statistic that
is constant in most of a group does not reject every other value: its square is
added to the variance (a ridge), which for such a statistic is the floor itself.
A repeated line raises two statistics at once; ``REPEAT`` adds the covariance of
that, so that one such line passes by itself.

Defined cases: null and empty texts have no words and fail the base rules; a
null language or source is a value of its own; repeated rows count each time;
an empty table gives an empty result; a document without a fitted estimate
(none of its corpus is usable) is kept unless the base rules reject it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

MIN_WORDS = 50
#: share of the usable documents that the estimate is fitted on
CORE = 0.75
STARTS, TRIAL, STEPS, TOLERANCE = 3, 2, 6, 1e-3
SALTS = 32
TAIL = 1e-4
#: log words, log word length, root of symbols, repeated lines, repeated words per word
FEATURES = 5
#: documents at which a group's own moments and its parent's weigh the same
PRIOR = 5 * FEATURES
#: least deviations: most texts have no symbol and no repeat
FLOOR = (0.2, 0.03, 0.08, 0.025, 0.075)
#: a quarter of what one line of 8 words, found twice in MIN_WORDS words, adds to each
#: statistic (both copies count as repeated words): alone it is about 13 away, not 80
REPEAT = (0.0, 0.0, 0.0, 0.25 * math.sqrt(1 / MIN_WORDS), 0.25 * math.sqrt(16 / MIN_WORDS))
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_ALL = "corpus"
_SPACE = r"[\x20\x09-\x0D]+"


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma P(k/2, x/2), by its series."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x else 0.0


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def with_statistics(docs: DataFrame, carry: list[str], text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source") -> DataFrame:
    """(doc, lang, source, the BASE statistics, base_failed): ``doc`` is a
    struct of the ``carry`` columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("doc"),
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
        F.filter(F.split(text, _SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    zero = F.lit(0).cast("long")
    n = F.size("words")
    grams = F.transform(
        F.slice(F.arrays_zip("words", F.slice("words", 2, n), F.slice("words", 3, n)), F.lit(1), n - 2),
        lambda w, i: F.struct(F.xxhash64(w).alias("h"), i.alias("i")))
    sorted_grams = first.select(
        "doc", "lang", "source", n.cast("long").alias("n_words"),
        F.aggregate("words", zero, lambda a, w: a + F.length(w)).alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n > 3, F.sort_array(grams)).alias("grams"))
    # neighbours with equal hashes are windows found twice; their first words
    twice = F.filter(F.zip_with("grams", F.slice("grams", F.lit(2), F.size("grams")),
                                lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
                     lambda p: p.isNotNull())
    starts = F.sort_array(F.array_distinct(F.flatten(twice)))
    nothing = F.struct(F.lit(-3).alias("last"), zero.alias("n"))
    covered = F.aggregate(starts, nothing, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
    return (sorted_grams.withColumn("n_repeat_words", F.coalesce(covered, zero)).drop("grams")
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def features() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p("n_words"), F.log1p(F.col("word_chars") / n), F.sqrt(F.col("n_symbols") / n),
            F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n)]


def _distance(params: str = "p") -> Column:
    """Squared Mahalanobis distance from the centre and the inverse scatter."""
    z = [F.col(f"x{i}") - F.get(F.col(f"{params}.centre"), F.lit(i)) for i in range(FEATURES)]
    cell = lambda i, j: F.get(F.col(f"{params}.inverse"), F.lit(i * FEATURES + j))
    return sum((cell(i, j) * z[i] * z[j] * (1 if i == j else 2) for i in range(FEATURES) for j in range(i + 1)), F.lit(0.0))


def _inverted(matrix: Column) -> Column:
    """(inverse, log determinant) of a positive definite matrix, given and returned
    row by row: every pivot is swept out in turn."""

    def sweep(state: Column, k: Column) -> Column:
        a = state["inverse"]
        pivot = F.greatest(F.get(a, k * FEATURES + k), F.get(F.array(*[F.lit(f ** 2 / 100) for f in FLOOR]), k))

        def cell(v: Column, at: Column) -> Column:
            i, j = F.floor(at / FEATURES).cast("int"), at % FEATURES
            return (F.when((i == k) & (j == k), 1 / pivot).when(i == k, v / pivot).when(j == k, -v / pivot)
                    .otherwise(v - F.get(a, i * FEATURES + k) * F.get(a, k * FEATURES + j) / pivot))

        return F.struct(F.transform(a, cell).alias("inverse"), (state["logdet"] + F.log(pivot)).alias("logdet"))

    start = F.struct(matrix.alias("inverse"), F.lit(0.0).alias("logdet"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(FEATURES - 1)), start, sweep)


def _estimates(moments: DataFrame) -> DataFrame:
    """(g, start, p): centre, inverse scatter and log determinant from the moments."""
    q = chi2_quantile(CORE, FEATURES)
    consistent = CORE / chi2_cdf(q, FEATURES + 2)  # the core's scatter is too small by this factor

    def scatter(i: int, j: int) -> Column:
        c = (F.col(f"s{max(i, j)}{min(i, j)}") - F.col(f"m{i}") * F.col(f"m{j}")) * consistent + REPEAT[i] * REPEAT[j]
        return F.greatest(c, F.lit(0.0)) + FLOOR[i] ** 2 if i == j else c

    cells = F.array(*[scatter(i, j) for i in range(FEATURES) for j in range(FEATURES)])
    centre = F.array(*[F.col(f"m{i}") for i in range(FEATURES)])
    rows = moments.select("g", "start", centre.alias("centre"), _inverted(cells).alias("s"))
    return rows.select("g", "start", F.struct("centre", "s.inverse", "s.logdet").alias("p"))


def _mixed(moments: DataFrame, tree: DataFrame) -> DataFrame:
    """Moments of all groups, each mixed with its parent's from the corpus down."""
    names = [c for c in moments.columns if c not in ("g", "start")]
    above = moments.filter(F.col("g") == _ALL)
    out = above
    weight = F.col("n") * F.col("n") / (F.col("n") * F.col("n") + float(PRIOR ** 2))
    for level in (1, 2):
        upper = above.select(F.col("g").alias("parent"), "start", *[F.col(c).alias(f"up_{c}") for c in names])
        above = (moments.join(tree.filter(F.col("level") == level), "g").join(upper, ["parent", "start"]).withColumn("w", weight)
                 .select("g", "start", *[(F.col("w") * F.col(c) + (1 - F.col("w")) * F.col(f"up_{c}")).alias(c) for c in names]))
        out = out.unionByName(above)
    return out


def fit(statistics: DataFrame) -> DataFrame:
    """Estimates (lang, source, p) by minimum covariance determinant.

    ``statistics``: rows of ``with_statistics``.  One row per (lang, source).
    """
    x = [f"x{i}" for i in range(FEATURES)]
    usable = statistics.filter(~F.col("base_failed")).select(
        "lang", "source", *[f.alias(c) for f, c in zip(features(), x)])
    # a row counts for its source, its language and the corpus
    language = F.concat(F.lit("lang "), F.to_json(F.struct("lang")))
    group = F.concat(F.lit("source "), F.to_json(F.struct("lang", "source")))
    members = stored(statistics.filter(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n")).select(
        "lang", "source", group.alias("g"), language.alias("parent"), "n"), "mcd-groups")
    tree = members.select("g", "parent", "n", F.lit(2).alias("level")).union(
        members.groupBy(F.col("parent").alias("g")).agg(F.sum("n").alias("n")).select(
            "g", F.lit(_ALL).alias("parent"), "n", F.lit(1).alias("level")))
    tree = stored(tree, "mcd-tree")
    rows = stored(usable.select(
        F.explode(F.array(group, language, F.lit(_ALL))).alias("g"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"), *x), "mcd-rows")

    def by_group(values: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
        """``values`` with their group's rows of ``table``: a hot group's rows are
        met in SALTS places, and summed in part before they move again."""
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        return values.join(table.withColumn("salt", salts), [*on, "salt"])

    # starts: medians and median deviations, means and deviations
    centres = rows.groupBy("g").agg(
        F.struct(*[F.percentile_approx(c, 0.5).alias(c) for c in x]).alias("median"),
        F.struct(*[F.avg(c).alias(c) for c in x]).alias("mean"), F.struct(*[F.stddev_pop(c).alias(c) for c in x]).alias("sd"))
    apart = by_group(rows, stored(centres, "mcd-centres"), ["g"])
    spread = apart.groupBy("g").agg(*[F.first(c).alias(c) for c in ("median", "mean", "sd")], F.struct(
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"median.{c}")), 0.5).alias(c) for c in x]).alias("mad"))
    apart = by_group(rows, stored(spread, "mcd-spread"), ["g"])
    robust = [((F.col(c) - F.col(f"median.{c}")) / F.greatest(1.4826 * F.col(f"mad.{c}"), F.lit(f))) ** 2 for c, f in zip(x, FLOOR)]
    plain = [((F.col(c) - F.col(f"mean.{c}")) / F.greatest(f"sd.{c}", F.lit(f))) ** 2 for c, f in zip(x, FLOOR)]
    starts = [sum(robust, F.lit(0.0)), sum(plain, F.lit(0.0)), sum(robust[:2], F.lit(0.0))]
    ranked = apart.select("g", "salt", *x, F.posexplode(F.array(*starts)).alias("start", "d2"))
    before = None
    for step in range(1, STEPS + 2):
        cut = ranked.groupBy("g", "start").agg(F.percentile_approx("d2", CORE, 10000).alias("cut"))
        core = by_group(ranked, cut, ["g", "start"]).filter(F.col("d2") <= F.col("cut"))
        moments = core.groupBy("g", "start").agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
            *[F.avg(F.col(x[i]) * F.col(x[j])).alias(f"s{i}{j}") for i in range(FEATURES) for j in range(i + 1)])
        params = stored(_estimates(_mixed(stored(moments, "mcd-moments"), tree)), "mcd-params")
        if before is not None:
            was = before.select("g", "start", F.col("p.logdet").alias("was"))
            moved = params.join(was, ["g", "start"]).agg(F.max(F.abs(F.col("p.logdet") - F.col("was")))).first()[0]
            if moved is None or moved <= TOLERANCE:
                break
        if step == TRIAL:
            # one start each from here on, by one name: groups and their parents are mixed by it
            least = params.groupBy("g").agg(F.min_by("p", F.struct("p.logdet", "start")).alias("p"))
            params = stored(least.select("g", F.lit(0).alias("start"), "p"), "mcd-best")
        before = params
        ranked = by_group(rows, params, ["g"]).withColumn("d2", _distance())
    return members.join(params, "g").select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "p")


def judge(statistics: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``distance`` (squared Mahalanobis) and ``kept``."""
    limit = chi2_quantile(1 - TAIL, FEATURES)
    rows = statistics.withColumns({f"x{i}": f for i, f in enumerate(features())})
    rows = rows.join(estimates, rows["lang"].eqNullSafe(estimates["_lang"])
                     & rows["source"].eqNullSafe(estimates["_source"]), "left")
    return (rows.withColumn("distance", _distance())
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit))
            .drop("p", "_lang", "_source", *[f"x{i}" for i in range(FEATURES)]))


def quality(docs: DataFrame, id_col: str = "doc_id", **cols: str) -> DataFrame:
    """One row per input row: doc_id, the BASE statistics, base_failed, distance, kept."""
    s = stored(with_statistics(docs, [id_col], **cols), "statistics")
    return judge(s, fit(s)).select(F.col("doc")[id_col].alias("doc_id"), *BASE, "base_failed", "distance", "kept")


def keep(docs: DataFrame, **cols: str) -> DataFrame:
    """The documents that pass, with all their columns.

    Documents and statistics are stored together once: the fit reads the
    statistics only, and nothing is computed twice or shuffled with its text.
    """
    s = stored(with_statistics(docs, docs.columns, **cols), "statistics")
    return judge(s, fit(s.drop("doc"))).filter("kept").select("doc.*")
