"""Quality rules: robust multivariate outliers by minimum covariance determinant.

``text_stats`` computes word, symbol, repeated-line and repeated-word counts
inside each row.  ``reject_outliers`` fits a centre and a covariance for each
(language, source) with the regularised minimum-covariance-determinant method:
two deterministic robust starts, concentration steps that keep the closest
three fifths of the documents, and the start whose covariance has the
smaller determinant.  A document is rejected when its squared Mahalanobis
distance exceeds a chi-square quantile.

Scale: the text is read once; the fit works on a table of six integers per
document, written to the shared folder.  A concentration step is one
aggregation by (group, distance bucket) with map-side combining, so a source
that holds a third of all rows is never gathered in one task; quantiles come
from the buckets.  Moments are sums of integers, so a rerun gives the same
verdicts whatever the order of rows.  The estimates have one row per group and
are broadcast only after their number was counted.

Defined cases: a null text has no words and fails the base rule; null
languages or sources form groups of their own; groups under ``MIN_GROUP``
documents are pooled by language, then over all languages, and if even that
pool is smaller only the base rule judges it; repeated rows are judged alike;
an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyspark.llm.shared import GAP, let, own_name, words, written

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Base rule: fewer words, or a larger share (percent) of repeated words, fails.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Fit: share of each group kept by a concentration step, number of steps, smallest group.
KEPT_SHARE = 0.6
STEPS = 5
MIN_GROUP = 60
# Ridge of each transformed statistic, as a standard deviation: log words, log letters a word, and square
# roots of the symbol, repeated-line and repeated-word shares.  Most documents have none of the last three.
RIDGE = [0.30, 0.08, 0.08, 0.15, 0.15]
# Squared distance beyond which a document is rejected: chi-square, 5 degrees of freedom, upper tail 1e-8.
CUTOFF = 46.0
# Transformed statistics are kept as integers in this unit.
UNIT = 10_000
# Buckets of squared distance per doubling; the largest group still broadcast.
PER_OCTAVE = 8
# Bits of a packed (window hash, place); longer texts compare all their windows by whole hash.
PLACE_BITS = 20
MAX_BROADCAST_GROUPS = 20_000
P = len(RIDGE)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _repeated_words(w: Column) -> Column:
    """Words inside three-word windows that the word array ``w`` has more than once.

    Texts whose window hashes are all different have none.  Else windows whose hash shares its upper bits
    with another's are found in one sorted array of hash and place; only those are compared by the whole hash."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    low = (1 << PLACE_BITS) - 1
    upper = lambda x: F.shiftright(x, PLACE_BITS)
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def near(h: Column) -> Column:
        """Places of windows that may be repeated."""
        packed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))))
        twins = let(packed, lambda s: F.filter(s, lambda x, k: (upper(x) == upper(F.get(s, k + 1))) | (upper(x) == upper(F.get(s, k - 1)))))
        return (F.when(n > low, F.transform(h, lambda x, i: i.cast("long")))
                .otherwise(F.transform(twins, lambda x: x.bitwiseAND(F.lit(low)))))

    def count(s: Column) -> Column:
        """Words under the windows of ``s``, (hash, place) sorted, whose neighbour has the same hash."""
        same = F.transform(F.filter(s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | (x["h"] == F.get(s, k - 1)["h"])), lambda x: x["i"])
        steps = let(F.sort_array(same), lambda p: F.transform(
            p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(3).cast("long")), F.lit(3).cast("long"))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def exact(h: Column) -> Column:
        keyed = F.transform(near(h), lambda i: F.struct(window(i.cast("int")).alias("h"), i.alias("i")))
        return let(F.sort_array(keyed), count)

    hashes = F.transform(F.slice(w, 1, n), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(exact(h)))


def text_stats(text: Column) -> Column:
    """Struct of the five counts of a text (see ``STATS``).

    A word is a run without ASCII white space; a repeated word lies in a window
    of three words that the text has more than once; a duplicate line has a
    word and equals an earlier line."""
    with_word = lambda x: x.rlike(r"[^\x20\x09-\x0D]")
    n_dup = let(F.split(text, "\n"), lambda every: F.when(F.size(every) == F.size(F.array_distinct(every)), F.lit(0)).otherwise(
        let(F.filter(every, with_word), lambda x: F.size(x) - F.size(F.array_distinct(x)))))
    symbols = reduce(lambda a, b: a + b, [
        F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in "#*$%&|<>"])
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        n_dup.cast("long").alias("n_dup_lines"),
        _repeated_words(w).alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _vector() -> list[Column]:
    """Transformed statistics in ``UNIT``: logarithms of sizes, square roots of shares."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    x = [F.log(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.sqrt(F.col("n_symbols") / n),
         F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n)]
    return [F.round(c * UNIT).cast("long").alias(f"x{i}") for i, c in enumerate(x)]


def _bucket(value: Column) -> Column:
    """Logarithmic bucket of a squared distance."""
    return F.floor(F.log2(F.greatest(value, F.lit(1e-6))) * PER_OCTAVE).cast("int")


def _joined(rows: DataFrame, params: DataFrame, on: list[str], bounded: bool) -> DataFrame:
    return rows.join(F.broadcast(params) if bounded else params, on)


def _medians(rows: DataFrame, cols: dict[str, Column], step: int) -> DataFrame:
    """Median of each column by group, on a grid of ``step`` units, from counts of the grid cells."""
    cells = (rows.select("grp", F.explode(F.array(*[
        F.struct(F.lit(name).alias("dim"), F.floor(c / step).cast("long").alias("cell")) for name, c in cols.items()])).alias("e"))
        .groupBy("grp", "e.dim", "e.cell").count())
    w = W.partitionBy("grp", "dim")
    run = F.sum("count").over(w.orderBy("cell").rowsBetween(W.unboundedPreceding, 0))
    hit = (cells.withColumn("run", run).withColumn("all", F.sum("count").over(w))
           .filter(F.col("run") * 2 >= F.col("all")).groupBy("grp", "dim").agg(F.min("cell").alias("cell")))
    return hit.groupBy("grp").agg(*[
        F.max(F.when(F.col("dim") == name, F.col("cell") * step + step // 2)).alias(name) for name in cols])


def _distance2() -> str:
    """Squared Mahalanobis distance from the columns x*, mean m*, and Cholesky factor l*_* (forward substitution)."""
    z: list[str] = []
    for i in range(P):
        known = "".join(f" - l{i}_{j} * {z[j]}" for j in range(i))
        z.append(f"((x{i} / {UNIT} - m{i}{known}) / l{i}_{i})")
    return " + ".join(f"power({c}, 2)" for c in z)


def _estimates(moments: DataFrame, by: list[str], scale: float) -> DataFrame:
    """Mean, Cholesky factor and log determinant from integer moments; ``scale`` widens the covariance."""
    out = moments.selectExpr(*by, "cast(n AS DOUBLE) AS n", *[f"cast(s{i} AS DOUBLE) / {UNIT} / n AS m{i}" for i in range(P)],
                             *[f"q{i}_{j}" for i, j in PAIRS])
    for j in range(P):  # one column of the factor after the other
        cols = []
        for i in range(j, P):
            cov = f"(cast(q{i}_{j} AS DOUBLE) / {UNIT} / {UNIT} / n - m{i} * m{j}) * {scale!r}D"
            known = "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
            diagonal = f"(cast(q{j}_{j} AS DOUBLE) / {UNIT} / {UNIT} / n - m{j} * m{j}) * {scale!r}D + {RIDGE[j] ** 2!r}D" + "".join(
                f" - l{j}_{k} * l{j}_{k}" for k in range(j))
            root = f"sqrt(greatest({diagonal}, 1e-12D))"
            cols.append(f"{root} AS l{j}_{j}" if i == j else f"({cov}{known}) / {root} AS l{i}_{j}")
        out = out.selectExpr("*", *cols)
    logdet = " + ".join(f"2 * ln(l{i}_{i})" for i in range(P))
    return out.selectExpr(*by, *[f"m{i}" for i in range(P)], *[f"l{i}_{j}" for i, j in PAIRS], f"{logdet} AS logdet")


def _concentrate(scored: DataFrame, scale: float) -> DataFrame:
    """Estimates from the closest ``KEPT_SHARE`` of each (grp, start); whole buckets are taken."""
    whole = "cast({} AS DECIMAL(19,0))"
    cells = scored.groupBy("grp", "start", "bucket").agg(
        F.expr("count(1)").alias("n"), *[F.expr(f"sum(x{i})").alias(f"s{i}") for i in range(P)],
        *[F.expr(f"sum({whole.format(f'x{i}')} * {whole.format(f'x{j}')})").alias(f"q{i}_{j}") for i, j in PAIRS])
    near = cells.selectExpr("*", f"sum(n) OVER (PARTITION BY grp, start) * {KEPT_SHARE} AS wanted",
                            "sum(n) OVER (PARTITION BY grp, start ORDER BY bucket ROWS UNBOUNDED PRECEDING) - n AS before")
    sums = [f"s{i}" for i in range(P)] + [f"q{i}_{j}" for i, j in PAIRS]
    moments = near.filter("before < wanted").groupBy("grp", "start").agg(*[F.expr(f"sum({c})").alias(c) for c in ["n", *sums]])
    return _estimates(moments, ["grp", "start"], scale)


def _consistency(share: float) -> float:
    """Factor that makes the covariance of the closest ``share`` of normal vectors that of all of them."""
    def chi2_cdf(x: float, dof: int) -> float:
        """Chi-square distribution for odd degrees of freedom, from the error function."""
        out, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
        for k in range(1, dof - 1, 2):
            out, term = out - term, term * x / (k + 2)
        return out

    low, high = 0.0, 100.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, P) < share else (low, mid)
    return share / chi2_cdf(low, P + 2)


def fit(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Centre and covariance of each ``grp`` of ``rows`` (columns grp, x0..x4), and whether they may be broadcast."""
    bounded = rows.select("grp").distinct().count() <= MAX_BROADCAST_GROUPS
    dims = {f"c{i}": F.col(f"x{i}") for i in range(P)}
    centre = written(_medians(rows, dims, UNIT // 100), "mcd-median")
    near = _joined(rows, centre, ["grp"], bounded)
    spread = written(centre.join(_medians(near, {f"d{i}": F.abs(F.col(f"x{i}") - F.col(f"c{i}")) for i in range(P)},
                                          UNIT // 100), "grp"), "mcd-spread")
    z2 = [F.pow((F.col(f"x{i}") - F.col(f"c{i}")) / UNIT, 2) / (F.pow(F.col(f"d{i}") * 1.4826 / UNIT, 2) + RIDGE[i] ** 2)
          for i in range(P)]
    # Two starts: scaled Euclidean distance from the medians, and the largest scaled deviation.
    starts = F.array(F.struct(F.lit(0).alias("start"), _bucket(reduce(lambda a, b: a + b, z2)).alias("bucket")),
                     F.struct(F.lit(1).alias("start"), _bucket(F.greatest(*z2)).alias("bucket")))
    xs = [f"x{i}" for i in range(P)]
    scored = _joined(rows, spread, ["grp"], bounded).select("grp", *xs, F.explode(starts).alias("e")).select("grp", *xs, "e.*")
    scale = _consistency(KEPT_SHARE)
    params = written(_concentrate(scored, scale), "mcd-step")
    for _ in range(STEPS):
        scored = _joined(rows, params, ["grp"], bounded).withColumn("bucket", _bucket(F.expr(_distance2())))
        params = written(_concentrate(scored.select("grp", "start", "bucket", *xs), scale), "mcd-step")
    best = params.groupBy("grp").agg(F.min(F.struct("logdet", "start")).alias("b")).select("grp", "b.start")
    return written(params.join(best, ["grp", "start"]).drop("start", "logdet"), "mcd-fit"), bounded


def judge(stats: DataFrame) -> DataFrame:
    """Adds base_failed, distance2 (null where only the base rule judges) and kept to rows with lang, source and ``STATS``."""
    xs = _vector()
    keyed = stats.withColumn("base_failed", base_failed())
    sizes = keyed.filter(~F.col("base_failed")).groupBy("lang", "source").count()
    # Small (language, source) groups are pooled by language, small pools over all languages.
    by_lang = W.partitionBy("lang")
    small = F.col("count") < MIN_GROUP
    pools = (sizes.withColumn("pool", F.sum(F.when(small, F.col("count")).otherwise(0)).over(by_lang))
             .withColumn("grp", F.when(~small, F.to_json(F.struct(F.lit("s").alias("k"), "lang", "source")))
                         .when(F.col("pool") >= MIN_GROUP, F.to_json(F.struct(F.lit("l").alias("k"), "lang")))
                         .otherwise("rest")))
    pools = written(pools.select(F.col("lang").alias("p_lang"), F.col("source").alias("p_source"), "grp", "count"), "mcd-groups")
    few = pools.count() <= MAX_BROADCAST_GROUPS
    pooled = pools.groupBy("grp").agg(F.sum("count").alias("n"))
    usable = {r[0] for r in pooled.filter((F.col("grp") == "rest") & (F.col("n") >= MIN_GROUP)).collect()}
    on = F.col("lang").eqNullSafe(F.col("p_lang")) & F.col("source").eqNullSafe(F.col("p_source"))
    side = pools.select("p_lang", "p_source", "grp")
    grouped = keyed.join(F.broadcast(side) if few else side, on, "left").drop("p_lang", "p_source")
    grouped = grouped.withColumns({f"x{i}": c for i, c in enumerate(xs)})
    learn = F.col("grp").isNotNull() & ~F.col("base_failed")
    if "rest" not in usable:
        learn = learn & (F.col("grp") != "rest")
    params, bounded = fit(grouped.filter(learn).select("grp", *[f"x{i}" for i in range(P)]))
    out = grouped.join(F.broadcast(params) if bounded else params, ["grp"], "left")
    d2 = F.when(~F.col("base_failed"), F.expr(_distance2()))
    return (out.withColumn("distance2", d2)
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= CUTOFF))
            .drop("grp", *[f"x{i}" for i in range(P)], *[f"m{i}" for i in range(P)], *[f"l{i}_{j}" for i, j in PAIRS]))


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and distance2 of each row of ``docs`` (doc_id, text, lang, source)."""
    stats = docs.select("doc_id", "lang", "source", text_stats(F.coalesce(F.col("text"), F.lit(""))).alias("s"))
    stats = written(stats.select("doc_id", "lang", "source", "s.*"), "mcd-stats")
    return judge(stats).select("doc_id", *STATS, "base_failed", "kept", "distance2")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were.

    Verdicts depend only on (text, language, source): rows are matched to them by doc_id and the digest of
    the text, so repeated ids with different texts are judged apart."""
    key = own_name(docs, "mcd_key")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text", "lang", "source"))
    stats = keyed.select(F.col(key).alias("doc_key"), "lang", "source", text_stats(F.coalesce(F.col("text"), F.lit(""))).alias("s"))
    stats = written(stats.select("doc_key", "lang", "source", "s.*"), "mcd-stats")
    good = judge(stats).filter("kept").select(F.col("doc_key").alias(key)).distinct()
    return keyed.join(good, key, "left_semi").drop(key)
