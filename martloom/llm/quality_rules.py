"""Quality rules whose cutoffs are chosen under a guaranteed rate of false rejection.

Every document gets a few rates (symbols, repeated lines, repeated words, capitals) from its whole
text, in built-in functions only. Each rule rejects a document whose rate is above a cutoff. Which
cutoff holds in which stratum is learned from labelled documents:

* How many rules a stratum tests follows from its number ``n`` of good labelled documents alone: the first
  ``m`` of ``RATES``, with the largest ``m`` for which a cutoff without a false rejection would be certified.
  ``risk`` is the allowed share for all rules together, divided evenly among the ``m`` (with the default
  risk and four strata, one rule takes 108 good labels, two 252, three 409, four 575).
* A cutoff is tested by the exact binomial law: with ``n`` good labelled documents in the stratum, of
  which it would reject ``k``, the hypothesis "it falsely rejects more than ``risk / m``" is refuted if
  ``P(Binomial(n, risk / m) <= k) <= confidence / (m * strata)`` (Bonferroni).
* The cutoffs of a rule are tested from the loosest to the strictest and the first that isn't
  refuted ends the sequence, which needs no correction for their number.
* Of the certified cutoffs the one with the largest gain (bad rejected less good rejected) is taken,
  the loosest among equals; without a gain, or in a stratum with too few labels to certify anything,
  the rule stays off and keeps every document.

Counts cover all labelled documents. A stratum may hold most rows: it only meets map-side combined
counts. Strata are few (languages): their counts and cutoffs are written by one task, and the cutoffs'
size is known to the planner.

Defined results: null text has no words (and fails the base rule of ten words), a null stratum is a
stratum of its own, repeated rows are judged alike, of several labels of a document the largest counts,
an empty table gives no rows, columns of the input are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import stage
from .common import SPACE, beside, free_name

# Fixed values of the contract.
SYMBOLS = r"[#*$%&|<>]+"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20

# Cutoffs per rate, from the loosest to the strictest.
GRID = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)
# The order in which strata of few labels take rules in: the base rule covers part of the last two.
RATES = ("symbol_rate", "capital_rate", "dup_line_rate", "repeat_rate")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(hashes: Column, ordered: Column) -> Column:
    """Words within windows whose hash occurs more than once; ``ordered`` is (hash, start) sorted."""
    at = lambda i: F.get(ordered, i)["h"]
    twice = F.filter(
        ordered, lambda x, i: F.coalesce(x["h"] == at(i - 1), F.lit(False)) | F.coalesce(x["h"] == at(i + 1), F.lit(False))
    )
    return F.array_sort(F.transform(twice, lambda x: x["i"]))


def with_features(docs: DataFrame, text: str = "text", into: str = "_quality") -> DataFrame:
    """``docs`` with a struct of counts and rates of the whole text.

    Windows are compared by 64-bit hashes of their words' hashes within one document. Sorting them
    is done only for documents that repeat a window at all.
    """
    w, h, o, r, body = (free_name(docs, x) for x in ("_words", "_hashes", "_ordered", "_starts", "_body"))
    rows = docs.withColumn(body, F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = rows.withColumn(w, F.array_remove(F.split(F.col(body), SPACE, -1), ""))
    size = F.size(w)
    rows = rows.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    window = lambda i: F.xxhash64(*[F.get(F.col(h), i + k) for k in range(WINDOW)])
    rows = rows.withColumn(
        o,
        F.when(size >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(size - WINDOW, F.lit(0))), window)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    rows = rows.withColumn(
        r,
        F.when(
            F.size(F.array_distinct(o)) < F.size(o),
            F.array_sort(F.transform(o, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    rows = rows.withColumn(o, F.when(F.col(r).isNotNull(), _repeat_words(F.col(h), F.col(r))))
    repeats = F.coalesce(
        F.aggregate(
            F.transform(o, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(o), i + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ),
        F.lit(0).cast("long"),
    )
    lines = F.filter(F.split(F.col(body), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = F.struct(
        size.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(F.col(h)).cast("long").alias("n_lines"),
        F.size(F.array_distinct(h)).cast("long").alias("n_distinct_lines"),
        repeats.alias("n_repeat_words"),
        F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
    )
    # An array of one struct, exploded: rates and verdicts read the counts many times, and the optimizer
    # would otherwise put the expressions behind them in each place.
    rows = rows.withColumn(h, lines).select(*[c for c in rows.columns if c != h], h, F.explode(F.array(counts)).alias(into))
    f = F.col(into)
    per = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    dup_lines = f["n_lines"] - f["n_distinct_lines"]
    rates = F.struct(
        *[f[c].alias(c) for c in ("n_words", "word_chars", "n_symbols")],
        dup_lines.alias("n_dup_lines"),
        f["n_repeat_words"].alias("n_repeat_words"),
        per(f["n_symbols"], f["word_chars"]).alias("symbol_rate"),
        per(dup_lines, f["n_lines"]).alias("dup_line_rate"),
        per(f["n_repeat_words"], f["n_words"]).alias("repeat_rate"),
        per(f["n_capitals"], f["word_chars"]).alias("capital_rate"),
        ((f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])).alias("base_failed"),
    )
    return rows.withColumn(into, rates).drop(w, h, o, r, body)


def binomial_log_cdf(k: Column, n: Column, p: Column | float) -> Column:
    """ln P(Binomial(n, p) <= k), summed exactly in logarithms; 0 where k is at least the mean."""
    k, n, p = (F.col(x) if isinstance(x, str) else F.lit(x) for x in (k, n, p))
    odds = F.log(p / (1 - p))
    first = n * F.log(1 - p)
    step = lambda s, j: F.struct(
        (s["t"] + F.log((n - j + 1) / j) + odds).alias("t"), s["total"].alias("total")
    )
    add = lambda s: F.struct(
        s["t"].alias("t"),
        (F.greatest(s["t"], s["total"]) + F.log1p(F.exp(-F.abs(s["t"] - s["total"])))).alias("total"),
    )
    start = F.struct(first.alias("t"), first.alias("total"))
    summed = F.aggregate(
        F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        start,
        lambda s, j: add(step(s, j)),
        lambda s: s["total"],
    )
    return F.when(k >= n * p, F.lit(0.0)).otherwise(summed)


def risk_cutoffs(
    labelled: DataFrame, stratum: str, good: str, features: str, risk: float = 0.04, confidence: float = 0.05
) -> DataFrame:
    """Per stratum a map from rate to its certified cutoff; rules that stay off are absent.

    ``labelled``: rows with the stratum, whether the label is good (boolean) and the features.
    """
    grid = F.array(*map(F.lit, GRID))
    exceeded = lambda value: F.size(F.filter(grid, lambda c: value > c))
    levels = [F.struct(F.lit(r).alias("rule"), exceeded(F.col(features)[r]).alias("level")) for r in RATES]
    counts = (
        labelled.select(F.col(stratum).alias("stratum"), F.col(good).alias("good"), F.explode(F.array(*levels)).alias("x"))
        .groupBy("stratum", "x.rule", "x.level")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # A level counts the cutoffs that a rate exceeds, which are the last (strictest) of the grid, so
    # cutoff i rejects the levels from len(GRID) - i on.
    counts = stage(counts.coalesce(1), "levels")
    cutoff = F.explode(F.expr(f"sequence(0, {len(GRID) - 1})"))
    per_rule = counts.groupBy("stratum", "rule").agg(
        F.collect_list(F.struct("level", "good", "bad")).alias("levels"), F.sum("good").alias("n")
    )
    size = len(GRID)
    rejected = lambda c: F.aggregate(
        F.filter("levels", lambda x: x["level"] >= size - F.col("i")), F.lit(0).cast("long"), lambda a, x: a + x[c]
    )
    tested = per_rule.withColumn("i", cutoff).select(
        "stratum", "rule", "n", "i", rejected("good").alias("k"), rejected("bad").alias("caught")
    )
    strata = counts.agg(F.count_distinct("stratum")).scalar()
    share = lambda m: F.log(F.lit(confidence) / (m * strata))
    enough = [F.when(F.col("n") * F.log(F.lit(1 - risk / m)) <= share(m), m) for m in range(1, len(RATES) + 1)]
    place = F.array_position(F.array(*map(F.lit, RATES)), F.col("rule"))
    judged = (
        tested.withColumn("m", F.greatest(*enough, F.lit(0)))
        .where(place <= F.col("m"))
        .withColumn("refuted", binomial_log_cdf(F.col("k"), F.col("n"), F.lit(risk) / F.col("m")) <= share(F.col("m")))
    )
    failed = (
        judged.groupBy("stratum", "rule")
        .agg(F.min(F.when(~F.col("refuted"), F.col("i"))).alias("stop"), F.collect_list(F.struct("i", "k", "caught")).alias("tests"))
        .withColumn("sure", F.filter("tests", lambda x: x["i"] < F.coalesce(F.col("stop"), F.lit(size))))
        .withColumn(
            "best",
            F.array_max(
                F.transform("sure", lambda x: F.struct((x["caught"] - x["k"]).alias("gain"), (-x["i"]).alias("loose")))
            ),
        )
        .where(F.col("best.gain") > 0)
    )
    return failed.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", F.get(grid, -F.col("best.loose"))))).alias("cutoffs")
    )


def judge(
    docs: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", **options
) -> tuple[DataFrame, str]:
    """``docs`` with a struct (counts, rates, base_failed and kept), and the struct's name.

    Labelled documents are read once for the cutoffs, all documents once for the verdicts; no text
    is written or shuffled on the way (that of labelled ones is, if labels are too many to send).
    """
    into = free_name(docs, "_quality")
    marks = labels.groupBy(F.col("doc_id").alias("_label_of")).agg(F.max("quality").alias("_label")).where("_label IS NOT NULL")
    strata = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("null"))
    slim = docs.select(F.col(doc_id).alias("_id"), strata.alias("_stratum"), F.col("text"))
    marked = slim.join(beside(marks), F.col("_id") == F.col("_label_of")).withColumn("_good", F.col("_label") == 1)
    found = risk_cutoffs(with_features(marked, into="_features"), "_stratum", "_good", "_features", **options)
    # A written table: the planner sees that it is small and sends it to the documents.
    cutoffs = stage(found.coalesce(1), "cutoffs")
    key, of = free_name(docs, "_stratum_key"), free_name(docs, "_cutoffs")
    joined = with_features(docs, into=into).withColumn(key, strata).join(
        cutoffs.select(F.col("stratum").alias(f"{key}2"), F.col("cutoffs").alias(of)), F.col(key) == F.col(f"{key}2"), "left"
    )
    above = [F.coalesce(F.col(into)[r] > F.col(of)[r], F.lit(False)) for r in RATES]
    broken = above[0]
    for x in above[1:]:
        broken = broken | x
    kept = ~F.col(into)["base_failed"] & ~broken
    return joined.withColumn(into, F.col(into).withField("kept", kept)).drop(key, f"{key}2", of), into


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    rows, into = judge(docs, labels, **options)
    f = F.col(into)
    return rows.select("doc_id", *[f[c].alias(c) for c in COUNTS], f["base_failed"].alias("base_failed"), f["kept"].alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``."""
    rows, into = judge(docs, labels, **options)
    return rows.where(F.col(into)["kept"]).select(*docs.columns)
