"""Statistics, panel labelling, evaluation and models on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import bindings as B
from ..operators import evaluate as E
from ..operators import models as M
from ..operators import panel as P
from ..operators import profile as R
from ..operators import stats as S
from ..sources.files import TRANSACTION_TYPES
from ..workspace import stage
from .join_queries import weekly_with_macro
from .registry import query
from .sqltext import sql

# Panel results are shares of one order state in three, so a third is the even score.
EVEN = 0.33
SPLITS = (1997, 2000)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return P.with_split(P.label_next_period(B.panel(spark, sf)), *SPLITS)


# -- statistics --------------------------------------------------------------------------------

INDICATORS = ["housing_starts_index", "lumber_price_index", "mortgage_rate"]


@query(
    "describe",
    sql(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count({c}) AS value_count, min({c}) AS min_value,
            max({c}) AS max_value, round(avg({c}), 4) AS mean_value,
            round(stddev_samp({c}), 4) AS std_value FROM sales_m"""
            for c in INDICATORS
        ),
        "sales_m",
    ),
)
def describe(spark: SparkSession, sf: str) -> DataFrame:
    out = S.describe(B.sales(spark, sf, *INDICATORS), INDICATORS)
    return rounded(out, 4, "mean_value", "std_value")


@query(
    "outliers_3sigma",
    sql(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} < m - 3 * s OR {c} > m + 3 * s)
            AS outlier_count FROM sales_m,
            (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM sales_m)"""
            for c in INDICATORS
        ),
        "sales_m",
    ),
)
def outliers_3sigma(spark: SparkSession, sf: str) -> DataFrame:
    return S.outlier_counts(B.sales(spark, sf, *INDICATORS), INDICATORS)


@query(
    "histogram50",
    """
    SELECT cast(least(floor((l_extendedprice - lo) / (hi - lo) * 50) + 1, 50) AS integer) AS bin,
      count(*) AS row_count, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value
    FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
    GROUP BY 1
    """,
)
def histogram50(spark: SparkSession, sf: str) -> DataFrame:
    return S.histogram(B.table(spark, sf, "lineitem"), "l_extendedprice", 50)


@query(
    "boxplot_stats",
    sql(
        """
        WITH q AS (SELECT product_category, quantile_cont(revenue, 0.25) AS q1,
          quantile_cont(revenue, 0.5) AS median, quantile_cont(revenue, 0.75) AS q3
          FROM sales GROUP BY 1),
        f AS (SELECT s.product_category, revenue, q1, median, q3,
          revenue BETWEEN q1 - 1.5::double * (q3 - q1) AND q3 + 1.5::double * (q3 - q1) AS inside
          FROM sales s JOIN q ON s.product_category = q.product_category)
        SELECT product_category, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
          round(any_value(q3), 4) AS q3, min(revenue) FILTER (inside) AS whisker_low,
          max(revenue) FILTER (inside) AS whisker_high,
          count(*) FILTER (NOT inside) AS outlier_count
        FROM f GROUP BY 1
        """,
        "sales",
    ),
)
def boxplot_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.sales(spark, sf, "product_category", "revenue")
    return rounded(S.boxplot_stats(rows, "product_category", "revenue"), 4, "q1", "median", "q3")


WEEKLY = """
  w AS (SELECT date, cast(sum(revenue_cents) AS double) AS revenue_cents,
    cast(sum(units) AS double) AS units FROM sales GROUP BY 1),
  j AS (SELECT * FROM w LEFT JOIN macro_w ON date = week)
"""
CORRELATED = ["revenue_cents", "units", *INDICATORS, "season_factor"]


@query(
    "corr_matrix",
    sql(
        f"WITH {WEEKLY}"
        + "\nUNION ALL\n".join(
            f"SELECT '{a}' AS x, '{b}' AS y, "
            + ("1.0::double" if a == b else f"(SELECT round(corr({a}, {b}), 3) FROM j)")
            + " AS correlation"
            for a in CORRELATED
            for b in CORRELATED
        ),
        "sales",
        "macro_w",
    ),
)
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        S.correlation_matrix(weekly_with_macro(spark, sf), CORRELATED), 3, "correlation"
    )


PAIRS = [(c, "revenue_cents") for c in (*INDICATORS, "season_factor")]


@query(
    "corr_pair",
    sql(
        f"WITH {WEEKLY}"
        + "\nUNION ALL\n".join(
            f"""SELECT '{a}' AS x, '{b}' AS y, n AS pair_count, round(r, 6) AS correlation,
            round(r * sqrt((n - 2) / (1 - r * r)), 4) AS t_stat
            FROM (SELECT corr({a}, {b}) AS r, count(*) FILTER ({a} IS NOT NULL) AS n FROM j)"""
            for a, b in PAIRS
        ),
        "sales",
        "macro_w",
    ),
)
def corr_pair(spark: SparkSession, sf: str) -> DataFrame:
    out = S.correlations(weekly_with_macro(spark, sf), PAIRS)
    return rounded(rounded(out, 6, "correlation"), 4, "t_stat")


@query(
    "t_test",
    sql(
        """
        WITH s AS (SELECT count(*) FILTER (target = 0) AS n0, count(*) FILTER (target = 1) AS n1,
          avg(goal_diff) FILTER (target = 0) AS mean0, avg(goal_diff) FILTER (target = 1) AS mean1,
          var_samp(goal_diff) FILTER (target = 0) AS v0,
          var_samp(goal_diff) FILTER (target = 1) AS v1 FROM pairs)
        SELECT n0, n1, round(mean0, 6) AS mean0, round(mean1, 6) AS mean1,
          round((mean0 - mean1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)
            * (1.0::double / n0 + 1.0::double / n1)), 6) AS t_stat,
          cast(n0 + n1 - 2 AS double) AS df
        FROM s
        """,
        "pairs",
    ),
)
def t_test(spark: SparkSession, sf: str) -> DataFrame:
    out = S.pooled_t(labelled(spark, sf), "goal_diff", "target")
    return rounded(out, 6, "mean0", "mean1", "t_stat")


@query("t_test_p")
def t_test_p(spark: SparkSession, sf: str) -> DataFrame:
    """With the p-value: the distribution function runs on the one aggregated row."""
    out = S.pooled_t(labelled(spark, sf), "goal_diff", "target")
    return out.withColumn("p_value", S.p_value("t_stat", "df"))


@query(
    "linear_trend",
    sql(
        """SELECT regr_count(next_win_rate, win_rate) AS pair_count,
          round(regr_slope(next_win_rate, win_rate), 6) AS slope,
          round(regr_intercept(next_win_rate, win_rate), 6) AS intercept,
          round(regr_r2(next_win_rate, win_rate), 6) AS r2 FROM pairs""",
        "pairs",
    ),
)
def linear_trend(spark: SparkSession, sf: str) -> DataFrame:
    out = S.linear_trend(labelled(spark, sf), "win_rate", "next_win_rate")
    return rounded(out, 6, "slope", "intercept", "r2").withColumn(
        "pair_count", F.col("pair_count").cast("long")
    )


@query(
    "mutual_info",
    sql(
        """
        WITH long AS (SELECT target AS y, f AS feature, v AS value FROM (
          """
        + " UNION ALL ".join(
            f"SELECT target, '{f}' AS f, cast({f} AS double) AS v FROM pairs" for f in P.FEATURES
        )
        + """)),
        cuts AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
          quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1),
        cells AS (SELECT l.feature, y, (CASE WHEN value > q1 THEN 1 ELSE 0 END)
          + (CASE WHEN value > q2 THEN 1 ELSE 0 END) + (CASE WHEN value > q3 THEN 1 ELSE 0 END) AS b,
          cast(count(*) AS double) AS n
          FROM long l JOIN cuts c ON l.feature = c.feature GROUP BY ALL),
        m AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature, b) AS nb,
          sum(n) OVER (PARTITION BY feature, y) AS ny, sum(n) OVER (PARTITION BY feature) AS nt
          FROM cells)
        SELECT feature, round(sum(n / nt * ln(n * nt / (nb * ny))), 6) AS mutual_info
        FROM m GROUP BY 1
        """,
        "pairs",
    ),
)
def mutual_info(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        S.mutual_information(labelled(spark, sf), P.FEATURES, "target", 4), 6, "mutual_info"
    )


@query(
    "consistency_checks",
    sql(
        """
        WITH c AS (SELECT abs(win_rate - cast(wins AS double) / (cast(wins AS double)
            + cast(losses AS double) + coalesce(cast(ot_losses AS double), 0))) > 0.01::double AS a,
          wins + losses + coalesce(ot_losses, 0) <> 82 AS b,
          goal_diff <> goals_for - goals_against AS d FROM panel)
        SELECT 'win_rate_mismatch' AS check_name, count(*) FILTER (a) AS row_count FROM c
        UNION ALL SELECT 'games_mismatch', count(*) FILTER (b) FROM c
        UNION ALL SELECT 'goal_diff_mismatch', count(*) FILTER (d) FROM c
        """,
        "panel",
    ),
)
def consistency_checks(spark: SparkSession, sf: str) -> DataFrame:
    return S.mismatch_counts(B.panel(spark, sf), P.consistency_checks())


@query(
    "consistency_rows",
    sql(
        """SELECT team, year, wins + losses + coalesce(ot_losses, 0) AS games FROM panel
        WHERE wins + losses + coalesce(ot_losses, 0) <> 82""",
        "panel",
    ),
)
def consistency_rows(spark: SparkSession, sf: str) -> DataFrame:
    games = F.col("wins") + F.col("losses") + F.coalesce(F.col("ot_losses"), F.lit(0))
    wrong = B.panel(spark, sf).filter(P.consistency_checks()["games_mismatch"])
    return wrong.select("team", "year", games.alias("games"))


CELL_KINDS = {"int": "^-?[0-9]+$", "double": "^-?[0-9]+([.][0-9]+)?$", "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}


def dtypes_sql() -> str:
    parts = []
    for c, declared in TRANSACTION_TYPES.items():
        counts = {k: f"count(*) FILTER (regexp_matches({c}, '{p}'))" for k, p in CELL_KINDS.items()}
        tests = " ".join(f"WHEN {n} = count({c}) THEN '{k}'" for k, n in counts.items())
        parts.append(
            f"""SELECT '{c}' AS column_name, '{declared}' AS declared, count({c}) AS cells,
            CASE WHEN count({c}) = 0 THEN 'string' {tests} ELSE 'string' END AS inferred,
            {counts.get(declared, f"count({c})")} AS fitting FROM landing"""
        )
    return " UNION ALL ".join(parts)


@query("dtypes", sql(dtypes_sql(), "landing"))
def dtypes(spark: SparkSession, sf: str) -> DataFrame:
    """Type that every cell of a landing column has, beside the type declared for it, and how many
    cells fit the declared one."""
    return R.inferred_types(B.landing(spark, sf), TRANSACTION_TYPES, CELL_KINDS)


# -- labels and splits -------------------------------------------------------------------------


@query(
    "next_period_label",
    sql(
        """SELECT team, year, target_year, win_rate, next_win_rate,
          round(median_next_win_rate, 6) AS median_next_win_rate, target, ot_losses FROM pairs""",
        "pairs",
    ),
)
def next_period_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.label_next_period(B.panel(spark, sf))
    return rounded(rows, 6, "median_next_win_rate").select(
        *["team", "year", "target_year", "win_rate", "next_win_rate", "median_next_win_rate"],
        *["target", "ot_losses"],
    )


@query(
    "median_ties",
    sql(
        """SELECT count(*) AS pairs, count(*) FILTER (next_win_rate = median_next_win_rate)
          AS median_ties, cast(sum(target) AS bigint) AS positives FROM pairs""",
        "pairs",
    ),
)
def median_ties(spark: SparkSession, sf: str) -> DataFrame:
    return P.median_ties(P.label_next_period(B.panel(spark, sf)))


@query(
    "temporal_split",
    sql(
        """SELECT split, min(target_year) AS first_year, max(target_year) AS last_year,
          count(*) AS row_count, cast(sum(target) AS double) / count(*)::double AS positive_share
        FROM pairs GROUP BY 1""",
        "pairs",
    ),
)
def temporal_split(spark: SparkSession, sf: str) -> DataFrame:
    return P.split_summary(labelled(spark, sf))


def feature_guard_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, true AS is_feature, count({c}) AS newest_known FROM newest" for c in P.FEATURES]
    parts += [f"SELECT '{c}', false, count({c}) FROM newest" for c in P.FUTURE_COLUMNS]
    future = ", ".join(f"p.{c}" for c in P.FUTURE_COLUMNS)
    return f"""WITH newest AS (SELECT n.*, {future} FROM panel n LEFT JOIN pairs p USING (team, year)
      WHERE n.year = (SELECT max(year) FROM panel)) {" UNION ALL ".join(parts)}"""


@query("feature_guard", sql(feature_guard_sql(), "panel", "pairs"))
def feature_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the guard lets a column through, beside how many rows of the newest period know it:
    what it refuses is known for none of them."""
    rows = stage(B.panel(spark, sf), "panel")
    labels = P.label_next_period(rows).select("team", "year", *P.FUTURE_COLUMNS)
    newest = rows.filter(F.col("year") == rows.agg(F.max("year")).scalar()).join(labels, ["team", "year"], "left")

    def passes(column: str) -> bool:
        try:
            return P.guard_features([*P.FEATURES, column]) is not None
        except P.FutureLeak:
            return False

    names = [*P.FEATURES, *P.FUTURE_COLUMNS]
    counts = newest.agg(*[F.count(c).alias(c) for c in names])
    return R.unpivot_row(counts, {c: [F.lit(passes(c)), F.col(c)] for c in names}, ["is_feature", "newest_known"])


# -- evaluation --------------------------------------------------------------------------------

AUC_SQL = """
  r AS (SELECT g, label, sum(n) OVER (PARTITION BY g ORDER BY score) - (n - 1) / 2.0::double AS rk,
    pos, n FROM c)
  SELECT g AS GROUPING, cast(sum(n) AS bigint) AS rows, cast(sum(pos) AS bigint) AS positives,
    round((sum(pos * rk) - sum(pos) * (sum(pos) + 1) / 2.0::double)
      / (cast(sum(pos) AS double) * cast(sum(n) - sum(pos) AS double)), 6) AS auc
  FROM r GROUP BY 1
"""


@query(
    "roc_auc",
    sql(
        """WITH c AS (SELECT split AS g, win_rate AS score, 0 AS label, count(*) AS n,
          sum(target) AS pos FROM pairs GROUP BY 1, 2), """
        + AUC_SQL.replace("GROUPING", "split"),
        "pairs",
    ),
)
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(E.roc_auc(labelled(spark, sf), "win_rate", "target", ["split"]), 6, "auc")


@query(
    "roc_auc_rows",
    """WITH c AS (SELECT l_linestatus AS g, l_extendedprice AS score, 0 AS label, count(*) AS n,
      count(*) FILTER (l_returnflag = 'R') AS pos FROM lineitem GROUP BY 1, 2), """
    + AUC_SQL.replace("GROUPING", "l_linestatus"),
)
def roc_auc_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The price as a score for returns, over all rows, per line status."""
    rows = B.table(spark, sf, "lineitem").select(
        "l_linestatus",
        "l_extendedprice",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )
    return rounded(E.roc_auc(rows, "l_extendedprice", "returned", ["l_linestatus"]), 6, "auc")


@query(
    "const_baseline",
    sql(
        """
        WITH m AS (SELECT target AS guess FROM pairs WHERE split = 'train' GROUP BY 1
          ORDER BY count(*) DESC, target LIMIT 1)
        SELECT split, any_value(guess) AS guess, 0.5::double AS auc,
          cast(count(*) FILTER (target = guess) AS double) / count(*)::double AS accuracy
        FROM pairs, m GROUP BY 1
        """,
        "pairs",
    ),
)
def const_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """The majority class of the training rows as a constant score."""
    rows = stage(labelled(spark, sf), "pairs")
    guess = R.most_common(rows.filter("split = 'train'"), "target").select("target").scalar()
    scored = rows.withColumn("guess", guess)
    aucs = E.roc_auc(scored, "guess", "target", ["split"]).select("split", "auc")
    hits = scored.groupBy("split").agg(
        F.max("guess").alias("guess"),
        (
            F.count_if(F.col("guess") == F.col("target")).cast("double")
            / F.count(F.lit(1)).cast("double")
        ).alias("accuracy"),
    )
    return hits.join(aucs, "split")


@query(
    "score_baseline",
    sql(
        f"""
        SELECT split, count(*) FILTER (win_rate >= {EVEN}::double AND target = 1) AS tp,
          count(*) FILTER (win_rate >= {EVEN}::double AND target = 0) AS fp,
          count(*) FILTER (win_rate < {EVEN}::double AND target = 1) AS fn,
          count(*) FILTER (win_rate < {EVEN}::double AND target = 0) AS tn,
          round(avg(CASE WHEN (win_rate >= {EVEN}::double) = (target = 1) THEN 1.0::double
            ELSE 0.0::double END), 6) AS accuracy,
          round(2.0::double * tp / (2.0::double * tp + fp + fn), 6) AS f1
        FROM pairs GROUP BY 1
        """,
        "pairs",
    ),
)
def score_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """The current share as a score: confusion counts, accuracy and F1 per split."""
    out = E.threshold_metrics(labelled(spark, sf), "win_rate", "target", ["split"], EVEN)
    return rounded(out, 6, "accuracy", "f1")


@query(
    "threshold_metrics",
    """
    SELECT l_linestatus, count(*) FILTER (l_discount >= 0.05::double AND l_returnflag = 'R') AS tp,
      count(*) FILTER (l_discount >= 0.05::double AND l_returnflag <> 'R') AS fp,
      count(*) FILTER (l_discount < 0.05::double AND l_returnflag = 'R') AS fn,
      count(*) FILTER (l_discount < 0.05::double AND l_returnflag <> 'R') AS tn,
      round(cast(tp + tn AS double) / (tp + fp + fn + tn), 6) AS accuracy,
      round(2.0::double * tp / (2.0::double * tp + fp + fn), 6) AS f1
    FROM lineitem GROUP BY 1
    """,
)
def threshold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "lineitem").select(
        "l_linestatus",
        "l_discount",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )
    out = E.threshold_metrics(rows, "l_discount", "returned", ["l_linestatus"], 0.05)
    return rounded(out, 6, "accuracy", "f1")


@query(
    "brier",
    sql(
        """SELECT split, round(avg((win_rate - target) * (win_rate - target)), 6) AS brier
        FROM pairs GROUP BY 1""",
        "pairs",
    ),
)
def brier(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(E.brier(labelled(spark, sf), "win_rate", "target", ["split"]), 6, "brier")


@query(
    "brier_improvement",
    """
    WITH s AS (SELECT l_discount * 10 AS p, l_quantity / 50 AS q,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem),
    b AS (SELECT avg((p - y) * (p - y)) AS brier, avg((q - y) * (q - y)) AS brier_baseline FROM s)
    SELECT round(brier, 6) AS brier, round(brier_baseline, 6) AS brier_baseline,
      round((brier_baseline - brier) / brier_baseline * 100, 4) AS improvement_pct FROM b
    """,
)
def brier_improvement(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "lineitem").select(
        (F.col("l_discount") * 10).alias("p"),
        (F.col("l_quantity") / 50).alias("q"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
    )
    out = E.brier_improvement(rows, "p", "q", "y")
    return rounded(rounded(out, 6, "brier", "brier_baseline"), 4, "improvement_pct")


def judged(spark: SparkSession, sf: str) -> DataFrame:
    test = labelled(spark, sf).filter("split = 'test'")
    return E.with_outcome(test, "win_rate", "target", EVEN)


JUDGED = f"""
  SELECT *, CASE WHEN (win_rate >= {EVEN}::double) = (target = 1) THEN 'Correct'
    WHEN win_rate >= {EVEN}::double THEN 'False Positive' ELSE 'False Negative' END AS outcome
  FROM pairs WHERE split = 'test'
"""


@query(
    "error_analysis",
    sql(
        f"""SELECT team, year, outcome, round(abs(win_rate - {EVEN}::double), 6) AS confidence
        FROM ({JUDGED})""",
        "pairs",
    ),
)
def error_analysis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(judged(spark, sf), 6, "confidence").select(
        "team", "year", "outcome", "confidence"
    )


@query(
    "topk_confident_errors",
    sql(
        f"""SELECT team, year, outcome FROM ({JUDGED}) WHERE outcome <> 'Correct'
        ORDER BY abs(win_rate - {EVEN}::double) DESC, team, year LIMIT 5""",
        "pairs",
    ),
)
def topk_confident_errors(spark: SparkSession, sf: str) -> DataFrame:
    return E.confident_errors(judged(spark, sf), ["team", "year"], 5).select(
        "team", "year", "outcome"
    )


@query(
    "profile_by_outcome",
    sql(
        f"""SELECT outcome, count(*) AS row_count, round(avg(win_rate), 6) AS win_rate,
          round(avg(goal_diff), 6) AS goal_diff, round(avg(wins), 6) AS wins
        FROM ({JUDGED}) GROUP BY 1""",
        "pairs",
    ),
)
def profile_by_outcome(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["win_rate", "goal_diff", "wins"]
    return rounded(E.outcome_profile(judged(spark, sf), columns), 6, *columns)


@query(
    "error_rate_by_period",
    """
    SELECT cast(year(l_shipdate) AS integer) AS year, count(*) AS row_count,
      count(*) FILTER ((l_discount >= 0.05::double) <> (l_returnflag = 'R')) AS error_count,
      round(error_count * 100.0::double / row_count, 6) AS error_rate_pct
    FROM lineitem GROUP BY 1
    """,
)
def error_rate_by_period(spark: SparkSession, sf: str) -> DataFrame:
    rows = B.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"),
        "l_discount",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
    )
    out = E.error_rate_by(E.with_outcome(rows, "l_discount", "returned", 0.05), "year")
    return rounded(out, 6, "error_rate_pct")


@query(
    "union_groups",
    sql(f"SELECT team, year, outcome AS type FROM ({JUDGED})", "pairs"),
)
def union_groups(spark: SparkSession, sf: str) -> DataFrame:
    return E.union_outcomes(stage(judged(spark, sf), "judged")).select("team", "year", "type")


MODEL_SCORES = {"share": "win_rate", "goals": "goals_score", "constant": "half"}


def scored_models(spark: SparkSession, sf: str) -> DataFrame:
    goals = F.col("goals_for") / (F.col("goals_for") + F.col("goals_against"))
    return labelled(spark, sf).withColumns({"goals_score": goals, "half": F.lit(0.5)})


MODEL_SQL = (
    """
  WITH s AS (
    SELECT 'share' AS model, split, target, win_rate AS score FROM pairs
    UNION ALL SELECT 'goals', split, target,
      cast(goals_for AS double) / (goals_for + goals_against) FROM pairs
    UNION ALL SELECT 'constant', split, target, 0.5::double FROM pairs),
  c AS (SELECT model, split, score, count(*) AS n, sum(target) AS pos FROM s GROUP BY 1, 2, 3),
  r AS (SELECT model, split, n, pos, sum(n) OVER (PARTITION BY model, split ORDER BY score)
    - (n - 1) / 2.0::double AS rk FROM c),
  a AS (SELECT model, split, (sum(pos * rk) - sum(pos) * (sum(pos) + 1) / 2.0::double)
      / (cast(sum(pos) AS double) * cast(sum(n) - sum(pos) AS double)) AS auc
    FROM r GROUP BY 1, 2),
  t AS (SELECT model, cast(count(*) FILTER ((score >= 0.5::double) = (target = 1)) AS double)
      / count(*) AS acc,
    2.0::double * count(*) FILTER (score >= 0.5::double AND target = 1)
      / (2.0::double * count(*) FILTER (score >= 0.5::double AND target = 1)
        + count(*) FILTER ((score >= 0.5::double) <> (target = 1))) AS f1
    FROM s WHERE split = 'test' GROUP BY 1),
  w AS (SELECT v.model, v.auc AS va, e.auc AS ta, f1, acc FROM a v
    JOIN a e ON v.model = e.model AND e.split = 'test' JOIN t ON t.model = v.model
    WHERE v.split = 'validation')
  SELECT model, round(va, 6) AS validation_auc, round(ta, 6) AS test_auc,
    round(coalesce(f1, 0), 6) AS test_f1, round(acc, 6) AS test_accuracy,
    round(ta - va, 6) AS test_minus_validation, round(va - base, 6) AS vs_first,
    CASE WHEN va - base > 0.005::double THEN 'BETTER' WHEN va - base < -0.005::double THEN 'WORSE'
      ELSE '~EQUAL' END AS verdict
  FROM w, (SELECT va AS base FROM w WHERE model = 'share')
"""
)


@query("model_table", sql(MODEL_SQL, "pairs"))
def model_table(spark: SparkSession, sf: str) -> DataFrame:
    out = E.model_table(scored_models(spark, sf), MODEL_SCORES, "target", "split")
    return rounded(
        out,
        6,
        *["validation_auc", "test_auc", "test_f1", "test_accuracy"],
        *["test_minus_validation", "vs_first"],
    )


@query(
    "rank_models",
    sql(
        f"SELECT model, validation_auc FROM ({MODEL_SQL}) ORDER BY validation_auc DESC, model LIMIT 1",
        "pairs",
    ),
)
def rank_models(spark: SparkSession, sf: str) -> DataFrame:
    table = E.model_table(scored_models(spark, sf), MODEL_SCORES, "target", "split")
    return rounded(E.best_model(table), 6, "validation_auc").select("model", "validation_auc")


@query("bootstrap_ci")
def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    return E.bootstrap_interval(labelled(spark, sf), "win_rate", "target", 1000)


@query("bootstrap_ci_rows")
def bootstrap_ci_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Interval of the AUC of price for returns, over all rows."""
    rows = B.table(spark, sf, "lineitem").select(
        "l_extendedprice", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned")
    )
    return E.bootstrap_interval(rows, "l_extendedprice", "returned", 1000)


# -- models ------------------------------------------------------------------------------------


def study_rows(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Labelled rows per split, written once: every fit reads them again."""
    rows = stage(labelled(spark, sf), "pairs")
    return {s: rows.filter(F.col("split") == s) for s in ("train", "validation", "test")}


def model_report(model, parts: dict[str, DataFrame]) -> DataFrame:
    scored = None
    for name in ("validation", "test"):
        part = M.predict(model, parts[name])
        scored = part if scored is None else scored.unionByName(part)
    fits = E.threshold_metrics(scored, "score", "target", ["split"])
    aucs = E.roc_auc(scored, "score", "target", ["split"]).select("split", "auc")
    return fits.join(aucs, "split").select("split", "auc", "f1", "accuracy")


@query("impute_scale")
def impute_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled features of the test rows, with means and deviations of the training rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    parts = study_rows(spark, sf)
    train, test = (M.as_model_input(parts[s], P.FEATURES) for s in ("train", "test"))
    fitted = Pipeline(stages=M.prepare_stages(P.FEATURES, scale=True)).fit(train)
    return fitted.transform(test).select(
        "team", "year", vector_to_array("features").alias("features")
    )


def logistic_search(train: DataFrame):
    """Five folds over all penalty strengths and kinds, refitted with the best."""
    estimator = M.logistic()
    return M.grid_search(train, estimator, M.logistic_grid(estimator, train.count()), scale=True)


@query("logreg")
def logreg(spark: SparkSession, sf: str) -> DataFrame:
    parts = study_rows(spark, sf)
    return model_report(logistic_search(parts["train"]).bestModel, parts)


@query("random_forest")
def random_forest(spark: SparkSession, sf: str) -> DataFrame:
    parts = study_rows(spark, sf)
    estimator = M.forest(numTrees=100, maxDepth=3, minInstancesPerNode=5)
    return model_report(M.fit(parts["train"], estimator), parts)


def boost(**params):
    return M.boosting(maxIter=100, maxDepth=2, stepSize=0.1, **params)


@query("gbt")
def gbt(spark: SparkSession, sf: str) -> DataFrame:
    parts = study_rows(spark, sf)
    estimator = boost(subsamplingRate=0.8, minInstancesPerNode=5)
    return model_report(M.fit(parts["train"], estimator), parts)


@query("gbt_colsample")
def gbt_colsample(spark: SparkSession, sf: str) -> DataFrame:
    parts = study_rows(spark, sf)
    estimator = boost(featureSubsetStrategy="0.8")
    return model_report(M.fit(parts["train"], estimator), parts)


@query("grid_cv")
def grid_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validated AUC over all penalty strengths and kinds."""
    return M.grid_table(logistic_search(study_rows(spark, sf)["train"]), spark)


@query("coefficients")
def coefficients(spark: SparkSession, sf: str) -> DataFrame:
    train = study_rows(spark, sf)["train"]
    model = M.fit(train, M.logistic(rows=train.count()), scale=True)
    return M.weights(model, P.FEATURES, spark)


@query("importances")
def importances(spark: SparkSession, sf: str) -> DataFrame:
    train = study_rows(spark, sf)["train"]
    return M.weights(M.fit(train, M.forest(numTrees=100, maxDepth=3)), P.FEATURES, spark)


@query("cutoff_sensitivity")
def cutoff_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(labelled(spark, sf), "pairs")
    return M.cutoff_sensitivity(rows, boost(), [1996, 1997, 2000], 2001)


@query("ablation")
def ablation(spark: SparkSession, sf: str) -> DataFrame:
    parts = study_rows(spark, sf)
    return M.ablation(parts["train"], parts["test"], boost())


@query("fitted_models")
def fitted_models(spark: SparkSession, sf: str) -> DataFrame:
    """All fitted models and two baselines side by side, by their stored scores."""
    rows = stage(labelled(spark, sf), "pairs")
    train = rows.filter(F.col("split") == "train")
    fits = {
        "logistic": lambda: logistic_search(train).bestModel,
        "forest": lambda: M.fit(train, M.forest(numTrees=100, maxDepth=3, minInstancesPerNode=5)),
        "boosted": lambda: M.fit(train, boost(subsamplingRate=0.8, minInstancesPerNode=5)),
        "colsample": lambda: M.fit(train, boost(featureSubsetStrategy="0.8")),
    }
    models = dict(zip(fits, M.at_once([*fits.values()])))
    scored = rows.withColumn("half", F.lit(0.5))
    for name, model in models.items():
        scored = M.predict(model, scored).withColumnRenamed("score", name)
    stored = stage(scored.select("split", "target", "half", "win_rate", *models), "scores")
    return E.model_table(stored, {"share": "win_rate", "constant": "half", **{m: m for m in models}}, "target", "split")
