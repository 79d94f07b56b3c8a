"""Models on the monthly panel. Linear ones have a closed form, written out in SQL."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.operators import models, stats, tuning
from panelwise.operators.models import Spec
from panelwise.plans import bindings as b, features as chains
from panelwise.plans.catalog.registry import query
from panelwise.session import landed, new_folder

ID = ["city", "year", "month"]
FIRST_TEST = 2000
LABEL = "precip_total"
FEATURES = [
    "temp_mean",
    "humidity_mean",
    "wind_mean",
    "solar_mean",
    "precip_total_lag1",
    "precip_total_lag3",
    "precip_total_lag12",
    "temp_mean_lag1",
    "precip_anomaly",
    "month_sin",
    "month_cos",
]
_N = len(FEATURES)
_F = [f"f{i}" for i in range(1, _N + 1)]

# The eleven features as f1 to f11, as ``features.monthly_features`` makes them.
_BASE_SQL = """base AS (
        SELECT city, year, month, precip_total AS y, temp_mean AS f1, humidity_mean AS f2, wind_mean AS f3, solar_mean AS f4,
               lag(precip_total, 1) OVER w AS f5, lag(precip_total, 3) OVER w AS f6, lag(precip_total, 12) OVER w AS f7, lag(temp_mean, 1) OVER w AS f8,
               precip_total - avg(precip_total) OVER (PARTITION BY city ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS f9,
               sin(2 * pi() * month / 12) AS f10, cos(2 * pi() * month / 12) AS f11
        FROM monthly WINDOW w AS (PARTITION BY city ORDER BY year, month))"""


def _linear_sql(alpha: float, select: str, train: str = f"WHERE year < {FIRST_TEST}", asked: str = "base") -> str:
    """Ridge (or, with alpha 0, least squares) on all standardised features: the normal equations, solved step by step."""
    every = ", ".join
    return f"""WITH RECURSIVE {_BASE_SQL},
        med AS (SELECT {every(f"quantile_cont({f}, 0.5) AS q_{f}" for f in _F)} FROM base {train}),
        filled AS (SELECT city, year, month, y, {every(f"coalesce({f}, q_{f}) AS {f}" for f in _F)} FROM base, med),
        st AS (SELECT {every(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in _F)}, avg(y) AS my FROM filled {train}),
        z AS (SELECT year, y - my AS y, [{every(f"({f} - m_{f}) / s_{f}" for f in _F)}] AS z FROM filled, st),
        gram AS (
          SELECT i, list(v ORDER BY j) AS r FROM (
            SELECT i, j, sum(z[i] * CASE WHEN j = {_N + 1} THEN y ELSE z[j] END) + CASE WHEN i = j THEN {alpha} ELSE 0 END AS v
            FROM z, range(1, {_N + 1}) a(i), range(1, {_N + 2}) b(j) {train} GROUP BY i, j) GROUP BY i),
        steps AS (
          SELECT 1 AS k, list(r ORDER BY i) AS m FROM gram
          UNION ALL SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / m[k][k])
            ELSE list_transform(r, lambda x, j: x - r[k] / m[k][k] * m[k][j]) END) FROM steps WHERE k <= {_N}),
        w AS (SELECT list_transform(m, lambda r: r[{_N + 1}]) AS w FROM steps WHERE k = {_N + 1}),
        asked AS (SELECT * FROM {asked}),
        scored AS (SELECT city, year, month, y, my + list_inner_product([{every(f"(coalesce({f}, q_{f}) - m_{f}) / s_{f}" for f in _F)}], w) AS p FROM asked, med, st, w)
        {select}"""


_PREDICTED = "SELECT city, year, month, round(p, 3) AS predicted FROM scored"


def feature_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly panel with its features, written once: fitting goes over it many times."""
    return landed(chains.monthly_features(b.monthly(spark, sf), LABEL, ["city"]), "features")


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year") < FIRST_TEST)


def fit_all(rows: DataFrame, spec: Spec) -> PipelineModel:
    return models.fit(train_rows(rows), FEATURES, LABEL, spec)


def scored(rows: DataFrame, model: PipelineModel, digits: int = 3) -> DataFrame:
    out = models.predict({"predicted": model}, rows)
    return out.select(*ID, F.round("predicted", digits).alias("predicted"))


@query("model_ridge", _linear_sql(10.0, _PREDICTED))
def model_ridge(spark: SparkSession, sf: str) -> DataFrame:
    rows = feature_panel(spark, sf)
    return scored(rows, fit_all(rows, Spec("ridge", {"alpha": 10.0})))


@query("model_ols", _linear_sql(0.0, _PREDICTED))
def model_ols(spark: SparkSession, sf: str) -> DataFrame:
    rows = feature_panel(spark, sf)
    return scored(rows, fit_all(rows, Spec("ols")))


@query("model_save_load", _linear_sql(0.0, _PREDICTED))
def model_save_load(spark: SparkSession, sf: str) -> DataFrame:
    rows, path = feature_panel(spark, sf), new_folder(spark, "model")
    models.save_model(fit_all(rows, Spec("ols")), path)
    return scored(rows, models.load_first([f"{path}-final", path]))


@query("retrain_full", _linear_sql(1.0, _PREDICTED, train=""))
def retrain_full(spark: SparkSession, sf: str) -> DataFrame:
    rows = feature_panel(spark, sf)
    return scored(rows, models.fit(rows, FEATURES, LABEL, Spec("ridge", {"alpha": 1.0})))


@query(
    "batch_score",
    _linear_sql(
        0.0,
        """SELECT city, year, month, round(p, 2) AS predicted,
               CASE WHEN p < 50 THEN 'LOW' WHEN p < 80 THEN 'MODERATE' WHEN p < 120 THEN 'HIGH' ELSE 'VERY HIGH' END AS risk FROM scored""",
        asked="(SELECT * REPLACE (CASE WHEN month <> 5 THEN f1 END AS f1, NULL::DOUBLE AS f4) FROM base)",
    ),
)
def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """Requests without one feature at all, and without another in May."""
    rows = feature_panel(spark, sf)
    model = fit_all(rows, Spec("ols"))
    temp = F.when(F.col("month") != 5, F.col("temp_mean"))
    requests = rows.withColumn("temp_mean", temp).select(*ID, *[f for f in FEATURES if f != "solar_mean"])
    return models.batch_score(requests, model, FEATURES).select(*ID, "predicted", "risk")


@query(
    "prediction_table",
    _linear_sql(
        0.0,
        """SELECT city, year, month, y AS actual, round(p, 3) AS predicted, round(y - p, 3) AS residual,
                  CASE WHEN year < 2000 THEN 'train' ELSE 'test' END AS model FROM scored""",
    ),
)
def prediction_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = feature_panel(spark, sf)
    model = fit_all(rows, Spec("ols"))
    table = models.tagged_predictions(model, rows, ID, LABEL, "year", FIRST_TEST)
    return table.withColumns({c: F.round(c, 3) for c in ("predicted", "residual")})


@query(
    "feature_importance",
    _linear_sql(
        10.0,
        f"""SELECT list_extract({FEATURES}, i) AS feature, round(abs(w[i]) / list_sum(list_transform(w, lambda x: abs(x))), 6) AS importance
            FROM w, range(1, {_N + 1}) a(i)""",
    ),
)
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    model = fit_all(feature_panel(spark, sf), Spec("ridge", {"alpha": 10.0}))
    return models.importances(spark, model, FEATURES).withColumn("importance", F.round("importance", 6))


# --- trees, tuning and stacks: closed forms on one feature, beside the full models ---------------

#: The quarter of the year: a feature of four values, on which fits have closed forms.
QUARTER = "quarter"
#: A line that is flat: it predicts the mean of what it has seen.
FLAT = Spec("ridge", {"alpha": 1e15})

# Folds as the tuner makes them, and the quarter's line and group means for each.
_FOLDS_SQL = f"""WITH base AS (SELECT city, year, month, precip_total AS y, ceil(month / 3)::DOUBLE AS x, year * 12 + month AS period FROM monthly),
    calendar AS (SELECT period, row_number() OVER (ORDER BY period DESC) AS from_end, greatest(count(*) OVER () // 4, 1) AS size
                 FROM (SELECT DISTINCT period FROM base WHERE year < {FIRST_TEST})),
    blocks AS (SELECT base.*, greatest(3 - (from_end - 1) // size, 0) AS block FROM base JOIN calendar USING (period)),
    cuts AS (SELECT * FROM (VALUES (1), (2), (3), (4)) t(fold)),
    past AS (SELECT fold, x, y FROM blocks JOIN cuts ON block < fold),
    seen AS (SELECT fold, avg(y) AS y_mean, avg(x) AS x_mean, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy,
                    CASE WHEN quantile_cont(x, 0.75) > quantile_cont(x, 0.25) THEN quantile_cont(x, 0.75) - quantile_cont(x, 0.25) ELSE 1 END AS s FROM past GROUP BY fold),
    lines AS (SELECT fold, y_mean, x_mean, alpha, (sxy / s) / (sxx / (s * s) + alpha) / s AS slope FROM seen, (VALUES (1), (10)) t(alpha)),
    means AS (SELECT fold, x, avg(y) AS m FROM past GROUP BY fold, x),
    unseen AS (SELECT block AS fold, y, y_mean + slope * (b.x - x_mean) AS line, m, alpha
               FROM blocks b JOIN lines ON lines.fold = block JOIN means ON means.fold = block AND means.x = b.x WHERE block > 0),"""

_GRID_SQL = """
    errors AS (SELECT alpha, avg(line) AS line, avg(m) AS m FROM (
      SELECT alpha, fold, avg(abs(y - line)) AS line, avg(abs(y - m)) AS m FROM unseen GROUP BY alpha, fold) GROUP BY alpha),
    grid AS (
      SELECT 'ridge' AS model, 'alpha=' || alpha AS params FROM (VALUES (1), (10)) a(alpha)
      UNION ALL SELECT 'random_forest', 'trees=' || t || ', depth=' || d || ', min_leaf=' || l FROM (VALUES (100), (150)) a(t), (VALUES (5), (10)) b(d), (VALUES (3), (5)) c(l)
      UNION ALL SELECT 'extra_trees', 'trees=' || t || ', depth=' || d FROM (VALUES (100), (150)) a(t), (VALUES (5), (30)) b(d)
      UNION ALL SELECT k, 'iterations=' || t || ', depth=' || d || ', rate=' || r
      FROM (VALUES ('gbt'), ('boosted_alt')) k(k), (VALUES (100), (150)) a(t), (VALUES (3), (5)) b(d), (VALUES ('0.05'), ('0.1')) c(r))
    SELECT model, params, round(CASE WHEN model = 'ridge' THEN (SELECT line FROM errors WHERE 'alpha=' || alpha = params) ELSE (SELECT any_value(m) FROM errors) END, 4) AS quarter_mae,
           true AS beats_mean FROM grid"""

_STACK_SQL = f"""
    u AS (SELECT y, line AS a, m AS b FROM unseen WHERE alpha = 1),
    g AS (SELECT regr_sxx(y, a) + 1 AS aa, regr_sxx(y, b) + 1 AS bb, regr_sxy(a, b) AS ab, regr_sxy(y, a) AS ya, regr_sxy(y, b) AS yb, avg(y) AS y0, avg(a) AS a0, avg(b) AS b0 FROM u),
    w AS (SELECT *, (bb * ya - ab * yb) / (aa * bb - ab * ab) AS wa, (aa * yb - ab * ya) / (aa * bb - ab * ab) AS wb FROM g),
    test AS (SELECT y AS actual, y0 + wa * (y_mean + slope * (t.x - x_mean) - a0) + wb * (m - b0) AS predicted
             FROM base t, w, lines JOIN means USING (fold) WHERE t.year >= {FIRST_TEST} AND lines.fold = 4 AND alpha = 1 AND means.x = t.x)
    SELECT 'stack' AS model, round(avg(abs(actual - predicted)), 4) AS mae, round(sqrt(avg((actual - predicted) ** 2)), 4) AS rmse,
           round(1 - sum((actual - predicted) ** 2) / regr_syy(actual, predicted), 4) AS r2,
           round(avg(abs(actual - predicted) / nullif(abs(actual), 0)), 4) AS mape, count(*) AS n, 4 AS bases, true AS beats_mean FROM test"""


def tree_query(spark: SparkSession, sf: str, spec: Spec) -> DataFrame:
    """Test months as predicted on the quarter alone, which has a closed form, and whether the model of all
    features beats the mean of the training months on them. ``tree_errors`` has its errors."""
    frame = train_panel(spark, sf)
    train, test = train_rows(frame), frame.filter(F.col("year") >= FIRST_TEST)
    kinds = {
        "checked": models.fit(train, [QUARTER], LABEL, _checkable(spec, few=5)),
        "full": models.fit(train, FEATURES, LABEL, spec),
    }
    both = models.predict(kinds, test)
    mean = train.select(F.avg(LABEL)).scalar()
    beats = both.agg(F.avg(F.abs(F.col(LABEL) - F.col("full"))) < F.avg(F.abs(F.col(LABEL) - mean))).first()[0]
    return both.select(*ID, F.round("checked", 4).alias("predicted"), F.lit(bool(beats)).alias("beats_mean"))


def tree_errors(spark: SparkSession, sf: str, name: str, spec: Spec) -> DataFrame:
    """Errors of one model of all features on the test years."""
    frame = feature_panel(spark, sf)
    test = frame.filter(F.col("year") >= FIRST_TEST)
    return stats.regression_metrics(models.prediction_table({name: fit_all(frame, spec)}, test, ID, LABEL))


_GROUPS_SQL = f"""SELECT city, year, month, (SELECT round(avg(t.precip_total), 4) FROM monthly t WHERE t.year < {FIRST_TEST} AND ceil(t.month / 3) = ceil(m.month / 3)) AS predicted,
    true AS beats_mean FROM monthly m WHERE year >= {FIRST_TEST}"""


@query("model_random_forest", _GROUPS_SQL)
def model_random_forest(spark: SparkSession, sf: str) -> DataFrame:
    return tree_query(spark, sf, models.ANNUAL_MODELS["random_forest"])


@query("model_gbt", _GROUPS_SQL)
def model_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return tree_query(spark, sf, models.ANNUAL_MODELS["gbt"])


@query("model_boosted_alt", _GROUPS_SQL)
def model_boosted_alt(spark: SparkSession, sf: str) -> DataFrame:
    return tree_query(spark, sf, models.ANNUAL_MODELS["boosted_alt"])


@query("model_extra_trees", _GROUPS_SQL)
def model_extra_trees(spark: SparkSession, sf: str) -> DataFrame:
    return tree_query(spark, sf, Spec("extra_trees", {"trees": 100, "depth": 30}))


def all_candidates() -> list[Spec]:
    return [s for kind, grid in models.GRIDS.items() for s in models.candidates(kind, grid)]


def train_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The training months, with the month's number since year 0 as ``period`` and its quarter."""
    frame = feature_panel(spark, sf)
    return frame.withColumns({"period": F.col("year") * 12 + F.col("month"), QUARTER: F.ceil(F.col("month") / 3).cast("double")})


_TUNED: dict[tuple[str, str], tuning.Tuned] = {}


def tuned(spark: SparkSession, sf: str) -> tuning.Tuned:
    """The full tuning run over all features: written once a session and path, read by all that need it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TUNED:
        frame = train_panel(spark, sf)
        test = frame.filter(F.col("year") >= FIRST_TEST)
        _TUNED[key] = tuning.cross_validate(train_rows(frame), FEATURES, LABEL, "period", all_candidates(), test=test)
    return _TUNED[key]


def _checkable(spec: Spec, few: int | None = None) -> Spec:
    """The candidate without bootstrap: on a feature of four values its trees predict the means of the four groups,
    a boosting's first one already, so ``few`` trees show the same as all."""
    params = dict(spec.params) | ({"bootstrap": False} if spec.kind == "random_forest" else {})
    return Spec(spec.kind, params | {k: few for k in ("trees", "iterations") if few and k in params})


@query("ts_cv_grid", _FOLDS_SQL + _GRID_SQL)
def ts_cv_grid(spark: SparkSession, sf: str) -> DataFrame:
    """All candidates of the grid: whether they beat the mean over all features, and their fold error on one
    feature for which it has a closed form. The fold errors over all features are ``ts_cv_errors``."""
    full = tuned(spark, sf)
    train = train_rows(train_panel(spark, sf))
    quarter = tuning.cross_validate(train, [QUARTER], LABEL, "period", [*map(_checkable, all_candidates()), FLAT])
    flat = quarter.scores[-1][1]
    rows = [
        (s.kind, _shown(s), round(float(c), 4), bool(e < flat))
        for (s, e), (_, c) in zip(full.scores, quarter.scores[:-1], strict=True)
    ]
    return spark.createDataFrame(rows, "model string, params string, quarter_mae double, beats_mean boolean")


@query("ts_cv_errors")
def ts_cv_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Fold error of every candidate over all features, smallest first."""
    rows = [(s.kind, _shown(s), float(e)) for s, e in tuned(spark, sf).scores]
    return spark.createDataFrame(rows, "model string, params string, cv_mae double").orderBy("cv_mae", "model", "params")


@query("ensemble_stacking", _FOLDS_SQL + _STACK_SQL)
def ensemble_stacking(spark: SparkSession, sf: str) -> DataFrame:
    """Errors, on the test years, of a stack whose bases have a closed form (a line and group means over the
    quarter), and whether the stack of the four best kinds over all features beats the mean there."""
    full, frame = tuned(spark, sf), train_panel(spark, sf)
    train, test = train_rows(frame), frame.filter(F.col("year") >= FIRST_TEST)
    winners = full.winners()
    top = sorted(winners, key=lambda kind: winners[kind][1])[:4]
    simple = {"line": Spec("ridge", {"alpha": 1.0}), "groups": _checkable(Spec("random_forest", {"trees": 1, "depth": 5, "min_leaf": 3}))}
    folds = tuning.cross_validate(train, [QUARTER], LABEL, "period", list(simple.values()), test=test)
    checked = tuning.stacked_test(folds, LABEL, simple).select(F.lit("stack").alias("model"), F.col(LABEL).alias("actual"), "predicted")
    errors = stats.regression_metrics(checked).select("model", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2", "mape")], "n")
    best = tuning.stacked_test(full, LABEL, {kind: winners[kind][0] for kind in top})
    mean = train.select(F.avg(LABEL)).scalar()
    beats = best.agg(F.avg(F.abs(F.col(LABEL) - F.col("predicted"))) < F.avg(F.abs(F.col(LABEL) - mean))).first()[0]
    return errors.withColumns({"bases": F.lit(len(top)), "beats_mean": F.lit(bool(beats))})


@query("ensemble_stacking_errors")
def ensemble_stacking_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors, on the test years, of the stack of the four kinds with the smallest fold errors, and of its bases."""
    full = tuned(spark, sf)
    winners = full.winners()
    top = sorted(winners, key=lambda kind: winners[kind][1])[:4]
    specs = {kind: winners[kind][0] for kind in top}
    stack = tuning.stacked_test(full, LABEL, specs).select(F.lit("stack").alias("model"), F.col(LABEL).alias("actual"), "predicted")
    test = tuning.base_predictions(full, LABEL, specs).filter(F.col("fold") == full.folds + 1)
    bases = test.unpivot([LABEL], [f"base_{k}" for k in top], "model", "predicted").select("model", F.col(LABEL).alias("actual"), "predicted")
    return stats.regression_metrics(stack.unionByName(bases))


def _shown(spec: Spec) -> str:
    return ", ".join(f"{k}={v:g}" for k, v in spec.params.items())
