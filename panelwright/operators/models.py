"""Panel regressions with Spark ML, ensembles, and linear attribution as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME
from panelwright.operators.crosssec import insample
from panelwright.operators.grid import melt, numbered_days
from panelwright.operators.joins import replace_by
from panelwright.operators.order_stats import avg_ranks, qcut
from panelwright.operators.sizes import CALENDAR_DAYS, attach
from panelwright.session import durable

# Settings of the estimators.
SEED = 12345
FOREST = {"numTrees": 500, "maxDepth": 10}
BOOSTING = {"maxIter": 700, "stepSize": 0.005, "maxDepth": 6}


def estimator(algo: str, target: str, features: str = "features", **params):
    common = {"featuresCol": features, "labelCol": target, "predictionCol": algo}
    if algo == "ols":
        return LinearRegression(**common, **params)
    if algo == "lasso":
        return LinearRegression(**common, **{"elasticNetParam": 1.0, "regParam": 0.001, **params})
    if algo == "enet":
        return LinearRegression(**common, **{"elasticNetParam": 0.5, "regParam": 0.001, **params})
    if algo == "rf":
        return RandomForestRegressor(**common, **{"seed": SEED, "minInstancesPerNode": 1, **FOREST, **params})
    if algo == "gbm":
        return GBTRegressor(**common, **{"seed": SEED, **BOOSTING, **params})
    raise ValueError(f"unknown estimator {algo!r}")


def fit(
    df: DataFrame, features: Sequence[str], target: str, algo: str, fold_col: str | None = None,
    grid: dict[str, Sequence] | None = None, **params,
) -> Model:
    """Fit one estimator; with a grid, folds given by ``fold_col`` choose its setting."""
    # an estimator reads its rows several times: the columns it takes are written once
    wanted = dict.fromkeys([*features, target, *([fold_col] if fold_col else [])])
    rows = durable(df.select(*[F.col(f"`{c}`") for c in wanted]).fillna(0.0, [*features, target]))
    learner = estimator(algo, target, **params)
    if grid:
        builder = ParamGridBuilder()
        for name, values in grid.items():
            builder = builder.addGrid(learner.getParam(name), list(values))
        score = RegressionEvaluator(labelCol=target, predictionCol=algo, metricName="r2")
        folds = rows.select(fold_col).distinct().count() if fold_col else 5
        learner = CrossValidator(
            estimator=learner, estimatorParamMaps=builder.build(), evaluator=score, numFolds=folds, foldCol=fold_col or "",
            seed=SEED,
        )
    stages = [VectorAssembler(inputCols=list(features), outputCol="features"), learner]
    return Pipeline(stages=stages).fit(rows)


def fold_scores(df: DataFrame, features: Sequence[str], target: str, algo: str, fold_col: str = "fold_id", **params) -> DataFrame:
    """R2 of the model fitted on all rows, per fold."""
    scored = predict({algo: fit(df, features, target, algo, **params)}, df, features, keep=[target, fold_col])
    stats = scored.groupBy(fold_col).agg(
        F.sum((F.col(target) - F.col(algo)) ** 2).alias("_res"),
        (F.var_pop(target) * F.count(target)).alias("_tot"),
    )
    return stats.select(fold_col, (1 - F.try_divide("_res", "_tot")).alias("r2"))


def hold_out_last(df: DataFrame, fold_col: str = "fold_id") -> tuple[DataFrame, DataFrame]:
    last = df.agg(F.max(fold_col)).scalar()
    return df.where(F.col(fold_col) < last), df.where(F.col(fold_col) == last)


def predict(models: dict[str, Model], df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One prediction column per model."""
    out = df.fillna(0.0, list(features))
    for model in models.values():
        out = model.transform(out).drop("features")
    return out.select(TIME, KEY, *keep, *models)


def fit_rolling(
    df: DataFrame, periods: Sequence[tuple[int, int]], algos: Sequence[str], features: Sequence[str], target: str,
    path: str | None = None, mode: str = "full_train", n_dates: int = 106, **params,
) -> dict[str, dict[str, Model]]:
    """Models per (year, month), each on the dates up to the first date of that month.

    ``load`` reads saved models, ``full_train`` fits and saves all, ``append``
    fits only the periods that are not saved yet.
    """
    from pyspark.ml import PipelineModel

    out: dict[str, dict[str, Model]] = {}
    for year, month in periods:
        key = f"{year:04d}-{month:02d}"
        out[key] = {}
        rows = None
        for algo in algos:
            place = f"{path}/model_date={key}/algo={algo}" if path else None
            if mode in ("load", "append") and place:
                try:
                    out[key][algo] = PipelineModel.load(place)
                    continue
                except Exception as error:  # only a model that is not there is fitted anew
                    if mode == "load" or "not exist" not in str(error):
                        raise
            if rows is None:
                rows = durable(insample(df, year, month, n_dates))
            out[key][algo] = fit(rows, features, target, algo, **params)
            if place:
                out[key][algo].write().overwrite().save(place)
    return out


def ensemble(predictions: DataFrame, weights: dict[str, float], returns: DataFrame | None = None) -> DataFrame:
    """Percent rank per date of each prediction and of their weighted sum, with the return attached."""
    blend = sum((F.col(a) * w for a, w in weights.items()), F.lit(0.0))
    both = predictions.select(TIME, KEY, *weights, blend.alias("ensemble"))
    ranks = avg_ranks(both, [*weights, "ensemble"], [TIME, KEY], [TIME], pct=True)
    if returns is None:
        return ranks
    rets = [c for c in returns.columns if c not in (TIME, KEY)]
    return ranks.join(returns, [TIME, KEY], "left").fillna(0.0, rets)


def merge_signals(df: DataFrame, signals: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Signals joined to the panel without the columns it already has."""
    return df.join(signals.drop(*drop), [TIME, KEY], "left")


def final_predictions(signals: DataFrame, master: DataFrame, after: str, id_col: str = "dcm_security_id") -> DataFrame:
    """Quintile per date, ticker names for ids, rows after a day."""
    ranked = qcut(signals, "ensemble", 5, [TIME])
    late = ranked.where(F.col(TIME) > F.lit(after).cast("date"))
    named = replace_by(late, KEY, master, id_col, "ticker")
    return named.select(TIME, KEY, F.col("ensemble_qt").alias("cross_sectional_rank"), "future_ret_5B")


def linear_attribution(df: DataFrame, coefficients: dict[str, float]) -> DataFrame:
    """Contribution of each feature to a linear score: coefficient x (value - mean)."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefficients]).alias("m")).scalar()
    framed = df.withColumn("_m", means)
    return framed.withColumns({c: F.lit(float(b)) * (F.col(c) - F.col(f"_m.{c}")) for c, b in coefficients.items()}).drop("_m")


def model_coefficients(model: Model, features: Sequence[str]) -> dict[str, float]:
    return dict(zip(features, (float(b) for b in model.stages[-1].coefficients)))


def blend_attribution(parts: dict[str, DataFrame], weights: dict[str, float], features: Sequence[str]) -> DataFrame:
    """Weighted sum of per-model contributions (wide frames on date and security)."""
    weighted = None
    for name, df in parts.items():
        rows = df.select(TIME, KEY, *[(F.coalesce(F.col(f), F.lit(0.0)) * weights[name]).alias(f) for f in features])
        weighted = rows if weighted is None else weighted.unionByName(rows)
    return weighted.groupBy(TIME, KEY).agg(*[F.sum(f).alias(f) for f in features])


def unfold_upstream(
    blended: DataFrame, upstream: dict[str, DataFrame], stacked: Sequence[str] = ("rf", "gbm"), overall: str = "ensemble"
) -> DataFrame:
    """Contributions of upstream model scores spread over the upstream models' own features.

    ``blended`` has a column per upstream score; each is replaced by its last
    row's value times that model's contributions, and ``overall`` scales their
    sum once more.  Features the panel already has are not taken twice.
    """
    stacked = [s for s in stacked if s in upstream]
    names = [c for c in upstream[stacked[0]].columns if c not in (TIME, KEY)]
    ends = blended.agg(F.max_by(F.struct(*stacked, overall), F.struct(TIME, KEY)).alias("w")).scalar()
    parts = None
    for s in stacked:
        rows = upstream[s].select(TIME, KEY, F.lit(s).alias("_m"), *names)
        parts = rows if parts is None else parts.unionByName(rows)
    factor = F.coalesce(*[F.when(F.col("_m") == s, F.col(f"_w.{s}")) for s in stacked])
    scaled = parts.withColumn("_w", ends)
    spread = scaled.groupBy(TIME, KEY).agg(
        *[F.sum(F.col(n) * factor * (1 + F.col(f"_w.{overall}"))).alias(n) for n in names]
    )
    base = blended.drop(*stacked, overall, *[n for n in names if n in blended.columns])
    return base.join(spread, [TIME, KEY], "left").fillna(0.0, names)


def model_segments(df: DataFrame, model_dates: Sequence[str], out: str = "model_date") -> DataFrame:
    """The model date whose [date, next date) holds each row; earlier rows take the first model."""
    days = sorted(model_dates)
    pick = F.lit(days[0])
    for day in days[1:]:
        pick = F.when(F.col(TIME) >= F.lit(day).cast("date"), F.lit(day)).otherwise(pick)
    return df.withColumn(out, pick.cast("date"))


def predict_segments(sets: dict[str, dict[str, Model]], df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Each row scored by the models in force on its day, and by no others; ``sets`` is keyed by year and month."""
    placed, out = model_segments(df, [f"{key}-01" for key in sets]), None
    for key, models in sets.items():
        mine = placed.where(F.col("model_date") == F.lit(f"{key}-01").cast("date"))
        part = predict(models, mine, features, ["model_date"])
        out = part if out is None else out.unionByName(part)
    return out


# Features of each theme.
THEMES = {
    "Growth": ["revenue_growth", "grossmargin", "netmargin_indgrp", "netmargin", "capex_yield", "log_mktcap", "revenue_yield"],
    "Quality": ["currentratio", "fcf_yield", "debt2equity_indgrp", "debt2equity", "amihud", "current_to_total_assets", "retearn_to_total_assets"],
    "Macro": [
        "DCOILWTICO", "T5YFFM", "IPDCONGD", "DEXUSUK", "RPI", "USTRADE", "RETAILx", "AAAFFM", "GS10", "HWI", "GS5",
        "CUSR0000SAC", "CPFF", "CPITRNSL", "T10YFFM", "T1YFFM", "WPSID62", "CUSR0000SA0L2",
    ],
    "Momentum Fast": ["STOCHRSI_FASTK_63_15_10", "STOCHRSI_FASTD_14_5_3", "volatility_126_indgrp", "volatility_126", "volatility_21", "VIXCLS"],
    "Momentum Slow": [
        "ret_10B", "macd_diff_indgrp", "momentum", "ret_126B", "ret_1B", "WILLR_14", "macd_diff_ConsumerStaples",
        "macd_diff", "bm_Financials", "bm_Utilities", "bm_indgrp", "bm",
    ],
    "Trend Following": [
        "PPO_21_126", "ADX_14_MA_3", "PPO_12_26", "PPO_21_126_ConsumerDiscretionary", "PPO_3_14", "rel_to_high",
        "PPO_21_126_Industrials", "PPO_21_126_Energy", "PPO_21_126_InformationTechnology", "PPO_21_126_indgrp", "PPO_12_26_indgrp",
    ],
    "Value": [
        "pe1", "ebitdamargin", "investments_yield", "ebitda_to_ev_indgrp", "ebitda_to_ev", "pe_indgrp", "divyield_indgrp",
        "divyield_Industrials", "divyield", "gp2assets", "payoutratio", "divyield_ConsumerStaples",
    ],
    "Other Factors": [
        "std_turn", "EWJ_volume", "ret_63B_indgrp", "overnight_return", "EWG_close", "log_avg_dollar_volume", "ret_252B",
        "log_dollar_volume", "SPY_beta", "maxret", "SPY_close", "ret_63B", "ret_2B",
    ],
}


def theme_of(themes: dict[str, list[str]] = THEMES):
    """Column mapping a feature name to its theme."""
    pairs = [F.lit(x) for t, names in themes.items() for n in names for x in (n, t)]
    return F.create_map(*pairs)[F.col("feature")]


def group_factors(df: DataFrame, themes: dict[str, list[str]] = THEMES, absolute: bool = True) -> DataFrame:
    """Sum of contributions (or of their sizes) per theme, one column per theme."""
    out = []
    for theme, names in themes.items():
        have = [F.coalesce(F.abs(n) if absolute else F.col(n), F.lit(0.0)) for n in names if n in df.columns]
        out.append(sum(have, F.lit(0.0)).alias(theme))
    keys = [k for k in (TIME, KEY) if k in df.columns]
    return df.select(*keys, *out)


def contributions_long(df: DataFrame, themes: dict[str, list[str]] = THEMES) -> DataFrame:
    """Long contributions with their theme; features outside every theme are left out."""
    cols = [c for c in df.columns if c not in (TIME, KEY)]
    return melt(df, [TIME, KEY], cols).withColumn("theme", theme_of(themes)).where(F.col("theme").isNotNull())


def factor_returns(
    returns: DataFrame, weights: DataFrame, insample_end: str, same_date: bool = False, ret: str = "ret", weight: str = "weight"
) -> DataFrame:
    """Return of the weighted portfolio over the in-sample mean of the weight sums, and its lag.

    The weights of the last period apply to every date unless ``same_date``.
    Dates move down one row; gaps take the in-sample mean.
    """
    cut = F.lit(insample_end).cast("date")
    if same_date:
        joined = returns.join(weights.select(TIME, KEY, weight), [TIME, KEY])
    else:
        last = weights.agg(F.max(TIME)).scalar()
        joined = returns.join(weights.where(F.col(TIME) == last).select(KEY, weight), KEY)
    sums = joined.groupBy(TIME).agg(F.sum(F.coalesce(F.col(ret), F.lit(0.0)) * F.col(weight)).alias("_raw"))
    norm = weights.where(F.col(TIME) <= cut).groupBy(TIME).agg(F.sum(weight).alias("_w")).agg(F.avg("_w")).scalar()
    w = Window.orderBy(TIME)  # one row per date
    series = sums.select(TIME, F.lag(F.try_divide("_raw", norm)).over(w).alias("f_next"), F.row_number().over(w).alias("_rn"))
    both = series.withColumn("f_t", F.lag("f_next").over(w)).where("_rn > 1")
    means = {c: F.avg(F.when(F.col(TIME) <= cut, F.col(c))).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for c in ("f_t", "f_next")}
    return both.select(TIME, *[F.coalesce(F.col(c), m).alias(c) for c, m in means.items()])


def time_split(df: DataFrame, shares: Sequence[float] | None = (0.7, 0.1, 0.2), cut: str | None = None, out: str = "part") -> DataFrame:
    """train / valid / test by share of the dates, or train / test at a cut day."""
    if cut is not None:
        inside = F.col(TIME) <= F.lit(cut).cast("date")
        return df.withColumn(out, F.when(inside, "train").otherwise("test"))
    n_train = F.floor(F.col("_last") * F.lit(float(shares[0])))
    n_valid = F.floor(F.col("_last") * F.lit(float(shares[1])))
    days = numbered_days(df).select(
        TIME,
        F.when(F.col("_seq") <= n_train, "train").when(F.col("_seq") <= n_train + n_valid, "valid").otherwise("test").alias(out),
    )
    return attach(df, days, [TIME], max_rows=CALENDAR_DAYS)


def sequences(df: DataFrame, cols: Sequence[str], steps: int, time_limit: bool = True) -> DataFrame:
    """Windows of ``steps`` consecutive rows per security, as an array of structs.

    The last full window is left out, as only n - steps windows are built.
    """
    w = Window.partitionBy(KEY).orderBy(TIME)
    ahead = w.rowsBetween(0, steps - 1)
    framed = df.select(TIME, KEY, F.collect_list(F.struct(*cols)).over(ahead).alias("sequence"), F.lead(F.lit(1), steps).over(w).alias("_more"))
    full = F.size("sequence") == steps
    return framed.where(full & F.col("_more").isNotNull() if time_limit else full).drop("_more")
