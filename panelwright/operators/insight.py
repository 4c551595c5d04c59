"""Per-security insight tables, for all securities in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.columns import KEY, TIME, ratio
from panelwright.operators.grid import melt
from panelwright.operators.models import THEMES, contributions_long, group_factors
from panelwright.operators.picks import latest, stable_sample, top_n, top_with_other


def _themes_long(df: DataFrame, keys: list[str]) -> DataFrame:
    return melt(df, keys, [c for c in df.columns if c not in keys], "theme", "value")


def attribution_summary(attribution: DataFrame, themes: dict = THEMES) -> DataFrame:
    """Signed theme attribution in percent, latest and historical mean, per security."""
    long = _themes_long(group_factors(attribution, themes, absolute=False), [TIME, KEY])
    return long.groupBy(KEY, "theme").agg(
        (F.max_by("value", TIME) * 100).alias("current"), (F.avg("value") * 100).alias("historical")
    )


def _shares(grouped: DataFrame, keys: list[str]) -> DataFrame:
    themes = [c for c in grouped.columns if c not in keys]
    whole = sum((F.col(t) for t in themes), F.lit(0.0))
    return grouped.withColumns({t: ratio(t, whole) for t in themes})


def contribution_shares(attribution: DataFrame, master: DataFrame, themes: dict = THEMES, id_col: str = "dcm_security_id") -> DataFrame:
    """Share of each theme in percent, latest and mean, for the security and for its sector."""
    mine = _themes_long(_shares(group_factors(attribution, themes), [TIME, KEY]), [TIME, KEY])
    own = mine.groupBy(KEY, "theme").agg((F.max_by("value", TIME) * 100).alias("current"), (F.avg("value") * 100).alias("historical"))
    cols = [c for c in attribution.columns if c not in (TIME, KEY)]
    sectors = attribution.join(master.select(F.col(id_col).alias(KEY), "Sector"), KEY)
    summed = sectors.groupBy(TIME, "Sector").agg(*[F.sum(c).alias(c) for c in cols])
    parts = []
    for theme, names in themes.items():
        have = [F.coalesce(F.abs(n), F.lit(0.0)) for n in names if n in cols]
        parts.append(sum(have, F.lit(0.0)).alias(theme))
    grouped = _shares(summed.select(TIME, "Sector", *parts), [TIME, "Sector"])
    sector = _themes_long(grouped, [TIME, "Sector"]).groupBy("Sector", "theme").agg(
        (F.max_by("value", TIME) * 100).alias("sector_current"), (F.avg("value") * 100).alias("sector_historical")
    )
    named = own.join(master.select(F.col(id_col).alias(KEY), "Sector"), KEY)
    return named.join(sector, ["Sector", "theme"])


def comparables(signals: DataFrame, master: DataFrame, top: int = 4, frac: float = 0.5, seed: int = 0, id_col: str = "dcm_security_id") -> DataFrame:
    """Half of the top-signal securities of each sector on the latest date."""
    now = latest(signals).where(F.col("ensemble_qt") == top).select(KEY)
    side = master.select(F.col(id_col).alias(KEY), F.col("ticker").alias("name"), "Sector")
    return stable_sample(now.join(side, KEY), frac, KEY, ["Sector"], seed)


def raw_summary(attribution: DataFrame, panel: DataFrame, themes: dict = THEMES, n: int = 3) -> DataFrame:
    """Top features per security and theme on the last day, with the raw value of the row before and the sign."""
    long = contributions_long(attribution, themes).withColumn("value", F.coalesce("value", F.lit(0.0)))
    last = latest(long, [KEY])
    top = top_n(last, [KEY, "theme"], [F.desc(F.abs("value")), F.col("feature")], n, "rank")
    back = Window.partitionBy(KEY).orderBy(F.desc(TIME))
    second = panel.withColumn("_rn", F.row_number().over(back)).where("_rn = 2").drop("_rn", TIME)
    raw = melt(second, [KEY], [c for c in second.columns if c != KEY], "feature", "raw_value")
    joined = top.join(raw, [KEY, "feature"], "left")
    return joined.select(
        KEY, "theme", "feature", "rank",
        F.bround(F.coalesce("raw_value", F.lit(0.0)), 3).alias("raw_value"),
        F.when(F.col("value") >= 0, "positive").otherwise("negative").alias("sign"),
    )


def overview(signals: DataFrame, q: int = 5) -> DataFrame:
    """Present signal, its past occurrences and the bull / bear hit ratios per security."""
    now = signals.groupBy(KEY).agg(F.max_by("ensemble_qt", TIME).alias("current_signal"))
    joined = signals.join(now, KEY)
    top, low = F.col("ensemble_qt") == q - 1, F.col("ensemble_qt") == 0
    up, down = F.col("future_ret_5B") > 0, F.col("future_ret_5B") < 0
    return joined.groupBy(KEY, "current_signal").agg(
        (F.avg(F.when(top, F.when(up, 1.0).otherwise(0.0))) * 100).alias("hit_ratio_bull"),
        (F.avg(F.when(low, F.when(down, 1.0).otherwise(0.0))) * 100).alias("hit_ratio_bear"),
        F.count(F.when(F.col("ensemble_qt") == F.col("current_signal"), 1)).alias("past_occurrences"),
    )


def waterfall(attribution: DataFrame, themes: dict = THEMES, n: int = 9) -> DataFrame:
    """Ordered contributions per security and theme on the last day, in percent, the rest in one row."""
    last = latest(contributions_long(attribution, themes), [KEY])
    scaled = last.withColumn("value", F.col("value") * 100)
    return top_with_other(scaled, [KEY, "theme"], "feature", "value", n)


def share_history(attribution: DataFrame, themes: dict = THEMES, n: int = 9) -> DataFrame:
    """Size of contributions per security, theme and date, in percent; small features in one column."""
    long = contributions_long(attribution, themes).withColumn("value", F.abs("value") * 100)
    sizes = long.groupBy(KEY, "theme", "feature").agg(F.sum("value").alias("_size"))
    order = Window.partitionBy(KEY, "theme").orderBy(F.desc("_size"), "feature")
    ranked = sizes.withColumn("_rk", F.row_number().over(order))
    others = F.count(F.when(F.col("_rk") > n, 1)).over(Window.partitionBy(KEY, "theme"))
    labels = ranked.withColumn("_others", others).select(
        KEY, "theme", "feature",
        F.when(F.col("_rk") <= n, F.col("feature"))
        .otherwise(F.concat(F.col("_others").cast("string"), F.lit(" other features")))
        .alias("label"),
    )
    return long.join(labels, [KEY, "theme", "feature"]).groupBy(TIME, KEY, "theme", "label").agg(F.sum("value").alias("value"))
