"""Scans: tables by path, and the assembly of price, filing, index and macro inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.columns import KEY, TIME, ffill
from panelwright.operators.joins import lookup, restrict_to
from panelwright.operators.picks import top_n
from panelwright.operators.sizes import require_day


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    format: str = "parquet",
    nan_missing: bool = True,
    **options: str,
) -> DataFrame:
    """Table or file glob; text formats need a schema, so that no pass is spent on guessing it.

    NaN in a number column is read as missing.  ``nan_missing=False`` keeps it, and
    lets filters on such columns reach the files.
    """
    reader = spark.read.format(format)
    if format == "csv":
        options = {"header": "true", **options}
    if format in ("csv", "json") and schema is None:
        raise ValueError(f"reading {format} needs a schema")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path if isinstance(path, str) else list(path))
    return nan_as_null(df) if nan_missing else df


def nan_as_null(df: DataFrame) -> DataFrame:
    """Floating-point columns with NaN as null; the other columns stay as they are."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def read_strategy(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Strategy file; an empty file is an error."""
    df = read_table(spark, path, schema, "csv")
    if df.isEmpty():
        raise ValueError(f"no content at {path}")
    return df


def lineage(df: DataFrame) -> list[str]:
    """Files a frame reads."""
    return sorted(df.inputFiles())


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def security_master(raw: DataFrame, index_col: str | None = None, id_col: str = "dcm_security_id") -> DataFrame:
    """Master without its index column and with integer ids."""
    out = raw.drop(index_col) if index_col else raw
    return out.withColumn(id_col, F.col(id_col).cast("bigint"))


def append_rows(df: DataFrame, rows: Sequence[dict]) -> DataFrame:
    """Literal rows added below; columns they lack are null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [n for n in df.columns if any(n in row for row in rows)]
    schema = T.StructType([T.StructField(n, types[n]) for n in names])
    extra = df.sparkSession.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)
    return df.unionByName(extra, allowMissingColumns=True)


def transform_catalogue(raw: DataFrame, symbols: Sequence[str], code: int = 5) -> DataFrame:
    """Series catalogue plus close and volume rows for each symbol."""
    rows = [{"series": f"{s}_{kind}", "transform": code} for s in symbols for kind in ("close", "volume")]
    return append_rows(raw, rows)


def index_membership(wide: DataFrame, narrow: DataFrame, master: DataFrame, order: Sequence[str] = ("cusip",)) -> DataFrame:
    """Index weights with ids: lower-case names, empty weights as 0, last row per (date, ticker)."""
    wide = wide.toDF(*[c.lower() for c in wide.columns])
    narrow = narrow.toDF(*[c.lower() for c in narrow.columns])
    weights = [c for c in wide.columns if c.startswith("wt-")]
    joined = wide.fillna(0.0, weights).join(narrow, ["date", "cusip"], "left").distinct()
    known = restrict_to(joined, master, "dcm_security_id")
    return top_n(known, ["date", "ticker"], [F.desc(c) for c in order], 1)


def current_filings(
    raw: DataFrame,
    master: DataFrame,
    start: str,
    end: str,
    dimensions: Sequence[str] = ("ARQ", "ART"),
    ticker: str = "ticker",
    master_ticker: str = "quandl_ticker",
    filed: str = "datekey",
) -> DataFrame:
    """Filings of known securities in a date range, vendor ticker replaced by the id."""
    days = F.col(filed).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    kept = raw.where(days & F.col("dimension").isin(*dimensions))
    return lookup(kept, master, (ticker, master_ticker), "inner", ["dcm_security_id"]).drop(ticker)


def daily_prices(df: DataFrame, master: DataFrame, start: str, end: str, key: str = "ticker") -> DataFrame:
    """Bars strictly between two days for the securities of the master."""
    inside = (F.col("date") > F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date"))
    return restrict_to(df.where(inside), master, key)


def consolidate_bars(df: DataFrame, id_col: str = "dcm_security_id") -> DataFrame:
    """Distinct rows averaged per (ticker, date), rows without id dropped, the id as ticker."""
    values = [c for c in df.columns if c not in ("ticker", "date")]
    mean = df.distinct().groupBy("ticker", "date").agg(*[F.avg(c).alias(c) for c in values])
    known = mean.where(F.col(id_col).isNotNull()).drop("ticker")
    return known.withColumn("ticker", F.col(id_col).cast("bigint")).drop(id_col).withColumn("date", F.to_date("date"))


def current_version(
    df: DataFrame, start: str | Column, end: str | Column, end_col: str = "as_of_end", date: str = "date"
) -> DataFrame:
    """Rows in force, in [start, end)."""
    start, end = (F.lit(x).cast("date") if isinstance(x, str) else x for x in (start, end))
    return df.where(F.col(end_col).isNull() & (F.col(date) >= start) & (F.col(date) < end))


def assemble_symbols(
    df: DataFrame, symbols: Sequence[str], symbol: str = "symbol", order: Sequence[str] = (), close: str = "close", volume: str = "volume"
) -> DataFrame:
    """One row per day with ``<symbol>_close`` and ``<symbol>_volume`` of each symbol.

    The last value of a day counts, and days without one are filled forward.  Ticks
    are combined per (symbol, day) before the exchange; the fill sees one row a day.
    """
    require_day(df, TIME)
    at = F.struct(*(order or [TIME]))
    days = (
        df.where(F.col(symbol).isin(*symbols))
        .groupBy(symbol, TIME)
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in (close, volume)])
    )
    w = Window.partitionBy(symbol).orderBy(TIME).rowsBetween(Window.unboundedPreceding, 0)
    filled = days.select(symbol, TIME, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in (close, volume)])
    picks = [
        F.max(F.when(F.col(symbol) == s, F.col(c))).alias(f"{s}_{name}")
        for s in symbols
        for name, c in (("close", close), ("volume", volume))
    ]
    return filled.groupBy(TIME).agg(*picks)


def assemble_series(
    df: DataFrame,
    series: Sequence[str],
    alias: dict[str, str] | None = None,
    calendar: DataFrame | None = None,
    required: Sequence[str] = (),
    start: str | None = None,
    end: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Macro table: one column per series, last value per day, trading days only, filled forward.

    ``alias`` maps source ids to model names.  One row per calendar day, so the
    ordered fill over the whole table stays within that bound.
    """
    if alias:
        pairs = F.create_map(*[F.lit(x) for kv in alias.items() for x in kv])
        df = df.withColumn("series", F.coalesce(pairs[F.col("series")], F.col("series")))
    if start is not None:
        df = df.where(F.col(TIME) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(TIME) <= F.lit(end).cast("date"))
    at = F.struct(TIME, *order)
    wide = df.groupBy(TIME).agg(
        *[
            F.max_by(F.when(F.col("series") == s, F.col("value")), F.when(F.col("series") == s, at)).alias(s)
            for s in series
        ]
    )
    if calendar is not None:
        wide = wide.join(F.broadcast(calendar.where("is_open").select(TIME)), TIME, "left_semi")
    require_columns(wide, required)
    w = Window.orderBy(TIME).rowsBetween(Window.unboundedPreceding, 0)
    return wide.select(TIME, *[F.last(s, ignorenulls=True).over(w).alias(s) for s in series])


def symbol_returns(prices: DataFrame, ticker, end: str | None = None, close: str = "close", key: str = KEY) -> DataFrame:
    """Daily returns of one security, rows without a value dropped."""
    rows = prices.where(F.col(key) == ticker)
    if end is not None:
        rows = rows.where(F.col(TIME) < F.lit(end).cast("date"))
    filled = rows.withColumn("_c", ffill(close, None, key))
    w = Window.partitionBy(key).orderBy(TIME)
    return filled.withColumn("ret_1B", F.try_divide("_c", F.lag("_c").over(w)) - 1).drop("_c").dropna()
