"""Grouped counts, rates, profiles, histograms and densities.

All of them are partial aggregates: rows combine before the shuffle, so a hot group is cheap.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions.expressions import as_col, correlation, format_pattern, late_flag, parse_number
from tablework.operators.joins import full_outer_by_key, with_total
from tablework.operators.quantiles import exact_quantiles


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def group_means(df: DataFrame, by: Sequence[str], cols: Sequence[str], digits: int | None = None) -> DataFrame:
    def mean(c: str) -> Column:
        return (F.avg(c) if digits is None else F.round(F.avg(c), digits)).alias(f"avg_{c}")

    return df.groupBy(*by).agg(*[mean(c) for c in cols])


def distinct_counts(df: DataFrame, by: Sequence[str], exprs: Mapping[str, str | Column | Sequence]) -> DataFrame:
    """Several distinct counts per group; a list of columns counts distinct tuples."""
    aggs = []
    for out, e in exprs.items():
        parts = e if isinstance(e, (list, tuple)) else [e]
        aggs.append(F.count_distinct(*[as_col(p) for p in parts]).alias(out))
    return df.groupBy(*by).agg(*aggs)


def price_stats(df: DataFrame, date: str | Column, cols: Mapping[str, str], out_date: str = "forecast_date") -> DataFrame:
    """Exact median and mean per date; ``cols`` maps a column to the prefix of its results."""
    data = df.select(as_col(date).alias(out_date), *cols)
    stats = exact_quantiles(data, [out_date], list(cols), [0.5])
    aggs = []
    for c, prefix in cols.items():
        mine = F.col("_col") == c
        aggs.append(F.max(F.when(mine, F.col("q0"))).alias(f"{prefix}_median"))
        aggs.append(F.max(F.when(mine, F.col("mean"))).alias(f"{prefix}_average"))
    return stats.groupBy(out_date).agg(*aggs)


def energy_prices_daily(electricity: DataFrame, gas: DataFrame) -> DataFrame:
    """Daily price table: electricity and gas statistics side by side, days of either."""
    e = price_stats(electricity, F.to_date("forecast_date"), {"euros_per_mwh": "electricity_price_per_mwh"})
    g = price_stats(
        gas,
        F.to_date("forecast_date"),
        {"lowest_price_per_mwh": "gas_lowest_price_per_mwh", "highest_price_per_mwh": "gas_highest_price_per_mwh"},
    )
    return full_outer_by_key(e, g, ["forecast_date"])


def consumption_production(df: DataFrame, how: str = "inner") -> DataFrame:
    """Daily consumed, produced and net amounts in one pass.

    ``how="inner"`` keeps days with rows on both sides, ``"full"`` days of either.
    """
    used, made = F.col("is_consumption") == 1, F.col("is_consumption") == 0
    daily = (
        df.select(F.to_date("datetime").alias("date"), "target", "is_consumption")
        .where(F.col("date").isNotNull())
        .groupBy("date")
        .agg(
            F.sum(F.when(used, F.col("target"))).alias("total_consumption_amt"),
            F.sum(F.when(made, F.col("target"))).alias("total_production_amt"),
            F.count_if(used).alias("_used"),
            F.count_if(made).alias("_made"),
        )
    )
    both = (F.col("_used") > 0) & (F.col("_made") > 0)
    either = (F.col("_used") > 0) | (F.col("_made") > 0)
    net = F.col("total_production_amt") - F.col("total_consumption_amt")
    return daily.where(both if how == "inner" else either).select(
        "date", "total_consumption_amt", "total_production_amt", net.alias("net_amt")
    )


def delay_rates(df: DataFrame, *by: str, min_sample: int | None = None) -> DataFrame:
    """Cancel, late and on-time rate per group; cancelled flights have no delay and do not count as late.

    With ``min_sample`` only groups above that size and with a defined late rate stay.
    """
    # The flag is a column of its own: inside the aggregate the cast would run once per use.
    is_text = dict(df.dtypes)["ArrDelay"] == "string"
    delay = parse_number("ArrDelay", "int") if is_text else F.col("ArrDelay")
    flagged = df.select(*by, "Cancelled", late_flag(delay).alias("_late"))
    late_rate = F.try_divide(F.count_if("_late"), F.count("_late"))
    out = flagged.groupBy(*by).agg(
        F.try_divide(F.sum("Cancelled"), F.count(F.lit(1))).alias("cancel_rate"),
        late_rate.alias("late_rate"),
        (1 - late_rate).alias("on_time_rate"),
        F.count(F.lit(1)).alias("sample"),
    )
    if min_sample is not None:
        # Null group values drop as well, as any-null rows of the finished table do.
        out = out.where(F.col("sample") > min_sample).na.drop("any")
    return out


def constant_raters(df: DataFrame, by: Sequence[str], min_n: int = 10, item: str = "Movie_ID", score: str = "Rating") -> DataFrame:
    """Groups with more than ``min_n`` ratings that all have the same score."""
    return (
        df.groupBy(*by)
        .agg(F.count(item).alias("num_movies"), F.min(score).alias("_lo"), F.max(score).alias("_hi"))
        .where((F.col("num_movies") > min_n) & (F.col("_lo") == F.col("_hi")))
        .select(*by, "num_movies", F.lit(1).cast("long").alias("unique_ratings"))
    )


def item_means(df: DataFrame, item: str = "Movie_ID", score: str = "Rating", min_n: int = 15) -> DataFrame:
    return (
        df.groupBy(item)
        .agg(F.avg(score).alias("average_rating"), F.count(score).alias("num_ratings"))
        .where(F.col("num_ratings") > min_n)
    )


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return value_counts(df, *keys).where(F.col("count") > 1)


def key_uniques(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return value_counts(df, *keys).where(F.col("count") == 1)


def _per_column(df: DataFrame, cols: Sequence[str], stats: Mapping[str, object]) -> DataFrame:
    """Evaluate aggregates for all columns in one pass and turn the single row into one row per column."""
    one = df.agg(*[F.struct(*[fn(c).alias(s) for s, fn in stats.items()]).alias(f"_s{i}") for i, c in enumerate(cols)])
    items = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"_s{i}")[s].alias(s) for s in stats]) for i, c in enumerate(cols)
    ]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column, one row per column."""
    return _per_column(df, df.columns, {"null_count": lambda c: F.count_if(F.col(c).isNull())})


def fill_rates(df: DataFrame) -> DataFrame:
    """Share of non-null values per column."""
    return _per_column(
        df, df.columns, {"fill_rate": lambda c: F.try_divide(F.count(F.col(c)), F.count(F.lit(1)))}
    )


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: count, nulls, mean, sample deviation, min, exact quartiles, max."""
    q = exact_quantiles(df, [], cols, [0.25, 0.5, 0.75])
    return q.select(
        F.col("_col").alias("column_name"),
        F.col("n").alias("count"),
        (F.col("n_rows") - F.col("n")).alias("nulls"),
        "mean",
        "stddev",
        "min",
        F.col("q0").alias("p25"),
        F.col("q1").alias("p50"),
        F.col("q2").alias("p75"),
        "max",
    )


def profile_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column of any type: count, nulls, distinct values, the most frequent one and how often it is there, first and last.

    Values are counted column by column: a scan reads that column alone and its counts combine before the
    shuffle, so rows are never multiplied by columns and a frequent value costs one row per task. Of
    equally frequent values the lowest is named; all values are given as text.
    """
    out = None
    for c in cols or df.columns:
        counts = df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        known = F.col("value").isNotNull()
        # the most frequent and, of these, the lowest: a maximum of counts cannot prefer low values, a minimum of negated ones can
        best = F.min(F.when(known, F.struct((-F.col("n")).alias("minus"), F.col("value").alias("value"))))
        row = counts.agg(
            F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"),
            F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("n_distinct"),
            best.alias("best"),
            F.min("value").cast("string").alias("first"),
            F.max("value").cast("string").alias("last"),
        )
        row = row.select(F.lit(c).alias("column_name"), "count", "nulls", "n_distinct", F.col("best.value").cast("string").alias("top"), (-F.col("best.minus")).alias("freq"), "first", "last")
        out = row if out is None else out.unionByName(row)
    return out


def _grand_total(counts: DataFrame) -> DataFrame:
    """The total from the group counts: their shuffle is reused, the rows are not read again."""
    return counts.agg(F.sum("count").alias("total"))


def class_balance(df: DataFrame, col: str) -> DataFrame:
    counts = value_counts(df, col)
    return with_total(counts, _grand_total(counts)).select(
        col, "count", (F.lit(100.0) * F.try_divide(F.col("count"), F.col("total"))).alias("percent")
    )


def share_of_total(df: DataFrame, by: str, digits: int = 2) -> DataFrame:
    """Count per group, its share of all rows with a value, and the count in thousands as text."""
    counts = value_counts(df.where(F.col(by).isNotNull()), by)
    return with_total(counts, _grand_total(counts)).select(
        by,
        "count",
        "total",
        F.round(F.try_divide(F.col("count"), F.col("total")), digits).alias("share"),
        format_pattern(F.col("count") / 1000, ",### K").alias("count_text"),
    )


def bucket_counts(df: DataFrame, bucket: Column, name: str = "bucket") -> DataFrame:
    return df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("total_within_range"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def file_shape(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Row and column count of a frame and the octets of the data files (of any format) that it was read from."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files, octets = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True), 0
    while files.hasNext():
        status = files.next()
        octets += 0 if status.getPath().getName().startswith(("_", ".")) else status.getLen()
    return shape(df).withColumn("n_octets", F.lit(octets).cast("long"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin holds the maximum; empty bins are listed.

    When all values are equal the range is widened by 0.5 on both sides.
    """
    data = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    limits = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    same = F.col("lo") == F.col("hi")
    limits = limits.select(
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    placed = with_total(data, limits)
    pos = F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))).cast("int")
    counts = placed.groupBy(F.least(pos, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = limits.where(F.col("lo").isNotNull()).select(
        "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("count"),
    )


def density(
    df: DataFrame, col: str, points: Sequence[float], bandwidth: float, below: float | None = None
) -> DataFrame:
    """Gaussian density of a column at the given points.

    Rows shrink to value counts first; each value then meets the fixed list of points and is added
    up per point before the shuffle.
    """
    data = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    if below is not None:
        data = data.where(F.col("v") < below)
    counts = data.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    z = (F.col("v") - F.col("x")) / bandwidth
    norm = bandwidth * math.sqrt(2.0 * math.pi)
    return (
        counts.select("v", "w", F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("x"))
        .groupBy("x")
        .agg((F.sum(F.col("w") * F.exp(-0.5 * z * z)) / (F.sum("w") * norm)).alias("density"))
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs (a <= b) in one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[correlation(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    items = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)
    ]
    return one.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def latest(df: DataFrame, col: str, n: int) -> DataFrame:
    return df.orderBy(F.col(col).desc()).limit(n)


def sort_rows(df: DataFrame, cols: Sequence[str | Column], tie_break: Sequence[str] = ()) -> DataFrame:
    """Full sort. Tie-break columns also spread a hot sort value over several ranges."""
    return df.orderBy(*cols, *tie_break)
