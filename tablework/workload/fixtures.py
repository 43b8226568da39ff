"""Stand-in inputs derived from the given tables, once as DataFrames and once as SQL text.

Nulls and ``'NA'`` sentinels are placed by key, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY0 = "2024-01-01"


class Fixtures:
    """Lazy access to the tables of one scale-factor folder and to the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def readings(self) -> DataFrame:
        """Hourly meter readings; one target in 97 is missing."""
        e = self.table("events")
        return e.select(
            F.col("event_id").alias("row_id"),
            F.col("user_id").alias("prediction_unit_id"),
            (F.col("user_id") % 16).cast("int").alias("county"),
            (F.col("user_id") % 2).cast("int").alias("is_business"),
            (F.col("user_id") % 4).cast("int").alias("product_type"),
            F.when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(0).alias("is_consumption"),
            F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("target"),
            F.col("ts").alias("datetime"),
            F.datediff(F.to_date("ts"), F.lit(DAY0).cast("date")).alias("data_block_id"),
        )

    def electricity_prices(self) -> DataFrame:
        hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
        return (
            self.table("events")
            .groupBy(hour.alias("forecast_date"))
            .agg(F.round(F.avg("value"), 7).alias("euros_per_mwh"))
            .select(
                "forecast_date",
                "euros_per_mwh",
                (F.col("forecast_date") - F.expr("INTERVAL 1 DAY")).alias("origin_date"),
                F.datediff(F.to_date("forecast_date"), F.lit(DAY0).cast("date")).alias("data_block_id"),
            )
        )

    def gas_prices(self) -> DataFrame:
        """Daily prices, three days later than the readings so that outer joins have one-sided keys."""
        return (
            self.table("events")
            .groupBy(F.date_add(F.to_date("ts"), 3).alias("forecast_date"))
            .agg(F.min("value").alias("lowest_price_per_mwh"), F.max("value").alias("highest_price_per_mwh"))
            .select(
                "forecast_date",
                "lowest_price_per_mwh",
                "highest_price_per_mwh",
                F.date_sub("forecast_date", 1).alias("origin_date"),
                F.datediff("forecast_date", F.lit(DAY0).cast("date")).alias("data_block_id"),
            )
        )

    def client(self) -> DataFrame:
        return (
            self.table("events")
            .groupBy(
                (F.col("user_id") % 4).cast("int").alias("product_type"),
                (F.col("user_id") % 16).cast("int").alias("county"),
                (F.col("user_id") % 2).cast("int").alias("is_business"),
                F.date_add(F.to_date("ts"), 2).alias("date"),
            )
            .agg(
                F.count_distinct("user_id").alias("eic_count"),
                F.round(F.sum("value"), 4).alias("installed_capacity"),
            )
            .withColumn("data_block_id", F.datediff("date", F.lit(DAY0).cast("date")))
        )

    def historical_weather(self) -> DataFrame:
        """Hourly means at a grid of places, a day after the hour."""
        place = F.col("user_id")
        return (
            self.table("events")
            .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"), (place % 8 / 2).alias("latitude"), (place % 4 / 4).alias("longitude"))
            .agg(F.round(F.avg("value"), 7).alias("temperature"))
            .withColumn("data_block_id", F.datediff(F.to_date("datetime"), F.lit(DAY0).cast("date")) + 1)
        )

    def forecast_weather(self) -> DataFrame:
        """Of each day what was forecast for its hours; one temperature in 53 is missing."""
        place, hour = F.col("user_id"), F.hour("ts")
        origin = F.date_trunc("day", "ts").cast("timestamp_ntz")
        rows = self.table("events").groupBy((place % 8 / 2).alias("latitude"), (place % 4 / 4).alias("longitude"), origin.alias("origin_datetime"), hour.alias("hours_ahead"))
        return rows.agg(F.round(F.max("value"), 7).alias("top"), F.min("event_id").alias("first")).select(
            "latitude",
            "longitude",
            "origin_datetime",
            "hours_ahead",
            F.when(F.col("first") % 53 != 0, F.col("top")).alias("temperature"),
            F.datediff(F.to_date("origin_datetime"), F.lit(DAY0).cast("date")).alias("data_block_id"),
            (F.col("origin_datetime") + F.make_interval(hours="hours_ahead")).cast("timestamp_ntz").alias("forecast_datetime"),
        )

    def unscored(self) -> DataFrame:
        """The readings as a test set: without the target, with the time to predict."""
        return self.readings().drop("target").withColumnRenamed("datetime", "prediction_datetime")

    def flights(self) -> DataFrame:
        """Shipments as flights: the delay is text with ``'NA'`` for cancelled ones."""
        li, o, s, c = (self.table(t) for t in ("lineitem", "orders", "supplier", "customer"))
        cancelled = F.col("l_returnflag") == "R"
        delay = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("string")
        line = F.col("l_linenumber")
        return (
            li.join(o, li.l_orderkey == o.o_orderkey)
            .join(s, li.l_suppkey == s.s_suppkey)
            .join(c, o.o_custkey == c.c_custkey)
            .select(
                F.year("l_shipdate").alias("Year"),
                F.month("l_shipdate").alias("Month"),
                F.col("l_suppkey").alias("UniqueCarrier"),
                F.col("l_partkey").alias("TailNum"),
                F.col("s_nationkey").alias("Origin"),
                F.col("c_nationkey").alias("Dest"),
                F.when(cancelled, 1).otherwise(0).alias("Cancelled"),
                F.when(cancelled, "NA").otherwise(delay).alias("ArrDelay"),
                F.col("l_quantity").alias("AirTime"),
                F.col("l_extendedprice").alias("Distance"),
                F.col("l_tax").alias("TaxiIn"),
                F.col("l_discount").alias("TaxiOut"),
                F.when(line == 2, "NA").when(line > 2, line.cast("string")).alias("CarrierDelay"),
            )
        )

    def ratings(self) -> DataFrame:
        li, o, p = (self.table(t) for t in ("lineitem", "orders", "part"))
        return (
            li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .select(
                F.col("p_brand").alias("Movie_ID"),
                F.col("o_custkey").alias("User_ID"),
                (1 + (F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("int").alias("Rating"),
                F.to_date("o_orderdate").alias("Date"),
            )
        )

    def properties(self) -> DataFrame:
        p, size, key = self.table("part"), F.col("p_size"), F.col("p_partkey")

        def unless(divisor: int, value) -> F.Column:
            return F.when(size % divisor != 0, value)

        return p.select(
            key.alias("parcelid"),
            (2016 + key % 2).cast("int").alias("file_year"),
            unless(9, size % 12).alias("roomcnt"),
            unless(7, 1950 + size * 2).alias("yearbuilt"),
            unless(5, size * 10).alias("yardbuildingsqft17"),
            unless(11, size % 7).alias("unitcnt"),
            F.when(size % 3 == 0, 1).alias("poolcnt"),
            F.when(size % 8 == 0, 66).alias("decktypeid"),
            unless(13, size * 100).alias("lotsizesquarefeet"),
            (size * 10 - 100).alias("landtaxvaluedollarcnt"),
            F.col("p_retailprice").alias("taxvaluedollarcnt"),
            unless(6, (key % 25).cast("int")).alias("fips"),
            "p_brand",
            "p_type",
        )

    def houses(self) -> DataFrame:
        """Sales with price text, sizes and years; built years fall, renovation is often year 0."""
        li, p = self.table("lineitem"), self.table("part")
        return li.join(p, li.l_partkey == p.p_partkey).select(
            F.col("l_orderkey").alias("id"),
            F.col("l_linenumber").alias("line"),
            F.concat(F.lit(" $"), F.format_number(F.col("l_extendedprice"), 2)).alias("price"),
            F.col("l_extendedprice").alias("price_num"),
            F.col("p_size").alias("sqft_living"),
            F.col("l_quantity").alias("sqft_lot"),
            F.col("l_discount").alias("sqft_basement"),
            F.col("l_tax").alias("grade"),
            F.year("l_shipdate").alias("sold"),
            (F.lit(1950) + F.col("p_size")).alias("yr_built"),
            F.when(F.col("p_size") % 3 == 0, 1990).otherwise(0).alias("yr_renovated"),
        )

    def bronze_readings(self) -> DataFrame:
        """Readings with their load time; one row in ten was loaded twice."""
        r = self.readings()
        first = r.withColumn("process_timestamp", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
        again = r.where(F.col("row_id") % 10 == 0).withColumn(
            "process_timestamp", F.lit("2024-02-02 00:00:00").cast("timestamp_ntz")
        )
        return first.unionByName(again.withColumn("target", F.col("target") + 1))

    def scored(self) -> DataFrame:
        """Binary labels with a score, from the labelled documents."""
        d = self.table("documents").select("doc_id", "n_chars")
        return self.table("labels").join(d, "doc_id").select(
            "doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score")
        )


# The same views for the SQL engine that checks the results.
DUCK_VIEWS = {
    "readings": """
        SELECT event_id AS row_id, user_id AS prediction_unit_id, CAST(user_id % 16 AS INT) AS county,
          CAST(user_id % 2 AS INT) AS is_business, CAST(user_id % 4 AS INT) AS product_type,
          CASE WHEN event_type IN ('purchase','signup') THEN 1 ELSE 0 END AS is_consumption,
          CASE WHEN event_id % 97 <> 0 THEN value END AS target, ts AS datetime,
          CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS data_block_id FROM events""",
    "electricity_prices": """
        SELECT date_trunc('hour', ts) AS forecast_date, round(avg(value), 7) AS euros_per_mwh,
          date_trunc('hour', ts) - INTERVAL 1 DAY AS origin_date,
          CAST(date_diff('day', DATE '2024-01-01', CAST(min(ts) AS DATE)) AS INT) AS data_block_id
        FROM events GROUP BY date_trunc('hour', ts)""",
    "gas_prices": """
        SELECT CAST(CAST(ts AS DATE) + 3 AS DATE) AS forecast_date, min(value) AS lowest_price_per_mwh, max(value) AS highest_price_per_mwh,
          CAST(CAST(ts AS DATE) + 2 AS DATE) AS origin_date,
          CAST(date_diff('day', DATE '2024-01-01', CAST(min(ts) AS DATE)) + 3 AS INT) AS data_block_id
        FROM events GROUP BY CAST(ts AS DATE)""",
    "client": """
        SELECT CAST(user_id % 4 AS INT) AS product_type, CAST(user_id % 16 AS INT) AS county,
          CAST(user_id % 2 AS INT) AS is_business, CAST(CAST(ts AS DATE) + 2 AS DATE) AS date,
          count(DISTINCT user_id) AS eic_count, round(sum(value), 4) AS installed_capacity,
          CAST(date_diff('day', DATE '2024-01-01', CAST(min(ts) AS DATE)) + 2 AS INT) AS data_block_id
        FROM events GROUP BY 1, 2, 3, 4""",
    "flights": """
        SELECT CAST(year(l_shipdate) AS INT) AS Year, CAST(month(l_shipdate) AS INT) AS Month, l_suppkey AS UniqueCarrier,
          l_partkey AS TailNum, s_nationkey AS Origin, c_nationkey AS Dest,
          CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS Cancelled,
          CASE WHEN l_returnflag = 'R' THEN 'NA'
            ELSE CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS VARCHAR) END AS ArrDelay,
          l_quantity AS AirTime, l_extendedprice AS Distance, l_tax AS TaxiIn, l_discount AS TaxiOut,
          CASE WHEN l_linenumber = 2 THEN 'NA' WHEN l_linenumber > 2 THEN CAST(l_linenumber AS VARCHAR) END AS CarrierDelay
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
          JOIN customer ON o_custkey = c_custkey""",
    "ratings": """
        SELECT p_brand AS Movie_ID, o_custkey AS User_ID, CAST(1 + (l_orderkey + l_linenumber) % 5 AS INT) AS Rating,
          CAST(o_orderdate AS DATE) AS Date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "properties": """
        SELECT p_partkey AS parcelid, CAST(2016 + p_partkey % 2 AS INT) AS file_year,
          CASE WHEN p_size % 9 <> 0 THEN p_size % 12 END AS roomcnt,
          CASE WHEN p_size % 7 <> 0 THEN 1950 + p_size * 2 END AS yearbuilt,
          CASE WHEN p_size % 5 <> 0 THEN p_size * 10 END AS yardbuildingsqft17,
          CASE WHEN p_size % 11 <> 0 THEN p_size % 7 END AS unitcnt,
          CASE WHEN p_size % 3 = 0 THEN 1 END AS poolcnt, CASE WHEN p_size % 8 = 0 THEN 66 END AS decktypeid,
          CASE WHEN p_size % 13 <> 0 THEN p_size * 100 END AS lotsizesquarefeet,
          p_size * 10 - 100 AS landtaxvaluedollarcnt, p_retailprice AS taxvaluedollarcnt,
          CASE WHEN p_size % 6 <> 0 THEN CAST(p_partkey % 25 AS INT) END AS fips, p_brand, p_type FROM part""",
    "houses": """
        SELECT l_orderkey AS id, l_linenumber AS line, format(' ${:,.2f}', l_extendedprice) AS price,
          l_extendedprice AS price_num, p_size AS sqft_living, l_quantity AS sqft_lot, l_discount AS sqft_basement,
          l_tax AS grade, CAST(year(l_shipdate) AS INT) AS sold, 1950 + p_size AS yr_built,
          CASE WHEN p_size % 3 = 0 THEN 1990 ELSE 0 END AS yr_renovated
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "bronze_readings": """
        SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS process_timestamp FROM readings
        UNION ALL
        SELECT * REPLACE (target + 1 AS target), TIMESTAMP '2024-02-02 00:00:00' FROM readings WHERE row_id % 10 = 0""",
    "scored": """
        SELECT doc_id, quality AS label, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)""",
}


def duck_views(sql: str, views: tuple[str, ...]) -> str:
    """Put the named views in front of a SELECT (or of its own WITH list)."""
    if not views:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({DUCK_VIEWS[v].strip()})" for v in views)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
