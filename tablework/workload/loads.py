"""Queries over whole loads: bronze, silver and gold, each run more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework import schemas
from tablework.operators.merge import RANGE
from tablework.plans import medallion as ME
from tablework.plans import property as P
from tablework.session import fresh_database, scratch_dir
from tablework.sinks.tables import export_csv, write_table
from tablework.workload.fixtures import Fixtures
from tablework.workload.joins import GOLD_SQL, GOLD_VIEWS, rounded
from tablework.workload.registry import query
from tablework.workload.relational import today

SCHEMAS = {
    "train": schemas.READINGS,
    "client": schemas.CLIENT,
    "electricity_prices": schemas.ELECTRICITY_PRICES,
    "gas_prices": schemas.GAS_PRICES,
    "weather_station_to_county_mapping": schemas.WEATHER_STATIONS,
    "historical_weather": schemas.HISTORICAL_WEATHER,
    "forecast_weather": schemas.FORECAST_WEATHER,
    "test": schemas.UNSCORED,
}


def raw_files(fx: Fixtures, label: str) -> str:
    """The energy inputs as CSV, the way the loads find them."""
    folder = scratch_dir(fx.spark, label)
    for name, data in {
        "train": fx.readings(),
        "client": fx.client(),
        "electricity_prices": fx.electricity_prices(),
        "gas_prices": fx.gas_prices(),
        "weather_station_to_county_mapping": stations(fx),
    }.items():
        export_csv(data, f"{folder}/{name}.csv")
    return folder


def stations(fx: Fixtures) -> DataFrame:
    """One row per supplier; a third lack a county."""
    key = F.col("s_suppkey")
    return fx.table("supplier").select(
        F.when(key % 3 != 0, F.col("s_name")).alias("county_name"),
        (F.col("s_acctbal") / 100).alias("longitude"),
        (F.col("s_acctbal") / 200).alias("latitude"),
        F.col("s_nationkey").alias("county"),
    )


def loaded(fx: Fixtures, label: str, blocks: int) -> str:
    """Bronze in runs of some blocks each until no table has anything new."""
    db = fresh_database(fx.spark, label)
    folder = raw_files(fx, label)
    while any(x.startswith("blocks") for x in ME.load_bronze(fx.spark, folder, db, blocks, SCHEMAS).values()):
        pass
    return db


def load_layers(fx: Fixtures, db: str, folder: str, blocks: int) -> bool:
    """Bronze and silver of the next blocks; False, and silver as it was, if there are none."""
    if not any(x.startswith("blocks") for x in ME.load_bronze(fx.spark, folder, db, blocks, SCHEMAS).values()):
        return False
    for t in ("train", "client", "electricity_prices", "gas_prices"):
        ME.load_silver(fx.spark, db, t)
    ME.refresh_reference(
        fx.spark, db, "weather_station_to_county_mapping", ["county_name", "longitude", "latitude", "county"]
    )
    return True


@query(
    "l01_bronze",
    "SELECT * FROM readings",
    ("readings",),
)
def l01(fx: Fixtures) -> DataFrame:
    db = loaded(fx, "l01", 15)
    return fx.spark.table(f"{db}.bronze_train").select(schemas.READINGS.names)


@query(
    "l01_marks",
    """SELECT 'bronze_train' AS table_name, CAST(max(data_block_id) AS INT) AS data_block_id FROM readings
      UNION ALL SELECT 'bronze_client', CAST(max(data_block_id) AS INT) FROM client
      UNION ALL SELECT 'bronze_electricity_prices', CAST(max(data_block_id) AS INT) FROM electricity_prices
      UNION ALL SELECT 'bronze_gas_prices', CAST(max(data_block_id) AS INT) FROM gas_prices""",
    GOLD_VIEWS,
)
def l01_marks(fx: Fixtures) -> DataFrame:
    db = loaded(fx, "l01m", 15)
    return fx.spark.table(f"{db}.{ME.CONTROL}").select("table_name", "data_block_id")


@query(
    "l02_silver",
    """SELECT * FROM bronze_readings b1 WHERE target IS NOT NULL AND process_timestamp =
      (SELECT max(process_timestamp) FROM bronze_readings b2 WHERE b1.row_id = b2.row_id)""".replace(
        "SELECT * FROM", "SELECT * EXCLUDE (process_timestamp) FROM", 1
    ),
    ("readings", "bronze_readings"),
)
def l02(fx: Fixtures) -> DataFrame:
    """Duplicated bronze rows in two blocks-wise runs."""
    db = fresh_database(fx.spark, "l02")
    early = F.col("data_block_id") < 15
    for part in (early, ~early):
        write_table(fx.bronze_readings().where(part), f"{db}.bronze_train", "append", ["data_block_id"])
        ME.load_silver(fx.spark, db, "train")
    return fx.spark.table(f"{db}.silver_train").select(schemas.READINGS.names)


@query(
    "l02_silver_weather",
    """SELECT 'historical' AS kind, date_trunc('hour', ts) AS datetime, 0 AS hours_ahead, (user_id % 8) / 2 AS latitude, (user_id % 4) / 4 AS longitude,
        round(avg(value), 7) AS temperature, CAST(date_diff('day', DATE '2024-01-01', CAST(date_trunc('hour', ts) AS DATE)) AS INT) + 1 AS data_block_id FROM events GROUP BY ALL
      UNION ALL SELECT 'forecast', o + to_hours(h), CAST(h AS INT), latitude, longitude, t, CAST(date_diff('day', DATE '2024-01-01', CAST(o AS DATE)) AS INT) FROM
        (SELECT date_trunc('day', ts)::TIMESTAMP AS o, hour(ts) AS h, (user_id % 8) / 2 AS latitude, (user_id % 4) / 4 AS longitude,
          round(max(value), 7) AS t, min(event_id) AS first FROM events GROUP BY ALL) WHERE first % 53 <> 0""",
)
def l02_weather(fx: Fixtures) -> DataFrame:
    """Both weather tables through bronze and silver, some blocks in each run."""
    db, folder = fresh_database(fx.spark, "l02w"), scratch_dir(fx.spark, "l02w")
    export_csv(fx.historical_weather(), f"{folder}/historical_weather.csv")
    export_csv(fx.forecast_weather(), f"{folder}/forecast_weather.csv")
    while any(x.startswith("blocks") for x in ME.load_bronze(fx.spark, folder, db, 20, SCHEMAS).values()):
        for t in ("historical_weather", "forecast_weather"):
            ME.load_silver(fx.spark, db, t)
    past, ahead = (fx.spark.table(f"{db}.silver_{t}") for t in ("historical_weather", "forecast_weather"))
    columns = ["kind", "datetime", "hours_ahead", "latitude", "longitude", "temperature", "data_block_id"]
    ahead = ahead.withColumnRenamed("forecast_datetime", "datetime").withColumn("kind", F.lit("forecast"))
    return past.withColumns({"kind": F.lit("historical"), "hours_ahead": F.lit(0)}).select(columns).unionByName(ahead.select(columns))


@query(
    "l02_silver_insert_only",
    "SELECT * FROM readings WHERE target IS NOT NULL",
    ("readings",),
)
def l02_insert_only(fx: Fixtures) -> DataFrame:
    """Later versions of keys that silver already holds do not change it."""
    db = fresh_database(fx.spark, "l02i")
    first = F.col("process_timestamp") < F.lit("2024-02-02").cast("timestamp_ntz")
    for part in (first, ~first):
        write_table(fx.bronze_readings().where(part), f"{db}.bronze_train", "append", ["data_block_id"])
        ME.load_silver(fx.spark, db, "train")
    return fx.spark.table(f"{db}.silver_train").select(schemas.READINGS.names)


@query(
    "l03_reference",
    """SELECT s_name AS county_name, s_acctbal / 100 AS longitude, s_acctbal / 200 AS latitude, s_nationkey AS county
      FROM supplier WHERE s_suppkey % 3 <> 0""",
)
def l03(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "l03")
    name = "weather_station_to_county_mapping"
    write_table(stations(fx), f"{db}.bronze_{name}")
    return ME.refresh_reference(fx.spark, db, name, ["county_name", "longitude", "latitude", "county"])


# Silver drops rows with any null, so the gold queries start from complete readings.
SILVER_CTE = GOLD_SQL.replace("FROM readings a", "FROM (SELECT * FROM readings WHERE target IS NOT NULL) a")


def gold(fx: Fixtures, label: str, blocks: int = 45, grain: str = "hour") -> str:
    """All layers in runs of some blocks each until no table has anything new; gold once per run."""
    db = fresh_database(fx.spark, label)
    folder, checkpoint = raw_files(fx, label), scratch_dir(fx.spark, f"{label}c")
    while load_layers(fx, db, folder, blocks):
        ME.load_gold(fx.spark, db, checkpoint, grain=grain)
    return db


@query(
    "l04_gold_features",
    SILVER_CTE.format(electricity="date_trunc('hour', a.datetime) = c.forecast_date + INTERVAL 1 DAY"),
    GOLD_VIEWS,
)
def l04_features(fx: Fixtures) -> DataFrame:
    return fx.spark.table(f"{gold(fx, 'l04f')}.gold_all_features")


@query(
    "l04_gold_features_steps",
    SILVER_CTE.format(electricity="date_trunc('hour', a.datetime) = c.forecast_date + INTERVAL 1 DAY"),
    GOLD_VIEWS,
)
def l04_features_steps(fx: Fixtures) -> DataFrame:
    """Built in several loads: prices and client states arrive after readings that need them."""
    return fx.spark.table(f"{gold(fx, 'l04fs', 13)}.gold_all_features")


@query(
    "l04_gold_test",
    """SELECT event_id AS row_id, user_id AS prediction_unit_id, CAST(user_id % 16 AS INT) AS county, CAST(user_id % 2 AS INT) AS is_business,
        CAST(user_id % 4 AS INT) AS product_type, CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS is_consumption,
        ts AS prediction_datetime, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS data_block_id FROM events""",
)
def l04_test(fx: Fixtures) -> DataFrame:
    """The test set through bronze and silver in two runs, gold with the test dataset each time."""
    db, checkpoint, folder = fresh_database(fx.spark, "l04t"), scratch_dir(fx.spark, "l04tc"), scratch_dir(fx.spark, "l04t")
    for name, data in {"test": fx.unscored(), "electricity_prices": fx.electricity_prices(), "gas_prices": fx.gas_prices()}.items():
        export_csv(data, f"{folder}/{name}.csv")
    while any(x.startswith("blocks") for x in ME.load_bronze(fx.spark, folder, db, 20, SCHEMAS).values()):
        for t in ("test", "electricity_prices", "gas_prices"):
            ME.load_silver(fx.spark, db, t)
        ME.load_gold(fx.spark, db, checkpoint, dataset="test")
    return fx.spark.table(f"{db}.gold_test").select(schemas.UNSCORED.names)

@query(
    "l04_gold_prices",
    """SELECT coalesce(e.d, g.d) AS forecast_date, round(m, 11) AS electricity_price_per_mwh_median, round(a, 11) AS electricity_price_per_mwh_average,
        round(lm, 11) AS gas_lowest_price_per_mwh_median, round(la, 11) AS gas_lowest_price_per_mwh_average,
        round(hm, 11) AS gas_highest_price_per_mwh_median, round(ha, 11) AS gas_highest_price_per_mwh_average
      FROM (SELECT CAST(forecast_date AS DATE) AS d, median(euros_per_mwh) AS m, avg(euros_per_mwh) AS a FROM electricity_prices GROUP BY 1) e
      FULL OUTER JOIN (SELECT forecast_date AS d, median(lowest_price_per_mwh) AS lm, avg(lowest_price_per_mwh) AS la,
        median(highest_price_per_mwh) AS hm, avg(highest_price_per_mwh) AS ha FROM gas_prices GROUP BY 1) g ON e.d = g.d""",
    ("electricity_prices", "gas_prices"),
)
def l04_prices(fx: Fixtures) -> DataFrame:
    return rounded(fx.spark.table(f"{gold(fx, 'l04p', 20)}.gold_energy_prices_aggregate").drop(RANGE), 11)


@query(
    "l04_gold_consumption",
    """SELECT c.date AS date, round(c.a, 4) AS total_consumption_amt, round(p.a, 4) AS total_production_amt, round(p.a - c.a, 4) AS net_amt
      FROM (SELECT CAST(datetime AS DATE) AS date, sum(target) AS a FROM readings WHERE is_consumption = 1 AND target IS NOT NULL GROUP BY 1) c
      JOIN (SELECT CAST(datetime AS DATE) AS date, sum(target) AS a FROM readings WHERE is_consumption = 0 AND target IS NOT NULL GROUP BY 1) p
      ON c.date = p.date""",
    ("readings",),
)
def l04_consumption(fx: Fixtures) -> DataFrame:
    return rounded(fx.spark.table(f"{gold(fx, 'l04k', 20)}.gold_consumption_production_aggregate").drop(RANGE), 4)


@query("l04_gold_stream", "SELECT * FROM readings WHERE target IS NOT NULL", ("readings",))
def l04_stream(fx: Fixtures) -> DataFrame:
    return fx.spark.table(f"{gold(fx, 'l04s', 20)}.gold_train").select(schemas.READINGS.names)


@query(
    "l05_price_aggs",
    """SELECT forecast_date::TIMESTAMP AS forecast_date, 'electricity' AS kind, euros_per_mwh AS low_median, euros_per_mwh AS low_average FROM electricity_prices
      UNION ALL SELECT forecast_date::TIMESTAMP, 'gas', lowest_price_per_mwh, lowest_price_per_mwh FROM gas_prices""",
    ("electricity_prices", "gas_prices"),
)
def l05(fx: Fixtures) -> DataFrame:
    db = fresh_database(fx.spark, "l05")
    write_table(fx.electricity_prices(), f"{db}.silver_electricity_prices")
    write_table(fx.gas_prices(), f"{db}.silver_gas_prices")
    for _ in range(2):
        ME.load_price_aggregates(fx.spark, db)
    e = fx.spark.table(f"{db}.gold_electricity_aggregate").toDF("forecast_date", "low_median", "low_average")
    g = fx.spark.table(f"{db}.gold_gas_prices_aggregate")
    g = g.select(
        F.col("forecast_date").cast("timestamp_ntz").alias("forecast_date"),
        F.col("lowest_price_per_mwh_median").alias("low_median"),
        F.col("lowest_price_per_mwh_average").alias("low_average"),
    )
    return e.withColumn("kind", F.lit("electricity")).unionByName(g.withColumn("kind", F.lit("gas")))


PROPERTY_SILVER_SQL = """SELECT p.*, concat(p_brand, ' homes') AS brand_desc, concat(p_type, ' class') AS type_desc,
  lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_fips, n_name AS state_code
  FROM properties p LEFT JOIN nation ON substr(lpad(CAST(fips * 1000 + 1 AS VARCHAR), 5, '0'), 1, 2) = lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"""


def property_silver(fx: Fixtures, label: str) -> DataFrame:
    part = fx.table("part")
    brands = part.select("p_brand").distinct().select(
        F.col("p_brand").alias("key"), F.concat("p_brand", F.lit(" homes")).alias("brand_desc")
    )
    types = part.select("p_type").distinct().select(
        F.col("p_type").alias("key"), F.concat("p_type", F.lit(" class")).alias("type_desc")
    )
    states = fx.table("nation").select(F.col("n_nationkey").alias("state_fips"), F.col("n_name").alias("state_code"))
    facts = fx.properties().withColumn("county_code", F.col("fips") * 1000 + 1)
    db = fresh_database(fx.spark, label)
    lookups = [("p_brand", brands, "key", ["brand_desc"]), ("p_type", types, "key", ["type_desc"])]
    return P.load_property_silver(facts, lookups, states, f"{db}.silver_properties", county_code="county_code")


@query("l06_property_silver", PROPERTY_SILVER_SQL, ("properties",))
def l06(fx: Fixtures) -> DataFrame:
    return property_silver(fx, "l06").drop("county_code")


GOLD_COLUMNS = [
    "parcelid",
    "roomcnt",
    "yearbuilt",
    "yardbuildingsqft17",
    "unitcnt",
    "poolcnt",
    "decktypeid",
    "lotsizesquarefeet",
    "landtaxvaluedollarcnt",
    "taxvaluedollarcnt",
    "fips",
    "state_code",
]


@query(
    "l07_property_gold",
    f"""WITH s AS ({PROPERTY_SILVER_SQL})
      SELECT parcelid, roomcnt, yearbuilt, yardbuildingsqft17, coalesce(unitcnt, 0) AS unitcnt, poolcnt, decktypeid,
        coalesce(lotsizesquarefeet, 0) AS lotsizesquarefeet, landtaxvaluedollarcnt, taxvaluedollarcnt, fips, state_code,
        CASE WHEN yearbuilt IS NULL THEN NULL WHEN 2024 - yearbuilt <= 10 THEN '0 - 10 years old' WHEN 2024 - yearbuilt <= 60
          THEN '10 - 60 years old' ELSE '60 or more years old' END AS Age_Group,
        CASE WHEN decktypeid IS NULL THEN 0 ELSE 1 END AS hasdeck,
        landtaxvaluedollarcnt / nullif(lotsizesquarefeet, 0) AS landpricepersqft,
        CASE WHEN lotsizesquarefeet IS NULL THEN 0 ELSE 1 END AS lotexists,
        CASE WHEN yardbuildingsqft17 IS NULL OR yardbuildingsqft17 = 0 THEN 'none' WHEN yardbuildingsqft17 < 200 THEN 'small'
          WHEN yardbuildingsqft17 < 300 THEN 'medium' WHEN yardbuildingsqft17 < 400 THEN 'large' ELSE 'extra_large' END AS patiosize,
        CASE WHEN poolcnt IS NULL THEN 'No' ELSE 'Yes' END AS pool,
        CASE WHEN roomcnt = 0 THEN 'none' WHEN roomcnt <= 4 THEN 'small' WHEN roomcnt <= 8 THEN 'medium' ELSE 'large' END AS roomcntcat,
        CAST(CASE WHEN unitcnt IS NULL THEN 0 WHEN unitcnt >= 5 THEN 5 ELSE unitcnt END AS INT) AS unitcntcat
      FROM s WHERE roomcnt IS NOT NULL AND fips IS NOT NULL AND state_code IS NOT NULL AND taxvaluedollarcnt IS NOT NULL""",
    ("properties",),
)
def l07(fx: Fixtures) -> DataFrame:
    silver = property_silver(fx, "l07")
    db = fresh_database(fx.spark, "l07g")
    return P.load_property_gold(silver, GOLD_COLUMNS, f"{db}.gold_properties", today())


def known(value: str, divisor: int) -> str:
    """SQL that both engines read: a value that one size in ``divisor`` lacks."""
    return f"CASE WHEN (p_size + {divisor}) % {divisor} <> 0 THEN {value} END"


# The columns of the property tables and the lookups behind them.
CODES = {
    "airconditioningtypeid": ("AirConditioningDesc", 13),
    "architecturalstyletypeid": ("ArchitecturalStyleDesc", 27),
    "buildingclasstypeid": ("BuildingClassDesc", 5),
    "heatingorsystemtypeid": ("HeatingOrSystemDesc", 25),
    "propertylandusetypeid": ("PropertyLandUseDesc", 31),
    "storytypeid": ("StoryDesc", 35),
    "typeconstructiontypeid": ("TypeConstructionDesc", 18),
    "buildingqualitytypeid": ("BuildingQualityTypeDesc", 12),
}
WIDE = {
    "parcelid": "p_partkey",
    "file_year": "CAST(2016 + p_partkey % 2 AS INT)",
    "bathroomcnt": known("p_size % 4", 19),
    "bedroomcnt": known("p_size % 6", 23),
    "decktypeid": "CASE WHEN p_size % 8 = 0 THEN 66 END",
    "calculatedfinishedsquarefeet": known("p_size * 40", 7),
    "fireplaceflag": "CASE WHEN p_size % 3 = 0 THEN TRUE END",
    "fullbathcnt": known("p_size % 3", 5),
    "hashottuborspa": "CASE WHEN p_size % 5 = 0 THEN TRUE END",
    "latitude": known("p_partkey % 180 - 90", 29),
    "longitude": known("p_partkey % 360 - 180", 29),
    "lotsizesquarefeet": known("p_size * 100", 13),
    "poolcnt": "CASE WHEN p_size % 3 = 0 THEN 1 END",
    "pooltypeid2": "CASE WHEN p_size % 10 = 0 THEN 1 END",
    "pooltypeid10": "CASE WHEN p_size % 14 = 0 THEN 1 END",
    "propertycountylandusecode": known("p_type", 31),
    "censustractandblock": known("p_partkey * 1000", 37),
    "regionidzip": known("p_partkey % 400", 41),
    "roomcnt": known("p_size % 12", 9),
    "unitcnt": known("p_size % 7", 11),
    "yardbuildingsqft17": known("p_size * 10", 5),
    "yardbuildingsqft26": "CASE WHEN p_size % 4 = 0 THEN p_size END",
    "taxvaluedollarcnt": "p_retailprice",
    "basementsqft": "CASE WHEN p_size % 6 = 0 THEN p_size * 20 END",
    "yearbuilt": known("1950 + p_size * 2", 7),
    "landtaxvaluedollarcnt": "p_size * 10 - 100",
    "county_code": f"({known('CAST(p_partkey % 25 AS INT)', 6)}) * 1000 + 1",
    "fips": known("CAST(p_partkey % 25 AS INT)", 6),
    **{code: known(f"CAST(p_partkey % {n} AS INT)", 43 + k) for k, (code, (_, n)) in enumerate(CODES.items())},
}
WIDE_SQL = f"SELECT {', '.join(f'{v} AS {c}' for c, v in WIDE.items())} FROM part"
LOOKUPS_SQL = ", ".join(
    f"l{k} AS (SELECT DISTINCT CAST(p_partkey % {n} AS INT) AS key, concat('{out} ', p_partkey % {n}) AS {out} FROM part WHERE p_partkey % {n} <> 3)" for k, (out, n) in enumerate(CODES.values())
)
WIDE_SILVER_SQL = f"""w AS ({WIDE_SQL}), {LOOKUPS_SQL}, s AS (SELECT w.*, {", ".join(out for out, _ in CODES.values())},
    lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state_fips, n_name AS state_code FROM w
    {" ".join(f"LEFT JOIN l{k} ON w.{code} = l{k}.key" for k, code in enumerate(CODES))}
    LEFT JOIN nation ON substr(lpad(CAST(county_code AS VARCHAR), 5, '0'), 1, 2) = lpad(CAST(n_nationkey AS VARCHAR), 2, '0'))"""


def wide_silver(fx: Fixtures, label: str) -> DataFrame:
    """All columns and all eight lookups; code 3 is in no lookup."""
    part, lookups = fx.table("part"), []
    for code, (out, n) in CODES.items():
        key = (F.col("p_partkey") % n).cast("int")
        rows = part.where(key != 3).select(key.alias("key"), F.concat(F.lit(f"{out} "), key.cast("string")).alias(out)).distinct()
        lookups.append((code, rows, "key", [out]))
    states = fx.table("nation").select(F.col("n_nationkey").alias("state_fips"), F.col("n_name").alias("state_code"))
    facts = part.selectExpr(*(f"{v} AS {c}" for c, v in WIDE.items()))
    return P.load_property_silver(facts, lookups, states, f"{fresh_database(fx.spark, label)}.silver_properties", county_code="county_code")


@query("l06_property_silver_wide", f"WITH {WIDE_SILVER_SQL} SELECT * FROM s")
def l06_wide(fx: Fixtures) -> DataFrame:
    return wide_silver(fx, "l06w")


# The columns of the gold table, in its order.
WIDE_GOLD = [
    "bathroomcnt", "bedroomcnt", "BuildingQualityTypeDesc", "decktypeid", "calculatedfinishedsquarefeet", "fips", "fireplaceflag", "fullbathcnt",
    "hashottuborspa", "latitude", "longitude", "lotsizesquarefeet", "parcelid", "poolcnt", "pooltypeid2", "pooltypeid10",
    "propertycountylandusecode", "propertylandusetypeid", "PropertyLandUseDesc", "censustractandblock", "regionidzip", "roomcnt", "unitcnt",
    "yardbuildingsqft17", "yardbuildingsqft26", "taxvaluedollarcnt", "basementsqft", "state_code", "state_fips", "yearbuilt", "landtaxvaluedollarcnt",
]
FILL_SQL = {
    "BuildingQualityTypeDesc": "'No information'",
    "calculatedfinishedsquarefeet": "0",
    "fireplaceflag": "FALSE",
    "fullbathcnt": "0",
    "hashottuborspa": "FALSE",
    "lotsizesquarefeet": "0",
    "unitcnt": "0",
}


@query(
    "l07_property_gold_wide",
    f"""WITH {WIDE_SILVER_SQL}
      SELECT {", ".join(f"coalesce({c}, {FILL_SQL[c]}) AS {c}" if c in FILL_SQL else c for c in WIDE_GOLD)},
        CASE WHEN yearbuilt IS NULL THEN NULL WHEN 2024 - yearbuilt <= 10 THEN '0 - 10 years old' WHEN 2024 - yearbuilt <= 60
          THEN '10 - 60 years old' ELSE '60 or more years old' END AS Age_Group,
        CASE WHEN decktypeid IS NULL THEN 0 ELSE 1 END AS hasdeck, CASE WHEN basementsqft IS NULL THEN 0 ELSE 1 END AS hasbasement,
        CASE WHEN pooltypeid10 IS NULL AND pooltypeid2 IS NULL THEN 0 ELSE 1 END AS hashottub,
        CASE WHEN yardbuildingsqft26 IS NULL THEN 0 ELSE 1 END AS hasyardstorage,
        landtaxvaluedollarcnt / nullif(lotsizesquarefeet, 0) AS landpricepersqft,
        CASE WHEN lotsizesquarefeet IS NULL THEN 0 ELSE 1 END AS lotexists,
        CASE WHEN yardbuildingsqft17 IS NULL OR yardbuildingsqft17 = 0 THEN 'none' WHEN yardbuildingsqft17 < 200 THEN 'small'
          WHEN yardbuildingsqft17 < 300 THEN 'medium' WHEN yardbuildingsqft17 < 400 THEN 'large' ELSE 'extra_large' END AS patiosize,
        CASE WHEN poolcnt IS NULL THEN 'No' ELSE 'Yes' END AS pool,
        CASE WHEN roomcnt = 0 THEN 'none' WHEN roomcnt <= 4 THEN 'small' WHEN roomcnt <= 8 THEN 'medium' ELSE 'large' END AS roomcntcat,
        CAST(CASE WHEN unitcnt IS NULL THEN 0 WHEN unitcnt >= 5 THEN 5 ELSE unitcnt END AS INT) AS unitcntcat
      FROM s WHERE {" AND ".join(f"{c} IS NOT NULL" for c in P.GOLD_REQUIRED)}""",
)
def l07_wide(fx: Fixtures) -> DataFrame:
    return P.load_property_gold(wide_silver(fx, "l07w"), WIDE_GOLD, f"{fresh_database(fx.spark, 'l07wg')}.gold_properties", today())
