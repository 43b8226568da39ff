"""Declared schemas, so that no scan needs an inference pass."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table(*columns: str) -> T.StructType:
    """``table("id bigint not null", "name string")``; needs no running session, unlike a DDL string."""
    fields = []
    for column in columns:
        name, dtype, *rest = column.split()
        fields.append(T.StructField(name, _TYPES[dtype], nullable=not rest))
    return T.StructType(fields)


# Audit columns every loaded (bronze) row carries.
AUDIT_COLUMNS = [
    "file_path",
    "file_name",
    "file_size",
    "file_modification_time",
    "run_id",
    "job_group",
    "process_timestamp",
]

READINGS = table(
    "row_id bigint",
    "prediction_unit_id bigint",
    "county int",
    "is_business int",
    "product_type int",
    "is_consumption int",
    "target double",
    "datetime timestamp_ntz",
    "data_block_id int",
)
UNSCORED = table(
    "row_id bigint",
    "prediction_unit_id bigint",
    "county int",
    "is_business int",
    "product_type int",
    "is_consumption int",
    "prediction_datetime timestamp_ntz",
    "data_block_id int",
)
CLIENT = table(
    "product_type int",
    "county int",
    "is_business int",
    "date date",
    "eic_count bigint",
    "installed_capacity double",
    "data_block_id int",
)
ELECTRICITY_PRICES = table(
    "forecast_date timestamp_ntz",
    "euros_per_mwh double",
    "origin_date timestamp_ntz",
    "data_block_id int",
)
GAS_PRICES = table(
    "forecast_date date",
    "lowest_price_per_mwh double",
    "highest_price_per_mwh double",
    "origin_date date",
    "data_block_id int",
)
HISTORICAL_WEATHER = table(
    "datetime timestamp_ntz",
    "latitude double",
    "longitude double",
    "temperature double",
    "data_block_id int",
)
FORECAST_WEATHER = table(
    "latitude double",
    "longitude double",
    "origin_datetime timestamp_ntz",
    "hours_ahead int",
    "temperature double",
    "data_block_id int",
    "forecast_datetime timestamp_ntz",
)
WEATHER_STATIONS = table(
    "county_name string",
    "longitude double",
    "latitude double",
    "county int",
)
RATINGS = table(
    "Movie_ID string",
    "User_ID string",
    "Rating int",
    "Date date",
)
TITLES = table(
    "Movie_ID string",
    "Release_Year int",
    "Title string",
)
CONTROL = table(
    "table_name string not null",
    "data_block_id int not null",
    "load_timestamp timestamp not null",
)

# Keys that identify one version of a row in each silver table.
SILVER_KEYS = {
    "client": ["product_type", "county", "eic_count", "installed_capacity", "is_business", "date", "data_block_id"],
    "electricity_prices": ["forecast_date", "origin_date", "data_block_id"],
    "forecast_weather": ["latitude", "longitude", "origin_datetime", "hours_ahead", "data_block_id", "forecast_datetime"],
    "gas_prices": ["forecast_date", "origin_date", "data_block_id"],
    "historical_weather": ["datetime", "latitude", "longitude", "data_block_id"],
    "train": ["row_id"],
    "test": ["row_id"],
}
