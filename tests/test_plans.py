import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablework import schemas
from tablework.plans import medallion as ME
from tablework.plans import property as P
from tablework.session import scratch_dir
from tablework.sinks.tables import export_csv, get_watermark, write_table
from tests.conftest import rows

SCHEMAS = {"gas_prices": schemas.GAS_PRICES, "weather_station_to_county_mapping": schemas.WEATHER_STATIONS}


def gas(spark, blocks):
    d = dt.date(2024, 1, 1)
    data = [(d + dt.timedelta(b), b * 1.0, b * 2.0, d + dt.timedelta(b - 1), b) for b in blocks]
    return spark.createDataFrame(data, schemas.GAS_PRICES)


def folder(spark, blocks):
    path = scratch_dir(spark, "raw")
    export_csv(gas(spark, blocks), f"{path}/gas_prices.csv")
    stations = spark.createDataFrame([("a", 1.0, 2.0, 3), (None, 1.0, 2.0, 3)], schemas.WEATHER_STATIONS)
    export_csv(stations, f"{path}/weather_station_to_county_mapping.csv")
    return path


def test_window(spark):
    data = gas(spark, [0, 1, 2, 9, 30, 31])
    assert ME.next_blocks(data, -1, 400) == [0, 1, 2, 9, 30, 31] and ME.next_blocks(data, 1, 2) == [2, 9]
    assert ME.next_blocks(data, -1, 400, reference_window=True) == [1, 2, 9, 30, 31]
    assert ME.next_blocks(data, 2, 3, reference_window=True) == [9, 30] and ME.next_blocks(data, 31, 4) == []
    with pytest.raises(ValueError):
        ME.next_blocks(data, 0, 0)


@pytest.mark.parametrize("blocks", [1, 2, 4])
def test_bronze_passes_gaps_wider_than_a_run(spark, db, blocks):
    present = [0, 1, 2, 3, 50, 51, 200]
    path = folder(spark, present)
    for _ in range(len(present) + 1):
        ME.load_bronze(spark, path, db, blocks, SCHEMAS)
    assert rows(spark.table(f"{db}.bronze_gas_prices"), "data_block_id") == [(b,) for b in present]


def test_bronze_repairs_a_half_written_block(spark, db):
    path = folder(spark, range(4))
    ME.load_bronze(spark, path, db, 2, SCHEMAS)
    name = f"{db}.bronze_gas_prices"
    stray = spark.table(name).where("data_block_id = 1").withColumn("data_block_id", F.lit(3)).withColumn("lowest_price_per_mwh", F.lit(-1.0))
    write_table(stray.select(spark.table(name).columns), name, "append", ["data_block_id"])
    ME.load_bronze(spark, path, db, 2, SCHEMAS)
    assert rows(spark.table(name), "data_block_id", "lowest_price_per_mwh") == [(b, float(b)) for b in range(4)]


def test_bronze_in_steps_equals_bronze_at_once(spark, db):
    path = folder(spark, range(10))
    for expected in ("blocks 0..3", "blocks 4..7", "blocks 8..9", "nothing new"):
        done = ME.load_bronze(spark, path, db, 4, SCHEMAS)
        assert done[f"{db}.bronze_gas_prices"] == expected
    assert rows(spark.table(f"{db}.bronze_gas_prices"), "data_block_id") == [(b,) for b in range(10)]
    assert spark.table(f"{db}.bronze_weather_station_to_county_mapping").count() == 2
    assert get_watermark(spark, f"{db}.{ME.CONTROL}", "bronze_gas_prices") == 9


def test_bronze_repeat_after_a_lost_mark(spark, db, monkeypatch):
    """The blocks were written, then the job died before the mark was set."""
    path = folder(spark, range(6))
    with monkeypatch.context() as m:
        m.setattr(ME, "set_watermark", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ME.load_bronze(spark, path, db, 3, SCHEMAS)
    assert spark.table(f"{db}.bronze_gas_prices").count() == 3
    for _ in range(3):
        ME.load_bronze(spark, path, db, 3, SCHEMAS)
    assert rows(spark.table(f"{db}.bronze_gas_prices"), "data_block_id") == [(b,) for b in range(6)]


def bronze(spark, data):
    schema = "row_id int, target double, data_block_id int, file_name string, process_timestamp timestamp_ntz"
    return spark.createDataFrame([(k, v, b, "f", dt.datetime(2024, 1, t)) for k, v, b, t in data], schema)


def test_silver(spark, db):
    first = [(1, 1.0, 0, 1), (1, 2.0, 0, 2), (2, None, 0, 1), (None, 5.0, 0, 1), (3, 3.0, 1, 1)]
    write_table(bronze(spark, first), f"{db}.bronze_train")
    assert ME.load_silver(spark, db, "train") == 2
    assert rows(spark.table(f"{db}.silver_train")) == [(1, 2.0, 0), (3, 3.0, 1)]
    # Existing keys stay, a dropped key is tried again and may succeed.
    write_table(bronze(spark, [(1, 9.0, 2, 3), (2, 4.0, 2, 3)]), f"{db}.bronze_train", "append")
    assert ME.load_silver(spark, db, "train") == 3
    assert rows(spark.table(f"{db}.silver_train")) == [(1, 2.0, 0), (2, 4.0, 2), (3, 3.0, 1)]
    assert ME.load_silver(spark, db, "train") == 3


def test_price_aggregates_follow_the_source(spark, db):
    e = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h), float(h), dt.datetime(2024, 1, 1), 0) for h in range(3)], schemas.ELECTRICITY_PRICES
    )
    write_table(e, f"{db}.silver_electricity_prices")
    write_table(gas(spark, range(3)), f"{db}.silver_gas_prices")
    assert ME.load_price_aggregates(spark, db)["gold_gas_prices_aggregate"]["insert"] == 3
    write_table(gas(spark, range(1, 5)), f"{db}.silver_gas_prices")
    assert ME.load_price_aggregates(spark, db)["gold_gas_prices_aggregate"] == {"insert": 2, "update": 0, "keep": 2, "delete": 1}


def test_gold_properties_chain_fills_and_flags(spark):
    df = spark.createDataFrame([(1, None, None, 3, 1.0), (2, 100.0, 7, None, 2.0)], "parcelid int, lotsizesquarefeet double, unitcnt int, roomcnt int, taxvaluedollarcnt double")
    out = P.gold_properties(df, df.columns, F.lit("2024-01-01").cast("date"))
    assert rows(out, "parcelid", "lotsizesquarefeet", "lotexists", "unitcnt", "unitcntcat", "roomcntcat") == [(1, 0.0, 0, 0, 0, "small")]


def test_prices_by_date_are_joined_last(spark):
    """They multiply the rows, so nothing else has to be done to the many."""
    at, ts, day = "timestamp'2024-01-03 05:00:00'", "timestamp_ntz'2024-01-02 {}:00:00'", "date'2024-01-{}'"
    readings = spark.sql(f"SELECT 1 county, 0 is_business, 2 product_type, {at} datetime UNION ALL SELECT 9, 0, 2, NULL")
    gas = spark.sql(f"SELECT {day.format('02')} forecast_date, 1.5 low")
    electricity = spark.sql(" UNION ALL ".join(f"SELECT {ts.format(h)} forecast_date, {h} euros" for h in ("01", "02", "03")))
    client = spark.sql(f"SELECT 2 product_type, 1 county, 0 is_business, {day.format('03')} date, 7 n")
    out = ME.build_gold_features(readings, gas, electricity, client)
    assert out.columns[4:8] == ["gas_prices_forecast_date", "gas_prices_low", "electric_prices_forecast_date", "electric_prices_euros"] and out.columns[-1] == "client_n"
    assert rows(out, "train_county", "gas_prices_low", "electric_prices_euros", "client_n") == rows(spark.sql("SELECT * FROM VALUES (9, NULL, NULL, NULL), (1, 1.5, 1, 7), (1, 1.5, 2, 7), (1, 1.5, 3, 7)"))
    joins = [x for x in out._jdf.queryExecution().analyzed().toString().splitlines() if "Join LeftOuter" in x]
    assert "client_" in joins[1] and "client_" not in joins[0]


def test_first_silver_load_copies_no_bronze_and_carries_no_paths(spark, db, monkeypatch):
    stored = []
    keep = ME.staged
    monkeypatch.setattr(ME, "staged", lambda df, label, **more: stored.append((label, df.columns)) or keep(df, label, **more))
    write_table(bronze(spark, [(1, 1.0, 0, 1), (1, 2.0, 0, 2), (2, None, 0, 1)]), f"{db}.bronze_train", "overwrite", ["data_block_id"])
    assert ME.load_silver(spark, db, "train") == 1
    write_table(bronze(spark, [(1, 9.0, 2, 3), (2, 4.0, 2, 3)]), f"{db}.bronze_train", "append", ["data_block_id"])
    assert ME.load_silver(spark, db, "train") == 2
    assert [label for label, _ in stored] == ["newest", "incomplete", "unseen", "newest", "incomplete"]
    assert not any("file_name" in columns for _, columns in stored)
    assert rows(spark.table(f"{db}.silver_train"), "row_id", "target") == [(1, 2.0), (2, 4.0)]
