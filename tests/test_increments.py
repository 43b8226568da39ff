import datetime as dt

from pyspark.sql import functions as F

from tablework import schemas
from tablework.operators.merge import RANGE
from tablework.plans import increments as I
from tablework.plans import medallion as ME
from tablework.session import scratch_dir
from tablework.sinks.tables import write_table
from tests.conftest import rows

DAY = dt.datetime(2024, 1, 1)


def bronze(spark, db, table, data, schema, seen=1):
    """Append rows to a bronze table as one load would."""
    df = spark.createDataFrame(data, schema).withColumns({"file_name": F.lit("f"), "process_timestamp": F.lit(DAY + dt.timedelta(days=seen)).cast("timestamp_ntz")})
    write_table(df.select(*[c for c in df.columns if c != I.BLOCK], I.BLOCK), f"{db}.bronze_{table}", "append", [I.BLOCK])


def reading(row_id, block, target=1.0):
    return (row_id, row_id % 3, 1, 0, 1, row_id % 2, target, DAY + dt.timedelta(days=block, hours=row_id % 24), block)


def files_of(spark, name):
    return {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1] for f in spark.table(name).inputFiles()}


def blocks_read(df):
    return {f.rsplit("/", 2)[-2] for f in df.inputFiles()}


def test_second_silver_load_reads_only_changed_blocks(spark, db):
    bronze(spark, db, "train", [reading(i, i // 10) for i in range(50)], schemas.READINGS)
    assert ME.load_silver(spark, db, "train") == 50
    bronze(spark, db, "train", [reading(i, i // 10) for i in range(50, 60)] + [reading(60, 2)], schemas.READINGS, 2)  # one is late
    changes = I.Changes(spark, db, "bronze_train", "silver_train")
    assert changes.blocks == ["2", "5"] and not changes.all
    assert blocks_read(changes.rows()) == {"data_block_id=2", "data_block_id=5"}
    # no silver block has keys from 50 to 60; those of block 2 are 20 to 29 so far
    new = I.possible_matches(spark, db, "train", changes.rows().where("row_id >= 50"), ["row_id"], changes)
    assert blocks_read(new) == set()
    late = I.possible_matches(spark, db, "train", changes.rows(), ["row_id"], changes)
    assert blocks_read(late) == {"data_block_id=2", "data_block_id=3", "data_block_id=4"}
    assert ME.load_silver(spark, db, "train") == 61
    assert not I.Changes(spark, db, "bronze_train", "silver_train").any()
    assert ME.load_silver(spark, db, "train") == 61


def test_loads_in_steps_equal_one_comparison_of_everything(spark, db):
    """Versions, late rows, incomplete rows and null keys, in any number of loads."""
    steps = [
        [reading(1, 0), reading(2, 0, None), reading(3, 0), reading(9, 0, None)],
        [reading(1, 1, 7.0), reading(2, 1, 2.0), reading(4, 1, None)],
        [reading(5, 0), (None, *reading(6, 0)[1:]), reading(4, 2, None), reading(9, 2, None)],
        [reading(4, 0, 4.0), reading(6, 3), reading(6, 3)],
    ]
    seen, expected = {}, []
    for k, data in enumerate(steps):
        bronze(spark, db, "train", data, schemas.READINGS, k + 1)
        ME.load_silver(spark, db, "train")
        for r in data:
            if r[0] is not None:
                seen.setdefault(r[0], []).append((k, r))
        have = {r[0] for r in expected}
        for key, versions in seen.items():
            newest = [r for at, r in versions if at == max(v[0] for v in versions)]
            expected += [r for r in newest if None not in r] if key not in have else []
    assert rows(spark.table(f"{db}.silver_train").select(schemas.READINGS.names)) == sorted(expected)


def test_an_older_row_of_an_incomplete_key_stays_out(spark, db):
    bronze(spark, db, "train", [reading(1, 0, None)], schemas.READINGS, 5)
    ME.load_silver(spark, db, "train")
    bronze(spark, db, "train", [reading(1, 1, 3.0)], schemas.READINGS, 2)  # written later, but older
    assert ME.load_silver(spark, db, "train") == 0
    bronze(spark, db, "train", [reading(1, 2, 4.0)], schemas.READINGS, 5)
    assert rows(spark.table(f"{db}.silver_train"), "target") == [] and ME.load_silver(spark, db, "train") == 1


def gold_inputs(spark, db, blocks, late_price=None):
    for b in blocks:
        day = (DAY + dt.timedelta(days=b)).date()
        hour = DAY + dt.timedelta(days=b)
        bronze(spark, db, "train", [reading(b * 10 + i, b, float(i)) for i in range(6)], schemas.READINGS, b + 1)
        bronze(spark, db, "gas_prices", [(day, b * 1.0, b * 2.0, day, b)], schemas.GAS_PRICES, b + 1)
        if b != late_price:
            bronze(spark, db, "electricity_prices", [(hour + dt.timedelta(hours=i), b + i / 10, hour, b) for i in range(6)], schemas.ELECTRICITY_PRICES, b + 1)
        bronze(spark, db, "client", [(1, 1, 0, day, b, 2.0, b)], schemas.CLIENT, b + 1)


def load(spark, db, checkpoint):
    for t in ("train", "gas_prices", "electricity_prices", "client"):
        ME.load_silver(spark, db, t)
    return ME.load_gold(spark, db, checkpoint)


GOLD = ("gold_all_features", "gold_energy_prices_aggregate", "gold_consumption_production_aggregate")


def contents(spark, db):
    out = {}
    for t in GOLD:
        df = spark.table(f"{db}.{t}")
        out[t] = rows(df.select(sorted(c for c in df.columns if c != RANGE)))
    return out


def test_gold_loads_in_steps_equal_a_full_build(spark, db):
    gold_inputs(spark, db, range(6), late_price=2)
    load(spark, db, scratch_dir(spark, "steps"))
    before = {t: files_of(spark, f"{db}.{t}") for t in GOLD}
    gold_inputs(spark, db, [6])
    hour = DAY + dt.timedelta(days=2)
    bronze(spark, db, "electricity_prices", [(hour + dt.timedelta(hours=i), 2 + i / 10, hour, 2) for i in range(6)], schemas.ELECTRICITY_PRICES, 9)
    done = load(spark, db, scratch_dir(spark, "steps"))
    assert done["gold_consumption_production_aggregate"] == {"insert": 1, "update": 0, "keep": 0, "delete": 0}
    assert done["gold_energy_prices_aggregate"] == {"insert": 1, "update": 1, "keep": 0, "delete": 0}
    stayed = {t: {f.split("/")[0] for f in before[t] & files_of(spark, f"{db}.{t}")} for t in GOLD}
    # readings of day 3 get the late prices of day 2, those of day 6 are new; the others keep their files
    assert stayed["gold_all_features"] == {f"train_data_block_id={b}" for b in (0, 1, 2, 4, 5)}
    assert len(stayed["gold_energy_prices_aggregate"]) == 5 and len(stayed["gold_consumption_production_aggregate"]) == 6
    in_steps = contents(spark, db)
    for t in GOLD:
        spark.sql(f"DROP TABLE {db}.{t}")
    spark.sql(f"DROP TABLE {db}.{I.STATE}")
    ME.load_gold(spark, db, scratch_dir(spark, "full"))
    assert contents(spark, db) == in_steps
    assert ME.load_gold(spark, db, scratch_dir(spark, "idle")) == {}


def test_empty_bronze_gives_empty_layers(spark, db):
    for t, schema in (("train", schemas.READINGS), ("gas_prices", schemas.GAS_PRICES), ("electricity_prices", schemas.ELECTRICITY_PRICES), ("client", schemas.CLIENT)):
        bronze(spark, db, t, [], schema)
    load(spark, db, scratch_dir(spark, "none"))
    assert all(not found for found in contents(spark, db).values())
    gold_inputs(spark, db, [0, 1])
    load(spark, db, scratch_dir(spark, "none"))
    assert len(contents(spark, db)["gold_all_features"]) == 6 + 6 * 6 and len(contents(spark, db)["gold_energy_prices_aggregate"]) == 2
