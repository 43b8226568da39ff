"""Bronze, silver and gold loads of the energy tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablework.operators.aggregates import consumption_production, energy_prices_daily, price_stats
from tablework.operators.clean import complete_rows, prefix_columns
from tablework.operators.joins import join_shifted, latest_version, new_rows
from tablework.operators.merge import merge_sync, write_ranged
from tablework.plans.increments import BLOCK, NO_VALUE, Changes, add_key_ranges, possible_matches
from tablework.schemas import AUDIT_COLUMNS, SILVER_KEYS
from tablework.session import staged
from tablework.sinks.tables import get_watermark, partition_columns, replace_partitions, set_watermark, write_table
from tablework.sources.files import discover_csv, read_csv, with_ingest_metadata
from tablework.streaming.copy import stream_copy

CONTROL = "bronze_loading_checkpoint"
DATE_RANGES = 16  # parts of a daily gold table


def next_blocks(data: DataFrame, last: int, blocks: int, reference_window: bool = False) -> list[int]:
    """The next ``blocks`` block values above the mark that exist in the data, in rising order.

    Blocks that exist are counted, so a gap of any width in their numbers holds nothing up.
    ``reference_window=True`` takes one block less, and never block 0, as the original notebooks did.
    """
    if blocks < 1:
        raise ValueError("load at least one block")
    if reference_window:
        last, blocks = max(last, 0), blocks - 1
    if not blocks:
        return []
    found = data.where(F.col(BLOCK) > last).select(BLOCK).distinct().orderBy(BLOCK).limit(blocks)
    return [r[0] for r in found.collect()]


def load_bronze(
    spark: SparkSession,
    directory: str,
    db: str,
    blocks: int,
    schemas: Mapping[str, StructType],
    run_id: str = "run",
    job_group: str = "bronze",
    reference_window: bool = False,
) -> dict[str, str]:
    """Load every CSV of a folder into its bronze table and move that table's mark.

    Tables with a block column get the next blocks appended, others are replaced. Each table has
    its own mark, written right after its own load: a failure repeats at most that one table, and
    a table that lags behind loses nothing.
    """
    done = {}
    for table, path in discover_csv(spark, directory).items():
        stem = table.removeprefix("bronze_")
        data = with_ingest_metadata(read_csv(spark, path, schemas.get(stem), infer=stem not in schemas), run_id, job_group)
        name = f"{db}.{table}"
        if BLOCK not in data.columns:
            write_table(data, name)
            done[name] = "replaced"
            continue
        last = get_watermark(spark, f"{db}.{CONTROL}", table)
        window = next_blocks(data, last, blocks, reference_window)
        if not window:
            done[name] = "nothing new"
            continue
        batch = data.where(F.col(BLOCK).between(window[0], window[-1]))
        if spark.catalog.tableExists(name):
            # A repeat after a crash between write and mark replaces what the lost run wrote of these blocks.
            replace_partitions(batch, name, [BLOCK])
        else:
            write_table(batch, name, "append", [BLOCK])
        set_watermark(spark, f"{db}.{CONTROL}", table, window[-1])
        done[name] = f"blocks {window[0]}..{window[-1]}"
    return done


def load_silver(spark: SparkSession, db: str, table: str, keys: Sequence[str] | None = None) -> int:
    """Append the new rows of one bronze table to its silver table; existing keys stay as they are.

    Only blocks of bronze whose files have changed since the last load are read, and only the part of silver that can
    hold their keys. A key whose latest row is incomplete is kept aside with its time, so that
    a later row of it is compared with that one although its block is not read again. Returns the row count of the
    silver table afterwards.
    """
    keys, name, held_name = list(keys or SILVER_KEYS[table]), f"{db}.silver_{table}", f"{db}.silver_{table}_incomplete"
    changes = Changes(spark, db, f"bronze_{table}", f"silver_{table}")
    if not changes.any() and spark.catalog.tableExists(name):
        return spark.table(name).count()
    fresh = changes.rows()
    fresh = fresh.drop(*(c for c in AUDIT_COLUMNS if c != "process_timestamp"))  # else each shuffle carries the long paths
    silver = possible_matches(spark, db, table, fresh, keys, changes)
    unseen = fresh if silver is None else staged(new_rows(fresh, silver, keys), "unseen")  # bronze itself is stored
    newest = staged(latest_version(unseen, keys, "process_timestamp"), "newest")
    if changes.blocks is not None:
        if spark.catalog.tableExists(held_name):
            held = spark.table(held_name).groupBy(*keys).agg(F.max("process_timestamp").alias("_held"))
            newest = newest.join(held, keys, "left").where(F.coalesce(F.col("process_timestamp") >= F.col("_held"), F.lit(True))).drop("_held")
        value = F.lit(True)
        for c in newest.columns:
            value = value & (F.col(c).isNotNull() if c not in AUDIT_COLUMNS else F.lit(True))
        incomplete = staged(complete_rows(newest.where(~value).select(*keys, "process_timestamp").distinct(), keys), "incomplete")
        if incomplete.limit(1).count():
            write_table(incomplete, held_name, "append")
    batch = complete_rows(newest.drop(*AUDIT_COLUMNS))
    if changes.blocks is not None:
        add_key_ranges(batch, db, table, keys[0])
    columns = [c for c in batch.columns if c != BLOCK] + [BLOCK]
    write_table(batch.select(columns), name, "append", [BLOCK])
    changes.remember()
    return spark.table(name).count()


def refresh_reference(spark: SparkSession, db: str, table: str, cols: Sequence[str]) -> DataFrame:
    """Replace a silver reference table by the complete rows of its bronze table."""
    return write_table(complete_rows(spark.table(f"{db}.bronze_{table}").select(*cols)), f"{db}.silver_{table}")


def build_gold_features(
    readings: DataFrame, gas: DataFrame, electricity: DataFrame, client: DataFrame, grain: str = "day", name: str = "train"
) -> DataFrame:
    """Facts with the gas and electricity prices of the day before and the client state of the day.

    ``grain="day"`` matches electricity prices by date (one fact meets all hours of that day),
    ``"hour"`` by the exact hour.
    """
    facts = prefix_columns(readings, name)
    ts = f"{name}_datetime"
    out = join_shifted(facts, prefix_columns(gas, "gas_prices"), ts, "gas_prices_forecast_date", 1, "day")
    electric = prefix_columns(electricity, "electric_prices")
    c = prefix_columns(client, "client")
    on = (
        (F.col(f"{name}_product_type") == F.col("client_product_type"))
        & (F.col(f"{name}_county") == F.col("client_county"))
        & (F.col(f"{name}_is_business") == F.col("client_is_business"))
        & (F.to_date(ts) == F.col("client_date"))
    )
    # Prices by date multiply the rows, so that join comes last; the columns keep their order.
    wide = join_shifted(out.join(c, on, "left"), electric, ts, "electric_prices_forecast_date", 1, grain)
    return wide.select(*out.columns, *electric.columns, *c.columns)


def dates_of(changes: Changes, ts: str, shift: int = 0) -> DataFrame:
    """The dates of the rows in the changed blocks."""
    return changes.rows().select(F.date_add(F.to_date(ts), shift).alias("date")).where("date is not null")


def on_dates(df: DataFrame, ts: str, dates: Sequence, shift: int = 0) -> DataFrame:
    """The rows on some dates. The first and last of them bound the scan."""
    if not dates:
        return df.limit(0)
    low, high = F.lit(min(dates)), F.date_add(F.lit(max(dates)), 1 - shift)
    bounded = df.where((F.col(ts) >= F.date_add(low, -shift).cast(df.schema[ts].dataType)) & (F.col(ts) < high.cast(df.schema[ts].dataType)))
    return bounded.where(F.date_add(F.to_date(ts), shift).isin(list(dates)))


def merge_dates(spark: SparkSession, name: str, source: DataFrame, column: str, dates: Sequence | None) -> dict[str, int]:
    """Merge a daily table, which is kept in ranges of dates: all of it, or the given dates alone."""
    if not spark.catalog.tableExists(name):
        write_ranged(source, name, column, DATE_RANGES)
        return {"insert": spark.table(name).count(), "update": 0, "keep": 0, "delete": 0}
    scope = None if dates is None else F.col(column).isin(list(dates))
    return merge_sync(spark, name, source, [column], unique_checked=True, scope=scope)


def load_gold(spark: SparkSession, db: str, checkpoint: str, dataset: str = "train", grain: str = "day") -> dict[str, object]:
    """All gold tables: features, price aggregate, consumption aggregate and the streamed copy.

    What has changed in silver since the last load decides what is computed. The dates of new readings and prices
    are aggregated again and merged alone. Features are kept by the block of their readings: blocks with a
    reading on a date for which a reading, price or client state is new are built again, all others stay.
    Daily tables have a last column ``key_range``, the part that a merge rewrites.
    """

    def silver(t: str) -> DataFrame:
        return spark.table(f"{db}.silver_{t}")

    def changed(t: str) -> Changes:
        return Changes(spark, db, f"silver_{t}", f"gold_{dataset}_{t}")

    def listed(dates: DataFrame) -> list:
        return [r.date for r in dates.distinct().orderBy("date").collect()]  # a calendar, not rows

    done: dict[str, object] = {}
    prices = {t: changed(t) for t in ("gas_prices", "electricity_prices")}
    facts = changed(dataset)
    inputs = [*prices.values(), facts]
    if dataset == "train":
        client = changed("client")
        inputs.append(client)
        target = f"{db}.gold_consumption_production_aggregate"
        dates = None if facts.all else listed(dates_of(facts, "datetime"))
        if dates is None or dates:
            rows = silver(dataset) if dates is None else on_dates(silver(dataset), "datetime", dates)
            done["gold_consumption_production_aggregate"] = merge_dates(spark, target, consumption_production(rows), "date", dates)
        if any(c.any() for c in inputs) or not spark.catalog.tableExists(f"{db}.gold_all_features"):
            features_of(spark, db, dataset, grain, facts, prices, client, listed)
    target = f"{db}.gold_energy_prices_aggregate"
    whole = any(c.all for c in prices.values())
    new = [dates_of(c, "forecast_date") for c in prices.values() if c.any()]
    dates = None if whole else listed(new[0].unionByName(new[-1])) if new else []
    if dates is None or dates:
        e, g = (silver(t) if whole else on_dates(silver(t), "forecast_date", dates) for t in ("electricity_prices", "gas_prices"))
        done["gold_energy_prices_aggregate"] = merge_dates(spark, target, energy_prices_daily(e, g), "forecast_date", dates)
    stream_copy(spark, f"{db}.silver_{dataset}", checkpoint, f"{db}.gold_{dataset}")
    for c in inputs:
        c.remember()
    return done


def features_of(spark: SparkSession, db: str, dataset: str, grain: str, facts: Changes, prices: Mapping[str, Changes], client: Changes, listed) -> None:
    """Build the features of the blocks that the changes reach; all of them at first."""

    def silver(t: str) -> DataFrame:
        return spark.table(f"{db}.silver_{t}")

    name, block = f"{db}.gold_all_features", f"{dataset}_{BLOCK}"
    dims = {"gas_prices": ("forecast_date", 1), "electricity_prices": ("forecast_date", 1), "client": ("date", 0)}
    whole = facts.all or not spark.catalog.tableExists(name) or partition_columns(spark, name) != [block]
    tables = {t: silver(t) for t in dims}
    readings = silver(dataset)
    if not whole:
        changed = {**prices, "client": client}
        late = None
        for t, (ts, shift) in dims.items():
            if changed[t].any():
                own = dates_of(changed[t], ts, shift)
                late = own if late is None else late.unionByName(own)
        dates = listed(late) if late is not None else []
        blocks = {int(b) for b in facts.blocks if b != NO_VALUE}
        blocks |= {r[0] for r in on_dates(readings, "datetime", dates).select(BLOCK).distinct().collect()}  # one row per block
        if not blocks:
            return
        readings = readings.where(F.col(BLOCK).isin(sorted(blocks)))
        reached = listed(readings.select(F.to_date("datetime").alias("date")).where("date is not null"))
        tables = {t: on_dates(tables[t], ts, reached, shift) for t, (ts, shift) in dims.items()}
    features = build_gold_features(readings, tables["gas_prices"], tables["electricity_prices"], tables["client"], grain, dataset)
    if whole:
        write_table(features, name, "overwrite", [block])
    else:
        replace_partitions(features, name, [block])


def load_price_aggregates(spark: SparkSession, db: str) -> dict[str, object]:
    """The older gold tables: electricity and gas statistics apart, by the raw forecast date."""
    electricity = price_stats(
        spark.table(f"{db}.silver_electricity_prices"), "forecast_date", {"euros_per_mwh": "euros_per_mwh"}
    )
    gas = price_stats(
        spark.table(f"{db}.silver_gas_prices"),
        "forecast_date",
        {"lowest_price_per_mwh": "lowest_price_per_mwh", "highest_price_per_mwh": "highest_price_per_mwh"},
    )
    out = {}
    for table, data in (("gold_electricity_aggregate", electricity), ("gold_gas_prices_aggregate", gas)):
        out[table] = merge_sync(spark, f"{db}.{table}", data, ["forecast_date"], unique_checked=True)
    return out
