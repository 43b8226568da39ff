"""Silver and gold loads of the property tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.functions.expressions import bucketize, capped_count, presence_flag, ratio, yes_no, years_since
from tablework.operators.clean import fill_nulls
from tablework.operators.joins import enrich, enrich_state
from tablework.sinks.tables import write_table

# Range labels of the derived columns.
AGE_LABELS = ["0 - 10 years old", "10 - 60 years old", "60 or more years old"]
PATIO_LABELS = ["small", "medium", "large", "extra_large"]
ROOM_LABELS = ["small", "medium", "large"]
BUILT_LABELS = ["Over 60 Years", "10 to 50 years old", "Newer than 10 years"]

# Columns the gold table fills, and those it requires, where present.
GOLD_FILLS = {
    "BuildingQualityTypeDesc": "No information",
    "calculatedfinishedsquarefeet": 0,
    "fireplaceflag": False,
    "fullbathcnt": 0,
    "hashottuborspa": False,
    "lotsizesquarefeet": 0,
    "unitcnt": 0,
}
GOLD_REQUIRED = [
    "bathroomcnt",
    "bedroomcnt",
    "fips",
    "latitude",
    "longitude",
    "propertycountylandusecode",
    "propertylandusetypeid",
    "PropertyLandUseDesc",
    "regionidzip",
    "censustractandblock",
    "state_code",
    "roomcnt",
    "taxvaluedollarcnt",
]


def age_group(built: str | Column, today: Column) -> Column:
    return bucketize(years_since(built, today), [10, 60], AGE_LABELS, closed="right")


def patio_size(col: str | Column = "yardbuildingsqft17") -> Column:
    return bucketize(col, [200, 300, 400], PATIO_LABELS, null_label="none", zero_label="none")


def room_category(col: str | Column = "roomcnt") -> Column:
    return bucketize(col, [4, 8], ROOM_LABELS, closed="right", null_label="none", zero_label="none")


def unit_category(col: str | Column = "unitcnt") -> Column:
    return capped_count(col, 5)


def built_category(col: str | Column = "yearbuilt", edges: Sequence[int] = (1960, 2010)) -> Column:
    """Year ranges; an unknown year or year 0 means there is no structure."""
    return bucketize(col, list(edges), BUILT_LABELS, null_label="No Structure", zero_label="No Structure")


def derived_columns(today: Column, available: Sequence[str]) -> dict[str, Column]:
    """The derived gold columns whose inputs are available."""
    needs: dict[str, tuple[tuple[str, ...], Column]] = {
        "Age_Group": (("yearbuilt",), age_group("yearbuilt", today)),
        "hasdeck": (("decktypeid",), presence_flag("decktypeid")),
        "hasbasement": (("basementsqft",), presence_flag("basementsqft")),
        "hashottub": (("pooltypeid10", "pooltypeid2"), presence_flag("pooltypeid10", "pooltypeid2")),
        "hasyardstorage": (("yardbuildingsqft26",), presence_flag("yardbuildingsqft26")),
        "landpricepersqft": (
            ("landtaxvaluedollarcnt", "lotsizesquarefeet"),
            ratio("landtaxvaluedollarcnt", "lotsizesquarefeet"),
        ),
        "lotexists": (("lotsizesquarefeet",), presence_flag("lotsizesquarefeet")),
        "patiosize": (("yardbuildingsqft17",), patio_size()),
        "pool": (("poolcnt",), yes_no("poolcnt")),
        "roomcntcat": (("roomcnt",), room_category()),
        "unitcntcat": (("unitcnt",), unit_category()),
    }
    return {out: expr for out, (cols, expr) in needs.items() if set(cols) <= set(available)}


def gold_properties(
    silver: DataFrame,
    columns: Sequence[str],
    today: Column | None = None,
    fills: Mapping[str, object] = GOLD_FILLS,
    required: Sequence[str] = GOLD_REQUIRED,
) -> DataFrame:
    """Select, derive from the raw values, then fill, then drop rows without a required value."""
    today = F.current_date() if today is None else today
    data = silver.select(*columns)
    data = data.withColumns(derived_columns(today, columns))
    data = fill_nulls(data, {c: v for c, v in fills.items() if c in columns})
    return data.na.drop("any", subset=[c for c in required if c in columns])


def load_property_silver(
    properties: DataFrame,
    lookups: Sequence[tuple[str, DataFrame, str, Sequence[str]]],
    states: DataFrame,
    name: str,
    county_code: str = "fips",
    state_key: str = "state_fips",
    partition_by: Sequence[str] | None = ("file_year",),
) -> DataFrame:
    """Add all descriptions and the state, then store.

    Partitioned by file year; a partition per neighbourhood would make one small file for each of
    thousands of values and task.
    """
    data = enrich_state(enrich(properties, lookups), states, county_code, state_key)
    return write_table(data, name, partition_by=list(partition_by) if partition_by else None)


def load_property_gold(silver: DataFrame, columns: Sequence[str], name: str, today: Column | None = None) -> DataFrame:
    return write_table(gold_properties(silver, columns, today), name)
