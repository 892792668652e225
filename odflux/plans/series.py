"""Historical and new series as one long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odflux.operators.filters import drop_self_flows, year_before
from odflux.operators.lookups import Lookup
from odflux.operators.recode import as_recode_lookup, recode_both_ends
from odflux.operators.reshape import unpivot_age
from odflux.operators.sets import union_by_name
from odflux.sources.releases import combine_cleaned
from odflux.sources.sinks import WriteSummary, write_partitioned

# First year of the new series, and the vintages of the two series.
FIRST_NEW_YEAR = 2012
OLD_VINTAGE = 2021
NEW_VINTAGE = 2023


def combine_series(
    historical: DataFrame,
    new_wide: DataFrame,
    changes: DataFrame | Lookup,
    first_new_year: int = FIRST_NEW_YEAR,
    old_vintage: int = OLD_VINTAGE,
    new_vintage: int = NEW_VINTAGE,
    unique_keys: bool = False,
) -> DataFrame:
    """Old years recoded at both ends, new years unpivoted, flows within an area left out.

    ``unique_keys`` says that the historical series holds no key twice.
    """
    lookup = changes if isinstance(changes, Lookup) else as_recode_lookup(changes, old_vintage, new_vintage)
    old = recode_both_ends(year_before(historical, first_new_year), lookup, unique_keys=unique_keys)
    return drop_self_flows(union_by_name([old, unpivot_age(new_wide)]))


def write_series(combined: DataFrame, root: str, rebalance: bool = True) -> WriteSummary:
    return write_partitioned(combined, root, rebalance=rebalance)


def build_series(
    spark: SparkSession, cleaned_root: str, historical: DataFrame, changes: DataFrame | Lookup, root: str
) -> WriteSummary:
    """From cleaned yearly sheets and the historical series to the dataset by year."""
    new_wide = combine_cleaned(spark, cleaned_root)
    if new_wide is None:
        raise FileNotFoundError(f"no sheets under {cleaned_root}")
    return write_series(combine_series(historical, new_wide, changes), root)
