"""Gross and aggregated flows of all geographies, written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflux.operators.flows import Geography, gross_by_geography, gross_flows, od_by_geography
from odflux.sources.sinks import write_parquet


def write_area_flows(flows: DataFrame, geographies: list[Geography], root: str, decimals: int = 1) -> None:
    """Local gross flows, one table of pairs per geography, and the reported gross flows.

    The flow table is read twice: once for the local areas, once for all
    geographies together. The pairs are small and kept while they are written.
    """
    write_parquet(gross_flows(flows, decimals), f"{root}/lad_gross_flows")
    od = od_by_geography(flows, geographies).persist()
    try:
        for geography in geographies:
            pairs = od.where(F.col("geography") == geography.name).drop("geography")
            write_parquet(pairs, f"{root}/{geography.name}_od_series")
        write_parquet(gross_by_geography(od, geographies, decimals), f"{root}/final_gross_flows")
    finally:
        od.unpersist()
