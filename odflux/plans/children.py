"""Net flows of children, long and wide, written out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from odflux.operators.children import CHILD_AGE, children_net, children_net_wide
from odflux.operators.flows import Geography
from odflux.sources.sinks import write_csv, write_parquet


def write_children_flows(
    flows: DataFrame,
    region: Geography,
    inner_outer: Geography,
    root: str,
    max_age: int = CHILD_AGE,
    ages: Sequence[int] | None = None,
) -> None:
    """Long net flows as Parquet and, from that table, the wide ones as CSV."""
    write_parquet(children_net(flows, region, inner_outer, max_age), f"{root}/net_flows")
    net = flows.sparkSession.read.parquet(f"{root}/net_flows")
    write_csv(children_net_wide(net, range(max_age + 1) if ages is None else ages), f"{root}/net_flows_wide")
