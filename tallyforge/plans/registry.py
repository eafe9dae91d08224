"""The driver queries by inventory id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


#: Queries that return a day: it is shown as text, as engines differ in how they hand dates to a client.
DAYS = {
    **dict.fromkeys(["agg_01_aggregate_arm", "agg_02_absent_latency", "agg_03_set_hash", "agg_05_paired_compare", "agg_09_anchor_census"], "night"),
    **dict.fromkeys(["evt_03_night_events", "evt_04_promote_nights", "str_08_night_aggregates", "src_06_discover_nights", "win_04_dedupe_nights", "win_15_select_capped"], "night"),
    "src_05_recent_days": "dt",
}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL where SQL can say it."""

    def add(function: Query) -> Query:
        day = DAYS.get(name)
        QUERIES[name] = (lambda spark, sf: function(spark, sf).withColumn(day, F.col(day).cast("string"))) if day else function
        if oracle:
            ORACLES[name] = f"SELECT * REPLACE (CAST({day} AS VARCHAR) AS {day}) FROM ({oracle})" if day else oracle
        return function

    return add
