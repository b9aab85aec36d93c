"""The source tables of the workload and the moments at which it looks at them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# up to here a replica has been synced before; what came later is the delta
EVENTS_SYNCED = "2024-01-16 00:00:00"
ORDERS_SYNCED = "1998-06-15 00:00:00"
LINES_SYNCED = "1999-01-01 00:00:00"

POLICY_SKIP = ("embeddings", "pages")
# 'lineitems' is misspelt on purpose
POLICY_INCREMENTAL = {
    "events": {"field": "ts", "pk": "event_id"},
    "orders": {"field": "o_orderkey"},
    "lineitem": {"field": "l_shipdate"},
    "conversations": {"field": "conv_id", "pk": "conv_id,turn"},
    "lineitems": {"field": "l_shipdate"},
}

# A catalog of an older system, one table per part, as SQL for the other engine.
LEGACY_CATALOG = """
WITH p AS (
  SELECT concat(replace(p_name, ' ', '_'), cast(p_partkey AS varchar(20))) AS base, p_brand, p_type, p_size, p_retailprice
  FROM {part}
)
SELECT concat(base, 's') AS table_name, 1 AS ordinal, concat(replace(p_brand, '#', ''), 'Code') AS name, 'str' AS type FROM p
UNION ALL
SELECT concat(base, 's'), 2, CASE WHEN p_size > 40 THEN 'Comment' WHEN p_size > 5 THEN 'CustomerID' ELSE 'Text' END, 'int' FROM p
UNION ALL
SELECT concat(base, 's'), 3, CASE WHEN p_size > 20 THEN concat(upper(base), 'Id') ELSE 'Title' END, 'int' FROM p
UNION ALL
SELECT concat(base, 's'), 4,
       CASE p_type WHEN 'ECONOMY' THEN 'ModifiedDate' WHEN 'STANDARD' THEN 'last_updated' WHEN 'PROMO' THEN 'Changed' ELSE 'Notes' END,
       CASE WHEN p_size > 15 THEN 'datetime' ELSE 'str' END FROM p
UNION ALL
SELECT concat(base, 's'), 5, CASE WHEN p_retailprice > 980 THEN 'Status' WHEN p_retailprice > 950 THEN 'is_deleted' ELSE 'Memo' END, 'int' FROM p
UNION ALL
SELECT concat(base, 's'), 6, CASE WHEN p_size = 1 THEN 'ID' WHEN p_size < 10 THEN 'updated' ELSE 'Active' END, 'date' FROM p
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf_dir, t) for t in TABLES}


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")
