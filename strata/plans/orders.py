"""Orders pipeline: customers and orders -> enriched orders -> country KPIs.

bronze: stamped raw tables with a row hash; silver: cleaned customers, orders
joined to them (inner), age and high-value flag, upserted into a versioned
layer; gold: one KPI row per country.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import high_value_flag
from strata.operators.clean import bronze_stamp, filter_not_null, normalize_text

# Columns the silver MERGE updates on a matched id.
ORDER_UPDATE_COLS = [
    "customer_id",
    "order_date",
    "amount",
    "status",
    "customer_name",
    "country",
    "order_age_days",
    "is_high_value",
    "_silver_ts",
]

HIGH_VALUE_THRESHOLD = 1000.0


def bronze(df: DataFrame, source: str = "postgres", ts: Column | None = None) -> DataFrame:
    """Raw rows + ``_ingestion_ts``, ``_source`` and ``_row_hash`` (raw columns)."""
    return bronze_stamp(df, source, ts)


def clean_customers(customers: DataFrame) -> DataFrame:
    """Trim name/country, upper-case and trim e-mail, drop NULL e-mails only
    (a blank e-mail stays)."""
    out = normalize_text(customers, {"name": ["trim"], "email": ["upper", "trim"], "country": ["trim"]})
    return filter_not_null(out, ["email"])


def _as_of_date(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast("date")


# Columns of the enriched orders that come from the two tables.
ENRICHED_COLUMNS = ["id", "customer_id", "order_date", "amount", "status", "customer_name", "country"]


def enrich_orders(
    orders: DataFrame,
    customers_clean: DataFrame,
    as_of: dt.date | str | Column | None = None,
    threshold: float = HIGH_VALUE_THRESHOLD,
    stamp: bool | Column = False,
) -> DataFrame:
    """Orders of known customers, with the customer's name and country, the age
    of the order and the high-value flag.

    The join is an inner one: orders of dropped customers and orders with a
    NULL customer fall out.
    """
    names = {"id": "customer_id", "name": "customer_name"}
    known = customers_clean.select(*[F.col(c).alias(names.get(c, c)) for c in ("id", "name", "country")])
    out = orders.join(known, "customer_id").select(*ENRICHED_COLUMNS)
    out = out.withColumns(
        {
            "order_age_days": F.datediff(_as_of_date(as_of), F.to_date("order_date")),
            "is_high_value": high_value_flag("amount", threshold),
        }
    )
    if stamp is not False:
        out = out.withColumn("_silver_ts", F.current_timestamp() if stamp is True else stamp)
    return out


def country_kpis(silver: DataFrame, stamp: bool = False) -> DataFrame:
    """Per country: order count, revenue sum/avg/max and completed orders
    (0, not NULL, when none is completed)."""
    out = silver.groupBy("country").agg(
        F.count("id").alias("total_orders"),
        F.sum("amount").alias("total_revenue"),
        F.avg("amount").alias("avg_order_value"),
        F.max("amount").alias("max_order_value"),
        F.sum(F.when(F.col("status") == "completed", 1).otherwise(0)).cast("bigint").alias("completed_orders"),
    )
    if stamp:
        out = out.withColumn("_gold_ts", F.current_timestamp())
    return out


def fill_order_defaults(orders: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Column defaults of the source DDL: status 'pending', order_date today."""
    return orders.withColumns(
        {
            "status": F.coalesce(F.col("status"), F.lit("pending")),
            "order_date": F.coalesce(F.col("order_date"), _as_of_date(as_of)),
        }
    )
