"""SQL access: register the warehouse tables as temporary views.

``register_warehouse(spark, sf_dir)`` names every fact, dimension and mart
like the reference's tables (``fact_ecommerce_daily``, ``dim_date``,
``cross_channel_daily``, ...) so existing SQL runs unchanged through
``spark.sql``; Catalyst plans it exactly like the DataFrame API.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from martline.plans import dims, marts
from martline.plans import warehouse as wh
from martline.sources import views


def warehouse_tables(spark: SparkSession, sf_dir: str) -> dict:
    tables = {n: fn(spark, sf_dir) for n, fn in wh.FACT_NAMES.items()}
    tables.update({
        "dim_date": wh.date_spine(spark, sf_dir),
        "dim_geography": wh.geography(spark, sf_dir),
        "dim_channel": dims.channel_dim(spark),
        "dim_campaign_initiative": dims.initiative_dim(spark),
        "dim_podcast": dims.show_dim(views.v_mentions(spark, sf_dir)),
        "airport_lookup": wh.airport_lookup(spark, sf_dir),
        "cross_channel_daily": wh.cross_channel(spark, sf_dir),
    })
    daily = tables["cross_channel_daily"]
    tables["lag_correlations"] = marts.lag_correlations(daily)
    tables["lag_correlations_resid"] = marts.lag_correlations(daily, residual=True)
    tables["promo_impact_summary"] = marts.promo_impact(wh.transactions_clean(spark, sf_dir))
    return tables


def register_warehouse(spark: SparkSession, sf_dir: str) -> list[str]:
    """Create (or replace) one temporary view per table; returns the view names."""
    names = []
    for name, df in warehouse_tables(spark, sf_dir).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return sorted(names)
