"""Run SQL text over the star (Spark SQL, Catalyst-planned).

:func:`register_views` exposes the star's tables under their warehouse names
(``dim_date``, ``dim_product``, ``dim_store``, ``dim_customer``,
``stg_sales``, ``fact_sales``); :func:`run_query` parses SQL with ANSI
double-quoted identifiers so a column named ``"2025-01"`` reads as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.plans.star import Star

VIEWS = ("dim_date", "dim_product", "dim_store", "dim_customer", "stg_sales", "fact_sales")


def register_views(star: Star) -> None:
    """Expose the star as temp views. Dimensions under the size bound carry
    their broadcast hint inside the view, so plain SQL joins get it too."""
    star.date_dim().createOrReplaceTempView("dim_date")
    star.dim("product").createOrReplaceTempView("dim_product")
    star.dim("store").createOrReplaceTempView("dim_store")
    star.dim("customer").createOrReplaceTempView("dim_customer")
    star.stg_sales.createOrReplaceTempView("stg_sales")
    star.fact.createOrReplaceTempView("fact_sales")


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Analyse ``sql`` with ANSI double-quoted identifiers (which need ANSI
    mode), then restore the session's settings."""
    keys = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        return spark.sql(sql)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
