"""Silver layer to customer, product and customer-ML feature layers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlens.operators import customers
from orderlens.sources import layers, scratch


def job_features(
    silver: DataFrame,
    path: str,
    fmt: str = layers.DEFAULT_FORMAT,
    csv_path: str | None = None,
    database: str | None = None,
    single_csv: bool = False,
) -> dict[str, DataFrame]:
    """Write the three feature layers, optionally as CSV extracts and catalog tables too.

    ``customer_features`` is cut from the written ML layer, so the customer aggregates
    and scores are computed once; extracts and tables copy written layers. An extract is
    one file only with ``single_csv``.
    """
    with scratch.scope(silver.sparkSession):
        ml = layers.write_layer(
            customers.customer_ml_features(silver), f"{path}/customer_ml_features", fmt
        )
        features = ml.select(customers.KEY, *customers.FEATURE_COLUMNS)
        written = {
            "customer_features": layers.write_layer(features, f"{path}/customer_features", fmt),
            "product_features": layers.write_layer(
                customers.product_features(silver), f"{path}/product_features", fmt
            ),
            "customer_ml_features": ml,
        }
        if csv_path:
            for name, layer in written.items():
                write = layers.write_csv_single if single_csv else layers.write_csv
                write(layer, f"{csv_path}/{name}")
        if database:
            layers.save_tables(silver.sparkSession, database, written)
    return written
