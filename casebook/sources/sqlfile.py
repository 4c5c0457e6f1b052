"""Run a SQL text file over registered views.

Any statement that yields rows returns a DataFrame - ``WITH ...`` queries
included. The file is a small query text read on the driver; the data stays
in the views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql_file(spark: SparkSession, path: str, views: dict[str, DataFrame] | None = None,
                 args: dict | None = None) -> DataFrame:
    register_views(views or {})
    with open(path, encoding="utf-8") as fh:
        text = fh.read().strip().rstrip(";")
    return spark.sql(text, args=args) if args else spark.sql(text)
