"""Registry of this subpackage's queries and of their SQL."""

from pyspark.sql import DataFrame, SparkSession

from parley.registry.base import ship_package

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a function (spark, sf_dir) -> DataFrame; `sql` gives the same rows in DuckDB."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
