"""Registry of named queries over the given tables, each with its SQL counterpart where one exists."""

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

QUERIES = {}
ORACLES = {}
_SHIPPED = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they start (as --py-files)."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        target = os.path.join(tempfile.mkdtemp(prefix="parley-code-"), "parley")
        spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "parley"))
        _SHIPPED.add(app)


def query(name, sql=None):
    """Register a function (spark, sf_dir) -> DataFrame; `sql` gives the same rows in DuckDB."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return ", ".join(sql_text(v) for v in values)
