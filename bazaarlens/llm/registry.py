"""Queries of this package by name, and their check SQL."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import bazaarlens

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, once for each application, unless their path has it already."""
    root = Path(bazaarlens.__file__).resolve().parents[1]
    places = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in [Path(p).resolve() for p in places]:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/bazaarlens", "zip", root, "bazaarlens")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def shipped(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage (spark first) whose workers can import the package."""

    @functools.wraps(fn)
    def call(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return fn(spark, *args)

    return call


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        fn = QUERIES[name] = shipped(fn)
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
