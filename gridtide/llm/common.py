"""What the text operators share: tables, ASCII case, row keys and tables that outlive an executor."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterable

import gridtide
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.sources.scratch import delete, fresh_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The white space of the contracts: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application: Python tasks import it by name."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = os.path.realpath(tempfile.mkdtemp(prefix="gridtide-"))
        source = os.path.dirname(os.path.abspath(gridtide.__file__))
        copy = os.path.join(folder, "code", "gridtide")
        shutil.copytree(source, copy, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(os.path.join(folder, "gridtide"), "zip", os.path.dirname(copy)))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole(text: Column) -> Column:
    """Text as a value: null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; pure ASCII takes the compiled way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id; only ever compared beside that id."""
    return F.xxhash64(whole(text))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without columns of these names, so that computed ones can take them."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def durable(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: lineage ends there, and no executor owns it."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    held = spark.read.schema(df.schema).parquet(path)
    held.durable_path = path
    return held


def release(*frames: DataFrame) -> None:
    """Deletes durable tables that nothing to come reads."""
    for frame in frames:
        delete(frame.sparkSession, frame.durable_path)
