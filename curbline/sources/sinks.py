"""Stored results."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions.geometry import GEOMETRY_TYPE, geometry_to_wkt
from curbline.session import exists, shared_dir


def sink_csv(df: DataFrame, path: str) -> str:
    """Header CSV; geometry columns become WKT text. Parts are written in parallel."""
    flat = df.select(
        *[
            geometry_to_wkt(F.col(f.name)).alias(f.name)
            if f.dataType.simpleString() == GEOMETRY_TYPE
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    # keep white space and tell an empty text from a missing one
    flat.write.mode("overwrite").option("header", True).option("emptyValue", '""').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def sink_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def materialize(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    *,
    parameters: dict | None = None,
    force: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """The stored table ``name`` for these parameters, built and stored when it is missing or
    ``force`` is set. The parameters are part of the path, so changing one never reads a table
    built with another."""
    key = hashlib.sha256(json.dumps(parameters or {}, sort_keys=True, default=str).encode()).hexdigest()
    path = f"{(folder or shared_dir(spark)).rstrip('/')}/{name}-{key[:16]}"
    # without the marker it was not stored yet, or the run storing it did not finish
    if not force and exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    sink_table(build(), path)
    return spark.read.parquet(path)
