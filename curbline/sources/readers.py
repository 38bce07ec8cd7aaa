"""Scans of landed files, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions import geometry as geo
from curbline.functions.projection import (
    GEOGRAPHIC_CRS,
    PLANAR_CRS,
    point_from_lat_long,
    project_geometry,
)
from curbline.sources.catalog import Dataset, dataset


def scan_records_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One (nested) record per line."""
    return spark.read.schema(schema).json(path)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a header line. White space is data: it is kept as it is."""
    return spark.read.schema(schema).option("header", True).csv(path)


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_dataset(
    spark: SparkSession, name: str, folder: str, *, limit: int | None = None
) -> DataFrame:
    """Raw rows of a registered dataset landed under ``folder/name``, all of them unless
    ``limit`` is given."""
    entry = dataset(name)
    rows = spark.read.schema(entry.schema).format(entry.format).load(f"{folder.rstrip('/')}/{name}")
    return rows if limit is None else rows.limit(limit)


def to_layer(raw: DataFrame, entry: Dataset) -> DataFrame:
    """Planar layer of a raw dataset: ``x``, ``y`` for points, ``geometry`` for lines. Rows
    without a geometry are dropped, the raw geometry columns go."""
    if entry.geometry_column is None:
        return point_from_lat_long(raw, crs=entry.crs)
    column = F.col(entry.geometry_column)
    kind = dict(raw.dtypes)[entry.geometry_column]
    decoded = (
        geo.geometry_from_wkt(column)
        if kind == "string"
        else geo.geometry_from_geojson(column, is_text=False)
    )
    return _planar(raw.withColumn("geometry", decoded).drop(
        *([entry.geometry_column] if entry.geometry_column != "geometry" else [])
    ), entry.crs, entry.points)


def _planar(df: DataFrame, crs: str, points: bool) -> DataFrame:
    present = geo.drop_missing_geometry(df)
    if crs == GEOGRAPHIC_CRS:
        present = present.withColumn("geometry", project_geometry(F.col("geometry")))
    elif crs != PLANAR_CRS:
        raise ValueError(f"unknown coordinate system {crs!r}")
    if not points:
        return present
    first = geo.first_vertex(F.col("geometry"))
    return present.withColumns({"x": first["x"], "y": first["y"]}).drop("geometry")


def load_layer(
    spark: SparkSession, name: str, folder: str, *, limit: int | None = None
) -> DataFrame:
    return to_layer(scan_dataset(spark, name, folder, limit=limit), dataset(name))


def scan_geo_table(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    geometry_column: str = "geometry",
    crs: str = PLANAR_CRS,
    points: bool = False,
) -> DataFrame:
    """Reload a CSV table whose geometry is WKT text, projected if it is longitude/latitude."""
    rows = scan_csv(spark, path, schema)
    decoded = rows.withColumn("geometry", geo.geometry_from_wkt(F.col(geometry_column)))
    if geometry_column != "geometry":
        decoded = decoded.drop(geometry_column)
    return _planar(decoded, crs, points)
