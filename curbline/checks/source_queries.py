"""Scans and sinks: the layers are written, read back and must be unchanged."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.checks import fixtures as fx
from curbline.checks.registry import query
from curbline.session import scratch_path
from curbline.sources import readers, sinks
from curbline.sources.catalog import CATALOG


def _record(geometry: str = "geometry"):
    """GeoJSON record of a one-part line."""
    pairs = F.transform(F.col(geometry)[0], lambda v: F.array(v["x"], v["y"]))
    return F.struct(F.lit("LineString").alias("type"), pairs.alias("coordinates"))


def _point_record(lon, lat):
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def _as_text(df, *keep):
    return df.select(*[F.col(c).cast("string").alias(c) if c not in keep else F.col(c) for c in df.columns])


def land(spark, sf_dir, folder):
    """Write the layers as the record service would deliver them, geometry in degrees: the planar
    feet are scaled down to a small patch of the projection's area."""
    def degrees(layer):
        patch = F.transform(
            "geometry",
            lambda part: F.transform(part, lambda v: F.struct(
                (v["x"] / 1e6 - 74.1).alias("x"), (v["y"] / 1e6 + 40.5).alias("y"))),
        )
        return layer.withColumn("geometry", patch).withColumn("the_geom", _record()).drop("geometry")

    def point(layer, column):
        record = _point_record(F.col("x") / 1e6 - 74.1, F.col("y") / 1e6 + 40.5)
        return layer.withColumn(column, record).drop("x", "y")

    volumes = fx.traffic_volumes(spark, sf_dir)
    wkt = F.concat(F.lit("POINT ("), F.col("x").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit(")"))
    tables = {
        "crashes": fx.raw_crashes(spark, sf_dir).select(
            "collision_id", "crash_date", "crash_time", "latitude", "longitude"),
        "centerline": degrees(fx.all_streets(spark, sf_dir)),
        "speedlimits": degrees(fx.speedlimits(spark, sf_dir)),
        "speedhumps": degrees(fx.speedhumps(spark, sf_dir)),
        "trees": point(fx.trees(spark, sf_dir), "the_geom"),
        "traffic_volumes": volumes.withColumn("wktgeom", wkt).drop("x", "y", "site_id"),
        "parking_meters": point(fx.parking_meters(spark, sf_dir), "location"),
    }
    for name, table in tables.items():
        _as_text(table, "the_geom", "location").write.json(f"{folder}/{name}")
    return folder


@query("dataset_catalog", fx.with_layers(
    "raw_crashes all_streets speedlimits speedhumps trees traffic_volumes parking_meters", """
    SELECT 'crashes' AS name, NULL::VARCHAR AS geometry_column, 'EPSG:4326' AS crs, count(latitude) AS rows FROM raw_crashes
    UNION ALL SELECT 'centerline', 'the_geom', 'EPSG:4326', count(*) FROM all_streets
    UNION ALL SELECT 'speedlimits', 'the_geom', 'EPSG:4326', count(*) FROM speedlimits
    UNION ALL SELECT 'speedhumps', 'the_geom', 'EPSG:4326', count(*) FROM speedhumps
    UNION ALL SELECT 'trees', 'the_geom', 'EPSG:4326', count(*) FROM trees
    UNION ALL SELECT 'traffic_volumes', 'wktgeom', 'EPSG:2263', count(*) FROM traffic_volumes
    UNION ALL SELECT 'parking_meters', 'location', 'EPSG:4326', count(*) FROM parking_meters"""))
def _(spark, sf_dir):
    folder = land(spark, sf_dir, scratch_path(spark, "landed"))
    result = None
    for name, entry in CATALOG.items():
        one = readers.load_layer(spark, name, folder).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), F.lit(entry.geometry_column).cast("string").alias("geometry_column"),
            F.lit(entry.crs).alias("crs"), "rows",
        )
        result = one if result is None else result.unionByName(one)
    return result


@query("scan_dataset", fx.with_layers(
    "traffic_volumes", "SELECT x, y, vol, yr, m, d FROM traffic_volumes"))
def _(spark, sf_dir):
    folder = scratch_path(spark, "landed")
    volumes = fx.traffic_volumes(spark, sf_dir)
    wkt = F.format_string("POINT (%.3f %.3f)", "x", "y")
    _as_text(volumes.withColumn("wktgeom", wkt).drop("x", "y", "site_id")).write.json(f"{folder}/traffic_volumes")
    layer = readers.load_layer(spark, "traffic_volumes", folder)
    return layer.select(
        "x", "y", F.col("vol").cast("double").alias("vol"), *[F.col(c).cast("int").alias(c) for c in ("yr", "m", "d")]
    )


@query("scan_records_json", fx.with_layers(
    "all_streets", "SELECT physicalid, st_name, x0, y0, x1, y1 FROM all_streets"))
def _(spark, sf_dir):
    path = scratch_path(spark, "records")
    streets = fx.all_streets(spark, sf_dir).withColumn("the_geom", _record()).drop("geometry")
    _as_text(streets, "the_geom").write.json(path)
    raw = readers.scan_records_json(spark, path, CATALOG["centerline"].schema)
    entry = CATALOG["centerline"]
    layer = readers.to_layer(raw, type(entry)(**{**entry.__dict__, "crs": "EPSG:2263"}))
    a, b = F.col("geometry")[0][0], F.col("geometry")[0][1]
    return layer.select(
        F.col("physicalid").cast("long").alias("physicalid"), "st_name",
        a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1"),
    )


@query("scan_csv", fx.with_layers(
    "raw_crashes", "SELECT collision_id, latitude, persons_injured, on_street_name, off_street_name FROM raw_crashes"))
def _(spark, sf_dir):
    crashes = fx.raw_crashes(spark, sf_dir).select(
        "collision_id", "latitude", "persons_injured", "on_street_name", "off_street_name"
    )
    path = sinks.sink_csv(crashes, scratch_path(spark, "crashes"))
    return readers.scan_csv(
        spark, path,
        "collision_id long, latitude double, persons_injured long, on_street_name string, off_street_name string",
    )


@query("scan_geo_table", fx.with_layers(
    "speedhumps", "SELECT hump_id, round(x0, 6) + 0 AS x0, round(y1, 6) + 0 AS y1 FROM speedhumps"))
def _(spark, sf_dir):
    humps = fx.speedhumps(spark, sf_dir).select("hump_id", "geometry")
    path = sinks.sink_csv(humps, scratch_path(spark, "humps"))
    table = readers.scan_geo_table(spark, path, "hump_id long, geometry string")
    line = F.col("geometry")[0]
    return table.select(
        "hump_id", F.round(line[0]["x"], 6).alias("x0"), F.round(line[1]["y"], 6).alias("y1")
    )


@query("sink_csv", fx.with_layers(
    "crashes", "SELECT collision_id, crash_date, x, y, number_of_pedestrians_injured FROM crashes"))
def _(spark, sf_dir):
    crashes = fx.crashes(spark, sf_dir).select(
        "collision_id", "crash_date", "x", "y", "number_of_pedestrians_injured"
    )
    path = sinks.sink_csv(crashes, scratch_path(spark, "crashes"))
    return readers.scan_csv(
        spark, path,
        "collision_id long, crash_date timestamp_ntz, x double, y double, number_of_pedestrians_injured long",
    )


@query("sink_table", fx.with_layers(
    "speedhumps", "SELECT hump_id, humps, date_insta, round(shape_leng, 6) AS shape_leng FROM speedhumps"))
def _(spark, sf_dir):
    path = sinks.sink_table(fx.speedhumps(spark, sf_dir), scratch_path(spark, "humps"))
    return readers.scan_table(spark, path).select(
        "hump_id", "humps", "date_insta", F.round("shape_leng", 6).alias("shape_leng")
    )


@query("materialize", fx.with_layers(
    "crashes", "SELECT CAST(year(crash_date) AS INTEGER) AS year, count(*) AS crashes FROM crashes GROUP BY 1"))
def _(spark, sf_dir):
    crashes = fx.crashes(spark, sf_dir)

    def build():
        return crashes.groupBy(F.year("crash_date").alias("year")).agg(F.count(F.lit(1)).alias("crashes"))

    parameters = {"table": sf_dir, "session": spark.sparkContext.applicationId}
    sinks.materialize(spark, "crashes-per-year", build, parameters=parameters, force=True)
    return sinks.materialize(spark, "crashes-per-year", build, parameters=parameters)


