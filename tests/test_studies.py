from datetime import datetime

from pyspark.sql import functions as F

from curbline.plans import crash_studies, hump_effect
from tests.test_geometry import line

T = datetime


def test_repeated_street_ids_are_separate_rows(spark):
    """Street 1 has two rows of different geometry; only one of them lies along the hump line."""
    streets = line(spark, [(0, [[(0, 0), (100, 0)]]), (1, [[(0, 0), (0, 300)]]), (2, [[(0, 5000), (100, 5000)]])])
    streets = streets.select(
        F.when(F.col("id") == 2, 2).otherwise(1).cast("long").alias("physicalid"), "geometry",
        (F.lit(100.0) + F.col("id")).alias("shape_leng"), F.lit("1").alias("rw_type"), F.lit(None).cast("string").alias("bike_lane"),
        F.lit("TF").alias("trafdir"), F.lit(30.0).alias("st_width"),
    )
    humps = line(spark, [(7, [[(-5, 2), (105, 2)]]), (8, [[(-5, -2), (105, -2)]])]).select(
        F.col("id").alias("hump_id"), "geometry", F.col("id").alias("humps"), F.lit(110.0).alias("shape_leng"),
        F.lit(T(2016, 1, 1)).cast("timestamp_ntz").alias("date_insta"),
    )
    crashes = spark.createDataFrame(
        [(1, 50.0, 1.0, T(2013, 1, 1), 1, 0), (2, 50.0, 1.0, T(2016, 1, 1), None, None), (3, 50.0, 1.0, T(2018, 1, 1), 0, 0),
         (4, 0.0, 200.0, T(2012, 1, 1), 0, 0)],
        "collision_id long, x double, y double, crash_date timestamp_ntz, number_of_pedestrians_injured long, "
        "number_of_pedestrians_killed long",
    )
    found = hump_effect.hump_road_crashes(crashes, streets, humps, as_of=T(2020, 1, 1))
    per_road = hump_effect.crashes_per_road(found, as_of=T(2020, 1, 1)).collect()
    # two hump lines: every crash counts twice; the crash on the installation day counts as before
    assert sorted((r.physicalid, r.after_humps, r.collisions, r.humps, r.road_leng) for r in per_road) == [
        (1, False, 4, 8.0, 100.0), (1, True, 2, 8.0, 100.0)
    ]
    weeks = (T(2016, 1, 1) - T(2013, 1, 1)).days / 7
    before = next(r for r in per_road if not r.after_humps)
    assert abs(before.collisions_per_week - 4 / weeks) < 1e-9
    walked = hump_effect.crashes_per_road(found, as_of=T(2020, 1, 1), pedestrians=True).collect()
    assert sorted((r.after_humps, r.collisions, r.pedestrians_involved) for r in walked) == [(False, 2, 2), (True, 0, 0)]

    points = crashes.select("collision_id", "x", "y", F.col("crash_date").alias("datetime"))
    limits = spark.createDataFrame([(1, 50.0, 0.0, 30.0), (2, 60.0, 0.0, 20.0)], "limit_id long, x double, y double, postvz_sl double")
    centres = spark.createDataFrame([(1, 0.0, 250.0, 3)], "hump_id long, x double, y double, humps long")
    profile = crash_studies.street_profile(streets, limits, centres)
    rows = profile.select("shape_leng", "postvz_sl", "humps").collect()
    assert sorted(map(tuple, rows)) == [(100.0, 25.0, 0.0), (101.0, 20.0, 3.0), (102.0, 20.0, 0.0)]
    hourly = crash_studies.crashes_by_street_hour(profile, points)
    assert sorted((r.shape_leng, r.hour, r.crashes) for r in hourly.collect() if r.hour is not None) == [
        (100.0, 0, 3 / 4), (101.0, 0, 1 / 4)
    ]
    counted = crash_studies.crashes_by_street_hour(profile, points, count_missing_month=True)
    assert sorted(r.crashes for r in counted.collect()) == [0.0, 1 / 5, 3 / 5]
