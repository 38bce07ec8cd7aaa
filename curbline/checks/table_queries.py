"""Joins, filters, projections, aggregates, scalar functions, sorting and de-duplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from curbline.checks import fixtures as fx
from curbline.checks.geometry_queries import streets
from curbline.checks.registry import query
from curbline.functions import geometry as geo
from curbline.functions import transforms as tr
from curbline.operators import aggregates as ag
from curbline.operators import intervals as iv
from curbline.operators import relational as rel

H0, H1 = "TIMESTAMP '1995-01-01'", "TIMESTAMP '2001-09-01'"


def ntz(moment: datetime):
    return F.lit(moment).cast("timestamp_ntz")


def hump_dates(spark, sf_dir):
    """Installation per street, by plain key."""
    return fx.speedhumps(spark, sf_dir).select(F.col("hump_id").alias("physicalid"), "humps", "date_insta")


# --- joins

@query("left_equi_join", fx.with_layers("streets speedhumps", """
    SELECT s.physicalid, s.st_name, h.humps, h.date_insta FROM streets s
    LEFT JOIN speedhumps h ON h.hump_id = s.physicalid"""))
def _(spark, sf_dir):
    return streets(spark, sf_dir).select("physicalid", "st_name").join(
        hump_dates(spark, sf_dir), "physicalid", "left"
    )


@query("multi_left_join", fx.with_layers("streets speedhumps", """
    SELECT s.physicalid, a.orders, b.quantity, c.humps FROM streets s
    LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) a ON a.o_custkey = s.physicalid
    LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1) b ON b.l_partkey = s.physicalid
    LEFT JOIN (SELECT hump_id, humps FROM speedhumps) c ON c.hump_id = s.physicalid"""))
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(
        F.col("o_custkey").alias("physicalid")
    ).agg(F.count(F.lit(1)).alias("orders"))
    quantity = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(
        F.col("l_partkey").alias("physicalid")
    ).agg(F.sum("l_quantity").alias("quantity"))
    humps = hump_dates(spark, sf_dir).select("physicalid", "humps")
    return rel.multi_left_join(
        [streets(spark, sf_dir).select("physicalid"), orders, quantity, humps], ["physicalid"]
    )


def _status_means(spark, sf_dir, status):
    return (
        spark.read.parquet(f"{sf_dir}/orders.parquet").where(F.col("o_orderstatus") == status)
        .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.avg("o_totalprice").alias("price"))
    )


@query("inner_join_suffixes", """
    SELECT a.o_custkey, a.orders AS orders_before, b.orders AS orders_after,
           round(a.price, 6) AS price_before, round(b.price, 6) AS price_after
    FROM (SELECT o_custkey, count(*) AS orders, avg(o_totalprice) AS price FROM orders
          WHERE o_orderstatus = 'O' GROUP BY 1) a
    JOIN (SELECT o_custkey, count(*) AS orders, avg(o_totalprice) AS price FROM orders
          WHERE o_orderstatus = 'F' GROUP BY 1) b ON a.o_custkey = b.o_custkey""")
def _(spark, sf_dir):
    joined = rel.inner_join_suffixes(
        _status_means(spark, sf_dir, "O"), _status_means(spark, sf_dir, "F"), ["o_custkey"]
    )
    return joined.withColumns(
        {c: F.round(c, 6) for c in ("price_before", "price_after")}
    )


@query("before_after_left_join", """
    SELECT b.o_custkey, round(b.o_totalprice, 4) AS price_before, round(a.o_totalprice, 4) AS price_after
    FROM orders b JOIN orders a ON a.o_custkey = b.o_custkey
    WHERE b.o_orderstatus <> 'F' AND a.o_orderstatus = 'F'""")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("done", F.col("o_orderstatus") == "F")
    pairs = rel.before_after_left_join(
        orders, "o_custkey", "done", "o_totalprice", ("price_before", "price_after")
    )
    return pairs.select(
        "o_custkey", F.round("price_before", 4).alias("price_before"), F.round("price_after", 4).alias("price_after")
    )


@query("replace_by_group_values", """
    SELECT l_orderkey, l_linenumber, max(l_quantity) OVER (PARTITION BY l_partkey) AS l_quantity,
           max(l_shipdate) OVER (PARTITION BY l_partkey) AS l_shipdate, l_partkey FROM lineitem""")
def _(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"
    )
    return rel.replace_by_group_values(lines, "l_partkey", ["l_quantity", "l_shipdate"])


@query("cross_join_densify", """
    SELECT c.c_custkey, f.urgent, coalesce(o.orders, 0) AS orders
    FROM customer c CROSS JOIN (SELECT false AS urgent UNION ALL SELECT true) f
    LEFT JOIN (SELECT o_custkey, o_orderpriority = '1-URGENT' AS urgent, count(*) AS orders
               FROM orders GROUP BY 1, 2) o ON o.o_custkey = c.c_custkey AND o.urgent = f.urgent""")
def _(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    facts = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .groupBy(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return rel.densify(customers, facts, ["c_custkey"], "urgent", ["orders"])


_INTERVALS_BY_KEY = f"""
    SELECT s.physicalid, coalesce(h.date_insta, {H0}) AS after, {H1} AS until, h.date_insta IS NOT NULL AS has_humps
    FROM streets s LEFT JOIN speedhumps h ON h.hump_id = s.physicalid
    UNION ALL
    SELECT s.physicalid, {H0}, h.date_insta, false FROM streets s JOIN speedhumps h ON h.hump_id = s.physicalid"""


def intervals_by_key(spark, sf_dir):
    dated = streets(spark, sf_dir).select("physicalid").join(
        hump_dates(spark, sf_dir).select("physicalid", "date_insta"), "physicalid", "left"
    )
    return iv.validity_split(dated, "date_insta", "has_humps", horizon=fx.HORIZON)


@query("validity_split", fx.with_layers("streets speedhumps", "SELECT * FROM rows", rows=_INTERVALS_BY_KEY))
def _(spark, sf_dir):
    return intervals_by_key(spark, sf_dir)


@query("union_all_by_name", fx.with_layers(
    "streets speedhumps", "SELECT physicalid, after, until, has_humps FROM rows", rows=_INTERVALS_BY_KEY))
def _(spark, sf_dir):
    start, end = (ntz(t) for t in fx.HORIZON)
    dated = streets(spark, sf_dir).select("physicalid").join(
        hump_dates(spark, sf_dir), "physicalid", "left"
    )
    new = dated.select(
        "physicalid", F.coalesce("date_insta", start).alias("after"), end.alias("until"),
        F.col("date_insta").isNotNull().alias("has_humps"),
    )
    old = dated.where(F.col("date_insta").isNotNull()).select(
        F.lit(False).alias("has_humps"), F.col("date_insta").alias("until"), start.alias("after"), "physicalid"
    )
    return new.unionByName(old)


@query("interval_join", fx.with_layers("streets speedhumps", """
    SELECT r.physicalid, r.after, r.until, count(l.l_shipdate) AS events FROM rows r
    LEFT JOIN lineitem l ON l.l_partkey = r.physicalid AND l.l_shipdate > r.after AND l.l_shipdate <= r.until
    GROUP BY 1, 2, 3""", rows=_INTERVALS_BY_KEY))
def _(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_partkey").alias("physicalid"), F.col("l_shipdate").alias("t")
    )
    return iv.interval_join(
        intervals_by_key(spark, sf_dir), events, "physicalid", "t",
        keys=["physicalid", "after", "until"], name="events",
    )


@query("semi_join_isin", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _(spark, sf_dir):
    ids = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("o_custkey")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return rel.semi_join_isin(orders, ids, "o_custkey")


@query("anti_join_isin", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _(spark, sf_dir):
    ids = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("o_custkey")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return rel.anti_join_isin(orders, ids, "o_custkey")


@query("anti_join_rows", fx.with_layers("raw_crashes", """
    SELECT collision_id FROM raw_crashes
    WHERE NOT (latitude IS NULL AND coalesce(persons_injured + persons_killed > 0, false))"""))
def _(spark, sf_dir):
    raw = fx.raw_crashes(spark, sf_dir)
    chosen = rel.unlocated_injury_filter(raw)
    return rel.anti_join_isin(raw, chosen, "collision_id").select("collision_id")


# --- projections, filters, casts, conditionals

@query("select_drop_rename", fx.with_layers(
    "all_streets", "SELECT physicalid AS id, st_width, shape_leng AS road_leng FROM all_streets"))
def _(spark, sf_dir):
    kept = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "shape_leng", "bike_lane").drop("bike_lane")
    return kept.withColumnsRenamed({"physicalid": "id", "shape_leng": "road_leng"})


@query("street_filter", fx.with_layers("streets", "SELECT physicalid, shape_leng FROM streets"))
def _(spark, sf_dir):
    return streets(spark, sf_dir).select("physicalid", "shape_leng")


@query("cast_columns", """
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, CAST(o_date AS TIMESTAMP) AS day, TRY_CAST(p_type AS INTEGER) AS bad
    FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, p_type,
                 strftime(TIMESTAMP '1995-01-01' + to_days(p_size), '%Y-%m-%d') AS o_date FROM part)""")
def _(spark, sf_dir):
    text = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", F.col("p_size").cast("string").alias("size"), F.col("p_type").alias("bad"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size")).cast("string").alias("day"),
    )
    cast = rel.cast_columns(text, {"size": "double", "day": "timestamp_ntz"})
    return rel.cast_columns(cast, {"bad": "int"}, strict=False)


@query("is_present_flag", fx.with_layers(
    "all_streets", "SELECT physicalid, bike_lane IS NOT NULL AS has_bike_lane FROM all_streets"))
def _(spark, sf_dir):
    flagged = rel.is_present_flag(fx.all_streets(spark, sf_dir), "bike_lane", "has_bike_lane")
    return flagged.select("physicalid", "has_bike_lane")


@query("positive_flag", fx.with_layers(
    "all_streets", "SELECT physicalid, coalesce(CAST(bike_lane AS DOUBLE) > 0, false) AS on_lane, "
    "coalesce(st_width > 0, false) AS wide FROM all_streets"))
def _(spark, sf_dir):
    flagged = rel.positive_flag(fx.all_streets(spark, sf_dir), "bike_lane", "on_lane")
    return rel.positive_flag(flagged, "st_width", "wide").select("physicalid", "on_lane", "wide")


STREET_TYPES_SQL = """
    coalesce(post_type IN ('AVE', 'BLVD'), false) OR coalesce(pre_type = 'AVE', false)
      OR coalesce(st_name IN ('BROADWAY', 'BOWERY'), false) AS is_av,
    coalesce(post_type = 'ST', false) AS is_st, coalesce(post_type IN ('RD', 'ROAD'), false) AS is_rd"""


@query("street_type_flags", fx.with_layers("all_streets", f"SELECT physicalid, {STREET_TYPES_SQL} FROM all_streets"))
def _(spark, sf_dir):
    return rel.street_type_flags(fx.all_streets(spark, sf_dir)).select("physicalid", "is_av", "is_st", "is_rd")


@query("date_window_filter", fx.with_layers(
    "streets speedhumps", "SELECT * FROM rows WHERE until > TIMESTAMP '1996-01-01' AND after < TIMESTAMP '2001-03-01'",
    rows=_INTERVALS_BY_KEY))
def _(spark, sf_dir):
    return rel.date_window_filter(
        intervals_by_key(spark, sf_dir), until_after=datetime(1996, 1, 1), after_before=datetime(2001, 3, 1)
    )


@query("margin_window_filter", fx.with_layers("speedhumps", f"""
    SELECT hump_id, date_insta FROM speedhumps
    WHERE date_insta > (SELECT min(o_orderdate) FROM orders) + INTERVAL 365 DAY
      AND date_insta < {H1} - INTERVAL 365 DAY"""))
def _(spark, sf_dir):
    first = ag.scalar_min(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")
    humps = fx.speedhumps(spark, sf_dir).select("hump_id", "date_insta")
    return rel.margin_window_filter(humps, "date_insta", first_event=first, as_of=fx.AS_OF)


@query("drop_null_rows", fx.with_layers(
    "all_streets", "SELECT physicalid, st_width, post_type FROM all_streets "
    "WHERE st_width IS NOT NULL AND post_type IS NOT NULL"))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "post_type", "bike_lane")
    return rows.dropna(subset=["st_width", "post_type"]).drop("bike_lane")


@query("positive_width_filter", fx.with_layers(
    "all_streets", "SELECT physicalid, st_width FROM all_streets WHERE st_width > 0"))
def _(spark, sf_dir):
    return rel.positive_width_filter(fx.all_streets(spark, sf_dir)).select("physicalid", "st_width")


@query("fill_constant", fx.with_layers(
    "all_streets", "SELECT physicalid, coalesce(st_width, 25) AS st_width, coalesce(bike_lane, '0') AS bike_lane "
    "FROM all_streets"))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "bike_lane")
    return rows.fillna({"st_width": 25.0, "bike_lane": "0"})


UNLOCATED = "SELECT * FROM raw_crashes WHERE latitude IS NULL AND persons_injured + persons_killed > 0"
BLANK = "coalesce(regexp_full_match(off_street_name, '\\s+'), false)"


@query("unlocated_injury_filter", fx.with_layers("raw_crashes", "SELECT collision_id FROM rows", rows=UNLOCATED))
def _(spark, sf_dir):
    return rel.unlocated_injury_filter(fx.raw_crashes(spark, sf_dir)).select("collision_id")


@query("off_street_rows", fx.with_layers(
    "raw_crashes", f"SELECT collision_id, off_street_name FROM rows WHERE off_street_name IS NOT NULL AND NOT {BLANK}",
    rows=UNLOCATED))
def _(spark, sf_dir):
    chosen = rel.off_street_rows(rel.unlocated_injury_filter(fx.raw_crashes(spark, sf_dir)))
    return chosen.select("collision_id", "off_street_name")


@query("cross_street_rows", fx.with_layers(
    "raw_crashes", f"SELECT collision_id, cross_street_name, on_street_name FROM rows "
    f"WHERE NOT (off_street_name IS NOT NULL AND NOT {BLANK}) "
    "AND cross_street_name IS NOT NULL AND on_street_name IS NOT NULL", rows=UNLOCATED))
def _(spark, sf_dir):
    chosen = rel.cross_street_rows(rel.unlocated_injury_filter(fx.raw_crashes(spark, sf_dir)))
    return chosen.select("collision_id", "cross_street_name", "on_street_name")


# --- aggregates

@query("group_agg_named", """
    SELECT l_suppkey, l_returnflag, sum(l_quantity) AS l_quantity, min(l_shipdate) AS first_ship,
           max(l_linenumber) AS l_linenumber, round(avg(l_discount), 6) AS l_discount, count(l_partkey) AS l_partkey
    FROM lineitem GROUP BY 1, 2""")
def _(spark, sf_dir):
    grouped = ag.group_agg_named(
        spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_suppkey", "l_returnflag"],
        {"l_quantity": "sum", "l_shipdate": "min", "l_linenumber": "max", "l_discount": "mean", "l_partkey": "count"},
        rename={"l_shipdate": "first_ship"},
    )
    return grouped.withColumn("l_discount", F.round("l_discount", 6))


@query("two_level_average", fx.with_layers("traffic_volumes", """
    SELECT site_id, round(avg(vol), 6) AS vol
    FROM (SELECT site_id, yr, m, d, sum(vol) AS vol FROM traffic_volumes GROUP BY ALL) GROUP BY 1"""))
def _(spark, sf_dir):
    means = ag.two_level_average(fx.traffic_volumes(spark, sf_dir), ["site_id"], ["yr", "m", "d"], "vol")
    return means.select("site_id", F.round("vol", 6).alias("vol"))


@query("count_if_groups", """
    SELECT o_custkey, CAST(month(o_orderdate) AS INTEGER) AS month,
           count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1, 2""")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("month", F.month("o_orderdate"))
    return ag.count_if_groups(
        orders, ["o_custkey", "month"], F.col("o_orderpriority") == "1-URGENT", "urgent"
    )


@query("dedupe_by_geometry_sum", """
    SELECT CAST(s_nationkey % 5 AS DOUBLE) AS x, sum(humps) AS humps, min(first) AS first FROM (
        SELECT s_nationkey, CAST(s_suppkey AS DOUBLE) AS humps, s_name AS first FROM supplier) GROUP BY 1""")
def _(spark, sf_dir):
    x = (F.col("s_nationkey") % 5).cast("double")
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        geo.straight_line(x, F.lit(0.0), x + 1, F.lit(1.0)).alias("geometry"),
        F.col("s_suppkey").cast("double").alias("humps"), F.col("s_name").alias("first"),
    )
    merged = ag.dedupe_by_geometry(rows, {"humps": "sum", "first": "min"})
    return merged.select(F.col("geometry")[0][0]["x"].alias("x"), "humps", "first")


@query("mode_value", """
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_quantity, 1), (
        SELECT l_quantity FROM lineitem WHERE l_quantity <> 1 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_quantity
    FROM lineitem""")
def _(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_quantity", F.lit(1.0)).alias("l_quantity")
    )
    return lines.withColumn("l_quantity", F.coalesce("l_quantity", ag.mode_value(lines, "l_quantity")))


@query("scalar_min", """
    SELECT o_orderkey, date_diff('day', (SELECT min(o_orderdate) FROM orders), o_orderdate) AS days FROM orders""")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        "o_orderkey", F.timestamp_diff("DAY", ag.scalar_min(orders, "o_orderdate"), F.col("o_orderdate")).alias("days")
    )


@query("distinct_month_count", """
    SELECT count(*) AS months FROM (SELECT DISTINCT month(l_shipdate), year(l_shipdate) FROM lineitem)""")
def _(spark, sf_dir):
    return ag.distinct_month_count(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_shipdate")


@query("distinct_month_count_missing", """
    SELECT count(*) AS months FROM (SELECT DISTINCT month(d), year(d) FROM (
        SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS d FROM orders))""")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    dated = orders.select(F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate")).alias("d"))
    return ag.distinct_month_count(dated, "d", count_missing=True)


@query("value_counts", fx.with_layers("all_streets", """
    SELECT post_type, count(*) AS count FROM all_streets WHERE post_type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1"""))
def _(spark, sf_dir):
    return ag.value_counts(fx.all_streets(spark, sf_dir), "post_type")


@query("column_profile", fx.with_layers("all_streets", """
    SELECT 'physicalid' AS "column", 'bigint' AS "type", count(physicalid) AS non_null FROM all_streets
    UNION ALL SELECT 'st_width', 'double', count(st_width) FROM all_streets
    UNION ALL SELECT 'bike_lane', 'string', count(bike_lane) FROM all_streets
    UNION ALL SELECT 'post_type', 'string', count(post_type) FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).select("physicalid", "st_width", "bike_lane", "post_type")
    return ag.column_profile(rows)


def _describe_sql(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean,
        round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min,
        round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50,
        round(quantile_cont({column}, 0.75), 6) AS q75, CAST(max({column}) AS DOUBLE) AS max FROM {table}"""


@query("describe", _describe_sql("l_quantity", "lineitem") + " UNION ALL " + _describe_sql("l_extendedprice", "lineitem"))
def _(spark, sf_dir):
    table = ag.describe(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_quantity", "l_extendedprice"])
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("histogram", """
    SELECT l_returnflag, CAST(least(floor((l_quantity - low) / ((high - low) / 80)), 79) AS INTEGER) AS bin,
           count(*) AS count
    FROM lineitem, (SELECT min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem) GROUP BY 1, 2""")
def _(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_returnflag")
    return ag.histogram(lines, "l_quantity", 80, "l_returnflag")


@query("month_hour_distribution", """
    SELECT CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS crashes
    FROM events GROUP BY 1, 2""")
def _(spark, sf_dir):
    return ag.month_hour_distribution(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")


# --- scalar functions

@query("parse_date_time", fx.with_layers("raw_crashes", """
    SELECT collision_id, CAST(split_part(crash_date, 'T', 1) AS TIMESTAMP)
        + to_hours(CAST(split_part(crash_time, ':', 1) AS INTEGER))
        + to_minutes(CAST(split_part(crash_time, ':', 2) AS INTEGER)) AS moment,
        CAST(split_part(crash_date, 'T', 1) AS TIMESTAMP) AS day
    FROM raw_crashes"""))
def _(spark, sf_dir):
    return fx.raw_crashes(spark, sf_dir).select(
        "collision_id", tr.parse_date_time(F.col("crash_date"), F.col("crash_time")).alias("moment"),
        tr.parse_date_time(F.col("crash_date")).alias("day"),
    )


@query("parse_date", fx.with_layers("raw_crashes", """
    SELECT collision_id, TRY_CAST(crash_date AS TIMESTAMP) AS day, TRY_CAST(off_street_name AS TIMESTAMP) AS none
    FROM raw_crashes"""))
def _(spark, sf_dir):
    return fx.raw_crashes(spark, sf_dir).select(
        "collision_id", tr.parse_date(F.col("crash_date")).alias("day"),
        tr.parse_date(F.col("off_street_name")).alias("none"),
    )


@query("date_parts", """
    SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(year(ts) AS INTEGER) AS year FROM events""")
def _(spark, sf_dir):
    parts = tr.date_parts("ts")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", *[c.alias(n) for n, c in parts.items()])


_WEEKS = "CAST(date_diff('second', {a}, {b}) AS DOUBLE) / 604800"


@query("weeks_between", fx.with_layers(
    "speedhumps", f"SELECT hump_id, round({_WEEKS.format(a='date_insta', b=H1)}, 6) AS weeks FROM speedhumps"))
def _(spark, sf_dir):
    weeks = iv.weeks_between(F.col("date_insta"), ntz(fx.AS_OF))
    return fx.speedhumps(spark, sf_dir).select("hump_id", F.round(weeks, 6).alias("weeks"))


@query("weekly_rate", fx.with_layers(
    "streets speedhumps",
    f"SELECT physicalid, after, round(100 / nullif({_WEEKS.format(a='after', b='until')}, 0), 6) AS rate FROM rows",
    rows=_INTERVALS_BY_KEY))
def _(spark, sf_dir):
    rate = iv.weekly_rate(F.lit(100), F.col("after"), F.col("until"))
    return intervals_by_key(spark, sf_dir).select("physicalid", "after", F.round(rate, 6).alias("rate"))


@query("rate_per_length", fx.with_layers("all_streets", """
    SELECT physicalid, round(7 / nullif(shape_leng, 0), 6) AS rate, round(7 * 1000.0 / nullif(shape_leng, 0), 6) AS rate_1000
    FROM all_streets"""))
def _(spark, sf_dir):
    return fx.all_streets(spark, sf_dir).select(
        "physicalid", F.round(tr.rate_per_length(F.lit(7), F.col("shape_leng")), 6).alias("rate"),
        F.round(tr.rate_per_length(F.lit(7), F.col("shape_leng"), 1000.0), 6).alias("rate_1000"),
    )


@query("before_after_flag", fx.with_layers("streets speedhumps", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, date_insta < l_shipdate AS after_humps
    FROM lineitem JOIN speedhumps ON hump_id = l_partkey"""))
def _(spark, sf_dir):
    dates = hump_dates(spark, sf_dir).select(F.col("physicalid").alias("l_partkey"), "date_insta")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    return lines.join(dates, "l_partkey").withColumn(
        "after_humps", F.col("date_insta") < F.col("l_shipdate")
    ).drop("date_insta")


@query("pedestrians_involved", fx.with_layers("crashes", """
    SELECT collision_id, coalesce(number_of_pedestrians_injured, 0) + coalesce(number_of_pedestrians_killed, 0) AS involved
    FROM crashes"""))
def _(spark, sf_dir):
    involved = tr.pedestrians_involved(
        F.col("number_of_pedestrians_injured"), F.col("number_of_pedestrians_killed")
    )
    return fx.crashes(spark, sf_dir).select("collision_id", involved.alias("involved"))


@query("monthly_average", """
    SELECT o_custkey, round(count(*) / CAST((SELECT count(DISTINCT date_trunc('month', o_orderdate)) FROM orders) AS DOUBLE), 6)
        AS crashes FROM orders GROUP BY 1""")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    months = ag.distinct_month_count(orders, "o_orderdate").scalar()
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("o_custkey", F.round(F.try_divide(F.col("n").cast("double"), months), 6).alias("crashes"))


@query("log1p_columns", fx.with_layers("all_streets", """
    SELECT physicalid, round(ln(1 + st_width), 6) AS log_st_width, round(ln(1 + shape_leng), 6) AS log_shape_leng
    FROM all_streets"""))
def _(spark, sf_dir):
    logged = tr.log1p_columns(fx.all_streets(spark, sf_dir), ["st_width", "shape_leng"])
    return logged.select(
        "physicalid", *[F.round(c, 6).alias(c) for c in ("log_st_width", "log_shape_leng")]
    )


@query("inverse_columns", fx.with_layers(
    "all_streets", "SELECT physicalid, round(1 / (1 + st_width), 6) AS inv_st_width FROM all_streets"))
def _(spark, sf_dir):
    inverse = tr.inverse_columns(fx.all_streets(spark, sf_dir), ["st_width"])
    return inverse.select("physicalid", F.round("inv_st_width", 6).alias("inv_st_width"))


@query("per_tree_ratios", fx.with_layers("all_streets", """
    SELECT physicalid, round(ln(1 + shape_leng) / (1 + physicalid % 9), 6) AS leng_per_tree,
           round(ln(1 + st_width) / (1 + physicalid % 9), 6) AS width_per_tree FROM all_streets"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).withColumn("n_trees", F.col("physicalid") % 9)
    return tr.per_tree_ratios(rows).select(
        "physicalid", *[F.round(c, 6).alias(c) for c in ("leng_per_tree", "width_per_tree")]
    )


@query("hump_ratio_features", fx.with_layers("all_streets", """
    SELECT physicalid, round(vol / nullif(shape_leng, 0), 6) AS vol_per_leng,
           round(n / nullif(shape_leng, 0), 6) AS trees_per_leng, round(n / (1 + vol), 6) AS trees_per_vol
    FROM (SELECT physicalid, shape_leng, physicalid % 9 AS n, CAST(physicalid % 70 AS DOUBLE) AS vol FROM all_streets)"""))
def _(spark, sf_dir):
    rows = fx.all_streets(spark, sf_dir).withColumns(
        {"tree_count": F.col("physicalid") % 9, "vol": (F.col("physicalid") % 70).cast("double"),
         "road_leng": F.col("shape_leng")}
    )
    return tr.hump_ratio_features(rows).select(
        "physicalid", *[F.round(c, 6).alias(c) for c in ("vol_per_leng", "trees_per_leng", "trees_per_vol")]
    )


@query("is_blank_text", fx.with_layers(
    "raw_crashes", f"SELECT collision_id, {BLANK} AS blank FROM raw_crashes"))
def _(spark, sf_dir):
    blank = rel.is_true(rel.is_blank_text(F.col("off_street_name")))
    return fx.raw_crashes(spark, sf_dir).select("collision_id", blank.alias("blank"))


# --- sorting, limits, de-duplication

@query("limit_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def _(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(100)


@query("head_preview", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 10")
def _(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value").orderBy("event_id").limit(10)


@query("sort_desc", "SELECT o_custkey, count(*) AS crashes FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def _(spark, sf_dir):
    counts = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("crashes"))
    return counts.orderBy(F.col("crashes").desc(), "o_custkey")


@query("sort_by_abs", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey")
def _(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_acctbal")
    return rows.orderBy(F.abs("c_acctbal").desc(), "c_custkey")


@query("row_at_min", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1")
def _(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    least = F.min(F.struct("o_totalprice", "o_orderkey")).alias("m")
    return orders.agg(least).select("m.o_orderkey", "m.o_totalprice")


@query("rows_around_min", """
    WITH grid AS (SELECT o_orderdate, avg(o_totalprice) AS mse FROM orders GROUP BY 1),
         best AS (SELECT o_orderdate AS least FROM grid ORDER BY mse, o_orderdate LIMIT 1),
         ranked AS (SELECT o_orderdate, mse, row_number() OVER (ORDER BY o_orderdate) AS n FROM grid)
    SELECT o_orderdate, round(mse, 6) AS mse FROM ranked,
           (SELECT n AS m FROM ranked JOIN best ON o_orderdate = least) WHERE n BETWEEN m - 10 AND m + 9""")
def _(spark, sf_dir):
    grid = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderdate").agg(F.avg("o_totalprice").alias("mse"))
    return rel.rows_around_min(grid, "o_orderdate", "mse", 10).withColumn("mse", F.round("mse", 6))


@query("drop_duplicates_first", """
    SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey
            ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS n FROM lineitem) WHERE n = 1""")
def _(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    return rel.drop_duplicates_first(
        lines, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    )


@query("distinct_rows", "SELECT DISTINCT p_type, p_brand FROM part")
def _(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_type", "p_brand").distinct()
