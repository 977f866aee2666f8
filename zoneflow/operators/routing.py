"""Overflow recommendations between zones.

A destination's score is its free bays less a share of its load less a cost
per km. The best five of every zone are found without pairing all zones:
zones are hashed into nested cubes of doubling size around the earth's
centre, and equal cube numbers are the only join condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.functions.scalar import EARTH_RADIUS_KM, haversine_km
from zoneflow.session import write_table

# Weights of the score, assumed speed, shortest drive, list length.
LOAD_WEIGHT = 0.2
KM_WEIGHT = 2.5
SPEED_KMH = 22
MIN_DRIVE_MIN = 2
TOP_K = 5

_CUBE_KM = 0.5
_LEVELS = 16  # the largest cube holds the whole earth
_SLACK = 0.02  # scores are compared after rounding to two places
_SIDE = 1 << 15
# Cube sizes of the descent, each an eighth of the one before.
_DESCENT = (12, 9, 6, 3, 0)


def _cube_size(level: Column) -> Column:
    return F.lit(_CUBE_KM) * F.pow(F.lit(2.0), level)


def _cube_key(level: Column, x: Column, y: Column, z: Column) -> Column:
    return ((level.cast("bigint") * _SIDE + x) * _SIDE + y) * _SIDE + z


def _axis(name: str, level: Column) -> Column:
    return F.floor(F.col(name) / _cube_size(level)).cast("bigint")


def _own_cube(level: Column) -> Column:
    return _cube_key(level, _axis("_x", level), _axis("_y", level), _axis("_z", level))


def _places(state: DataFrame) -> DataFrame:
    lat, lon = F.radians("latitude"), F.radians("longitude")
    shift = EARTH_RADIUS_KM + 1
    return state.select(
        "zone_id", "zone_name", "latitude", "longitude", "capacity", "occupancy", "available", "utilization",
        (F.col("available") - F.col("utilization") * LOAD_WEIGHT).alias("_base"),
        (F.cos(lat) * F.cos(lon) * EARTH_RADIUS_KM + shift).alias("_x"),
        (F.cos(lat) * F.sin(lon) * EARTH_RADIUS_KM + shift).alias("_y"),
        (F.sin(lat) * EARTH_RADIUS_KM + shift).alias("_z"),
    )


def _pyramid(places: DataFrame) -> DataFrame:
    """Every place once per cube size."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1)))
    return places.withColumn("_level", levels).withColumn("_cube", _own_cube(F.col("_level")))


def _score(km: Column) -> Column:
    return F.col("_base") - km * KM_WEIGHT


def reroute_candidates(state: DataFrame, k: int = TOP_K) -> DataFrame:
    """The `k` best destinations of every zone, ranked by rounded score, then zone id."""
    places = write_table(_places(state), "places")
    source = places.select(
        F.col("zone_id").alias("source_zone"), F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"),
        "_x", "_y", "_z",
    )
    pyramid = _pyramid(places.where("available > 0"))

    # 1. k+1 destinations of one cube that beat another by more than the cube's
    #    width costs beat it from everywhere, also when one of them is the source.
    in_cube = Window.partitionBy("_cube").orderBy(F.desc("_base"), "zone_id")
    best = pyramid.withColumn("_rn", F.row_number().over(in_cube)).where(F.col("_rn") <= k + 1)
    width = _cube_size(F.col("_level")) * (3 ** 0.5) * (3.1416 / 2)
    floor = best.where(F.col("_rn") == k + 1).select(
        "_cube", (F.col("_base") - width * KM_WEIGHT - _SLACK).alias("_floor")
    )
    kept = (
        pyramid.select("zone_id", "_base", "_cube").join(floor, "_cube", "left")
        .groupBy("zone_id").agg(F.max("_floor").alias("_floor"), F.first("_base").alias("_b"))
        .where(F.col("_floor").isNull() | (F.col("_b") >= F.col("_floor"))).select("zone_id")
    )
    useful = places.join(kept, "zone_id", "left_semi")

    # 2. The leaders of the cubes a source lies in bound its k-th score from below.
    km = haversine_km("_slat", "_slon", "latitude", "longitude")
    near = (
        _pyramid(source).select("source_zone", "_slat", "_slon", "_cube")
        .join(best.select("_cube", "zone_id", "latitude", "longitude", "_base"), "_cube")
        .where(F.col("source_zone") != F.col("zone_id"))
        .groupBy("source_zone", "zone_id").agg(F.first(_score(km)).alias("_s"))
    )
    by_source = Window.partitionBy("source_zone")
    bound = (
        near.withColumn("_rn", F.row_number().over(by_source.orderBy(F.desc("_s"))))
        .where(F.col("_rn") == k).select("source_zone", (F.col("_s") - _SLACK).alias("_bound"))
    )

    # 3. Descend from the cube that holds all places: a smaller cube is looked into where its best base, less the
    #    way to the nearest side of the box around its own places, still reaches the bound. One outstanding zone opens
    #    the way to itself only.
    frontier = source.join(bound, "source_zone", "left").withColumn("_cube", _own_cube(F.lit(_LEVELS - 1)))
    members = useful.withColumn("_parent", _own_cube(F.lit(_LEVELS - 1)))
    for level in _DESCENT:
        members = members.withColumn("_cube", _own_cube(F.lit(level)))
        boxes = members.groupBy("_parent", "_cube").agg(
            F.max("_base").alias("_top"), *[f(a).alias(f"{n}{a}") for a in ("_x", "_y", "_z") for n, f in (("low", F.min), ("high", F.max))])
        boxes = boxes.withColumnRenamed("_cube", "_child")
        apart = [F.greatest(F.lit(0.0), F.col(f"low{a}") - F.col(a), F.col(a) - F.col(f"high{a}")) for a in ("_x", "_y", "_z")]
        reach = F.col("_top") - F.sqrt(sum((d * d for d in apart[1:]), apart[0] * apart[0])) * KM_WEIGHT
        frontier = (
            frontier.join(boxes, frontier["_cube"] == boxes["_parent"])
            .where(F.col("_bound").isNull() | (reach >= F.col("_bound")))
            .select("source_zone", "_slat", "_slon", "_x", "_y", "_z", "_bound", F.col("_child").alias("_cube"))
        )
        members = members.withColumn("_parent", F.col("_cube"))
    targets = members.drop("_x", "_y", "_z", "_parent")
    pairs = frontier.drop("_x", "_y", "_z").join(targets, "_cube").where(F.col("source_zone") != F.col("zone_id"))
    scored = pairs.withColumn("_km", km).where(F.col("_bound").isNull() | (_score(F.col("_km")) >= F.col("_bound")))
    ranked = scored.withColumn("recommendation_score", F.round(_score(F.col("_km")), 2)).withColumn(
        "rank", F.row_number().over(by_source.orderBy(F.desc("recommendation_score"), "zone_id"))
    )
    return ranked.where(F.col("rank") <= k).select(
        "source_zone", "rank", F.col("zone_id").alias("target_zone"),
        F.round("_km", 1).alias("distance_km"),
        F.greatest(F.lit(MIN_DRIVE_MIN), F.bround(F.col("_km") / SPEED_KMH * 60, 0).cast("int")).alias("drive_minutes"),
        "recommendation_score",
    )


def decide_reroute(requests: DataFrame, state: DataFrame, candidates: DataFrame) -> DataFrame:
    """Outcome of each request (`request_id`, `source_zone`, optional `target_zone`).

    A request joins one row per source, so a popular source does not multiply.
    """
    options = candidates.groupBy("source_zone").agg(
        F.sort_array(F.collect_list(F.struct("rank", "target_zone", "distance_km", "drive_minutes"))).alias("_options")
    )
    known = state.select(F.col("zone_id").alias("source_zone")).join(options, "source_zone", "left").withColumn(
        "_known", F.lit(True)
    )
    wanted = F.upper(F.coalesce("target_zone", F.lit("")))
    none = F.array().cast("array<struct<rank:int,target_zone:string,distance_km:double,drive_minutes:int>>")
    options_or_none = F.coalesce("_options", none)
    joined = (
        requests.withColumn("source_zone", F.upper(F.coalesce("source_zone", F.lit(""))))
        .join(known, "source_zone", "left").withColumn("_want", wanted)
    )
    pick = F.when(F.col("_want") == "", F.try_element_at(options_or_none, F.lit(1))).otherwise(
        F.try_element_at(F.filter(options_or_none, lambda o: o["target_zone"] == F.col("_want")), F.lit(1))
    )
    status = (
        F.when(F.col("_known").isNull(), "UNKNOWN_SOURCE")
        .when(F.col("_pick").isNotNull(), "RECORDED")
        .when(F.col("_want") != "", "UNAVAILABLE_TARGET")
        .otherwise("NO_DESTINATION")
    )
    return joined.withColumn("_pick", pick).select(
        "request_id", "source_zone", status.alias("status"), F.col("_pick.target_zone").alias("target_zone"),
        F.col("_pick.distance_km").alias("distance_km"), F.col("_pick.drive_minutes").alias("drive_minutes"),
    )


def best_overflow(state: DataFrame, k: int = 3) -> DataFrame:
    """For every zone the `k` other zones with most free bays: the network's k+1 leaders less itself."""
    leaders = state.orderBy(F.desc("available"), "zone_id").limit(k + 1).agg(
        F.sort_array(F.collect_list(F.struct(
            (-F.col("available")).alias("_neg"), F.col("zone_id").alias("zone"), F.col("available").alias("free")
        ))).alias("l")
    ).scalar()
    others = F.slice(F.filter("_leaders", lambda o: o["zone"] != F.col("zone_id")), 1, k)
    return state.select("zone_id", leaders.alias("_leaders")).select("zone_id", F.posexplode(others).alias("_pos", "_o")).select(
        F.col("zone_id").alias("source_zone"), (F.col("_pos") + 1).alias("rank"),
        F.col("_o.zone").alias("target_zone"), F.col("_o.free").alias("available"),
    )


def best_hub(state: DataFrame) -> DataFrame:
    """Least loaded zone with free bays."""
    return state.where("available > 0").orderBy("utilization", F.desc("available"), "zone_id").limit(1)


def diversion_plan(state: DataFrame, k: int = 3) -> DataFrame:
    """Zones to send overflow to: most free bays among those not at high risk."""
    return state.where("available > 0 AND risk <> 'HIGH'").orderBy(F.desc("available"), "zone_id").limit(k)
