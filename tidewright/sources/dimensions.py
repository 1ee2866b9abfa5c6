"""Small keyed tables kept as JSON documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

STATION = "array<struct<name:string,lat:double,lng:double,prefecture:string,sea_area:string>>"
SCHEMAS = {
    "boats": "boats array<struct<boat_id:string,boat_name:string,area_id:string,"
             "source_values:array<string>,active:boolean>>",
    "areas": "areas array<struct<area_id:string,name:string,prefecture:string,"
             "weather_stations:array<string>,current_points:array<string>,active:boolean>>",
    "weather_stations": f"weather_stations {STATION}",
    "current_points": f"current_points {STATION}",
    "rules": "rules array<struct<`from`:string,`to`:string,type:string,reason:string>>",
    "spots": "spots array<struct<canonical_spot:string,raw_spots:array<string>,spot_lat:double,"
             "spot_lng:double,nearest_station:string,distance_km:double,current_point:string,"
             "current_distance_km:double,sea_area:string,confidence:string>>",
}


def read_entries(spark: SparkSession, path: str, name: str, by_line: bool = False) -> DataFrame:
    """Rows of one list of a JSON document, or of all documents of a folder with one in each line."""
    document = spark.read.schema(SCHEMAS[name]).option("multiLine", not by_line).json(path)
    return document.select(F.inline(name))


def active_only(dimension: DataFrame, flag: str = "active") -> DataFrame:
    """Entries in use; one without the flag is in use."""
    return dimension.where(F.coalesce(F.col(flag), F.lit(True)))


def read_geocode_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cache document to rows: name, lat, lng, source, fetched_at, reason."""
    entry = "struct<lat:double,lng:double,source:string,fetched_at:string,reason:string>"
    document = spark.read.schema(f"entries map<string,{entry}>").option(
        "multiLine", True).json(path)
    return document.select(F.explode("entries").alias("name", "_entry")).select(
        "name", "_entry.*")


def cached_coordinates(spots: DataFrame, cache: DataFrame, name: str) -> DataFrame:
    """Spots with what the cache knows: success, lat, lng, origin, reason, status."""
    known = cache.select(F.col("name").alias("_name"), F.col("lat").alias("_lat"),
                         F.col("lng").alias("_lng"), F.col("source").alias("_source"),
                         F.col("reason").alias("_reason"))
    rows = spots.join(known, F.col(name) == F.col("_name"), "left")
    status = (F.when(F.coalesce(F.col(name), F.lit("")) == "", "empty")
              .when(F.col("_name").isNull(), "miss")
              .when(F.col("_lat").isNotNull() & F.col("_lng").isNotNull(), "hit")
              .otherwise("negative_hit"))
    rows = rows.withColumn("status", status)
    hit = F.col("status") == "hit"
    return rows.select(
        *spots.columns, hit.alias("success"),
        F.when(hit, F.col("_lat")).alias("lat"), F.when(hit, F.col("_lng")).alias("lng"),
        F.when(hit, F.coalesce("_source", F.lit("cache")))
        .when(F.col("status") == "negative_hit", "cache").otherwise("").alias("origin"),
        F.when(F.col("status") == "empty", "empty_spot_name")
        .when(F.col("status") == "miss", "cache_only_miss")
        .when(F.col("status") == "negative_hit", F.coalesce("_reason", F.lit("negative_cache")))
        .alias("reason"), "status")


def cache_statistics(looked_up: DataFrame) -> DataFrame:
    """How many look-ups hit, missed or were empty."""
    return looked_up.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def default_entry(dimension: DataFrame, key: str, order: str, preferred: str | None = None
                  ) -> DataFrame:
    """The preferred key if it is in use, else the first one; a single row."""
    return active_only(dimension).agg(F.coalesce(
        F.max(F.when(F.col(key) == preferred, F.col(key))), F.min_by(key, order)).alias(key))
