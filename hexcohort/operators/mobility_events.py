"""Summary columns from raw events: time-of-day shares, weekend share, entropy, home and work cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexcohort.functions.hexgrid import haversine_km, hex_cell, hex_centre
from hexcohort.operators.density import group_entropy


def day_part(ts: Column) -> Column:
    """morning 6-12, afternoon 12-18, evening 18-22, night 22-6."""
    h = F.hour(ts)
    return (F.when((h >= 6) & (h < 12), "morning").when((h >= 12) & (h < 18), "afternoon")
            .when((h >= 18) & (h < 22), "evening").otherwise("night"))


def time_bucket_ratios(events: DataFrame, user: str = "user_id", ts: str = "ts", value: str = "value") -> DataFrame:
    """Share of each user's volume per part of the day; one folded aggregation per user."""
    part = day_part(F.col(ts))
    names = ("morning", "afternoon", "evening", "night")
    agg = events.groupBy(user).agg(
        F.sum(value).alias("all_"), *[F.sum(F.when(part == p, F.col(value)).otherwise(F.lit(0.0))).alias(p) for p in names])
    return agg.select(user, *[F.try_divide(F.col(p), F.col("all_")).alias(f"{p}_data_ratio") for p in names])


def weekend_ratio(events: DataFrame, user: str = "user_id", ts: str = "ts", value: str = "value") -> DataFrame:
    weekend = F.dayofweek(ts).isin(1, 7)
    agg = events.groupBy(user).agg(F.sum(value).alias("all_"),
                                   F.sum(F.when(weekend, F.col(value)).otherwise(F.lit(0.0))).alias("w"))
    return agg.select(user, F.try_divide(F.col("w"), F.col("all_")).alias("weekend_data_ratio"))


def visit_entropy(events: DataFrame, user: str = "user_id", place: str = "event_type") -> DataFrame:
    """Entropy (natural log) of the places a user visits."""
    return group_entropy(events, user, place, "mobility_entropy")


def _daily_km(pings: DataFrame, user: str) -> DataFrame:
    """Kilometres per user and day along the order of the pings.

    Steps are summed per minute first and the minutes then chained by their end
    points (at most 1,440 a day), so a very busy user is spread over many tasks.
    """
    m = pings.select(user, F.date_trunc("minute", "t").alias("minute"), "t", "la", "lo")
    inside = Window.partitionBy(user, "minute").orderBy("t", "la", "lo")
    step = haversine_km(F.lag("la").over(inside), F.lag("lo").over(inside), F.col("la"), F.col("lo"))
    point = F.struct("t", "la", "lo")
    minutes = (m.withColumn("km", F.coalesce(step, F.lit(0.0))).groupBy(user, "minute")
               .agg(F.sum("km").alias("km"), F.min(point).alias("first"), F.max(point).alias("last")))
    chain = Window.partitionBy(user, F.to_date("minute")).orderBy("minute")
    before = F.lag("last").over(chain)
    hop = haversine_km(before["la"], before["lo"], F.col("first.la"), F.col("first.lo"))
    return (minutes.select(user, F.to_date("minute").alias("day"), (F.col("km") + F.coalesce(hop, F.lit(0.0))).alias("km"))
            .groupBy(user, "day").agg(F.sum("km").alias("km")))


def home_work(pings: DataFrame, user: str = "user_id", ts: str = "ts", lat: str = "lat", lon: str = "lon",
              res: int = 8) -> DataFrame:
    """Home and work cell, time shares, radius and daily distance from positioned events.

    Home is the modal cell at night, work the modal cell between 9 and 17 on
    weekdays away from home.  Pings are folded to (user, cell) counts first.
    """
    h = F.hour(ts)
    night = (h >= 22) | (h < 6)
    office = (h >= 9) & (h < 17) & ~F.dayofweek(ts).isin(1, 7)
    p = pings.select(user, F.col(ts).alias("t"), F.col(lat).alias("la"), F.col(lon).alias("lo"),
                     hex_cell(F.col(lat), F.col(lon), res).alias("cell"),
                     night.cast("int").alias("at_night"), office.cast("int").alias("at_office"))
    cells = p.filter(F.col("cell").isNotNull()).groupBy(user, "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("at_night").alias("n_night"), F.sum("at_office").alias("n_office"))
    home = cells.groupBy(user).agg(
        F.min(F.struct(-F.col("n_night"), -F.col("n"), "cell"))["cell"].alias("home_h3"), F.sum("n").alias("n_all"))
    away = cells.join(home, user).withColumn("home_n", F.when(F.col("cell") == F.col("home_h3"), F.col("n")))
    work = away.groupBy(user).agg(
        F.first("home_h3").alias("home_h3"), F.first("n_all").alias("n_all"), F.max("home_n").alias("home_n"),
        F.min(F.when((F.col("cell") != F.col("home_h3")) & (F.col("n_office") > 0),
                     F.struct((-F.col("n_office")).alias("o"), F.col("cell").alias("c"), F.col("n").alias("n"))))
        .alias("w"),
        F.count(F.lit(1)).alias("n_frequent_locations"))
    base = work.select(user, "home_h3", F.col("w.c").alias("work_h3"),
                       (F.col("home_n") / F.col("n_all")).alias("pct_time_at_home"),
                       F.coalesce(F.col("w.n") / F.col("n_all"), F.lit(0.0)).alias("pct_time_at_work"),
                       "n_frequent_locations")
    h_lat, h_lon = hex_centre(F.col("home_h3"))
    far = (cells.join(base.select(user, "home_h3"), user)
           .select(user, haversine_km(h_lat, h_lon, *hex_centre(F.col("cell"))).alias("d"))
           .groupBy(user).agg(F.max("d").alias("travel_radius_km")))
    daily = (_daily_km(p, user).groupBy(user).agg(F.avg("km").alias("avg_daily_distance_km")))
    w_lat, w_lon = hex_centre(F.col("work_h3"))
    return (base.join(far, user).join(daily, user)
            .withColumn("home_work_distance_km", haversine_km(h_lat, h_lon, w_lat, w_lon)))
