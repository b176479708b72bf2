"""The seven analyst reports. Year and size thresholds are parameters.

Sorts name their null order, and end in the group key where ties are possible.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.functions import measures as m
from tarmac.plans.summaries import daily_counts, with_route_places


def _of_year(flights, year):
    return flights.filter(F.col("year") == year)


def carrier_ranking(flights, dim_carriers, year=2023):
    """Carriers by share of delayed flights."""
    flown = ~F.col("is_cancelled")
    ranked = _of_year(flights, year).groupBy("carrier_code").agg(
        F.count("*").alias("total_flights"),
        m.count_where(F.col("is_cancelled")).alias("cancelled_flights"),
        m.mean(m.total_where(F.col("arrival_delay_min"), flown),
               m.present_where(F.col("arrival_delay_min"), flown)).alias("avg_arrival_delay_min"),
        m.percent(m.count_where(F.col("is_delayed") & flown), m.count_where(flown))
        .alias("pct_delayed"),
        m.percent(m.count_where(F.col("is_cancelled")), F.count("*")).alias("pct_cancelled"),
        *[
            m.mean(m.total_where(F.col(c), F.col(c) > 0), m.present_where(F.col(c), F.col(c) > 0))
            .alias(name)
            for c, name in (("weather_delay_min", "avg_weather_delay"),
                            ("carrier_delay_min", "avg_carrier_delay"))
        ],
    )
    names = dim_carriers.select("carrier_code", "carrier_name")
    return (
        ranked.join(names, "carrier_code", "left")
        .select("carrier_code", "carrier_name", *ranked.columns[1:])
        .orderBy(F.asc_nulls_last("pct_delayed"), "carrier_code")
    )


def monthly_trend(flights, dim_date):
    """Seasonality, with cancellations for weather (B) and by the carrier (A)."""
    days = dim_date.select("date_id", "month_name")
    return (
        daily_counts(flights, "year", "month")
        .join(days, "date_id")
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("flights").alias("total_flights"),
            m.mean(F.sum("arr_sum"), F.sum("arr_n")).alias("avg_delay_min"),
            m.percent(F.sum("late"), F.sum("flown")).alias("pct_delayed"),
            F.sum("weather_cancelled").alias("weather_cancellations"),
            F.sum("carrier_cancelled").alias("carrier_cancellations"),
        )
        .orderBy("year", "month", "month_name")
    )


def worst_routes(flights, dim_airports, year=2023, min_flights=100, top=20):
    """Routes by mean arrival delay."""
    keys = ["route", "origin_airport", "dest_airport"]
    delay = F.col("arrival_delay_min")
    flown = _of_year(flights, year).filter(~F.col("is_cancelled"))
    worst = (
        flown.groupBy(*keys)
        .agg(
            F.count("*").alias("total_flights"),
            m.mean(F.sum(delay), F.count(delay)).alias("avg_delay_min"),
            m.rounded(m.percentiles(delay, [0.9])[0], 2).alias("p90_delay_min"),
            m.percent(m.count_where(F.col("is_delayed")), F.count("*")).alias("pct_delayed"),
        )
        .filter(F.col("total_flights") >= min_flights)
        .orderBy(F.desc_nulls_first("avg_delay_min"), "route")
        .limit(top)
    )
    return (
        with_route_places(worst, dim_airports, "city")
        .select(*keys, "origin_city", "dest_city", *worst.columns[3:])
        .orderBy(F.desc_nulls_first("avg_delay_min"), "route")
    )


def day_of_week(flights, dim_date, year=2023):
    days = dim_date.select("date_id", "day_of_week", "day_name")
    return (
        daily_counts(_of_year(flights, year))
        .join(days, "date_id")
        .groupBy("day_of_week", "day_name")
        .agg(
            F.sum("flights").alias("total_flights"),
            m.mean(F.sum("dep_sum"), F.sum("dep_n")).alias("avg_dep_delay_min"),
            m.mean(F.sum("arr_sum"), F.sum("arr_n")).alias("avg_arr_delay_min"),
            m.percent(F.sum("late"), F.sum("flown")).alias("pct_delayed"),
        )
        .orderBy("day_of_week")
    )


def delay_causes(flights, year=2023):
    """Mean size of each cause where it occurred, and the carrier's share. The share leaves
    security out of the whole, as the report always has."""
    def mean_if_any(column):
        some = F.col(column) != 0
        return m.mean(m.total_where(F.col(column), some), m.present_where(F.col(column), some))

    causes = ["carrier", "weather", "nas", "security", "late_aircraft"]
    sums = {c: F.coalesce(F.sum(f"{c}_delay_min"), F.lit(0)) for c in causes}
    whole = sums["carrier"] + sums["weather"] + sums["nas"] + sums["late_aircraft"]
    return (
        _of_year(flights, year)
        .filter(F.col("arrival_delay_min") >= 15)
        .groupBy("carrier_code")
        .agg(
            *[mean_if_any(f"{c}_delay_min").alias(f"avg_{c}_delay") for c in causes],
            m.percent(sums["carrier"], whole, 1).alias("pct_carrier_caused"),
        )
        .orderBy(F.desc_nulls_first("avg_carrier_delay"), "carrier_code")
    )


def running_delay(flights):
    """Per carrier: the running mean of its monthly means, and its rank within each month. Both use
    the unrounded means; the windows see one row per carrier and month."""
    monthly = (
        flights.filter(~F.col("is_cancelled"))
        .groupBy("year", "month", "carrier_code")
        .agg(
            F.count("*").alias("monthly_flights"),
            m.raw_mean(F.sum("arrival_delay_min"), F.count("arrival_delay_min")).alias("delay"),
        )
    )
    so_far = (
        Window.partitionBy("carrier_code").orderBy("year", "month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    in_month = Window.partitionBy("year", "month").orderBy(F.asc_nulls_last("delay"))
    return (
        monthly.select(
            "year", "month", "carrier_code", "monthly_flights",
            m.rounded(F.col("delay"), 2).alias("avg_delay"),
            m.rounded(F.avg("delay").over(so_far), 2).alias("cumulative_avg_delay"),
            F.rank().over(in_month).cast("bigint").alias("monthly_rank"),
        )
        .orderBy("year", "month", "monthly_rank", "carrier_code")
    )


def hubs(flights, dim_airports, year=2023, min_departures=10_000, top=25):
    """Busiest origin airports. One row per airport and carrier is left to count carriers in."""
    flown = ~F.col("is_cancelled")
    busiest = (
        _of_year(flights, year)
        .groupBy("origin_airport", "carrier_code")
        .agg(
            F.count("*").alias("flights"),
            m.count_where(F.col("is_cancelled")).alias("cancelled"),
            m.total_where(F.col("departure_delay_min"), flown).alias("dep_sum"),
            m.present_where(F.col("departure_delay_min"), flown).alias("dep_n"),
        )
        .groupBy(F.col("origin_airport").alias("airport"))
        .agg(
            F.sum("flights").alias("total_departures"),
            m.mean(F.sum("dep_sum"), F.sum("dep_n")).alias("avg_dep_delay"),
            m.percent(F.sum("cancelled"), F.sum("flights")).alias("cancellation_rate_pct"),
            F.count("carrier_code").alias("carrier_count"),
        )
        .filter(F.col("total_departures") >= min_departures)
        .orderBy(F.desc("total_departures"), "airport")
        .limit(top)
    )
    places = dim_airports.select(
        F.col("iata_code").alias("airport"), "airport_name", "city", "state_code"
    )
    return (
        busiest.join(places, "airport", "left")
        .select("airport", "airport_name", "city", "state_code", *busiest.columns[1:])
        .orderBy(F.desc("total_departures"), "airport")
    )
