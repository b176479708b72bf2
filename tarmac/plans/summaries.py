"""Summary tables over the flights fact, and the run health view.

Each one reduces the fact by natural keys to partial sums first and joins dimensions to the reduced
rows: the fact is never joined, whatever the dimension's size. Dimension keys are unique.
"""

from pyspark.sql import functions as F

from tarmac.functions import measures as m


def flown():
    return ~F.col("is_cancelled")


def _delayed():
    return F.col("is_delayed") & flown()


def daily_counts(flights, *keys):
    """Partial sums per day and `keys`: everything the calendar-joined tables need."""
    in_air = flown()
    return flights.groupBy("date_id", *keys).agg(
        F.count("*").alias("flights"),
        m.count_where(F.col("is_cancelled")).alias("cancelled"),
        m.count_where(in_air).alias("flown"),
        m.count_where(F.col("is_delayed")).alias("late"),
        m.count_where(_delayed()).alias("late_flown"),
        m.count_where(~F.col("is_delayed") & in_air).alias("ontime"),
        m.total_where(F.col("arrival_delay_min"), in_air).alias("arr_sum"),
        m.present_where(F.col("arrival_delay_min"), in_air).alias("arr_n"),
        m.total_where(F.col("departure_delay_min"), in_air).alias("dep_sum"),
        m.present_where(F.col("departure_delay_min"), in_air).alias("dep_n"),
        F.sum("distance_miles").alias("dist_sum"),
        F.count("distance_miles").alias("dist_n"),
        m.count_where(F.col("cancellation_code") == "B").alias("weather_cancelled"),
        m.count_where(F.col("cancellation_code") == "A").alias("carrier_cancelled"),
    )


def monthly_summary(flights, dim_date):
    """Per carrier and month. Both rates have true names: the share of late flights, and the share
    of flights that were not."""
    return months_flown(daily_counts(flights, "year", "month", "carrier_code"), dim_date)


def months_flown(days_of_carriers, dim_date):
    """`monthly_summary` from counts per day and carrier."""
    days = dim_date.select("date_id", "month_name", "season")
    total = {c: F.sum(c) for c in (
        "flights", "cancelled", "flown", "late_flown", "ontime", "arr_sum", "arr_n", "dep_sum",
        "dep_n", "dist_sum", "dist_n")}
    return (
        days_of_carriers.join(days, "date_id")
        .groupBy("year", "month", "month_name", "season", "carrier_code")
        .agg(
            total["flights"].alias("total_flights"),
            total["cancelled"].alias("cancelled_count"),
            total["late_flown"].alias("delayed_count"),
            total["ontime"].alias("ontime_count"),
            m.mean(total["arr_sum"], total["arr_n"]).alias("avg_arrival_delay"),
            m.mean(total["dep_sum"], total["dep_n"]).alias("avg_departure_delay"),
            m.percent(total["late_flown"], total["flown"]).alias("delayed_rate_pct"),
            m.percent(total["ontime"], total["flown"]).alias("ontime_rate_pct"),
            m.mean(total["dist_sum"], total["dist_n"]).alias("avg_distance_miles"),
        )
    )


def carrier_performance(flights, dim_carriers):
    """Per carrier and year, with the number of routes and of origin airports served.

    Reducing to one row per carrier, year, route and origin leaves the two distinct counts a few
    thousand rows to look at.
    """
    in_air = flown()
    served = flights.groupBy("carrier_code", "year", "route", "origin_airport").agg(
        F.count("*").alias("flights"),
        m.count_where(F.col("is_cancelled")).alias("cancelled"),
        m.count_where(in_air).alias("flown"),
        m.count_where(~F.col("is_delayed") & in_air).alias("ontime"),
        m.total_where(F.col("arrival_delay_min"), in_air).alias("arr_sum"),
        m.present_where(F.col("arrival_delay_min"), in_air).alias("arr_n"),
    )
    return carriers_served(served, dim_carriers)


def carriers_served(served, dim_carriers):
    """`carrier_performance` from counts per carrier, year, route and origin (in any number of parts)."""
    per_carrier = served.groupBy("carrier_code", "year").agg(
        F.sum("flights").alias("total_flights"),
        m.percent(F.sum("ontime"), F.sum("flown")).alias("ontime_pct"),
        m.mean(F.sum("arr_sum"), F.sum("arr_n")).alias("avg_delay_min"),
        m.percent(F.sum("cancelled"), F.sum("flights")).alias("cancellation_pct"),
        F.count_distinct("route").alias("routes_served"),
        F.count_distinct("origin_airport").alias("airports_served"),
    )
    names = dim_carriers.select("carrier_code", "carrier_name")
    return per_carrier.join(names, "carrier_code", "left").select(
        "carrier_code", "carrier_name", "year", "total_flights", "ontime_pct", "avg_delay_min",
        "cancellation_pct", "routes_served", "airports_served",
    )


ROUTE_YEAR = ["route", "origin_airport", "dest_airport", "year"]


def with_route_places(routes, airports, *columns):
    """Attributes of both ends, as `origin_<column>` and `dest_<column>`."""
    names = {"city": "city", "state_code": "state"}
    for end in ("origin", "dest"):
        place = airports.select(
            F.col("iata_code").alias(f"{end}_airport"),
            *[F.col(c).alias(f"{end}_{names[c]}") for c in columns],
        )
        routes = routes.join(place, f"{end}_airport", "left")
    return routes


def route_analysis(flights, dim_airports, min_flights=50):
    """Per route and year, for routes with enough flights."""
    delay, in_air = F.col("arrival_delay_min"), flown()
    per_route = (
        flights.groupBy(*ROUTE_YEAR)
        .agg(
            F.count("*").alias("total_flights"),
            m.mean(m.total_where(delay, in_air), m.present_where(delay, in_air))
            .alias("avg_delay_min"),
            m.percentiles(delay, [0.5, 0.9]).alias("delays"),
            m.mean(F.sum("distance_miles"), F.count("distance_miles"), 0)
            .alias("avg_distance_miles"),
            m.distinct_few(F.col("carrier_code")).alias("carrier_count"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    return _route_columns(per_route, dim_airports)


def routes_flown(routes, delays, dim_airports, min_flights=50):
    """`route_analysis` from counts per route, year and carrier, and flights per route, year and distinct delay."""
    per_route = routes.groupBy(*ROUTE_YEAR).agg(
        F.sum("flights").alias("total_flights"),
        m.mean(F.sum("arr_sum"), F.sum("arr_n")).alias("avg_delay_min"),
        m.mean(F.sum("dist_sum"), F.sum("dist_n"), 0).alias("avg_distance_miles"),
        m.distinct_few(F.col("carrier_code")).alias("carrier_count"),
    ).filter(F.col("total_flights") >= min_flights)
    spread = delays.groupBy(*[F.col(c).alias(f"of_{c}") for c in ROUTE_YEAR]).agg(m.counted_percentiles(
        F.col("arrival_delay_min"), F.col("flights"), [0.5, 0.9]).alias("delays"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ROUTE_YEAR]
    return _route_columns(per_route.join(spread, same, "left"), dim_airports)


def sketched(sketches):
    """Per carrier and year, approximate percentiles of the delay and numbers of routes and origins, from sketches."""
    merged = sketches.groupBy("carrier_code", "year").agg(
        F.sum("flights").alias("total_flights"),
        F.kll_merge_agg_double("delays").alias("delays"),
        F.hll_sketch_estimate(F.hll_union_agg("routes")).alias("routes_served"),
        F.hll_sketch_estimate(F.hll_union_agg("origins")).alias("airports_served"),
    )

    def quantile(share):  # null without a delay
        return F.when(F.kll_sketch_get_n_double("delays") > 0, F.kll_sketch_get_quantile_double("delays", F.lit(share)))

    return merged.select("carrier_code", "year", "total_flights", quantile(0.5).alias("median_delay_min"),
                         quantile(0.9).alias("p90_delay_min"), "routes_served", "airports_served")


def _route_columns(per_route, dim_airports):
    per_route = per_route.withColumns({
        "median_delay_min": m.rounded(F.col("delays")[0], 2),
        "p90_delay_min": m.rounded(F.col("delays")[1], 2),
    })
    return with_route_places(per_route, dim_airports, "city", "state_code").select(
        "route", "origin_airport", "dest_airport", "origin_city", "origin_state", "dest_city",
        "dest_state", "year", "total_flights", "avg_delay_min", "median_delay_min",
        "p90_delay_min", "avg_distance_miles", "carrier_count",
    )


def run_health(runs):
    """Newest first. A successful run is healthy when under 1% of its rows were rejected; with no
    rows extracted the share is unknown, and the run a warning."""
    share = F.col("rows_rejected") / F.nullif(F.col("rows_extracted"), F.lit(0))
    return runs.select(
        "run_id", "year", "month", "status", "rows_extracted", "rows_loaded", "rows_rejected",
        m.percent(F.col("rows_rejected"), F.col("rows_extracted")).alias("rejection_rate_pct"),
        m.rounded(F.col("duration_sec"), 1).alias("duration_sec"),
        "started_at",
        F.when((F.col("status") == "success") & (share < 0.01), "healthy")
        .when(F.col("status") == "success", "warning")
        .otherwise("failed")
        .alias("health_status"),
    ).orderBy(F.desc_nulls_first("started_at"), F.desc("run_id"))
