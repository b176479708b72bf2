"""Warehouse tables on Parquet: locations, reads, and the sinks that write them."""

import uuid
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schema
from tarmac.operators import dimensions

FACT_TABLE = T.StructType(
    [T.StructField("flight_id", T.LongType())]
    + [T.StructField(n, t) for n, t in schema.FACT_TYPES.items() if n not in ("year", "month")]
    + [
        T.StructField("carrier_id", T.LongType()),
        T.StructField("origin_airport_id", T.LongType()),
        T.StructField("dest_airport_id", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("year", T.ShortType()),
        T.StructField("month", T.ShortType()),
    ]
)

STAGED_TEXT = {
    "flight_date": "flight_date",
    "carrier_code": "carrier_code",
    "flight_number": "flight_number",
    "origin_airport": "origin_airport",
    "dest_airport": "dest_airport",
    "departure_delay": "departure_delay_min",
    "arrival_delay": "arrival_delay_min",
    "is_cancelled": "is_cancelled",
    "distance": "distance_miles",
}


#: One row per unit of a publication. A null folder retires the unit; `source` names what it was made from.
PUBLISHED = "seq long, table string, unit string, folder string, source string"


MAX_ROWS_PER_FILE = 5_000_000
#: Bytes of stored months whose merge may shuffle their rows at one time, some four times as many there.
MERGED_AT_ONCE = 1 << 30


def new_version():
    return f"v{uuid.uuid4().hex}"


def month_unit(year, month):
    return f"year={year}/month={month}"


class Warehouse:
    """Tables below one root folder, for one writer at a time.

    What replaces stored rows (a month, a dimension, a year of a summary) is written to a folder of its own
    beside the live one and published last: a publication is one small file of `_published`, which appears whole or
    not at all. Readers see the newest folder of every unit, so a write that fails midway leaves the old
    rows in sight, and units published together change together. Tables that only ever grow are plain Parquet.
    """

    def __init__(self, spark, root):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table):
        return f"{self.root}/{table}"

    def _plain(self, table, table_schema=None):
        reader = self.spark.read
        if table_schema is not None:
            reader = reader.schema(table_schema)
        try:
            return reader.parquet(self.path(table))
        except AnalysisException as error:
            if table_schema is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], table_schema)

    def units(self, table):
        """{unit: (folder, source)} by the newest publication of each unit: some per month of data at most."""
        log = self._plain("_published", PUBLISHED).filter(F.col("table") == table)
        newest = log.groupBy("unit").agg(F.max_by(F.struct("folder", "source"), "seq").alias("at"))
        return {r["unit"]: r["at"] for r in newest.collect()}

    def publish(self, rows):
        """Make folders live, all at once. `rows`: (table, unit, folder or None, source or None)."""
        if rows:
            seq = (self._plain("_published", PUBLISHED).agg(F.max("seq")).first()[0] or 0) + 1
            self.spark.createDataFrame([(seq, *row) for row in rows], PUBLISHED).coalesce(1).write.mode(
                "append").parquet(self.path("_published"))

    def read(self, table, table_schema=None, only=None):
        """The stored table, or an empty one with the given schema if nothing is stored yet; `only` some units of it."""
        units = self.units(table)
        if not units and only is None:
            return self._plain(table, table_schema).drop("txn")
        folders = [f"{self.path(table)}/{at['folder']}" for unit, at in sorted(units.items())
                   if at["folder"] is not None and (only is None or unit in only)]
        if not folders:
            if table_schema is None:
                return self._plain(table).drop("version").filter("false")
            return self.spark.createDataFrame([], table_schema)
        reader = self.spark.read.option("basePath", self.path(table))
        if table_schema is not None:
            reader = reader.schema(table_schema)
        return reader.parquet(*folders).drop("version")

    def facts(self, only=None):
        return self.read("fact_flights", FACT_TABLE, only)

    def carriers(self):
        return self.read("dim_carriers", schema.DIM_CARRIER)

    def airports(self):
        return self.read("dim_airports", schema.DIM_AIRPORT)

    def runs(self):
        return self.read("pipeline_runs", schema.RUN)

    def append(self, df, table):
        """Add rows; to a table with published folders as one more of them."""
        if not self.units(table):
            df.write.mode("append").parquet(self.path(table))
        elif not df.isEmpty():
            version = new_version()
            df.write.parquet(f"{self.path(table)}/version={version}")
            self.publish([(table, f"added-{version}", f"version={version}", None)])

    def record(self, df, table, txn):
        """Make the rows of one transaction in an audit table consist of `df`: writing again replaces them."""
        df.withColumn("txn", F.lit(txn)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("txn").parquet(self.path(table))

    def replace_table(self, df, table):
        """The whole table in one step."""
        version = new_version()
        df.write.parquet(f"{self.path(table)}/version={version}")
        old = [(table, unit, None, None) for unit in self.units(table) if unit != "all"]
        self.publish([*old, (table, "all", f"version={version}", None)])

    def written_months(self, facts, year, month):
        """Write one month beside the live one; gives the row to publish."""
        folder = f"version={new_version()}"
        replace_month(facts, f"{self.path('fact_flights')}/{folder}", year, month)
        unit = month_unit(year, month)
        return [("fact_flights", unit, f"{folder}/{unit}", None)]

    def replace_months(self, facts):
        """Replace every month that occurs in `facts`, all in one step; other months stay."""
        folder = f"version={new_version()}"
        path = f"{self.path('fact_flights')}/{folder}"
        typed = in_table_order(facts)
        write_months(typed.select([F.col(f.name).cast(f.dataType) for f in FACT_TABLE.fields]), path)
        months = self.spark.read.parquet(path).select("year", "month").distinct().collect()
        units = [month_unit(r["year"], r["month"]) for r in months]
        self.publish([("fact_flights", unit, f"{folder}/{unit}", None) for unit in units])

    def merge_months(self, fresh, flights=None):
        """Add `fresh` to the months it touches, in one step; it wins over stored flights of the same key.

        `fresh` holds each flight once, and is best stored, so that Spark knows its size: while its keys are small
        enough to broadcast, stored rows are not shuffled, only copied. Where it is not, `flights` may name the stored
        rows it is made of, for their months and keys. Files follow the tasks that read them,
        which pack small ones, so deliveries do not add up to ever more files. Stored months are merged some at a time,
        so that no more than these are shuffled at once.
        """
        flights = fresh if flights is None else flights
        # Calendar months: few, whatever the number of rows.
        months = sorted((r["year"], r["month"]) for r in flights.select("year", "month").distinct().collect())
        units = [month_unit(year, month) for year, month in months]
        folder = f"version={new_version()}"
        for some in self._at_once(months):
            inside = F.lit(True)
            if len(some) < len(months):
                inside = reduce(or_, [(F.col("year") == year) & (F.col("month") == month) for year, month in some])
            (
                merged(self.facts(only=[month_unit(*month) for month in some]), fresh.filter(inside),
                       flights.filter(inside))
                .transform(with_flight_id)
                .transform(in_table_order)
                .sortWithinPartitions("year", "month", "carrier_code", "origin_airport")
                .write.mode("append").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
                .partitionBy("year", "month")
                .parquet(f"{self.path('fact_flights')}/{folder}")
            )
        self.publish([("fact_flights", unit, f"{folder}/{unit}", None) for unit in units])
        return months

    def _at_once(self, months):
        """Months in groups of at most MERGED_AT_ONCE stored bytes, or of one month."""
        hadoop, conf = self.spark.sparkContext._jvm.org.apache.hadoop.fs, self.spark.sparkContext._jsc.hadoopConfiguration()
        stored, groups, held = self.units("fact_flights"), [[]], 0
        for month in months:
            at = stored.get(month_unit(*month))
            size = 0
            if at is not None and at["folder"] is not None:
                path = hadoop.Path(f"{self.path('fact_flights')}/{at['folder']}")
                size = path.getFileSystem(conf).getContentSummary(path).getLength()
            if groups[-1] and held + size > MERGED_AT_ONCE:
                groups.append([])
                held = 0
            groups[-1].append(month)
            held += size
        return groups

    def drop_superseded(self, table):
        """Delete the folders of a table that no unit names any more; run it when nobody reads older ones."""
        live = {at["folder"] for at in self.units(table).values() if at["folder"] is not None}
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
            self.path(table)).select(F.regexp_extract("path", r"/(version=[^/]+(?:/[a-z]+=[^/]+)*)/[^/]*$", 1).alias("folder"))
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for row in files.filter(F.length("folder") > 0).distinct().collect():
            if row["folder"] not in live:
                old = hadoop.Path(f"{self.path(table)}/{row['folder']}")
                old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def staged_rows(raw, source_file=None):
    """Landing rows: the checked columns as text, the whole raw row as JSON, and its origin."""
    source = F.lit(source_file) if source_file else F.col("source_file")
    names = {canonical: r for r, canonical in schema.RAW_TO_CANONICAL.items() if r in raw.columns}
    text = [
        (F.col(names[c]).cast("string") if c in names else F.lit(None).cast("string")).alias(staged)
        for staged, c in STAGED_TEXT.items()
    ]
    whole = F.struct(*[F.col(r) for r in schema.RAW_TO_CANONICAL if r in raw.columns])
    return raw.select(
        source.alias("source_file"),
        F.to_json(whole, {"ignoreNullFields": "false"}).alias("raw_data"),
        *text,
        F.current_timestamp().alias("loaded_at"),
        F.lit(False).alias("is_processed"),
        F.lit(None).cast("string").alias("error_message"),
    )


def to_facts(df):
    """The fact columns present, in order and in warehouse types. A value too large for its type
    is an error, as it is for any typed table."""
    return df.select([
        F.col(n).cast(t).alias(n) for n, t in schema.FACT_TYPES.items() if n in df.columns
    ])


def with_flight_id(facts):
    """A row id that no other write repeats, without a shuffle: the month of the row above the
    writing task and row number. Years 1970 to 2310 and 262,144 tasks fit; beyond them the write
    fails instead of repeating an id."""
    period = (F.col("year").cast("bigint") - 1970) * 12 + F.col("month")
    row = F.monotonically_increasing_id()
    fits = period.between(0, 4095) & (F.spark_partition_id() < 2 ** 18)
    return facts.withColumn("flight_id", F.when(fits, F.shiftleft(period, 51) + row).otherwise(
        F.raise_error(F.lit("flight_id: year or number of tasks out of range")).cast("bigint")))


def loadable_facts(df, carriers, airports):
    return (
        df.transform(to_facts)
        .transform(dimensions.with_dimension_keys, carriers, airports)
        .transform(with_flight_id)
        .withColumn("loaded_at", F.current_timestamp())
    )


def in_table_order(facts):
    return facts.select([
        F.col(f.name) if f.name in facts.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in FACT_TABLE.fields
    ])


def merged(stored, fresh, flights=None):
    """Stored rows whose flight is not in `fresh`, and all of `fresh`, in the table's types. Both hold each flight once;
    null key parts equal each other. The keys are those of `flights`, the rows `fresh` is made of, if given."""
    keys = (fresh if flights is None else flights).select([F.col(c).alias(f"_{c}") for c in schema.FLIGHT_KEY])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in schema.FLIGHT_KEY])
    typed = [F.col(f.name).cast(f.dataType) for f in FACT_TABLE.fields]
    return stored.join(keys, same, "left_anti").unionByName(in_table_order(fresh).select(typed))


def replace_month(facts, path, year, month, max_rows_per_file=MAX_ROWS_PER_FILE):
    """Make the stored month consist of `facts`, which must all belong to it. Writing again gives
    the same table. Rows stay where they are; sorting inside each file lets readers skip parts."""
    (
        in_table_order(facts).drop("year", "month")
        .sortWithinPartitions("carrier_code", "origin_airport")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows_per_file)
        .parquet(f"{path}/year={year}/month={month}")
    )


def write_months(df, path, max_rows_per_file=MAX_ROWS_PER_FILE):
    """Replace every month that occurs in `df`; other months stay. Rebalancing gives months files
    of even size: large months are split over tasks, small ones are not scattered."""
    (
        df.hint("rebalance", "year", "month")
        .sortWithinPartitions("year", "month", *[
            c for c in ("carrier_code", "origin_airport") if c in df.columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("year", "month")
        .parquet(path)
    )


def rows_of_month(facts, year, month):
    """How many rows a month holds; only its own partition is listed and counted."""
    return facts.filter((F.col("year") == year) & (F.col("month") == month)).agg(
        F.count("*").alias("existing_rows")
    )
