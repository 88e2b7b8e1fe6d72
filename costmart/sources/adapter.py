"""Maps the generic benchmark tables onto the engine's inputs.

`events` serves as both the query log (one statement per event) and, summed per hour, the metering;
`orders` stands for storage snapshots, `nation` and `region` for departments. Tests, benchmark and the
SQL oracle share these rules; they are listed in FIXTURES.md.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.functions import exprs as X
from costmart.functions.types import cast_to, schema_of
from costmart.sources import schemas

# Observed size text by warehouse number; number 8 has none.
SIZES = ("X-Small", "Small", "Medium", "Large", "X-Large", "2X-Large", "3X-Large", "4X-Large")


def _warehouse_number() -> Column:
    return F.col("user_id") % 9


def _warehouse_name() -> Column:
    n = _warehouse_number()
    return F.when(n == 8, "CLOUD_SERVICES_ONLY").otherwise(F.concat(F.lit("WH_"), n.cast("string")))


# Columns of the benchmark tables in use; stating them saves reading file footers to infer them.
TABLES = {
    "events": schema_of(
        event_id="long", ts="timestamp_ntz", user_id="long", event_type="string", value="double", props="string"
    ),
    "orders": schema_of(o_orderkey="long", o_custkey="long", o_totalprice="double", o_orderpriority="string"),
    "nation": schema_of(n_nationkey="integer", n_regionkey="integer"),
    "region": schema_of(r_regionkey="integer", r_name="string"),
}


class Inputs:
    """Lazy frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def events(self, since: date | None = None) -> DataFrame:
        """Events, or those that can matter to inputs that start at `since`, a filter the scan can use.

        A statement starts at or before its event, except for a negative value; a meter hour holds
        events from its start on.
        """
        rows = self.table("events")
        if since is None:
            return rows
        start = F.lit(datetime.combine(since, datetime.min.time())).cast("timestamp_ntz")
        return rows.where((F.col("ts") >= start) | (F.col("value") < 0))

    def metering(self, since: date | None = None) -> DataFrame:
        hour = X.bucket(F.col("ts"))
        credits = F.round(F.sum(F.col("value").cast("decimal(18,2)")) * F.lit(Decimal("0.01")), 3).cast("decimal(18,3)")
        hours = (
            self.events(since)
            .groupBy(
                _warehouse_number().alias("warehouse_id"), _warehouse_name().alias("warehouse_name"), hour.alias("start_time")
            )
            .agg(credits.alias("credits_used"))
        )
        return cast_to(
            hours.select(
                "start_time",
                X.shift(F.col("start_time"), 1, "hour").alias("end_time"),
                "warehouse_id",
                "warehouse_name",
                "credits_used",
                F.round(F.col("credits_used") * F.lit(Decimal("0.95")), 3).alias("credits_used_compute"),
                F.round(F.col("credits_used") * F.lit(Decimal("0.05")), 3).alias("credits_used_cloud_services"),
            ),
            schemas.METERING,
        )

    def raw_metering(self) -> DataFrame:
        """Untyped meter rows: text timestamps, no id, no split, cost at list price."""
        return self.metering().select(
            F.col("start_time").cast("string").alias("start_time"),
            F.col("end_time").cast("string").alias("end_time"),
            "warehouse_name",
            F.col("credits_used").alias("total_credits_used"),
            F.round(F.col("credits_used") * F.lit(Decimal(3)), 2).cast("decimal(18,2)").alias("total_cost_usd"),
        )

    def queries(self, since: date | None = None) -> DataFrame:
        elapsed = (F.col("value").cast("decimal(18,2)") * F.lit(2000)).cast("bigint")
        k = F.get_json_object("props", "$.k").cast("bigint")
        size = F.get(F.array(*[F.lit(s) for s in SIZES]), _warehouse_number().cast("int"))
        log = self.events(since).select(
            F.col("event_id").cast("string").alias("query_id"),
            (F.col("ts") - F.make_dt_interval(secs=elapsed.cast("decimal(18,3)") / 1000)).alias("start_time"),
            F.col("ts").alias("end_time"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
            F.col("event_type").alias("role_name"),
            _warehouse_name().alias("warehouse_name"),
            size.alias("warehouse_size"),
            F.col("event_type").alias("query_type"),
            F.concat(F.lit("DB_"), (F.col("user_id") % 5).cast("string")).alias("database_name"),
            F.concat(F.lit("S_"), (F.col("event_id") % 3).cast("string")).alias("schema_name"),
            F.when(F.col("event_type") == "error", "FAIL").otherwise("SUCCESS").alias("execution_status"),
            (k * F.lit(2**30)).alias("bytes_scanned"),
            (k * 10).alias("rows_produced"),
            elapsed.alias("total_elapsed_time"),
            elapsed.alias("execution_time"),
        )
        return cast_to(log, schemas.QUERIES)

    def raw_queries(self) -> DataFrame:
        return self.queries().select(*[F.col(f.name).cast("string").alias(f.name) for f in schemas.QUERIES.fields])

    def storage(self) -> DataFrame:
        day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
        num_bytes = F.sum(F.col("o_totalprice").cast("decimal(18,2)")) * F.lit(1_000_000)
        snapshots = (
            self.table("orders")
            .groupBy(day.alias("usage_date"), F.col("o_orderpriority").alias("database_name"))
            .agg(num_bytes.cast("decimal(38,0)").alias("average_database_bytes"))
        )
        return cast_to(
            snapshots.select(
                "usage_date",
                # The priority's leading digit serves as the database id.
                (F.substring("database_name", 1, 1).cast("bigint") + 1000).alias("database_id"),
                "database_name",
                "average_database_bytes",
                F.call_function("div", F.col("average_database_bytes"), F.lit(5)).alias("average_failsafe_bytes"),
            ),
            schemas.STORAGE,
        )

    def raw_storage(self) -> DataFrame:
        return self.storage().select(
            *[F.col(f.name).cast("string").alias(f.name) for f in schemas.STORAGE.fields],
            F.lit("0").alias("average_stage_bytes"),
        )

    def department_map(self) -> DataFrame:
        region = self.table("region")
        named = self.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return cast_to(
            named.select(
                F.concat(F.lit("WH_"), F.col("n_nationkey").cast("string")).alias("warehouse_name"),
                F.when(F.col("n_nationkey") == 6, " ").otherwise(F.col("r_name")).alias("department"),
            ),
            schemas.DEPARTMENT_MAP,
        )

    def budget(self) -> DataFrame:
        dates = F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-02-14").cast("date"))
        return cast_to(
            self.table("region").select(
                F.col("r_name").alias("department"),
                F.explode(dates).alias("date"),
                (F.lit(100) + F.lit(10) * F.col("r_regionkey")).alias("budget_usd"),
            ),
            schemas.BUDGET,
        )

    def attribution(self) -> DataFrame:
        """A cost estimate for every statement, by its run time."""
        elapsed = F.col("total_elapsed_time")
        return cast_to(
            self.queries().select("query_id", F.round(elapsed.cast("decimal(18,0)") * F.lit(Decimal("0.00001")), 6).alias("estimated_query_cost_usd")),
            schemas.ATTRIBUTION,
        )

    def clustering(self) -> DataFrame:
        return cast_to(
            self.table("events")
            .groupBy(X.bucket(F.col("ts")).alias("usage_hour"))
            .agg(F.sum(F.when(F.col("event_type") == "signup", Decimal("0.010")).otherwise(Decimal("0.002"))).alias("credits_used")),
            schemas.CLUSTERING,
        )

    def settings(self) -> DataFrame:
        """One row per warehouse seen, with auto-suspend alternating 300, 600, unset by number."""
        n = _warehouse_number()
        seen = self.table("events").select(n.alias("n"), _warehouse_name().alias("name")).distinct()
        return cast_to(
            seen.select(
                "name",
                F.when(F.col("n") % 3 == 0, 300).when(F.col("n") % 3 == 1, 600).alias("auto_suspend"),
                F.get(F.array(*[F.lit(s) for s in SIZES]), F.col("n").cast("int")).alias("size"),
            ),
            schemas.SETTINGS,
        )
