"""Explicit input schemas; readers never infer types from data."""

from costmart.functions.types import schema_of

METERING = schema_of(
    start_time="timestamp_ntz",
    end_time="timestamp_ntz",
    warehouse_id="long",
    warehouse_name="string",
    credits_used="decimal(18,3)",
    credits_used_compute="decimal(18,3)",
    credits_used_cloud_services="decimal(18,3)",
)
RAW_METERING = schema_of(
    start_time="string",
    end_time="string",
    warehouse_name="string",
    total_credits_used="decimal(18,3)",
    total_cost_usd="decimal(18,2)",
)
QUERIES = schema_of(
    query_id="string",
    start_time="timestamp_ntz",
    end_time="timestamp_ntz",
    user_name="string",
    role_name="string",
    warehouse_name="string",
    warehouse_size="string",
    query_type="string",
    database_name="string",
    schema_name="string",
    execution_status="string",
    bytes_scanned="long",
    rows_produced="long",
    total_elapsed_time="long",
    execution_time="long",
)
RAW_QUERIES = schema_of(**{name: "string" for name in QUERIES.names})
STORAGE = schema_of(
    usage_date="date",
    database_id="long",
    database_name="string",
    average_database_bytes="decimal(38,0)",
    average_failsafe_bytes="decimal(38,0)",
)
RAW_STORAGE = schema_of(
    usage_date="string",
    database_id="string",
    database_name="string",
    average_database_bytes="string",
    average_failsafe_bytes="string",
    average_stage_bytes="string",
)
DEPARTMENT_MAP = schema_of(
    warehouse_name="string",
    department="string",
)
BUDGET = schema_of(
    department="string",
    date="date",
    budget_usd="decimal(18,2)",
)
ATTRIBUTION = schema_of(
    query_id="string",
    estimated_query_cost_usd="decimal(38,6)",
)
CLUSTERING = schema_of(
    usage_hour="timestamp_ntz",
    credits_used="decimal(18,3)",
)
SETTINGS = schema_of(
    name="string",
    auto_suspend="integer",
    size="string",
)
