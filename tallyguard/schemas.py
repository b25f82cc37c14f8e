"""Fixed schemas, as DDL: production reads never infer."""

# A scored request. Optional fields may be null.
TRANSACTION = (
    "transaction_id string, amount double, merchant_category string, hour_of_day int, "
    "day_of_week int, user_age int, location_risk_score double"
)

# The same request as it arrives in files: text that the contract still has to judge.
RAW_TRANSACTION = (
    "transaction_id string, amount string, merchant_category string, hour_of_day string, "
    "day_of_week string, user_age string, location_risk_score string"
)

STREAM_TRANSACTION = (
    "transaction_id string, feature1 double, feature2 double, feature3 double, "
    "amount double, timestamp timestamp"
)

METRIC_VALUE = "metric string, value double"

ACCESS_LOG = (
    "method string, path string, query_string string, client_ip string, "
    "user_agent string, status_code int, duration_ms double"
)

TEST_RUN = (
    "test_run_id string, start_time string, end_time string, duration_seconds double, "
    "detailed_results array<struct<test_name:string,status:string,response_time_ms:double,"
    "timestamp:string,details:map<string,string>>>"
)

REGISTRY = (
    "model_name string, version string, alias string, stage string, run_id string, "
    "creation_timestamp timestamp, last_updated_timestamp timestamp, description string, "
    "tags map<string,string>"
)

CORRUPT = "_corrupt"
