"""Record schemas of the reference's stream types, as Spark DDL strings."""

# sensor line "id,seconds,temperature"; one job variant stamps readings in ms
SENSOR = "id STRING, timestamp BIGINT, temperature DOUBLE"
# request line "user,operation,seconds"
REQUEST = "user_id STRING, operation_type STRING, timestamp BIGINT"
# two-stream join lines "ride_id,type,seconds" and "ride_id,fare,seconds"
RIDE_LINE = "ride_id STRING, type STRING, timestamp BIGINT"
FARE_LINE = "ride_id STRING, fare DOUBLE, timestamp BIGINT"
# typed taxi records
TAXI_RIDE = ("ride_id BIGINT, is_start BOOLEAN, event_time TIMESTAMP, start_lon FLOAT, "
             "start_lat FLOAT, end_lon FLOAT, end_lat FLOAT, passenger_cnt SMALLINT, "
             "taxi_id BIGINT, driver_id BIGINT")
TAXI_FARE = ("ride_id BIGINT, taxi_id BIGINT, driver_id BIGINT, start_time TIMESTAMP, "
             "payment_type STRING, tip FLOAT, tolls FLOAT, total_fare FLOAT")
TRANSACTION = "account_id BIGINT, amount DOUBLE, ts TIMESTAMP"
TEXT = "value STRING"

# line formats by name, used by the text-line parsers
LINE_SCHEMAS = {
    "sensor": SENSOR,
    "request": REQUEST,
    "ride": RIDE_LINE,
    "fare": FARE_LINE,
}
