"""Column contracts of the inputs and outputs, and the fixed values of the rules."""

from __future__ import annotations

from pyspark.sql import types as T

# What the rules flag, and how their windows are cut.
BIG_AMOUNT = 10_000_000
VELOCITY_SIZE, VELOCITY_SLIDE, VELOCITY_MIN_TXNS = "1 minute", "10 seconds", 5
GEO_SIZE, GEO_SLIDE, GEO_MIN_LOCATIONS = "5 minutes", "1 minute", 2
DEVICE_SIZE, DEVICE_SLIDE, DEVICE_MIN_CUSTOMERS = "5 minutes", "1 minute", 4
WATERMARK_DELAY = "5 seconds"

# Texts that alert consumers match on. The device-blacklist hits carry the
# customer label and the device message names a day, as the consumers know them.
VELOCITY_MESSAGE = "⚠️ Suspicious velocity: ≥5 transactions in 1 min"
GEO_MESSAGE = "🚨 Geolocation anomaly: ≥2 locations in <5 minutes"
DEVICE_MESSAGE = "⚠️ Device anomaly: >3 users on same device in 1 day"
BLACKLIST_LABEL = "blacklist customer"

# The vocabulary of the transaction producers.
LOCATIONS = ["jakarta", "bandung", "cimahi", "depok", "bogor", "surabaya", "malang", "semarang", "yogyakarta"]
MERCHANTS = ["alfamart", "indomaret", "tokopedia", "shopee", "bukalapak"]
PAYMENT_METHODS = ["Debit Card", "Credit Card", "E-Wallet", "Q-ris"]

# Event-time text as producers write it; up to nine fraction digits are read.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"
TIME_PATTERN_SECONDS = "yyyy-MM-dd HH:mm:ss"

S, L, I, TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


TRANSACTIONS = _struct(
    ("transaction_id", S), ("customer_id", S), ("amount", L), ("location", S),
    ("merchant", S), ("payment_method", S), ("device_id", S), ("timestamp", TS),
)
# The event time stays text here and is computed into its own column.
TRANSACTIONS_TEXT_TIME = _struct(
    ("transaction_id", S), ("customer_id", S), ("amount", L), ("merchant", S),
    ("location", S), ("payment_method", S), ("device_id", S), ("timestamp", S),
)
# `mercant` is the relational table's own spelling; no record carries that field.
TRANSACTIONS_RELATIONAL = _struct(
    ("transaction_id", S), ("customer_id", S), ("amount", I), ("timestamp", TS),
    ("mercant", S), ("payment_method", S), ("location", S), ("device_id", S),
)
TRANSACTIONS_NARROW = _struct(
    ("transaction_id", L), ("customer_id", S), ("amount", L), ("location", S),
    ("payment_method", S), ("device_id", S), ("timestamp", TS),
)
BLACKLIST_CUSTOMERS = _struct(("customer_id", S), ("description", S))
BLACKLIST_DEVICES = _struct(("device_id", S), ("description", S))
BLACKLIST = _struct(*[(f.name, f.dataType) for f in TRANSACTIONS], ("label", S), ("description", S))


def _alerts(key: str, count: str) -> T.StructType:
    return _struct((key, S), ("window_start", TS), ("window_end", TS), (count, L), ("alert_message", S))


VELOCITY_ALERTS = _alerts("customer_id", "txn_count")
GEOLOCATION_ALERTS = _alerts("customer_id", "distinct_locations")
DEVICE_ALERTS = _alerts("device_id", "distinct_customers")
VELOCITY_FRAUD = _struct(("customer_id", S), ("tx_count", L), ("window_start", TS), ("window_end", TS))

TRANSACTION_COLUMNS = TRANSACTIONS.fieldNames()
BLACKLIST_COLUMNS = BLACKLIST.fieldNames()

# Record key of every output; an empty list marks an unkeyed append stream.
OUTPUT_KEYS = {
    "transactions": ["transaction_id"],
    "big_amount": ["transaction_id"],
    "blacklist": ["transaction_id"],
    "velocity_alerts": ["customer_id"],
    "geolocation_alerts": ["customer_id"],
    "device_alerts": ["device_id"],
    "velocity_fraud": ["customer_id", "window_start"],
    "blacklist_customers": ["customer_id"],
    "blacklist_devices": ["device_id"],
    "blacklist_append": [],
    "blacklist_customers_append": [],
    "device_alerts_append": [],
}
