"""The detection rules, each a function from transactions to flagged rows.

They take batch tables and streams alike; a stream must carry a watermark on its time column for
the windowed rules. The blacklist rules measure a batch dictionary by a small job while the plan is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fraudlens import schemas as s
from fraudlens.operators.distinct import count_values, hop_distinct_stream, hop_values
from fraudlens.operators.joins import BROADCAST_BYTES, dictionary_join, measured_bytes
from fraudlens.operators.latest import latest_by_key
from fraudlens.operators.windows import hop, hop_count, hop_distinct


def with_watermark(tx: DataFrame, time: str = "timestamp", delay: str = s.WATERMARK_DELAY) -> DataFrame:
    return tx.withWatermark(time, delay)


def normalise_places(tx: DataFrame, *columns: str) -> DataFrame:
    """Opt-in: one spelling for values that producers write in different case."""
    return tx.withColumns({c: F.lower(F.trim(c)) for c in columns or ("location", "merchant")})


def big_amount(tx: DataFrame, above: int = s.BIG_AMOUNT, carry: tuple[str, ...] = ()) -> DataFrame:
    return tx.where(F.col("amount") > above).select(*carry, *s.TRANSACTION_COLUMNS)


def blacklisted(
    tx: DataFrame, dictionary: DataFrame, key: str, how: str = "inner", label: str = s.BLACKLIST_LABEL, carry: tuple[str, ...] = (), **join
) -> DataFrame:
    """Transactions whose ``key`` is listed, once per dictionary row; with ``how="left"`` all of them."""
    joined = dictionary_join(tx, dictionary.select(key, "description"), [key], how, **join)
    return joined.withColumn("label", F.lit(label)).select(*carry, *s.BLACKLIST_COLUMNS)


def blacklisted_customers(tx: DataFrame, customers: DataFrame, **options) -> DataFrame:
    return blacklisted(tx, customers, "customer_id", **options)


def blacklisted_devices(tx: DataFrame, devices: DataFrame, **options) -> DataFrame:
    return blacklisted(tx, devices, "device_id", **options)


def blacklist_hits(
    tx: DataFrame, customers: DataFrame, devices: DataFrame, label: str = s.BLACKLIST_LABEL, carry: tuple[str, ...] = (),
    broadcast_bytes: int = BROADCAST_BYTES, salts: int | None = None, heavy: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """Both blacklist rules; ``_writer`` is 0 for hits by customer, 1 for hits by device. ``heavy`` has the heavy keys of either column.

    Dictionaries of a measured size are looked up in one pass over the transactions, with the
    entries of a key in one list. Larger ones are joined one by one.
    """
    dictionaries = {"customer_id": customers, "device_id": devices}
    listed = {key: d.select(key, "description").dropna(subset=[key]) for key, d in dictionaries.items()}
    if any(d.isStreaming for d in listed.values()) or measured_bytes(listed["customer_id"].union(listed["device_id"])) > broadcast_bytes:
        parts = [
            blacklisted(tx, d, key, label=label, carry=carry, broadcast_bytes=broadcast_bytes, salts=salts, heavy=(heavy or {}).get(key)).withColumn("_writer", F.lit(writer))
            for writer, (key, d) in enumerate(listed.items())
        ]
        return parts[0].unionByName(parts[1]).select(*carry, "_writer", *s.BLACKLIST_COLUMNS)
    found = tx
    for writer, (key, d) in enumerate(listed.items()):
        entries = d.groupBy(key).agg(F.expr(f"collect_list(struct({writer} AS w, description AS d)) AS _hits{writer}"))
        found = found.join(F.broadcast(entries), key, "left")
    hits = "CASE WHEN _hits1 IS NULL THEN _hits0 WHEN _hits0 IS NULL THEN _hits1 ELSE concat(_hits0, _hits1) END"
    return (
        found.where("_hits0 IS NOT NULL OR _hits1 IS NOT NULL")
        .select(*carry, *s.TRANSACTION_COLUMNS, F.lit(label).alias("label"), F.expr(f"inline({hits}) AS (_writer, description)"))
    )


def blacklist_latest(tx: DataFrame, customers: DataFrame, devices: DataFrame, sequence: str, **options) -> DataFrame:
    """The keyed blacklist table that both rules write: per transaction id the last hit by ``sequence``.

    Ties are settled by rule: devices write after customers, and among several entries of one key
    the greatest description remains. The dictionaries are cut to that entry before the join, so
    repeated entries multiply nothing.
    """

    def last_entry(dictionary: DataFrame, key: str) -> DataFrame:
        return dictionary.groupBy(key).agg(F.max("description").alias("description"))

    hits = blacklist_hits(tx, last_entry(customers, "customer_id"), last_entry(devices, "device_id"), carry=(sequence,), **options)
    order = [F.col(sequence), F.col("_writer")]
    return latest_by_key(hits, ["transaction_id"], order).select(*s.BLACKLIST_COLUMNS)


def velocity_windows(tx: DataFrame, minimum: int = 1, time: str = "timestamp", name: str = "txn_count") -> DataFrame:
    """Transactions per customer and window."""
    if tx.isStreaming:
        counted = tx.groupBy("customer_id", F.window(time, s.VELOCITY_SIZE, s.VELOCITY_SLIDE)).agg(F.count("*").alias(name))
        return counted.where(F.col(name) >= minimum).select(
            "customer_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name
        )
    return hop_count(tx, ["customer_id"], time, s.VELOCITY_SIZE, s.VELOCITY_SLIDE, name, minimum)


def velocity(tx: DataFrame, minimum: int = s.VELOCITY_MIN_TXNS, message: str = s.VELOCITY_MESSAGE) -> DataFrame:
    """Customers with many transactions in a minute."""
    return velocity_windows(tx, minimum).withColumn("alert_message", F.lit(message))


def velocity_direct(tx: DataFrame, minimum: int = s.VELOCITY_MIN_TXNS, message: str = s.VELOCITY_MESSAGE) -> DataFrame:
    """The velocity rule with every row copied into its windows: the plain form, for comparison."""
    windows = hop(tx.select("customer_id", "timestamp"), "timestamp", s.VELOCITY_SIZE, s.VELOCITY_SLIDE)
    counted = windows.groupBy("customer_id", "window_start", "window_end").agg(F.count("*").alias("txn_count"))
    return counted.where(F.col("txn_count") >= minimum).withColumn("alert_message", F.lit(message))


def velocity_by_window(tx: DataFrame, time: str = "event_time", minimum: int = s.VELOCITY_MIN_TXNS) -> DataFrame:
    """The velocity table keyed by customer and window start, on a computed event time."""
    counted = velocity_windows(tx, minimum, time, "tx_count")
    return counted.select("customer_id", "tx_count", "window_start", "window_end")


def _distinct(tx: DataFrame, key: str, value: str, size: str, slide: str, name: str, minimum: int, strategy: str) -> DataFrame:
    if tx.isStreaming:
        counted = hop_distinct_stream(tx, [key], value, "timestamp", size, slide, name, strategy)
        return counted.where(F.col(name) >= minimum)
    return hop_distinct(tx, [key], value, "timestamp", size, slide, name, minimum)


def geolocation(
    tx: DataFrame, minimum: int = s.GEO_MIN_LOCATIONS, message: str = s.GEO_MESSAGE, strategy: str = "two_stage"
) -> DataFrame:
    """Customers seen in several places within five minutes."""
    counted = _distinct(tx, "customer_id", "location", s.GEO_SIZE, s.GEO_SLIDE, "distinct_locations", minimum, strategy)
    return counted.withColumn("alert_message", F.lit(message))


def device_sharing(
    tx: DataFrame, minimum: int = s.DEVICE_MIN_CUSTOMERS, message: str = s.DEVICE_MESSAGE, strategy: str = "two_stage"
) -> DataFrame:
    """Devices used by many customers within five minutes."""
    counted = _distinct(tx, "device_id", "customer_id", s.DEVICE_SIZE, s.DEVICE_SLIDE, "distinct_customers", minimum, strategy)
    return counted.withColumn("alert_message", F.lit(message))


def geolocation_values(tx: DataFrame) -> DataFrame:
    """The places of a customer in each window, a row each: what :func:`geolocation_of_values` counts once the window is closed."""
    return hop_values(tx, ["customer_id"], "location", "timestamp", s.GEO_SIZE, s.GEO_SLIDE)


def geolocation_of_values(values: DataFrame, minimum: int = s.GEO_MIN_LOCATIONS, message: str = s.GEO_MESSAGE) -> DataFrame:
    counted = count_values(values, ["customer_id"], "location", "distinct_locations")
    return counted.where(F.col("distinct_locations") >= minimum).withColumn("alert_message", F.lit(message))


def device_sharing_values(tx: DataFrame) -> DataFrame:
    """The customers of a device in each window, a row each: what :func:`device_sharing_of_values` counts once the window is closed."""
    return hop_values(tx, ["device_id"], "customer_id", "timestamp", s.DEVICE_SIZE, s.DEVICE_SLIDE)


def device_sharing_of_values(values: DataFrame, minimum: int = s.DEVICE_MIN_CUSTOMERS, message: str = s.DEVICE_MESSAGE) -> DataFrame:
    counted = count_values(values, ["device_id"], "customer_id", "distinct_customers")
    return counted.where(F.col("distinct_customers") >= minimum).withColumn("alert_message", F.lit(message))


def copy(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pass-through in the order of the target's columns."""
    return df.select(*columns)


def distinct_entries(dictionary: DataFrame, within_watermark: bool = False) -> DataFrame:
    """Each entry once. A stream keeps every entry for good, or with a watermark only for its delay."""
    return dictionary.dropDuplicatesWithinWatermark() if within_watermark else dictionary.distinct()


def latest_transactions(tx: DataFrame, sequence: Column, columns: list[str] | None = None) -> DataFrame:
    return latest_by_key(tx.withColumn("_sequence", sequence), ["transaction_id"], [F.col("_sequence")]).select(
        *(columns or s.TRANSACTION_COLUMNS)
    )
