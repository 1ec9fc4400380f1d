"""Rules over skewed transactions of one day, as built and in the plain form; prints one line of JSON.

``python scale_bench.py FOLDER [rows]`` writes the transactions below FOLDER, or reads them from there:
a third of the rows has one customer, another third one device. Both forms must give the same rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraudlens import schemas as s
from fraudlens.operators.windows import hop
from fraudlens.plans import rules
from fraudlens.session import create_session

CUSTOMERS, DEVICES = 200_000, 100_000


def transactions(spark: SparkSession, folder: str, rows: int) -> DataFrame:
    path = f"{folder}/transactions-{rows}"
    if not os.path.exists(f"{path}/_SUCCESS"):
        key = F.xxhash64("id")
        places = F.array(*[F.lit(x) for x in s.LOCATIONS])
        customer = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.pmod(key, F.lit(CUSTOMERS)))
        device = F.when(F.col("id") % 3 == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(DEVICES)))
        when = F.timestamp_millis((F.lit(1_704_067_200_000) + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(86_400_000))))
        spark.range(rows).select(
            F.concat(F.lit("TX"), "id").alias("transaction_id"), F.concat(F.lit("C"), customer).alias("customer_id"),
            F.pmod(F.xxhash64("id", F.lit(3)), F.lit(12_000_000)).alias("amount"),
            F.element_at(places, (F.pmod(F.xxhash64("id", F.lit(4)), F.lit(len(s.LOCATIONS))) + 1).cast("int")).alias("location"),
            F.lit(s.MERCHANTS[0]).alias("merchant"), F.lit(s.PAYMENT_METHODS[0]).alias("payment_method"),
            F.concat(F.lit("dev-"), device).alias("device_id"), when.alias("timestamp"),
        ).write.parquet(path)
    return spark.read.parquet(path)


def plain_distinct(tx: DataFrame, key: str, value: str, size: str, slide: str, name: str, minimum: int, message: str) -> DataFrame:
    windows = hop(tx.select(key, value, "timestamp"), "timestamp", size, slide)
    counted = windows.groupBy(key, "window_start", "window_end").agg(F.count_distinct(value).alias(name))
    return counted.where(F.col(name) >= minimum).withColumn("alert_message", F.lit(message))


def timed(df: DataFrame) -> tuple[float, tuple]:
    """Seconds, and what tells the rows: their number and the sum of their hashes."""
    begin = time.perf_counter()
    found = df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
    return round(time.perf_counter() - begin, 2), tuple(found)


def main() -> None:
    folder, rows = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20_000_000
    spark = create_session("scale", **{
        "spark.master": f"local[{os.environ.get('BENCH_CPUS', '8')}]", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false", "spark.local.dir": f"{folder}/shuffle",
    })
    tx = transactions(spark, folder, rows)
    forms = {
        "velocity": (rules.velocity(tx), rules.velocity_direct(tx)),
        "geolocation": (rules.geolocation(tx), plain_distinct(
            tx, "customer_id", "location", s.GEO_SIZE, s.GEO_SLIDE, "distinct_locations", s.GEO_MIN_LOCATIONS, s.GEO_MESSAGE)),
        "device_sharing": (rules.device_sharing(tx), plain_distinct(
            tx, "device_id", "customer_id", s.DEVICE_SIZE, s.DEVICE_SLIDE, "distinct_customers", s.DEVICE_MIN_CUSTOMERS, s.DEVICE_MESSAGE)),
    }
    out = {}
    for name, (built, plain) in forms.items():
        (built_seconds, result), (plain_seconds, expected) = timed(built), timed(plain)
        if result != expected:
            raise SystemExit(f"{name}: {result} rows and hash, {expected} expected")
        out[name] = {"built": built_seconds, "plain": plain_seconds, "alerts": result[0]}
    out["big_amount"] = {"built": timed(rules.big_amount(tx))[0]}
    print(json.dumps({"metric": "skewed_rules", "rows": rows, "unit": "sec", "rules": out}))
    spark.stop()


if __name__ == "__main__":
    main()
