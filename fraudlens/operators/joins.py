"""Joins of transactions with dictionaries of listed keys.

A dictionary has no primary key: each of its rows gives an output row. NULL keys match nothing.
It is broadcast only after its rows have been measured; a larger one is joined by shuffle, where
adaptive execution splits the partitions of hot keys (batch) or a salt does (streams).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_BYTES = 128 << 20
# Parts of a heavy key for each partition that it would fill: hashed at random, they then leave few partitions out.
PARTS_PER_PARTITION = 4
# Keys that the sketch of heavy keys keeps count of.
TRACKED_KEYS = 10_000


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of the bytes of all rows as Spark holds them in memory; runs one small job."""
    row, texts = 32 + 16 * len(df.columns), ["0"]
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(f"coalesce(octet_length(`{field.name}`), 0)")
        elif not isinstance(field.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            raise ValueError(f"no size bound for {field.name} of type {field.dataType.simpleString()}")
    return df.agg(F.expr(f"sum(bigint({row} + {' + '.join(texts)}))")).first()[0] or 0


def _never_null(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drops NULL keys and declares the others as such. Spark else sees that only in micro-batches
    with rows on both sides, and refuses the join state of the others for its different schema."""
    types = {k: df.schema[k].dataType for k in keys}
    fill = {k: F.lit("" if isinstance(dtype, T.StringType) else 0).cast(dtype) for k, dtype in types.items()}
    return df.dropna(subset=keys).withColumns({k: F.coalesce(k, v) for k, v in fill.items()})


def heavy_keys(sample: DataFrame, key: str, partitions: int) -> dict[str, int]:
    """Keys that alone hold more than their part of ``partitions`` in ``sample``, and into how many parts to split each.

    There are fewer than ``partitions`` of them, whatever the sample's size; what it misses is only slower.
    """
    known = sample.where(F.col(key).isNotNull())
    told = known.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {max(partitions, 1)}, {max(TRACKED_KEYS, 2 * partitions)})").alias("top")).first()
    fills = {item["item"]: item["count"] * partitions / told["n"] for item in told["top"] or []}
    return {k: min(-(-PARTS_PER_PARTITION * int(f * 1000) // 1000), PARTS_PER_PARTITION * partitions) for k, f in fills.items() if f > 1}


def _split(df: DataFrame, key: str, heavy: dict[str, int]) -> DataFrame:
    """``df`` with the parts of each row's key, 1 for those that are not heavy."""
    table = df.sparkSession.createDataFrame(list(heavy.items()), T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("_parts", T.IntegerType())]))
    return df.join(F.broadcast(table), key, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))


def dictionary_join(
    df: DataFrame, dictionary: DataFrame, keys: list[str], how: str = "inner", broadcast_bytes: int = BROADCAST_BYTES, salts: int | None = None,
    heavy: dict[str, int] | None = None,
) -> DataFrame:
    """``df`` joined with ``dictionary`` on ``keys``, ``how`` being ``inner`` or ``left``.

    With a batch dictionary on the side of a stream, the rows present when the plan is made are
    the ones that match. With two streams an entry also matches the transactions before it; both
    sides are then kept for good, spread by ``salts`` so that no key sits in one state partition, or with
    ``heavy`` (see :func:`heavy_keys`) only those keys, each over its own number of parts. Either is to stay the same
    for as long as the state is kept; results do not depend on it.
    """
    if how not in {"inner", "left"}:
        raise ValueError(f"how must be inner or left, not {how}")
    listed = dictionary.dropna(subset=keys)
    if not dictionary.isStreaming:
        if measured_bytes(listed) <= broadcast_bytes:
            return df.join(F.broadcast(listed), keys, how)
        # With the hint, Spark's own estimate from the size of compressed files does not broadcast it
        # after all. Adaptive execution splits the skewed partitions of a sort-merge join.
        if not df.isStreaming and (salts or 1) == 1 and heavy is None:
            return df.join(listed.hint("merge"), keys, how)
    elif how == "left":
        raise ValueError("a left join of two streams has no final result without a time bound")
    if heavy is not None and len(keys) != 1:
        raise ValueError("heavy keys are those of one column")
    salts = salts or 16
    # Each row has one salt and meets the dictionary rows of that salt, which are all of them. The
    # salt is the same in whatever order a task that is run again sees its rows, and the partition
    # number splits large groups of equal rows.
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    parts, entries = F.lit(salts), listed
    if heavy is not None:
        parts, df, entries = F.col("_parts"), _split(df, keys[0], heavy), _split(listed, keys[0], heavy)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), parts).cast("int")).drop("_parts")
    copies = entries.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    keys = [*keys, "_salt"]
    if dictionary.isStreaming:
        salted, copies = _never_null(salted, keys), _never_null(copies, keys)
    else:
        copies = copies.hint("merge")
    return salted.join(copies, keys, how).drop("_salt")
