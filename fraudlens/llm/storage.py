"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import fraudlens
from fraudlens.session import shared_folder


# Folders of intermediate tables that this application has made and not removed, in their order.
_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back: later steps neither compute it again nor depend
    on the executors that made it."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    _made.append(folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, first: int = 0, last: int | None = None) -> None:
    """Deletes the intermediate tables from the ``first`` to before the ``last``, in the order they were made (see
    :func:`made`). Results read them until they are written themselves: call it only then."""
    for folder in _made[first:last]:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    del _made[first:last]


def made() -> int:
    """How many intermediate tables there are."""
    return len(_made)


def free(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator adds itself."""
    return df.drop(*[c for c in df.columns if c in names])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def schema_with(df: DataFrame, added: str, without: tuple[str, ...] = ()) -> T.StructType:
    extra = T.StructType.fromDDL(added)
    return T.StructType([f for f in df.schema if f.name not in without] + list(extra))


def text_or_empty(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application: their Python runs parts of it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(fraudlens.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}-code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
