"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import checkpoint_dir

# A key is hot when it holds at least one row in HOT_PARTS, so there are never
# more than HOT_PARTS hot keys: the bound that makes their broadcast safe.
HOT_PARTS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, kind: str = "table", compression: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and
    survives the loss of any executor."""
    path = shared_path(df.sparkSession, kind)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` of which nothing is read any more: what
    was made of them is written itself."""
    for df in tables:
        path = _PATHS.pop(df, None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str,
           how: str = "left", total: int | None = None) -> DataFrame:
    """Join ``left`` with ``right``, which has one row per ``key`` and says in
    ``weight`` how many rows of ``left`` have that key.

    Keys holding at least 1/HOT_PARTS of all rows (so at most HOT_PARTS keys)
    are joined by broadcast and never meet in one task; the others go through a
    shuffle in which no key is large.  ``left`` is read twice, so it should be
    cheap to read.  Rows with a null key are kept by ``how="left"``, spread out.
    ``total`` saves a job if the number of rows, or a bound of it, is known.
    """
    if total is None:
        total = right.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * F.lit(HOT_PARTS) >= F.lit(total)
    values = [c for c in right.columns if c != weight]
    hot, cold = right.where(is_hot).select(values), right.where(~is_hot).select(values)
    known = left.where(F.col(key).isNotNull())
    parts = [known.join(F.broadcast(hot), key),
             known.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)]
    if how == "left":
        nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c)
                 for c in values if c != key]
        parts.append(left.where(F.col(key).isNull()).select("*", *nulls))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def free(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of what nothing refers to any
    more: it learns of them when the driver collects garbage.  The session keeps
    its last job, so there is a small one first."""
    spark.range(1).count()
    gc.collect()
    spark._jvm.System.gc()


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
