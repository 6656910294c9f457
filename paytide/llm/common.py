"""What several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.session import prepare

SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark; batches to Python are kept small, for long texts."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words between the six ASCII white-space characters; null counts as none."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")
    # after trimming, the words are one more than the blanks
    trimmed = F.trim(spaced)
    blanks = F.length(trimmed) - F.length(F.translate(trimmed, " ", ""))
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(blanks + 1).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_number(*parts: object) -> int:
    """A number below 2**31 that a seed and a purpose fix."""
    import hashlib

    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) >> 1
