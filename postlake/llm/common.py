"""What several operators of this subpackage share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.plans.staging import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Where a NULL doc_id stands in an order of documents: after all others.
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """128 bits over id and text. Rows equal in both share the key, and every result of theirs."""
    text = text_of(text_column)
    return [F.xxhash64(F.lit(1), F.col(id_column), text).alias("_k1"), F.xxhash64(F.lit(2), text, F.col(id_column)).alias("_k2")]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors and the driver can reach; the caller owns it."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def mounted(uri: str) -> str:
    """The path under which workers open the shared folder; memory-mapping needs a mounted one."""
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {uri}; set spark.checkpoint.dir to one")
    return unquote(parsed.path)


def publish(path: str, data: bytes) -> None:
    """Write whole or not at all: a repeated or lost task leaves no half file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        out.write(data)
    os.replace(part, path)


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor
