"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: White space of the contracts, as a character class and as bytes.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def with_fields(df: DataFrame, ddl: str, drop: tuple[str, ...] = ()) -> StructType:
    """Schema of ``df`` without ``drop``, then the fields of ``ddl``; these replace columns of the same name."""
    added = StructType.fromDDL(ddl)
    gone = {f.name for f in added} | set(drop)
    return StructType([StructField(f.name, f.dataType, True) for f in df.schema if f.name not in gone] + list(added))


def doc_order(c: str = "doc_id") -> Column:
    """doc_id for comparisons; documents without one count as one document after all others."""
    return F.coalesce(F.col(c).cast("bigint"), F.lit(2**63 - 1))


def free_name(df: DataFrame, name: str) -> str:
    """A name for an interim column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
