"""Text sources: the two-column pair file and the wide quoted retail file.

Both follow the reference's line handling: the first line is the header, every
line equal to it is dropped, and fields are split on ',' by position (not
quote-aware).  Empty fields stay empty strings.  Blank lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.columns import composite_key, normalise_item_id, strip_quotes

PAIR_SCHEMA = "basket string, item string"


def header_line(spark: SparkSession, path: str) -> str | None:
    """First non-empty line of the first file in name order that has one."""
    for file in sorted(spark.read.text(path).inputFiles()):
        first = (spark.read.text(file).where((F.length("value") > 0) & (F.col("_metadata.file_block_start") == 0))
                 .limit(1).collect())
        if first:
            return first[0]["value"]
    return None


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Data lines of a text file or folder: lines equal to the header and blank lines removed."""
    raw = spark.read.text(path).where(F.length("value") > 0)
    head = header_line(spark, path)
    return raw if head is None else raw.where(F.col("value") != F.lit(head))


def split_fields(lines: DataFrame) -> DataFrame:
    return lines.select(F.split("value", ",", -1).alias("f"))


def case_fields(case: str | int) -> tuple[int, int]:
    """Case 1: basket = field 0 (user), item = field 1 (business).
    Case 2 (inverted): basket = field 1, item = field 0."""
    case = str(case)
    if case == "1":
        return 0, 1
    if case == "2":
        return 1, 0
    raise ValueError(f"case must be '1' or '2', got {case!r}")


def case_projection(fields: DataFrame, case: str | int) -> DataFrame:
    b, i = case_fields(case)
    return fields.select(F.col("f")[b].alias("basket"), F.col("f")[i].alias("item"))


def read_pairs(spark: SparkSession, path: str, case: str | int = 1) -> DataFrame:
    """(basket, item) rows of a two-column CSV such as ``user_id,business_id``."""
    case_fields(case)
    return case_projection(split_fields(read_lines(spark, path)), case)


def retail_pairs(lines: DataFrame, date_field: int = 0, customer_field: int = 1,
                 item_field: int = 5, normalise: bool = True) -> DataFrame:
    """Wide quoted rows -> (basket = date-customer, item = product id).

    Quotes are stripped by dropping the first and last character of each field;
    product ids lose leading zeros when ``normalise``.
    """
    f = F.split("value", ",", -1)
    item = strip_quotes(f[item_field])
    return lines.select(
        composite_key(strip_quotes(f[date_field]), strip_quotes(f[customer_field])).alias("basket"),
        (normalise_item_id(item) if normalise else item).alias("item"),
    )


def read_retail(spark: SparkSession, path: str, **kwargs) -> DataFrame:
    return retail_pairs(read_lines(spark, path), **kwargs)
