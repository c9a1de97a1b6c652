"""Declared schemas. Reading with a schema costs no inference pass."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


PRICE = T.DecimalType(12, 2)

RAW_SALE = _struct(
    ("listing_id", T.StringType()),
    ("source", T.StringType()),
    ("scraped_at", T.TimestampType()),
    ("sale_price_usd", PRICE),
    ("sale_date", T.DateType()),
    ("listing_title", T.StringType()),
    ("fighter_name", T.StringType()),
    ("card_year", T.IntegerType()),
    ("card_set", T.StringType()),
    ("card_number", T.StringType()),
    ("grade", T.StringType()),
    ("grader", T.StringType()),
    ("grade_numeric", T.DoubleType()),
    ("listing_url", T.StringType()),
    ("image_url", T.StringType()),
    ("sale_type", T.StringType()),
    ("record_hash", T.StringType()),
)

RUN_LOG = _struct(
    ("source", T.StringType()),
    ("run_id", T.StringType()),
    ("started_at", T.StringType()),
    ("completed_at", T.StringType()),
    ("records_scraped", T.IntegerType()),
    ("records_valid", T.IntegerType()),
    ("records_new", T.IntegerType()),
    ("records_written", T.IntegerType()),
    ("errors", T.ArrayType(T.StringType())),
)

ENTITY_SEED = _struct(
    ("fighter_name_canonical", T.StringType()),
    ("fighter_name_alias", T.StringType()),
    ("sport", T.StringType()),
    ("nationality", T.StringType()),
    ("promotion", T.StringType()),
    ("active", T.StringType()),
    ("debut_year", T.StringType()),
)

GRADE_DIM = _struct(
    ("grade_id", T.IntegerType()),
    ("grader", T.StringType()),
    ("grade_numeric", T.DoubleType()),
    ("grade_label", T.StringType()),
)

CERT = _struct(
    ("cert_number", T.StringType()),
    ("grade", T.StringType()),
    ("grade_numeric", T.DoubleType()),
    ("grader", T.StringType()),
    ("year", T.StringType()),
    ("brand", T.StringType()),
    ("subject", T.StringType()),
    ("variety", T.StringType()),
    ("spec_level", T.StringType()),
    ("fetched_at", T.StringType()),
)

API_ITEM = _struct(
    ("itemId", T.StringType()),
    ("title", T.StringType()),
    ("price", _struct(("value", T.StringType()), ("currency", T.StringType()))),
    ("itemEndDate", T.StringType()),
    ("buyingOptions", T.ArrayType(T.StringType())),
    ("itemWebUrl", T.StringType()),
    ("image", _struct(("imageUrl", T.StringType()))),
)

API_PAYLOAD = _struct(("itemSummaries", T.ArrayType(API_ITEM)))

SOURCE_STATUS = _struct(
    ("last_successful_scrape", T.TimestampType()),
    ("last_run_records_written", T.IntegerType()),
    ("last_run_records_invalid", T.IntegerType()),
    ("status", T.StringType()),
    ("lag_hours", T.DoubleType()),
)
