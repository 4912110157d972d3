"""Column layouts of the tables the reports run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

MONEY = T.DecimalType(18, 4)

USER_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("external_user_id", T.StringType()),
    T.StructField("network_user_id", T.StringType()),  # too long for an integer
    T.StructField("event_type", T.StringType()),
    T.StructField("event_date", T.TimestampType()),
    T.StructField("publisher_id", T.LongType()),  # 0 = organic
    T.StructField("campaign_id", T.LongType()),
    T.StructField("sub_id", T.StringType()),
    T.StructField("affiliate_id", T.StringType()),
    T.StructField("deposit_amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("converted_amount", MONEY),
    T.StructField("converted_currency", T.StringType()),
    T.StructField("website", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("advertiser", T.StringType()),
])

_SPEND_HEAD = [
    T.StructField("publisher_id", T.LongType()),
    T.StructField("publisher_name", T.StringType()),
    T.StructField("format", T.StringType()),
]
_SPEND_TAIL = [
    T.StructField("deposits_reported", T.LongType()),
    T.StructField("spend", T.DecimalType(15, 2)),
    T.StructField("current_cpa", T.DecimalType(10, 3)),
]
PUBLISHER_SPEND = T.StructType(_SPEND_HEAD + [T.StructField("month", T.StringType())] + _SPEND_TAIL)
PUBLISHER_SPEND_DAILY = T.StructType(_SPEND_HEAD + [T.StructField("date", T.DateType())] + _SPEND_TAIL)

CAMPAIGNS = T.StructType([
    T.StructField("source_sheet_id", T.StringType()),
    T.StructField("attribution_type", T.StringType()),  # 1_hour / 24_hours
    T.StructField("event_date", T.TimestampType()),
    T.StructField("campaignid", T.LongType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("postview", T.LongType()),
    T.StructField("postclick", T.LongType()),
    T.StructField("spend", T.StringType()),  # text numbers, decimal comma
    T.StructField("cpa_pv", T.StringType()),
    T.StructField("cpa_pc", T.StringType()),
    T.StructField("total_spend", T.StringType()),
    T.StructField("total_cpa", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order; columns ``df`` lacks become typed NULLs."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
