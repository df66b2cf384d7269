from collections import Counter

import pytest
from pyspark.sql import types as T

from millrace.contracts import RAW, STAGING
from millrace.functions.types import UnmappedType, declared_type
from millrace.sources.landing import LANDERS


def kinds(contracts):
    return Counter(type(f.dataType).__name__ for c in contracts.values() for f in c.schema.fields)


def test_tables_and_columns():
    assert len(RAW) == 19 and len(STAGING) == 10
    assert sum(kinds(RAW).values()) == 246
    assert sum(kinds(STAGING).values()) == 102
    assert kinds(RAW)["VariantType"] == 4
    assert kinds(RAW)["DecimalType"] == 12
    assert kinds(STAGING)["DecimalType"] == 11


def test_every_column_is_nullable():
    for contract in [*RAW.values(), *STAGING.values()]:
        assert all(f.nullable for f in contract.schema.fields)


def test_key_is_a_column_and_comes_last():
    for contract in [*RAW.values(), *STAGING.values()]:
        assert contract.key.column in contract.names
        if contract.name != "fraud_signals":
            assert contract.names[-1] == contract.key.column


def test_keys_and_clusters():
    hourly = [c.name for c in RAW.values() if c.key.column == "partition_ts"]
    assert len(hourly) == 12
    clustered = {c.name: c.cluster for c in [*RAW.values(), *STAGING.values()] if c.cluster}
    assert clustered == {
        "shipment_tracking": ("carrier_partition",),
        "warehouse_picks": ("warehouse_id_partition",),
        "mobile_events": ("platform",),
        "dedup_clickstream": ("country_partition", "user_id"),
    }
    assert RAW["supplier_invoices"].key.grain == "month"
    assert RAW["fraud_signals"].key.grain == "day"


def test_folder_columns_are_dropped_or_promoted():
    for contract in RAW.values():
        kept = set(contract.feed.delivered) & set(contract.names)
        allowed = {"carrier_partition", "warehouse_id_partition", "signal_date", contract.key.column}
        assert kept <= allowed


def test_one_lander_per_feed():
    assert set(LANDERS) == set(RAW)


@pytest.mark.parametrize(
    "feed_type, declared",
    [
        ("int", "bigint"),
        ("tinyint", "bigint"),
        ("float", "double"),
        ("decimal(10,2)", "decimal(38,9)"),
        ("map<string,string>", "variant"),
        ("struct<a:int,b:array<decimal(4,1)>>", "struct<a:bigint,b:array<decimal(38,9)>>"),
        ("array<struct<sku:string,qty:int,price:decimal(10,2)>>",
         "array<struct<sku:string,qty:bigint,price:decimal(38,9)>>"),
        ("timestamp_ntz", "timestamp"),
    ],
)
def test_type_mapping(spark, feed_type, declared):
    assert declared_type(T.DataType.fromDDL(feed_type)).simpleString() == declared


@pytest.mark.parametrize("feed_type", [T.BinaryType(), T.MapType(T.LongType(), T.StringType()), T.NullType()])
def test_unmapped_types_are_refused(feed_type):
    with pytest.raises(UnmappedType):
        declared_type(T.ArrayType(feed_type))
