from datetime import date

from millrace.contracts import RAW
from millrace.operators.layout import read_table
from millrace.plans.load import load_feed, table_path
from millrace.plans.views import fraud_signals_recent
from tests.test_landing import SIGNALS, write_avro


def test_drops_are_loaded_and_reloaded(spark, tmp_path):
    warehouse, quarantine = str(tmp_path / "wh"), str(tmp_path / "bad")
    contract = RAW["sales_retail"]
    hours = ("2024013005", "2024013006")
    for hour in hours:
        drop = tmp_path / f"{hour}.csv"
        drop.write_text(f"{hour},S,d,1,x,2.5,C,FR\nB{hour},S,d,many,x,2.5,C,FR\n")
        assert load_feed(spark, "sales_retail", str(drop), warehouse, quarantine, {"date_ts": hour}) == 1
    path = table_path(warehouse, contract)
    assert read_table(spark, path, contract).count() == 4
    listed = spark.read.parquet(f"{quarantine}/sales_retail/*")
    assert listed.count() == 2 and listed.first().failed_columns == ["quantity"]

    clean = tmp_path / "again.csv"
    clean.write_text("only,S,d,1,x,2.5,C,FR\n")
    assert load_feed(spark, "sales_retail", str(clean), warehouse, quarantine, {"date_ts": hours[0]}) == 0
    assert {r.invoice_no for r in read_table(spark, path, contract).collect()} == {"only", hours[1], "B" + hours[1]}
    assert spark.read.parquet(f"{quarantine}/sales_retail/*").count() == 1


def test_clustered_drop(spark, tmp_path):
    drop = tmp_path / "e.json"
    drop.write_text("".join(f'{{"event_id":"{i}","platform":"p{i % 3}"}}\n' for i in range(300)) + "{bad\n")
    values = {"event_date": "20240130", "hour_bucket": "5"}
    assert load_feed(spark, "mobile_events", str(drop), str(tmp_path / "wh"), str(tmp_path / "bad"), values) == 1
    stored = read_table(spark, table_path(str(tmp_path / "wh"), RAW["mobile_events"]), RAW["mobile_events"])
    assert stored.count() == 301


def test_drops_that_share_a_day_do_not_replace_each_other(spark, tmp_path):
    """Signals are stored by their own day, so a drop may reach into the days of others."""
    warehouse, contract = str(tmp_path / "wh"), RAW["fraud_signals"]
    day = 86_400_000
    start = 1706486400000  # 2024-01-29

    def load(drop, times):
        path = str(tmp_path / f"{drop}-{len(times)}.avro")
        rows = [{"customer_id": drop, "score": 0.5, "reason_codes": [], "signal_ts": t} for t in times]
        write_avro(spark, path, SIGNALS, rows)
        assert load_feed(spark, "fraud_signals", path, warehouse, str(tmp_path / "bad"), {"signal_date": drop}) == 0

    def stored():
        table = read_table(spark, table_path(warehouse, contract), contract)
        assert table.columns == contract.names
        return table

    load("20240129", [start, start + day, None])
    load("20240130", [start + day, start + day + 1, None])
    assert stored().count() == 6 and stored().where("signal_ts IS NULL").count() == 2
    load("20240129", [start, start + day, start + day + 2, None])
    counts = {r.signal_date: r["count"] for r in stored().groupBy("signal_date").count().collect()}
    assert counts == {"20240129": 4, "20240130": 3}

    recent = fraud_signals_recent(stored(), date(2024, 1, 31))
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(signal_date" in plan


def test_drops_whose_names_give_no_key_are_kept_apart(spark, tmp_path):
    path = table_path(str(tmp_path / "wh"), RAW["sales_retail"])
    for name in ("soon", "later", "soon"):
        drop = tmp_path / f"{name}.csv"
        drop.write_text(f"{name},S,d,1,x,2.5,C,FR\n")
        assert load_feed(spark, "sales_retail", str(drop), str(tmp_path / "wh"), str(tmp_path / "bad"), {"date_ts": name}) == 1
    stored = read_table(spark, path, RAW["sales_retail"])
    assert sorted(r.invoice_no for r in stored.collect()) == ["later", "soon"]
    assert stored.where("partition_ts is null").count() == 2


def test_siblings_of_one_hour_do_not_replace_each_other(spark, tmp_path):
    warehouse, bad = str(tmp_path / "wh"), str(tmp_path / "bad")
    contract = RAW["shipment_tracking"]

    def load(hour, carrier, numbers):
        drop = tmp_path / f"{hour}-{carrier}-{len(numbers)}.csv"
        drop.write_text("".join(f"{n},{carrier},i,c,,,x,y,\n" for n in numbers))
        load_feed(spark, "shipment_tracking", str(drop), warehouse, bad, {"date_ts": hour, "carrier_partition": carrier})

    def stored():
        return sorted(r.tracking_no for r in read_table(spark, table_path(warehouse, contract), contract).collect())

    load("2024013005", "a-b", ["1", "2"])
    load("2024013005", "fedex", ["3"])
    load("20240130", "fedex", ["4"])
    load("2024013000", "fedex", ["5"])
    assert stored() == ["1", "2", "3", "4", "5"]
    load("2024013005", "a-b", ["6"])
    assert stored() == ["3", "4", "5", "6"]
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    load_feed(spark, "shipment_tracking", str(empty), warehouse, bad, {"date_ts": "2024013005", "carrier_partition": "fedex"})
    assert stored() == ["4", "5", "6"]


def test_a_smaller_drop_leaves_no_day_of_the_larger_one(spark, tmp_path):
    warehouse, contract = str(tmp_path / "wh"), RAW["fraud_signals"]
    day = 86_400_000
    for times in ([1706486400000, 1706486400000 + day], [1706486400000 + day]):
        path = str(tmp_path / f"{len(times)}.avro")
        write_avro(spark, path, SIGNALS, [{"customer_id": "c", "score": 0.5, "reason_codes": [], "signal_ts": t} for t in times])
        load_feed(spark, "fraud_signals", path, warehouse, str(tmp_path / "bad"), {"signal_date": "20240130"})
    assert read_table(spark, table_path(warehouse, contract), contract).count() == 1


def test_folders_are_loaded_twice(spark, tmp_path):
    warehouse, bad = str(tmp_path / "wh"), str(tmp_path / "bad")
    contract = RAW["sales_retail"]

    def load(drops):
        root = tmp_path / f"load{len(drops)}{sorted(drops)[0]}"
        for hour, lines in drops.items():
            (root / f"date_ts={hour}").mkdir(parents=True)
            (root / f"date_ts={hour}" / "a.csv").write_text(lines)
        return load_feed(spark, "sales_retail", str(root), warehouse, bad)

    assert load({"2024013005": "A,S,d,many,x,2.5,C,FR\n", "2024013006": "B,S,d,1,x,2.5,C,FR\n"}) == 1
    assert load({"2024013006": "C,S,d,some,x,2.5,C,FR\nD,S,d,1,x,2.5,C,FR\n"}) == 1
    assert sorted(r.invoice_no for r in read_table(spark, table_path(warehouse, contract), contract).collect()) == ["A", "C", "D"]
    assert spark.read.parquet(f"{bad}/sales_retail").count() == 2
    assert load({"2024013005": "E,S,d,1,x,2.5,C,FR\n"}) == 0
    assert spark.read.parquet(f"{bad}/sales_retail").count() == 1
