"""Cleansing jobs on small rows, and against plain Python where a rule is intricate."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harness.tables import raw_shaped
from millrace.contracts import RAW, STAGING
from millrace.functions.text import address_hash
from millrace.plans.addresses import ADDRESS, geocoded_addresses, unplaced_addresses
from millrace.plans.carriers import normalized_carrier_events, untimed_shipments
from millrace.plans.clickstream import dedup_clickstream
from millrace.plans.customers import cleansed_customers
from millrace.plans.fraud import fraud_scored
from millrace.plans.loyalty import parsed_loyalty_events
from millrace.plans.orders import cleansed_orders
from millrace.plans.products import cleansed_products
from millrace.plans.returns import merged_returns_cdc, returns_snapshot, returns_state, unkeyed_returns
from millrace.plans.warehouse import closing_backlog, warehouse_kpi_snapshot

START = datetime(2024, 1, 30)


def rows_as(spark, feed, rows, **nested):
    """Dicts to the shape of a feed; values are cast from text unless they are nested."""
    names = sorted({name for row in rows for name in row})
    texts = [tuple(None if row.get(n) is None else str(row[n]) for n in names) for row in rows]
    frame = spark.createDataFrame(texts, ", ".join(f"{n} string" for n in names))
    columns = {n: nested.get(n, F.col(n)) for n in names}
    return raw_shaped(frame, feed, **columns)


def check_schema(frame, name):
    assert [(f.name, f.dataType) for f in frame.schema.fields if "ARRAY" not in f.dataType.simpleString().upper()] == [
        (f.name, f.dataType) for f in STAGING[name].schema.fields if "ARRAY" not in f.dataType.simpleString().upper()
    ]


def test_orders(spark):
    tills = rows_as(
        spark,
        "pos_transactions",
        [
            dict(txn_id=1, invoice_no="a", txn_ts=START, gross_amount="99999999999999.99", discount_amount="0.01",
                 tax_amount="0.02", void_flag="true"),
            dict(txn_id=1, invoice_no="old", txn_ts=START - timedelta(hours=1), gross_amount="1"),
            dict(txn_id=2, invoice_no="b", txn_ts=START, gross_amount="5.123456789"),
            dict(txn_id=3, invoice_no="c", txn_ts=None, gross_amount=None, tax_amount="1"),
        ],
    )
    retail = rows_as(
        spark,
        "sales_retail",
        [
            dict(invoice_no="1", quantity=3, unit_price="0.123456789", invoice_date="1/30/2024 8:05", customer_id="x"),
            dict(invoice_no="1", quantity=-1, unit_price="2.5", invoice_date="1/30/2024 8:26", customer_id="y"),
            dict(invoice_no="9", quantity=None, unit_price="2.5", invoice_date="?", customer_id=None),
        ],
    )
    orders = cleansed_orders(tills, retail)
    check_schema(orders, "cleansed_orders")
    got = {(r.source_feed, r.order_id): r for r in orders.collect()}
    assert len(got) == 5
    assert got["pos", "1"].invoice_no == "a" and got["pos", "1"].net_amount == Decimal("100000000000000.00")
    assert got["pos", "2"].net_amount == Decimal("5.123456789") and got["pos", "2"].discount is None
    assert got["pos", "3"].net_amount is None and got["pos", "3"].order_date is None
    one = got["retail", "1"]
    assert (one.line_count, one.customer_id, one.txn_ts) == (2, "y", datetime(2024, 1, 30, 8, 26))
    assert one.gross_amount == one.net_amount == Decimal("-2.129629633")
    assert got["retail", "9"].gross_amount is None and got["retail", "9"].txn_ts is None


def test_products(spark):
    day = date(2024, 1, 30)
    feed = rows_as(
        spark,
        "product_catalog_feed",
        [
            dict(sku="a", name=" Red   Ring ", feed_date="2024-01-02", available_from=day, discontinued_at="2024-02-01"),
            dict(sku="a", name="old", feed_date="2024-01-01"),
            dict(sku="b", feed_date="2024-01-01", discontinued_at=day, color=" "),
            dict(sku="c", feed_date="2024-01-01", available_from="2024-01-31"),
            dict(sku="d", feed_date="2024-01-01"),
        ],
    )
    products = cleansed_products(feed, day)
    check_schema(products, "cleansed_products")
    got = {r.sku: r for r in products.collect()}
    assert {k: r.available for k, r in got.items()} == {"a": True, "b": False, "c": False, "d": True}
    assert got["a"].name_norm == "red ring" and got["b"].color_norm is None


def signups(spark, rows):
    return rows_as(spark, "customer_signups", rows)


def test_addresses(spark):
    people = signups(
        spark,
        [
            dict(customer_id="1", addr_line1=" 1 Main  St", addr_city="Rome"),
            dict(customer_id="2", addr_line1="1 MAIN ST ", addr_city="rome"),
            dict(customer_id="3", addr_city="1 main st"),
            dict(customer_id="4", addr_line1="", addr_city=" "),
        ],
    )
    hashes = people.select("customer_id", address_hash([F.col(c) for c in ADDRESS]).alias("h")).collect()
    h = {r.customer_id: r.h for r in hashes}
    assert h["1"] == h["2"] != h["3"] and h["4"] is None
    found = [
        (h["1"], 1.0, 1.0, "0.8", "b"),
        (h["1"], 2.0, 2.0, "0.9", "b"),
        (h["1"], 3.0, 3.0, "0.9", "a"),
        (h["1"], 4.0, 4.0, None, "a"),
        ("elsewhere", 5.0, 5.0, "1", "a"),
        (None, 6.0, 6.0, "1", "a"),
    ]
    candidates = spark.createDataFrame(
        found, "raw_addr_hash string, lat double, lon double, confidence string, provider string"
    )
    placed = geocoded_addresses(people, candidates, date(2024, 1, 30))
    check_schema(placed, "geocoded_addresses")
    assert [(r.addr_line1, r.lat, r.confidence, r.provider) for r in placed.collect()] == [
        ("1 main st", 3.0, Decimal("0.9"), "a")
    ]


def test_customers(spark):
    people = [
        dict(customer_id="1", email=" A@B.c ", phone="+1 (2) 3", first_name="x", addr_city="Rome", signup_date="2024-01-01"),
        dict(customer_id="1", email="old@b.c", signup_date="2023-01-01"),
        dict(customer_id="2", email="", first_name=None, signup_date="2024-01-01"),
    ]
    none = spark.createDataFrame([], STAGING["geocoded_addresses"].schema)
    first = cleansed_customers(signups(spark, people), none, START)
    check_schema(first, "cleansed_customers")
    got = {r.customer_id: r for r in first.collect()}
    assert got["1"].email_norm == "a@b.c" and got["1"].phone_norm == "123" and got["1"].geocoded_lat is None
    assert got["2"].email_norm is None and got["2"].load_date == START.date()

    again = cleansed_customers(signups(spark, people), none, START + timedelta(days=1), first)
    assert again.count() == 0

    people[2]["first_name"] = ""
    changed = cleansed_customers(signups(spark, people), none, START + timedelta(days=1), first)
    assert [r.customer_id for r in changed.collect()] == ["2"]

    # Back to an earlier state: it differs from the newest row, though not from all history.
    history = first.union(changed)
    people[2]["first_name"] = None
    back = cleansed_customers(signups(spark, people), none, START + timedelta(days=2), history)
    assert [r.customer_id for r in back.collect()] == ["2"]


def test_addresses_are_placed_or_listed(spark):
    people = [{"customer_id": str(i), "addr_city": city} for i, city in enumerate(["Rome", " rome", "Oslo", None, " "])]
    candidates = spark.createDataFrame(
        [(None, 1.0, 2.0, "p"), (None, 1.0, 2.0, "p")], "raw_addr_hash string, lat double, lon double, provider string"
    ).withColumn("confidence", F.lit(1))
    rome = address_hash([F.lit("Rome") if c == "addr_city" else F.lit(None).cast("string") for c in ADDRESS])
    found = candidates.limit(1).withColumn("raw_addr_hash", rome)
    listed = unplaced_addresses(signups(spark, people), candidates.unionByName(found)).collect()
    assert sorted((tuple(r.failed_columns), "oslo" in r.original) for r in listed) == [
        (("lat", "lon"), True),
        (("raw_addr_hash",), False),
        (("raw_addr_hash",), False),
    ]
    assert unplaced_addresses(signups(spark, people).limit(0), candidates.limit(0)).count() == 0


def test_shipments_without_a_time_are_listed(spark):
    time = "2024-01-30 05:00:00"
    rows = [
        {"tracking_no": "a", "status": "shipped", "shipped_at": time},
        {"tracking_no": "b", "status": "shipped", "estimated_eta": time},
        {"tracking_no": "c", "status": None},
        {"tracking_no": "d", "status": "lost", "partition_ts": time},
        {"tracking_no": "e", "status": "lost", "delivered_at": time},
        {"tracking_no": "f", "status": " ", "partition_ts": time},
    ]
    shipments = rows_as(spark, "shipment_tracking", rows)
    listed = {r.original.split('"tracking_no":"')[1][0]: r.failed_columns for r in untimed_shipments(shipments).collect()}
    every = ["shipped_at", "delivered_at", "estimated_eta", "partition_ts"]
    assert listed == {"b": ["shipped_at"], "c": every, "e": ["partition_ts"], "f": every[:3]}
    assert {r.tracking_no for r in normalized_carrier_events(shipments).collect()} == {"a", "b", "d", "e"}


def test_loyalty(spark):
    good = dict(event_ts_str="2024-01-30 05:00:00", partition_ts=START)
    rows = [
        dict(good, tx_id="1", points="12", meta_raw='{"a":1}'),
        dict(good, tx_id="2", points=" 12 ", meta_raw='{"a":1,"a":2}'),
        dict(good, tx_id="3", points="12.7", meta_raw="bad"),
        dict(tx_id="4", points="", event_ts_str="2024-01-29T01:02:03", partition_ts=None),
    ]
    events = parsed_loyalty_events(rows_as(spark, "loyalty_events", rows))
    check_schema(events, "parsed_loyalty_events")
    got = {r.tx_id: r for r in events.collect()}
    assert [got[k].points for k in "1234"] == [12, 12, None, None]
    assert got["1"].meta.toPython() == {"a": 1} and got["2"].meta is None and got["3"].meta is None
    assert got["4"].event_ts == datetime(2024, 1, 29, 1, 2, 3) and got["4"].event_date == date(2024, 1, 29)


def test_carriers(spark):
    rows = [
        dict(tracking_no="1", carrier=" FED  EX", status="Dispatched", shipped_at=START, estimated_eta=START,
             last_location="Rome, Lazio ,IT", partition_ts=START),
        dict(tracking_no="2", carrier="Snail", status="Lost", last_location="Rome", partition_ts=START),
        dict(tracking_no="3", status=None, partition_ts=START),
    ]
    events = normalized_carrier_events(rows_as(spark, "shipment_tracking", rows))
    check_schema(events, "normalized_carrier_events")
    got = sorted((r.tracking_no, r.event_type, r.carrier, r.location_country) for r in events.collect())
    assert got == [
        ("1", "estimated_delivery", "fedex", "IT"),
        ("1", "shipped", "fedex", "IT"),
        ("2", "exception", "snail", None),
    ]


def cdc(spark, rows):
    return rows_as(spark, "returns_cdc", rows)


def test_returns_delete_and_revive(spark):
    day1, day2 = date(2024, 1, 30), date(2024, 1, 31)
    first = cdc(
        spark,
        [
            dict(return_id=1, op="I", return_ts=START, snapshot_date=day1, status="new"),
            dict(return_id=1, op="D", return_ts=START, snapshot_date=day1, status="gone"),
            dict(return_id=2, op="I", return_ts=START, snapshot_date=day1, status="new"),
            dict(return_id=2, op="U", return_ts=START - timedelta(hours=1), snapshot_date=day1, status="late"),
            dict(return_id=None, op="I", return_ts=START, snapshot_date=day1),
        ],
    )
    one = merged_returns_cdc(first, day1)
    check_schema(one, "merged_returns_cdc")
    got = {r.return_id: r for r in one.collect()}
    assert got[1].is_deleted and got[1].status == "gone" and got[2].status == "new"
    second = cdc(
        spark,
        [
            dict(return_id=1, op="I", return_ts=START - timedelta(days=1), snapshot_date=day2, status="back"),
            dict(return_id=3, op=None, return_ts=None, snapshot_date=day2, status="x"),
        ],
    )
    got = {r.return_id: r for r in merged_returns_cdc(second, day2, previous=returns_state(first)).collect()}
    assert unkeyed_returns(first).count() == 1 and unkeyed_returns(second).count() == 0
    assert set(got) == {1, 2, 3} and {r.snapshot_date for r in got.values()} == {day2}
    assert not got[1].is_deleted and got[1].status == "back" and got[3].is_deleted is False


CHANGE = st.fixed_dictionaries(
    {
        "return_id": st.integers(1, 3),
        "op": st.sampled_from(["I", "U", "D"]),
        "hour": st.integers(0, 3),
        "day": st.integers(0, 2),
        "late": st.integers(0, 2),
        "status": st.sampled_from(["a", "b", None]),
        "amount": st.sampled_from(["1.00", "2.00", None]),
    }
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(CHANGE, min_size=1, max_size=14))
def test_folding_at_once_equals_folding_day_by_day(spark, changes):
    def feed(days):
        rows = [
            dict(return_id=c["return_id"], op=c["op"], return_ts=START + timedelta(hours=c["hour"]),
                 snapshot_date=date(2024, 1, 30) + timedelta(days=c["day"]), status=c["status"],
                 refund_amount=c["amount"], invoice_no="i")
            for c in changes if max(c["day"], c["late"]) in days
        ]
        return cdc(spark, rows) if rows else spark.createDataFrame([], RAW["returns_cdc"].schema)

    last = date(2024, 2, 1)
    at_once = merged_returns_cdc(feed({0, 1, 2}), last)
    stepped = None
    for day in range(3):
        stepped = returns_state(feed({day}), stepped)
    stepped = returns_snapshot(stepped, last)
    assert sorted(map(str, at_once.collect())) == sorted(map(str, stepped.collect()))


def brute_force_scores(sales, signals, span):
    expected = {}
    for txn, customer, at in sales:
        seen = [s for s in signals if customer is not None and at is not None
                and s[0] == customer and s[1] is not None and at - span < s[1] <= at]
        scores = [s[2] for s in seen if s[2] is not None and s[2] == s[2]]
        codes = sorted({c for s in seen for c in (s[3] or []) if c is not None})
        expected[txn] = (max(scores, default=0.0), codes)
    return expected


@pytest.mark.parametrize("seed, slice_minutes", [(1, 10), (2, 60), (3, 1), (4, 1440)])
def test_fraud_scores_match_brute_force(spark, seed, slice_minutes):
    rng = random.Random(seed)
    grid = [START + timedelta(minutes=10 * i) for i in range(400)]

    def moment():
        return rng.choice(grid) + timedelta(seconds=rng.choice([0, 0, 1, 599]))

    customers = ["a", "b", None]
    sales = [(i, rng.choice(customers), rng.choice([moment(), moment(), None])) for i in range(60)]
    signals = [
        (rng.choice(customers), rng.choice([moment(), moment(), moment(), None]),
         rng.choice([0.1234, 0.3, 0.5, 0.7, 0.99, None, float("nan")]),
         rng.choice([None, [], ["x"], ["y", "x", None], ["z", "z"]]))
        for _ in range(80)
    ]
    # A signal exactly 24 hours before a sale is outside, one at its time is inside.
    sales.append((98, "edge", START + timedelta(days=1)))
    sales.append((99, "edge", START + timedelta(days=3)))
    signals += [("edge", START, 0.9, ["out"]), ("edge", START + timedelta(days=3), 0.6, ["in"])]

    sale_frame = spark.createDataFrame(sales, "t bigint, c string, at timestamp")
    signal_frame = spark.createDataFrame(signals, "c string, at timestamp, s double, codes array<string>")
    scored = fraud_scored(
        raw_shaped(sale_frame, "pos_transactions", txn_id=F.col("t"), customer_id=F.col("c"), txn_ts=F.col("at")),
        raw_shaped(signal_frame, "fraud_signals", customer_id=F.col("c"), signal_ts=F.col("at"),
                   score=F.col("s"), reason_codes=F.col("codes")),
        slice_minutes=slice_minutes,
    )
    got = {r.txn_id: r for r in scored.collect()}
    expected = brute_force_scores(sales, signals, timedelta(hours=24))
    assert len(got) == len(sales)
    for txn, (score, codes) in expected.items():
        assert float(got[txn].fraud_score) == score and got[txn].signals == codes
        band = "high" if score >= 0.7 else "medium" if score >= 0.3 else "low"
        assert got[txn].risk_band == band


def brute_force_sessions(events, gap):
    """(visitor, given) -> sorted kept events -> session (start, end, count) per event time."""
    streams = {}
    for visitor, given_id, at in events:
        streams.setdefault((visitor, given_id), []).append(at)
    sessions = {}
    for (visitor, given_id), times in streams.items():
        times.sort()
        groups = [[times[0]]]
        for before, after in zip(times, times[1:]):
            if given_id is None and after - before > gap:
                groups.append([])
            groups[-1].append(after)
        for group in groups:
            for at in group:
                sessions[visitor, given_id, at] = (group[0], group[-1], len(group))
    return sessions


@pytest.mark.parametrize("seed, slice_minutes", [(1, 5), (2, 30), (3, 1)])
def test_sessions_match_brute_force(spark, seed, slice_minutes):
    rng = random.Random(seed)
    events, at = [], START
    for i in range(150):
        at += timedelta(seconds=rng.choice([1, 60, 299, 300, 1799, 1800, 1801, 4000]))
        events.append((rng.choice(["u1", "u2"]), rng.choice([None, None, "s1"]), at, f"e{i}"))
    frame = spark.createDataFrame(events, "u string, s string, at timestamp, e string")
    nothing = F.lit(None).cast("string")
    app = raw_shaped(
        frame, "mobile_events", event_id=F.col("e"), event_ts=F.col("at"), user_id=F.col("u"),
        context=F.struct(nothing.alias("ip"), nothing.alias("country"), F.col("s").alias("session_id"),
                         nothing.alias("referrer")),
    )
    web = spark.createDataFrame([], "event_ts string, ip string, url string, user_id string, city string, "
                                    "country string, state string, partition_ts timestamp")  # fmt: skip
    clicks = dedup_clickstream(web, app, slice_minutes=slice_minutes)
    check_schema(clicks, "dedup_clickstream")
    expected = brute_force_sessions([(u, s, t) for u, s, t, _ in events], timedelta(minutes=30))
    by_time = {t: (u, s) for u, s, t, _ in events}
    got = clicks.collect()
    assert len(got) == len(events)
    for row in got:
        user, given_id = by_time[row.event_ts]
        start, end, count = expected[user, given_id, row.event_ts]
        micros = int((start - datetime(1970, 1, 1)) / timedelta(microseconds=1))
        assert row.session_id == (given_id or f"{user}-{micros}")
        lasted = max(int((end - start) / timedelta(microseconds=1)), 60_000_000)
        assert row.bot_score == Decimal(count * 60_000_000 * 10**9 // lasted).scaleb(-9)


def test_clicks_without_visitor_or_time_are_kept(spark):
    web = spark.createDataFrame(
        [
            ("2024-01-30 05:00:00", None, "/a", None, START),
            ("2024-01-30 05:00:00", None, "/b", None, START),
            ("never", "1.1.1.1", "/a", None, START),
            ("2024-01-30 05:00:00", "1.1.1.1", "/a", None, START),
            ("2024-01-30 05:00:00", "1.1.1.1", "/a", None, START),
        ],
        "event_ts string, ip string, url string, user_id string, partition_ts timestamp",
    ).withColumn("country", F.lit("fr"))
    app = spark.createDataFrame([], RAW["mobile_events"].schema)
    got = dedup_clickstream(web, app).collect()
    unplaced = [r for r in got if r.ip is None or r.event_ts is None]
    assert len(got) == len(unplaced) + 1 and all(r.session_id is None and r.bot_score is None for r in unplaced)
    assert {r.event_date for r in got} == {START.date()} and {r.country_partition for r in got} == {"FR"}


def test_kpis(spark):
    hour = timedelta(hours=1)
    moves = rows_as(
        spark,
        "inventory_movements",
        [
            dict(warehouse_id="w", movement_type="IN", quantity=10, movement_ts=START),
            dict(warehouse_id="w", movement_type="OUT", quantity=4, movement_ts=START + 2 * hour),
            dict(warehouse_id="w", movement_type="COUNT", quantity=99, movement_ts=START),
        ],
    )
    picks = rows_as(
        spark,
        "warehouse_picks",
        [
            dict(warehouse_id="w", quantity=3, picked_at=START, duration_ms=1000),
            dict(warehouse_id="w", quantity=4, picked_at=START + hour / 2, duration_ms=2001),
            dict(warehouse_id="w", quantity=1, picked_at=START + hour, duration_ms=None),
        ],
    )
    figures = warehouse_kpi_snapshot(moves, picks)
    check_schema(figures, "warehouse_kpi_snapshot")
    got = [r for r in sorted(figures.collect(), key=lambda r: r.snapshot_ts)]
    assert [(r.units_in, r.units_picked, r.units_shipped, r.backlog_units) for r in got] == [
        (10, 7, 0, 7), (0, 1, 0, 8), (0, 0, 4, 4),
    ]
    assert [r.avg_pick_ms for r in got] == [1501, None, None]
    assert got[0].pick_rate_uph == Decimal("8397.2") and got[1].pick_rate_uph is None


def test_figures_of_single_hours_equal_those_of_the_day(spark):
    hour = timedelta(hours=1)
    picks = [dict(warehouse_id=w, quantity=q, picked_at=START + h * hour, duration_ms=d)
             for w, q, h, d in [("a", 3, 0, 10), ("a", -1, 1, 100_000_000), ("b", 5, 0, None), ("a", 2, 2, None), (None, 7, 1, 3)]]
    moves = [dict(warehouse_id="a", movement_type="OUT", quantity=4, movement_ts=START + h * hour) for h in (0, 2)]
    whole = warehouse_kpi_snapshot(rows_as(spark, "inventory_movements", moves), rows_as(spark, "warehouse_picks", picks))
    stepped, opening = [], None
    for h in range(3):
        own = [p for p in picks if p["picked_at"] == START + h * hour] or [dict(warehouse_id="none")]
        part = warehouse_kpi_snapshot(
            rows_as(spark, "inventory_movements", [m for m in moves if m["movement_ts"] == START + h * hour] or [dict(warehouse_id="none")]).where("warehouse_id <> 'none'"),
            rows_as(spark, "warehouse_picks", own).where("not warehouse_id <=> 'none'"),
            opening=opening,
        )
        stepped += part.collect()
        opening = closing_backlog(part, opening)
        opening = spark.createDataFrame(opening.collect(), opening.schema)
    assert sorted(map(str, stepped)) == sorted(map(str, whole.collect()))
    assert {r.warehouse_id: r.backlog_units for r in opening.collect()} == {"a": -4, "b": 5, None: 7}
    assert next(r for r in stepped if r.units_picked == -1).pick_rate_uph == Decimal("-0.04")


