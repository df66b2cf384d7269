"""Loads in steps, however cut, equal one load."""

import random
from glob import glob
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from harness.tables import raw_shaped
from millrace.operators import checks, layout
from millrace.plans.clickstream import clicks_of, clicks_state, dedup_clickstream
from millrace.plans.orders import cleansed_orders, orders_of, orders_state, unfit_orders, unfit_orders_of
from millrace.plans.products import cleansed_products, products_of, products_state
from millrace.plans.returns import fold_returns, read_returns, returns_state
from millrace.plans.warehouse import kpi_state, kpis_of, late_kpis, warehouse_kpi_snapshot, with_late
from millrace.session import written

WEB = "event_ts string, ip string, url string, user_id string, country string, partition_ts timestamp, load int"
APP = "event_id string, event_ts timestamp, user_id string, session string, ip string, load int"


def feeds(spark, rng, loads):
    start = datetime(2024, 1, 1)

    def moment():
        return start + timedelta(minutes=rng.choice([0, 7, 20, 31, 45, 70, 100, 131, 200, 300]), seconds=rng.choice([0, 0, 40, 2400]))

    web = [
        (moment().strftime("%Y-%m-%d %H:%M:%S") if rng.random() < 0.95 else "soon", rng.choice(["i", None]), rng.choice(["p", "q", None]),
         rng.choice(["u", "v", None]), rng.choice(["de", None]), start, rng.randrange(loads))
        for _ in range(120)
    ]
    app = [
        (rng.choice(["e", "f", "p", None]), moment() if rng.random() < 0.95 else None, rng.choice(["u", "v", None]),
         rng.choice([None, None, "s1"]), rng.choice(["i", None]), rng.randrange(loads))
        for _ in range(80)
    ]
    web, app = spark.createDataFrame(web, WEB), spark.createDataFrame(app, APP)
    none = F.lit(None).cast("string")
    context = F.struct(F.col("ip"), none.alias("country"), F.col("session").alias("session_id"), none.alias("referrer"))
    return web, app, context


def shaped_app(app, context):
    return raw_shaped(app, "mobile_events", event_id=F.col("event_id"), event_ts=F.col("event_ts"), user_id=F.col("user_id"), context=context)


def rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("seed,grain", [(1, "HOUR"), (2, None), (3, "DAY")])
def test_clicks_in_any_loads_equal_one(spark, seed, grain):
    loads = 3
    web, app, context = feeds(spark, random.Random(seed), loads)
    whole = dedup_clickstream(web, shaped_app(app, context), repeat_grain=grain)
    state = None
    for n in range(loads):
        mine = F.col("load") == n
        state = written(clicks_state(web.where(mine), shaped_app(app.where(mine), context), state, repeat_grain=grain), "test-clicks")
    assert rows(clicks_of(state)) == rows(whole)


def test_a_load_reaches_only_near_sessions(spark):
    """Of two visitors with two sessions each, a late event between the first two joins them; the other visitor's stay."""
    base = datetime(2024, 1, 1)
    app = [(f"e{n}", base + timedelta(minutes=m), u, None, None, 0) for n, (u, m) in enumerate([("u", 0), ("u", 50), ("u", 400), ("v", 0), ("v", 50)])]
    app = spark.createDataFrame([*app, ("late", base + timedelta(minutes=25), "u", None, None, 1)], APP)
    web = spark.createDataFrame([], WEB)
    none = F.lit(None).cast("string")
    context = F.struct(F.col("ip"), none.alias("country"), F.col("session").alias("session_id"), none.alias("referrer"))
    first = written(clicks_state(web, shaped_app(app.where("load = 0"), context)), "test-clicks")
    second = clicks_state(web, shaped_app(app.where("load = 1"), context), first)
    sizes = sorted((r["_visitor"], r["session_events"]) for r in second.select("_visitor", "session_start", "session_events").distinct().collect())
    assert sizes == [("u", 1), ("u", 3), ("v", 1), ("v", 1)]


TILLS = "txn_id bigint, customer_id string, invoice_no string, txn_ts timestamp, line_count bigint, gross_amount decimal(38,9), load int"
LINES = "invoice_no string, customer_id string, quantity bigint, invoice_date string, unit_price decimal(38,9), load int"


def test_orders_in_any_loads_equal_one(spark):
    """Invoices and till records cut by load, with amounts whose parts overflow while their sum does not."""
    rng = random.Random(5)
    huge = Decimal(10) ** 28 * 9
    start = datetime(2024, 1, 1)
    tills = [(rng.choice([1, 2, 3, None]), rng.choice("ab"), "i", start + timedelta(hours=rng.randrange(4)), 1, Decimal(rng.randrange(9)), rng.randrange(3)) for _ in range(60)]
    lines = [(rng.choice(["x", "y", None]), rng.choice("ab"), rng.choice([1, 3, None]), "2024-01-01 00:00:00", Decimal(rng.randrange(999)) / 100, rng.randrange(3)) for _ in range(150)]
    lines += [("big", "a", 1, None, sign * huge, load) for sign, load in [(1, 0), (1, 0), (1, 1), (-1, 1), (-1, 2), (-1, 2)]]
    lines += [("big", "a", 1, None, Decimal("0.000000007"), 2), ("over", "a", 1, None, huge, 0), ("over", "a", 1, None, huge, 2), ("unfit", "a", 99, None, huge, 1), ("unfit", "a", 1, None, Decimal(1), 2)]
    tills, lines = spark.createDataFrame(tills, TILLS), spark.createDataFrame(lines, LINES)

    def shaped(mine):
        one = raw_shaped(tills.where(mine), "pos_transactions", **{c: F.col(c) for c in tills.columns if c != "load"})
        two = raw_shaped(lines.where(mine), "sales_retail", **{c: F.col(c) for c in lines.columns if c != "load"})
        return one, two

    whole = cleansed_orders(*shaped(F.lit(True)))
    state = None
    for n in range(3):
        state = written(orders_state(*shaped(F.col("load") == n), state), "test-orders")
    assert rows(orders_of(state)) == rows(whole)
    amounts = {r["order_id"]: r["gross_amount"] for r in orders_of(state).where("source_feed = 'retail'").collect()}
    assert amounts["big"] == Decimal("0.000000007") and amounts["over"] is None and amounts["unfit"] is None
    assert rows(unfit_orders_of(state)) == rows(unfit_orders(*shaped(F.lit(True))))
    assert unfit_orders_of(state).count() == 2


CHANGES = "return_id bigint, return_ts timestamp, status string, op string, snapshot_date date"


def changes(spark, rng, ids, days):
    made = [(rng.choice(ids), datetime(2024, 1, 1) + timedelta(hours=rng.randrange(200)), rng.choice("xyz"), rng.choice("IUD"), date(2024, 1, rng.choice(days))) for _ in range(200)]
    frame = spark.createDataFrame([*made, (None, None, "lost", "U", date(2024, 1, 1))], CHANGES)
    return raw_shaped(frame, "returns_cdc", **{c: F.col(c) for c in frame.columns})


def test_only_buckets_with_changes_are_rewritten(spark, table_path):
    rng = random.Random(8)
    loads = [changes(spark, rng, range(500), [1, 2, 3]), changes(spark, rng, [3, 4], [2]), changes(spark, rng, [900], [1, 9])]
    names, rewritten = [], []
    for load in loads:
        rewritten.append(fold_returns(load, table_path, 16))
        names.append({f for f in glob(f"{table_path}/*/part-*")})
    state = returns_state(loads[0].unionByName(loads[1]).unionByName(loads[2]))
    assert rows(read_returns(spark, table_path).drop("_bucket")) == rows(state)
    assert len(rewritten[0]) == 16 and len(rewritten[1]) <= 2 and len(rewritten[2]) == 1
    for before, after, touched in zip(names, names[1:], rewritten[1:], strict=False):
        assert {f for f in before if f.split("/")[-2] not in touched} <= after
        assert not {f for f in before if f.split("/")[-2] in touched} & after
    with pytest.raises(ValueError, match="another number"):
        fold_returns(loads[1], table_path, 8)


def test_empty_state(spark, table_path):
    assert read_returns(spark, table_path).count() == 0
    assert fold_returns(changes(spark, random.Random(1), [1], [1]).limit(0), table_path) == []


@pytest.mark.parametrize("stop", [1, 2, 3, 4])
def test_a_load_that_stops_while_folders_are_swapped_loses_nothing(spark, table_path, monkeypatch, stop):
    def frame(text):
        return spark.createDataFrame([(f"{text}{i}", str(i % 2)) for i in range(20)], "v string, k string")

    layout.replace_folders(frame("old"), table_path, ["k"], [])
    moves, move = [], layout._move

    def stopping(files, source, target):
        moves.append(target)
        if len(moves) == stop:
            raise OSError("the driver died")
        move(files, source, target)

    monkeypatch.setattr(layout, "_move", stopping)
    with pytest.raises(OSError, match="died"):
        layout.replace_folders(frame("new"), table_path, ["k"], ["k=gone"])
    monkeypatch.setattr(layout, "_move", move)
    layout.finish_loads(spark, table_path)
    assert rows(spark.read.schema("v string, k string").parquet(table_path)) == rows(frame("new"))
    assert not glob(f"{table_path}/_loading-*")


def test_a_load_that_stops_while_writing_changes_nothing(spark, table_path):
    good = spark.createDataFrame([("a", "1")], "v string, k string")
    layout.replace_folders(good, table_path, ["k"], [])
    good.write.partitionBy("k").parquet(f"{table_path}/_loading-half")
    layout.replace_folders(spark.createDataFrame([("b", "2")], "v string, k string"), table_path, ["k"], [])
    assert rows(spark.read.schema("v string, k string").parquet(table_path)) == ["Row(v='a', k='1')", "Row(v='b', k='2')"]


def test_differences_shuffle_only_damaged_buckets(spark):
    """Of 20,000 rows, 12 differ: the buckets to compare hold few rows, and the result is that of the whole comparison."""
    kind = F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string"))
    source = spark.range(20_000).select("id", kind.alias("k"), F.lit(None).cast("string").alias("none"), F.array(F.col("id")).alias("a"))
    damage = F.col("id") % 5000
    target = source.where(damage != 7).withColumn("none", F.when(damage == 9, "x")).unionByName(source.where(damage == 11))
    apart = checks.differing_buckets(source, target, "k", 1024)
    assert 0 < apart.count() <= 16
    found = checks.row_differences_pruned(source, target, "k")
    assert rows(found) == rows(checks.row_differences(source, target))
    assert found.count() == 16
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    assert checks.row_differences_pruned(source, source, "k").count() == 0
    few, checks.FEW = checks.FEW, 3
    try:
        assert rows(checks.row_differences_pruned(source, target, "k")) == rows(found)
    finally:
        checks.FEW = few


MOVES = "warehouse_id string, movement_type string, quantity bigint, at timestamp, load int"


def warehouse(spark, rng, count):
    def at():
        return None if rng.random() < 0.05 else datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(3000))

    rows_of = [(rng.choice(["w", "x", None]), rng.choice(["IN", "OUT", "pick", "pick"]), rng.randrange(1, 9), at(), rng.randrange(4)) for _ in range(count)]
    frame = spark.createDataFrame(rows_of, MOVES)

    def feeds(mine):
        moves, picks = frame.where(mine & (F.col("movement_type") != "pick")), frame.where(mine & (F.col("movement_type") == "pick"))
        duration = F.when(F.col("quantity") % 3 > 0, F.col("quantity") * 1000)
        return (
            raw_shaped(moves, "inventory_movements", movement_ts=F.col("at"), **{c: F.col(c) for c in ("warehouse_id", "movement_type", "quantity")}),
            raw_shaped(picks, "warehouse_picks", picked_at=F.col("at"), duration_ms=duration, **{c: F.col(c) for c in ("warehouse_id", "quantity")}),
        )

    return feeds


@pytest.mark.parametrize("seed", [1, 2])
def test_movements_in_any_loads_equal_one(spark, seed):
    feeds = warehouse(spark, random.Random(seed), 150)
    state = written(kpi_state(*feeds(F.col("load") == 0)), "test-kpi")
    for n in (1, 2, 3):
        late = written(late_kpis(state, *feeds(F.col("load") == n)), "test-kpi")
        state = written(with_late(state, late), "test-kpi")
    assert rows(kpis_of(state)) == rows(warehouse_kpi_snapshot(*feeds(F.lit(True))))


def test_late_movements_change_only_later_hours_of_their_warehouse(spark):
    start = datetime(2024, 1, 1)
    made = [(w, "OUT", 5, start + timedelta(hours=h), 0) for w in "wx" for h in range(0, 48, 4)]
    made += [("w", "OUT", 2, start + timedelta(hours=30), 1), ("x", "IN", 3, start + timedelta(hours=9), 1)]
    frame = spark.createDataFrame(made, MOVES)
    none = raw_shaped(frame.where("false"), "warehouse_picks")

    def moves(load):
        return raw_shaped(frame.where(F.col("load") == load), "inventory_movements", movement_ts=F.col("at"), **{c: F.col(c) for c in ("warehouse_id", "movement_type", "quantity")})

    late = late_kpis(kpi_state(moves(0), none), moves(1), none).collect()
    hours = {(r["warehouse_id"], int((r["snapshot_ts"] - start).total_seconds() // 3600)): r["backlog_units"] for r in late}
    assert hours == {("w", 30): -42, ("w", 32): -47, ("w", 36): -52, ("w", 40): -57, ("w", 44): -62, ("x", 9): -15}


def test_products_in_any_loads_equal_one(spark):
    rng = random.Random(9)
    made = [(rng.choice(["a", "b", "c", None]), rng.choice("uv"), rng.choice(["N", None]), date(2024, 1, rng.randrange(1, 5)), rng.randrange(3)) for _ in range(60)]
    frame = spark.createDataFrame(made, "sku string, upc string, name string, feed_date date, load int")
    feed = raw_shaped(frame, "product_catalog_feed", **{c: F.col(c) for c in ("sku", "upc", "name", "feed_date")})
    part = [raw_shaped(frame.where(F.col("load") == n), "product_catalog_feed", **{c: F.col(c) for c in ("sku", "upc", "name", "feed_date")}) for n in range(3)]
    state = None
    for own in part:
        state = written(products_state(own, state), "test-products")
    assert rows(products_of(state, date(2024, 1, 4))) == rows(cleansed_products(feed, date(2024, 1, 4)))
