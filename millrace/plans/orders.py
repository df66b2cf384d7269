"""Store tills and the retail export merged into one order table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.contracts import STAGING
from millrace.functions.keys import parse_timestamp
from millrace.functions.numbers import billionths, with_decimal
from millrace.functions.types import NUMERIC
from millrace.operators.latest import latest_per_key

INVOICE_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", "M/d/yyyy H:mm", "yyyy-MM-dd")


#: Amounts are summed as a high and a low part of this size, so that no sum of parts can overflow.
PART = 10**20

#: Columns of an order that a till record gives.
TILL = ["order_id", "customer_id", "invoice_no", "txn_ts", "line_count", "gross_amount", "discount", "tax", "tender_type"]
#: Sums over the lines of an invoice.
SUMS = ["high", "low", "unfit", "given"]


def cleansed_orders(
    pos_transactions: DataFrame,
    sales_retail: DataFrame,
    invoice_date_formats: tuple[str, ...] = INVOICE_DATE_FORMATS,
) -> DataFrame:
    """One row per order of each feed: till records as they are, retail lines summed by invoice.

    A till record sent more than once counts with its latest version. Till records without a
    number and lines without an invoice are orders of their own. Amounts are exact to nine decimals;
    one that does not fit is NULL, and ``unfit_orders`` lists its row.
    """
    return orders_of(orders_state(pos_transactions, sales_retail, None, invoice_date_formats))


def orders_state(
    pos_transactions: DataFrame,
    sales_retail: DataFrame,
    previous: DataFrame | None = None,
    invoice_date_formats: tuple[str, ...] = INVOICE_DATE_FORMATS,
) -> DataFrame:
    """The newest till record of each number and the sums of each invoice, after a load that follows the
    ``previous`` state.

    The declared table holds rounded amounts, so this state is kept beside it: an invoice that comes in
    several drops is the sum of all its lines, whichever drop they come in. Both feeds are reduced to one
    row per order before they meet the state.
    """
    tills, invoices = _from_tills(pos_transactions), _invoices(_lines(sales_retail, invoice_date_formats))
    if previous is not None:
        old = previous.where("source_feed = 'pos'").select(*TILL)
        tills = _newest(tills.unionByName(old))
        sums = previous.where("source_feed = 'retail'").select("invoice_no", "customer_id", "txn_ts", "line_count", *SUMS)
        invoices = _invoices(invoices.unionByName(sums))
    tills = tills.withColumn("source_feed", F.lit("pos"))
    invoices = invoices.withColumn("source_feed", F.lit("retail"))
    return tills.unionByName(invoices, allowMissingColumns=True)


def orders_of(state: DataFrame) -> DataFrame:
    """The declared table of a state."""
    return _orders(state).select(*STAGING["cleansed_orders"].names)


def unfit_orders(
    pos_transactions: DataFrame,
    sales_retail: DataFrame,
    invoice_date_formats: tuple[str, ...] = INVOICE_DATE_FORMATS,
) -> DataFrame:
    """Orders with an amount that DECIMAL(38,9) cannot hold, in the form of the quarantine."""
    return unfit_orders_of(orders_state(pos_transactions, sales_retail, None, invoice_date_formats))


def unfit_orders_of(state: DataFrame) -> DataFrame:
    """The orders of a state that ``unfit_orders`` lists."""
    contract = STAGING["cleansed_orders"]
    return _orders(state).where(F.size("_failed") > 0).select(
        F.lit(contract.table).alias("table_name"),
        F.col("_failed").alias("failed_columns"),
        F.to_json(F.struct(*contract.names)).alias("original"),
    )


def _orders(state: DataFrame) -> DataFrame:
    retail = F.col("source_feed") == "retail"
    # A line that does not fit leaves its invoice without an amount.
    total = F.when((F.col("unfit") == 0) & (F.col("given") > 0), F.col("_total"))
    zero = F.lit(0).cast("decimal(38,0)")
    both = with_decimal(_with_total(state), "_gross", total).withColumns(
        {
            "order_id": F.when(retail, F.col("invoice_no")).otherwise(F.col("order_id")),
            "gross_amount": F.when(retail, F.col("_gross")).otherwise(F.col("gross_amount")),
            "discount": F.when(retail, F.lit(0).cast(NUMERIC)).otherwise(F.col("discount")),
            "tax": F.when(retail, F.lit(0).cast(NUMERIC)).otherwise(F.col("tax")),
        }
    )
    discount, tax = (F.coalesce(billionths(F.col(c)), zero) for c in ("discount", "tax"))
    less = F.try_subtract(billionths(F.col("gross_amount")), discount).cast("decimal(38,0)")
    net = F.try_add(less, tax).cast("decimal(38,0)")
    orders = with_decimal(both, "net_amount", net).withColumn("order_date", F.to_date("txn_ts"))
    gross_lost = retail & (F.col("unfit") + F.col("given") > 0) & F.col("gross_amount").isNull()
    net_lost = F.col("gross_amount").isNotNull() & F.col("net_amount").isNull()
    failed = F.array_compact(F.array(F.when(gross_lost, "gross_amount"), F.when(net_lost, "net_amount")))
    # The number, which is always given, keeps filters on the list above these steps: below them they would
    # compute all amounts once more, in nested expressions.
    return orders.withColumn("_failed", F.when(F.monotonically_increasing_id() >= 0, failed))


def _own_number(key: str) -> Column:
    """For a row without a key a number that only has to differ from those of all others, so that one scan
    and one reduction serve the rows with and without a key."""
    return F.when(F.col(key).isNull(), F.monotonically_increasing_id())


def _newest(tills: DataFrame) -> DataFrame:
    numbered = tills.withColumn("_own", _own_number("order_id"))
    return latest_per_key(numbered, ["order_id", "_own"], ["txn_ts"]).drop("_own")


def _from_tills(pos_transactions: DataFrame) -> DataFrame:
    return _newest(
        pos_transactions.select(
            F.col("txn_id").cast("string").alias("order_id"),
            "customer_id",
            "invoice_no",
            "txn_ts",
            "line_count",
            "gross_amount",
            F.col("discount_amount").alias("discount"),
            F.col("tax_amount").alias("tax"),
            "tender_type",
        )
    )


def _lines(sales_retail: DataFrame, formats: tuple[str, ...]) -> DataFrame:
    """Retail lines as invoices of one line."""
    amount = _line_amount(F.col("quantity"), F.col("unit_price"))
    present = F.col("quantity").isNotNull() & F.col("unit_price").isNotNull()
    lines = sales_retail.select(
        "invoice_no",
        "customer_id",
        parse_timestamp(F.col("invoice_date"), formats).alias("txn_ts"),
        F.lit(1).cast("bigint").alias("line_count"),
        amount.alias("_amount"),
        present.alias("_present"),
    )
    part = F.lit(str(PART)).cast("decimal(21,0)")
    # Nearly all amounts are one part, and need no division.
    small = F.abs("_amount") < part
    high = F.when(small, F.lit(0)).otherwise(F.call_function("div", F.col("_amount"), part)).cast("decimal(38,0)")
    low = F.when(small, F.col("_amount")).otherwise((F.col("_amount") % part).cast("decimal(38,0)"))
    return lines.select(
        "invoice_no",
        "customer_id",
        "txn_ts",
        "line_count",
        high.alias("high"),
        low.alias("low"),
        (F.col("_present") & F.col("_amount").isNull()).cast("bigint").alias("unfit"),
        F.col("_amount").isNotNull().cast("bigint").alias("given"),
    )


def _invoices(lines: DataFrame) -> DataFrame:
    """Lines or sums of lines summed by invoice; those without an invoice stay as they are."""
    zero = F.lit(0).cast("decimal(38,0)")
    numbered = lines.withColumn("_own", _own_number("invoice_no"))
    return (
        numbered.groupBy("invoice_no", "_own")
        .agg(
            F.max("customer_id").alias("customer_id"),
            F.max("txn_ts").alias("txn_ts"),
            F.sum("line_count").alias("line_count"),
            *[F.coalesce(F.sum(c), zero).cast("decimal(38,0)").alias(c) for c in ("high", "low")],
            *[F.sum(c).alias(c) for c in ("unfit", "given")],
        )
        .drop("_own")
    )


def _with_total(sums: DataFrame) -> DataFrame:
    """The sum of both parts as ``_total``, NULL where it does not fit 38 digits.

    The low sum is carried first and both parts are brought to one sign, so that nothing on the way is
    larger than the sum. Steps are columns, so that each is computed once a row.
    """
    part = F.lit(str(PART)).cast("decimal(21,0)")
    high, low, carried, rest, borrowed = (F.col(c) for c in ("high", "low", "_carried", "_rest", "_borrowed"))
    sums = sums.withColumns(
        {"_carried": (high + F.call_function("div", low, part).cast("decimal(38,0)")).cast("decimal(38,0)"), "_rest": low % part}
    )
    borrow = F.when((carried > 0) & (rest < 0), 1).when((carried < 0) & (rest > 0), -1).otherwise(0)
    sums = sums.withColumn("_borrowed", borrow.cast("decimal(1,0)"))
    above = F.try_multiply((carried - borrowed).cast("decimal(38,0)"), part).cast("decimal(38,0)")
    total = F.try_add(above, (rest + borrowed * part).cast("decimal(38,0)")).cast("decimal(38,0)")
    return sums.withColumn("_total", total).drop("_carried", "_rest", "_borrowed")


def _line_amount(quantity: Column, unit_price: Column) -> Column:
    """Billionths of quantity times price, NULL where they do not fit 38 digits."""
    return F.try_multiply(billionths(unit_price), quantity.cast("decimal(20,0)")).cast("decimal(38,0)")
