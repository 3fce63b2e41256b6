"""Operational data store: daily order totals, item migration, back-fill and invoice documents."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.functions import on_days, with_scalars
from tidewright.operators import nest_by, number_rows
from tidewright.sources import PartitionedTable, Scratch


def order_totals(orders: DataFrame, lines: DataFrame, first: dt.date, last: dt.date | None = None) -> DataFrame:
    """Orders placed on the given days with their quantity; orders without lines are left out."""
    placed = orders.filter(on_days("o_orderdate", first, last)).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("OrderDate")
    )
    joined = lines.select("l_orderkey", "l_quantity").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderkey", "OrderDate", "o_custkey").agg(F.sum("l_quantity").alias("total")).select(
        F.col("o_orderkey").alias("OrderId"),
        F.col("total").cast("bigint").alias("OrderTotal"),
        F.col("o_custkey").alias("CustomerId"),
        "OrderDate",
    )


def ods_orders(spark, path: str) -> PartitionedTable:
    return PartitionedTable(spark, path, schemas.ODS_ORDERS, ["OrderDate"])


def load_day(orders: DataFrame, lines: DataFrame, ods: PartitionedTable, day: dt.date) -> None:
    """Add the order totals of one day; raise before writing anything if the day is there already."""
    if not ods.read().filter(F.col("OrderDate") == F.lit(day)).isEmpty():
        raise ValueError(f"orders of {day} are already loaded")
    ods.replace(order_totals(orders, lines, day))


def reload_week(orders: DataFrame, lines: DataFrame, ods: PartitionedTable, day: dt.date, days: int = 7) -> None:
    """Remove everything up to `day`, then load `day` and the `days` days after it.

    Later rows stay. An order of the window that is already there is replaced, so a rerun is harmless. Only the
    days of the window are written, and later days on which an order of the window stood before.
    """
    last = day + dt.timedelta(days=days)
    with Scratch(ods.spark, "week") as scratch:
        window = scratch.cut(order_totals(orders, lines, day, last))
        stored = ods.read()
        own = window.select("OrderId")
        moved = stored.filter(F.col("OrderDate") > F.lit(last)).join(own, "OrderId", "left_semi").select("OrderDate")
        dates = [row["OrderDate"] for row in moved.distinct().collect()]  # the calendar bounds them
        touched = F.col("OrderDate").between(F.lit(day + dt.timedelta(days=1)), F.lit(last))
        if dates:
            touched = touched | F.col("OrderDate").isin(dates)
        kept = stored.filter(touched).join(own, "OrderId", "left_anti")
        emptied = {name for name in ods.partitions() if name <= f"OrderDate={day}"} | {f"OrderDate={date}" for date in dates}
        ods.replace(kept.unionByName(window), emptied)


def migrate_items(items: DataFrame, json_column: str, attributes: dict[str, str]) -> DataFrame:
    """All rows with attributes of a JSON column as columns of their own; a missing one is NULL. The column is parsed
    once, whatever the number of attributes."""
    return with_scalars(items, json_column, {name: f'$."{key}"' for name, key in attributes.items()}).drop(json_column)


def shred_purchase_orders(documents: DataFrame, column: str, *keep: str) -> DataFrame:
    """First purchase order of each document as a typed row; a value of the wrong form becomes NULL."""
    parsed = F.from_json(F.col(column), schemas.PURCHASE_ORDER_DOCUMENT)
    first = documents.select(*keep, F.try_element_at(parsed["PurchaseOrders"], F.lit(1)).alias("po"))
    typed = [F.col("po")[key].try_cast(kind).alias(name) for name, key, kind in schemas.PURCHASE_ORDER_FIELDS]
    return first.select(*keep, *typed)


def backfill(missed: DataFrame, order_by: list[str], highest_item: int) -> tuple[DataFrame, DataFrame]:
    """New stock items, numbered on from the highest id, and new purchase orders.

    Order lines are not filled: the documents hold none.
    """
    numbered = number_rows(missed, order_by, "StockItemID", start=highest_item + 1)
    country = F.col("CountryOfManufacture")
    items = numbered.select(
        "StockItemID",
        "StockItemName",
        "SupplierID",
        "UnitPackageID",
        "OuterPackageID",
        "Brand",
        "LeadTimeDays",
        F.lit(0).alias("IsChillerStock"),
        "QuantityPerOuter",
        "TaxRate",
        "UnitPrice",
        "RecommendedRetailPrice",
        "TypicalWeightPerUnit",
        F.when(country.isNotNull(), F.to_json(F.struct(country))).alias("CustomFields"),
        F.lit(0).alias("LastEditedBy"),
    )
    purchase_orders = numbered.select(
        "SupplierID",
        "OrderDate",
        F.lit(0).alias("DeliveryMethodID"),
        F.lit(0).alias("ContactPersonID"),
        "ExpectedDeliveryDate",
        "SupplierReference",
        F.lit(1).alias("IsOrderFinalized"),
        F.lit(1).alias("LastEditedBy"),
    )
    return items, purchase_orders


def invoice_documents(
    orders: DataFrame, lines: DataFrame, order_columns: list[str], line_columns: list[str]
) -> DataFrame:
    """Per order date the JSON array of its orders with their lines, in pieces: (OrderDate, seq, text)."""
    dated = orders.withColumn("_date", F.to_date("o_orderdate"))
    return nest_by(
        dated, lines, "o_orderkey", "l_orderkey", "_date", order_columns, line_columns, "lines"
    ).withColumnRenamed("_date", "OrderDate")


def customer_documents(
    orders: DataFrame, lines: DataFrame, customer: int, order_columns: list[str], line_columns: list[str]
) -> DataFrame:
    """The document of each date on which one customer ordered, once per order of that customer.

    Set-based form of a loop over the customer's orders: each order adds the document of its date again,
    under the next id; documents come in pieces, ordered by `seq`. Ids count up by date. They come from a running total over the distinct dates,
    which the calendar bounds.
    """
    day = F.to_date("o_orderdate")
    own = orders.filter((F.col("o_custkey") == customer) & day.isNotNull())
    dates = own.groupBy(day.alias("InvoiceDate")).agg(F.count("*").alias("times"))
    before = W.orderBy("InvoiceDate").rowsBetween(W.unboundedPreceding, -1)
    dates = dates.withColumn("_before", F.coalesce(F.sum("times").over(before), F.lit(0)))
    # A filter, not a join: nesting tells equal rows apart by their place in the files.
    same_days = orders.filter(day.isin([row["InvoiceDate"] for row in dates.select("InvoiceDate").collect()]))
    documents = invoice_documents(same_days, lines, order_columns, line_columns)
    placed = documents.join(dates, F.col("OrderDate") == F.col("InvoiceDate"))
    return _repeat(placed, "times", "_copy").select(
        (F.col("_before") + F.col("_copy")).alias("ID"),
        "InvoiceDate",
        "seq",
        F.col("text").alias("InvoiceValue"),
    )


def _repeat(df: DataFrame, times: str, number: str, block=1_000) -> DataFrame:
    """Each row `times` times, numbered from 1, in blocks so that one row never grows into one huge array."""
    blocks = df.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times), F.lit(block).cast("bigint"))))
    upto = F.least(F.col(times), F.col("_from") + (block - 1))
    return blocks.withColumn(number, F.explode(F.sequence(F.col("_from"), upto))).drop("_from")
