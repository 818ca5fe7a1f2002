"""Records with nested structs and arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Header fields that travel with every line item, in output order.
INVOICE_HEADER = [
    "InvoiceNumber", "CreatedTime", "StoreID", "PosID", "CustomerType", "PaymentMethod", "DeliveryType",
    "DeliveryAddress.City", "DeliveryAddress.PinCode", "DeliveryAddress.State",
]


def explode_structs(df: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element, with its fields as columns after the kept ones.

    Rows whose array is null or empty drop out. ``keep`` may name struct fields, so a
    columnar scan reads just those.
    """
    item = "_item"
    exploded = df.select(*keep, F.explode(array).alias(item))
    return exploded.select(*[F.col(c) for c in exploded.columns if c != item], f"{item}.*")


def line_items(invoices: DataFrame) -> DataFrame:
    """Invoices as flat line items."""
    return explode_structs(invoices, "InvoiceLineItems", INVOICE_HEADER)


def expand(df: DataFrame, struct: str) -> DataFrame:
    """The fields of one struct column as the columns of the result."""
    return df.select(f"{struct}.*")
