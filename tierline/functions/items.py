"""Order items held as JSON text: element parsing, field casts, and the in-row item total.

The raw ``items`` column is a JSON array of objects.  A bare object, malformed text or NULL
yields no items (like an inner lateral UNNEST), so such an order has no calculated total.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.functions.columns import as_col

# Element fields are read as strings so that both ``2`` and ``"2"`` are accepted, then cast.
ITEM_TEXT_SCHEMA = "struct<product_id:string,product_name:string,quantity:string,unit_price:string>"
MONEY = "decimal(18,2)"
SUM_MONEY = "decimal(38,2)"


def item_elements(items: str | Column) -> Column:
    """JSON text → ``array<string>`` of element texts; non-arrays and bad text give NULL."""
    return F.from_json(as_col(items), "array<string>")


def to_int_lax(text: Column) -> Column:
    """Text → INT the way a SQL engine casts VARCHAR to INTEGER: numeric text is rounded
    half-up (``'2.5'`` → 3); anything non-numeric is NULL instead of an error."""
    return F.round(text.try_cast("decimal(38,6)"), 0).try_cast("int")


def typed_item_fields(raw: Column) -> Column:
    """Text-field item struct → struct(product_id, product_name, quantity INT, unit_price DECIMAL)."""
    return F.struct(
        raw["product_id"].alias("product_id"),
        raw["product_name"].alias("product_name"),
        to_int_lax(raw["quantity"]).alias("quantity"),
        raw["unit_price"].try_cast(MONEY).alias("unit_price"),
    )


def raw_items(items: str | Column) -> Column:
    """``array<struct<product_id, product_name, quantity, unit_price>>`` with text fields;
    NULL when ``items`` is not a JSON array.

    Fast path: one parse of the whole array into structs.  That parse wraps a bare object
    into a one-element array and gives NULL for an array holding a non-object element, so it
    is only taken for text that opens with ``[``; when it fails on such text, the elements
    are parsed one by one (the slow path keeps every object element of a mixed array).
    """
    text = as_col(items)
    is_array_text = F.regexp_like(text, F.lit(r"^[ \t\r\n]*\["))
    fast = F.from_json(text, f"array<{ITEM_TEXT_SCHEMA}>")
    slow = F.transform(item_elements(text), lambda e: F.from_json(e, ITEM_TEXT_SCHEMA))
    return F.when(is_array_text, F.coalesce(fast, slow))


def item_total(items: str | Column) -> Column:
    """SUM(quantity * unit_price) over an order's items, computed inside the row.

    Equivalent to exploding the items and grouping by order id, without the explode or the
    shuffle: products with a NULL factor are skipped (as SUM skips NULLs) and an order with no
    non-NULL product gets NULL (as a missing group would after a LEFT JOIN).
    """
    return total_of_raw(raw_items(items))


def total_of_raw(raw: Column) -> Column:
    """``item_total`` over an already parsed ``raw_items`` array: one fold, the accumulator
    starts NULL and ``coalesce(acc + p, acc, p)`` skips NULL products."""
    def product(r: Column) -> Column:
        return to_int_lax(r["quantity"]) * r["unit_price"].try_cast(MONEY)

    return F.aggregate(
        raw,
        F.lit(None).cast(SUM_MONEY),
        lambda acc, r: F.coalesce(acc + product(r), acc, product(r)).cast(SUM_MONEY),
    )
