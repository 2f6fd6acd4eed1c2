"""Record validation as column expressions over a once-parsed Variant message.

A message value is parsed a single time with ``try_parse_json``.  The validator then works
in staged projections so that nothing is computed twice per row:

1. ``with_fields`` — each top-level field pulled out of the Variant once (``_f_<name>``);
2. ``with_kinds``  — the JSON kind of each field (``_t_<name>``: STRING, BIGINT, DECIMAL(p,s),
   DOUBLE, BOOLEAN, OBJECT<..>, ARRAY<..>, VOID for an explicit ``null``, NULL if missing);
3. ``with_times``  — time fields parsed once (``_ts_<name>``);
4. ``with_items``  — for orders: a native fast path (merged schema + one typed cast of the
   items array) and, only for orders that miss it, the element-by-element path;
5. ``computed_once`` — rules and typed record columns, produced by a one-row generator so
   that a validity filter above cannot be pushed down and re-inline the stages.

Projections whose outputs are used more than once are not merged by the optimizer, so the
Variant lookups stay single.  The result per message is an ``errors array<string>`` (empty =
valid) plus the typed, defaulted record fields.

Rules (the per-record model of the reference, restated):

* events — ``event_type`` one of the five known types; ``user_id``, ``session_id``, ``page``
  required strings; ``referrer`` optional string; ``metadata`` an object (missing → ``{}``);
  ``timestamp`` an ISO date/datetime (zoned → UTC) or epoch seconds / milliseconds (missing →
  the broker timestamp); ``event_id`` a string (missing → an id derived from topic,
  partition and offset, so a redelivery keeps its id).
* orders — ``user_id`` required string; ``items`` an array (may be empty) of objects with
  string ``product_id`` / ``product_name``, integer ``quantity > 0`` and number
  ``unit_price > 0``; ``total_amount`` a number ``> 0``; ``currency`` / ``status`` strings
  (missing → ``USD`` / ``pending``); ``shipping_address`` optional string; ``created_at`` as
  ``timestamp``.
* numbers are lax: numeric strings are accepted, an integer field accepts ``2.0`` but not
  ``2.5``; a string field does not accept a number; an explicit ``null`` is only accepted by
  the optional fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import EVENT_TYPES

# Fixed values that must equal the reference's record defaults.
DEFAULT_CURRENCY = "USD"
DEFAULT_STATUS = "pending"
# Epoch numbers above this magnitude are milliseconds, below it seconds.
EPOCH_MS_THRESHOLD = 20_000_000_000

EVENT_FIELDS = ("event_id", "event_type", "user_id", "session_id", "page", "referrer", "metadata", "timestamp")
ORDER_FIELDS = ("order_id", "user_id", "items", "total_amount", "currency", "status", "shipping_address",
                "created_at")
ITEM_FIELDS = ("product_id", "product_name", "quantity", "unit_price")
_NUMBER_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
NUMBER_TEXT = r"^[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}($|[T ])"
INTEGER = "decimal(38,0)"


def parse_value(value: Column) -> Column:
    """Message text → Variant; NULL when the value is NULL or not JSON."""
    return F.try_parse_json(value)


def looks_like_object(value: Column) -> Column:
    """Text starts with ``{`` after JSON whitespace (with a successful parse: a JSON object).
    Cheaper than typing the whole Variant, which walks every nested field."""
    return F.regexp_like(value, F.lit(r"^[ \t\r\n]*\{"))


# ---------------------------------------------------------------- staged extraction

def f(name: str) -> Column:
    return F.col(f"_f_{name}")


def t(name: str) -> Column:
    return F.col(f"_t_{name}")


def with_fields(df: DataFrame, v: str, names: Sequence[str]) -> DataFrame:
    """Stage 1: pull each named field out of Variant column ``v`` once."""
    return df.select("*", *[F.variant_get(F.col(v), f"$.{n}", "variant").alias(f"_f_{n}") for n in names])


def with_kinds(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Stage 2: the JSON kind of each extracted field."""
    return df.select("*", *[F.schema_of_variant(f(n)).alias(f"_t_{n}") for n in names])


# ---------------------------------------------------------------- kinds and lax values

def k_string(k: Column) -> Column:
    return k == F.lit("STRING")


def k_object(k: Column) -> Column:
    return k.startswith("OBJECT")


def k_null(k: Column) -> Column:
    return k == F.lit("VOID")


def k_number(k: Column) -> Column:
    return k.isin(*_NUMBER_KINDS) | k.startswith("DECIMAL")


def as_string(x: Column, k: Column) -> Column:
    return F.when(k_string(k), F.try_variant_get(x, "$", "string"))


def number_text(x: Column) -> Column:
    """Trimmed text when it is a JSON-like number or one of the words for infinity and not a
    number; NULL otherwise (Spark's own cast would also take ``5d`` or ``5f``)."""
    text = F.trim(F.try_variant_get(x, "$", "string"))
    return F.when(F.regexp_like(text, F.lit(NUMBER_TEXT)), text)


def as_number(x: Column, k: Column) -> Column:
    """Lax number of an epoch: JSON number or numeric string → DECIMAL(38,10)."""
    return (F.when(k_number(k), F.try_variant_get(x, "$", "decimal(38,10)"))
            .when(k_string(k), number_text(x).try_cast("decimal(38,10)")))


def as_double(x: Column, k: Column) -> Column:
    return (F.when(k_number(k), F.try_variant_get(x, "$", "double"))
            .when(k_string(k), number_text(x).try_cast("double")))


def as_int(x: Column, k: Column) -> Column:
    """Lax integer of up to 38 digits: integral number or integral numeric string (``2.0`` ok,
    ``2.5`` and ``2.00000000001`` NULL)."""
    d = as_double(x, k)
    return F.when(d == F.rint(d), F.when(k_number(k), F.try_variant_get(x, "$", INTEGER))
                  .otherwise(number_text(x).try_cast(INTEGER)))


def as_timestamp(x: Column, k: Column) -> Column:
    """ISO date / datetime text (zoned text shifted to UTC) or epoch s/ms, as number or numeric
    text → naive UTC.  Text without a date is no time: nothing is filled in from the clock."""
    text = F.trim(F.try_variant_get(x, "$", "string"))
    num = as_number(x, k)
    scale = F.when(F.abs(num) > EPOCH_MS_THRESHOLD, F.lit(1000)).otherwise(F.lit(1_000_000))
    from_epoch = F.timestamp_micros((num * scale).try_cast("long"))
    dated = F.when(F.regexp_like(text, F.lit(DATE_TEXT)), F.try_to_timestamp(text))
    parsed = (F.when(k_string(k), F.coalesce(from_epoch, dated))
              .when(k_number(k), from_epoch))
    return parsed.cast("timestamp_ntz")


def computed_once(df: DataFrame, keep: Sequence[str], outputs: Sequence[Column]) -> DataFrame:
    """Final stage: ``keep`` columns plus ``outputs`` produced by a one-row generator.

    A filter on a plain projection is pushed below it with every referenced alias inlined,
    so ``filter(size(errors) == 0)`` would re-run the Variant parse and lookups dozens of
    times per row.  Columns produced by a generator are opaque to that rewrite: the rules
    run once per message and the validity filter stays above them.  They are computed in a
    projection below it, as a generator evaluates what its columns share anew for each of them.
    """
    rows = df.select(*keep, *outputs)
    return rows.select(*keep, F.inline(F.array(F.struct(*rows.columns[len(keep):]))))


def with_times(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Stage 3: each time field parsed once (``_ts_<name>``), shared by rule and record."""
    return df.select("*", *[as_timestamp(f(n), t(n)).alias(f"_ts_{n}") for n in names])


def positive(d: Column) -> Column:
    """``d > 0`` where NaN is not positive (Spark orders NaN above every number)."""
    return (d > 0) & ~F.isnan(d)


# ---------------------------------------------------------------- rules

def rule(cond: Column, label: str) -> Column:
    """``label`` when ``cond`` holds (a NULL condition counts as a violation)."""
    return F.when(F.coalesce(cond, F.lit(True)), F.lit(label))


SEP = "; "


def label_list(*labels: Column) -> Column:
    """Non-NULL labels as ``array<string>``.

    Built with ``concat_ws`` (which skips NULLs) and ``split`` rather than filtering an
    array with a lambda: higher-order functions are not code-generated and would take the
    whole projection out of whole-stage codegen."""
    text = F.concat_ws(SEP, *labels)
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(text, SEP))


def required_string(name: str) -> Column:
    return rule(~k_string(t(name)), f"{name}: string required")


def optional_string(name: str) -> Column:
    k = t(name)
    return rule(k.isNotNull() & ~k_null(k) & ~k_string(k), f"{name}: string or null expected")


def defaulted_string(name: str) -> Column:
    k = t(name)
    return rule(k.isNotNull() & ~k_string(k), f"{name}: string expected")


def time_rule(name: str) -> Column:
    """Needs the ``with_times`` stage."""
    return rule(t(name).isNotNull() & F.col(f"_ts_{name}").isNull(), f"{name}: datetime expected")


def message_rules(value: Column, v: Column, is_obj: Column) -> list[Column]:
    return [
        F.when(value.isNull(), F.lit("value: null")),
        F.when(value.isNotNull() & v.isNull(), F.lit("value: not JSON")),
        F.when(v.isNotNull() & ~is_obj, F.lit("value: not an object")),
    ]


def _checked(value: Column, v: Column, per_field: list[Column]) -> Column:
    is_obj = looks_like_object(value)
    ok_obj = v.isNotNull() & is_obj
    return label_list(*message_rules(value, v, is_obj), *[F.when(ok_obj, r) for r in per_field])


def event_errors(value: Column, v: Column) -> Column:
    """Errors of an event message; needs the staged ``_f_`` / ``_t_`` columns of EVENT_FIELDS."""
    return _checked(value, v, [
        defaulted_string("event_id"),
        rule(~(k_string(t("event_type")) & as_string(f("event_type"), t("event_type")).isin(*EVENT_TYPES)),
             "event_type: not an accepted value"),
        required_string("user_id"),
        required_string("session_id"),
        required_string("page"),
        optional_string("referrer"),
        rule(t("metadata").isNotNull() & ~k_object(t("metadata")), "metadata: object expected"),
        time_rule("timestamp"),
    ])


def item_kinds(e: Column) -> Column:
    """Per item element: its fields and their kinds (each looked up once)."""
    parts = [F.schema_of_variant(e).alias("k")]
    for n in ITEM_FIELDS:
        x = F.variant_get(e, f"$.{n}", "variant")
        parts += [x.alias(n), F.schema_of_variant(x).alias(f"k_{n}")]
    return F.struct(*parts)


ITEM_RULES = (
    ("bad_object", "items: object expected"),
    ("bad_product_id", "items.product_id: string required"),
    ("bad_product_name", "items.product_name: string required"),
    ("bad_quantity", "items.quantity: integer > 0 required"),
    ("bad_unit_price", "items.unit_price: number > 0 required"),
)


def _item_breaks(it: Column) -> dict[str, Column]:
    """Which item rules one element (from ``item_kinds``) breaks."""
    obj = F.coalesce(k_object(it["k"]), F.lit(False))
    return {
        "bad_object": ~obj,
        "bad_product_id": obj & ~F.coalesce(k_string(it["k_product_id"]), F.lit(False)),
        "bad_product_name": obj & ~F.coalesce(k_string(it["k_product_name"]), F.lit(False)),
        "bad_quantity": obj & ~F.coalesce(as_int(it["quantity"], it["k_quantity"]) > 0, F.lit(False)),
        "bad_unit_price": obj & ~F.coalesce(positive(as_double(it["unit_price"], it["k_unit_price"])),
                                            F.lit(False)),
    }


def item_flags(items: Column) -> Column:
    """One fold over the items: a struct with one flag per item rule (any element breaks it)."""
    zero = F.struct(*[F.lit(False).alias(name) for name, _ in ITEM_RULES])

    def merge(acc: Column, it: Column) -> Column:
        breaks = _item_breaks(it)
        return F.struct(*[(acc[name] | breaks[name]).alias(name) for name, _ in ITEM_RULES])

    return F.aggregate(items, zero, merge)


def item_errors(flags: Column) -> list[Column]:
    """Labels of the item rules flagged by ``item_flags``."""
    return [F.when(flags[name], F.lit(label)) for name, label in ITEM_RULES]


def typed_item(it: Column) -> Column:
    """The element as the four typed item fields, in field order."""
    return F.struct(
        as_string(it["product_id"], it["k_product_id"]).alias("product_id"),
        as_string(it["product_name"], it["k_product_name"]).alias("product_name"),
        as_int(it["quantity"], it["k_quantity"]).alias("quantity"),
        as_double(it["unit_price"], it["k_unit_price"]).alias("unit_price"),
    )


# Fast path for order items: one native cast of the whole array to typed structs, guarded by
# the array's merged JSON schema (one ``schema_of_variant`` call per order).
FAST_ITEMS = "array<struct<product_id:string,product_name:string,quantity:double,unit_price:double>>"
ITEMS_JSON = "array<struct<product_id:string,product_name:string,quantity:decimal(38,0),unit_price:double>>"
_NUMBER = r"(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
# Doubles are exact integers up to here; greater quantities take the element-wise path.
EXACT_DOUBLE = float(1 << 53)


def _fast_items_ok(schema: Column, fast: Column) -> Column:
    """True when every element is a flat object whose fields have the accepted JSON kinds and
    valid values; such an order breaks no item rule and its typed items are ``fast``.  Any
    other order (a wrong kind, a NULL element, a nested value, a bad number) is left to the
    exact element-by-element path, which also names the broken rules."""
    inner = F.substr(schema, F.lit(len("ARRAY<OBJECT<") + 1))
    flat = schema.startswith("ARRAY<OBJECT<") & ~inner.contains("OBJECT<") & ~inner.contains("ARRAY<")
    kinds = (F.regexp_like(schema, F.lit(r"[<, ]product_id: STRING[,>]"))
             & F.regexp_like(schema, F.lit(r"[<, ]product_name: STRING[,>]"))
             & F.regexp_like(schema, F.lit(r"[<, ]quantity: " + _NUMBER + r"[,>]"))
             & F.regexp_like(schema, F.lit(r"[<, ]unit_price: " + _NUMBER + r"[,>]")))
    bad_value = F.exists(fast, lambda it: (
        it.isNull() | it["product_id"].isNull() | it["product_name"].isNull()
        | ~F.coalesce((it["quantity"] > 0) & (it["quantity"] == F.rint(it["quantity"]))
                      & (it["quantity"] <= EXACT_DOUBLE), F.lit(False))
        | ~F.coalesce(positive(it["unit_price"]), F.lit(False))))
    empty = schema == F.lit("ARRAY<VOID>")
    return fast.isNotNull() & (empty | (flat & kinds)) & ~F.coalesce(bad_value, F.lit(True))


def with_items(df: DataFrame) -> DataFrame:
    """Stages for orders' items.

    1. per order, natively: the merged schema of ``items`` and the typed cast of the array;
    2. ``_items_fast_ok``: whether that typed array can be taken as is (one ``exists`` pass);
    3. ``_items_is_array``, ``_item_flags`` (one flag per item rule) and ``_items_json`` (the
       items re-serialised with the four typed fields).  Orders on the fast path get no flags
       and the cast array; only the others look every element up (``item_kinds``), type it
       and fold the rule flags.
    """
    items = f("items")
    staged = df.select("*", F.schema_of_variant(items).alias("_items_schema"),
                       F.try_variant_get(items, "$", FAST_ITEMS).alias("_items_fast"))
    staged = staged.select("*", _fast_items_ok(F.col("_items_schema"), F.col("_items_fast")).alias("_items_fast_ok"))
    slow = F.transform(F.try_variant_get(items, "$", "array<variant>"), item_kinds)
    no_flags = F.struct(*[F.lit(False).alias(name) for name, _ in ITEM_RULES])
    fast_ok = F.col("_items_fast_ok")
    return staged.select(
        "*",
        F.coalesce(F.col("_items_schema").startswith("ARRAY<"), F.lit(False)).alias("_items_is_array"),
        F.when(fast_ok, no_flags).otherwise(item_flags(slow)).alias("_item_flags"),
        F.when(fast_ok, F.to_json(F.col("_items_fast").try_cast(ITEMS_JSON)))
        .otherwise(F.to_json(F.transform(slow, typed_item))).alias("_items_json"),
    )


def order_errors(value: Column, v: Column) -> Column:
    """Errors of an order message; needs the staged columns of ORDER_FIELDS and ``with_items``."""
    item_rules = ([F.when(~F.col("_items_is_array"), F.lit("items: array required"))]
                  + [F.when(F.col("_items_is_array"), e) for e in item_errors(F.col("_item_flags"))])
    return _checked(value, v, [
        defaulted_string("order_id"),
        required_string("user_id"),
        rule(~positive(as_double(f("total_amount"), t("total_amount"))), "total_amount: number > 0 required"),
        defaulted_string("currency"),
        defaulted_string("status"),
        optional_string("shipping_address"),
        time_rule("created_at"),
        *item_rules,
    ])
