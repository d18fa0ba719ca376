"""The seven silver tables: typed, cleaned, reject-accounted, de-duplicated.

Each table is described once (``SilverTable``); building it, metering it and the
end-to-end run all read that description.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.functions.casts import (
    MONEY,
    Converter,
    blank_as_null,
    blank_as_value,
    is_missing,
    to_timestamp,
    to_type,
    was_rounded,
)
from tierforge.operators.dedupe import dedupe_latest
from tierforge.operators.features import delay_features
from tierforge.operators.lookup import translate
from tierforge.operators.quality import (
    Rule,
    in_range,
    judge,
    keep_passing,
    matches,
    not_null,
    rejected,
    rule_counters,
)
from tierforge.sources.raw_csv import CORRUPT
from tierforge.operators.text_ops import fill_text, has_text, map_values, standardize_text

# Patterns of valid review scores and review dates.
SCORE_PATTERN = r"^[1-5]\z"
MOMENT_PATTERN = r"^\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}\z"

# Labels of the payment codes.
PAYMENT_LABELS = {
    "credit_card": "Credit Card",
    "debit_card": "Debit Card",
    "boleto": "Boleto",
    "voucher": "Voucher",
}


@dataclass(frozen=True)
class SilverTable:
    """How one silver table comes from its bronze table.

    ``columns``   source columns, in silver order
    ``casts``     converters by column, given the money type
    ``rules``     row rules over the cleaned columns and the raw text of cast ones
    ``clean``     steps between casts and rules
    ``keys``      de-duplication keys (none: rows are kept as they are)
    ``latest_by`` column whose greatest value wins within a key
    ``finish``    steps after de-duplication; takes the ``lookups`` tables, too
    ``amounts``   columns of the money type
    """

    source: str
    columns: Sequence[str]
    rules: Callable[[], list[Rule]]
    casts: Callable[[str], dict[str, Converter]] = lambda money: {}
    clean: Callable[[DataFrame], DataFrame] = lambda df: df
    keys: Sequence[str] = ()
    latest_by: str | None = None
    finish: Callable[..., DataFrame] = lambda df: df
    lookups: Sequence[str] = ()
    amounts: Sequence[str] = ()


def _raw(name: str) -> str:
    return f"__raw_{name}"


def prepare(table: SilverTable, bronze: DataFrame, money: str = MONEY) -> DataFrame:
    """Typed and cleaned rows before any is dropped, with the raw text of cast columns."""
    casts = table.casts(money)
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in bronze.columns else F.lit(False)
    typed = bronze.select(
        corrupt.alias(_raw(CORRUPT)),
        *[casts[name](F.col(name)).alias(name) if name in casts else F.col(name) for name in table.columns],
        *[F.col(name).alias(_raw(name)) for name in casts],
    )
    return table.clean(typed)


def passing(table: SilverTable, prepared: DataFrame, judged: bool = False) -> DataFrame:
    """The prepared rows that break no rule, without the raw text."""
    raw = [name for name in prepared.columns if name.startswith(_raw(""))]
    return keep_passing(prepared, table.rules(), judged).drop(*raw)


def rejects(table: SilverTable, judged: DataFrame) -> DataFrame:
    """The judged rows that break a rule: the silver columns, ``raw_`` and the text of each cast one, whether the row
    was ``corrupt`` (landed with a wrong number of fields), and the rules it breaks."""
    renamed = {_raw(name): f"raw_{name}" for name in table.columns} | {_raw(CORRUPT): "corrupt"}
    return rejected(judged, table.rules()).withColumnsRenamed(renamed)


def complete(table: SilverTable, prepared: DataFrame, *lookups: DataFrame, judged: bool = False) -> DataFrame:
    """Rules, de-duplication and lookups over prepared rows; ``judged`` rows carry the outcome of the rules."""
    kept = passing(table, prepared, judged)
    if table.keys:
        kept = dedupe_latest(kept, table.keys, table.latest_by)
    return table.finish(kept, *lookups)


def build(table: SilverTable, bronze: DataFrame, *lookups: DataFrame, money: str = MONEY) -> DataFrame:
    return complete(table, prepare(table, bronze, money), *lookups)


# --- orders -----------------------------------------------------------------

_ORDER_MOMENTS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


ORDERS = SilverTable(
    source="bronze_orders",
    columns=("order_id", "customer_id", "order_status", *_ORDER_MOMENTS),
    casts=lambda money: {name: to_timestamp() for name in _ORDER_MOMENTS},
    clean=lambda df: delay_features(
        df,
        start="order_purchase_timestamp",
        due="order_estimated_delivery_date",
        actual="order_delivered_customer_date",
    ),
    rules=lambda: [Rule("delivered", not_null(["order_delivered_customer_date"]))],
    keys=("order_id",),
    latest_by="order_purchase_timestamp",
)

# --- order items ------------------------------------------------------------

ORDER_ITEMS = SilverTable(
    source="bronze_order_items",
    columns=(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ),
    casts=lambda money: {
        "order_item_id": to_type("int"),
        "shipping_limit_date": to_timestamp(),
        "price": to_type(money),
        "freight_value": to_type(money),
    },
    rules=lambda: [
        Rule("amounts", in_range("price", 0) & in_range("freight_value", 0)),
        Rule("product_id", not_null(["product_id"])),
        Rule("seller_id", not_null(["seller_id"])),
    ],
    keys=("order_id", "order_item_id"),
    latest_by="shipping_limit_date",
    amounts=("price", "freight_value"),
)

# --- customers and sellers --------------------------------------------------


def _place_table(entity: str, ids: Sequence[str], latest_by: str) -> SilverTable:
    zip_code, city, state = (f"{entity}_{part}" for part in ("zip_code_prefix", "city", "state"))
    key = ids[0]
    return SilverTable(
        source=f"bronze_{entity}s",
        columns=(*ids, zip_code, city, state),
        clean=lambda df: standardize_text(df, {zip_code: "trim", city: "title", state: "upper"}),
        rules=lambda: [Rule("required", not_null([key, zip_code, city, state]))],
        keys=(key,),
        latest_by=latest_by,
    )


CUSTOMERS = _place_table("customer", ("customer_id", "customer_unique_id"), "customer_unique_id")
SELLERS = _place_table("seller", ("seller_id",), "seller_city")

# --- order payments ---------------------------------------------------------

ORDER_PAYMENTS = SilverTable(
    source="bronze_order_payments",
    columns=(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    casts=lambda money: {
        "payment_sequential": to_type("int"),
        "payment_installments": blank_as_value("int", 1),
        "payment_value": to_type(money),
    },
    clean=lambda df: map_values(
        standardize_text(df, {"payment_type": "lower"}), "payment_type", PAYMENT_LABELS
    ),
    rules=lambda: [Rule("required", not_null(["order_id", "payment_value"]))],
    amounts=("payment_value",),
)

# --- order reviews ----------------------------------------------------------

_COMMENTS = ("review_comment_title", "review_comment_message")

ORDER_REVIEWS = SilverTable(
    source="bronze_order_reviews",
    columns=(
        "review_id",
        "order_id",
        "review_score",
        *_COMMENTS,
        "review_creation_date",
        "review_answer_timestamp",
    ),
    casts=lambda money: {
        "review_score": to_type("int"),
        "review_creation_date": to_timestamp(None),
        "review_answer_timestamp": to_timestamp(None),
    },
    clean=lambda df: has_text(fill_text(df, _COMMENTS), _COMMENTS, "has_comment"),
    rules=lambda: [
        Rule("score", matches(_raw("review_score"), SCORE_PATTERN)),
        Rule(
            "creation_date",
            matches(_raw("review_creation_date"), MOMENT_PATTERN, allow_null=False, allow_blank=False),
        ),
        Rule("required", not_null(["review_id", "order_id", "review_score"])),
    ],
    keys=("review_id",),
    latest_by="review_creation_date",
)

# --- products ---------------------------------------------------------------

_COUNTS = ("product_name_lenght", "product_description_lenght", "product_photos_qty")
_SIZES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")


def _english_category(df: DataFrame, translation: DataFrame) -> DataFrame:
    return translate(
        df,
        translation,
        key="product_category_name",
        label="product_category_name_english",
        out="product_category_name_english",
    )


PRODUCTS = SilverTable(
    source="bronze_products",
    columns=("product_category_name", "product_id", *_COUNTS, *_SIZES),
    casts=lambda money: {
        **{name: lambda value: to_type("int")(blank_as_null(value)) for name in _COUNTS},
        **{name: blank_as_value("double", 0.0) for name in _SIZES},
    },
    rules=lambda: [Rule("product_id", not_null(["product_id"]))],
    keys=("product_id",),
    latest_by="product_category_name",
    # After de-duplication: fewer rows meet the lookup, and none is multiplied by it.
    finish=_english_category,
    lookups=("bronze_translation",),
)

SILVER = {
    "silver_orders": ORDERS,
    "silver_order_items": ORDER_ITEMS,
    "silver_customers": CUSTOMERS,
    "silver_sellers": SELLERS,
    "silver_order_payments": ORDER_PAYMENTS,
    "silver_order_reviews": ORDER_REVIEWS,
    "silver_products": PRODUCTS,
}


def build_silver_orders(bronze: DataFrame) -> DataFrame:
    return build(ORDERS, bronze)


def build_silver_order_items(bronze: DataFrame, money: str = MONEY) -> DataFrame:
    return build(ORDER_ITEMS, bronze, money=money)


def build_silver_customers(bronze: DataFrame) -> DataFrame:
    return build(CUSTOMERS, bronze)


def build_silver_sellers(bronze: DataFrame) -> DataFrame:
    return build(SELLERS, bronze)


def build_silver_order_payments(bronze: DataFrame, money: str = MONEY) -> DataFrame:
    return build(ORDER_PAYMENTS, bronze, money=money)


def build_silver_order_reviews(bronze: DataFrame) -> DataFrame:
    return build(ORDER_REVIEWS, bronze)


def build_silver_products(bronze: DataFrame, translation: DataFrame) -> DataFrame:
    return build(PRODUCTS, bronze, translation)


# --- metrics ----------------------------------------------------------------

METRICS_SCHEMA = "table string, metric string, item string, value bigint"


def counters(table: SilverTable, money: str = MONEY, judged: bool = False) -> list[Column]:
    """Aggregates over prepared rows, named ``metric:item``: the reject account of the rules, and ``cast_counters``."""
    return [*rule_counters(table.rules(), judged), *cast_counters(table, money)]


def cast_counters(table: SilverTable, money: str = MONEY) -> list[Column]:
    """The texts that a cast could not read (``malformed``) and the amounts it had to round (``rounded``)."""
    aggregates = []
    for name in table.casts(money):
        text = F.col(_raw(name))
        aggregates.append(
            F.count_if(~is_missing(text) & F.col(name).isNull()).alias(f"malformed:{name}")
        )
        if name in table.amounts and money.startswith("decimal"):
            aggregates.append(F.count_if(was_rounded(text, F.col(name))).alias(f"rounded:{name}"))
    return aggregates


def row_counters(table: SilverTable) -> list[Column]:
    """Aggregates over prepared rows: those landed with a wrong number of fields (``corrupt``), and those with a
    NULL in the key (``null_keys``); of the latter, de-duplication makes one row a key."""
    incomplete = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in table.keys], F.lit(False))
    return [F.count_if(F.col(_raw(CORRUPT))).alias("corrupt"), F.count_if(incomplete).alias("null_keys")]


def silver_metrics(name: str, bronze: DataFrame, money: str = MONEY) -> DataFrame:
    """The counters of one table as rows ``table``, ``metric``, ``item``, ``value``; one pass."""
    table = SILVER[name]
    counted = judge(prepare(table, bronze, money), table.rules()).agg(*counters(table, money, judged=True))
    lines = [
        F.struct(
            F.lit(name).alias("table"),
            F.lit(counter.partition(":")[0]).alias("metric"),
            F.lit(counter.partition(":")[2]).alias("item"),
            F.col(f"`{counter}`").alias("value"),
        )
        for counter in counted.columns
    ]
    return counted.select(F.inline(F.array(*lines)))
