"""The eight landed tables."""

from __future__ import annotations

from tierforge.sources.ingest import IngestEntry

# The retail tables, in landing order.
RETAIL_TABLES = (
    "orders",
    "products",
    "customers",
    "sellers",
    "order_items",
    "order_payments",
    "order_reviews",
)
TRANSLATION_FILE = "product_category_name_translation.csv"


def retail_manifest(prefix: str = "", multiline: bool | str = "auto") -> list[IngestEntry]:
    """``<prefix><table>_dataset.csv`` -> ``bronze_<table>``, and the category translation."""
    entries = [
        IngestEntry(f"{prefix}{table}_dataset.csv", f"bronze_{table}", multiline)
        for table in RETAIL_TABLES
    ]
    return [*entries, IngestEntry(TRANSLATION_FILE, "bronze_translation", multiline)]
