"""What each feed looks like, and how its columns reach the common model."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions import fixed_values as fixed
from tillmark.functions import lists, text
from tillmark.functions.staged import Steps

LINEAGE = ("_source_file", "_ingest_ts", "_snapshot_date")
RESCUED = "_rescued_data"


@dataclass(frozen=True)
class From:
    """A column of the feed and the clean-up it gets, if need be after a parse in steps."""

    header: str
    clean: Callable[[Column], Column] | None = None
    parse: Callable[[Column, str], Steps] | None = None


@dataclass(frozen=True, eq=False)
class FeedSpec:
    """One retailer's feed.

    ``headers`` is the file layout; ``columns`` maps fields of the common model to feed
    columns; ``keep`` is a condition on the cleaned fields that rows must meet.
    """

    retailer: str
    folder: str
    headers: tuple[str, ...]
    columns: dict[str, From]
    specials: tuple[str, ...] = ()
    keep: Callable[[], Column] | None = None
    stored_headers: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "stored_headers", tuple(stored_name(h) for h in self.headers))

    def stored_schema(self) -> T.StructType:
        """Schema of the stored raw table: native columns as text, extras, and lineage."""
        schema = T.StructType([T.StructField(name, T.StringType()) for name in self.stored_headers])
        return (
            schema.add(RESCUED, T.StringType())
            .add("_source_file", T.StringType())
            .add("_ingest_ts", T.TimestampType())
            .add("_snapshot_date", T.DateType())
        )


def stored_name(name: str) -> str:
    """Column name without the characters a stored table refuses; a leading ``_`` stays."""
    cleaned = re.sub(fixed.NAME_BREAKERS, "_", name)
    return cleaned if name.startswith("_") else cleaned.strip("_")


def with_stored_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{name}`").alias(stored_name(name)) for name in df.columns])


def column_or_null(df: DataFrame, header: str) -> Column:
    """The column under its own or its stored name, as text; NULL if the feed lacks it."""
    for name in (header, stored_name(header)):
        if name in df.columns:
            return F.col(f"`{name}`").cast("string")
    return F.lit(None).cast("string")


def _in_scope_category() -> Column:
    return F.col("main_category") != fixed.EXCLUDED_CATEGORY


def _has_department() -> Column:
    return F.col("main_category").isNotNull()


ALDI = FeedSpec(
    retailer="Aldi",
    folder="aldi",
    headers=("Date", "Product", "Price", "Unit Price", "Main Category", "Sub Category", "Product Page"),
    columns={
        "product_name": From("Product"),
        "price": From("Price"),
        "unit_price": From("Unit Price"),
        "main_category": From("Sub Category", text.slug_category),
        "product_url": From("Product Page"),
    },
)

COLES = FeedSpec(
    retailer="Coles",
    folder="coles",
    headers=(
        "Date", "Product Name", "SKU", "Brand", "Unit Size", "Current Price", "Previous Price",
        "Price per unit", "On Special", "Availability", "Suppliers", "Category", "URL",
    ),
    columns={
        "product_name": From("Product Name"),
        "source_sku": From("SKU"),
        "brand": From("Brand"),
        "price": From("Current Price"),
        "previous_price": From("Previous Price"),
        "unit_price": From("Price per unit"),
        "package_size": From("Unit Size", text.unit_size_label),
        "availability": From("Availability"),
        "suppliers": From("Suppliers"),
        "main_category": From("Category", text.label_of_spaced, text.spaced_steps),
        "product_url": From("URL"),
    },
    specials=("On Special",),
    keep=_in_scope_category,
)

IGA = FeedSpec(
    retailer="IGA",
    folder="iga",
    headers=(
        "Date", "Product Name", "SKU", "Price", "Price per unit", "Main Category", "Sub Category", "Product URL",
    ),
    columns={
        "product_name": From("Product Name", text.repaired_name),
        "source_sku": From("SKU", text.barcode),
        "price": From("Price"),
        "unit_price": From("Price per unit"),
        "main_category": From("Main Category", text.label_of_spaced, text.spaced_steps),
        "sub_category": From("Sub Category"),
        "product_url": From("Product URL"),
    },
)

WOOLWORTHS = FeedSpec(
    retailer="Woolworths",
    folder="woolworths",
    headers=(
        "Date", "Product Name", "SKU", "Brand", "Price", "Price per unit", "Package Size",
        "Specials", "Availability", "Ratings", "Department", "Product URL",
    ),
    columns={
        "product_name": From("Product Name"),
        "source_sku": From("SKU"),
        "brand": From("Brand"),
        "price": From("Price"),
        "unit_price": From("Price per unit"),
        "package_size": From("Package Size", text.package_size_label),
        "availability": From("Availability"),
        "ratings": From("Ratings"),
        "main_category": From("Department", lists.primary_department, lists.department_steps),
        "product_url": From("Product URL"),
    },
    specials=("Specials",),
    keep=_has_department,
)

FEEDS = (ALDI, COLES, IGA, WOOLWORTHS)
