"""Business labels: customer segments, price bands, drop reasons, customer types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Customer segments as stored in the result tables -> English.
SEGMENT_ENGLISH = {
    "高价值用户": "Champions",
    "忠诚用户": "Loyal",
    "新客户": "New",
    "流失高价值用户": "At Risk",
    "沉睡用户": "Hibernating",
    "潜力用户": "Promising",
}
CHAMPIONS, LOYAL, NEW, AT_RISK, HIBERNATING, PROMISING = SEGMENT_ENGLISH

# Customer type of a month's sales.
NEW_CUSTOMER = "新客"
RETURNING_CUSTOMER = "老客"

# Upper bound (exclusive) and label of each invoice price band.
PRICE_BANDS = [
    (10, "< £10"),
    (50, "£10 - £50"),
    (100, "£50 - £100"),
    (500, "£100 - £500"),
]
TOP_PRICE_BAND = ">= £500"

# Why a raw line is dropped or kept.
NO_CUSTOMER = "drop:CustomerID_is_null"
BAD_QUANTITY = "drop:Quantity_non_positive"
BAD_PRICE = "drop:UnitPrice_non_positive"
NULL_MEASURE = "drop:null_measure"
KEPT = "keep:DWD"


def segment(r: Column, f: Column, m: Column) -> Column:
    """Customer segment from the three 1-5 scores; the first matching rule wins."""
    high = 4
    middle = 3
    low = 2
    return (
        F.when(F.least(r, f, m) >= high, CHAMPIONS)
        .when(F.least(r, f) >= middle, LOYAL)
        .when((r >= high) & (f <= low), NEW)
        .when((r <= low) & (F.least(f, m) >= middle), AT_RISK)
        .when(F.greatest(r, f) <= low, HIBERNATING)
        .otherwise(PROMISING)
    )


def translate(label: Column, mapping: dict[str, str]) -> Column:
    """Look a label up in a small fixed mapping; unknown labels stay as they are."""
    pairs = F.create_map(*[F.lit(text) for pair in mapping.items() for text in pair])
    return F.coalesce(F.try_element_at(pairs, label), label)


def price_band(total: Column) -> Column:
    """Label of the half-open band [lower, upper) that holds an invoice total."""
    bound, label = PRICE_BANDS[0]
    bands = F.when(total < bound, label)
    for bound, label in PRICE_BANDS[1:]:
        bands = bands.when(total < bound, label)
    return bands.otherwise(TOP_PRICE_BAND)


def drop_reason(customer_id: Column, quantity: Column, unit_price: Column, null_measures: bool = False) -> Column:
    """Mutually exclusive reason for dropping a raw line.

    A NULL quantity or price is reported as kept unless `null_measures` is set, although the
    cleaning step does drop such a line.
    """
    reasons = (
        F.when(customer_id.isNull(), NO_CUSTOMER).when(quantity <= 0, BAD_QUANTITY).when(unit_price <= 0, BAD_PRICE)
    )
    if null_measures:
        reasons = reasons.when(quantity.isNull() | unit_price.isNull(), NULL_MEASURE)
    return reasons.otherwise(KEPT)


def customer_type(month: Column, first_month: Column) -> Column:
    """Whether a month's sales come from the customer's first month or a later one."""
    return F.when(month == first_month, NEW_CUSTOMER).otherwise(RETURNING_CUSTOMER)
