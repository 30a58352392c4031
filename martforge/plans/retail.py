"""Specs of the retail star schema: rules, conformance, hierarchies."""

from __future__ import annotations

from martforge.operators.conform import ConformSpec
from martforge.operators.hierarchy import HierarchySpec, Level
from martforge.operators.quality import Rule

# Fixed values that must equal the original pipeline's: the product id pattern,
# the default labels and the level names.
ITEM_ID_PATTERN = r"^ITM\d+$"
OTHERS = "Others"
NOT_AVAILABLE = "Not Available"
GEO_LEVELS = ("country", "state", "district")
PRODUCT_LEVELS = ("department", "category", "item")

STORE_RULES = [Rule("store_id", "int")]
PRODUCT_RULES = [Rule("item_id", "pattern", ITEM_ID_PATTERN)]
SALES_RULES = [Rule("sales_id", "int"), Rule("store_id", "int"), Rule("product_id", "int"),
               Rule("period_start"), Rule("period_end")]

# Strict variants: unparseable dates and product ids that overflow int are
# quarantined instead of reaching silver as NULL.
# So are dates that would stretch the calendar beyond reason, and measures that
# sums would round (``facts.AMOUNT_SCALE`` digits after the point).
CALENDAR_RANGE = "1900-01-01..2199-12-31"
SALES_RULES_STRICT = SALES_RULES + [
    Rule("period_start", "date"), Rule("period_end", "date"),
    Rule("period_start", "date_range", CALENDAR_RANGE), Rule("period_end", "date_range", CALENDAR_RANGE),
    Rule("sales_amount", "decimals", "10"), Rule("sales_units", "decimals", "10")]
PRODUCT_RULES_STRICT = PRODUCT_RULES + [
    Rule("item_id", "sql", "try_cast(substring(item_id, 4) as int) is not null")]

STORE_CONFORM = ConformSpec(
    defaults={"store_state": OTHERS, "store_district": OTHERS},
    casts={c: "string" for c in ("store_name", "store_addr", "store_district", "store_state", "store_country")},
    key="store_id")

PRODUCT_CONFORM = ConformSpec(
    renames={"item_id": "product_id", "item_name": "item"},
    substr={"product_id": 4},
    casts={"product_id": "int", "department": "string", "category": "string", "item": "string"},
    defaults={"department": NOT_AVAILABLE, "category": NOT_AVAILABLE},
    key="product_id")

SALES_CONFORM = ConformSpec(
    casts={"sales_amount": "double", "sales_units": "double", "product_id": "int"},
    dates=("period_start", "period_end"),
    defaults={"sales_amount": 0.0, "sales_units": 0.0},
    key="sales_id")

GEOGRAPHY = HierarchySpec(
    levels=(Level("country", ("store_country",)),
            Level("state", ("store_country", "store_state")),
            Level("district", ("store_country", "store_state", "store_district"))),
    id_col="geography_id", leaf_key="store_id", id_base=1, id_type="int")

# The item level matches on department, category and product id, not on the item name.
PRODUCT = HierarchySpec(
    levels=(Level("department", ("department",)),
            Level("category", ("department", "category")),
            Level("item", ("department", "category", "item", "product_id"),
                  match=("department", "category", "product_id"))),
    id_col="hierarchy_id", leaf_key="product_id", id_base=0, id_type="bigint")
