"""Typed schemas and the fixed domain values of the click log.

One ``StructType`` per logical table; readers apply these instead of
inferring (inference costs an extra scan and turns day codes such as
``0511`` into the number 511).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original jobs' constants for equal results)
# ---------------------------------------------------------------------------
# action_type codes: 0 click, 1 add-to-cart, 2 purchase, 3 favourite
ACTION_CLICK = 0
ACTION_CART = 1
ACTION_PURCHASE = 2
ACTION_FAVOURITE = 3
# the day the ranking and share reports look at (an MMDD day code)
DEFAULT_DAY = "1111"
# age bands counted as "young" (under 30)
YOUTH_BANDS = (1, 2, 3)
# valid age bands; 0 and empty mean unknown
VALID_AGE_BANDS = (1, 2, 3, 4, 5, 6, 7, 8)
# valid gender codes; 2 and empty mean unknown
VALID_GENDERS = (0, 1)
# size of the ranked reports
TOP_K = 100
# feature order of the pair table (position i is LibSVM index i+1)
FEATURES = (
    "age_range",
    "gender",
    "total_logs",
    "unique_item_ids",
    "categories",
    "browse_days",
    "one_clicks",
    "shopping_carts",
    "purchase_times",
    "favor_times",
)
# ---------------------------------------------------------------------------

LOG_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("cat_id", T.LongType()),
        T.StructField("seller_id", T.LongType()),
        T.StructField("brand_id", T.StringType()),
        T.StructField("time_stamp", T.StringType()),
        T.StructField("action_type", T.IntegerType()),
    ]
)

USERS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("age_range", T.IntegerType()),
        T.StructField("gender", T.IntegerType()),
    ]
)

PAIRS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("merchant_id", T.LongType()),
        T.StructField("label", T.IntegerType()),
    ]
)

LOG_COLUMNS = tuple(f.name for f in LOG_SCHEMA.fields)
USERS_COLUMNS = tuple(f.name for f in USERS_SCHEMA.fields)


def all_string(schema: T.StructType) -> T.StructType:
    """Same field names, every field a string (raw CSV read before casts)."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])

# names of the temp views that the SQL forms read
LOG_VIEW, USERS_VIEW = "clickmart_user_log", "clickmart_user_info"
