"""Fixed values of the mapping from the test tables onto the reference's schema.

The reference queries a payments star (yearly fact tables and four
dimensions) and a sales sample database. Neither ships data; the test tables
stand in for them. The values below must stay as they are for results to
match the oracle, and are kept together here.
"""

from __future__ import annotations

# --- fixed values: year stand-ins (reference year -> test year) -------------
YEAR_A = 1997  # stands for 2019
YEAR_B = 1998  # stands for 2020

# --- fixed values: literal stand-ins used by the queries --------------------
TYPE_LITERAL_CAPITALISED = "Standard"   # reference writes 'Payment'
TYPE_LITERAL_LOWER = "standard"         # reference writes 'payment'
STATUS_SUCCESS = "success"
CATEGORY = "bolt"                        # reference: 'Billing' and 'Shopping'
SUB_CATEGORIES = ("red", "blue", "hot")  # reference: Electricity, Internet, Water
SUB_CATEGORY_COLUMNS = ("electricity_trans", "internet_trans", "water_trans")
PAYMENT_METHOD = "HIGH"                  # reference: 'Bank account'
PLATFORM = "ios"
RFM_AS_OF = "1998-12-31"                 # reference: '2020-12-31'
COHORT_SUB_CATEGORIES = ("red", "blue", "hot", "small")   # reference: 'Telco Card'

# Sales side.
COLORS = ("red", "blue", "hot")          # reference: 'Black', 'Red', 'White'
SIZES = (1, 2)                           # reference: 'S', 'M'
PRODUCT_NUMBER_PATTERN = "Brand#[^1]%[0-9]"   # reference: 'BK-[^T]%-[0-9][0-9]'
NAME_WORDS = ("ring", "widget")          # reference: 'HL', 'Mountain'
MIN_NUMBER_PATTERN = "________%"         # at least 8 characters
MAIN_OFFICE = "BUILDING"                 # reference: 'Main Office'
CATEGORY_NAME_PATTERN = "%O%"            # reference: '%Bikes%'
MODEL_NAME_PATTERN = "%g%"               # reference: '%Road%'
LIST_PRICE_INT = 950                     # reference: 2443

# Binning (reference: ten bins of 1M then '> 10M'; ten bins of 10 then '> 100').
AMOUNT_BIN_WIDTH = 25_000
COUNT_BIN_WIDTH = 1
BIN_COUNT = 10
CATEGORY_BINS = 7
SCENARIO_BINS = 17

# Dimension rows built from literals.
PLATFORMS = ((1, "ios"), (2, "android"), (3, "website"))
STATUSES = ((1, "success"), (2, "failed"), (3, "pending"))
RETURN_FLAG_PLATFORM = (("R", 1), ("A", 2))   # anything else -> 3
ORDER_STATUS_ID = (("F", 1), ("O", 2))         # anything else -> 3

# Week of date (reference: datepart(week, '2022-04-20')).
WEEK_PROBE_DATE = "2022-04-20"
