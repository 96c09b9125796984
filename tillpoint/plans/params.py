"""Parameters of the registered queries on the driver's test tables.

The report functions keep the reference thresholds as their defaults; the test tables have
larger amounts (monthly customer revenue runs to about 230,000 and the median average gap
between orders is about 218 days), so the registered queries pass these values instead.
"""

HIGH_TIER = 120000
MEDIUM_TIER = 60000
RISK_DAYS = 220
PERIOD_START = "2000-01-01"
PERIOD_END = "2000-04-01"
REPORT_ANCHOR = "2000-06-01"

# Sales-table filters and thresholds (A2 / A5 style statements).
REGION = "AMERICA"
CATEGORY = "ECONOMY"
SALES_OVER = 50000.0
SALES_OVER_SMALL = 10000.0
DATE_AFTER = "1998-01-01"
QUANTITY_OVER = 1000
CITY_COUNT_OVER = 2000
