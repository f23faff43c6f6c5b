"""Filing tag names the dashboard queries select on.

Fixed values: these must equal the tag names used by the original dashboard
SQL so that the same filings produce the same rows.
"""

REVENUE = (
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "SalesRevenueNet",
    "Revenues",
)
COST_OF_REVENUE = ("CostOfGoodsAndServicesSold", "CostOfRevenue")
OPERATING_COST = (
    "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
    "SellingAndMarketingExpense",
    "GeneralAndAdministrativeExpense",
)
NET_INCOME = ("NetIncomeLoss",)
ASSETS = "Assets"
LIABILITIES = "Liabilities"
ASSETS_CURRENT = "AssetsCurrent"
LIABILITIES_CURRENT = "LiabilitiesCurrent"
SHARES_OUTSTANDING = "CommonStockSharesOutstanding"
EPS_BASIC = "EarningsPerShareBasic"
DIVIDENDS_PER_SHARE = "CommonStockDividendsPerShareDeclared"
OPERATING_CASH_FLOW = (
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
)
INVESTING_CASH_FLOW = (
    "NetCashProvidedByUsedInInvestingActivities",
    "NetCashProvidedByUsedInInvestingActivitiesContinuingOperations",
)

# Market index ticker compared against company prices.
INDEX_TICKER = "^GSPC"

# Filing forms kept by the ingest job.
FORMS = ("10-Q", "10-K")

# Fiscal period -> number of quarters a year-to-date (cumulative) fact spans.
CUMULATIVE_QTRS = {"Q1": 1, "Q2": 2, "Q3": 3, "FY": 4}
