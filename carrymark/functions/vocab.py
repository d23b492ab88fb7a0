"""Fixed values of the canonical data model.

The cash-flow sets below differ from mart to mart on purpose; each mart names
the set it uses and none is shared by accident.
"""

EQUITY = "EQUITY"
CREDIT = "CREDIT"

# --- fixed values: accepted vocabularies -----------------------------------
INSTRUMENT_TYPES = ("EQUITY", "CREDIT")
FUND_TYPES = ("EQUITY", "CREDIT")
SNAPSHOT_SOURCES = ("ADMIN", "INTERNAL")
VALUATION_TYPES = ("ACTUAL", "FORECAST")
INCOME_LEVELS = ("HIC", "UMC", "LMC", "LIC", "INX", "")
CASHFLOW_TYPES = (
    "INVESTMENT", "RETURN_OF_CAPITAL", "DIVIDEND", "EXIT_PROCEEDS", "DRAW",
    "PRINCIPAL", "INTEREST", "PREPAYMENT", "FEE", "OTHER",
)
TRANSACTION_TYPES = (
    "DRAWDOWN", "DISTRIBUTION", "DIVIDEND", "INVESTMENT_TRANSACTION", "EXPENSE",
    "MANAGEMENT_FEE", "LOAN_RECEIVED", "LOAN_DRAW", "LOAN_PRINCIPAL_REPAYMENT",
    "LOAN_INTEREST_RECEIPT", "LOAN_FEE_RECEIPT",
)
ACTIVITY_TYPES = (
    "DRAWDOWN", "DISTRIBUTION", "INVESTMENT_TRANSACTION", "EXPENSE", "MANAGEMENT_FEE",
)
CREDIT_TYPES = ("TERM", "REVOLVER", "DDTL", "BRIDGE", "MEZZ")
INTEREST_INDEXES = ("SOFR", "EURIBOR", "SONIA", "FED_FUNDS", "FIXED")
DAY_COUNTS = ("30E_360", "ACT_360", "ACT_365", "ACT_ACT")
AMORTIZATIONS = ("BULLET", "STRAIGHT_LINE", "CUSTOM_SCHEDULE")
SECURITY_RANKS = ("SENIOR_SECURED", "SENIOR_UNSECURED", "SECOND_LIEN", "MEZZANINE", "PIK")
FACILITY_TYPES = (
    "TERM_LOAN_B", "UNITRANCHE", "REVOLVER", "DELAYED_DRAWDOWN", "MEZZANINE", "RCF", "BRIDGE",
)
SYNDICATE_ROLES = ("AGENT", "ARRANGER", "LENDER", "CO_LENDER", "ADMIN_AGENT")
PERIOD_TYPES = ("Current", "Historical", "Forecast")
DIRECTIONS = ("outflow", "inflow")

# --- fixed values: cash-flow sets, one per use ------------------------------
PERIOD_CONTRIBUTIONS = ("CONTRIBUTION", "PURCHASE", "DRAW")
PERIOD_DISTRIBUTIONS = ("DISTRIBUTION", "DIVIDEND", "SALE", "PRINCIPAL", "PREPAYMENT")
CUMULATIVE_DISTRIBUTIONS = ("DISTRIBUTION", "DIVIDEND", "EXIT_PROCEEDS", "RETURN_OF_CAPITAL")
CUMULATIVE_CALLED = ("INVESTMENT", "PURCHASE")
INTEREST = ("INTEREST",)
RETURNS_OUTFLOWS = ("INVESTMENT", "DRAW")
EQUITY_REALISED = ("EXIT_PROCEEDS", "RETURN_OF_CAPITAL", "DIVIDEND")
CREDIT_DRAWS = ("DRAW",)
CREDIT_REPAYMENTS = ("PRINCIPAL", "PREPAYMENT")

# Stages that take a deal out of the open pipeline.
CLOSED_STAGES = ("Declined", "Committed")

# Investor-facing ledger entries used by the latest-performance summary.
CAPITAL_CALLS = ("DRAWDOWN",)
INVESTOR_DISTRIBUTIONS = ("DISTRIBUTION",)
