"""General-ledger business rules held as data (§2.12)."""

# P&L line by account text, first match wins (construction revenue, direct and indirect cost, admin).
REVENUE_PREFIXES = ("41010", "41020", "41030")
DIRECT_COST_PREFIXES = ("5",)
INDIRECT_COST_PREFIXES = ("6", "7")
ADMIN_PREFIX = "8"
ADMIN_EXCLUDED_PREFIXES = ("89", "88200", "88300", "88400")
# Cash accounts are natural accounts 11000-11199 except 11150 and 11170, outside companies 132 and 134.
CASH_RANGE = (11000, 11199)
CASH_EXCLUDED_ACCOUNTS = (11150, 11170)
CASH_EXCLUDED_COMPANIES = ("132", "134")

# Companies left out of the consolidated P&L, plus the numeric range 71-104.
EXCLUDED_COMPANIES = ("41", "47", "51", "54", "56", "58", "61", "64", "67",
                      "120", "122", "124", "126", "128", "130", "132", "134")
EXCLUDED_COMPANY_RANGE = (71, 104)

# Divisions whose indirect cost counts from the break year on; before it all indirect cost counts.
INDIRECT_DIVISIONS = ("0000", "3000", "0400", "0600", "0800", "1200")

# Admin expense category by (divisions, departments), first match wins.
ADMIN_CATEGORIES = (
    (("0000",), ("309", "009"), "Accounting"),
    (("0400", "0600", "0800", "1200"), ("300", "010"), "Project Support"),
    (("0000",), ("414", "014"), "Business Development"),
    (("0400", "0600", "0800", "1200"), ("004",), "Facilities"),
    (("0000",), ("012", "312"), "HR"),
    (("0000", "0400", "0600", "0800", "1200"), ("302", "002"), "Field Ops"),
    (("0000",), ("407", "007"), "Project Solutions"),
    (("0000",), ("316", "016"), "Risk Management"),
    (("0000", "0400", "0600", "0800", "1200"), ("311", "011"), "Safety"),
    (("0000", "0400", "0600", "0800", "1200"), ("008", "108", "308", "408", "508"), "Technology"),
    (("0000",), ("000", "300"), "C-Suite"),
    (("1200",), ("000", "100", "106", "400", "500"), "Midwest"),
    (("0800",), ("000", "100", "106", "400", "500"), "Mid-Atlantic"),
    (("0600",), ("000", "100", "106", "400", "500"), "Central"),
    (("0400",), ("000", "100", "106", "400", "500"), "Great Lakes"),
)
