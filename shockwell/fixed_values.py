"""Regulatory numbers, code lists and file headers.

Everything in this file is a value that results depend on, stated as it is
published or as the input files spell it.  No logic lives here.
"""

# Equity, currency and property shocks.
STRATEGIC_SHOCK = 0.22
T1_BASE_SHOCK = 0.39
T2_BASE_SHOCK = 0.49
CURRENCY_UP_SHOCK = 0.25
CURRENCY_DOWN_SHOCK = 0.25
PROPERTY_SHOCK = 0.25

# Spread stress a + b * duration; one row per duration bucket
# (below 5, 10, 15, 20 years, and above), one column per credit quality step.
BOND_RATED_A = [
    [0.000, 0.000, 0.000, 0.000, 0.000, 0.000],
    [0.045, 0.055, 0.070, 0.125, 0.225, 0.375],
    [0.070, 0.084, 0.105, 0.200, 0.350, 0.585],
    [0.095, 0.109, 0.130, 0.250, 0.440, 0.610],
    [0.120, 0.134, 0.155, 0.300, 0.465, 0.635],
]
BOND_RATED_B = [
    [0.009, 0.011, 0.014, 0.025, 0.045, 0.075],
    [0.005, 0.006, 0.007, 0.015, 0.025, 0.042],
    [0.005, 0.005, 0.005, 0.010, 0.018, 0.005],
    [0.005, 0.005, 0.005, 0.010, 0.005, 0.005],
    [0.005, 0.005, 0.005, 0.005, 0.005, 0.005],
]
BOND_UNRATED_A = [[0.000], [0.150], [0.235], [0.235], [0.355]]
BOND_UNRATED_B = [[0.030], [0.017], [0.012], [0.012], [0.005]]

# Concentration thresholds and factors per credit quality step.
EXCESS_EXPOSURE_THRESHOLDS = [0.03, 0.03, 0.03, 0.015, 0.015, 0.015, 0.015]
RISK_FACTORS = [0.12, 0.12, 0.21, 0.27, 0.73, 0.73, 0.73]
GOV_RISK_FACTORS = [0.00, 0.00, 0.12, 0.21, 0.27, 0.73, 0.73]
CONCENTRATION_TOLERANCE = 1e-5

# Calculation type -> row number in the calculation matrix.
CALCULATION_TYPE_ROWS = {
    "1": 0, "2": 1, "3L": 2, "3X": 3, "4": 4, "5": 5, "6": 6, "7": 7,
    "8": 8, "9": 9, "A": 10, "B": 11, "C": 12, "D": 13, "E": 14, "F": 15,
}

# Country lists.
EEA_COUNTRIES = [
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR",
    "HU", "IS", "IE", "IT", "LV", "LI", "LT", "LU", "MT", "NL", "NO", "PL",
    "PT", "RO", "SK", "SI", "ES", "SE", "CH", "GB",
]
OECD_NON_EEA_COUNTRIES = [
    "AU", "CA", "CL", "IL", "JP", "KR", "MX", "NZ", "TR", "US",
]

# Country -> currency.  The order matters: the first country of a
# currency names its risk-free curve.
COUNTRY_CURRENCY = {
    "AT": "EUR", "BE": "EUR", "BG": "BGN", "HR": "HRK", "CY": "EUR",
    "CZ": "CZK", "DK": "DKK", "EE": "EUR", "FI": "EUR", "FR": "EUR",
    "DE": "EUR", "GR": "EUR", "HU": "HUF", "IS": "ISK", "IE": "EUR",
    "IT": "EUR", "LV": "EUR", "LI": "CHF", "LT": "EUR", "LU": "EUR",
    "MT": "EUR", "NL": "EUR", "NO": "NOK", "PL": "PLN", "PT": "EUR",
    "RO": "RON", "SK": "EUR", "SI": "EUR", "ES": "EUR", "SE": "SEK",
    "CH": "CHF", "UK": "GBP", "AU": "AUD", "CA": "CAD", "CL": "CLP",
    "IL": "ILS", "JP": "JPY", "KR": "KRW", "MX": "MXN", "NZ": "NZD",
    "TR": "TRY", "US": "USD",
}

# Asset categories a holding may carry.
VALID_CATEGORIES = [
    "0", "1", "2", "3", "3X", "3L", "4", "5", "6", "7", "8", "9",
    "A", "B", "C", "D", "E", "F",
]
STRUCTURED_CATEGORIES = ["A", "B", "C", "D", "E", "F"]
RATED_CATEGORIES = ["1", "2", "8"]
EQUITY_CATEGORIES = ["3X", "3L"]
RATE_SENSITIVE_TYPES = ["1", "2", "4", "5", "6", "8"]

# Currencies with a published risk-free curve.
CURVE_CURRENCIES = [
    "EUR", "BGN", "HRK", "CZK", "DKK", "HUF", "ISK", "CHF", "NOK", "PLN",
    "RON", "SEK", "GBP", "AUD", "CAD", "CLP", "JPY", "KRW", "MXN",
    "NZD", "TRY", "USD",
]

# Bounds of the holding checks.
WEIGHT_SUM_LOW = 0.999
WEIGHT_SUM_HIGH = 1.001
STRUCTURED_WEIGHT_LIMIT = 0.12
CONTROL_TOTAL_TOLERANCE = 1_000_000.0

# Columns a holding must fill, also the duplicate key.
HOLDING_MANDATORY = [
    "portfolio_id", "valuation_date", "scr_delivery", "cic_of_underlying",
    "id_of_underlying", "qc_of_underlying", "valuation_weight",
    "portfolio_mod_dur", "underlying_asset_category",
]
# Columns that single checks read.
HOLDING_SPECIFIC = [
    "portfolio_id", "valuation_date", "portfolio_mod_dur", "scr_delivery",
    "cic_of_underlying", "economic_zone", "valuation_weight", "cqs",
    "mod_dur_of_underlying", "underlying_asset_category", "name_of_underlying",
]
POSITION_MANDATORY = ["portfolio_group", "portfolio_id", "dirty_value_pc"]

# Rating (without + - and blanks) -> credit quality step.
RATING_STEPS = {
    "AAA": "0", "AA": "1", "A": "2", "BBB": "3", "BB": "4", "B": "5", "NR": "NR",
}
WORST_STEP = "6"

# Names that mark a sovereign-like issuer, and its CIC prefix.
SOVEREIGN_NAME_PATTERN = "(?i)EIB|HGB|HTB"
SOVEREIGN_CIC_PREFIX = "HU"

# Asset-allocation prefixes.
ALLOCATION_FX = "645"
ALLOCATION_DEPOSIT = "996"
ALLOCATION_STRATEGIC = "950"
ALLOCATIONS_OUTSIDE_TOTAL = ["995", "645"]

# Cell texts that mean "missing" in the delimited input files.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Fund file header -> column.
TPT_HEADERS = {
    "1_Portfolio_identifying_data": "portfolio_id",
    "6_Valuation_date": "valuation_date",
    "10_Portfolio_modified_duration": "portfolio_mod_dur",
    "11_Complete_SCR_delivery": "scr_delivery",
    "12_CIC_code_of_the_instrument": "cic_of_underlying",
    "13_Economic_zone_of_the_quotation_place": "economic_zone",
    "14_Identification_code_of_the_instrument": "id_of_underlying",
    "17_Instrument_name": "name_of_underlying",
    "21_Quotation_currency_(A)": "qc_of_underlying",
    "26_Valuation_weight": "valuation_weight",
    "39_Maturity_date": "maturity_date",
    "59_Credit_quality_step": "cqs",
    "90_Modified_duration_to_maturity_date": "mod_dur_of_underlying",
    "131_Underlying_asset_category": "underlying_asset_category",
}

# Asset-list header -> column.
ASSET_HEADERS = {
    "Portfolio": "portfolio_group",
    "Security ID": "portfolio_id",
    "Analysis date": "analysis_date",
    "Security name": "security_name",
    "Coun- try": "country",
    "Solvency2 WP Rating": "rating",
    "CIC Code": "cic_of_instrument",
    "Asset Allocation 5. Ebene": "asset_allocation",
    "Currency": "currency",
    "Expected maturity date": "exp_maturity_date",
    "Balance nominal/number": "balance_nominal",
    "Modified duration YTM": "modified_duration",
    "Dirty value PC": "dirty_value_pc",
}

# Unit-linked-list header -> column.
UL_HEADERS = {
    "Portfolio group": "portfolio_group",
    "Security ID": "portfolio_id",
    "Analysis date": "analysis_date",
    "Security name": "security_name",
    "Coun- try": "country",
    "Solvency2 WP Rating": "rating",
    "CIC Code": "cic_of_instrument",
    "Asset Allocation 5. Ebene": "asset_allocation",
    "Quotation currency": "currency",
    "Maturity date": "exp_maturity_date",
    "Balance nominal/number": "balance_nominal",
    "Modified duration YTM": "modified_duration",
    "Dirty value RC": "dirty_value_pc",
}

# Calculation-matrix column of each module, and the types a
# module adds by itself.  Currency reads the concentration column.
MODULE_FLAG_COLUMN = {
    "equity": "Equity Risk",
    "interest": "Interest rate risk",
    "spread": "Spread Risk",
    "currency": "Concentration Risk",
    "concentration": "Concentration Risk",
    "property": "Property Risk",
}
MODULE_EXTRA_TYPES = {
    "equity": ["3S"],
    "interest": ["1X"],
    "spread": ["1X"],
    "currency": ["1X", "3S", "FX"],
    "concentration": ["1X", "3S"],
    "property": [],
}

# Reporting months, curve terms and days of a mean year.
QUARTER_MONTHS = [3, 6, 9, 12]
FIRST_TERM = 1
LAST_TERM = 150
DAYS_PER_YEAR = 365.2425
BASE_CURRENCY = "HUF"
EURO = "EUR"
