"""Fixed values.

These tables are published codes and conventions (exchange codes, form items,
transaction codes, taxonomy concept names, series ids, contract symbols) that have
to be exactly as they are for results to be right.
"""

from __future__ import annotations

# Two-digit industry-code prefixes per sector; anything else is "Other".
SECTOR_PREFIXES: dict[str, tuple[str, ...]] = {
    "Energy": ("10", "12", "13", "14"),
    "Pharma": ("28",),
    "Tech & Electronics": ("35", "36", "37", "38"),
    "Software & Services": ("73",),
    "Financials": ("60", "61", "62", "63", "64", "65", "67"),
    "Telecom & Utilities": ("48", "49"),
    "Retail": ("52", "53", "54", "55", "56", "57", "58", "59"),
    "Food & Beverage": ("20", "21"),
}

# ISO 10383 market identifier code -> exchange name.
EXCHANGES: dict[str, str] = {
    "XNYS": "NYSE", "XNAS": "NASDAQ", "XASE": "NYSE American", "ARCX": "NYSE Arca",
    "BATS": "Cboe BZX", "EDGX": "Cboe EDGX", "IEXG": "IEX", "XPHL": "NASDAQ PSX",
    "XBOS": "NASDAQ BX", "XCHI": "Chicago SE", "OTCM": "OTC Markets", "OOTC": "OTC Markets",
}

# Current-report item code -> description.
REPORT_ITEMS: dict[str, str] = {
    "1.01": "Material Agreement",
    "1.02": "Termination of Material Agreement",
    "1.03": "Bankruptcy/Receivership",
    "1.04": "Mine Safety",
    "2.01": "Acquisition/Disposition Completed",
    "2.02": "Results of Operations",
    "2.03": "Direct Financial Obligation Created",
    "2.04": "Triggering Event (Acceleration)",
    "2.05": "Restructuring/Exit Costs",
    "2.06": "Material Impairments",
    "3.01": "Delisting Notice",
    "3.02": "Unregistered Sales of Equity",
    "3.03": "Material Modification of Rights",
    "4.01": "Change of Accountant",
    "4.02": "Non-Reliance on Prior Financials",
    "5.01": "Change in Control",
    "5.02": "Officer Departure/Appointment",
    "5.03": "Bylaw Amendments",
    "5.04": "Temporary Suspension of Trading",
    "5.05": "Code of Ethics Amendment",
    "5.06": "Change in Shell Status",
    "5.07": "Submission to Security Holders Vote",
    "5.08": "Shareholder Nominations",
    "6.01": "ABS Servicer Info",
    "6.02": "ABS Change of Servicer",
    "6.03": "ABS Change in Credit Enhancement",
    "6.04": "ABS Failure to Distribute",
    "6.05": "ABS Demand on Securities",
    "7.01": "Reg FD Disclosure",
    "8.01": "Other Events",
    "9.01": "Financial Statements and Exhibits",
}

# Insider transaction code -> type; anything else is "other".
TRANSACTION_TYPES: dict[str, str] = {
    "P": "buy", "S": "sell", "M": "exercise", "F": "tax_withhold", "G": "gift",
    "A": "award", "C": "conversion", "D": "disposition_to_issuer", "E": "expiration",
    "H": "expiration", "I": "discretionary", "J": "other", "K": "equity_swap",
    "L": "small_acquisition", "O": "exercise_oom", "U": "disposition_tender",
    "W": "acquisition_will", "X": "exercise_itm", "Z": "deposit_withdrawal",
}

# Filing families by form type; a trailing * means prefix.
FORM_FAMILIES: dict[str, tuple[str, ...]] = {
    "annual": ("10-K", "10-K/A", "20-F", "20-F/A"),
    "quarterly": ("10-Q", "10-Q/A"),
    "event": ("8-K", "8-K/A"),
    "insider": ("4", "3", "5"),
    "institutional": ("SC 13G", "SC 13G/A", "SC 13D", "SC 13D/A",
                      "SCHEDULE 13G", "SCHEDULE 13G/A", "SCHEDULE 13D", "SCHEDULE 13D/A"),
    "registration": ("S-1", "S-1/A", "S-3", "S-3ASR", "S-3/A", "S-8", "S-8 POS", "F-1", "F-3"),
    "prospectus": ("424B*",),
}

# Forms and fiscal periods that carry statements.
STATEMENT_FORMS = ("10-K", "20-F", "10-K/A", "20-F/A", "10-Q", "10-Q/A")
STATEMENT_PERIODS = ("FY", "Q1", "Q2", "Q3")

# Line item -> taxonomy concepts in order of preference.
CONCEPTS: dict[str, tuple[str, ...]] = {
    "revenue": (
        "RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet",
        "SalesRevenueGoodsNet", "RevenueFromContractWithCustomerIncludingAssessedTax",
    ),
    "cost_of_revenue": (
        "CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfGoodsSold",
        "CostOfGoodsAndServiceExcludingDepreciationDepletionAndAmortization",
    ),
    "gross_profit": ("GrossProfit",),
    "operating_expenses": ("OperatingExpenses", "CostsAndExpenses"),
    "operating_income": (
        "OperatingIncomeLoss",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
    ),
    "net_income": ("NetIncomeLoss", "ProfitLoss", "NetIncomeLossAvailableToCommonStockholdersBasic"),
    "basic_eps": ("EarningsPerShareBasic",),
    "diluted_eps": ("EarningsPerShareDiluted",),
    "research_and_dev": (
        "ResearchAndDevelopmentExpense",
        "ResearchAndDevelopmentExpenseExcludingAcquiredInProcessCost",
    ),
    "sga_expenses": ("SellingGeneralAndAdministrativeExpense", "GeneralAndAdministrativeExpense"),
    "income_tax": ("IncomeTaxExpenseBenefit", "IncomeTaxesPaidNet"),
    "interest_expense": ("InterestExpense", "InterestExpenseDebt", "InterestAndDebtExpense"),
    "ebitda": (),
    "total_assets": ("Assets",),
    "current_assets": ("AssetsCurrent",),
    "noncurrent_assets": ("AssetsNoncurrent",),
    "total_liabilities": ("Liabilities",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "noncurrent_liabilities": ("LiabilitiesNoncurrent",),
    "total_equity": (
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ),
    "retained_earnings": ("RetainedEarningsAccumulatedDeficit",),
    "long_term_debt": ("LongTermDebt", "LongTermDebtNoncurrent", "LongTermDebtAndCapitalLeaseObligations"),
    "short_term_debt": ("ShortTermBorrowings", "DebtCurrent", "LongTermDebtCurrent"),
    "cash_and_equivalents": (
        "CashAndCashEquivalentsAtCarryingValue",
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents", "Cash",
    ),
    "inventory": ("InventoryNet", "InventoryFinishedGoodsNetOfReserves"),
    "accounts_receivable": ("AccountsReceivableNetCurrent", "AccountsReceivableNet"),
    "accounts_payable": ("AccountsPayableCurrent", "AccountsPayable"),
    "goodwill": ("Goodwill",),
    "operating_cash_flow": (
        "NetCashProvidedByUsedInOperatingActivities",
        "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
    ),
    "investing_cash_flow": (
        "NetCashProvidedByUsedInInvestingActivities",
        "NetCashProvidedByUsedInInvestingActivitiesContinuingOperations",
    ),
    "financing_cash_flow": (
        "NetCashProvidedByUsedInFinancingActivities",
        "NetCashProvidedByUsedInFinancingActivitiesContinuingOperations",
    ),
    "capex": ("PaymentsToAcquirePropertyPlantAndEquipment", "CapitalExpenditureDiscontinuedOperations"),
    "dividends_paid": ("PaymentsOfDividends", "PaymentsOfDividendsCommonStock", "Dividends"),
    "depreciation_amortization": (
        "DepreciationDepletionAndAmortization", "DepreciationAndAmortization", "Depreciation",
    ),
    "shares_outstanding": ("CommonStockSharesOutstanding", "EntityCommonStockSharesOutstanding"),
    "shares_issued": ("CommonStockSharesIssued",),
    "weighted_avg_shares_basic": (
        "WeightedAverageNumberOfSharesOutstandingBasic",
        "WeightedAverageNumberOfShareOutstandingBasicAndDiluted",
    ),
    "weighted_avg_shares_diluted": (
        "WeightedAverageNumberOfDilutedSharesOutstanding",
        "WeightedAverageNumberOfShareOutstandingBasicAndDiluted",
    ),
    "stock_based_compensation": ("ShareBasedCompensation", "AllocatedShareBasedCompensationExpense"),
    "buyback_shares": (
        "StockRepurchasedAndRetiredDuringPeriodShares", "StockRepurchasedDuringPeriodShares",
        "TreasuryStockSharesAcquired",
    ),
    "buyback_value": (
        "PaymentsForRepurchaseOfCommonStock", "StockRepurchasedAndRetiredDuringPeriodValue",
        "TreasuryStockValueAcquiredCostMethod",
    ),
    "shares_issued_options": ("StockIssuedDuringPeriodSharesStockOptionsExercised",),
    "shares_issued_rsu_vested": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardEquityInstrumentsOtherThanOptionsVestedInPeriod",
    ),
    "unvested_rsu_shares": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardEquityInstrumentsOtherThanOptionsNonvestedNumber",
    ),
    "antidilutive_shares": ("AntidilutiveSecuritiesExcludedFromComputationOfEarningsPerShareAmount",),
    "dividends_per_share": ("CommonStockDividendsPerShareDeclared", "CommonStockDividendsPerShareCashPaid"),
    "issuance_proceeds": ("ProceedsFromIssuanceOfCommonStock", "ProceedsFromStockOptionsExercised"),
    "shares_authorized": ("CommonStockSharesAuthorized",),
    "preferred_shares_authorized": ("PreferredStockSharesAuthorized",),
    "stock_plan_shares_authorized": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardNumberOfSharesAuthorized",
    ),
    "buyback_program_authorized": ("StockRepurchaseProgramAuthorizedAmount1",),
    "warrants_outstanding": ("ClassOfWarrantOrRightOutstanding",),
    "warrant_exercise_price": ("ClassOfWarrantOrRightExercisePriceOfWarrantsOrRights1",),
    "warrant_shares_callable": ("ClassOfWarrantOrRightNumberOfSecuritiesCalledByWarrantsOrRights",),
    "warrants_fair_value": ("WarrantsAndRightsOutstanding",),
    "warrant_proceeds": ("ProceedsFromWarrantExercises",),
    "convertible_debt": ("ConvertibleDebt", "ConvertibleNotesPayable", "ConvertibleLongTermNotesPayable"),
    "convertible_debt_current": ("ConvertibleDebtCurrent", "ConvertibleNotesPayableCurrent"),
    "convertible_conversion_price": ("DebtInstrumentConvertibleConversionPrice1",),
    "convertible_conversion_ratio": ("DebtInstrumentConvertibleConversionRatio1",),
    "convertible_debt_proceeds": ("ProceedsFromConvertibleDebt",),
    "convertible_debt_repayments": ("RepaymentsOfConvertibleDebt",),
    "shares_from_conversion": ("StockIssuedDuringPeriodSharesConversionOfConvertibleSecurities",),
    "options_outstanding": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardOptionsOutstandingNumber",
    ),
    "options_exercisable": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardOptionsExercisableNumber",
    ),
    "options_weighted_avg_price": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardOptionsOutstandingWeightedAverageExercisePrice",
    ),
    "options_intrinsic_value": (
        "ShareBasedCompensationArrangementByShareBasedPaymentAwardOptionsOutstandingIntrinsicValue",
    ),
}

# Economic tables: series id -> column.  Adding a series is adding an entry.
ECONOMIC_TABLES: dict[str, dict[str, str]] = {
    "treasury_yields": {
        "DGS1MO": "yield_1_month", "DGS3MO": "yield_3_month", "DGS1": "yield_1_year",
        "DGS2": "yield_2_year", "DGS5": "yield_5_year", "DGS10": "yield_10_year",
        "DGS30": "yield_30_year",
    },
    "inflation": {
        "CPIAUCSL": "cpi", "CPILFESL": "cpi_core", "PCEPI": "pce", "PCEPILFE": "pce_core",
        "PCE": "pce_spending",
    },
    "inflation_expectations": {
        "T5YIE": "market_5_year", "T10YIE": "market_10_year", "T5YIFR": "forward_years_5_to_10",
        "EXPINF1YR": "model_1_year", "EXPINF5YR": "model_5_year", "EXPINF10YR": "model_10_year",
        "EXPINF30YR": "model_30_year",
    },
    "labor_market": {
        "UNRATE": "unemployment_rate", "CIVPART": "labor_force_participation_rate",
        "CES0500000003": "avg_hourly_earnings", "JTSJOL": "job_openings",
    },
    "rates": {
        "DFF": "fed_funds_rate", "SOFR": "sofr", "DBAA": "baa_yield", "DAAA": "aaa_yield",
        "BAMLH0A0HYM2": "hy_oas", "BAMLC0A0CM": "ig_oas", "DFII10": "tips_10y", "DFII5": "tips_5y",
        "DCPF3M": "commercial_paper_3m", "TB3MS": "tbill_3m",
    },
    "macro_daily": {
        "VIXCLS": "vix", "DTWEXBGS": "usd_index", "T10Y2Y": "yield_curve_10y2y",
        "T10Y3M": "yield_curve_10y3m",
    },
    "macro_weekly": {
        "STLFSI2": "financial_stress", "NFCI": "financial_conditions",
        "MORTGAGE30US": "mortgage_rate_30y", "ICSA": "initial_claims", "CCSA": "continued_claims",
    },
    "macro_monthly": {
        "M2SL": "m2_money_supply", "UMCSENT": "consumer_sentiment", "RSAFS": "retail_sales",
        "PSAVERT": "personal_savings_rate", "RPI": "real_personal_income", "HOUST": "housing_starts",
        "CSUSHPINSA": "case_shiller", "INDPRO": "industrial_production", "TCU": "capacity_utilization",
        "USSLIND": "leading_index", "PAYEMS": "nonfarm_payrolls", "TOTALSA": "auto_sales",
        "BUSLOANS": "bank_lending", "GDPC1": "real_gdp", "USREC": "recession",
        "SAHMREALTIME": "sahm_rule",
    },
}

# Energy tables: series id (or producing region) -> column.
ENERGY_TABLES: dict[str, dict[str, str]] = {
    "commodity_prices": {
        "RWTC": "wti_crude", "RBRTE": "brent_crude", "RNGWHHD": "natural_gas",
        "EMM_EPMR_PTE_NUS_DPG": "gasoline", "EER_EPJK_PF4_RGC_DPG": "heating_oil",
    },
    "eia_petroleum_weekly": {
        "WCRFPUS2": "crude_production", "WCRIMUS2": "crude_imports", "WCREXUS2": "crude_exports",
        "WCESTUS1": "crude_stocks", "WCSSTUS1": "spr_stocks", "WGTSTUS1": "gasoline_stocks",
        "WDISTUS1": "distillate_stocks", "WRPUPUS2": "product_supplied",
        "WGFUPUS2": "gasoline_supplied", "WDIUPUS2": "distillate_supplied",
        "WKJUPUS2": "jet_fuel_supplied", "WPULEUS3": "refinery_utilization",
        "WGIRIUS2": "refinery_inputs",
    },
    "eia_petroleum_monthly": {
        "OPEC": "opec_production", "MCRFPUS2": "us_production", "RUS": "russia_production",
        "SAU": "saudi_production", "IRN": "iran_production", "IRQ": "iraq_production",
        "ARE": "uae_production", "WORL": "world_production",
        "MCRIMUSPG2": "imports_persian_gulf", "MCRIMUSCA2": "imports_canada",
        "MCRIMUSMX2": "imports_mexico", "MCRIMUS2": "imports_total",
    },
}

# Futures symbol -> name.
FUTURES: dict[str, str] = {
    "GC=F": "Gold", "SI=F": "Silver", "PL=F": "Platinum", "PA=F": "Palladium",
    "CL=F": "WTI Crude Oil", "BZ=F": "Brent Crude Oil", "NG=F": "Natural Gas",
    "HO=F": "Heating Oil", "RB=F": "Gasoline (RBOB)", "HG=F": "Copper", "ALI=F": "Aluminum",
    "ZW=F": "Wheat", "ZC=F": "Corn", "ZS=F": "Soybeans", "ZL=F": "Soybean Oil",
    "ZM=F": "Soybean Meal", "KC=F": "Coffee", "SB=F": "Sugar", "CT=F": "Cotton", "CC=F": "Cocoa",
    "OJ=F": "Orange Juice", "LBS=F": "Lumber", "LE=F": "Live Cattle", "HE=F": "Lean Hogs",
    "GF=F": "Feeder Cattle",
}

# Volatility-index regimes: upper bound, name, largest position in percent.
VOLATILITY_REGIMES: tuple[tuple[float, str, float], ...] = (
    (18.0, "calm", 2.0), (28.0, "normal", 2.0), (35.0, "elevated", 1.5), (45.0, "crisis", 1.0),
)
VOLATILITY_SPIKE = ("spike", 0.0)
