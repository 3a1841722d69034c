"""Explicit schemas: landed payloads are always read with one, never inferred."""

from __future__ import annotations

# Payloads -------------------------------------------------------------------------

MINUTE_BARS = "t long, o double, h double, l double, c double, v double, vw double, n long"
DAILY_CANDLES = "datetime long, open double, high double, low double, close double, volume double"
GROUPED_DAILY = "T string, o double, h double, l double, c double, v double, vw double, n long"

GREEK_COLUMNS = (
    "delta", "gamma", "theta", "vega", "rho", "vanna", "charm", "vomma", "veta", "epsilon", "lambda",
    "vera", "speed", "zomma", "color", "ultima",
)
OPTION_GREEKS = (
    "symbol string, expiration string, strike double, right string, open double, high double, low double, "
    "close double, volume string, count string, bid double, ask double, bid_size string, ask_size string, "
    + ", ".join(f"`{g}` double" for g in GREEK_COLUMNS)
    + ", implied_vol double, iv_error double, underlying_price double"
)
OPEN_INTEREST = "symbol string, expiration string, strike double, right string, open_interest string"
TRADE_QUOTES = (
    "symbol string, expiration string, strike double, right string, trade_timestamp string, sequence string, "
    "price double, size string, exchange string, condition string, bid double, ask double, bid_size string, "
    "ask_size string"
)
DIVIDENDS = (
    "ticker string, ex_dividend_date string, declaration_date string, record_date string, pay_date string, "
    "cash_amount double, currency string, frequency long, dividend_type string"
)
SPLITS = "ticker string, execution_date string, split_from double, split_to double"
TICKER_DETAILS = (
    "ticker string, name string, type string, primary_exchange string, sic_code string, market_cap double, "
    "description string, homepage_url string, total_employees long, list_date string, cik string, "
    "sic_description string, composite_figi string, address struct<city:string,state:string>"
)
OBSERVATIONS = "series_id string, date string, value string"
COMPANY_FACTS = (
    "facts map<string, map<string, struct<units: map<string, array<struct<"
    "start:string, end:string, val:double, fp:string, form:string, filed:string, accn:string>>>>>>"
)
SUBMISSIONS = (
    "filings struct<recent: struct<form:array<string>, accessionNumber:array<string>, filingDate:array<string>, "
    "reportDate:array<string>, primaryDocument:array<string>, primaryDocDescription:array<string>, "
    "items:array<string>, isXBRL:array<int>>>"
)
_AMOUNT = "struct<_VALUE:string, value:string>"
_TRANSACTION = (
    f"struct<securityTitle:{_AMOUNT}, transactionCoding:struct<transactionCode:string>, "
    f"transactionAmounts:struct<transactionShares:{_AMOUNT}, transactionPricePerShare:{_AMOUNT}, "
    f"transactionAcquiredDisposedCode:{_AMOUNT}>, "
    f"postTransactionAmounts:struct<sharesOwnedFollowingTransaction:{_AMOUNT}>, "
    f"ownershipNature:struct<directOrIndirectOwnership:{_AMOUNT}>>"
)
INSIDER_FORM = (
    "periodOfReport string, issuer struct<issuerTradingSymbol:string>, "
    "reportingOwner array<struct<reportingOwnerId:struct<rptOwnerCik:string, rptOwnerName:string>, "
    "reportingOwnerRelationship:struct<isOfficer:string, isDirector:string, isTenPercentOwner:string, "
    "officerTitle:string>>>, "
    f"nonDerivativeTable struct<nonDerivativeTransaction: array<{_TRANSACTION}>>, "
    f"derivativeTable struct<derivativeTransaction: array<{_TRANSACTION}>>"
)
OWNERSHIP_FORM = (
    "headerData struct<filerInfo:struct<filer:struct<filerCredentials:struct<cik:string>>>>, "
    "formData struct<coverPageHeader:struct<eventDateRequiresFilingThisStatement:string, amendmentNo:string>, "
    "coverPageHeaderReportingPersonDetails:array<struct<reportingPersonName:string, typeOfReportingPerson:string, "
    "reportingPersonBeneficiallyOwnedNumberOfShares:struct<soleVotingPower:string, sharedVotingPower:string, "
    "soleDispositivePower:string, sharedDispositivePower:string>, "
    "reportingPersonBeneficiallyOwnedAggregateNumberOfShares:string, classPercent:string>>, "
    "items:struct<item2:struct<principalBusinessOfficeOrResidenceAddress:string>, "
    "item4:struct<amountBeneficiallyOwned:string, classPercent:string>>>"
)

# Stream messages ------------------------------------------------------------------

_ENVELOPE = "timestamp long, ingested_at long, source string, service string, ticker string"
QUOTE_MESSAGE = _ENVELOPE + (
    ", quote struct<bid:double, ask:double, last:double, bid_size:long, ask_size:long, volume:long, "
    "last_size:long, net_change:double, quote_time:long, trade_time:long>"
)
BAR_MESSAGE = _ENVELOPE + (
    ", ohlcv struct<sequence:long, open:double, high:double, low:double, close:double, volume:long, "
    "chart_time:long, chart_day:long>"
)

# Tables: identity key, version column, time column ----------------------------------

_SERIES = (("date",), "ingested_at", "date")
TABLES: dict[str, tuple[tuple[str, ...], str, str | None]] = {
    "ohlcv": (("ticker", "timestamp"), "ingested_at", "timestamp"),
    "ohlcv_daily": (("ticker", "day"), "ingested_at", "day"),
    "universe": (("ticker",), "updated_at", None),
    "dividends": (("ticker", "ex_dividend_date"), "ingested_at", "ex_dividend_date"),
    "stock_splits": (("ticker", "execution_date"), "ingested_at", "execution_date"),
    "option_chains": (("underlying", "expiration", "strike", "put_call", "snapshot_date"), "ingested_at", "snapshot_date"),
    "option_trades": (("underlying", "trade_date", "expiration", "strike", "put_call", "trade_timestamp", "sequence"),
                      "ingested_at", "trade_date"),
    "financials": (("ticker", "period_end", "fiscal_period"), "ingested_at", "period_end"),
    "sec_filings": (("ticker", "filed_date", "form_type", "accession_number"), "ingested_at", "filed_date"),
    "material_events": (("ticker", "filed_date", "item_code", "accession_number"), "ingested_at", "filed_date"),
    "insider_trades": (("ticker", "report_date", "reporter_name", "transaction_code", "shares"), "ingested_at", "filed_date"),
    "institutional_holders": (("ticker", "filed_date", "holder_name", "accession_number"), "ingested_at", "filed_date"),
    "commodities_ohlcv": (("ticker", "date"), "ingested_at", "date"),
    "commodities_ohlcv_15m": (("ticker", "timestamp"), "ingested_at", "timestamp"),
    "commodities_ohlcv_1h": (("ticker", "timestamp"), "ingested_at", "timestamp"),
    "commodities_ohlcv_4h": (("ticker", "timestamp"), "ingested_at", "timestamp"),
    "zbt_breadth": (("day",), "ingested_at", "day"),
    "algo_feature_matrix": (("date",), "computed_at", "date"),
    **{name: _SERIES for name in (
        "treasury_yields", "inflation", "inflation_expectations", "labor_market", "rates", "macro_daily", "macro_weekly", "macro_monthly",
        "commodity_prices", "eia_petroleum_weekly", "eia_petroleum_monthly")},
}
