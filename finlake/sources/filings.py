"""Company-filing payloads: facts, submissions, insider and ownership forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import lookup
from finlake.functions.lookups import (
    CONCEPTS, REPORT_ITEMS, STATEMENT_FORMS, STATEMENT_PERIODS, TRANSACTION_TYPES,
)
from finlake.operators.dedup import dedup_periods
from finlake.schemas import COMPANY_FACTS, INSIDER_FORM, OWNERSHIP_FORM, SUBMISSIONS

# Filing archive address and the three patterns of old ownership forms.
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"
HOLDER_NAME = r"(?i)NAME OF REPORTING PERSON[S]?\s*[:\-]?\s*([A-Z][\w\s,\.&]+?)(?:\d|\n|CHECK)"
HOLDER_SHARES = r"(?i)AGGREGATE AMOUNT[^:]*?(\d[\d,]+)"
HOLDER_PERCENT = r"(?i)PERCENT OF CLASS[^:]*?([\d.]+)\s*%?"


def filing_url(cik: Column, accession: Column) -> Column:
    """Index page of a filing; '' without an accession number."""
    path = F.concat(F.lit(ARCHIVE + "/"), F.regexp_replace(cik, "^0+", ""), F.lit("/"),
                    F.regexp_replace(accession, "-", ""), F.lit("/"))
    return F.when(F.coalesce(accession, F.lit("")) == "", F.lit("")).otherwise(path)


def _number(c: Column, junk: str = ",") -> Column:
    return F.regexp_replace(c, f"[{junk}]", "").try_cast("double")


# ---- company facts ----------------------------------------------------------------

def _concept_table(df: DataFrame) -> DataFrame:
    rows = [(field, i, concept, p) for i, (field, cs) in enumerate(CONCEPTS.items()) for p, concept in enumerate(cs)]
    return df.sparkSession.createDataFrame(rows, "field string, field_no int, concept string, priority int")


def explode_facts(df: DataFrame, payload: str = "payload", cik: str = "cik") -> DataFrame:
    """Facts documents -> one row per reported fact.

    The domestic taxonomy is used unless it is missing or empty, then the international
    one.  ``ord`` is the place of the fact inside its concept.
    """
    d = df.select(F.col(cik).alias("cik"), F.from_json(payload, COMPANY_FACTS)["facts"].alias("f"))
    local, foreign = F.try_element_at("f", F.lit("us-gaap")), F.try_element_at("f", F.lit("ifrs-full"))
    d = d.select("cik", F.explode(F.when(F.size(local) > 0, local).otherwise(foreign)).alias("concept", "_c"))
    d = d.select("cik", "concept", F.posexplode("_c.units").alias("_u", "unit", "_facts"))
    d = d.select("cik", "concept", "_u", F.posexplode("_facts").alias("_i", "_x"))
    return d.select("cik", "concept", (F.col("_u").cast("long") * 1_000_000_000 + F.col("_i")).alias("ord"), "_x.*")


def financials_from_facts(df: DataFrame, payload: str = "payload", cik: str = "cik") -> DataFrame:
    """One row per (company, period end, fiscal period) with every known line item.

    For each line item the first listed concept the company ever reported is used for all
    of its periods.  Period details come from the first fact of the period, values from
    the last.  The concept list is a fixed table of about a hundred rows, so it is
    broadcast.
    """
    facts = explode_facts(df, payload, cik).join(F.broadcast(_concept_table(df)), "concept")
    key = ["cik", F.col("end").alias("period_end"), F.col("fp").alias("fiscal_period"), F.col("form").alias("form_type")]
    first = F.struct("field_no", "ord", "start", "filed", "accn")
    per_item = facts.groupBy(*key, "field", "priority").agg(
        F.min(first).alias("_first"), F.max(F.struct("ord", "val")).alias("_last"))
    # After the aggregate a company and line item has one row per period and concept, a
    # few hundred at most, so the best concept can be found in a window.
    best = F.min("priority").over(W.partitionBy("cik", "field"))
    per_item = per_item.withColumn("_best", best).filter(F.col("priority") == F.col("_best"))
    per_item = per_item.filter(F.col("form_type").isin(*STATEMENT_FORMS) & F.col("fiscal_period").isin(*STATEMENT_PERIODS)
                               & (F.coalesce("period_end", F.lit("")) != ""))
    ids = ["cik", "period_end", "fiscal_period", "form_type"]
    fields = [f for f, cs in CONCEPTS.items() if cs]
    wide = per_item.groupBy(*ids).agg(
        F.min("_first").alias("_m"), *[F.max(F.when(F.col("field") == f, F.col("_last.val"))).alias(f) for f in fields])
    wide = wide.select(*ids, F.col("_m.start").alias("period_start"), F.col("_m.filed").alias("filed_date"),
                       F.col("_m.accn").alias("accession_number"), *fields)
    return dedup_periods(wide)


def shape_financials(df: DataFrame, tickers: DataFrame, source: str = "sec_edgar") -> DataFrame:
    """Typed ``financials`` rows; ``tickers`` maps cik to ticker."""
    d = df.join(tickers.select("ticker", "cik"), "cik")
    fields = [f for f in CONCEPTS if f in df.columns]
    return d.select(
        "ticker", "cik", F.col("period_start").try_cast("date").alias("period_start"),
        F.col("period_end").try_cast("date").alias("period_end"),
        F.substring("period_end", 1, 4).alias("fiscal_year"), "fiscal_period", "form_type",
        F.col("filed_date").try_cast("date").alias("filed_date"), "accession_number",
        *[F.col(f).cast("double").alias(f) for f in fields],
        filing_url(F.col("cik"), F.col("accession_number")).alias("filing_url"), F.lit(source).alias("source"))


# ---- submissions ------------------------------------------------------------------

def filings_from_submissions(df: DataFrame, payload: str = "payload", source: str = "sec_edgar") -> DataFrame:
    """Parallel arrays -> one row per form; short arrays count as missing values."""
    d = df.select("ticker", "cik", F.from_json(payload, SUBMISSIONS)["filings"]["recent"].alias("r"))
    parts = ("form", "accessionNumber", "filingDate", "reportDate", "primaryDocument", "primaryDocDescription",
             "items", "isXBRL")
    d = d.select("ticker", "cik", F.size("r.form").alias("_n"),
                 F.posexplode(F.arrays_zip(*[F.coalesce(F.col(f"r.{p}"), F.array()).alias(p) for p in parts])).alias("_i", "x"))
    d = d.filter(F.col("_i") < F.col("_n"))
    blank = lambda c: F.nullif(F.col(f"x.{c}"), F.lit(""))
    accession = F.coalesce("x.accessionNumber", F.lit(""))
    return d.select(
        "ticker", "cik", accession.alias("accession_number"), F.col("x.form").alias("form_type"),
        blank("filingDate").try_cast("date").alias("filed_date"), blank("reportDate").try_cast("date").alias("report_date"),
        F.coalesce("x.primaryDocument", F.lit("")).alias("primary_doc"),
        F.col("x.primaryDocDescription").alias("primary_doc_desc"), blank("items").alias("items"),
        F.coalesce(F.col("x.isXBRL") != 0, F.lit(False)).alias("is_xbrl"),
        filing_url(F.col("cik"), accession).alias("filing_url"), F.lit(source).alias("source"))


def explode_items(filings: DataFrame) -> DataFrame:
    """Current reports -> one row per item code with its description."""
    d = filings.filter(F.col("form_type").isin("8-K", "8-K/A") & F.col("items").isNotNull())
    d = d.withColumn("item_code", F.explode(F.split("items", ","))).withColumn("item_code", F.trim("item_code"))
    d = d.filter(F.col("item_code") != "")
    return d.select("ticker", "cik", "accession_number", "filed_date", "report_date", "item_code",
                    F.coalesce(lookup("item_code", REPORT_ITEMS), F.lit("Unknown")).alias("item_description"),
                    "primary_doc", "filing_url", "source")


# ---- insider forms ----------------------------------------------------------------

def _amount(path: str) -> Column:
    """Amount given as a nested value element or as direct text."""
    return F.coalesce(F.col(f"{path}.value"), F.col(f"{path}._VALUE"))


def _flag(path: str) -> Column:
    return F.coalesce(F.lower(F.trim(F.col(path))).isin("true", "1", "yes"), F.lit(False))


def insider_from_xml(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Insider form -> one row per transaction of both tables; unreadable forms give none."""
    d = df.select(*keep, F.from_xml(payload, INSIDER_FORM).alias("x"))
    owner = F.get("x.reportingOwner", F.lit(0))
    d = d.select(*keep, "x", owner.alias("o"))
    tagged = F.concat(
        F.transform(F.coalesce("x.nonDerivativeTable.nonDerivativeTransaction", F.array()),
                    lambda t: F.struct(F.lit(False).alias("der"), t.alias("t"))),
        F.transform(F.coalesce("x.derivativeTable.derivativeTransaction", F.array()),
                    lambda t: F.struct(F.lit(True).alias("der"), t.alias("t"))))
    d = d.select(*keep, "x", "o", F.explode(tagged).alias("e"))
    shares = _number(_amount("e.t.transactionAmounts.transactionShares"))
    price = _number(_amount("e.t.transactionAmounts.transactionPricePerShare"))
    code = F.coalesce("e.t.transactionCoding.transactionCode", F.lit(""))
    rel = "o.reportingOwnerRelationship"
    return d.select(
        *keep, F.col("x.periodOfReport").try_cast("date").alias("report_date"),
        F.col("o.reportingOwnerId.rptOwnerCik").alias("reporter_cik"),
        F.coalesce("o.reportingOwnerId.rptOwnerName", F.lit("")).alias("reporter_name"),
        F.col(f"{rel}.officerTitle").alias("reporter_title"), _flag(f"{rel}.isOfficer").alias("is_officer"),
        _flag(f"{rel}.isDirector").alias("is_director"), _flag(f"{rel}.isTenPercentOwner").alias("is_ten_pct_owner"),
        F.coalesce(_amount("e.t.securityTitle"), F.lit("")).alias("security_title"), code.alias("transaction_code"),
        F.coalesce(lookup(code, TRANSACTION_TYPES), F.lit("other")).alias("transaction_type"),
        F.col("e.der").alias("is_derivative"), F.coalesce(shares, F.lit(0.0)).alias("shares"), price.alias("price"),
        F.when((shares != 0) & (price != 0), shares * price).alias("value"),
        F.coalesce(_amount("e.t.transactionAmounts.transactionAcquiredDisposedCode"), F.lit("")).alias("acquired_or_disposed"),
        _number(_amount("e.t.postTransactionAmounts.sharesOwnedFollowingTransaction")).alias("shares_owned_after"),
        F.coalesce(_amount("e.t.ownershipNature.directOrIndirectOwnership"), F.lit("D")).alias("ownership_type"))


# ---- ownership forms --------------------------------------------------------------

def holders_from_xml(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Structured ownership form -> holder row; namespaces are ignored."""
    d = df.select(*keep, F.from_xml(payload, OWNERSHIP_FORM, {"ignoreNamespace": "true"}).alias("x"))
    d = d.withColumn("p", F.get("x.formData.coverPageHeaderReportingPersonDetails", F.lit(0))).filter(F.col("p").isNotNull())
    own, item4 = "p.reportingPersonBeneficiallyOwnedNumberOfShares", "x.formData.items.item4"
    num = lambda path: _number(F.col(path), ",%")
    total = num("p.reportingPersonBeneficiallyOwnedAggregateNumberOfShares")
    share = num("p.classPercent")
    event = F.col("x.formData.coverPageHeader.eventDateRequiresFilingThisStatement")
    amendment = F.col("x.formData.coverPageHeader.amendmentNo")
    us_date = F.try_to_timestamp(event, F.lit("M/d/yyyy")).cast("date")
    return d.select(
        *keep, F.col("x.headerData.filerInfo.filer.filerCredentials.cik").alias("holder_cik"),
        F.coalesce("p.reportingPersonName", F.lit("")).alias("holder_name"),
        F.coalesce("p.typeOfReportingPerson", F.lit("")).alias("holder_type"),
        F.col("x.formData.items.item2.principalBusinessOfficeOrResidenceAddress").alias("holder_address"),
        F.coalesce(total, num(f"{item4}.amountBeneficiallyOwned"), F.lit(0.0)).alias("shares_held"),
        F.coalesce(share, F.when(total.isNull(), num(f"{item4}.classPercent"))).alias("class_percent"),
        num(f"{own}.soleVotingPower").alias("sole_voting_power"), num(f"{own}.sharedVotingPower").alias("shared_voting_power"),
        num(f"{own}.soleDispositivePower").alias("sole_dispositive"),
        num(f"{own}.sharedDispositivePower").alias("shared_dispositive"),
        F.when(event.contains("/"), us_date).otherwise(event.try_cast("date")).alias("event_date"),
        amendment.try_cast("int").alias("amendment_number"),
        (F.coalesce(amendment, F.lit("")) != "").alias("is_amendment"))


def plain_text(html: Column) -> Column:
    """Tags to spaces, then runs of white space to one space."""
    return F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " ")


def holders_from_html(df: DataFrame, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Old ownership form -> whatever name, share count and percent can be found."""
    d = df.select(*keep, plain_text(F.col(payload)).alias("t"))
    found = lambda pattern: F.nullif(F.trim(F.regexp_extract("t", pattern, 1)), F.lit(""))
    d = d.select(*keep, found(HOLDER_NAME).alias("_name"), _number(found(HOLDER_SHARES)).alias("_shares"),
                 found(HOLDER_PERCENT).try_cast("double").alias("class_percent"))
    d = d.filter(F.col("_name").isNotNull() | (F.coalesce("_shares", F.lit(0.0)) != 0))
    return d.select(*keep, F.coalesce("_name", F.lit("")).alias("holder_name"),
                    F.coalesce("_shares", F.lit(0.0)).alias("shares_held"), "class_percent")
