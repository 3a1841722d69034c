"""Facts, submissions and forms on small documents."""

import json

from finlake.sources import filings as sf


def doc(spark, *payloads):
    return spark.createDataFrame([("0000000001", "T", p) for p in payloads], "cik string, ticker string, payload string")


def fact(end, val, fp="FY", form="10-K", filed="2024-02-01", **kw):
    return {"end": end, "val": val, "fp": fp, "form": form, "filed": filed, "accn": "1-2-3", **kw}


def test_first_concept_is_chosen_per_company(spark):
    facts = {"facts": {"us-gaap": {
        "RevenueFromContractWithCustomerExcludingAssessedTax": {"units": {"USD": [fact("2023-12-31", 10)]}},
        "Revenues": {"units": {"USD": [fact("2022-12-31", 7), fact("2023-12-31", 9)]}},
        "NetIncomeLoss": {"units": {"USD": [fact("2022-12-31", 1), fact("2022-12-31", 2), fact("2023-06-30", 5, fp="Q4"), fact("2023-06-30", 5, form="8-K")]}}}}}
    out = {r.period_end: r for r in sf.financials_from_facts(doc(spark, json.dumps(facts))).collect()}
    assert set(out) == {"2022-12-31", "2023-12-31"}
    assert out["2023-12-31"].revenue == 10.0 and out["2022-12-31"].revenue is None and out["2022-12-31"].net_income == 2.0


def test_foreign_taxonomy_and_amendment(spark):
    facts = {"facts": {"us-gaap": {}, "ifrs-full": {"Assets": {"units": {"EUR": [fact("2023-12-31", 4, form="20-F"), fact("2023-12-31", 5, form="20-F/A", filed="2024-09-01")]}}}}}
    out = sf.financials_from_facts(doc(spark, json.dumps(facts), "not json")).collect()
    assert [(r.form_type, r.total_assets) for r in out] == [("20-F", 4.0)]


def test_submissions_pad_short_arrays(spark):
    p = {"filings": {"recent": {"form": ["8-K", "4"], "accessionNumber": ["0001-24-1"], "filingDate": ["2024-01-02", ""], "items": ["1.01, 9.99,"], "isXBRL": [1]}}}
    f = sf.filings_from_submissions(doc(spark, json.dumps(p)))
    got = {r.form_type: r for r in f.collect()}
    assert got["4"].accession_number == "" and got["4"].filing_url == "" and got["4"].filed_date is None and got["4"].is_xbrl is False
    assert got["8-K"].filing_url.endswith("/1/0001241/")
    items = sorted((r.item_code, r.item_description) for r in sf.explode_items(f).collect())
    assert items == [("1.01", "Material Agreement"), ("9.99", "Unknown")]


def test_insider_form_values(spark):
    tx = "<transactionAmounts><transactionShares><value>{s}</value></transactionShares><transactionPricePerShare><value>{p}</value></transactionPricePerShare></transactionAmounts>"
    xml = ("<ownershipDocument><periodOfReport>2024-01-05</periodOfReport><reportingOwner><reportingOwnerId><rptOwnerName>First</rptOwnerName></reportingOwnerId></reportingOwner>"
           "<reportingOwner><reportingOwnerId><rptOwnerName>Second</rptOwnerName></reportingOwnerId></reportingOwner><nonDerivativeTable><nonDerivativeTransaction><transactionCoding><transactionCode>P</transactionCode></transactionCoding>"
           + tx.format(s="1,500", p="2") + "</nonDerivativeTransaction><nonDerivativeTransaction>" + tx.format(s="10", p="0") + "</nonDerivativeTransaction></nonDerivativeTable></ownershipDocument>")
    out = sorted(sf.insider_from_xml(doc(spark, xml, "<broken")).collect(), key=lambda r: r.shares)
    assert [(r.shares, r.value, r.transaction_type, r.reporter_name) for r in out] == [(10.0, None, "other", "First"), (1500.0, 3000.0, "buy", "First")]


def test_ownership_html(spark):
    html = "<p>NAME OF REPORTING PERSON:</p> Big Fund, L.P. <b>2 CHECK</b> AGGREGATE AMOUNT BENEFICIALLY OWNED 1,234,567 PERCENT OF CLASS 5.1%"
    out = sf.holders_from_html(doc(spark, html, "<p>none</p>")).collect()
    assert [(r.holder_name, r.shares_held, r.class_percent) for r in out] == [("Big Fund, L.P.", 1234567.0, 5.1)]
