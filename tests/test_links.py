"""Anchor extraction and link classification rules (FIXTURES section 8)."""
from pyspark.sql import functions as F

from claimlake.plans.links import download_catalogue, link_kind
from claimlake.sources.html import page_anchors

RULES = [
    ("DE1.0 Sample 1", None, "ignored"),
    ("DE1.0 Sample 1 2008 Beneficiary Summary File", None, "beneficiary"),
    ("DE1.0 Sample 1 2008-2010 Inpatient Claims Sample", None, "inpatient"),
    ("DE1.0 Sample 1 2008-2010 Outpatient Claims Sample", None, "outpatient"),
    ("DE1.0 Sample 1 2008-2010 Prescription Drug Events", None, "drug_events"),
    ("Inpatient Claims Sample", None, "ignored"),
    ("Claims file", " (ZIP, 4MB)", "ignored"),
    ("Claims file", " (ZIP)", "zip_fallback"),
    ("a b c d e f g", " (ZIP)", "ignored"),
    (None, " (ZIP)", "zip_fallback"),
]


def test_link_kind_rules(spark):
    df = spark.createDataFrame([(t, c) for t, c, _ in RULES], "text string, child1 string")
    got = [r[0] for r in df.select(link_kind(F.col("text"), F.col("child1"))).collect()]
    assert got == [k for _, _, k in RULES]


def test_anchor_children(spark):
    html = ('<p><a href="/a">Plain text</a> <a class="x" href="/b.zip"><b>Sample</b> (ZIP)</a>'
            '<a href="/c"></a><a href="/d">Start<i>x</i> tail</a></p>')
    pages = spark.createDataFrame([(1, "https://site.example.org/x/y", html)], "page_id long, url string, html string")
    got = [tuple(r) for r in page_anchors(pages).select("href", "text", "child1").collect()]
    assert got == [("/a", "Plain text", None), ("/b.zip", None, " (ZIP)"), ("/c", None, None), ("/d", "Start", None)]


def test_catalogue_urls_and_file_kinds(spark):
    rows = [(1, "https://www.example.org/p", "/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_2.zip", "Claims file", " (ZIP)"),
            (1, "https://www.example.org/p", "https://files.example.org/DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_1.zip",
             "DE1.0 Sample 1 2008-2010 Prescription Drug Events", None),
            (1, "https://www.example.org/p", "/f/DE1_0_2009_Beneficiary_Summary_File_Sample_2.zip", None, " (ZIP)")]
    a = spark.createDataFrame(rows, "page_id long, url string, href string, text string, child1 string")
    got = {r.href: r for r in download_catalogue(a).collect()}
    inp = got["/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_2.zip"]
    assert inp.table_kind == "inpatient"
    assert inp.download_url == "https://www.example.org/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_2.zip"
    assert inp.parquet_name == "DE1_0_2008_to_2010_Inpatient_Claims_Sample_2.parquet"
    drug = got[rows[1][2]]
    assert drug.table_kind == "drug_events" and drug.download_url == rows[1][2] and drug.sample_page
    assert got["/f/DE1_0_2009_Beneficiary_Summary_File_Sample_2.zip"].table_kind == "beneficiary"


def test_catalogue_follows_index_links_only(spark):
    from claimlake.plans.links import catalogue_from_index
    site = "https://www.example.org"
    pages = spark.createDataFrame([
        (1, f"{site}/index", '<a href="/s1">DE1.0 Sample 1</a> <a href="/other">Something else</a>'),
        (2, f"{site}/s1", '<a href="/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.zip">'
                          'DE1.0 Sample 1 2008-2010 Inpatient Claims Sample</a>'),
        (3, f"{site}/other", '<a href="/f/DE1_0_2008_to_2010_Outpatient_Claims_Sample_1.zip">'
                             'DE1.0 Sample 1 2008-2010 Outpatient Claims Sample</a>'),
    ], "page_id long, url string, html string")
    rows = catalogue_from_index(pages, f"{site}/index").collect()
    assert [(r.page_id, r.table_kind) for r in rows] == [(2, "inpatient")]
    assert rows[0].download_url == f"{site}/f/DE1_0_2008_to_2010_Inpatient_Claims_Sample_1.zip"
