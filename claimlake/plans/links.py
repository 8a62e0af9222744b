"""Download catalogue (JB5): classify anchors into claim-file kinds (FI3, FI4).

Rules, in order, with ``t`` = the anchor text split on single spaces:
  1. no text first child, or fewer than 5 tokens  -> fallback;
  2. ``t[4] == 'Beneficiary'``                     -> beneficiary;
  3. ``t[-3] == 'Inpatient'``                      -> inpatient;
  4. ``t[-3] == 'Outpatient'``                     -> outpatient;
  5. ``t[-3] == 'Prescription'``                   -> drug_events (absolute href);
  6. otherwise                                     -> ignored (no fallback).
Fallback: the second child's text between '(' and ')' is exactly 'ZIP' ->
the archive is fetched and classified by its file name (FI4): '_'-token 5
'Inpatient' / 'Outpatient', else token 3 'Beneficiary', else nothing.
Anchors whose first token is 'DE1.0' lead to the per-sample pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.text import (path_basename, path_restem, split_token,
                                      text_in_parens, token_count)
from claimlake.sources.html import site_of

# Tokens that mark sample pages, file kinds and archives.
SAMPLE_PAGE_TOKEN = "DE1.0"
KIND_TOKENS = [("Inpatient", "inpatient"), ("Outpatient", "outpatient"),
               ("Prescription", "drug_events")]
BENEFICIARY_TOKEN = "Beneficiary"
ARCHIVE_MARK = "ZIP"


def link_kind(text: Column, child1: Column) -> Column:
    """FI3: kind of an anchor, or 'zip_fallback' / 'ignored'."""
    t4 = split_token(text, 4)
    t_3 = split_token(text, -3)
    fallback = F.when(F.coalesce(text_in_parens(child1) == ARCHIVE_MARK, F.lit(False)),
                      F.lit("zip_fallback")).otherwise(F.lit("ignored"))
    rule = F.when(t4 == BENEFICIARY_TOKEN, F.lit("beneficiary"))
    for token, kind in KIND_TOKENS:
        rule = rule.when(t_3 == token, F.lit(kind))
    rule = rule.otherwise(F.lit("ignored"))
    return F.when(text.isNull() | (token_count(text) < 5), fallback).otherwise(rule)


def filename_kind(name: Column) -> Column:
    """FI4: kind of a claims file from its '_'-separated name, or null."""
    t5 = split_token(name, 5, "_")
    t3 = split_token(name, 3, "_")
    return (F.when(t5 == "Inpatient", F.lit("inpatient"))
            .when(t5 == "Outpatient", F.lit("outpatient"))
            .when(t3 == BENEFICIARY_TOKEN, F.lit("beneficiary")))


def is_sample_page_link(text: Column) -> Column:
    return F.coalesce(split_token(text, 0) == SAMPLE_PAGE_TOKEN, F.lit(False))


def download_catalogue(anchors: DataFrame) -> DataFrame:
    """JB5: every anchor with its kind, absolute URL and target file names."""
    kind = link_kind(F.col("text"), F.col("child1"))
    fname = path_basename(F.col("href"))
    a = anchors.withColumn("link_kind", kind).withColumn("file_name", fname)
    final_kind = F.when(F.col("link_kind") == "zip_fallback", filename_kind(F.col("file_name"))) \
        .when(F.col("link_kind") == "ignored", F.lit(None).cast("string")) \
        .otherwise(F.col("link_kind"))
    url = F.when(F.col("link_kind") == "drug_events", F.col("href")) \
        .otherwise(F.concat(site_of(F.col("url")), F.col("href")))
    return a.select(
        "page_id", "href", "text", "child1", "link_kind",
        is_sample_page_link(F.col("text")).alias("sample_page"),
        final_kind.alias("table_kind"),
        url.alias("download_url"),
        "file_name",
        path_restem(F.col("file_name"), ".parquet").alias("parquet_name"),
    )


def catalogue_from_index(pages: DataFrame, index_url: str) -> DataFrame:
    """JB5 with the two-level walk: only pages linked from ``index_url`` by a
    'DE1.0 ...' anchor are sample pages, and only their anchors are classified.

    The walk is a join of the index page's anchor targets with the page table
    (a semi-join), so it runs over any number of stored pages.
    """
    from claimlake.sources.html import page_anchors
    index_anchors = page_anchors(pages.where(F.col("url") == index_url))
    targets = (index_anchors.where(is_sample_page_link(F.col("text")))
               .select(F.concat(site_of(F.col("url")), F.col("href")).alias("target")).distinct())
    sample_pages = pages.join(targets, pages["url"] == targets["target"], "left_semi")
    return download_catalogue(page_anchors(sample_pages))
