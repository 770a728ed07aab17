"""Expressions over file names and directory-listing text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Names that are listed but carry no series data.
SKIP_FILES = ("pr.contacts", "pr.txt")

# One file row of the listing page (timestamp, size, href, name)
# and the publisher host the hrefs are relative to.
LISTING_ENTRY_PATTERN = (
    r'(\d+/\d+/\d{4}\s+\d+:\d+\s+[AP]M)\s+(\d+)\s+'
    r'<[Aa]\s+[Hh][Rr][Ee][Ff]="(/pub/time\.series/pr/[^"]+)">([^<]+)</[Aa]>'
)
DEFAULT_BASE_URL = "https://download.bls.gov"

CATEGORIES = ("current", "backfill", "series", "enrichment")


def strip_ws(c: Column) -> Column:
    """Strip all leading/trailing whitespace (tabs and newlines too, not only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def classify(filename: Column) -> Column:
    """Landing category of a file name, NULL for names on the skip list.

    ``pr.data.<x>.Current`` -> current, ``pr.data.<x>.AllData`` -> backfill
    (at least four dot-separated parts), ``pr.series`` -> series, anything
    else -> enrichment.
    """
    parts = F.split(filename, r"\.")
    is_data = (F.size(parts) >= 4) & (F.element_at(parts, 1) == "pr") & (F.element_at(parts, 2) == "data")
    last = F.element_at(parts, -1)
    return (F.when(filename.isNull() | filename.isin(*SKIP_FILES), F.lit(None).cast("string"))
             .when(is_data & (last == "Current"), F.lit("current"))
             .when(is_data & (last == "AllData"), F.lit("backfill"))
             .when(filename == "pr.series", F.lit("series"))
             .otherwise(F.lit("enrichment")))
