"""Cleaning scalars (column expressions; all run inside whole-stage codegen).

Each function takes a column (or column name) and returns a ``Column``; nothing here
touches Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwatch.schemas import PRICE

# ---- fixed values (must equal the source site's conventions) -------------------------
# Star-rating words as they appear in the listing markup, and their star counts.
RATING_WORDS = {"One": 1, "Two": 2, "Three": 3, "Four": 4, "Five": 5}
# Site root and catalogue root used to resolve relative product / next-page links.
SITE_BASE_URL = "https://books.toscrape.com/"
SITE_CATALOGUE_URL = "https://books.toscrape.com/catalogue/"
# Default text for attributes missing from a detail page.
UNKNOWN = "Unknown"
# --------------------------------------------------------------------------------------

# Text that a lenient numeric parser accepts: optional sign, digits with optional
# fraction (or a bare fraction), optional exponent, surrounding blanks. Spark's
# ``try_cast`` alone would also take suffixes like '3d' or '3f'.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rating_word_map() -> Column:
    items = []
    for word, stars in RATING_WORDS.items():
        items += [F.lit(word), F.lit(stars)]
    return F.create_map(*items)


def parse_rating(col: Column | str) -> Column:
    """X1: 'One'..'Five' (case-sensitive) -> 1..5, numeric text -> truncated int, else 0."""
    c = _c(col)
    word = F.try_element_at(rating_word_map(), c).cast("double")
    number = F.when(c.rlike(NUMERIC_TEXT), c.try_cast("double"))
    value = F.coalesce(word, number, F.lit(0.0))
    return F.coalesce(value.try_cast("int"), F.lit(0))


def clean_price(col: Column | str) -> Column:
    """Keep digits and '.', parse as DECIMAL(10,2); unparseable -> NULL (quarantine)."""
    digits = F.regexp_replace(_c(col), r"[^0-9.]", "")
    return digits.try_cast(PRICE)


def clean_stock(col: Column | str) -> Column:
    """Concatenate every digit of the availability text; no digit -> 0."""
    digits = F.regexp_replace(_c(col), r"[^0-9]", "")
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def resolve_product_url(col: Column | str, base: str = SITE_BASE_URL,
                        catalogue: str = SITE_CATALOGUE_URL) -> Column:
    """Relative href containing 'catalogue/' hangs off the site root, else the catalogue."""
    c = _c(col)
    return F.when(c.contains("catalogue/"), F.concat(F.lit(base), c)) \
        .otherwise(F.concat(F.lit(catalogue), c))


def resolve_next_url(col: Column | str, base: str = SITE_BASE_URL,
                     catalogue: str = SITE_CATALOGUE_URL) -> Column:
    """As X4 but tests for 'catalogue' without slash; NULL stays NULL (last page)."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("string")) \
        .when(c.contains("catalogue"), F.concat(F.lit(base), c)) \
        .otherwise(F.concat(F.lit(catalogue), c))


def trimmed(col: Column | str) -> Column:
    """X14."""
    return F.trim(_c(col))


def or_unknown(col: Column | str) -> Column:
    """Missing text attribute -> 'Unknown'."""
    return F.coalesce(_c(col), F.lit(UNKNOWN))


def to_date_text(col: Column | str) -> Column:
    """DATE -> 'YYYY-MM-DD' (lexicographic order equals date order)."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def from_date_text(col: Column | str) -> Column:
    """X12: 'YYYY-MM-DD' -> DATE (invalid text -> NULL)."""
    return F.try_to_date(_c(col), "yyyy-MM-dd")
