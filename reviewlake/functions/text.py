"""Text, identifier and rating functions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Fixed values.
SKIP_PHRASES = ["write your review", "escribe tu reseña", "escribe tu review"]
DEFAULT_FILE_COMPONENT = "reviews"
DEFAULT_SLUG = "empresa"
OUTPUT_PREFIX = "trustpilot_reviews_"
REVIEW_ID_IN_URL = r"/Review/[^/]+/([A-Za-z0-9]+)$"
UNSAFE_IN_FILE_NAME = r"[^A-Za-z0-9._-]+"
STRIPPED_FROM_FILE_NAME = "._-"
NUMBER_OUT_OF = r"(?i)([0-9]+(?:\.[0-9]+)?)(?U:\s*)(?:out of|/)(?U:\s*)([0-9]+)"
FIRST_NUMBER = r"([0-9]+(?:\.[0-9]+)?)"
ID_FINGERPRINT = "id::"
TEXT_FINGERPRINT = "ab::"
FINGERPRINT_SEPARATOR = "|"
FINGERPRINT_CHARS = 200

# Unicode white space, control separators included. Spark's own \s and trim()
# know only ASCII, and (?U)\s misses U+001C..U+001F. Single low characters and one
# range around the high ones keep the test of an ordinary character short.
_WS_HIGH = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS_NO_BLANK = (
    rf"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0[\x{{1680}}-\x{{3000}}&&[{_WS_HIGH}]]"
)
_WS = rf"[ {_WS_NO_BLANK}]"
# Runs that are not already one plain blank, so clean text costs no rewriting.
_WS_TO_COLLAPSE = rf"[{_WS_NO_BLANK}]{_WS}*| {_WS}+"
_WS_CHARS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

_FLOAT = (
    r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*)(?:\.(?:\d+(?:_\d+)*)?)?(?:e[+-]?\d+(?:_\d+)*)?"
    r"|\.\d+(?:_\d+)*(?:e[+-]?\d+(?:_\d+)*)?|inf|infinity|nan)$"
)


def strip(c: Column) -> Column:
    """Remove white space, Unicode included, from both ends."""
    return F.btrim(c, F.lit(_WS_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse(c: Column) -> Column:
    """One blank per white-space run, none at the ends."""
    return F.trim(F.regexp_replace(c, _WS_TO_COLLAPSE, " "))


def normalize_text(c: Column) -> Column:
    """Collapsed text; nothing left -> null."""
    return blank_to_null(collapse(c))


def norm(c: Column) -> Column:
    """Stripped text, with null as the empty text."""
    return strip(F.coalesce(c, F.lit("")))


def clean_review_id(c: Column) -> Column:
    """The bare id out of ``.../Review/<site>/<id>``; anything else unchanged."""
    found = F.regexp_extract(c, REVIEW_ID_IN_URL, 1)
    return F.coalesce(blank_to_null(found), blank_to_null(c))


def upper_company(c: Column) -> Column:
    return F.upper(c)


def company_from_path(file_name: Column) -> Column:
    """Company out of a review file's (URL-encoded) name."""
    decoded = F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))
    return company_from_slug(F.regexp_replace(decoded, r"\.csv$", ""))


def company_from_slug(stem: Column) -> Column:
    return upper_company(F.replace(stem, F.lit(OUTPUT_PREFIX), F.lit("")))


def _strip_marks(c: Column) -> Column:
    return F.btrim(c, F.lit(STRIPPED_FROM_FILE_NAME))


def safe_filename_component(c: Column) -> Column:
    kept = F.regexp_replace(norm(c), UNSAFE_IN_FILE_NAME, "_")
    return F.coalesce(blank_to_null(_strip_marks(kept)), F.lit(DEFAULT_FILE_COMPONENT))


def slugify_company(c: Column) -> Column:
    words = F.regexp_replace(norm(c), rf"{_WS}+", "_")
    kept = F.regexp_replace(words, UNSAFE_IN_FILE_NAME, "_")
    return F.coalesce(blank_to_null(F.lower(_strip_marks(kept))), F.lit(DEFAULT_SLUG))


def has_call_to_action(*parts: Column) -> Column:
    """True if the joined, lower-cased text invites the reader to write a review."""
    lowered = F.array(F.lower(F.concat_ws(" ", *parts)))
    # The one-element array gives the text a name, so it is lower-cased once.
    return F.exists(
        lowered,
        lambda t: reduce(or_, [F.contains(t, F.lit(phrase)) for phrase in SKIP_PHRASES]),
    )


def rating_float(c: Column) -> Column:
    """Text as a number where the whole text is one; ``4,5`` or ``4.5d`` -> null."""
    text = strip(c)
    number = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(F.rlike(text, F.lit(_FLOAT)), number.try_cast("double"))


def rating_out_of(c: Column) -> Column:
    """The rating in ``4 out of 5`` or ``3.5/5``."""
    return F.regexp_extract(c, NUMBER_OUT_OF, 1).try_cast("double")


def rating_first_number(c: Column) -> Column:
    """The first number in the text."""
    return F.regexp_extract(c, FIRST_NUMBER, 1).try_cast("double")


def author_name(author: Column, is_object: Column, name: Column) -> Column:
    """An author object counts by its name, a plain author by its text."""
    return F.when(is_object, name).otherwise(author)


def fingerprint(review_id: Column, author: Column, body: Column) -> Column:
    """``id::<id>``, or a digest of author and opening text for rows without id."""
    person = F.lower(F.coalesce(author, F.lit("")))
    opening = F.substring(F.lower(F.coalesce(body, F.lit(""))), 1, FINGERPRINT_CHARS)
    said = F.sha1(F.concat(person, F.lit(FINGERPRINT_SEPARATOR), opening))
    return F.when(review_id != "", F.concat(F.lit(ID_FINGERPRINT), review_id)).otherwise(
        F.concat(F.lit(TEXT_FINGERPRINT), said)
    )
