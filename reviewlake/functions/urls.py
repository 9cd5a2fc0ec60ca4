"""URL functions."""

from __future__ import annotations

import sys
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from . import text

# Fixed values.
DEFAULT_START_URL = "https://es.trustpilot.com/review/sending.es"
REVIEW_BASE_URL = "https://es.trustpilot.com/review/"
SITE_HOST_MARK = "trustpilot."
COMPANY_IN_PATH = r"(?i)/review/([^/?#]+)"

# scheme, authority, path, ?query, query, #fragment. Expression instead of
# parse_url(): that one gives up on a blank or user info inside the URL.
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _SPLIT, group)


def authority(url: Column) -> Column:
    return _part(url, 2)


def is_site_host(url: Column) -> Column:
    """True if the URL lies on the review site itself."""
    return F.contains(F.lower(authority(url)), F.lit(SITE_HOST_MARK))


def company_from_url(url: Column) -> Column:
    """``/review/<company>`` from the path, else the host."""
    named = F.regexp_extract(_part(url, 3), COMPANY_IN_PATH, 1)
    company = F.coalesce(text.blank_to_null(named), authority(url))
    return text.safe_filename_component(F.replace(company, F.lit("www."), F.lit("")))


def review_url(company_or_url: Column) -> Column:
    """The start URL for a company name, a domain or a URL."""
    s = text.norm(company_or_url)
    bare = ~F.contains(s, F.lit(".")) & ~F.contains(s, F.lit("/")) & ~F.contains(s, F.lit("\\"))
    site = F.when(bare, F.concat(F.lit("www."), s, F.lit(".com"))).otherwise(s)
    return (
        F.when(s == "", F.lit(DEFAULT_START_URL))
        .when(F.rlike(s, F.lit(r"(?i)^https?://")), s)
        .otherwise(F.concat(F.lit(REVIEW_BASE_URL), site))
    )


def output_name(start_url: Column, company: Column | None = None) -> Column:
    """Name of a company's review file, after the company or else its URL."""
    by_url = company_from_url(start_url)
    if company is not None:
        given = F.when(company != "", text.safe_filename_component(company))
        by_url = F.coalesce(given, by_url)
    return F.concat(F.lit(text.OUTPUT_PREFIX), by_url, F.lit(".csv"))


def _decode(c: Column) -> Column:
    # A "%" that starts no escape stands for itself.
    return F.url_decode(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(c: Column) -> Column:
    # url_encode() spares "*" and escapes "~"; query strings want the reverse.
    out = F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A"))
    return F.replace(out, F.lit("%7E"), F.lit("~"))


def _plus_one(number: Column) -> Column:
    """The text of an integer of any length, raised by one."""
    size = F.regexp_replace(number, "^[+-]?0*", "")

    def step(rolling: str, rolled: str, by: int) -> Column:
        # The last digit that does not roll over changes, the ones after it roll.
        head = F.regexp_replace(size, f"{rolling}+$", "")
        count = F.length(size) - F.length(head)
        last = (F.right(head, F.lit(1)).cast("int") + by).cast("string")
        front = F.substring(head, F.lit(1), F.length(head) - 1)
        changed = F.when(head == "", F.lit("1" if by > 0 else "")).otherwise(F.concat(front, last))
        return F.concat(changed, F.repeat(F.lit(rolled), count))

    lower = F.regexp_replace(step("0", "9", -1), "^0+", "")
    below_zero = F.startswith(number, F.lit("-")) & (size != "")
    return F.when(
        below_zero, F.when(lower == "", F.lit("0")).otherwise(F.concat(F.lit("-"), lower))
    ).otherwise(step("9", "0", 1))


def increment_page(url: Column) -> Column:
    """The URL with ``page`` raised by one; a missing ``page`` counts as 1.

    Empty parameters go, of repeated ones the first stays, and a ``page`` that is
    not a number gives null.
    """
    pairs = F.filter(
        F.split(_part(url, 4), "&"), lambda p: F.rlike(p, F.lit(r"^[^=]*=."))
    )
    pairs = F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.regexp_replace(p, r"^[^=]*=", "")).alias("v"),
        ),
    )
    first_of_key = F.filter(
        pairs, lambda p, i: F.array_position(pairs["k"], p["k"]) == i + 1
    )
    page = F.get(F.filter(first_of_key, lambda p: p["k"] == "page"), F.lit(0))["v"]
    digits = F.replace(text.strip(page), F.lit("_"), F.lit(""))
    following = F.when(page.isNull(), F.lit("2")).when(
        F.rlike(text.strip(page), F.lit(r"^[+-]?\d+(?:_\d+)*$")), _plus_one(digits)
    )
    with_page = F.when(
        page.isNull(),
        F.concat(
            first_of_key,
            F.array(F.struct(F.lit("page").alias("k"), F.lit("1").alias("v"))),
        ),
    ).otherwise(first_of_key)
    query = F.array_join(
        F.transform(
            with_page,
            lambda p: F.concat(
                _encode(p["k"]),
                F.lit("="),
                F.when(p["k"] == "page", following).otherwise(_encode(p["v"])),
            ),
        ),
        "&",
    )
    before = F.regexp_extract(url, r"^([^?#]*)", 1)
    scheme = F.regexp_extract(before, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    before = F.concat(F.lower(scheme), F.substring(before, F.length(scheme) + 1, F.length(before)))
    fragment = _part(url, 5)
    return F.when(
        following.isNotNull(),
        F.concat(
            before,
            F.lit("?"),
            query,
            F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
        ),
    )


def _join(base: str | None, href: str | None) -> str | None:
    if base is None or href is None:
        return None
    try:
        return urljoin(base, href)
    except ValueError:
        return ""


def _resolve(base: pa.Array, href: pa.Array) -> pa.Array:
    return pa.array(
        [_join(b, h) for b, h in zip(base.to_pylist(), href.to_pylist())], pa.string()
    )


# References that need no rules: absolute ones, and paths from the root, both without
# dot segments, bare query marks and the like.
_PLAIN_PATH = r"(?:/[A-Za-z0-9_~%-][A-Za-z0-9_.~%-]*)+/?(?:\?[A-Za-z0-9_.~%&=+-]+)?"
_PLAIN_HOST = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"


def _resolved(base: Column, href: Column) -> Column:
    """``urljoin``; the plain cases, which are most, without Python."""
    origin = F.regexp_extract(base, rf"^(https?://{_PLAIN_HOST})(?:[/?#]|$)", 1)
    absolute = F.rlike(href, F.lit(rf"^https?://{_PLAIN_HOST}(?:{_PLAIN_PATH})?$")) & base.isNotNull()
    rooted = F.rlike(href, F.lit(rf"^{_PLAIN_PATH}$")) & (origin != "")
    plain = F.coalesce(absolute | rooted, F.lit(False))
    rest = F.arrow_udf(_resolve, "string")(F.when(~plain, base), F.when(~plain, href))
    return F.when(absolute, href).when(rooted, F.concat(origin, href)).otherwise(rest)


def resolve_url(base: Column, href: Column) -> Column:
    """A link of a page as an absolute URL; null if it cannot be one."""
    return text.blank_to_null(_resolved(base, href))


def follow(base: Column, href: Column) -> Column:
    """The link, or without one the URL with its page raised."""
    # Asks whether there is a link of the resolved one, so that `href`, which
    # may be costly to find, is not worked out again.
    resolved = _resolved(base, href)
    return F.when(resolved.isNull(), increment_page(base)).otherwise(
        text.blank_to_null(resolved)
    )


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
