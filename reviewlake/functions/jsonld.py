"""Structured data (JSON-LD) of a page."""

from __future__ import annotations

import json
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from .arrow import udf_in_parts

# A comment, or a whole script or style element; whichever starts first hides
# the marks of the others inside it. One that is not closed goes on to the end of
# the page, so the page is scanned once.
_QUOTED_ATTRS = r"""(?:[^>"']++|"[^"]*+(?:"|\z)|'[^']*+(?:'|\z))*+"""
_RAW = (
    rf"(?s)<!--.*?(?:-->|\z)|<(?i:(script|style))\b{_QUOTED_ATTRS}"
    r"(?:>.*?(?:</(?i:\1)\s*+>|\z)|\z)"
)
_HEAD = rf"(?s)^<(?i:script)\b({_QUOTED_ATTRS})>"
_BODY = rf"(?s)^<(?i:script)\b{_QUOTED_ATTRS}>(.*)</(?i:script)\s*+>$"
_PLUS = r"(?:\+|&#43;|&(?i:#x2b);|&plus;)"
_TYPE = (
    rf"""\s(?i:type)\s*=\s*(?:"application/ld{_PLUS}json"|'application/ld{_PLUS}json'"""
    rf"""|application/ld{_PLUS}json(?=[\s/]|$))"""
)

NODE_TYPE = (
    "array<struct<type: string, url: string, id: string, name: string, body: string,"
    " rating: string, author: string, author_is_object: boolean, author_name: string,"
    " date: string>>"
)
_NODE_FIELDS = [
    pa.field("type", pa.string()),
    pa.field("url", pa.string()),
    pa.field("id", pa.string()),
    pa.field("name", pa.string()),
    pa.field("body", pa.string()),
    pa.field("rating", pa.string()),
    pa.field("author", pa.string()),
    pa.field("author_is_object", pa.bool_()),
    pa.field("author_name", pa.string()),
    pa.field("date", pa.string()),
]


def scripts(html: Column) -> Column:
    """Bodies of the JSON-LD scripts, in page order."""
    # Most pages have none; they are spared the element scan.
    page = F.when(F.contains(html, F.lit("application/ld")), html)
    raw = F.regexp_extract_all(page, F.lit(_RAW), F.lit(0))
    structured = F.filter(
        raw, lambda e: F.rlike(F.regexp_extract(e, _HEAD, 1), F.lit(_TYPE))
    )
    bodies = F.transform(structured, lambda e: F.regexp_extract(e, _BODY, 1))
    return F.coalesce(bodies, F.array().cast("array<string>"))


def _objects(data):
    """All objects of a parsed document, parents before their members."""
    todo = [data]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            yield x
            todo += [v for v in reversed(x.values()) if isinstance(v, (dict, list))]
        elif isinstance(x, list):
            todo += reversed(x)


def _text(value) -> str | None:
    # JSON may hold half a surrogate pair, which is no text a table can store.
    return value.encode("utf-8", "replace").decode() if isinstance(value, str) else None


def _number(value) -> str | None:
    try:
        return _text(value) if isinstance(value, str) else repr(float(value))
    except (TypeError, ValueError, OverflowError):
        return None


def _node(obj: dict) -> dict:
    author = obj.get("author")
    rating = obj.get("reviewRating")
    is_object = isinstance(author, dict)
    return {
        "type": _text(obj.get("@type")),
        "url": _text(obj.get("url")),
        "id": _text(obj.get("@id")),
        "name": _text(obj.get("name")),
        "body": _text(obj.get("reviewBody")),
        "rating": _number(rating.get("ratingValue")) if isinstance(rating, dict) else None,
        "author": _text(author),
        "author_is_object": is_object,
        "author_name": _text(author.get("name")) if is_object else None,
        "date": _text(obj.get("datePublished")),
    }


def _payload_nodes(payload: str | None) -> list[dict] | None:
    if payload is None or not payload.strip():
        return None
    try:
        return [_node(obj) for obj in _objects(json.loads(payload))]
    except (ValueError, RecursionError):
        return None


def _nodes(payloads: pa.Array) -> pa.Array:
    return pa.array(
        [_payload_nodes(p.as_py()) for p in payloads], pa.list_(pa.struct(_NODE_FIELDS))
    )


def json_nodes(payload: Column) -> Column:
    """The payload's objects in pre-order, with the members a review can have.

    Null for a blank or invalid payload. Members of another type than expected
    are null.
    """
    return udf_in_parts(_nodes, NODE_TYPE)(payload)


def _page_nodes(pages: pa.Array) -> pa.Array:
    return pa.array(
        [
            [n for p in page.as_py() or () for n in _payload_nodes(p) or ()]
            for page in pages
        ],
        pa.list_(pa.struct(_NODE_FIELDS)),
    )


def page_nodes(payloads: Column) -> Column:
    """``json_nodes`` of all payloads of a page, one after the other."""
    return udf_in_parts(_page_nodes, NODE_TYPE)(payloads)


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
