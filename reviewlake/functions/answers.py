"""Reading the labeler's answers: strict JSON with three required keys."""

from __future__ import annotations

import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from ..schema import LABEL_COLS

ANSWER_TYPE = ", ".join(f"{name}: string" for name in [*LABEL_COLS, "error"])
ANSWER_TYPE = f"struct<{ANSWER_TYPE}>"
_ANSWER_ARROW = pa.struct([pa.field(n, pa.string()) for n in [*LABEL_COLS, "error"]])

# Fixed values.
NOT_JSON = "No se pudo parsear a JSON: "
QUOTED_CHARS = 300
MISSING = "Faltan campos obligatorios: "

_REQUIRED = list(LABEL_COLS)
_OUTER_BRACES = re.compile(r"\{.*\}", re.DOTALL)


def coerce_json(answer: str):
    """The answer as JSON, else its widest ``{...}``; ValueError if neither is."""
    answer = answer.strip()
    braces = _OUTER_BRACES.search(answer)
    for candidate in [answer] + ([braces.group()] if braces else []):
        try:
            return json.loads(candidate)
        except (ValueError, RecursionError):
            pass
    raise ValueError(f"{NOT_JSON}{answer[:QUOTED_CHARS]}...")


def missing_keys(data: dict) -> list[str]:
    return sorted(set(_REQUIRED) - set(data))


def read_answer(answer: str | None) -> dict:
    """The three labels, or the reason why there are none."""
    try:
        data = coerce_json(answer or "")
        if not isinstance(data, dict):
            raise ValueError(f"No es un objeto JSON: {type(data).__name__}")
        missing = missing_keys(data)
        if missing:
            raise ValueError(f"{MISSING}{missing}")
    except ValueError as ex:
        return {"error": str(ex).encode("utf-8", "replace").decode()}
    return {name: _label(data[name]) for name in _REQUIRED}


def _label(value) -> str | None:
    if value is None:
        return None
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    # JSON may hold half a surrogate pair, which is no text a table can store.
    return text.encode("utf-8", "replace").decode()


def _answers(answers: pa.Array) -> pa.Array:
    return pa.array([read_answer(a.as_py()) for a in answers], _ANSWER_ARROW)


def parse_answer(answer: Column) -> Column:
    """Struct of the three labels and ``error`` (null if the answer is sound)."""
    return F.arrow_udf(_answers, ANSWER_TYPE)(answer)


def _missing(answers: pa.Array) -> pa.Array:
    found = []
    for answer in answers:
        try:
            data = coerce_json(answer.as_py() or "")
        except ValueError:
            data = None
        found.append(missing_keys(data) if isinstance(data, dict) else None)
    return pa.array(found, pa.list_(pa.string()))


def missing_fields(answer: Column) -> Column:
    """The required keys that the answer's object lacks; null if there is no object."""
    return F.arrow_udf(_missing, "array<string>")(answer)


def has_required_fields(answer: Column) -> Column:
    """True if the answer is an object with all label keys; their values may be null."""
    return F.coalesce(F.size(missing_fields(answer)) == 0, F.lit(False))


def missing_fields_error(answer: Column) -> Column:
    """Message naming the missing label keys, sorted; null if none or no object."""
    missing = missing_fields(answer)
    return F.when(
        F.size(missing) > 0,
        F.concat(F.lit(MISSING + "['"), F.array_join(missing, "', '"), F.lit("']")),
    )


# The helpers travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
