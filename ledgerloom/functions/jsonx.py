"""JSON text from models: extraction, strict checks against the label schema, and numeric-aware equality.

Checks run on VARIANT, since reading into typed structs would coerce what should fail.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# The closed sets of the label schema.
CATEGORIES = ("Food", "Drinks", "Groceries", "Transport", "Shopping", "Entertainment", "Bills", "Health", "Education", "Personal", "Gifts", "Income", "Other")
TYPES = ("expense", "income")
CURRENCIES = ("INR", "USD")
FIELDS = ("amount", "currency", "item", "category", "type")

TRANSACTIONS = "array<struct<amount:double,currency:string,item:string,category:string,type:string>>"


#: A quoted text, escapes heeded, closed or not; or a brace.
_MARK = re.compile(r'"(?:[^"\\]|\\.)*+"?|[{}]', re.DOTALL)


@F.arrow_udf(StringType())
def _first_object(column: pa.Array) -> pa.Array:
    """The first balanced {...} of a text. Quotes are heeded from the first character on; braces that close more than was
    opened count, so what opens after them isn't the outermost."""

    def scan(text: str | None) -> str | None:
        depth, start = 0, -1
        for m in _MARK.finditer(text or ""):
            if m[0] == "{":
                if depth == 0:
                    start = m.start()
                depth += 1
            elif m[0] == "}":
                depth -= 1
                if depth == 0 and start >= 0:
                    return text[start : m.end()]
        return None

    return pa.array([scan(t) for t in column.to_pylist()], pa.string())


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def json_value(text: Column) -> Column:
    """A text that is one JSON value, as VARIANT; else null. Spark's parser stops behind the first value and heeds nothing
    after it; only with nothing after it can both a bracket and a brace close the value."""
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    closed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return F.when((F.size(alone) == 1) & closed, F.get(alone, F.lit(0)))


def _object(text: Column) -> Column:
    """The text if it is a JSON object."""
    return F.when(_is_object(json_value(text)), text)


def extract_json(text: Column) -> Column:
    """The JSON object in a model's answer, as text: the whole answer, else what a fence around the whole of it holds,
    else the first balanced braces; null if none is an object."""
    bare = F.regexp_replace(text, "^\\s+|\\s+$", "")
    whole = _object(bare)
    fenced = _object(F.nullif(F.regexp_extract(bare, "(?s)\\A```(?:json)?\\s*(.*?)\\s*```\\s*\\z", 1), F.lit("")))
    open_ = F.when(whole.isNull() & fenced.isNull(), text)  # the scan sees no text that is settled
    return F.coalesce(whole, fenced, _object(_first_object(open_)))


def keys(v: Column) -> Column:
    return F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))


#: The label schema, as far as checks go: kinds of values, closed sets, least lengths.
LABEL = {
    "type": "object", "required": ["transactions"], "additionalProperties": False,
    "properties": {"transactions": {"type": "array", "minItems": 1, "items": {
        "type": "object", "required": list(FIELDS), "additionalProperties": False,
        "properties": {
            "amount": {"type": "number"}, "currency": {"type": "string", "enum": list(CURRENCIES)}, "category": {"type": "string", "enum": list(CATEGORIES)},
            "type": {"type": "string", "enum": list(TYPES)}, "item": {"type": "string", "minLength": 1},
        },
    }}},
}
VIOLATIONS = ArrayType(StructType([StructField("code", StringType()), StructField("path", StringType())]))
_KINDS = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool), "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}
_MISSING = object()


def compile_schema(schema: dict) -> Callable[[Column], Column]:
    """A JSON schema (type, required, properties, additionalProperties false, items, minItems, enum of texts, minLength)
    as a function from a VARIANT to its violations, an array of (code, path) in the order: type, required,
    additionalProperties or minItems, then properties or items. A null VARIANT is no value of any type.

    The schema is compiled to one checker that walks a value once; Arrow brings it batches of values as JSON. Lambdas over
    VARIANT say the same, but Spark interprets them: they took ten times as long."""
    check = _checker(schema)

    @F.arrow_udf(VIOLATIONS)
    def violations(column: pa.Array) -> pa.Array:
        out = []
        for text in column.to_pylist():
            found: list[dict] = []
            check(_MISSING if text is None else json.loads(text), "", found)
            out.append(found)
        return pa.array(out, _FOUND)

    return lambda v: violations(F.to_json(v))


_FOUND = pa.list_(pa.struct([("code", pa.string()), ("path", pa.string())]))


def _checker(schema: dict) -> Callable[[object, str, list], None]:
    """Adds a value's violations, found at a path, to a list."""
    fits = _KINDS[schema["type"]] if "type" in schema else lambda v: True
    required, closed = schema.get("required", []), schema.get("additionalProperties") is False
    inner = {name: _checker(s) for name, s in schema.get("properties", {}).items()}
    item = _checker(schema["items"]) if "items" in schema else None
    least, shortest, allowed = schema.get("minItems", 0), schema.get("minLength", 0), schema.get("enum")

    def check(value: object, path: str, out: list) -> None:
        add = lambda code: out.append({"code": code, "path": path})
        if not fits(value):
            add("type")
        elif isinstance(value, dict):
            for name in required:
                if name not in value:
                    add("required")
            if closed and any(name not in inner for name in value):
                add("additionalProperties")
            for name, own in inner.items():
                if name in value:
                    own(value[name], f"{path}/{name}", out)
        elif isinstance(value, list):
            if len(value) < least:
                add("minItems")
            if item:
                for i, v in enumerate(value):
                    item(v, f"{path}/{i}", out)
        if allowed is not None and not (isinstance(value, str) and value in allowed):
            add("enum")
        if isinstance(value, str) and len(value) < shortest:
            add("minLength")

    return check


def schema_errors(v: Column) -> Column:
    """Violations of the label schema in order, as array of (code, path); empty for a valid label. A null v is not an
    object."""
    return _LABEL_ERRORS(v)


_LABEL_ERRORS = compile_schema(LABEL)


def first_bucket(errors: Column) -> Column:
    """`schema:code@path` of the first violation: the path without its leading slash, `<root>` for the label itself. A
    field that lacks is filed under the object that lacks it."""
    def named(first: Column) -> Column:
        path = F.regexp_replace(first["path"], "^/", "")
        return F.concat(F.lit("schema:"), first["code"], F.lit("@"), F.when(path == "", "<root>").otherwise(path))

    return F.get(F.transform(F.slice(errors, 1, 1), named), F.lit(0))


def transactions(v: Column) -> Column:
    """Typed transactions of a valid label."""
    return F.try_variant_get(v, "$.transactions", TRANSACTIONS)


def equal_labels(a: Column, b: Column) -> Column:
    """Whether two typed lists of transactions are equal, in order; 100 and 100.0 are."""
    return a.eqNullSafe(b)


def tool_or_text(blocks: Column, use_tool: bool = True) -> Column:
    """From an array of (type, text, input) blocks: the first tool input if wanted and there, else the first text."""
    tool = F.get(F.filter(blocks, lambda b: b["type"] == "tool_use"), F.lit(0))["input"]
    text = F.get(F.filter(blocks, lambda b: b["type"] == "text"), F.lit(0))["text"]
    return F.coalesce(tool, text) if use_tool else text


def label_grammar() -> str:
    """A grammar for constrained decoding of labels, one rule a line."""
    words = lambda values: " | ".join(f'"\\"{v}\\""' for v in values)
    return "\n".join(
        (
            'root ::= "{" ws "\\"transactions\\":" ws "[" ws (txn ("," ws txn)*)? "]" ws "}"',
            'txn ::= "{" ws "\\"amount\\":" ws number "," ws "\\"currency\\":" ws currency "," ws "\\"item\\":" ws string "," ws "\\"category\\":" ws category "," ws "\\"type\\":" ws type ws "}"',
            f"currency ::= {words(CURRENCIES)}",
            f"category ::= {words(CATEGORIES)}",
            f"type ::= {words(TYPES)}",
            'number ::= "-"? [0-9]+ ("." [0-9]+)?',
            'string ::= "\\"" ([^"\\\\] | "\\\\" .)* "\\""',
            "ws ::= [ \\t\\n]*",
        )
    )
