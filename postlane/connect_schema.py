"""Driver-side reading of JSON record schemas into Spark types."""

from __future__ import annotations

import base64
import binascii
import json
import math
import struct as packing
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of the public JSON schema format for records.
SCALARS: dict[str, T.DataType] = {
    "boolean": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}


class SchemaError(ValueError):
    """The text is not a usable record schema."""


@dataclass(frozen=True)
class Node:
    """One level of a schema: its Spark type plus what Spark types cannot say."""

    type: T.DataType
    kind: str
    optional: bool = False
    default: Any = None
    fields: tuple[tuple[str, "Node"], ...] = ()
    item: "Node | None" = None

    def has_default(self) -> bool:
        children = [node for _, node in self.fields] + ([self.item] if self.item else [])
        return self.default is not None or any(child.has_default() for child in children)


def read_schema(text: str) -> Node:
    """Translate schema text; anything that is not a valid schema is a SchemaError."""
    stripped = text.strip()
    if not (stripped.startswith("{") and stripped.endswith("}")):
        raise SchemaError("the schema must be a JSON object")
    try:
        return _node(json.loads(stripped))
    except json.JSONDecodeError as problem:
        raise SchemaError(f"the schema is not JSON: {problem}") from problem


def connect_schema(text: str) -> T.DataType:
    """The Spark type a schema text stands for."""
    return read_schema(text).type


def _node(spec: Any) -> Node:
    if not isinstance(spec, dict):
        raise SchemaError(f"expected a schema object, found {spec!r}")
    kind = spec.get("type")
    optional = spec.get("optional", False)
    if not isinstance(optional, bool):
        raise SchemaError("'optional' must be true or false")
    default = spec.get("default")
    if isinstance(kind, str) and kind in SCALARS:
        return Node(SCALARS[kind], kind, optional, default)
    if kind == "array":
        item = _node(spec.get("items"))
        return Node(T.ArrayType(item.type), kind, optional, default, (), item)
    if kind == "map":
        keys = _node(spec.get("keys"))
        if keys.kind != "string":
            raise SchemaError("only maps with string keys can be read from a JSON object")
        item = _node(spec.get("values"))
        return Node(T.MapType(keys.type, item.type), kind, optional, default, (), item)
    if kind == "struct":
        listed = spec.get("fields")
        if not isinstance(listed, list):
            raise SchemaError("a struct schema needs a list of fields")
        fields = []
        for entry in listed:
            name = entry.get("field") if isinstance(entry, dict) else None
            if not isinstance(name, str):
                raise SchemaError("every struct field needs a name")
            fields.append((name, _node(entry)))
        if len({name for name, _ in fields}) < len(fields):
            raise SchemaError("a struct schema names a field twice")
        struct = T.StructType([T.StructField(name, node.type) for name, node in fields])
        return Node(struct, kind, optional, default, tuple(fields))
    raise SchemaError(f"unknown schema type: {kind}")


def breaks_schema(value: Column, node: Node) -> Column:
    """True where a value lacks something its schema requires, at any depth."""
    inside = F.lit(False)
    if node.kind == "struct":
        for name, child in node.fields:
            inside = inside | breaks_schema(value[name], child)
    elif node.kind == "array":
        inside = F.exists(value, lambda entry: breaks_schema(entry, node.item))
    elif node.kind == "map":
        inside = F.exists(F.map_values(value), lambda entry: breaks_schema(entry, node.item))
    missing_is_fine = node.optional or node.default is not None
    return F.when(value.isNull(), F.lit(not missing_is_fine)).otherwise(inside)


def fill_defaults(value: Column, node: Node) -> Column:
    """Put the schema's default where a value is missing."""
    if not node.has_default():
        return value
    if node.kind not in ("struct", "array", "map"):
        return F.coalesce(value, F.lit(node.default).cast(node.type))
    if node.default is not None:
        value = F.coalesce(value, F.from_json(F.lit(json.dumps(node.default)), node.type))
    if node.kind == "struct":
        filled = F.struct(*[fill_defaults(value[name], child).alias(name) for name, child in node.fields])
        return F.when(value.isNotNull(), filled)
    if node.kind == "array":
        return F.transform(value, lambda entry: fill_defaults(entry, node.item))
    return F.transform_values(value, lambda _, entry: fill_defaults(entry, node.item))


def conform(value: Any, node: Node) -> str:
    """JSON text of one parsed value of a schema met at run time, or a SchemaError.

    Defaults are filled in. Numbers of kind float are rounded to 32 bits, and they and those of
    kind double are written with an exponent, which VARIANT reads as a double. Bytes are checked and
    stay base64 text. Numbers that are not finite do not fit.
    """
    if value is None:
        if node.default is not None:
            return conform(node.default, node)
        if node.optional:
            return "null"
        raise SchemaError(f"null for a required {node.kind}")
    wanted = {"struct": dict, "map": dict, "array": list, "boolean": bool}.get(node.kind)
    if wanted is not None and not isinstance(value, wanted):
        raise SchemaError(f"{value!r} is not {node.kind}")
    if node.kind == "struct":
        return _object((name, conform(value.get(name), child)) for name, child in node.fields)
    if node.kind == "map":
        return _object((key, conform(entry, node.item)) for key, entry in value.items())
    if node.kind == "array":
        return "[" + ",".join(conform(entry, node.item) for entry in value) + "]"
    if node.kind.startswith("int"):
        bits = int(node.kind[3:])
        if type(value) is not int or not -(1 << bits - 1) <= value < 1 << bits - 1:
            raise SchemaError(f"{value!r} is not {node.kind}")
    elif node.kind in ("float", "double"):
        return _real(value, node.kind)
    elif node.kind == "bytes":
        try:
            base64.b64decode(value, validate=True)
        except (TypeError, ValueError, binascii.Error) as problem:
            raise SchemaError(f"{value!r} is not base64") from problem
    elif node.kind == "string" and not isinstance(value, str):
        value = json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    return json.dumps(value)


def _object(fields) -> str:
    return "{" + ",".join(f"{json.dumps(name)}:{text}" for name, text in fields) + "}"


def _real(value: Any, kind: str) -> str:
    if type(value) not in (int, float):
        raise SchemaError(f"{value!r} is not {kind}")
    try:
        number = float(value)
        if kind == "float":
            number = packing.unpack("<f", packing.pack("<f", number))[0]
    except OverflowError as problem:
        raise SchemaError(f"{value!r} is too large for {kind}") from problem
    if not math.isfinite(number):
        raise SchemaError(f"{value!r} is not finite")
    text = repr(number)
    return text if "e" in text else f"{text}e0"
