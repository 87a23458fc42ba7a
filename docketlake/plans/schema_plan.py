"""A JSON Schema with a ``$metadata`` block, read into what the operators need to know."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

_PRIMITIVES = {"string": T.StringType(), "number": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}
#: Sections that ``$metadata`` may have.
SECTIONS = ("identity", "compilation", "evidence", "output", "severity")


def resolved(node: Mapping, root: Mapping, seen: tuple[str, ...] = ()) -> Mapping:
    """A node with its local ``$ref`` followed; a ring of references is an error."""
    while "$ref" in node:
        ref = node["$ref"]
        if not ref.startswith("#/"):
            raise ValueError(f"only local references are followed: {ref}")
        if ref in seen:
            raise ValueError(f"a ring of references: {ref}")
        seen = (*seen, ref)
        target = root
        for part in ref[2:].split("/"):
            target = target[part.replace("~1", "/").replace("~0", "~")]
        node = {**target, **{k: v for k, v in node.items() if k != "$ref"}}
    return node


def spark_type(node: Mapping, root: Mapping) -> T.DataType:
    """The Spark type of a schema node; unions of several non-null types are text."""
    node = resolved(node, root)
    kinds = node.get("type", "object" if "properties" in node else "string")
    kinds = [k for k in ([kinds] if isinstance(kinds, str) else kinds) if k != "null"]
    if set(kinds) <= {"number", "integer"} and kinds:
        return T.DoubleType() if "number" in kinds else T.LongType()
    if len(kinds) != 1:
        return T.StringType()
    if kinds[0] == "object":
        return T.StructType([T.StructField(k, spark_type(v, root)) for k, v in node.get("properties", {}).items()])
    if kinds[0] == "array":
        return T.ArrayType(spark_type(node.get("items", {}), root))
    return _PRIMITIVES[kinds[0]]


@dataclass
class SchemaPlan:
    """What a schema says: payload type, main and row arrays, keys, titles, evidence and numeric fields."""

    payload: T.StructType
    main: str
    row_array: str | None
    context: list[str]
    item: list[str]
    child: list[str]
    evidence: list[str]
    numeric: list[str]
    titles: dict[str, str]
    uris: set[str]
    keys: list[str] = field(default_factory=list)
    fuzzy: list[str] = field(default_factory=list)
    partition: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        """Output order: context, item without its row array, children; a later name takes the place of an earlier one."""
        return list(dict.fromkeys([*self.context, *self.item, *self.child]))

    @classmethod
    def load(cls, text: str) -> SchemaPlan:
        root = json.loads(text)
        meta = root.get("$metadata", {})
        if unknown := [k for k in meta if k not in SECTIONS]:
            raise ValueError(f"unknown sections of $metadata: {unknown}; known are {list(SECTIONS)}")
        properties = {k: resolved(v, root) for k, v in root["properties"].items()}
        arrays = [k for k, v in properties.items() if v.get("type") == "array" and resolved(v.get("items", {}), root).get("properties")]
        main = meta.get("compilation", {}).get("main") or (arrays[0] if len(arrays) == 1 else None)
        if main is None:
            raise ValueError(f"which array holds the items: {arrays}?")
        item = {k: resolved(v, root) for k, v in resolved(properties[main]["items"], root)["properties"].items()}
        nested = [k for k, v in item.items() if v.get("type") == "array" and resolved(v.get("items", {}), root).get("properties")]
        rows = meta.get("compilation", {}).get("row_array") or (nested[0] if len(nested) == 1 else None)
        if rows is None and nested:
            raise ValueError(f"which array expands the rows: {nested}?")
        child = {k: resolved(v, root) for k, v in resolved(item[rows]["items"], root)["properties"].items()} if rows else {}
        context = {k: v for k, v in properties.items() if k != main}
        own = {k: v for k, v in item.items() if k != rows}
        every = {**context, **own, **child}
        identity = meta.get("identity", {})
        for name in (*identity.get("keys", ()), *identity.get("fuzzy", ()), *identity.get("partition", ())):
            if name not in every:
                raise ValueError(f"identity names an unknown field: {name}")
        number = lambda v: isinstance(spark_type(v, root), (T.DoubleType, T.LongType))
        return cls(
            payload=spark_type(root, root), main=main, row_array=rows, context=list(context), item=list(own), child=list(child),
            evidence=[k for k, v in every.items() if set(v.get("properties", {})) == {"value", "quote"}], numeric=[k for k, v in every.items() if number(v)],
            titles={k: v.get("title", k) for k, v in every.items()}, uris={k for k, v in every.items() if v.get("format") in ("uri", "uri-reference")},
            keys=list(identity.get("keys", ())), fuzzy=list(identity.get("fuzzy", ())), partition=list(identity.get("partition", ())),
        )


def deep_merge(base: Mapping, over: Mapping) -> dict:
    """``over`` upon ``base``: maps merge key by key, everything else is replaced."""
    return {**base, **{k: deep_merge(base[k], v) if isinstance(v, Mapping) and isinstance(base.get(k), Mapping) else v for k, v in over.items()}}


def strict_problems(node: Mapping, path: str = "$") -> list[str]:
    """Where a schema is no strict output schema: objects must close themselves and require all fields."""
    out = []
    if node.get("type") == "object" or "properties" in node:
        if node.get("additionalProperties") is not False:
            out.append(f"{path}: additionalProperties must be false")
        if missing := set(node.get("properties", {})) - set(node.get("required", ())):
            out.append(f"{path}: not required: {sorted(missing)}")
        for k, v in node.get("properties", {}).items():
            out += strict_problems(v, f"{path}.{k}")
    if isinstance(node.get("items"), Mapping):
        out += strict_problems(node["items"], f"{path}[]")
    return out


def payload_problems(value, node: Mapping, root: Mapping, path: str = "$", most: int = 20) -> list[str]:
    """How a value breaks a schema: types, required fields, enums; at most ``most`` lines, without the values."""
    node = resolved(node, root)
    out: list[str] = []
    kinds = node.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds:
        fits = {"null": value is None, "string": isinstance(value, str), "boolean": isinstance(value, bool), "integer": isinstance(value, int) and not isinstance(value, bool), "number": isinstance(value, (int, float)) and not isinstance(value, bool), "array": isinstance(value, list), "object": isinstance(value, dict)}
        if not any(fits[k] for k in kinds):
            return [f"{path}: not {' or '.join(kinds)}"]
    if "enum" in node and value not in node["enum"]:
        out.append(f"{path}: not one of the allowed values")
    if isinstance(value, dict):
        out += [f"{path}.{k}: missing" for k in node.get("required", ()) if k not in value]
        for k, v in value.items():
            if k in node.get("properties", {}):
                out += payload_problems(v, node["properties"][k], root, f"{path}.{k}", most)
            elif node.get("additionalProperties") is False:
                out.append(f"{path}.{k}: unknown")
    if isinstance(value, list) and "items" in node:
        for i, v in enumerate(value):
            out += payload_problems(v, node["items"], root, f"{path}[{i}]", most)
            if len(out) >= most:
                break
    return out[:most]
