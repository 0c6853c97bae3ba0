"""Record contracts: JSON Schema requirements compiled to Columns over VARIANT.

``compile_contract`` turns the ``required``, ``type``, ``format``, ``enum``,
``properties`` and ``items`` of a record schema into one boolean Column per
field and rule; ``violations`` tests every record in one projection and gives
(file, record, field, rule) rows.  A text is parsed once.  Other keywords are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TEXT = {"type": "string"}
_TIME = {"type": "string", "format": "date-time"}

# The exporter's record schema, version 1.0.1 (1.0.0 names two fields differently).
_ENTRY = {"type": "object", "properties": {
    "Identity": _TEXT, "Rights": _TEXT, "Type": _TEXT, "IsInherited": {"type": "boolean"},
    "InheritanceFlags": _TEXT, "PropagationFlags": _TEXT}}
_FIELDS = ("ApplianceHostname", "ApplianceDescription", "ApplianceSerialNumber", "VolumeName", "VolumeGuid", "ShareName", "SharePath")


def exporter_contract(version: str = "1.0.1") -> dict:
    """The record schema of the two exporter versions."""
    path, host = ("UncPath", "CollectionHost") if version == "1.0.1" else ("Path", "Host")
    common = ("Collector", "Owner", "Sddl", "FingerprintSha256", "CollectionSha256")
    properties = {path: _TEXT, "CollectedUtc": _TIME, host: _TEXT, **{f: _TEXT for f in (*common, *(_FIELDS if version == "1.0.1" else ()))},
                  "Attributes": {"type": "array", "items": _TEXT}, "Access": {"type": "array", "items": _ENTRY}}
    return {"type": "object", "properties": properties, "required": [path, "CollectedUtc", host, *common, "Access"]}


@dataclass(frozen=True)
class Rule:
    field: str
    rule: str
    broken: Column


_VARIANT_TYPES = {"string": "STRING", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT", "integer": "BIGINT", "null": "VOID"}
_RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"


def _of_type(value: Column, kind: str) -> Column:
    name = F.schema_of_variant(value)
    if kind == "number":
        return name.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return name.startswith(_VARIANT_TYPES[kind])


def _shape(schema: dict) -> str | None:
    """Type that reads an object's properties at once, or null for another value (None: not expressible)."""
    names = list(schema.get("properties", {}))
    if not names or len({n.lower() for n in names}) < len(names):
        return None
    return "struct<" + ", ".join(f"`{n.replace('`', '``')}`: variant" for n in names) + ">"


def _element_shape(items: dict) -> str | None:
    """The same for the elements of an array; None where a rule needs the element itself."""
    return _shape(items) if items.get("type") == "object" and not {"format", "enum", "items"} & items.keys() else None


def _broken_values(value: Column, schema: dict, field: str, opened: dict[str, Column] | None = None,
                   members: Column | None = None) -> list[Rule]:
    """Rules that a present value of a schema breaks (``broken`` is null or false otherwise).

    ``opened`` holds, by field, columns that ``_open`` has read already; ``members`` is
    the value itself as a struct of its properties, null if it is no object.
    """
    out = []
    opened = opened or {}
    shape = _shape(schema)
    if members is None and shape:
        members = opened.get(field)
        members = F.try_variant_get(value, "$", shape) if members is None else members
    kind = schema.get("type")
    if kind:
        kinds = [kind] if isinstance(kind, str) else kind
        if kinds == ["object"] and members is not None:
            out.append(Rule(field, "type", members.isNull()))
        elif kinds == ["array"]:
            out.append(Rule(field, "type", F.try_variant_get(value, "$", "array<variant>").isNull()))
        else:
            fits = _of_type(value, kinds[0])
            for k in kinds[1:]:
                fits = fits | _of_type(value, k)
            out.append(Rule(field, "type", ~fits))
    if schema.get("format") == "date-time":
        text = F.try_variant_get(value, "$", "string")
        good = text.rlike(_RFC3339) & F.try_to_timestamp(F.upper(text)).isNotNull()
        out.append(Rule(field, "format", (F.schema_of_variant(value) == "STRING") & ~good))
    if "enum" in schema:
        text = F.try_variant_get(value, "$", "string")
        out.append(Rule(field, "enum", ~F.coalesce(text.isin(*map(str, schema["enum"])), F.lit(False))))
    if "properties" in schema:
        is_object = members.isNotNull() if members is not None else F.schema_of_variant(value).startswith("OBJECT")
        for name, sub in schema["properties"].items():
            inner = F.try_variant_get(value, f"$.{name}", "variant") if members is None else members.getField(name)
            path = f"{field}.{name}" if field else name
            if name in schema.get("required", ()):
                out.append(Rule(path, "required", is_object & inner.isNull()))
            out += [Rule(r.field, r.rule, inner.isNotNull() & r.broken) for r in _broken_values(inner, sub, path, opened)]
    if "items" in schema:
        items, of = schema["items"], f"{field}[]"
        shape = _element_shape(items)
        elements = opened.get(of)
        if elements is None:
            elements = F.try_variant_get(value, "$", f"array<{shape or 'variant'}>")

        def of_element(x: Column) -> list[Rule]:
            return _broken_values(x, items, of, members=x if shape else None)

        def any_element(k: int) -> Column:
            return F.exists(elements, lambda x: F.coalesce(of_element(x)[k].broken, F.lit(False)))

        out += [Rule(r.field, r.rule, any_element(k)) for k, r in enumerate(of_element(F.lit(None)))]
    return out


def compile_contract(schema: dict, value: Column, opened: dict[str, Column] | None = None) -> list[Rule]:
    """One rule per field and keyword of ``schema``, as Columns over the record's VARIANT."""
    return _broken_values(value, schema, "", opened)


def _open(rows: DataFrame, value: Column, schema: dict) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with one column for each object and array of the schema, read once from its VARIANT.

    A step of its own for each: as parts of the rules' expressions they would be
    read again by every rule.
    """
    opened: dict[str, Column] = {}

    def add(path: str, source: Column, kind: str) -> None:
        nonlocal rows
        name = f"_open{len(opened)}"
        rows = rows.withColumn(name, F.try_variant_get(source, "$", kind))
        opened[path] = F.col(name)

    def visit(source: Column, sub: dict, path: str) -> None:
        shape = _shape(sub)
        if shape:
            add(path, source, shape)
            for name, inner in sub["properties"].items():
                visit(opened[path].getField(name), inner, f"{path}.{name}" if path else name)
        if "items" in sub:
            add(f"{path}[]", source, f"array<{_element_shape(sub['items']) or 'variant'}>")

    visit(value, schema, "")
    return rows, opened


def violations(records: DataFrame, schema: dict, keep: tuple[str, ...] = ("run_id", "source_file"), text: str = "text") -> DataFrame:
    """``keep`` columns, record (its path, else a hash of its text), field, rule of each broken rule.

    A text that is no JSON breaks the rule ``json``; an element counts once per
    record and rule, however many elements break it.
    """
    rows = records.select(*keep, F.col(text).alias("_t"), F.try_parse_json(F.col(text)).alias("_v"))
    v = F.col("_v")
    name = F.coalesce(F.try_variant_get(v, "$.UncPath", "string"), F.try_variant_get(v, "$.Path", "string"), F.md5("_t"))
    rows, opened = _open(rows, v, schema)
    tests = [F.when(v.isNotNull() & F.coalesce(r.broken, F.lit(False)), F.struct(F.lit(r.field).alias("field"), F.lit(r.rule).alias("rule")))
             for r in compile_contract(schema, v, opened)]
    tests.append(F.when(v.isNull(), F.struct(F.lit("").alias("field"), F.lit("json").alias("rule"))))
    found = rows.select(*keep, name.alias("record"), F.explode(F.array(*tests)).alias("x")).where("x is not null")
    return found.select(*keep, "record", "x.field", "x.rule")


def violations_per_file(found: DataFrame, keep: tuple[str, ...] = ("run_id", "source_file")) -> DataFrame:
    return found.groupBy(*keep, "field", "rule").agg(F.count("*").alias("records"))
