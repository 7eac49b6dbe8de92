"""JSON Schemas compiled to one column each: the faults of a VARIANT document, each with its path.

The schema is read once, on the driver; what it compiles to is an expression of built-in functions, so documents are
judged inside the JVM, in the same pass as what else is selected. Known are: ``type``, ``enum``, ``const``, ``required``,
``properties``, ``additionalProperties``, ``propertyNames``, ``minProperties``, ``maxProperties``, ``items``, ``prefixItems``,
``minItems``, ``maxItems``, ``uniqueItems``, ``minLength``, ``maxLength``, ``pattern``, ``format`` (date, date-time, uri),
``minimum``, ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``multipleOf``, ``allOf``, ``anyOf``, ``oneOf``, ``not``,
``if``/``then``/``else``, and ``$ref`` to ``$defs`` of the same document. Any other keyword, an unknown format and a
``$ref`` within itself raise when the schema is compiled, so no rule is passed over in silence.

A fault is ``path: rule``, for example ``$.lines[2].size: minimum``. A text that is no JSON, or null, has the one fault
``$: not JSON``. Of the branches of ``anyOf``, ``oneOf`` and ``not`` the rule alone is told. Numbers with a zero fraction are
integers, and lengths count code points. Items are equal if their JSON is.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: keywords that say nothing of a document
_NOTES = {"$schema", "$id", "$defs", "$comment", "title", "description", "default", "examples"}
_FORMATS = {
    "date": "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$",
    "date-time": "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[Tt]([01][0-9]|2[0-3]):[0-5][0-9]:([0-5][0-9]|60)([.][0-9]+)?([Zz]|[+-]([01][0-9]|2[0-3]):[0-5][0-9])$",
    "uri": "^[A-Za-z][A-Za-z0-9+.-]*:[^\\s<>\"{}|\\\\^`]*$",
}
#: First letters of the types that VARIANT names.
_KINDS = {"object": ("OBJ",), "array": ("ARR",), "string": ("STR",), "boolean": ("BOO",), "null": ("VOI",), "number": ("BIG", "DEC", "DOU")}


# fixed values: the keywords that ask for a form of a value
_TEXT_WORDS = {"minLength", "maxLength", "pattern", "format"}
_NUMBER_WORDS = {"minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"}
_OBJECT_WORDS = {"required", "properties", "additionalProperties", "propertyNames", "minProperties", "maxProperties"}
_ARRAY_WORDS = {"items", "prefixItems", "minItems", "maxItems", "uniqueItems"}


def _is_number(value: object) -> bool:
    return isinstance(value, int | float) and not isinstance(value, bool)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """The array that ``body`` makes of a value, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


class _Compiler:
    def __init__(self, root: dict) -> None:
        self.root = root
        self.open: list[str] = []

    def faults(self, schema: dict | bool, value: Column, path: Column) -> Column:
        """array<string> of what is wrong with a value that is there."""
        none = F.array().cast("array<string>")
        if schema is True:
            return none
        if schema is False:
            return F.array(F.concat(path, F.lit(": not allowed")))
        words = set(schema)
        constants = [*schema.get("enum", []), *([schema["const"]] if "const" in schema else [])]
        needed = {
            "text": words & _TEXT_WORDS,
            "number": words & _NUMBER_WORDS or "integer" in str(schema.get("type")) or any(map(_is_number, constants)),
            "fields": words & _OBJECT_WORDS,
            "items": words & _ARRAY_WORDS,
        }
        forms = {"text": "string", "number": "double", "fields": "map<string,variant>", "items": "array<variant>"}
        # the schema of an object or array is that of all below it: opened ones are known by their form instead
        opened = bool(needed["fields"] or needed["items"])
        asked = needed["text"] or needed["number"] or "type" in words
        kind = F.substring(F.schema_of_variant(value), 1, 3) if asked and not opened else F.lit(None).cast("string")
        bound = F.struct(value.alias("value"), kind.alias("kind"), *((F.try_variant_get(value, "$", t) if needed[c] else F.lit(None).cast(t)).alias(c) for c, t in forms.items()))

        def told(own: Column) -> Column:
            self.opened = opened, bool(needed["fields"]), bool(needed["items"])
            return self._told(schema, own, path)

        return _once(bound, told)

    def _is(self, own: Column, name: str) -> Column:
        """Whether a value, as bound by ``faults``, is of a kind."""
        opened, fields, items = self.opened
        if fields and name == "object":
            return own["fields"].isNotNull()
        if items and name == "array":
            return own["items"].isNotNull()
        kind = F.substring(F.schema_of_variant(own["value"]), 1, 3) if opened else own["kind"]
        if name == "integer":
            return kind.isin(*_KINDS["number"]) & (own["number"] == F.floor(own["number"]))
        return kind.isin(*_KINDS[name])

    def _told(self, schema: dict, own: Column, path: Column) -> Column:
        none = F.array().cast("array<string>")
        single: list[Column] = []
        parts: list[Column] = []
        value, text, number, fields, items = (own[c] for c in ("value", "text", "number", "fields", "items"))
        a_text, a_number, an_object, an_array = (self._is(own, k) for k in ("string", "number", "object", "array"))
        kind_of = {k: self._is(own, k) for k in (*_KINDS, "integer")}

        def rule(name: str, bad: Column) -> None:
            single.append(F.when(bad, F.concat(path, F.lit(f": {name}"))))

        def among(values: list) -> Column:
            """Whether the value is one of some constants, by its JSON."""
            plain = F.to_json(value)
            same = plain.isin(*(json.dumps(v, separators=(",", ":"), ensure_ascii=False, sort_keys=True) for v in values))
            numbers = [float(v) for v in values if _is_number(v)]
            return same | (a_number & number.isin(*numbers)) if numbers else same

        for word, told in schema.items():
            if word in _NOTES or word in ("then", "else"):
                continue
            elif word == "type":
                kinds = [told] if isinstance(told, str) else told
                fits = kind_of[kinds[0]]
                for k in kinds[1:]:
                    fits = fits | kind_of[k]
                rule(word, ~fits)
            elif word == "enum":
                rule(word, ~among(told))
            elif word == "const":
                rule(word, ~among([told]))
            elif word == "required":
                for name in told:
                    rule(f"required {name}", an_object & ~F.coalesce(F.map_contains_key(fields, name), F.lit(False)))
            elif word == "properties":
                for name, sub in told.items():
                    there = F.coalesce(F.map_contains_key(fields, name), F.lit(False))
                    inner = self.faults(sub, F.element_at(fields, F.lit(name)), F.concat(path, F.lit(f".{name}")))
                    parts.append(F.when(an_object & there, inner))
            elif word == "additionalProperties":
                rest = F.array_except(F.map_keys(fields), F.array(*map(F.lit, schema.get("properties", {}))).cast("array<string>"))
                inner = lambda k: self.faults(told, F.element_at(fields, k), F.concat(path, F.lit("."), k))  # noqa: B023, E731
                parts.append(F.when(an_object, F.flatten(F.transform(rest, inner))))
            elif word == "propertyNames":
                if set(told) - set(self._text_rules()):
                    raise ValueError(f"propertyNames knows {sorted(self._text_rules())} alone: {told}")
                for key, bound in told.items():
                    test = self._text_rules()[key]
                    parts.append(F.when(an_object, F.transform(F.filter(F.map_keys(fields), lambda k: test(k, bound)), lambda k: F.concat(path, F.lit("."), k, F.lit(f": {key}")))))
            elif word in ("minProperties", "maxProperties"):
                rule(word, an_object & (F.size(fields) < told if word == "minProperties" else F.size(fields) > told))
            elif word in ("items", "prefixItems"):
                skip = len(schema.get("prefixItems", [])) if word == "items" else 0
                if word == "prefixItems":
                    for i, sub in enumerate(told):
                        inner = self.faults(sub, F.get(items, F.lit(i)), F.concat(path, F.lit(f"[{i}]")))
                        parts.append(F.when(an_array & (F.size(items) > i), inner))
                else:
                    item = lambda x, i: self.faults(told, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))  # noqa: B023, E731
                    each = lambda x, i: F.when(i >= skip, item(x, i)).otherwise(none) if skip else item(x, i)  # noqa: B023, E731
                    parts.append(F.when(an_array, F.flatten(F.transform(items, each))))
            elif word in ("minItems", "maxItems"):
                rule(word, an_array & (F.size(items) < told if word == "minItems" else F.size(items) > told))
            elif word == "uniqueItems":
                if told:
                    plain = F.transform(items, lambda x: F.to_json(x))  # noqa: PLW0108
                    rule(word, an_array & (F.size(F.array_distinct(plain)) < F.size(items)))
            elif word in ("minLength", "maxLength", "pattern"):
                rule(word, a_text & self._text_rules()[word](text, told))
            elif word == "format":
                if told not in _FORMATS:
                    raise ValueError(f"unknown format: {told}")
                rule(f"format {told}", a_text & ~text.rlike(_FORMATS[told]))
            elif word in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
                bad = {"minimum": number < told, "maximum": number > told, "exclusiveMinimum": number <= told, "exclusiveMaximum": number >= told}
                rule(word, a_number & bad[word])
            elif word == "multipleOf":
                rule(word, a_number & (number / told != F.floor(number / told)))
            elif word == "allOf":
                parts += [self.faults(sub, value, path) for sub in told]
            elif word in ("anyOf", "oneOf", "not"):
                fit = [(F.size(self.faults(sub, value, path)) == 0).cast("int") for sub in (told if word != "not" else [told])]
                n = sum(fit[1:], fit[0])
                rule(word, {"anyOf": n == 0, "oneOf": n != 1, "not": n > 0}[word])
            elif word == "if":
                holds = F.size(self.faults(told, value, path)) == 0
                parts.append(F.when(holds, self.faults(schema.get("then", True), value, path)).otherwise(self.faults(schema.get("else", True), value, path)))
            elif word == "$ref":
                if not told.startswith("#/$defs/") or told in self.open:
                    raise ValueError(f"only references to $defs of the same document, not within themselves: {told}")
                self.open.append(told)
                parts.append(self.faults(self.root["$defs"][told.removeprefix("#/$defs/")], value, path))
                self.open.pop()
            else:
                raise ValueError(f"unknown keyword: {word}")
        found = F.array_compact(F.array(*single)) if single else none
        return F.concat(found, *(F.coalesce(p, none) for p in parts)) if parts else found

    @staticmethod
    def _text_rules() -> dict[str, Callable[[Column, object], Column]]:
        return {"minLength": lambda x, n: F.length(x) < n, "maxLength": lambda x, n: F.length(x) > n, "pattern": lambda x, p: ~x.rlike(p)}


def faults(schema: dict, document: Column) -> Column:
    """Sorted faults of a VARIANT document, none if it is valid."""
    found = lambda own: F.sort_array(_Compiler(schema).faults(schema, own, F.lit("$")))
    return _once(document, lambda own: F.when(own.isNull(), F.array(F.lit("$: not JSON"))).otherwise(found(own)))


def json_faults(schema: dict, text: Column) -> Column:
    """Sorted faults of a JSON text."""
    return faults(schema, F.try_parse_json(text))


def shape_of(document: Column, shapes: dict[str, dict]) -> Column:
    """The name of the first shape whose schema the document meets; null if it meets none."""

    def first(own: Column) -> Column:
        name = F.lit(None).cast("string")
        for key, schema in reversed(shapes.items()):
            name = F.when(F.size(faults(schema, own)) == 0, key).otherwise(name)
        return name

    return F.transform(F.array(document), first)[0]


def by_shape(document: Column, cases: dict[str, tuple[dict, dict[str, Column]]]) -> Column:
    """map<string, double> of the statistics of the first shape that the document meets; empty for an unknown shape."""
    found = F.create_map().cast("map<string,double>")
    for schema, statistics in reversed(cases.values()):
        own = F.map_from_arrays(F.array(*map(F.lit, statistics)), F.array(*(c.cast("double") for c in statistics.values())))
        found = F.when(F.size(faults(schema, document)) == 0, own).otherwise(found)
    return found
