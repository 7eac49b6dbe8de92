"""XML documents by XPath, behind a guard: Spark's XPath expands entities, so documents that declare any are
refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guarded(xml: Column, *, most_chars: int = 16 << 20) -> Column:
    """The document, or null where it declares a document type or entity, or is too long."""
    unsafe = F.upper(xml).contains("<!DOCTYPE") | F.upper(xml).contains("<!ENTITY")
    return F.when(~unsafe & (F.length(xml) <= most_chars), xml)


def xml_status(xml: Column) -> Column:
    return F.when(guarded(xml).isNull(), "refused").otherwise("ok")


def first_present(xml: Column, paths: list[str]) -> Column:
    """Text of the first of several paths that is there and not empty."""
    found = [F.xpath_string(xml, F.lit(p)) for p in paths]
    return F.coalesce(*(F.when(v != "", v) for v in found))


def explode_nodes(docs: DataFrame, *, xml: str, keep: list[str], node: str, fields: dict[str, str]) -> DataFrame:
    """A row for each node of a path, with a text field for each relative path: an attribute (``@a``) or a
    child. A node that lacks a field, or has it empty, has null there; others keep theirs.

    Spark's XPath takes constant paths alone and drops empty texts, so a document is parsed once by ``from_xml``
    down to the nodes' parent, and each node's fields are read by name.
    """
    _, *parents, name = node.strip("/").split("/")
    field = lambda p: f"_{p[1:]}" if p.startswith("@") else p
    inner = ", ".join(f"`{field(p)}`: string" for p in dict.fromkeys(fields.values()))
    schema = f"`{name}` array<struct<{inner}>>"
    for step in reversed(parents):
        schema = f"`{step}` struct<{schema.replace('` ', '`: ', 1)}>"
    safe = docs.select(*keep, F.from_xml(guarded(F.col(xml)), schema, {"attributePrefix": "_", "nullValue": ""}).alias("_doc"))
    path = ".".join(f"`{step}`" for step in [*parents, name])
    rows = safe.select(*keep, F.posexplode(F.col(f"_doc.{path}")).alias("position", "_node"))
    return rows.select(*keep, (F.col("position") + 1).alias("position"), *(F.col(f"_node.`{field(p)}`").alias(n) for n, p in fields.items()))
