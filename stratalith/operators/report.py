"""Reports as text columns: lines of tables, badges, and one text for each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formats import escape_html, escape_markdown

#: Colour of a badge for each state.
COLOURS = {"ok": "brightgreen", "success": "brightgreen", "failure": "red", "problems": "red", "cancelled": "lightgrey", "missing": "lightgrey", "pending": "yellow"}


def markdown_line(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(escape_markdown(c.cast("string")), F.lit("")) for c in cells)), F.lit(" |"))


def html_line(*cells: Column) -> Column:
    body = F.concat_ws("", *(F.concat(F.lit("<td>"), F.coalesce(escape_html(c.cast("string")), F.lit("")), F.lit("</td>")) for c in cells))
    return F.concat(F.lit("<tr>"), body, F.lit("</tr>"))


def badge(label: Column, state: Column) -> Column:
    """A badge as a JSON object: label, message and colour; unknown states are grey."""
    colour = F.lit("lightgrey")
    for name, value in COLOURS.items():
        colour = F.when(state == name, value).otherwise(colour)
    return F.to_json(F.struct(colour.alias("color"), label.alias("label"), state.alias("message"), F.lit(1).alias("schemaVersion")))


def grouped_text(rows: DataFrame, *, keys: list[str], line: Column, order: list[str]) -> DataFrame:
    """One text for each group: its lines in order. For groups of a size that a report has, not for bulk rows."""
    lines = F.sort_array(F.collect_list(F.struct(*order, line.alias("line"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("text"))
