"""Classification of files and small text conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.paths import file_suffix

#: Beginnings of binary formats, in hex.
MAGIC = {"zip": "504B0304", "seven-zip": "377ABCAF271C", "packed-xml": "454EA162", "gettext": "DE120495", "pe": "4D5A"}


def container_kind(head: Column) -> Column:
    """Format of a file by its first bytes; unknown if none fits."""
    out = F.lit("unknown")
    for name, magic in MAGIC.items():
        out = F.when(F.hex(F.substring(head, 1, len(magic) // 2)) == magic, name).otherwise(out)
    return out


def classify_text(path: Column, head: Column, suffixes: dict[str, str]) -> Column:
    """Kind by suffix, else by the head: markup, json, text, or empty."""
    out = F.when(F.trim(head) == "", "empty").when(F.ltrim(head).startswith("<"), "markup").when(F.ltrim(head).rlike("^[\\[{]"), "json").otherwise("text")
    for suffix, kind in suffixes.items():
        out = F.when(file_suffix(path) == suffix, kind).otherwise(out)
    return out


def strip_decompiler_marks(text: Column) -> Column:
    """Without comment lines at either end and a closing bare return; ``pass`` if nothing is left."""
    bare = F.regexp_replace(text, "\\A(?:#[^\\n]*\\n)+", "")
    bare = F.regexp_replace(bare, "(?:\\n#[^\\n]*)+\\s*\\z", "\n")
    bare = F.regexp_replace(bare, "\\n?return\\s*\\z", "\n")
    return F.when(F.trim(F.regexp_replace(bare, "\\s+", " ")) == "", F.lit("pass\n")).otherwise(bare)


def has_failure_mark(text: Column) -> Column:
    return F.lower(text).rlike("decompil(?:e|ation) fail|unsupported opcode|traceback \\(most recent")
