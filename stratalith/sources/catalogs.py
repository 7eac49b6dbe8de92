"""Compiled message catalogs (gettext MO): to rows, and from rows back to bytes."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame

from .archives import explode_binary


def pack_catalog(messages: dict[str, str]) -> bytes:
    """A little-endian catalog with the messages sorted by id."""
    pairs = sorted((k.encode(), v.encode()) for k, v in messages.items())
    head, n = 28, len(pairs)
    at = head + 16 * n
    tables: list[list[bytes]] = [[], []]
    body = b""
    for side in (0, 1):
        for pair in pairs:
            tables[side].append(struct.pack("<II", len(pair[side]), at + len(body)))
            body += pair[side] + b"\0"
    return struct.pack("<7I", 0x950412DE, 0, n, head, head + 8 * n, 0, head + 16 * n) + b"".join(tables[0] + tables[1]) + body


def catalog_messages(data: bytes) -> list[dict]:
    """Messages in file order, with context and plural forms apart; the empty id's text is the header."""
    magic = data[:4]
    order = "<" if magic == b"\xde\x12\x04\x95" else ">" if magic == b"\x95\x04\x12\xde" else ""
    if not order:
        raise ValueError("no catalog")
    n, ids, texts = struct.unpack_from(f"{order}3I", data, 8)
    out = []
    for i in range(n):
        parts = []
        for table in (ids, texts):
            size, at = struct.unpack_from(f"{order}2I", data, table + 8 * i)
            if at + size > len(data):
                raise ValueError("message is cut off")
            parts.append(data[at : at + size].decode())
        context, mark, rest = parts[0].rpartition("\x04")
        singular, *plural = rest.split("\0")
        out.append({"message_index": i, "context": context if mark else None, "message_id": singular, "plural_id": plural[0] if plural else None, "texts": parts[1].split("\0")})
    return out


CATALOG_SCHEMA = "message_index int, context string, message_id string, plural_id string, texts array<string>"


def list_messages(files: DataFrame) -> DataFrame:
    return explode_binary(files, catalog_messages, CATALOG_SCHEMA)
