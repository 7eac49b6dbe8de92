"""Torrent descriptors: bencoded dictionaries to rows of files, with the digest of their info part."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame

from .archives import explode_binary

MOST_DEPTH = 64


def decode(data: bytes, at: int = 0, depth: int = 0, spans: dict | None = None) -> tuple[object, int]:
    """A bencoded value and where it ends. Numbers must be canonical, keys sorted and unique.

    ``spans`` gets the place of the value of each key of the outermost dictionary.
    """
    if depth > MOST_DEPTH:
        raise ValueError("too deep")
    mark = data[at : at + 1]
    if mark == b"i":
        end = data.index(b"e", at)
        digits = data[at + 1 : end]
        if digits != str(int(digits)).encode():
            raise ValueError("number is not canonical")
        return int(digits), end + 1
    if mark == b"l":
        items, at = [], at + 1
        while data[at : at + 1] != b"e":
            item, at = decode(data, at, depth + 1)
            items.append(item)
        return items, at + 1
    if mark == b"d":
        found: dict[bytes, object] = {}
        last, at = None, at + 1
        while data[at : at + 1] != b"e":
            key, at = decode(data, at, depth + 1)
            if not isinstance(key, bytes) or (last is not None and key <= last):
                raise ValueError("keys are not sorted strings")
            begin = at
            found[key], at = decode(data, at, depth + 1)
            if spans is not None and depth == 0:
                spans[key] = (begin, at)
            last = key
        return found, at + 1
    colon = data.index(b":", at)
    digits = data[at:colon]
    if not digits.isdigit() or digits != str(int(digits)).encode():
        raise ValueError("length is not canonical")
    end = colon + 1 + int(digits)
    if end > len(data):
        raise ValueError("text is cut off")
    return data[colon + 1 : end], end


def torrent_files(data: bytes) -> list[dict]:
    """Files of a descriptor; the piece count must fit the total size."""
    spans: dict[bytes, tuple[int, int]] = {}
    whole, end = decode(data, spans=spans)
    if end != len(data) or not isinstance(whole, dict) or not isinstance(whole.get(b"info"), dict):
        raise ValueError("no descriptor")
    info = whole[b"info"]
    digest = hashlib.sha1(data[slice(*spans[b"info"])]).hexdigest()
    root = info[b"name"].decode()
    listed = info.get(b"files") or [{b"path": [], b"length": info.get(b"length", 0)}]
    files = [{"file_index": i, "name": "/".join([root, *(p.decode() for p in f[b"path"])]), "size": f[b"length"], "info_hash": digest} for i, f in enumerate(listed)]
    pieces = -(-sum(f["size"] for f in files) // info[b"piece length"])
    if len(info[b"pieces"]) != 20 * pieces:
        raise ValueError("piece count does not fit the size")
    return files


def list_torrents(files: DataFrame) -> DataFrame:
    return explode_binary(files, torrent_files, "file_index int, name string, size long, info_hash string")
