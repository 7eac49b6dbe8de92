"""Predicates and projections over relative paths, archive names and urls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that hold secrets, by part of their name.
SENSITIVE = ("auth", "key", "password", "secret", "session", "sig", "token")


def is_safe_path(path: Column) -> Column:
    """Relative, no backslash or NUL, no empty, ``.`` or ``..`` segment. False for null."""
    parts = F.split(path, "/")
    fine = (
        (F.length(path) > 0)
        & ~path.contains("\\")
        & ~path.contains("\x00")
        & F.forall(parts, lambda p: ~p.isin("", ".", ".."))
    )
    return F.coalesce(fine, F.lit(False))


def is_safe_archive_name(name: Column) -> Column:
    """A safe path without control characters and drive letters; a closing slash marks a folder."""
    bare = F.regexp_replace(name, "/$", "")
    return is_safe_path(bare) & ~F.coalesce(name.rlike("[\\x00-\\x1F\\x7F]|^[A-Za-z]:"), F.lit(True))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def is_allowed_url(url: Column, *, allow_http: bool) -> Column:
    """A scheme that is allowed, a host, no credentials and no fragment. False for null."""
    schemes = ("https", "http") if allow_http else ("https",)
    authority = F.regexp_extract(url, "://([^/?#]*)", 1)
    fine = url_scheme(url).isin(*schemes) & (url_host(url) != "") & ~authority.contains("@") & ~url.contains("#")
    return F.coalesce(fine, F.lit(False))


def redact_url(url: Column) -> Column:
    """The url without credentials, and with the values of sensitive query keys replaced."""
    bare = F.regexp_replace(url, "://[^/?#@]*@", "://")
    head = F.regexp_extract(bare, "^([^?#]*)", 1)
    query = F.regexp_extract(bare, "^[^?#]*[?]([^#]*)", 1)
    tail = F.regexp_extract(bare, "(#.*)$", 1)

    def field(pair: Column) -> Column:
        name = F.regexp_extract(pair, "^([^=]*)", 1)
        hidden = F.lower(name).rlike("|".join(SENSITIVE))
        return F.when(hidden, F.concat(name, F.lit("=REDACTED"))).otherwise(pair)

    rest = F.when(query == "", F.lit("")).otherwise(
        F.concat(F.lit("?"), F.array_join(F.transform(F.split(query, "&"), field), "&"))
    )
    return F.concat(head, rest, tail)


def file_suffix(path: Column) -> Column:
    """Lower-cased text from the last dot of the last segment; empty without one."""
    return F.lower(F.regexp_extract(path, "([.][^./]+)$", 1))


def bundle_name(path: Column) -> Column:
    """The file's stem without a ``-<version>-SNAPSHOT`` ending."""
    stem = F.regexp_replace(F.regexp_extract(path, "([^/]+)$", 1), "[.][^.]*$", "")
    return F.regexp_replace(stem, "-[0-9][A-Za-z0-9.]*-SNAPSHOT$", "")


def in_folders(path: Column, folders: tuple[str, ...]) -> Column:
    """Whether the file's last folders are the given ones."""
    parts = F.split(path, "/")
    n = len(folders)
    own = F.slice(parts, F.greatest(F.size(parts) - n, F.lit(1)), n)
    return F.coalesce((F.size(parts) > n) & (own == F.array(*map(F.lit, folders))), F.lit(False))
