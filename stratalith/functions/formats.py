"""Numbers, sizes, durations, money and marked-up text as strings; rates and back-off as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(amount: Column, seconds: Column, digits: int = 3) -> Column:
    """Amount a second, half to even, null unless time has passed."""
    return F.when(seconds > 0, F.bround(amount / seconds, digits))


def format_bytes(size: Column) -> Column:
    """Bytes in the largest binary unit that leaves one or more, with one decimal above bytes."""
    out = F.concat(size.cast("string"), F.lit(" B"))
    for power, unit in enumerate(("KiB", "MiB", "GiB", "TiB"), 1):
        tenths = F.floor((size * 10 + (1 << (10 * power - 1))) / F.lit(1 << 10 * power)).cast("long")
        text = F.concat_ws("", F.floor(tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(f" {unit}"))
        out = F.when(size >= 1 << 10 * power, text).otherwise(out)
    return out


def format_duration(seconds: Column) -> Column:
    """Whole seconds as ``1d 02h``, ``2h 03m``, ``3m 04s`` or ``5s``."""
    part = lambda unit, of: F.lpad((F.floor(seconds / unit) % of).cast("string"), 2, "0")
    whole = lambda unit: F.floor(seconds / unit).cast("string")
    return (
        F.when(seconds >= 86400, F.concat(whole(86400), F.lit("d "), part(3600, 24), F.lit("h")))
        .when(seconds >= 3600, F.concat(whole(3600), F.lit("h "), part(60, 60), F.lit("m")))
        .when(seconds >= 60, F.concat(whole(60), F.lit("m "), part(1, 60), F.lit("s")))
        .otherwise(F.concat(seconds.cast("string"), F.lit("s")))
    )


def format_rate(per_second: Column) -> Column:
    """Bytes a second by ``format_bytes``; unknown without one."""
    return F.coalesce(F.concat(format_bytes(per_second.cast("long")), F.lit("/s")), F.lit("unknown"))


def format_clock(seconds: Column) -> Column:
    """Whole seconds as ``h:mm:ss``, below an hour ``m:ss``."""
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    tail = F.concat(two(seconds % 3600 / 60), F.lit(":"), two(seconds % 60))
    short = F.concat(F.floor(seconds / 60).cast("string"), F.lit(":"), two(seconds % 60))
    return F.when(seconds >= 3600, F.concat(F.floor(seconds / 3600).cast("string"), F.lit(":"), tail)).otherwise(short)


def format_words(seconds: Column) -> Column:
    """Whole seconds in words of the two largest units: ``2 h 5 min``, ``5 min``, ``40 s``."""
    hours, minutes = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60)
    long_ = F.concat(hours.cast("string"), F.lit(" h"), F.when(minutes > 0, F.concat(F.lit(" "), minutes.cast("string"), F.lit(" min"))).otherwise(""))
    return F.when(seconds >= 3600, long_).when(seconds >= 60, F.concat(minutes.cast("string"), F.lit(" min"))).otherwise(F.concat(seconds.cast("string"), F.lit(" s")))


def format_cents(cents: Column, sign: str = "€") -> Column:
    return F.concat(F.lit(sign), F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def escape_html(text: Column) -> Column:
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def escape_markdown(text: Column) -> Column:
    return F.regexp_replace(text, "([\\\\`*_{}\\[\\]()#+.!|-])", "\\\\$1")


def retry_delay(attempt: Column, *, base: float, cap: float, remaining: Column | None = None) -> Column:
    """Doubling delay before an attempt from 1 on, none before the first, doubled ten times at most; never beyond
    what remains."""
    delay = F.least(F.lit(base) * F.pow(F.lit(2.0), F.least(F.greatest(attempt - 2, F.lit(0)), F.lit(10))), F.lit(cap))
    delay = delay if remaining is None else F.least(delay, remaining)
    return F.when(attempt <= 1, 0.0).otherwise(delay)


def segment_count(size: Column, *, least_size: int, target: int, most: int) -> Column:
    """Parallel parts of a download: one below the least size, else as many targets as fit."""
    return F.when(size < least_size, F.lit(1)).otherwise(F.greatest(F.lit(1), F.least(F.lit(most), F.floor(size / target)))).cast("int")


def time_budget(seconds: Column, workers: Column, cpus: Column, *, most: float) -> Column:
    """A time limit scaled by how many waves of workers the processors take."""
    return F.least(F.lit(most), seconds * F.greatest(F.lit(1), F.ceil(workers / cpus)))


def redact_secrets(text: Column) -> Column:
    """Values after secret-looking names, and credentials in urls, replaced."""
    named = F.regexp_replace(text, "(?i)((?:password|secret|token|api[_-]?key)\\s*[=:]\\s*)[^\\s&,;]+", "$1REDACTED")
    return F.regexp_replace(named, "(://)[^/\\s@]+@", "$1REDACTED@")


def readable_version(text: Column) -> Column:
    """``v.2.4.0.0 Common Test #927`` as ``2.4.0.0 #927``; null without a version."""
    version = F.regexp_extract(text, "([0-9]+(?:[.][0-9]+)+)", 1)
    build = F.regexp_extract(text, "(#[0-9]+)", 1)
    return F.when(version != "", F.trim(F.concat_ws(" ", version, build)))


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\\r\\n?", "\n")


def utc_text(text: Column) -> Column:
    """An ISO-8601 time with a zone as ``2024-01-02T03:04:05Z``, whole seconds; null without a zone, or if it is none.
    The session's zone plays no part."""
    zoned = text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})$")
    seconds = F.unix_seconds(F.try_to_timestamp(text))
    at = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.floor(seconds / 86400).cast("int"), F.lit(0), F.lit(0), F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))
    return F.when(zoned, F.concat(F.replace(F.substring(at.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("Z")))


def local_text(utc: Column, zone: str) -> Column:
    """A text of ``utc_text`` as date and minute in a zone, whatever the session's is."""
    at = F.to_timestamp_ntz(F.rtrim(utc, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return F.substring(F.convert_timezone(F.lit("UTC"), F.lit(zone), at).cast("string"), 1, 16)


# fixed values: words that no parameter can be called by
_RESERVED = (
    "False None True and as assert async await break class continue def del elif else except finally for from global if import in is lambda nonlocal not or "
    "pass raise return try while with yield"
).split()


def unique_names(names: Column, *, taken: list[str] | None = None) -> Column:
    """Parameter names of one signature told apart: one that is no identifier, a reserved word, or was given before (or is
    ``taken``) is called ``arg`` and its place from 0, with underscores while that is given too."""
    start = F.array(*map(F.lit, taken or [])).cast("array<string>")

    def step(given: Column, named: Column) -> Column:
        fine = F.coalesce(named["name"].rlike("^[A-Za-z_][A-Za-z0-9_]*$") & ~named["name"].isin(*_RESERVED) & ~F.array_contains(given, named["name"]), F.lit(False))
        by_place = F.concat(F.lit("arg"), named["place"].cast("string"))
        tries = F.transform(F.sequence(F.lit(0), F.size(given)), lambda k: F.concat(by_place, F.repeat(F.lit("_"), k)))
        return F.array_append(given, F.when(fine, named["name"]).otherwise(F.get(F.array_except(tries, given), F.lit(0))))

    placed = F.transform(names, lambda x, i: F.struct(x.alias("name"), i.alias("place")))
    return F.slice(F.aggregate(placed, start, step), F.lit(len(taken or []) + 1), F.greatest(F.size(names), F.lit(0)))
