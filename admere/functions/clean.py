"""Casts and text cleaning. Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
RATIO = "decimal(29,9)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Whole shapes of readable dates and instants. Spark alone would also read a year, a
#: month, a bare time (as today's) or a date with any text behind it.
_DATE = r"\s*\d{4}-\d{2}-\d{2}"
_TIME = r"[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
_ZONE = r"\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)"
SHAPES = {"date": rf"^{_DATE}\s*$", "timestamp": rf"^{_DATE}({_TIME}({_ZONE})?)?\s*$"}


def safe_cast(c: Column | str, to: str) -> Column:
    """Cast of a text that turns an unreadable value into NULL.

    Booleans accept only ``true`` and ``false``; Spark alone would also read
    ``yes``, ``t`` and ``1``. Dates and timestamps must be whole ones.
    """
    c = col(c)
    if to.lower() in ("boolean", "bool"):
        text = F.lower(c.cast("string"))
        return F.when(text.isin("true", "false"), text == "true")
    shape = SHAPES.get(to.lower())
    return F.when(c.cast("string").rlike(shape), c.try_cast(to)) if shape else c.try_cast(to)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def category_key(c: Column | str) -> Column:
    """Lower-case key with runs of spaces, underscores and hyphens made one space."""
    return F.lower(F.regexp_replace(F.trim(col(c)), r"[\s_-]+", " "))


def email_key(c: Column | str) -> Column:
    return F.nullif(F.lower(F.trim(col(c))), F.lit(""))


def email_domain(c: Column | str) -> Column:
    return F.get(F.split(col(c), "@"), F.lit(1))


def phone_key(c: Column | str, country: str = "27") -> Column:
    """International form of a phone number; NULL when it holds no digit."""
    digits = F.nullif(F.regexp_replace(col(c), "[^0-9]", ""), F.lit(""))
    plus = F.lit(f"+{country}")
    trunk = len(country) + 3
    return (
        F.when(digits.startswith(f"00{country}"), F.concat(plus, digits.substr(F.lit(trunk), F.length(digits))))
        .when(digits.startswith(country), F.concat(F.lit("+"), digits))
        .when(digits.startswith("0"), F.concat(plus, digits.substr(F.lit(2), F.length(digits))))
        .when(digits.isNotNull(), F.concat(plus, digits))
    )


def pseudonym(c: Column | str) -> Column:
    """Hex SHA-256 of a text; NULL stays NULL."""
    return F.sha2(col(c), 256)


def surrogate_key(*parts: Column | str, sep: str = "|") -> Column:
    """Hex SHA-256 over the joined parts; NULL if any part is NULL."""
    joined: list[Column] = []
    for part in parts:
        if joined:
            joined.append(F.lit(sep))
        joined.append(col(part).cast("string"))
    return F.sha2(F.concat(*joined), 256)


def event_fingerprint(visitor: Column | str, at: Column | str, name: Column | str, session: Column | str) -> Column:
    """Key of one event. The instant enters as epoch microseconds, never as text."""
    return surrogate_key(visitor, F.unix_micros(col(at)), name, session)


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First capture of ``pattern``; NULL when nothing matches."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def path_id(path: Column | str, pattern: str = r"/ad_([^/]+)/copy\.txt$") -> Column:
    return first_match(path, pattern)


def file_stem(path: Column | str, extension: str) -> Column:
    return first_match(path, rf"/([^/]+)\.{extension}$")


def url_parameter(url: Column | str, name: str, structured: Column | str | None = None) -> Column:
    """Query parameter, name matched in any letter case, value as written.

    A value delivered as a field of its own wins over the one in the URL.
    """
    found = first_match(url, rf"(?i)[?&]{name}=([^&#]+)")
    return found if structured is None else F.coalesce(col(structured), found)


def strip_code_fence(c: Column | str) -> Column:
    """Remove a Markdown code fence around a reply."""
    return F.regexp_extract(col(c), r"(?s)^\s*(?:`{3,}\w*)?\s*(.*?)\s*(?:`{3,})?\s*$", 1)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """All columns but ``names``; an unknown name is an error, not a no-op."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {missing}")
    return df.drop(*names)
