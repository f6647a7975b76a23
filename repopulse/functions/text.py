"""Keys, defaults and path parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_LANGUAGE = "Unknown"
UNKNOWN_NAME = "unknown"


def percent_encoded(text: Column) -> Column:
    """Percent-encoding in which only letters, digits and `_.-~` stay."""
    encoded = F.url_encode(text)
    for form_style, percent_style in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form_style), F.lit(percent_style))
    return encoded


def trimmed_repo_key(name: Column) -> Column:
    """X9, batch form: trimmed first; null and blank give the empty key."""
    return F.coalesce(percent_encoded(F.trim(name)), F.lit(""))


def joined_key(*parts: Column) -> Column:
    """Composite key `a#b#c`."""
    return F.concat_ws("#", *parts)


def padded(number: Column, width: int = 4) -> Column:
    """Zero-padded number that grows beyond the width."""
    return F.format_string(f"%0{width}d", number)


def key_head(key: Column) -> Column:
    """X11: the part before the first `#`."""
    return F.split(key, "#", 3)[0]


def key_tail(key: Column) -> Column:
    """X11: everything after the first `#`, null if there is none."""
    return F.try_element_at(F.split(key, "#", 2), F.lit(2))


def or_default(value: Column, default: str) -> Column:
    """null and empty text become the default."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def language_label(language: Column) -> Column:
    """Trimmed language, blank becomes `Unknown`."""
    return or_default(F.trim(language), UNKNOWN_LANGUAGE)


def known_language(language: Column) -> Column:
    """Trimmed language, null where it is blank or `Unknown`."""
    return F.nullif(language_label(language), F.lit(UNKNOWN_LANGUAGE))


def path_day(path: Column) -> Column:
    """The day that begins a path's last dated component, else null."""
    return F.nullif(F.regexp_extract(path, r"^.*/(\d{4}-\d{2}-\d{2}).*", 1), F.lit(""))


def path_hour(path: Column) -> Column:
    """Hour of an hourly archive file name, null for any other name."""
    return F.regexp_extract(path, r"/\d{4}-\d{2}-\d{2}-(\d{1,2})\.json\.gz$", 1).try_cast("int")


def has_owner(name: Column) -> Column:
    """Whether the name reads `owner/name`."""
    return F.coalesce(F.contains(name, F.lit("/")), F.lit(False))


def owner_and_name(name: Column) -> Column:
    """Struct of owner and name split at the first `/`, null if unsplittable."""
    parts = F.split(name, "/", 2)
    return F.when(has_owner(name), F.struct(parts[0].alias("owner"), parts[1].alias("name")))
