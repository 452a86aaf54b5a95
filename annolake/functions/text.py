"""Query texts, names and paths as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_ends(text: Column, before: str = "", after: str = "", only: Column | None = None) -> Column:
    """The text between `before` and `after`; "geometric" stays as it is, and so does a text for which `only` is false."""
    changed = F.concat(F.lit(before), text, F.lit(after))
    keep = text == "geometric" if only is None else (text == "geometric") | ~only
    return F.when(keep, text).otherwise(changed)


def listed(text: Column, names: list[str]) -> Column:
    """Whether a text, trimmed and in lower case, is one of the names."""
    return F.lower(F.trim(text)).isin([n.strip().lower() for n in names])


def stem(path: Column) -> Column:
    """File name without its folders and its last extension; a leading dot is part of the name."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def flat_path(path: Column) -> Column:
    return F.replace(path, F.lit("/"), F.lit("_"))


def recording_path(name: Column, root: str) -> Column:
    """lab_outcome_date_time..._recordings_kind_id.ext as a path under `root`; the time may hold underscores itself."""
    parts = F.split(name, "_")
    n = F.size(parts)
    time = F.array_join(F.slice(parts, 4, n - 6), "_")
    number = F.element_at(F.split(F.element_at(parts, -1), r"\."), 1)
    return F.concat_ws("/", F.lit(root.rstrip("/")), parts[0], parts[1], parts[2], time, F.element_at(parts, -3), F.element_at(parts, -2), F.concat(number, F.lit(".mp4")))


def sized_url(template: str, uuid: Column, width: Column, height: Column, most: Column) -> Column:
    """`template` (two %s) with the id and "full", or the largest size where an image is not below it on both sides."""
    size = F.when(most.isNull() | ((most > width) & (most > height)), F.lit("full")).otherwise(F.format_string("!%d,%d", most, most))
    return F.format_string(template, uuid, size)
