"""Column-name rules. All of this is plan-time work on header texts."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence

KEY = "job_id"
SOURCE = "source_file"

# Substrings that mark the column the record key is read from.
URL_WORDS = ("url", "link", "href")
# Fixed value: columns with a blank header, dropped together with the URL column.
UNNAMED_WORD = "unnamed"
# Substrings of the names of columns tried as dates.
DATE_WORDS = ("date", "time")
# Fixed value: suffix of the columns a merge throws away.
DUPLICATE_SUFFIX = "_dup"


def clean_name(name: object) -> str:
    """Lower case, every run of other characters one underscore, none at the ends."""
    return "_".join(re.findall("[a-z0-9_]+", str(name).strip().lower())).strip("_")


def clean_names(names: Sequence[str], on_clash: str = "error") -> list[str]:
    """Clean all names. Two headers with one clean name raise, or get `_2`, `_3`..."""
    cleaned: list[str] = []
    for name in names:
        label = clean_name(name)
        if label in cleaned:
            if on_clash == "error":
                raise ValueError(f"two columns clean to the same name: {label!r}")
            step = 2
            while f"{label}_{step}" in cleaned:
                step += 1
            label = f"{label}_{step}"
        cleaned.append(label)
    return cleaned


def header_names(line: str) -> list[str]:
    """Column names of a header line: blanks numbered, repeats get `.1`, `.2`..."""
    fields = next(csv.reader([line.removeprefix("﻿")]))
    names: list[str] = []
    for i, field in enumerate(fields):
        base = field if field else f"Unnamed: {i}"
        name, step = base, 1
        while name in names:
            name, step = f"{base}.{step}", step + 1
        names.append(name)
    return names


def is_url_name(name: str) -> bool:
    return any(word in name.lower() for word in URL_WORDS)


def find_url_column(names: Iterable[str]) -> str | None:
    """First column, in order, whose name contains a URL word (`hourly` does)."""
    return next((name for name in names if is_url_name(name)), None)


def key_source_columns(names: Sequence[str], url: str | None) -> list[str]:
    """Columns that leave once the key is read: the URL column and blank headers."""
    if url is None:
        return []
    return [name for name in names if name == url or UNNAMED_WORD in name]


def is_date_name(name: str) -> bool:
    return any(word in name.lower() for word in DATE_WORDS)
