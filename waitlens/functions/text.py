"""Text helpers: header normalisation, code/label split, check-digit removal."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed values of the reference's header cleaner: replacements made before
# the snake case conversion.
HEADER_REPLACEMENTS: tuple[tuple[str, str], ...] = (("'", ""), ('"', ""), ("%", "_percent_"), ("#", "_number_"))


def clean_name(name: str | None, position: int = 1) -> str:
    """Header to ASCII snake case (D1). A blank header becomes ``x<position>``."""
    text = name or ""
    for old, new in HEADER_REPLACEMENTS:
        text = text.replace(old, new)
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text:
        return f"x{position}"
    if text[0].isdigit():
        text = f"x{text}"
    return text


def clean_names(names: Iterable[str]) -> list[str]:
    """Clean every header and make duplicates unique with ``_2``, ``_3``..."""
    out: list[str] = []
    for i, raw in enumerate(names, start=1):
        base = name = clean_name(raw, i)
        n = 1
        while name in out:  # also where a suffixed name is taken
            n += 1
            name = f"{base}_{n}"
        out.append(name)
    return out


def split_code_label(c: Column | str, sep: str = r"\s*-\s*") -> tuple[Column, Column]:
    """Split at the first separator (D10): ``'C50 - a - b'`` gives ``('C50', 'a - b')``;
    without a separator the label is null."""
    parts = F.split(F.col(c) if isinstance(c, str) else c, sep, 2)
    return F.get(parts, 0), F.get(parts, 1)


def strip_last_char(c: Column | str) -> Column:
    """Identifier without its check digit (X3): ``str_sub(x, 1, -2)``."""
    x = F.col(c) if isinstance(c, str) else c
    return F.substring(x, F.lit(1), F.length(x) - 1)
