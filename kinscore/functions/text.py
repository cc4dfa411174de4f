"""Label → column-name slug (F1-F7), as one JVM-side ``Column`` expression.

lower → drop characters outside latin, cyrillic, digits and space → cyrillic to latin
letter by letter → runs of spaces to ``_``. Underscores in the input are dropped by the
second step; the map is lossy (several letters share a latin letter), so callers check
slug collisions (``assert_unique_names``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original job's for identical column names:
# the kept character class, and the letter map (33 cyrillic letters, same order, 33 latin).
KEEP_CLASS = "[^a-zа-яё0-9 ]"
CYRILLIC = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"
LATIN = "abvgdeejziyklmnoprstufhccsh_y_euj"


def slug(c) -> Column:
    """slug of a label column (null stays null)."""
    c = F.col(c) if isinstance(c, str) else c
    kept = F.regexp_replace(F.lower(c), KEEP_CLASS, "")
    return F.regexp_replace(F.translate(kept, CYRILLIC, LATIN), " +", "_")


def underscore_spaces(name: str) -> str:
    """``name.replace(' ', '_')`` for fixed feature names (services, tariffs)."""
    return name.replace(" ", "_")


def assert_unique_names(names: list[str]) -> None:
    """Column names are case-insensitive in Spark: fail clearly on any collision."""
    seen: dict[str, str] = {}
    for n in names:
        k = n.lower()
        if k in seen:
            raise ValueError(f"feature name collision: {seen[k]!r} and {n!r}")
        seen[k] = n
