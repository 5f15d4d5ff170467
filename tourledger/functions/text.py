"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_BREAK = "\u0001 "


def title_case(text: Column) -> Column:
    """Capitalise the first letter after anything but a letter or an apostrophe.

    ``initcap`` only starts a word after a space, so a marked space goes in after
    every other break and comes out again afterwards. This stays in generated code,
    which a ``transform`` over split pieces would not.
    """
    marked = F.regexp_replace(F.lower(text), r"([^\p{L}' ])", "$1" + _BREAK)
    return F.replace(F.initcap(marked), F.lit(_BREAK), F.lit(""))


def snake_case(name: str) -> str:
    """Normalise one column name: ``Full Name`` -> ``full_name``."""
    name = name.replace("'", "").replace('"', "").replace("%", "_percent_").replace("#", "_number_")
    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    name = re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()
    return f"x{name}" if not name or name[0].isdigit() else name


def snake_case_all(names: list[str]) -> list[str]:
    """Normalise column names; repeats get ``_2``, ``_3`` and so on."""
    seen: dict[str, int] = {}
    out = []
    for name in map(snake_case, names):
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out
