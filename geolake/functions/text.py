"""Parsing of the small text formats that travel with the data."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How an EPSG code is written in the three CRS text styles.
EPSG_PREFIX = r"EPSG:(\d+)"
WKT2_ID = r'ID\["EPSG",\s*(\d+)\]'
WKT1_AUTHORITY = r'AUTHORITY\["EPSG",\s*"(\d+)"\]'


def parse_bbox(text: Column) -> Column:
    """'a,b,c,d' or six values -> array of doubles; NULL when it is no valid box."""
    values = F.transform(F.split(text, ","), lambda v: F.trim(v).try_cast("double"))
    whole = F.size(values).isin(4, 6) & ~F.exists(values, lambda v: v.isNull())
    return F.when(whole, values)


def literal_bbox(value: str | Sequence[float]) -> list[float]:
    """Request box on the driver; raises on anything but 4 or 6 numbers."""
    parts = value.split(",") if isinstance(value, str) else value
    numbers = [float(v) for v in parts]
    if len(numbers) not in (4, 6):
        raise ValueError("a bbox has 4 or 6 values")
    return numbers


def epsg_of(text: Column) -> Column:
    """EPSG code of a CRS text: 'EPSG:n', else the last WKT2 id, else the last WKT1 authority.

    The last id is the code of the projected system; earlier ones belong to its parts.
    """
    def last(pattern: str) -> Column:
        return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))

    plain = F.nullif(F.regexp_extract(text, EPSG_PREFIX, 1), F.lit(""))
    return F.coalesce(plain, last(WKT2_ID), last(WKT1_AUTHORITY)).try_cast("int")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(name: Column) -> Column:
    """File name without its folder and its last extension."""
    return F.regexp_replace(file_name(name), r"(?<=.)\.[^.]*$", "")


def bare_stem(name: Column) -> Column:
    """Stem without the inner '.copc' of a converted cloud."""
    return F.replace(stem(name), F.lit(".copc"), F.lit(""))


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def has_scheme(url: Column) -> Column:
    return url.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")


def resolve_href(base: Column, href: Column) -> Column:
    """Relative link -> path, for './x', 'x' and any number of leading '../' steps."""
    clean = F.regexp_replace(href, r"^(\./)+", "")
    ups = F.array_size(F.regexp_extract_all(clean, F.lit(r"(\.\./)"), F.lit(1)))
    tail = F.regexp_replace(clean, r"^(\.\./)+", "")
    steps = F.filter(F.split(parent(base), "/"), lambda p: p != "")
    kept = F.slice(steps, F.lit(1), F.greatest(F.size(steps) - ups, F.lit(0)))
    joined = F.array_join(F.concat(kept, F.array(tail)), "/")
    rooted = F.when(base.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined)
    return F.when(has_scheme(href) | href.startswith("/"), href).otherwise(rooted)


_RANGE = re.compile(r"^\s*(\w+)(!?)\[\s*([^:\]]*)\s*:\s*([^:\]]*)\s*\]\s*$")


def range_predicate(limits: str) -> Column:
    """'Classification[2:2], Z[:800]' -> predicate.

    Ranges of the same dimension are alternatives, different dimensions must all hold;
    '!' before the bracket negates a range; an empty bound is open.
    """
    wanted: dict[str, Column] = {}
    for part in re.split(r",(?![^\[]*\])", limits):
        match = _RANGE.match(part)
        if not match:
            raise ValueError(f"not a range: {part!r}")
        name, negated, low, high = match.groups()
        test = F.lit(True)
        if low:
            test = test & (F.col(name) >= F.lit(float(low)))
        if high:
            test = test & (F.col(name) <= F.lit(float(high)))
        test = ~test if negated else test
        wanted[name] = (wanted[name] | test) if name in wanted else test
    predicate = F.lit(True)
    for test in wanted.values():
        predicate = predicate & test
    return predicate
