"""Character references of HTML as column expressions."""

from __future__ import annotations

import html
from html.entities import html5
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

NAMES = {name: value for name, value in html5.items() if name.endswith(";")}
#: Names that also count without a semicolon, longer ones first.
OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
#: What numbers below 160 stand for where it is not the character of that number (by the standard library's rule).
LOW = {n: text for n in range(160) if (text := html.unescape(f"&#{n};")) != chr(n)}


def _lookup(pairs: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(pairs.items()))), key)


def _character(n: Column) -> Column:
    """The character of a number; U+FFFD where there is none, nothing for code points that are no characters."""
    there = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    none = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    return F.when(n > 0x10FFFF, "�").when(n.between(0xD800, 0xDFFF), "�").when(n < 160, F.coalesce(_lookup(LOW, n.cast("int")), there)).when(none, "").otherwise(there)


def _decoded(piece: Column) -> Column:
    """A piece that starts with an ampersand, with the reference at its start decoded."""
    number = F.regexp_extract(piece, "^&#([0-9]+|[xX][0-9a-fA-F]+);?", 1)
    digits = F.regexp_replace(number, "^([xX]?)0+(?=.)", "$1")
    low = F.substring(digits, 2, 9)
    value = F.when(F.length(digits) > 9, F.lit(0x110000)).when(F.lower(digits).startswith("x"), F.conv(low, 16, 10).cast("bigint")).otherwise(digits.cast("bigint"))
    name = F.regexp_extract(piece, "^&([A-Za-z][A-Za-z0-9]*;)", 1)
    known = F.when(name != "", _lookup(NAMES, name))
    opened = F.regexp_extract(piece, f"^&({'|'.join(OPEN_NAMES)})", 1)
    rest = lambda n: F.substring(piece, n + 1, F.length(piece))
    return (
        F.when(number != "", F.concat(_character(value), F.regexp_replace(piece, "^&#([0-9]+|[xX][0-9a-fA-F]+);?", "")))
        .when(known.isNotNull(), F.concat(known, rest(F.length(name) + 1)))
        .when(opened != "", F.concat(_lookup({n: html5[n] for n in OPEN_NAMES}, opened), rest(F.length(opened) + 1)))
        .otherwise(piece)
    )


def unescape(c: Column) -> Column:
    """The text with every named and numeric reference decoded once, with or without its semicolon where HTML allows that."""
    pieces = F.split(c, "(?=&)")
    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(pieces, lambda p: F.when(p.startswith("&"), _decoded(p)).otherwise(p)), "")).otherwise(c)
