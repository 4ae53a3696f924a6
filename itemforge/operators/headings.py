"""How lines of an exam's Markdown open items, groups and parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What opens an item (its line break included), a group and a part.
ITEM = r"^(?:\$\\(?:star|bigstar|ast)\$\s*|\$?\\pm\s*|\\[*]\s*|[\*\u00b1•-]\s*|\*\*\s*)?(?:Quest[aã]o\s+)?(\d{1,3})(?:\.(\d{1,2}))?(?:\s*\.\s*(?:\*\*)?\s*\$?\s+|\s*\.\*\*\s+|(?=[A-ZÁÉÍÓÚÀÂÃÇ]))"
GROUP_HEADING = r"^#{1,3}\s*[Gg][Rr][Uu][Pp][Oo]\s+(I{1,3}|IV|VI{0,3}|IX|X)\b"
PART_HEADING = r"^#{1,3}\s+(?:[Pp][Aa][Rr][Tt][Ee]\s+)?([A-C])\s*$"
SCORING = r"^#{1,3}\s*COTA[ÇC][ÕO]ES\b"
#: Beyond the headings, a line that holds nothing else.
GROUP_LINE = r"^\s*(?i:grupo)\s+(I{1,3}|IV|VI{0,3}|IX|X)\s*$"
PART_LINE = r"^\s*(?i:parte)\s+([A-C])\s*$"


def found(line: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, group), F.lit(""))


def group_of(line: Column) -> Column:
    """The roman numeral of the group that a line opens, else null."""
    return F.coalesce(found(line, GROUP_HEADING), found(line, GROUP_LINE))


def part_of(line: Column) -> Column:
    """The letter of the part that a line opens, else null."""
    return F.coalesce(found(line, PART_HEADING), found(line, PART_LINE))
