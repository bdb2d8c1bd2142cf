"""Crawler log lines worth showing."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmine.config import SiteSettings

# Marks of relevant lines, besides the crawler's own name.
MARKS = (
    "Crawled (",
    "[omitido]",
    "[fuera-de-seccion]",
    "Redirecting",
    "Retrying",
    "Spider opened",
    "Closing spider",
    "Spider closed",
    "Enabled extensions",
)
MARKS_ANY_CASE = ("ERROR", "WARNING")


def relevant(line: Column, site: SiteSettings) -> Column:
    exact = [line.contains(m) for m in (f"[{site.crawler_name}]", *MARKS)]
    loose = [F.upper(line).contains(m) for m in MARKS_ANY_CASE]
    return reduce(or_, exact + loose)


def without_timestamp(line: Column) -> Column:
    """Drop the leading ``YYYY-MM-DD HH:MM:SS`` and the blank after it."""
    dated = (F.length(line) > 20) & (F.substring(line, 5, 1) == "-")
    return F.when(dated, F.substring(line, 21, 1_000_000_000)).otherwise(line)


def duration_text(start: Column, end: Column) -> Column:
    """Time between two timestamps as ``[-]D day(s), H:MM:SS``, whole seconds, rounded down."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    seconds = F.floor(micros / 1_000_000)
    days, rest = F.floor(seconds / 86_400), F.pmod(seconds, F.lit(86_400))
    unit = F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")
    clock = F.format_string("%d:%02d:%02d", F.floor(rest / 3600), F.floor(rest / 60) % 60, rest % 60)
    return F.concat(F.when(days != 0, F.concat(days.cast("string"), unit)).otherwise(""), clock)
