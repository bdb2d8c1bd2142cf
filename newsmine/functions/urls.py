"""Article links: recognition, parts, file key, host admission."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmine.config import SiteSettings


def article_pattern(site: SiteSettings) -> str:
    """``…/YYYY/MM/DD/slug``, any case, optional ``www.`` and final slash, end-anchored."""
    host = re.escape(site.domain)
    return (
        rf"(?i)https?://(?:www\.)?{host}"
        r"/([0-9]{4})/([0-9]{2})/([0-9]{2})/([a-z0-9][a-z0-9-]*)/?$"
    )


def is_article(url: Column, site: SiteSettings) -> Column:
    """A print view is no article; the start is not anchored."""
    return ~url.contains("/print/") & url.rlike(article_pattern(site))


def url_parts(url: Column, site: SiteSettings) -> dict[str, Column]:
    """Year, month, day, slug as they are written (no calendar check)."""
    pattern = article_pattern(site)
    names = ("year", "month", "day", "slug")
    return {n: F.regexp_extract(url, pattern, i) for i, n in enumerate(names, 1)}


def file_name(url: Column, site: SiteSettings) -> Column:
    return F.concat(F.concat_ws("-", *url_parts(url, site).values()), F.lit(".html"))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"(?i)^https?://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def host_allowed(url: Column, site: SiteSettings) -> Column:
    """The site itself or one of its sub-domains."""
    name = host(url)
    return (name == site.domain) | name.endswith("." + site.domain)


def status_admitted(status: Column, site: SiteSettings) -> Column:
    return status.between(200, 299) | status.isin(*site.extra_statuses)
