"""News-text mining as Spark jobs: acquire, extract, vectorise, classify, report."""

from newsmine.config import ModelSettings, SiteSettings, TextSettings

__all__ = ["ModelSettings", "SiteSettings", "TextSettings"]
