"""Settings. Nothing site-specific is hard-coded anywhere else."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SiteSettings:
    """Where articles come from and how a page says what it is about."""

    domain: str = "noticias.example"
    sitemap_template: str = "https://www.{domain}/arc/outboundfeeds/sitemap/{day}/?outputType=xml"
    lookback_days: int = 2
    crawler_name: str = "noticias_sitemap"
    # Fixed values of the page layout.
    sections: tuple[str, ...] = ("economia", "el-mundo", "el-pais", "sociedad")
    section_tag: str = "p12:section"
    island_marker: str = "Fusion.globalContent="
    wrapper_class: str = "article-wrapper"
    date_class: str = "p12Date"
    min_text_length: int = 200
    # Longest name a stored page may have, in bytes.
    max_name_bytes: int = 255
    # Response codes admitted besides 2xx.
    extra_statuses: tuple[int, ...] = (403, 404)


@dataclass(frozen=True)
class TextSettings:
    """How a text becomes terms and which terms are kept."""

    token_pattern: str | None = None
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 3
    max_df: float = 0.8


#: Counts of words and pairs (first model) and weighted words (second model).
COUNT_TEXT = TextSettings()
TFIDF_TEXT = TextSettings(ngram_range=(1, 1), min_df=2, max_df=0.9)


@dataclass(frozen=True)
class ModelSettings:
    """Parameters shared by the three classifiers."""

    k_terms: int = 150
    n_folds: int = 5
    seed: int = 42
    n_components: int = 100
    c: float = 1.0
    max_iter: int = 100
    # Steps of the probability sigmoids.
    sigmoid_max_iter: int = 30
    tol: float = 1e-4
    # 'corpus' fits the vocabulary on all rows before the folds are drawn,
    # 'fold' on the training rows of each fold only.
    fit_scope: str = "corpus"
