"""Fetched pages: what they are, where they belong, and how far to trust them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import markup, text, urls
from millrace.functions.bind import let


def canonical_link(html: Column, base: Column) -> Column:
    """The first canonical link of a page, against its address; empty without one."""
    tag = F.regexp_extract(html, r"""(?is)<link\b[^>]*\brel=["'][^"']*\bcanonical\b[^"']*["'][^>]*>""", 0)
    origin, scheme, folder = F.regexp_extract(base, r"^([^:]+://[^/?#]*)", 1), F.regexp_extract(base, "^([^:]+:)", 1), F.regexp_extract(base, r"^([^:]+://[^?#]*/)", 1)
    full = lambda href: F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(folder, href))
    return let(F.regexp_extract(tag, r"""(?i)\bhref=["']([^"']*)["']""", 1), lambda href: F.when(href == "", "").otherwise(urls.canonical_url(full(href))))


def challenge(html: Column) -> Column:
    """Whether a page asks for consent or proof instead of telling its story."""
    head = F.concat_ws(" ", F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    return head.rlike(r"(?i)just a moment|access denied|are you (?:a )?(?:human|robot)|before you continue|captcha|attention required|verify you") | html.rlike(r"(?is)<form[^>]+action=[\"'][^\"']*(?:consent|challenge|captcha)")


def confident_publisher(candidate: Column, final: Column, original: Column, wrapper: str = "news.google.com") -> Column:
    """A canonical address counts if it shares its host with where the fetch ended or began, unless that is a wrapper's."""
    host = urls.hostname(candidate)
    return ~F.endswith(host, F.lit(wrapper)) & (urls.hosts_match(host, urls.hostname(final)) | urls.hosts_match(host, urls.hostname(original)))


def resolved_address(original: Column, final: Column, canonical: Column, wrapper: str = "news.google.com") -> Column:
    """struct<url, status>: the page's own canonical address, else where the fetch ended, else where it began."""
    told = lambda url, status: F.struct(url.alias("url"), F.lit(status).alias("status"))

    def decide(a: Column) -> Column:
        return (
            F.when((a["c"] != "") & confident_publisher(a["c"], a["f"], a["o"], wrapper), told(a["c"], "canonical"))
            .when((a["f"] != a["o"]) & ~urls.loose_suffix(a["f"], wrapper), told(a["f"], "redirected"))
            .when(urls.loose_suffix(a["o"], wrapper), told(a["o"], "unresolved"))
            .otherwise(told(a["o"], "original"))
        )

    return let(F.struct(urls.canonical_url(canonical).alias("c"), urls.canonical_url(final).alias("f"), urls.canonical_url(original).alias("o")), decide)


def retrieval_status(url: Column, feed_text: Column, http_status: Column, content_type: Column, size: Column, html: Column, least: int = 300, most_bytes: int = 2_000_000) -> Column:
    """How a retrieval ended; evidence from the feed itself comes before any fetch."""
    return (
        F.when(urls.safe_http_url(url) == "", "invalid_url")
        .when(F.length(feed_text) >= least, "feed_content")
        .when(http_status.isin(401, 403, 429, 451) | challenge(F.coalesce(html, F.lit(""))), "blocked")
        .when(http_status.isNull() | (http_status >= 400), "fetch_failed")
        .when(~F.lower(F.coalesce(content_type, F.lit(""))).rlike("html"), "unsupported_content")
        .when(size > most_bytes, "too_large")
        .when(markup.article_text(html, least) == "", "insufficient_content")
        .otherwise("extracted")
    )


def overlay(status: Column, new: Column, old: Column) -> Column:
    """The new value where the retrieval gave one, else what was there."""
    return F.when(text.has_evidence(status), F.coalesce(F.nullif(new, F.lit("")), old)).otherwise(old)


def page_quality(title: Column, body: Column, paragraphs: Column) -> Column:
    """full, partial, wall or mismatch: how much of the expected story a page holds."""
    words = lambda x: F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(r"([\p{L}\p{N}]{3,})"), 1))
    shared = F.size(F.array_intersect(words(title), words(body)))
    long = F.size(F.filter(paragraphs, lambda p: F.length(p) >= 60))
    return (
        F.when(F.lower(body).rlike(r"subscribe to (?:read|continue)|sign in to (?:read|continue)|already a subscriber"), "wall")
        .when((shared < 2) | (shared < 0.45 * F.size(words(title))), "mismatch")
        .when(long >= 2, "full").otherwise("partial")
    )
