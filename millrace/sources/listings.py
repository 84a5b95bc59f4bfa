"""Listing pages: anchors that look like stories, with the dates and texts around them.

The tree walk has no SQL form, so a page is parsed by the standard library where it lies;
all filters and limits after that are expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import dates, urls

# Path segments that no article has.
SECTIONS = r"about(?:-us)?|contact(?:-us)?|login|log-in|sign-?in|sign-?up|register|registration|newsletters?|subscribe|subscriptions?|search|tags?|authors?|profiles?|categories|category|topics?|privacy|terms|advertising|cookies?|account|careers|jobs?|collections?|events?|podcasts?|videos?|photos?|pictures?|cartoons?|gallery|galleries|help|faq|sitemap|rss|feeds?"
ANCHORS = "page_id long, pos int, href string, title string, navigation boolean, context string, dated string"
_VOID = {"br", "img", "meta", "link", "hr", "input", "source", "area", "base", "col", "embed", "param", "track", "wbr"}
_SKIP = {"script", "style", "noscript", "template"}
_DATE = re.compile(r"\b(?:\d{4}-\d{2}-\d{2}|\d{1,2} [A-Z][a-z]{2,8} \d{4}|[A-Z][a-z]{2,8} \d{1,2},? \d{4}|\d+ (?:minutes?|hours?|days?) ago)\b")


class _Anchors(HTMLParser):
    """Collects anchors with the text of the paragraph-like block that they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[str] = []
        self.found: list[dict] = []
        self.open: dict | None = None
        self.block: list[str] = []
        self.dated = ""
        self.fresh = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        given = dict(attrs)
        if tag in ("article", "li", "section", "div"):
            self._close()
        if tag == "time" and given.get("datetime"):
            self.dated = given["datetime"]
        if tag == "a" and given.get("href"):
            self.open = {"href": given["href"], "title": "", "navigation": any(t in ("nav", "header", "footer", "aside") for t in self.stack)}
        if tag not in _VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.stack:
            del self.stack[len(self.stack) - 1 - self.stack[::-1].index(tag) :]
        if tag == "a" and self.open:
            self.found.append(self.open)
            self.open = None
        if tag in ("article", "li", "section"):
            self._close()

    def handle_data(self, data: str) -> None:
        if any(t in _SKIP for t in self.stack):
            return
        if self.open is not None:
            self.open["title"] += data
        self.block.append(data)

    def _close(self) -> None:
        told = re.sub(r"\s+", " ", " ".join(self.block)).strip()
        visible = _DATE.search(told)
        for a in self.found[self.fresh :]:
            a["context"], a["dated"] = told, self.dated or (visible.group() if visible else "")
        self.fresh, self.block, self.dated = len(self.found), [], ""


def parse_anchors(html: str | None, most: int = 100, bytes_: int = 2_000_000) -> list[dict]:
    """Up to ``most`` anchors of a page in order; a page over ``bytes_`` has none."""
    if not html or len(html.encode()) > bytes_:
        return []
    parser = _Anchors()
    parser.feed(html)
    parser._close()
    return [{"pos": k, **a, "title": re.sub(r"\s+", " ", a["title"]).strip()} for k, a in enumerate(parser.found[:most])]


def _parsed(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [{"page_id": k} | a for k, html in zip(frame["page_id"], frame["html"], strict=True) for a in parse_anchors(html, most)]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in ANCHORS.split(", ")])


def anchors(pages: DataFrame, most: int = 100) -> DataFrame:
    return pages.select("page_id", "html").mapInPandas(partial(_parsed, most=most), ANCHORS)


def resolved(href: Column, base: Column) -> Column:
    """A link against its page's address."""
    origin = F.regexp_extract(base, r"^([^:]+://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^:]+://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return F.when(href.rlike(r"(?i)^https?://"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]+:)", 1), href)).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(folder, href))


def recent_stories(found: DataFrame, pages: DataFrame, now: Column, days: int = 7, most: int = 20) -> DataFrame:
    """(page_id, url, title, published, snippet) of stories with a date in the window, the first of each address."""
    joined = found.join(pages.select("page_id", F.col("url").alias("base")), "page_id").withColumn("url", urls.canonical_url(resolved(F.col("href"), F.col("base"))))
    good = ~F.col("navigation") & (F.length("title") >= 20) & (F.size(F.split("title", " ")) >= 4) & urls.hosts_match(urls.hostname(F.col("url")), urls.hostname(F.col("base"))) & urls.article_path(F.col("url"), SECTIONS)
    dated = joined.where(good).withColumn("published", dates.parse_any(F.col("dated"), now)).where((F.col("published") <= now) & (F.col("published") >= now - F.expr(f"INTERVAL {days} DAYS")))
    first = dated.withColumn("__n", F.row_number().over(W.partitionBy("page_id", "url").orderBy("pos"))).where("__n = 1")
    kept = first.withColumn("__k", F.row_number().over(W.partitionBy("page_id").orderBy("pos"))).where(F.col("__k") <= most)
    return kept.select("page_id", "url", "title", "published", F.substring("context", 1, 600).alias("snippet"))
