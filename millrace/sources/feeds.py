"""RSS and Atom feeds, one file each, parsed where they are read.

A file that isn't XML and gives no entry is a parse error; one that breaks off after entries
keeps these. Each file yields its articles and one attempt row, so one bad feed never costs
the others theirs. Fetching is a connector's matter: files come from wherever Spark reads.
"""

from __future__ import annotations

from collections.abc import Iterator
from email.utils import parsedate_to_datetime
from io import BytesIO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates, markup, text, urls

ENTRIES = "path string, outcome string, error string, pos int, link string, links array<string>, title string, summary string, contents array<string>, dated string, image string"
#: Rows that a task holds before it hands them on, however many entries its files have.
HELD = 1_000


def _name(tag: str) -> str:
    return tag.rpartition("}")[2].lower()


def parse_feed(data: bytes) -> tuple[list[dict], str]:
    """(entries, error): those before a break are kept."""
    entries, error = [], ""
    try:
        for _, node in ElementTree.iterparse(BytesIO(data), events=("end",)):
            if _name(node.tag) not in ("item", "entry"):
                continue
            found: dict[str, list[str]] = {}
            images = []
            for child in node.iter():
                name = _name(child.tag)
                value = (child.text or "").strip() or child.get("href", "")
                if name in ("enclosure", "content", "thumbnail") and child.get("url") and (name != "enclosure" or child.get("type", "").startswith("image")):
                    images.append(child.get("url"))
                elif value and child is not node:
                    found.setdefault(name, []).append(value)
            one = lambda *names: next((found[n][0] for n in names if n in found), "")  # noqa: E731, B023
            entries.append({"link": one("link"), "links": found.get("link", []) + found.get("origlink", []), "title": one("title"), "summary": one("description", "summary"), "contents": found.get("encoded", []) + found.get("content", []), "dated": one("pubdate", "published", "updated", "created", "date"), "image": images[0] if images else ""})
            node.clear()
    except ElementTree.ParseError as e:
        error = str(e)
    return entries, "" if entries else error


def _iso(raw: str) -> str:
    try:
        return parsedate_to_datetime(raw).isoformat() if raw else ""
    except (TypeError, ValueError):
        return raw


def _parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in ENTRIES.split(", ")]

    def framed(rows: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        out["pos"] = out["pos"].astype("Int32")
        return out

    for frame in frames:
        rows = []
        for path, data in zip(frame["path"], frame["content"], strict=True):
            entries, error = parse_feed(data)
            told = {"path": path, "outcome": "Parse Error" if error else "Success" if entries else "Empty", "error": error[:1000]}
            if not entries:
                rows.append(told | {"pos": None, "link": "", "links": [], "title": "", "summary": "", "contents": [], "dated": "", "image": ""})
            for k, e in enumerate(entries):
                rows.append(told | {"pos": k} | e | {"dated": _iso(e["dated"])})
                if len(rows) >= HELD:
                    yield framed(rows)
                    rows = []
            if len(rows) >= HELD:
                yield framed(rows)
                rows = []
        if rows:
            yield framed(rows)


def read_feeds(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw rows of all files; a file without entries is one row with a null ``pos``."""
    return parse_feeds(spark.read.format("binaryFile").load(paths).select("path", "content"))


def stream_feeds(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_feeds``, for files that arrive: a run reads those that no run before it has read, by its own checkpoint."""
    return parse_feeds(spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path))


def parse_feeds(files: DataFrame) -> DataFrame:
    """Raw rows of (path string, content binary)."""
    return files.select("path", "content").mapInPandas(_parsed, ENTRIES)


def feed_articles(raw: DataFrame, wrapper: str = "news.google.com") -> DataFrame:
    """Articles: the first link that isn't a wrapper's, clean title and snippet, evidence from the first content block of 300 characters, never the summary."""
    links = F.filter(F.array_compact(F.concat(F.array("link"), "links", F.regexp_extract_all("summary", F.lit(r"""href=['"]([^'"]+)['"]"""), 1))), lambda x: x != "")
    direct = F.filter(links, lambda x: ~urls.loose_suffix(x, wrapper))
    link = F.coalesce(F.try_element_at(direct, F.lit(1)), F.try_element_at(links, F.lit(1)))
    return raw.where("pos is not null").select(
        "path", "pos", urls.canonical_url(F.coalesce(link, F.lit(""))).alias("url"), text.clean_text(F.col("title")).alias("title"), text.snippet(F.coalesce("summary", F.lit(""))).alias("snippet"),
        dates.parse_iso(F.col("dated")).alias("published"), F.coalesce("image", F.lit("")).alias("image_url"), markup.first_article_text(F.col("contents")).alias("evidence"),
        F.when(urls.loose_suffix(F.coalesce(link, F.lit("")), wrapper), "unresolved").when(F.size(direct) < F.size(links), "resolved_feed_metadata").otherwise("publisher_url").alias("resolution"),
    ).where("url <> ''")


def feed_attempts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("path").agg(F.max("outcome").alias("outcome"), F.count("pos").alias("article_count"), F.max("error").alias("error"))
