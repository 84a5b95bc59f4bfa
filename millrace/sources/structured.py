"""Objects in pages' embedded JSON: every object at any depth that has an address."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OBJECTS = "page_id long, pos int, url string, headline string, dated string, description string"
_BLOCK = re.compile(r"<script\b[^>]*type=[\"']application/(?:ld\+)?json[\"'][^>]*>(.*?)</script>", re.I | re.S)


def walk(value: object) -> Iterator[dict]:
    """All objects within a value, outer ones first, without recursion."""
    todo = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            yield v
            todo.extend(reversed(list(v.values())))
        elif isinstance(v, list):
            todo.extend(reversed(v))


def objects(html: str | None) -> list[dict]:
    found = []
    for block in _BLOCK.findall(html or ""):
        try:
            value = json.loads(block)
        except ValueError:
            continue
        for o in walk(value):
            url = o.get("url") or o.get("@id")
            if isinstance(url, str) and url:
                text = lambda *names: next((o[n] for n in names if isinstance(o.get(n), str)), None)  # noqa: B023, E731
                found.append({"pos": len(found), "url": url, "headline": text("headline", "name"), "dated": text("datePublished", "dateCreated"), "description": text("description")})
    return found


def _parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [{"page_id": k} | o for k, html in zip(frame["page_id"], frame["html"], strict=True) for o in objects(html)]
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in OBJECTS.split(", ")], dtype=object)


def structured_index(pages: DataFrame) -> DataFrame:
    """One row for each page and address, the last object that names it."""
    found = pages.select("page_id", "html").mapInPandas(_parsed, OBJECTS)
    last = F.row_number().over(W.partitionBy("page_id", "url").orderBy(F.desc("pos")))
    return found.withColumn("__n", last).where("__n = 1").drop("__n")
