"""Small labels and coercions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import urls


def provider_key(name: Column, known: dict[str, str]) -> Column:
    """The key of the first known text, in order, that a name contains."""
    return F.coalesce(*(F.when(F.lower(name).contains(part), F.lit(key)) for part, key in known.items()), F.lit(None).cast("string"))


def acquisition_method(method: Column, provider: Column, url: Column, wrapper: str = "news.google.com") -> Column:
    """What is stated, else a fallback for found stories, else by the address."""
    stated = F.nullif(F.coalesce(method, F.lit("")), F.lit(""))
    by_url = F.when(urls.loose_suffix(F.coalesce(url, F.lit("")), wrapper), "google_news_rss").otherwise("rss")
    return F.coalesce(stated, F.when(F.coalesce(provider, F.lit("")) != "", "discovery_fallback"), by_url)


def whole_number(x: Column, default: int = 0) -> Column:
    return F.coalesce(F.trim(x.cast("string")).try_cast("int"), F.lit(default))


def content_length(header: Column) -> Column:
    """A header's size, null unless it is a number of 0 or more."""
    n = F.trim(header).try_cast("bigint")
    return F.when(n >= 0, n)


def rendered(template: Column, values: dict[str, Column]) -> Column:
    """A template with its {{names}} replaced; null values are empty."""
    return reduce(lambda t, kv: F.replace(t, F.lit("{{" + kv[0] + "}}"), F.coalesce(kv[1].cast("string"), F.lit(""))), values.items(), template)


def typed_property(kind: str, value: Column) -> Column:
    """A value as the JSON that a typed document property holds; blank titles read Untitled, blank addresses null."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    bodies = {
        "title": F.struct(F.array(F.struct(F.struct(F.when(text == "", "Untitled").otherwise(text).alias("content")).alias("text"))).alias("title")),
        "rich_text": F.struct(F.when(text == "", F.array().cast("array<struct<text:struct<content:string>>>")).otherwise(F.array(F.struct(F.struct(text.alias("content")).alias("text")))).alias("rich_text")),
        "url": F.struct(F.nullif(text, F.lit("")).alias("url")),
        "number": F.struct(text.try_cast("double").alias("number")),
        "checkbox": F.struct(text.isin("true", "1").alias("checkbox")),
        "select": F.struct(F.when(text != "", F.struct(text.alias("name"))).alias("select")),
        "status": F.struct(F.when(text != "", F.struct(text.alias("name"))).alias("status")),
        "date": F.struct(F.when(text != "", F.struct(text.alias("start"))).alias("date")),
    }
    return F.to_json(bodies[kind], {"ignoreNullFields": "false"})


def guarded(topics: Column, dropped: tuple[str, ...], noun: Column, application: Column) -> Column:
    """The topics without ``dropped`` where a text names a thing but none of its uses and no other topic holds."""
    rest = F.array_except(topics, F.array(*map(F.lit, dropped)))
    return F.when(noun & ~application & (F.size(rest) == 0), rest).otherwise(topics)


def strength(core: Column, concrete: Column, systemic: Column) -> Column:
    """struct<strength, concrete>: 0 to 3 by core topics, a concrete project and a wide scope."""
    score = F.least(F.lit(3), F.least(F.size(core), F.lit(2)) + F.when(concrete | systemic, 1).otherwise(0))
    return F.struct(F.when(F.size(core) == 0, 0).otherwise(score).cast("int").alias("strength"), concrete.alias("concrete"))


def foreign_local(outside: Column, inside: Column, local: Column, systemic: Column) -> Column:
    """A title set elsewhere, without a place of interest, that is local or has no wide scope."""
    return outside & ~inside & (local | ~systemic)
