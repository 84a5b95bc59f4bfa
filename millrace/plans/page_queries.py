"""Queries of pages, labels and embedded data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import labels, markup, pages, scores, text
from millrace.plans.catalog import query
from millrace.plans.scalar_queries import _DROPPED_SQL, CANONICAL_SQL, STRIP_SQL
from millrace.sources import structured
from millrace.sources.tables import table


@query("canonical_ladder", CANONICAL_SQL + """
    select page_id, case when ends_with(url, '.html') then 'https://' || host || '/c/' || page_id else canonical end as url, case when ends_with(url, '.html') then 'canonical' when starts_with(url, 'http://') then 'redirected' else 'original' end as status
    from (select * replace (case when starts_with(url, 'http://') and not ends_with(url, '.html') then replace(canonical, 'http://', 'https://') else canonical end as canonical) from c)""")  # fmt: skip
def canonical_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that name an address of their own host, of another one or none; plain ones end up at secure addresses."""
    u = F.col("url")
    host = F.lower(F.regexp_replace(F.regexp_extract(u, r"://([^/?#]*)", 1), r":\d*$", ""))
    own = F.concat(F.lit('<link rel="x canonical" href="https://'), host, F.lit("/c/"), "page_id", F.lit('">'))
    html = F.concat(F.lit("<head>"), F.when(u.endswith(".html"), own).when(u.contains("#"), '<link rel="canonical" href="https://elsewhere.org/">').otherwise(""), "html")
    final = F.regexp_replace(u, "^http://", "https://")
    found = pages.resolved_address(u, final, pages.canonical_link(html, u))
    return table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", found["url"].alias("url"), found["status"].alias("status"))


@query("retrieval_status", f"""
    with t as (select page_id, url, strlen(html) as size, length({STRIP_SQL.replace('{}', _DROPPED_SQL)}) as told from pages)
    select page_id, case when contains(url, '#') then 'invalid_url' when size > 6000 then 'feed_content' when contains(url, '?') then case when size % 2 = 0 then 'blocked' else 'fetch_failed' end
        when ends_with(url, '/') then 'unsupported_content' when size * 500 > 2000000 then 'too_large' when told < 300 then 'insufficient_content' else 'extracted' end as status from t""")  # fmt: skip
def retrieval_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by their addresses and sizes: broken, told by the feed, refused, failing, of another type, too large, thin and whole ones."""
    u, size = F.col("url"), F.octet_length("html")
    status = pages.retrieval_status(F.when(u.contains("#"), F.replace(u, F.lit("."), F.lit(" "))).otherwise(u), F.when(size > 6000, F.col("html")).otherwise(F.left("html", F.lit(299))), F.when(u.contains("?"), F.when(size % 2 == 0, 403).otherwise(500)).otherwise(200), F.when(u.endswith("/"), "image/png").otherwise("text/HTML; charset=utf-8"), size * 500, F.col("html"))
    return table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", status.alias("status"))


_WORDS_SQL = "list_distinct(regexp_extract_all(lower({}), '[\\p{L}\\p{N}]{3,}'))"


@query("page_quality", f"""
    with p as (select page_id, url, html, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as title, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) as paragraphs from pages),
         j as (select a.page_id, a.url, b.title, {STRIP_SQL.replace('{}', _DROPPED_SQL.replace('html', 'a.html'))} as body, a.paragraphs from p a join p b on b.page_id = a.page_id - case when contains(a.url, '?') and a.page_id > 0 then 1 else 0 end),
         w as (select *, {_WORDS_SQL.replace('{}', 'title')} as tw, list_intersect({_WORDS_SQL.replace('{}', 'title')}, {_WORDS_SQL.replace('{}', 'body')}) as shared from j)
    select page_id, case when contains(url, '/de/') then 'wall' when len(shared) < 2 or len(shared) < 0.45 * len(tw) then 'mismatch' when len(list_filter(paragraphs, lambda x: length(x) >= 60)) >= 2 then 'full' else 'partial' end as quality from w""")  # fmt: skip
def page_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages against their own titles or, with a query in the address, those of the page before; German ones end at a wall."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    rows = table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", "url", markup.visible(F.col("html")).alias("body"), F.regexp_extract_all("html", F.lit(r"(?s)<p>(.*?)</p>"), 1).alias("paragraphs"), title.alias("title"))
    of = F.col("page_id") - F.when(F.col("url").contains("?") & (F.col("page_id") > 0), 1).otherwise(0)
    joined = rows.drop("title").withColumn("of", of).join(rows.select(F.col("page_id").alias("of"), "title"), "of")
    body = F.when(F.col("url").contains("/de/"), F.concat("body", F.lit(" Sign in to continue"))).otherwise(F.col("body"))
    return joined.select("page_id", pages.page_quality(F.col("title"), body, F.col("paragraphs")).alias("quality"))


@query("challenge_pages", "select page_id, ends_with(url, '.html') and not contains(url, '/es/') as challenge from pages")
def challenge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some pages get the title, the headline or the form that asks for proof, in words that differ by language."""
    u = F.col("url")
    mark = F.when(u.contains("/en/"), "<title>Just a moment...</title>").when(u.contains("/de/"), '<h1 class="x">Are you a robot?</h1>').when(u.contains("/fr/"), '<form method="post" action="/consent/save">').otherwise("<title>Moment</title>")
    html = F.when(u.endswith(".html"), F.concat(mark, "html")).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", pages.challenge(html).alias("challenge"))


@query("structured_objects", """
    with p as (select page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as title, length(html) % 3 as n, (select regexp_extract(b.html, '(?is)<title[^>]*>(.*?)</title>', 1) from pages b where b.page_id = pages.page_id - 1) as before from pages)
    select page_id, 'https://x.org/' || k as url, case when k = page_id then title else coalesce(before, 'first') end as headline, '2024-01-0' || (1 + n) as dated from (select *, unnest([page_id, page_id + 1000000][1:1 + n]) as k from p)""")  # fmt: skip
def structured_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page with its title in a nested object that is named twice, the later of which counts, some with the page before's, beside a block that isn't JSON."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    rows = table(spark, sf_dir, "pages", "page_id", "html").select("page_id", title.alias("title"), (F.length("html") % 3).alias("n"))
    told = rows.join(rows.select((F.col("page_id") + 1).alias("page_id"), F.col("title").alias("before")), "page_id", "left")
    one = lambda k, headline: F.struct(F.concat(F.lit("https://x.org/"), k).alias("url"), headline.alias("headline"), F.concat(F.lit("2024-01-0"), 1 + F.col("n")).alias("datePublished"))
    k = F.col("page_id")
    own = [one(k, F.lit("stale")), one(k, F.col("title")), one(k + 1000000, F.coalesce("before", F.lit("first")))]
    graph = F.to_json(F.struct(F.array(F.struct(own[0].alias("a")), F.struct(own[1].alias("a"))).alias("@graph"), F.when(F.col("n") > 0, own[2]).alias("more")))
    block = F.concat(F.lit('<script type="application/ld+json">'), graph, F.lit('</script><script type="application/json">{broken</script>'))
    return structured.structured_index(told.select("page_id", block.alias("html"))).select("page_id", "url", "headline", "dated")


@query("acquisition_method", """
    select event_id, case when event_type = 'click' then 'listing' when event_type = 'error' then 'discovery_fallback' when event_type = 'view' then 'google_news_rss' else 'rss' end as method,
           case when event_type in ('click', 'error') then 'first' when event_type = 'view' then 'second' end as provider from events""")  # fmt: skip
def acquisition_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    method = labels.acquisition_method(F.when(kind == "click", "listing").otherwise(""), F.when(kind == "error", "api"), F.when(kind == "view", "https://news.google.com/x").otherwise("https://a.org"))
    provider = labels.provider_key(kind, {"click": "first", "error": "first", "vie": "second"})
    return table(spark, sf_dir, "events", "event_id", "event_type").select("event_id", method.alias("method"), provider.alias("provider"))


@query("property_json", """
    select c_custkey, '{"title":[{"text":{"content":"' || c_name || '"}}]}' as title, '{"number":' || case when c_nationkey % 2 = 0 then c_nationkey || '.0' else 'null' end || '}' as number, '{"select":{"name":"' || c_mktsegment || '"}}' as choice, 'Dear ' || c_name || ', ' || c_mktsegment as letter from customer""")  # fmt: skip
def property_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    number = labels.typed_property("number", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")))
    letter = labels.rendered(F.lit("Dear {{name}}, {{segment}}{{nothing}}"), {"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "nothing": F.lit(None)})
    return rows.select("c_custkey", labels.typed_property("title", F.col("c_name")).alias("title"), number.alias("number"), labels.typed_property("select", F.col("c_mktsegment")).alias("choice"), letter.alias("letter"))


@query("signal_tiers", """
    with t as (select doc_id, lower(text) as x from documents), f as (select doc_id, regexp_matches(x, '(^|[^a-z])the($|[^a-z])') as noun, regexp_matches(x, 'ingth') as application, list_filter([case when contains(x, 'tion') then 'A' end, case when contains(x, 'ung') then 'B' end], lambda v: v is not null) as topics from t)
    select doc_id, case when noun and not application and len(list_filter(topics, lambda v: v <> 'A')) = 0 then list_filter(topics, lambda v: v <> 'A') else topics end as topics,
           case when len(topics) = 0 then 0 else least(3, least(len(topics), 2) + case when application then 1 else 0 end) end::int as strength, noun and not application and (application or true) as foreign_local from f""")  # fmt: skip
def signal_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.lower("text")
    noun, application = x.rlike(r"(^|[^a-z])the($|[^a-z])"), x.contains("ingth")
    topics = F.array_compact(F.array(F.when(x.contains("tion"), "A"), F.when(x.contains("ung"), "B")))
    read = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", noun.alias("noun"), application.alias("application"), topics.alias("t"))
    kept = labels.guarded(F.col("t"), ("A",), F.col("noun"), F.col("application"))
    return read.select("doc_id", kept.alias("topics"), labels.strength(F.col("t"), F.col("application"), F.lit(False))["strength"].alias("strength"), labels.foreign_local(F.col("noun"), F.col("application"), F.col("application"), F.lit(False)).alias("foreign_local"))


@query("page_fields", """
    with p as (select page_id, regexp_extract(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '([^/]*)/?$', 1) as segment, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as title, regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) as anchors from pages)
    select page_id, case when try_cast(segment as bigint) >= 0 then try_cast(segment as bigint) end as size, least(5, greatest(1, coalesce(try_cast(segment as bigint), 3)))::int as score, replace(lower(trim(title)), ' ', '_') as status,
           list_filter(anchors, lambda x, i: trim(x) <> '' and list_position(anchors, x) = i) as labels from p""")  # fmt: skip
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last part of an address says as a size and as a score, titles as statuses of one spelling, anchors as labels without repeats."""
    segment = F.regexp_extract(F.regexp_extract("url", r"://[^/?#]*([^?#]*)", 1), r"([^/]*)/?$", 1)
    title, anchors = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), 1)
    return table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", labels.content_length(segment).alias("size"), scores.clamped(segment).alias("score"), text.evidence_status(title).alias("status"), text.distinct_labels(anchors).alias("labels"))
