"""Queries of connectors and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators.gates import source_errors
from millrace.plans import ingestion
from millrace.plans.catalog import query
from millrace.plans.scalar_queries import CLEAN_SQL
from millrace.sources import collect, feeds, listings, state
from millrace.sources.tables import table
from millrace.streaming import quota
from millrace.streaming import state as streams


@query("feed_scan", f"""
    select doc_id, 'https://' || source || '.example.com/a/' || doc_id as url, {CLEAN_SQL.replace('{}', "split_part(text, chr(10), 1)")} as title, make_timestamp(1704067200000000 + (doc_id % 1000) * 60000000) as published from documents""")  # fmt: skip
def feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a one-entry feed, parsed back. Titles may hold markup, which is stripped and unescaped twice."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    line = F.substring_index("text", "\n", 1)
    dated = F.date_format(F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 1000) * 60), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    xml = F.concat(F.lit("<rss><channel><item><title>"), _escaped(line), F.lit("</title><link>https://"), "source", F.lit(".example.com/a/"), "doc_id", F.lit("?utm_source=feed</link><pubDate>"), dated, F.lit("</pubDate></item></channel></rss>"))
    files = docs.select(F.col("doc_id").cast("string").alias("path"), F.encode(xml, "UTF-8").alias("content"))
    return feeds.feed_articles(feeds.parse_feeds(files)).select(F.col("path").cast("long").alias("doc_id"), "url", "title", "published")


def _escaped(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("feed_outcomes", """
    with f as (select lang, len(string_split(text, chr(10))) as n, n_chars % 2 = 0 as whole from documents), o as (select case when lang = 'de' then 'Parse Error' when lang = 'es' and whole then 'Empty' when lang = 'es' then 'Parse Error' else 'Success' end as outcome, n from f)
    select outcome, count(*) as feeds, sum(case when outcome = 'Success' then n else 0 end)::bigint as articles from o group by 1""")  # fmt: skip
def feed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feeds with an item for each line, some broken off after them; German ones are no feeds, Spanish ones have no items."""
    items = F.array_join(F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<item><title>"), _escaped(x), F.lit("</title><link>https://a.example.com/x</link></item>"))), "")
    end = F.when(F.col("n_chars") % 2 == 0, "</channel></rss>").otherwise("<broken>")
    xml = F.when(F.col("lang") == "de", F.col("text")).otherwise(F.concat(F.lit("<rss><channel>"), F.when(F.col("lang") == "es", "").otherwise(items), end))
    files = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "n_chars").select(F.col("doc_id").cast("string").alias("path"), F.encode(xml, "UTF-8").alias("content"))
    return feeds.feed_attempts(feeds.parse_feeds(files)).groupBy("outcome").agg(F.count("*").alias("feeds"), F.sum("article_count").alias("articles"))


@query("listing_anchors", """select page_id, count(*) as anchors, count(*) filter (where nav) as navigation from (select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="[^"]*"')) as a, true as nav from pages) group by 1""")
def listing_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.anchors(table(spark, sf_dir, "pages", "page_id", "html")).groupBy("page_id").agg(F.count("*").alias("anchors"), F.count_if("navigation").alias("navigation"))


@query("recent_stories", """
    select page_id, regexp_extract(url, '^([^?#]*://[^/?#]*)', 1) || '/2024/a-story-of-five-words-' || k as url from (select page_id, url, unnest(generate_series(1, 1 + strlen(html) % 4)) as k, strlen(html) % 9 as age from pages) where (age + k) % 9 < 7""")  # fmt: skip
def recent_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to four cards a page, dated by its size, beside its navigation; those of the last week are found."""
    size = F.octet_length("html")

    def card(k: Column) -> Column:
        day = F.date_format(F.lit("2024-02-01").cast("timestamp") - F.make_dt_interval(((size % 9 + k) % 9).cast("int"), F.lit(1)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return F.concat(F.lit('<ul><li><a href="/2024/a-story-of-five-words-'), k, F.lit('"><h3>A story told in five words</h3></a><time datetime="'), day, F.lit('">then</time><p>More of it here</p></li></ul>'))

    cards = F.array_join(F.transform(F.sequence(F.lit(1), 1 + size % 4), card), "")
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", "url", F.concat(F.lit('<nav><a href="/about">A way to all of our sections</a></nav>'), cards).alias("html"))
    return listings.recent_stories(listings.anchors(pages), pages, F.lit("2024-02-01").cast("timestamp")).select("page_id", "url")


@query("source_validation", """
    select s_suppkey, list_filter([case when s_suppkey % 5 = 4 then 'type' end, case when s_acctbal / 1000 not between 1 and 10 then 'quality' end, case when s_suppkey % 5 < 3 and s_suppkey % 7 = 0 then 'frequency' end, case when s_suppkey % 5 < 3 and s_suppkey % 11 = 0 then 'feed URL' end], lambda x: x is not null) as errors from supplier""")  # fmt: skip
def source_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    kind = F.when(k % 5 == 4, "Blog").when(k % 5 == 3, "Discovery Provider").otherwise("Publisher")
    errors = source_errors(kind, F.col("s_acctbal") / 1000, F.when(k % 7 != 0, "Daily"), F.lit("RSS"), F.when(k % 11 != 0, "https://f.example.com/rss"))
    return table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal").select("s_suppkey", errors.alias("errors"))


@query("source_health", """
    select user_id as source_id, max(ts) as last_attempt, max(ts) filter (where event_type <> 'error') as last_success, arg_max(case when event_type = 'error' then 'HTTP Error' else 'Success' end, ts) as outcome, arg_max(case when event_type = 'error' then props else '' end, ts) as error from events group by 1""")  # fmt: skip
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    attempts = table(spark, sf_dir, "events", "user_id", "ts", "event_type", "props").select(F.col("user_id").alias("source_id"), F.col("ts").alias("attempted_at"), F.when(failed, "HTTP Error").otherwise("Success").alias("outcome"), F.when(failed, F.col("props")).alias("error"))
    return state.latest_health(attempts)


@query("find_or_create", "select distinct c.c_custkey as k from customer c where c.c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')")
def find_or_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("k"))
    return state.insert_missing(wanted, table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), ["k"])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.read_stream(spark, f"{sf_dir}/events.parquet", "ts")


@query("stream_seen_dedupe", "select distinct user_id, event_type from events")
def stream_seen_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = streams.first_of_each(_events(spark, sf_dir), ["user_id", "event_type"], "ts", "365 days")
    return streams.run_available(stream.select("user_id", "event_type"), "append")


@query("stream_weekly_counts", "select date_trunc('week', ts)::date as monday, event_type, count(*) as n from events group by 1, 2")
def stream_weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.run_available(streams.weekly_counts(_events(spark, sf_dir), ["event_type"], "ts"), "complete")


@query("stream_source_health", """
    select user_id, max(ts) as last_attempt, max(ts) filter (where event_type <> 'error') as last_success, arg_max(case when event_type = 'error' then 'failure' else 'success' end, ts) as outcome from events group by 1""")  # fmt: skip
def stream_source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.run_available(streams.source_health(_events(spark, sf_dir), "user_id", "ts", F.col("event_type") == "error"), "complete")


@query("stream_late_drop", "select event_type, count(*) as late from events where ts < timestamp '2024-01-31' - interval 7 day group by 1")
def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, late = streams.split_late(_events(spark, sf_dir), "ts", F.lit("2024-01-31").cast("timestamp"), 7)
    return streams.run_available(late.select("event_type", "reason"), "append").groupBy("event_type").agg(F.count("*").alias("late"))


@query("ingest_batch")
def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over documents as articles: gates, identity, events, ranks and selection."""
    return ingestion.run(spark, sf_dir)


_TARGETS = {"click": 60, "view": 35, "purchase": 20, "signup": 5}


@query("stream_weekly_quota", f"""
    with own as (select *, date_trunc('week', ts)::date as monday, row_number() over (partition by date_trunc('week', ts), event_type, user_id order by ts, event_id) as n from events),
         placed as (select *, row_number() over (partition by monday, event_type order by ts, event_id) as place from own where n <= 2)
    select monday, event_type as region, user_id::varchar as publisher, event_id as id, ts as at, place from placed
    where place <= case event_type {' '.join(f"when '{k}' then {n}" for k, n in _TARGETS.items())} else 0 end""")  # fmt: skip
def stream_weekly_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The week's admissions by kind of event, two of a user at most, out of carried state; kinds without a target have no room."""
    stream = streams.read_stream(spark, f"{sf_dir}/events.parquet", "ts")
    found = quota.weekly_quota(stream, "ts", "event_id", F.col("event_type"), F.col("user_id"), _TARGETS, 2)
    return streams.run_available(found, "append").where("kind = 'admitted'").drop("kind")


@query("collected_sources", f"""
    with d as (select doc_id, source, lang, n_chars, {CLEAN_SQL.replace('{}', "split_part(text, chr(10), 1)")} as title, strlen(text) as size from documents),
         o as (select *, case when lang = 'es' then 'Fetch Error' when n_chars < 300 then 'HTTP Error' when n_chars % 2 = 0 and lang = 'de' then 'Unchanged' when strpos(title, 'a') = 0 then 'Empty' else 'Success' end as outcome from d where lang <> 'fr')
    select doc_id::varchar as source_id, outcome, (outcome = 'Success')::int as article_count, case when outcome = 'HTTP Error' then 3 when outcome <> 'Fetch Error' then 1 end as attempts,
           case when outcome = 'HTTP Error' then 2000 + size when outcome <> 'Fetch Error' then size end::int as duration_ms from o""")  # fmt: skip
def collected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a source with a feed of its own: French ones aren't fetched as feeds, Spanish ones never answer, short ones fail three times, some German ones are unchanged, and those whose first line has no "a" are empty."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars")
    line, address = F.substring_index("text", "\n", 1), F.concat(F.lit("https://"), "source", F.lit(".example.com/"), "doc_id")
    clean = text.clean_text(line)
    item = F.when(F.contains(clean, F.lit("a")), F.concat(F.lit("<item><title>"), _escaped(line), F.lit("</title><link>"), address, F.lit("</link></item>"))).otherwise("")
    body = F.encode(F.concat(F.lit("<rss><channel>"), item, F.lit("</channel></rss>")), "UTF-8")
    registry = docs.select(F.col("doc_id").cast("string").alias("source_id"), F.col("source").alias("source_name"), address.alias("feed_url"), F.when(F.col("lang") == "fr", "listing").otherwise("RSS ").alias("collection_method"), F.col("lang").alias("source_region"), F.array("lang").alias("topics"), F.lit(5.0).alias("quality"))
    short = F.col("n_chars") < 300
    status = F.when(short, 503).when((F.col("n_chars") % 2 == 0) & (F.col("lang") == "de"), 304).otherwise(200)
    tried = docs.where("lang <> 'es'").withColumn("attempt", F.explode(F.when(short, F.sequence(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1)))))
    began = F.timestamp_seconds(F.lit(1704067200) + F.col("attempt"))
    fetches = tried.select(address.alias("url"), "attempt", status.alias("status"), body.alias("content"), F.lit(None).cast("string").alias("error"), began.alias("started_at"), F.timestamp_millis(F.unix_millis(began) + F.octet_length("text")).alias("ended_at"))
    return collect.collected(registry, fetches)[1].select("source_id", "outcome", "article_count", "attempts", "duration_ms")


@query("feed_links", """
    select doc_id, case when lang = 'de' then 'https://news.google.com/rss/' || doc_id else 'https://' || source || '.example.com/' || n_chars end as url,
           case when lang = 'de' then 'unresolved' when lang = 'es' then 'publisher_url' else 'resolved_feed_metadata' end as resolution, case when lang = 'fr' then 'https://' || source || '.example.com/' || n_chars || '.png' else '' end as image_url from documents""")  # fmt: skip
def feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an entry that names its address in one of several places: English ones behind a wrapper with the original beside it, French ones within the summary, with an image, German ones behind a wrapper alone, Spanish ones plainly."""
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    own = F.concat(F.lit("https://"), "source", F.lit(".example.com/"), "n_chars")
    wrapped = F.concat(F.lit("<link>https://news.google.com/rss/"), "doc_id", F.lit("</link>"))
    lang = F.col("lang")
    extra = F.when(lang == "en", F.concat(F.lit("<origLink>"), own, F.lit("</origLink>"))).when(lang == "fr", F.concat(F.lit("<description>&lt;a href='"), own, F.lit("'&gt;told&lt;/a&gt;</description><enclosure type='image/png' url='"), own, F.lit(".png'/>"))).otherwise("")
    xml = F.concat(F.lit("<rss><channel><item><title>t</title>"), F.when(lang == "es", F.concat(F.lit("<link>"), own, F.lit("</link>"))).otherwise(wrapped), extra, F.lit("</item></channel></rss>"))
    raw = feeds.parse_feeds(docs.select(F.col("doc_id").cast("string").alias("path"), F.encode(xml, "UTF-8").alias("content")))
    return feeds.feed_articles(raw).select(F.col("path").cast("long").alias("doc_id"), "url", "resolution", "image_url")
