"""Queries of stores, searches, resolvers, replays and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import urls
from millrace.operators import assessment, ranking, replay, selection
from millrace.plans.catalog import query
from millrace.plans.pool_queries import _FINAL, CANDIDATES_SQL, TARGETS, candidates
from millrace.plans.scalar_queries import CANONICAL_SQL
from millrace.plans.lineage import shared_folder
from millrace.sources import documents, hops, keyed_store, resolver, search, state
from millrace.sources.tables import table


@query("predicate_scan", """
    select *, ((place - 1) // 25)::int as page from (select o_orderkey, (row_number() over (order by o_totalprice desc, o_orderkey))::int as place from orders where o_orderdate >= timestamp '1995-01-01' and (o_orderstatus = 'F' or (o_orderstatus = 'O' and contains(o_orderpriority, 'URGENT')))) where place <= 120""")  # fmt: skip
def predicate_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = {"and": [{"property": "o_orderdate", "on_or_after": "1995-01-01 00:00:00"}, {"or": [{"property": "o_orderstatus", "equals": "F"}, {"and": [{"property": "o_orderstatus", "is_in": ["O"]}, {"property": "o_orderpriority", "contains": "URGENT"}]}]}]}
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return documents.scan(rows, where, [F.desc("o_totalprice"), F.asc("o_orderkey")], 120, 25).select("o_orderkey", "place", "page")


@query("first_of_week", """
    select week, o_orderkey from (select date_trunc('week', o_orderdate)::date as week, o_orderkey, row_number() over (partition by date_trunc('week', o_orderdate) order by o_orderdate, o_orderkey) as n from orders where o_orderstatus = 'P') where n = 1""")  # fmt: skip
def first_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderstatus").withColumn("week", F.date_trunc("week", "o_orderdate").cast("date"))
    return documents.first_of(rows, ["week"], {"property": "o_orderstatus", "equals": "P"}, [F.asc("o_orderdate"), F.asc("o_orderkey")]).select("week", "o_orderkey")


@query("point_lookup", "select o_orderkey, o_custkey from orders where o_orderkey = (select max(o_orderkey) from orders)")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return documents.lookup(rows, "o_orderkey", rows.agg(F.max("o_orderkey")).first()[0])


@query("append_requests", """
    with l as (select doc_id, unnest(generate_series(1, len(x))) as place from (select doc_id, regexp_split_to_array(trim(text), '\\s+') as x from documents)) select doc_id, ((place - 1) // 100)::int as request, count(*) as blocks from l group by 1, 2""")  # fmt: skip
def append_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's words as blocks that are appended a hundred at a time."""
    blocks = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split(F.regexp_replace("text", r"^[\s]+|[\s]+$", ""), r"\s+")).alias("pos", "word"))
    return documents.append_requests(blocks, "doc_id", "pos")


@query("apply_changes", """
    with c as (select user_id as key, arg_max(event_type, (ts, event_id)) as kind, arg_max(value, (ts, event_id)) as value from events group by 1),
         r as (select c_custkey as key, c_acctbal as value from customer)
    select coalesce(r.key, c.key) as key, case when c.key is null then r.value else c.value end as value from r full join c on r.key = c.key where c.kind is null or c.kind <> 'error'""")  # fmt: skip
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stored rows, events as their changes: errors delete, all else inserts or updates."""
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").toDF("key", "value")
    op = F.when(F.col("event_type") == "error", "delete").otherwise("put")
    changes = table(spark, sf_dir, "events", "user_id", "event_type", "value", "ts", "event_id").select(F.col("user_id").alias("key"), op.alias("op"), "value", F.struct("ts", "event_id").alias("seq"))
    return documents.changed(rows, changes, "key", "seq")


@query("status_transitions", """
    select o_orderkey, case when moved then wanted else o_orderstatus end as status, moved from (
        select *, (o_orderstatus = 'O' and wanted in ('P', 'F')) or (o_orderstatus = 'P' and wanted = 'F') as moved from (select o_orderkey, o_orderstatus, case substr(o_orderpriority, 1, 1) when '1' then 'F' when '2' then 'P' else 'O' end as wanted from orders))""")  # fmt: skip
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.when(F.col("o_orderpriority").startswith("1"), "F").when(F.col("o_orderpriority").startswith("2"), "P").otherwise("O")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority").select("o_orderkey", F.col("o_orderstatus").alias("status"), wanted.alias("wanted"))
    return documents.transitioned(rows, "status", "wanted", {"O": ("P", "F"), "P": ("F",)}).select("o_orderkey", "status", "moved")


@query("search_requests", """
    with w as (select doc_id as id, lang, source || '.example.com' as domain, n_chars, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '')) as words from documents),
         q as (select item_id as request_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '')))[1:2] as query, (item_id * 7) % 70 as n, case when item_id % 3 = 0 then 'en' end as language from benchmark),
         h as (select request_id, id, n, row_number() over (partition by request_id order by n_chars desc, id) as position from q join w on list_has_all(w.words, q.query) and (q.language is null or q.language = w.lang))
    select request_id, id, position::int as position from h where position <= greatest(1, least(50, n))""")  # fmt: skip
def search_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two first words, by letters, of each benchmark item asked of all documents."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda x: x != ""))
    index = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars").select(F.col("doc_id").alias("id"), "lang", F.concat("source", F.lit(".example.com")).alias("domain"), F.col("n_chars").alias("published"), words("text").alias("words"))
    asked = table(spark, sf_dir, "benchmark", "item_id", "text").select(
        F.col("item_id").alias("request_id"), F.slice(F.array_sort(words("text")), 1, 2).alias("query"), (F.col("item_id") * 7 % 70).alias("count"), F.when(F.col("item_id") % 3 == 0, "en").alias("language"),
        F.lit(None).cast("array<string>").alias("domains"), F.lit(None).cast("long").alias("since"), F.lit(None).cast("long").alias("until"),
    )
    return search.search(asked, index)


@query("fetch_outcomes", """
    with a as (select user_id, [200, 304, 404, 503, 429, 408][1 + event_id % 6] as status, row_number() over (partition by user_id order by ts, event_id) as n from events),
         o as (select *, case when status = 304 then 'Unchanged' when status = 200 then 'Success' when status in (503, 429, 408) and n <= 2 then 'retry' else 'HTTP Error' end as outcome from a where n <= 3)
    select user_id, arg_min(outcome, n) as outcome, min(n)::int as attempts from o where outcome <> 'retry' group by 1""")  # fmt: skip
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts on their user's feed, with statuses that pass, fail for good and fail for now."""
    status = F.element_at(F.array(*map(F.lit, (200, 304, 404, 503, 429, 408))), (F.col("event_id") % 6).cast("int") + 1)
    rows = ranking.top_k(table(spark, sf_dir, "events", "user_id", "event_id", "ts").withColumn("status", status), ["user_id"], [F.asc("ts"), F.asc("event_id")], 3, "attempt")
    return search.fetched(rows, "user_id", "attempt", "status")


@query("provider_outcomes", "select status, n, case when status in (402, 403, 429) then 'provider limit' when status between 200 and 299 then 'ok' else 'provider error' end as outcome from (select (200 + event_id % 300)::int as status, count(*) as n from events group by 1)")
def provider_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events", "event_id").groupBy((200 + F.col("event_id") % 300).cast("int").alias("status")).agg(F.count("*").alias("n"))
    return counts.withColumn("outcome", search.provider_outcome(F.col("status")))


@query("discovery_scan", """
    with f as (select r_name as region, n_name as provider, o_custkey % 700 as url_hash, o_orderdate as published, list_position(['AFRICA', 'ASIA', 'EUROPE'], r_name) as rank, o_orderkey from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
         x as (select *, row_number() over (partition by url_hash order by rank, provider, published desc, url_hash) as n from f where region in ('AFRICA', 'ASIA', 'EUROPE') and url_hash not in (select s_suppkey from supplier where s_acctbal > 5000)),
         p as (select *, row_number() over (partition by region order by provider, published desc, url_hash) as position from x where n = 1)
    select region, provider, url_hash, position::int as position from p where position <= 20""")  # fmt: skip
def discovery_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as found articles of regions, three of which lack rows; an address belongs to the first that found it."""
    t = lambda name, *c: table(spark, sf_dir, name, *c)
    found = t("orders", "o_custkey", "o_orderdate").join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation", "n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = found.select(F.col("r_name").alias("region"), F.col("n_name").alias("provider"), (F.col("o_custkey") % 700).alias("url_hash"), F.col("o_orderdate").alias("published"))
    known = t("supplier", "s_suppkey", "s_acctbal").where("s_acctbal > 5000").select(F.col("s_suppkey").alias("url_hash"))
    return search.discovered(rows, {"AFRICA": 1, "AMERICA": 0, "ASIA": 2, "EUROPE": 3}, known, 20).select("region", "provider", "url_hash", "position")


@query("wrapper_resolution", """
    with r as (select event_id, user_id % 90 as url, ts, row_number() over (partition by user_id % 90 order by ts, event_id) as n, min((ts, event_id)) over (partition by user_id % 90) as first from events),
         a as (select *, row_number() over (order by first) as place from (select distinct url, first from r)), k as (select *, case when url % 17 = 5 and place > 20 then 'refused' when url % 5 = 0 then 'failed' else 'resolved' end as status from a where place <= 48),
         s as (select url, place, case when coalesce(sum((status = 'refused')::int) over (order by place rows between unbounded preceding and 1 preceding), 0) > 0 then 'skipped after refusal' else status end as status from k),
         j as (select r.*, s.status, s.place, case when r.url % 7 = 3 then 'http://127.0.0.1/x' else 'https://p' || r.url || '.example.com/a' end as target from r left join s using (url)),
         f as (select *, case when status is null then 'attempt budget exhausted' when status = 'resolved' and (url % 7 = 3 or event_id % 4 = 0) then 'unsafe target' else status end as told from j)
    select event_id, told as status, case when told = 'resolved' then target end as resolved, n > 1 as cached, case when n = 1 and status is not null and status <> 'skipped after refusal' then ((place - 1) * 2)::int end as sent_after from f""")  # fmt: skip
def wrapper_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as articles behind 90 wrapper addresses; some fail, some are refused late, some lead to where nobody should go."""
    rows = table(spark, sf_dir, "events", "event_id", "user_id", "ts").select("event_id", (F.col("user_id") % 90).alias("url"), "ts", F.when(F.col("event_id") % 4 == 0, "other.org").otherwise("example.com").alias("expected"))
    firsts = rows.groupBy("url").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    late = firsts.select("url", F.row_number().over(W.orderBy("f")).alias("place"))  # 90 addresses
    u = F.col("url")
    status = F.when((u % 17 == 5) & (F.col("place") > 20), "refused").when(u % 5 == 0, "failed").otherwise("resolved")
    answers = late.select("url", status.alias("status"), F.when(u % 7 == 3, "http://127.0.0.1/x").otherwise(F.concat(F.lit("https://p"), u, F.lit(".example.com/a"))).alias("target"))
    return resolver.resolution(rows, answers, "event_id", "url", [F.col("ts"), F.col("event_id")])


@query("framed_replies", """
    select event_id, case when event_type in ('click', 'view') then 'v' || user_id end as value from events""")  # fmt: skip
def framed_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of several JSON lines; those of clicks and views hold the asked one once, others twice or never."""
    line = F.concat(F.lit('["ask","v'), "user_id", F.lit('","x"]\n'))
    kind = F.col("event_type")
    body = F.concat(F.lit(")]}'\n12\n"), F.when(kind.isin("click", "view"), line).when(kind == "error", F.concat(line, line)).otherwise(""), F.lit('["other","w"]\n[broken\n7'))
    return table(spark, sf_dir, "events", "event_id", "event_type", "user_id").select("event_id", resolver.framed_value(body, "ask").alias("value"))


@query("identity_refresh", CANONICAL_SQL + """
    select page_id, canonical, case when page_id % 4 = 0 then 'key' || page_id when page_id % 4 = 1 then 'id' || page_id else regexp_replace(host, '^www\\.', '') end as publisher_key, sha256(canonical) as url_hash from c""")  # fmt: skip
def identity_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    rows = table(spark, sf_dir, "pages", "page_id", "url").withColumns({"publisher_key": F.when(k % 4 == 0, F.concat(F.lit("key"), k)).otherwise(""), "source_id": F.when(k % 4 <= 1, F.concat(F.lit("id"), k)), "title": F.lit("t"), "source": F.lit("s")})
    return urls.refreshed_identity(rows).select("page_id", "canonical", "publisher_key", "url_hash")


_REPLAY_SQL = f"""
    with recursive {CANDIDATES_SQL}, pool as (select key, region, publisher, score, significance, row_number() over (order by {_FINAL}) as rank from scored where tier = 'strict'),
    targets(region, target, place) as (values {", ".join(f"('{r}', {n}, {k})" for k, (r, n) in enumerate(TARGETS.items()))}), screens(screen, least) as (values ('all', 0), ('strong', 5)), picks as (
        select screen, least, 0 as pick, []::struct(key bigint, region varchar, publisher bigint)[] as won, null::bigint as key, null::varchar as region from screens
        union all
        select picks.screen, picks.least, picks.pick + 1, list_append(picks.won, {{'key': best.key, 'region': best.region, 'publisher': best.publisher}}), best.key, best.region
        from picks, lateral (
            select * from (
                select c.*, t.place, count(*) over (partition by c.region) as n, t.target - len(list_filter(picks.won, lambda w: w.region = c.region)) as missing
                from pool c join targets t on c.region = t.region
                where c.significance >= picks.least and len(list_filter(picks.won, lambda w: w.key = c.key)) = 0 and len(list_filter(picks.won, lambda w: w.publisher = c.publisher)) < 1
            ) where missing > 0 order by n::double / missing, place, rank limit 1
        ) best where picks.pick < 12
    )"""


@query("screen_replay", _REPLAY_SQL + """
    select screens.screen, t.region, target::bigint as target, count(p.key) as selected, greatest(0, target - count(p.key))::bigint as missing from screens cross join targets t left join (select * from picks where pick > 0) p on p.screen = screens.screen and p.region = t.region group by screens.screen, t.region, t.target""")  # fmt: skip
def screen_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly selection replayed on all strict candidates and on those of high significance: what each leaves missing."""
    pool = candidates(spark, sf_dir).where("tier = 'strict'")
    told = replay.replayed(pool, {"all": F.lit(True), "strong": F.col("significance") >= 5}, lambda rows: selection.select_week(rows, TARGETS, 12, 1, fallback=False))
    return replay.shortages(told, TARGETS)


@query("retained_union", """
    select key, list_sort(list(e)) as experiments from (select distinct o_custkey as key, 'orders' as e from orders where o_orderstatus = 'P' union all select c_custkey, 'rich' from customer where c_acctbal > 8000 union all select distinct user_id, 'errors' from events where event_type = 'error') group by 1""")  # fmt: skip
def retained_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name, *c: table(spark, sf_dir, name, *c)
    parts = {"orders": t("orders", "o_custkey", "o_orderstatus").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key")), "rich": t("customer", "c_custkey", "c_acctbal").where("c_acctbal > 8000").select(F.col("c_custkey").alias("key")), "errors": t("events", "user_id", "event_type").where("event_type = 'error'").select(F.col("user_id").alias("key"))}
    return replay.retained_union(parts, "key")


@query("budget_estimate", """
    with n as (select count(*) as n, sum(ceil(strlen(text) / 4))::bigint as input_tokens from documents), p(model, i, o) as (values ('large', 0.4, 1.6), ('small', 0.1, 0.5))
    select model, ceil(n / 100)::bigint as requests, input_tokens, (n * 40)::bigint as output_tokens, round((input_tokens * i::decimal(12,6) + n * 40 * o::decimal(12,6)) / 1000000, 4)::double as cost from n, p""")  # fmt: skip
def budget_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = spark.createDataFrame([("large", 0.4, 1.6), ("small", 0.1, 0.5)], "model string, input_price double, output_price double")
    return replay.budget_estimate(table(spark, sf_dir, "documents", "text"), F.octet_length("text"), 100, prices, 40)


@query("reserved_ledger", """
    with recursive e as (select user_id, event_id, value::decimal(18,2) as v, row_number() over (partition by user_id order by ts, event_id) as n from events), w as (
        select user_id, 0::bigint as n, null::bigint as event_id, 0::decimal(18,2) as before, 0::decimal(18,2) as spent, false as sent from (select distinct user_id from events)
        union all
        select w.user_id, e.n, e.event_id, w.spent, case when w.spent + 100 <= 300 then w.spent + e.v else w.spent end, w.spent + 100 <= 300 from w join e on e.user_id = w.user_id and e.n = w.n + 1
    )
    select user_id, event_id, before::double as spent, sent from w where n > 0""")  # fmt: skip
def reserved_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "user_id", "event_id", "ts", "value")
    return replay.reserved(rows, ["user_id"], ["ts", "event_id"], F.lit(100), F.col("value").cast("decimal(18,2)"), 300).select("user_id", "event_id", "spent", "sent")


@query("repeat_consistency", "with k as (select user_id, count(distinct event_type) as kinds from events group by 1) select count(*) as ids, count(*) filter (kinds = 1) as alike, round(count(*) filter (kinds = 1) / count(*)::double, 6) as share from k")
def repeat_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.consistency(table(spark, sf_dir, "events", "user_id", "event_type"), "user_id", "event_type")


@query("labelled_union", """
    with u as (select doc_id, quality as label, 'labels' as origin, 0 as k from labels where quality is not null union all select doc_id, (n_chars > 400)::int, 'length', 1 from documents union all select doc_id, (lang = 'en')::int, 'lang', 2 from documents)
    select doc_id, arg_min(label, (k, label))::int as label, arg_min(origin, (k, label)) as origin, count(distinct label) > 1 as conflict from u group by 1""")  # fmt: skip
def labelled_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "n_chars", "lang")
    parts = {"labels": table(spark, sf_dir, "labels", "doc_id", "quality").select("doc_id", F.col("quality").cast("int").alias("label")), "length": docs.select("doc_id", (F.col("n_chars") > 400).cast("int").alias("label")), "lang": docs.select("doc_id", (F.col("lang") == "en").cast("int").alias("label"))}
    return replay.labelled_union(parts, "doc_id", "label")


@query("reject_histogram", """
    with l as (select regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) as section, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages)
    select section, case when not starts_with(href, '/') then 'other address' when length(href) < 5 then 'too short' when regexp_matches(href, '[.,]$') then 'not a path' else 'accepted' end as reason, count(*) as n from l group by 1, 2""")  # fmt: skip
def reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages", "url", "html").select(F.regexp_extract("url", "://[^/?#]*/([^/?#]*)", 1).alias("section"), F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("href"))
    href = F.col("href")
    return replay.reject_histogram(links, ["section"], [(~href.startswith("/"), "other address"), (F.length(href) < 5, "too short"), (href.rlike(r"[.,]$"), "not a path")])


@query("markdown_index", """
    select '| ' || doc_id || ' | ' || replace(regexp_replace(text, '\\s+', ' ', 'g'), '|', '\\|') || ' | ' || source || ' |' as line from documents""")  # fmt: skip
def markdown_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.markdown_rows(table(spark, sf_dir, "documents", "doc_id", "text", "source"), ["doc_id", "text", "source"])


@query("written_drafts", "select conv_id, 'Draft: ' || length(string_agg(text, chr(10) || chr(10) order by turn)) as draft from conversations group by 1")
def written_drafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return replay.written(rows, ["conv_id"], ["turn"], "text", lambda told: f"Draft: {len(told)}")


_CHAINS_SQL = """
    chained as (
        select page_id, url, lead(url) over w as next, first_value(url) over w as first from (select page_id, url, regexp_extract(url, '://([^/?#]*)', 1) as host from pages) window w as (partition by host order by page_id)
    ), answers as (
        select url, case when next is null and not contains(url, '?') and not contains(url, '#') then case when ends_with(url, '/') then 404 else 200 end else 302 end as status,
               case when next is not null then next when contains(url, '?') then first when contains(url, '#') then 'http://192.168.0.7/' end as location
        from chained
    )"""


@query("redirect_hops", f"""
    with recursive {_CHAINS_SQL.strip()}, known as (select url, min(struct_pack(status := status, location := location)) as a from answers group by url
    ), walk as (
        select page_id, url as "at", 0 as hops, [url] as past, null::varchar as ended from pages
        union all
        select page_id, case when ended_now in ('way', 'loop', 'refused destination') then "to" else "at" end, case when ended_now in ('way', 'loop', 'refused destination') then hops + 1 else hops end, case when ended_now = 'way' then list_append(past, "to") else past end, case when ended_now <> 'way' then ended_now end
        from (select *, case when a is null then 'no answer' when a.status >= 400 then 'failed' when "to" is null then 'arrived' when hops = 12 then 'too many hops' when starts_with("to", 'http://192.168.') then 'refused destination' when list_contains(past, "to") then 'loop' else 'way' end as ended_now
              from (select w.*, k.a, regexp_replace(k.a.location, '#.*$', '') as "to" from walk w left join known k on w."at" = k.url where w.ended is null))
    )
    select page_id, "at" as final_url, hops::int as hops, ended as outcome from walk where ended is not null""")  # fmt: skip
def redirect_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page leads to the next of its host; the last one answers, is gone, leads back to the first or to a private address. Twelve hops are followed."""
    chained = hops.host_chains(table(spark, sf_dir, "pages", "page_id", "url"))
    u, last = F.col("url"), F.col("next").isNull()
    there = last & ~u.contains("?") & ~u.contains("#")
    status = F.when(there, F.when(u.endswith("/"), 404).otherwise(200)).otherwise(302)
    location = F.when(~last, F.col("next")).when(u.contains("?"), F.col("first")).when(u.contains("#"), "http://192.168.0.7/")
    answers = chained.select("url", status.alias("status"), location.alias("location"))
    return hops.followed(table(spark, sf_dir, "pages", "page_id", "url"), answers, most=12).select("page_id", "final_url", "hops", "outcome")


@query("keyed_store_upserts", "select o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey, max(o_orderdate) as at from orders group by o_custkey")
def keyed_store_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of each customer, out of a store of which two deliveries write the touched buckets: late orders first, then the earlier ones."""
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderdate").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("at"))
    store = keyed_store.KeyedStore(spark, f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}", "o_custkey long, o_orderkey long, at timestamp", "o_custkey", "at", 16)
    middle = rows.agg(F.expr("timestamp_seconds(avg(unix_seconds(at)))")).first()[0]
    best = lambda part: part.groupBy("o_custkey").agg(F.max(F.struct("at", "o_orderkey")).alias("m")).select("o_custkey", "m.o_orderkey", "m.at")
    for part in (F.col("at") > F.lit(middle), F.col("at") <= F.lit(middle)):
        store.upsert(best(rows.where(part)))
    return store.rows()


_NEEDS = {"AFRICA": 1, "AMERICA": 4, "ASIA": 9, "EUROPE": 0, "MIDDLE EAST": 40}


@query("adaptive_shortlists", f"""
    with recursive base as (
        select o_orderkey, r_name as region, o_totalprice, o_orderstatus = 'P' as found, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) > 1 as duplicate,
               case left(o_orderpriority, 1) when '1' then 5 when '2' then 4 when '3' then 3 when '5' then 2 end as verdict
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    ), e as (
        select *, row_number() over (partition by region order by stage, o_totalprice desc, o_orderkey) as n from (select *, 1 as stage from base union all select *, 0 from base where found)
    ), lim as (select region, case region {' '.join(f"when '{r}' then {n}" for r, n in _NEEDS.items())} else 0 end as missing, 24 as most from (select distinct region from base)
    ), w as (
        select region, 0::bigint as n, 0 as used, 0 as good, 0 as places, 0 as early, least(6, most) as room, missing <= 0 or most <= 0 as done, null::bigint as o_orderkey, null::varchar as outcome, null::int as attempt from lim
        union all
        select region, n, used, good, places, early, case when room = 0 then least(2, most - used) else room end, room = 0 and take and (good >= missing or used >= most), o_orderkey, case when not skip then case when duplicate then 'duplicate URL' when verdict is null then 'enrichment failed' when verdict >= 4 then 'qualified' else 'relevance too low' end end, case when take then used end
        from (select s.*, s.used_ + take::int as used, s.good_ + (take and coalesce(verdict, 0) >= 4)::int as good, s.places_ + (take and stage = 0)::int as places, case when again then early_ - 1 when not skip and stage = 0 then early_ + 1 else early_ end as early, s.room_ - take::int as room
              from (select q.*, again or (stage = 0 and places_ >= least(2, most)) as skip, not (again or (stage = 0 and places_ >= least(2, most))) and not duplicate as take
                    from (select e.*, w.used as used_, w.good as good_, w.places as places_, w.early as early_, w.room as room_, lim.missing, lim.most, e.stage = 1 and e.found and w.early > 0 as again
                          from w join e on e.region = w.region and e.n = w.n + 1 join lim on lim.region = w.region where not w.done) q) s)
    ), told as (select o_orderkey, outcome, attempt from w where outcome is not null)
    select b.o_orderkey, b.region, coalesce(t.outcome, case when u.used >= u.most then 'shortlist ceiling' else 'shortlist deferred' end) as outcome, t.attempt::bigint as attempt
    from base b left join told t using (o_orderkey) join (select region, max(used) as used, max(most) as most from w join lim using (region) group by region) u on u.region = b.region""")  # fmt: skip
def adaptive_shortlists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as articles of their customer's region, dearest first: who is assessed until the region's need or its 24 attempts are met. Partial orders are found ones, a customer's later ones duplicates, unspecified ones fail."""
    t = lambda name, *c: table(spark, sf_dir, name, *c)
    placed = t("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority").join(t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rows = placed.join(t("nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    best = placed.groupBy(F.col("o_custkey").alias("of")).agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("best"))
    known = rows.join(best, F.col("o_custkey") == F.col("of")).select("o_orderkey", F.col("r_name").alias("region"), "o_totalprice", "o_orderstatus", "o_orderpriority", "best")
    verdict = F.try_element_at(F.create_map(*(F.lit(x) for pair in {"1": 5, "2": 4, "3": 3, "5": 2}.items() for x in pair)), F.left("o_orderpriority", F.lit(1)))
    need = F.try_element_at(F.create_map(*(F.lit(x) for pair in _NEEDS.items() for x in pair)), F.col("region"))
    told = assessment.adaptive(known, "region", [-F.col("o_totalprice"), F.col("o_orderkey")], F.col("o_orderstatus") == "P", F.col("o_orderkey") != F.col("best"), verdict, F.lit(4), need, F.lit(24))
    return told.select("o_orderkey", "region", "outcome", "attempt")


@query("search_filtered", """
    with w as (select doc_id as id, lang, source || '.example.com' as domain, n_chars, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> '')) as words from documents),
         q as (select item_id as request_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: x <> ''))) as all_words, length(text) as size from benchmark),
         h as (select request_id, id, row_number() over (partition by request_id order by n_chars desc, id) as position from q join w on list_has_all(w.words, all_words[2:2 + size % 3]) and (size % 2 = 0 or w.lang = 'en')
               and (size % 4 = 0 or list_contains(list_transform(range(12), lambda k: 'src' || ((size + k) % 20) || '.example.com'), w.domain)) and (size % 3 = 0 or w.n_chars >= size) and (size % 5 = 0 or w.n_chars <= size * 20))
    select request_id, id, position::int as position from h where position <= 10""")  # fmt: skip
def search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three words of each benchmark item, asked in a language, of a dozen domains, since and until a length, each where the item's own length says so."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda x: x != ""))
    index = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars").select(F.col("doc_id").alias("id"), "lang", F.concat("source", F.lit(".example.com")).alias("domain"), F.col("n_chars").alias("published"), words("text").alias("words"))
    size = F.length("text").cast("long")
    domains = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.concat(F.lit("src"), (size + k) % 20, F.lit(".example.com")))
    asked = table(spark, sf_dir, "benchmark", "item_id", "text").select(
        F.col("item_id").alias("request_id"), F.slice(F.array_sort(words("text")), F.lit(2), (size % 3 + 1).cast("int")).alias("query"), F.lit(10).alias("count"), F.when(size % 2 != 0, "en").alias("language"),
        F.when(size % 4 != 0, domains).alias("domains"), F.when(size % 3 != 0, size).alias("since"), F.when(size % 5 != 0, size * 20).alias("until"),
    )
    return search.search(asked, index)


@query("image_cache", CANONICAL_SQL + """
    select a.page_id, coalesce(m.image, '') as image_url, coalesce(m.provider, '') as image_provider from c a left join (
        select canonical, 'https://img.example.org/' || max(page_id) || '.png' as image, case when max(page_id) % 2 = 0 then 'even' else 'odd' end as provider from c where contains(url, '?') or contains(url, '#') group by canonical
    ) m using (canonical)""")  # fmt: skip
def image_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the image last recorded for its address, out of a keyed store that pages with queries, and then those with fragments, put theirs in."""
    rows = table(spark, sf_dir, "pages", "page_id", "url").withColumn("canonical", urls.canonical_url(F.col("url")))
    store = keyed_store.image_store(spark, f"{shared_folder(spark)}/images-{uuid.uuid4().hex}")
    found = rows.select("url", urls.url_hash(F.col("canonical")).alias("url_hash"), F.concat(F.lit("https://img.example.org/"), "page_id", F.lit(".png")).alias("image_url"), F.when(F.col("page_id") % 2 == 0, "even").otherwise("odd").alias("provider"), F.timestamp_seconds("page_id").alias("recorded_at"))
    for mark in ("?", "#"):
        store.upsert(found.where(F.contains("url", F.lit(mark))))
    return state.with_images(rows, store.rows()).select("page_id", "image_url", "image_provider")
