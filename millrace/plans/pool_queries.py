"""Queries of joins, ranks, events and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions import dates, scores, text, urls
from millrace.operators import events, gates, identity, ranking, selection
from millrace.plans.catalog import query
from millrace.plans.lineage import cut
from millrace.plans.scalar_queries import ARTICLES_SQL, articles
from millrace.plans.values import EVENT_STOP_WORDS, EVENT_WORD_FORMS
from millrace.sources import search
from millrace.sources.tables import table

TARGETS = {"AFRICA": 3, "AMERICA": 4, "ASIA": 3, "EUROPE": 2}
CANDIDATES_SQL = """
    candidates as (
        select o_orderkey as key, r_name as region, c_custkey as publisher, o_orderdate as published, 6 - substr(o_orderpriority, 1, 1)::int as relevance,
               least(5, 1 + floor(o_totalprice / 100000))::int as significance, c_acctbal / 1000 as quality, 'https://p' || c_custkey || '.example.com/' || lpad(o_orderkey::varchar, 9, '0') as url,
               case when 6 - substr(o_orderpriority, 1, 1)::int >= 4 then 'strict' else 'fallback' end as tier
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        where 6 - substr(o_orderpriority, 1, 1)::int >= 3
    ), scored as (
        select *, round(14.00 * relevance::decimal(12,4) + 4.00 * significance::decimal(12,4) + 1.00 * least(10, greatest(0, quality))::decimal(12,4), 2)::double as score from candidates
    )"""
_FINAL = "score desc, relevance desc, significance desc, coalesce(quality, 0) desc, published desc nulls last, url"


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as candidates: regions by customer, publishers are customers."""
    t = lambda name, *c: table(spark, sf_dir, name, *c)
    joined = (
        t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice").join(t("customer", "c_custkey", "c_nationkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation", "n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    relevance = 6 - F.substring("o_orderpriority", 1, 1).cast("int")
    read = joined.where(relevance >= 3).select(
        F.col("o_orderkey").alias("key"), F.col("r_name").alias("region"), F.col("c_custkey").alias("publisher"), F.col("o_orderdate").alias("published"), relevance.alias("relevance"),
        F.least(F.lit(5), 1 + F.floor(F.col("o_totalprice") / 100000)).cast("int").alias("significance"), (F.col("c_acctbal") / 1000).alias("quality"),
        F.concat(F.lit("https://p"), F.col("c_custkey"), F.lit(".example.com/"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("url"),
    )
    return read.withColumns({"tier": F.when(F.col("relevance") >= 4, "strict").otherwise("fallback"), "score": scores.queue_score(F.col("relevance"), F.col("significance"), F.col("quality"))})


#: Coverage alone: on the supplied tables the strict pool fills every region's target.
FLAGSHIP_SQL = f"""
    with recursive {CANDIDATES_SQL}, pool as (
        select key, region, publisher, score, row_number() over (order by {_FINAL}) as rank from scored where tier = 'strict'
    ), targets(region, target, place) as (values {", ".join(f"('{r}', {n}, {k})" for k, (r, n) in enumerate(TARGETS.items()))}), picks as (
        select 0 as pick, []::struct(key bigint, region varchar, publisher bigint)[] as won, null::bigint as key, null::varchar as region, null::bigint as publisher, null::double as score
        union all
        select picks.pick + 1, list_append(picks.won, {{'key': best.key, 'region': best.region, 'publisher': best.publisher}}), best.key, best.region, best.publisher, best.score
        from picks, lateral (
            select * from (
                select c.*, t.place, count(*) over (partition by c.region) as n, t.target - len(list_filter(picks.won, lambda w: w.region = c.region)) as missing
                from pool c join targets t on c.region = t.region
                where len(list_filter(picks.won, lambda w: w.key = c.key)) = 0 and len(list_filter(picks.won, lambda w: w.publisher = c.publisher)) < 2
            ) where missing > 0 order by n::double / missing, place, rank limit 1
        ) best where picks.pick < 12
    )
    select pick::int as pick, key, 'strict' as tier, region, publisher, score, 'coverage' as phase from picks where pick > 0"""


@query("flagship_weekly_selection", FLAGSHIP_SQL)
def flagship_weekly_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.select_final(candidates(spark, sf_dir), TARGETS, 12, 2)


#: A later run of a week: one row of three regions is there, a target region has no rows, strict rows are few, one row of a publisher wins.
LATER_TARGETS = TARGETS | {"ARCTIC": 2}
LATER_SQL = f"""
    with recursive {CANDIDATES_SQL}, pool as (
        select *, row_number() over (order by {_FINAL}) as rank, case when relevance >= 4 and significance >= 4 and quality >= 9 then 'strict' when relevance = 3 and significance >= 3 then 'fallback' end as place_
        from scored
    ), tiered as (select * exclude (tier, place_), place_ as tier from pool where place_ is not null), week as (
        select * from (select *, row_number() over (partition by region order by rank) as n from tiered where region in ('AFRICA', 'ASIA', 'EUROPE')) where n = 1
    ), open as (
        select * from tiered where url not in (select url from week) and publisher not in (select publisher from week)
    ), targets(region, target, place) as (values {", ".join(f"('{r}', {n}, {k})" for k, (r, n) in enumerate(LATER_TARGETS.items()))}), picks as (
        select 0 as pick, []::struct(key bigint, region varchar, publisher bigint)[] as won, null::bigint as key, null::varchar as tier, null::varchar as region, null::bigint as publisher, null::double as score, null::varchar as phase
        union all
        select picks.pick + 1, list_append(picks.won, {{'key': best.key, 'region': best.region, 'publisher': best.publisher}}), best.key, best.tier, best.region, best.publisher, best.score, case when best.missing > 0 then 'coverage' else 'overflow' end
        from picks, lateral (
            select * from (
                select c.*, t.place, count(*) over (partition by c.tier, c.region) as n,
                       coalesce(t.target, 0) - (select count(*) from week w where w.region = c.region) - len(list_filter(picks.won, lambda w: w.region = c.region)) as missing
                from open c left join targets t on c.region = t.region
                where len(list_filter(picks.won, lambda w: w.publisher = c.publisher)) < 1
            ) order by tier = 'fallback', missing <= 0, case when missing > 0 then n::double / missing end, case when missing > 0 then place end, rank limit 1
        ) best where picks.pick < 11
    ), done as (select * from picks where pick > 0), strict_won as (select publisher from done where tier = 'strict'), told as (
        select d.pick::int as pick, t.key, t.tier, t.region, t.publisher, t.score, d.phase, case
            when d.pick is not null or (t.tier = 'fallback' and (select count(*) from done where tier = 'strict') >= 11) then null when t.url in (select url from week) then 'existing URL' when t.publisher in (select publisher from week) then 'publisher weekly cap'
            when t.publisher in (select publisher from strict_won) or (t.tier = 'fallback' and t.publisher in (select publisher from done)) then 'publisher weekly cap'
            when (select count(*) from done where tier = 'strict' or t.tier = 'fallback') >= 11 then 'run capacity' else 'regional coverage complete' end as reason
        from tiered t left join done d on t.key = d.key
    )"""


def later_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict, fallback = (F.col("relevance") >= 4) & (F.col("significance") >= 4) & (F.col("quality") >= 9), (F.col("relevance") == 3) & (F.col("significance") >= 3)
    pool = candidates(spark, sf_dir).withColumn("tier", F.when(strict, "strict").when(fallback, "fallback")).where("tier is not null")
    rows = ranking.top_k(pool.where(F.col("region").isin("AFRICA", "ASIA", "EUROPE")), ["region"], ranking.final_order(), 1).withColumn("title", F.lit(""))
    return selection.select_week(pool, LATER_TARGETS, 14, 1, selection.week_state(rows))


@query("later_weekly_selection", LATER_SQL + " select pick, key, tier, region, publisher, score, phase from told where pick is not null")
def later_weekly_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winners of a later run: under what the week has, by coverage and overflow, of strict rows and then of fallback ones."""
    return later_run(spark, sf_dir).where("pick is not null").drop("reason")


@query("selection_reasons", LATER_SQL + " select tier, region, case when pick is not null then 'selected' else coalesce(reason, 'not considered') end as reason, count(*) as n from told group by 1, 2, 3")
def selection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each reason keeps out; fallback rows aren't considered where strict ones fill the run."""
    reason = F.when(F.col("pick").isNotNull(), "selected").otherwise(F.coalesce("reason", F.lit("not considered")))
    return later_run(spark, sf_dir).groupBy("tier", "region", reason.alias("reason")).agg(F.count("*").alias("n"))


@query("seen_antijoin", "select e.event_id from events e where e.user_id not in (select user_id from events where event_type = 'error' and ts < timestamp '2024-01-02')")
def seen_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    return identity.exclude_seen(rows, "user_id", rows.where("event_type = 'error' and ts < timestamp '2024-01-02 00:00:00+00:00'"), "user_id").select("event_id")


@query("representative", f"""with {ARTICLES_SQL} select url, doc_id from (select *, row_number() over (partition by url order by published desc nulls last, doc_id) as n from articles) where n = 1""")
def representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.representative(articles(spark, sf_dir), ["url"], [F.desc_nulls_last("published"), F.asc("doc_id")]).select("url", "doc_id")


@query("publisher_suffix_match", """
    with h as (select page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '^www\\.', '') as host from pages),
         s as (select distinct regexp_replace(host, '^(m|blog)\\.', '') as source, length(regexp_replace(host, '^(m|blog)\\.', '')) % 10 as quality from h),
         m as (select page_id, source, quality, row_number() over (partition by page_id order by quality desc, source) as n from h join s on host = source or ends_with(host, '.' || source) or ends_with(source, '.' || host))
    select h.page_id, coalesce(m.source, host) as publisher_key, m.quality::int as quality from h left join m on h.page_id = m.page_id and n = 1""")  # fmt: skip
def publisher_suffix_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages", "page_id", "url").select(F.col("page_id").alias("row_id"), urls.hostname(F.col("url")).alias("host"))
    source = F.regexp_replace("host", r"^(m|blog)\.", "")
    sources = rows.select(source.alias("source"), (F.length(source) % 10).alias("quality")).distinct()
    return identity.match_publishers(rows, "host", sources, "source", [F.desc("quality"), F.asc("matched_host")]).select(F.col("row_id").alias("page_id"), "publisher_key", "quality")


@query("prune_semi", "select c_custkey from customer where c_mktsegment = 'BUILDING' and c_custkey in (select o_custkey from orders) or c_custkey is null")
def prune_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = identity.keep_existing(table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").where("c_mktsegment = 'BUILDING'"), "c_custkey", table(spark, sf_dir, "orders", "o_custkey"))
    return kept.select("c_custkey")


@query("one_to_one_match", """
    with t as (select doc_id, source, trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{N}]+', ' ', 'g')) as k, lang, n_chars from documents),
         f as (select * from t where lang = 'en'), d as (select * from t where lang <> 'en'), p as (select f.doc_id as l, d.doc_id as r from f join d on f.source = d.source and (f.k = d.k or f.n_chars = d.n_chars))
    select l as left_id, r as right_id from p where l in (select l from p group by 1 having count(*) = 1) and r in (select r from p group by 1 having count(*) = 1)""")  # fmt: skip
def one_to_one_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents and others of one source that have a headline or a length in common with each other alone."""
    rows = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars").select("doc_id", "source", "lang", "n_chars", text.headline_key(F.substring_index("text", "\n", 1)).alias("k"))
    return identity.one_to_one(rows.where("lang = 'en'"), rows.where("lang <> 'en'"), [["source", "k"], ["source", "n_chars"]], "doc_id", "doc_id")


@query("supplement_matches", """
    with t as (select doc_id, source, lang, trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{N}]+', ' ', 'g')) as k, n_chars // 40 as page, n_chars * 900 as at from documents),
         f as (select * from t where lang = 'en'), d as (select * from t where lang <> 'en'),
         p as (select f.doc_id as l, d.doc_id as r from f join d on f.source = d.source and (f.page = d.page or (f.k = d.k and len(string_split(f.k, ' ')) >= 4 and abs(f.at - d.at) <= 86400)))
    select l as feed_id, r as direct_id from p where l in (select l from p group by 1 having count(*) = 1) and r in (select r from p group by 1 having count(*) = 1)""")  # fmt: skip
def supplement_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents as a feed, all others as pages of the same publishers: those that have an address, or a headline within a day, in common with each other alone."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang", "n_chars")
    rows = docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("publisher"), F.lit("").alias("source"), F.substring_index("text", "\n", 1).alias("title"), "lang",
        F.concat_ws("/", F.lit("https:/"), "source", F.floor(F.col("n_chars") / 40)).alias("canonical"), F.timestamp_seconds(F.col("n_chars") * 900).alias("published"),
    )
    return identity.only_matches(rows.where("lang = 'en'"), rows.where("lang <> 'en'"))


@query("source_lookup", "select l_orderkey, l_linenumber, coalesce(s_name, 'Unknown source') as source from lineitem left join supplier on l_suppkey + l_linenumber = s_suppkey")
def source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").withColumn("source_id", F.col("l_suppkey") + F.col("l_linenumber"))
    return identity.named(rows, "source_id", table(spark, sf_dir, "supplier", "s_suppkey", "s_name"), "s_suppkey", "s_name", "source").select("l_orderkey", "l_linenumber", "source")


@query("longest_override", """
    with o(phrase, value) as (values ('small ring', 'a'), ('small', 'b'), ('blue bolt', 'c'), ('red', 'd')),
         h as (select p_partkey, value, row_number() over (partition by p_partkey order by length(phrase) desc, phrase) as n from part join o on contains(lower(p_name), phrase))
    select p_partkey, value from h where n = 1""")  # fmt: skip
def longest_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    overrides = spark.createDataFrame([("small ring", "a"), ("small", "b"), ("blue bolt", "c"), ("red", "d")], "phrase string, value string")
    rows = table(spark, sf_dir, "part", "p_partkey", "p_name").withColumnRenamed("p_partkey", "row_id")
    return identity.longest_override(rows, "p_name", overrides, "phrase", "value").withColumnRenamed("row_id", "p_partkey")


@query("process_once", "select event_id, n from events e join (select event_type, count(*) as n from (select distinct event_type, user_id from events) group by 1) using (event_type)")
def process_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_id", "event_type", "user_id")
    counted = rows.select("event_type", "user_id").distinct().groupBy("event_type").agg(F.count("*").alias("n"))
    return identity.once_each(rows, ["event_type"], lambda keys: keys.join(counted, "event_type")).select("event_id", "n")


_STOP = ", ".join(f"'{w}'" for w in EVENT_STOP_WORDS)
EVENT_TOKENS_SQL = f"""
    {ARTICLES_SQL}, tokens as (
        select doc_id as key, list_sort(list_filter(list_distinct(regexp_extract_all(lower(regexp_replace(title, '\\s+[-|:]\\s+[^-|:]{{2,50}}$', '')), '[a-z0-9]+')), lambda x: length(x) > 1 and x not in ({_STOP}))) as t from articles
    )"""


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select(F.col("doc_id").alias("key"), text.title_tokens(F.col("title")).alias("tokens"))


@query("event_pairs_jaccard", f"""with {EVENT_TOKENS_SQL}, reps as (select t, min(key) as key from tokens where len(t) > 0 group by t) select a.key as a, b.key as b from reps a join reps b on a.key < b.key
    where len(list_intersect(a.t, b.t)) > 0 and len(list_intersect(a.t, b.t)) >= 0.72 * (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) - 1e-9""")  # fmt: skip
def event_pairs_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of titles that nearly agree, between the first documents of equal ones; ``event_classes`` tells whose they are."""
    return events.class_pairs(cut(events.event_classes(event_rows(spark, sf_dir), "key", "tokens"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


@query("event_classes", f"with {EVENT_TOKENS_SQL} select key, min(key) over (partition by t) as rep from tokens where len(t) > 0")
def event_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_rows(spark, sf_dir)
    return rows.withColumn("tokens", F.array_sort("tokens")).join(events.event_classes(rows, "key", "tokens"), "tokens").select("key", "rep")


@query("leader_dedupe", f"""
    with recursive {EVENT_TOKENS_SQL}, numbered as (select key, t, row_number() over (order by key) as i from tokens), walk as (
        select 0::bigint as i, null::bigint as key, null::bigint as leader, []::struct(k bigint, t varchar[])[] as held
        union all
        select n.i, n.key, l.leader, case when l.leader is null then list_append(w.held, {{'k': n.key, 't': n.t}}) else w.held end
        from walk w join numbered n on n.i = w.i + 1, lateral (
            select list_filter(w.held, lambda x: len(list_intersect(x.t, n.t)) > 0 and len(list_intersect(x.t, n.t)) >= 0.72 * (len(x.t) + len(n.t) - len(list_intersect(x.t, n.t))) - 1e-9)[1].k as leader
        ) l
    )
    select key, leader is null as kept, leader from walk where i > 0""")  # fmt: skip
def leader_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_rows(spark, sf_dir).withColumn("rank", F.col("key"))
    return events.dedupe_events(rows, "key", "tokens", "rank").select("key", "kept", "leader")


@query("image_assignment", """
    with recursive w as (
        select conv_id, list_filter(flatten(list(regexp_split_to_array(lower(text), '[^\\p{L}]+') order by turn)), lambda x: x <> '') as words, row_number() over (order by conv_id) as i from conversations where text is not null group by conv_id
    ), walk as (
        select 0::bigint as i, null::bigint as conv_id, null::varchar as word, []::varchar[] as used
        union all
        select w.i, w.conv_id, l.word, case when l.word is null then walk.used else list_append(walk.used, l.word) end
        from walk join w on w.i = walk.i + 1, lateral (select list_filter(w.words, lambda x: not list_contains(walk.used, x))[1] as word) l
    )
    select conv_id, word from walk where i > 0 and word is not null""")  # fmt: skip
def image_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation gets the first of its words that no earlier conversation got."""
    words = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.posexplode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("at", "word")).where("word <> ''")
    offers = words.select("conv_id", F.struct("turn", "at").alias("pos"), "word")
    return identity.assign_distinct(offers, "conv_id", "pos", "word").select("conv_id", "word")


_FORMS = ", ".join(f"('{k}', '{v}')" for k, v in EVENT_WORD_FORMS.items())
#: Orders of one customer as pairs of announcements, told in words of the orders' own.
PAIRS_SQL = f"""
    forms(w, form) as (values {_FORMS}), o as (
        select o_orderkey as id, o_custkey, o_orderdate as published, 'site' || o_orderkey % 7 as site, ['approves', 'approved', 'mulls', 'announces', 'launched'][1 + o_orderkey % 5] as verb, ['plan', 'strategies', 'law', 'scheme'][1 + (o_orderkey // 5) % 4] as matter,
               [null, 'Egypt', 'Iraq'][1 + (o_orderkey // 20) % 3] as place, o_comment_words as told, 1 + o_orderkey % 3 as gw, 'https://x.org/' || o_orderkey % 11 as url
        from (select *, (o_totalprice::bigint % 4) as o_comment_words from orders)
    ), titled as (
        select *, 'Ministry ' || verb || ' water ' || matter || ' for coastal towns of ' || site as title, 'one two three four five six seven eight nine ten eleven twelve' || case when told = 0 then ' other words than those' else '' end as snippet from o
    ), words as (
        select id, 'said' as kind, coalesce(form, w) as w from (select id, unnest(list_distinct(regexp_extract_all(lower(title), '[a-z0-9]+'))) as w from titled) left join forms using (w) where length(w) > 1 and w not in ({_STOP}, 'more', 'under')
        union select id, 'told', coalesce(form, w) from (select id, unnest(list_distinct(regexp_extract_all(lower(snippet), '[a-z0-9]+'))) as w from titled) left join forms using (w) where length(w) > 1 and w not in ({_STOP}, 'more', 'under')
    ), bags as (select id, list(w) filter (kind = 'said') as said, list(w) filter (kind = 'told') as told_words from words group by id), full_ as (
        select t.*, b.said, b.told_words from titled t join bags b using (id)
    ), pairs as (
        select a.id as a, b.id as b, a.place as pa, b.place as pb, a.url as ua, b.url as ub, a.gw as ga, b.gw as gb, a.site as ca, b.site as cb, abs(epoch(a.published) - epoch(b.published)) <= 3 * 86400 as near, a.said as sa, b.said as sb, a.told_words as ta, b.told_words as tb,
               list_intersect(a.said, b.said) as shared, list_intersect(a.told_words, b.told_words) as shared_told, ['policy', 'strategy', 'regulation', 'law', 'plan'] as policy, ['update', 'approve', 'adopt', 'announce', 'launch'] as act
        from full_ a join full_ b on a.o_custkey = b.o_custkey and a.id < b.id
    )"""


def _announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b, l, r): all pairs of one customer's orders, each told as an announcement."""
    k = F.col("o_orderkey")
    site = F.concat(F.lit("site"), k % 7)
    pick = lambda texts, n: F.element_at(F.array(*(F.lit(t).cast("string") for t in texts)), (n % len(texts)).cast("int") + 1)
    title = F.concat(F.lit("Ministry "), pick(["approves", "approved", "mulls", "announces", "launched"], k), F.lit(" water "), pick(["plan", "strategies", "law", "scheme"], F.floor(k / 5)), F.lit(" for coastal towns of "), site)
    told = F.concat(F.lit("one two three four five six seven eight nine ten eleven twelve"), F.when(F.round("o_totalprice").cast("long") % 4 == 0, " other words than those").otherwise(""))
    capacity = F.concat(F.when(k % 2 == 0, F.concat((1 + k % 3) * 1000, F.lit(" MW"))).otherwise(F.concat(1 + k % 3, F.lit(" GW"))), F.lit(" park near "), site)
    # few large row groups would leave most cores without texts to read, so the bare rows are dealt out first
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").repartition("o_orderkey")
    rows = orders.select("o_orderkey", "o_custkey", F.struct(
        F.concat(F.lit("https://x.org/"), k % 11).alias("canonical"), pick([None, "Egypt", "Iraq"], F.floor(k / 20)).alias("place"), events.measures(capacity).alias("measures"),
        text.title_tokens(F.concat(F.lit("solar park opens near "), site)).alias("tokens"), F.col("o_orderdate").alias("published"), events.announcement_tokens(title).alias("said"), events.announcement_tokens(told).alias("told"),
    ).alias("f"))
    side = lambda key, name: rows.select(F.col("o_orderkey").alias(key), "o_custkey", F.col("f").alias(name))
    return side("a", "l").join(side("b", "r"), "o_custkey").where("a < b")


_POLICY_SQL = """coalesce(pa = pb, false) and near and len(list_intersect(sa, policy)) > 0 and len(list_intersect(sb, policy)) > 0 and len(list_intersect(shared, act)) > 0 and (
        (len(list_intersect(shared, policy)) > 0 and least(len(sa), len(sb)) >= 6 and len(shared) >= 0.85 * least(len(sa), len(sb))) or (len(shared) >= 3 and len(shared_told) >= 12 and len(shared_told) >= 0.9 * least(len(ta), len(tb))))"""


@query("policy_match", f"with {PAIRS_SQL} select a, b from pairs where {_POLICY_SQL}")
def policy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _announcements(spark, sf_dir).where(events.same_policy("l", "r")).select("a", "b")


@query("event_vetoes", f"with {PAIRS_SQL} select a, b, case when ua = ub then true when pa <> pb then false when ga <> gb then false else ca = cb or ({_POLICY_SQL}) end as same from pairs")
def event_vetoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal addresses, other places, other capacities, titles, policies: all that decides whether two announcements are one event."""
    return _announcements(spark, sf_dir).select("a", "b", events.same_event("l", "r", policy=True).alias("same"))


@query("tiered_round_robin", f"""
    with {CANDIDATES_SQL}, turns as (select *, row_number() over (partition by region, tier, publisher order by {_FINAL}) as turn from scored),
         leads as (select region, tier, publisher, row_number() over (partition by region, tier order by {_FINAL}) as lead from turns where turn = 1)
    select region, tier, key, turn::int as turn, position::int as position from (select t.region, t.tier, t.key, turn, row_number() over (partition by t.region, t.tier order by turn, lead) as position from turns t join leads l on t.region = l.region and t.tier = l.tier and t.publisher = l.publisher) where position <= 48""")  # fmt: skip
def tiered_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.round_robin(candidates(spark, sf_dir), ["region", "tier"], "publisher", ranking.final_order(), 48).select("region", "tier", "key", "turn", "position")


@query("region_topk", f"with {CANDIDATES_SQL} select region, key, position::int as position from (select region, key, row_number() over (partition by region order by {_FINAL}) as position from scored) where position <= 8")
def region_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_k(candidates(spark, sf_dir), ["region"], ranking.final_order(), 8).select("region", "key", "position")


@query("region_budget", f"""
    with {CANDIDATES_SQL}, p as (select region, key, publisher, row_number() over (partition by region order by {_FINAL}) as position from scored),
         u as (select *, coalesce(sum(case when publisher % 3 <> 0 then 1 else 0 end) over (partition by region order by position rows between unbounded preceding and 1 preceding), 0) as used from p where position <= 40)
    select region, key, used::bigint as used, used < 8 as within from u""")  # fmt: skip
def region_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = ranking.top_k(candidates(spark, sf_dir), ["region"], ranking.final_order(), 40)
    return ranking.budgeted(short, ["region"], "position", F.col("publisher") % 3 != 0, F.lit(8)).select("region", "key", "used", "within")


@query("decision_rank", f"""
    with {CANDIDATES_SQL} select region, key, position::int as position from (select region, key, row_number() over (partition by region order by case when decision = 'Relevant' then 0 when decision = 'Borderline' then 1 else 2 end, relevance desc, coalesce(quality, 0) desc, published desc nulls last, url) as position
    from (select *, case relevance when 5 then 'Relevant' when 4 then 'Borderline' end as decision from scored)) where position <= 20""")  # fmt: skip
def decision_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = candidates(spark, sf_dir).withColumn("decision", F.when(F.col("relevance") == 5, "Relevant").when(F.col("relevance") == 4, "Borderline"))
    return ranking.top_k(judged, ["region"], ranking.decision_order(), 20).select("region", "key", "position")


@query("provider_order", """
    select n_name, s_suppkey, rank::int as rank from (select *, row_number() over (order by s_acctbal desc, n_name) as rank from (
        select n_name, s_suppkey, s_acctbal, row_number() over (partition by n_name order by s_acctbal desc, s_suppkey) as n from supplier join nation on s_nationkey = n_nationkey) where n = 1)""")  # fmt: skip
def provider_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal", "s_nationkey").join(table(spark, sf_dir, "nation", "n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    return search.provider_order(joined, "n_name", "s_acctbal", [F.asc("s_suppkey")]).select("n_name", "s_suppkey", "rank")


@query("preferred_domains", """
    select r_name, list(host order by q desc, host) as hosts from (select r_name, 's' || (s_suppkey % 40) || '.example.com' as host, max(s_acctbal) as q from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE') group by 1, 2) group by 1""")  # fmt: skip
def preferred_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal", "s_nationkey").join(table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    host = F.concat(F.lit("s"), F.col("s_suppkey") % 40, F.lit(".example.com"))
    return search.preferred_domains(joined.withColumn("regions", F.array("r_name")), "regions", ("ASIA", "EUROPE"), "r_name", host, "s_acctbal")


@query("featured_top3", f"with {CANDIDATES_SQL} select key, relevance from scored order by relevance desc, lower(url) limit 3")
def featured_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.featured(candidates(spark, sf_dir), [F.desc("relevance"), F.lower("url")], 3).select("key", "relevance")


@query("discovery_fill", """
    with r as (select user_id, event_type, event_id, ts, props, list_position(['purchase', 'signup', 'click'], event_type) as provider from events where event_type in ('purchase', 'signup', 'click')),
         d as (select *, row_number() over (partition by user_id, props order by provider, ts, event_id) as n from r)
    select user_id, event_id, position::int as position from (select user_id, event_id, row_number() over (partition by user_id order by provider, ts, event_id) as position from d where n = 1) where position <= 5""")  # fmt: skip
def discovery_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "user_id", "event_type", "event_id", "ts", "props").where(F.col("event_type").isin("purchase", "signup", "click"))
    ranked = rows.withColumn("provider", F.array_position(F.array(F.lit("purchase"), F.lit("signup"), F.lit("click")), F.col("event_type")))
    return ranking.first_distinct(ranked, ["user_id"], "props", [F.asc("provider"), F.asc("ts"), F.asc("event_id")]).where("position <= 5").select("user_id", "event_id", "position")


@query("image_first_seen", """
    with l as (select page_id, pos, href, min(page_id * 1000000 + pos) over (partition by href) as first from (select page_id, generate_subscripts(h, 1) - 1 as pos, unnest(h) as href from (select page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) as h from pages)))
    select page_id, count(*) as links, count(*) filter (where page_id * 1000000 + pos > first) as repeated from l group by page_id""")  # fmt: skip
def image_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages", "page_id", "html").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("pos", "href"))
    place = F.col("page_id") * 1000000 + F.col("pos")
    return identity.first_seen(links.withColumn("place", place), "href", "place").groupBy("page_id").agg(F.count("*").alias("links"), F.count_if("repeated").alias("repeated"))


_T = ", ".join(f"('{r}', {n})" for r, n in TARGETS.items())


def _week(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All candidates by week, and what each week aims at."""
    rows = candidates(spark, sf_dir).withColumn("week", dates.week_start(F.col("published")))
    return rows, spark.createDataFrame(list(TARGETS.items()), "region string, target int")


_WEEK_SQL = f"{CANDIDATES_SQL}, week as (select *, date_trunc('week', published)::date as week from scored), targets(region, target) as (values {_T})"


@query("capacity", f"with {_WEEK_SQL}, n as (select week, count(*) filter (region in (select region from targets)) as existing from week group by 1), t as (select sum(target)::bigint as target from targets) select week, target, existing, greatest(0, target - existing)::bigint as remaining, least(12, greatest(0, target - existing))::bigint as effective from n, t")
def capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, targets = _week(spark, sf_dir)
    return selection.capacity(rows, "region", targets, 12, ["week"])


@query("deficits", f"with {_WEEK_SQL}, weeks as (select distinct week from week) select weeks.week, t.region, target, count(key) as current, greatest(0, target - count(key))::bigint as deficit from weeks cross join targets t left join week w on w.week = weeks.week and w.region = t.region group by 1, 2, 3")
def deficits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, targets = _week(spark, sf_dir)
    return selection.deficits(rows, "region", targets, ["week"])


@query("metadata_top3", """
    select o_custkey, o_orderkey, place::int as place from (
        select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by length(o_orderpriority) desc, coalesce(case when o_orderstatus <> 'F' then o_totalprice end, 0) desc, (o_totalprice > 150000) desc, o_orderdate desc nulls last, least(length(o_orderstatus || o_orderpriority), 500) desc, o_orderkey) as place from orders
    ) where place <= 3""")  # fmt: skip
def metadata_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's three first orders in the order of unread articles: more specific, better rated, concrete, newer, longer, then by address."""
    c = F.col
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate").select(
        "o_custkey", "o_orderkey", F.length("o_orderpriority").alias("specificity"), F.when(c("o_orderstatus") != "F", c("o_totalprice")).alias("quality"), (c("o_totalprice") > 150000).alias("concrete"), c("o_orderdate").alias("published"),
        F.concat("o_orderstatus", "o_orderpriority").alias("snippet"), c("o_orderkey").alias("url"),
    )
    return ranking.top_k(rows, ["o_custkey"], ranking.metadata_order(), 3, "place").select("o_custkey", "o_orderkey", "place")


@query("eligible_lines", """
    select l_orderkey, l_linenumber, l_returnflag <> 'R' and l_linestatus = 'F' and (l_quantity >= 10 or l_discount > 0.05) as eligible, l_quantity / 10 >= greatest(1, l_tax * 50) as relevant from lineitem""")  # fmt: skip
def eligible_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as assessed rows: returned ones were rejected, open ones aren't enriched, small ones of small discount are background."""
    c = F.col
    small = (c("l_quantity") < 10) & (c("l_discount") <= 0.05)
    scope = gates.scope_reason(F.when(small, "explainer_background").otherwise("development"), F.when(small, "unclear").otherwise("true"))
    good = gates.eligible(F.when(c("l_returnflag") == "R", "returned").otherwise(""), c("l_linestatus") == "F", scope)
    rows = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    return rows.select("l_orderkey", "l_linenumber", good.alias("eligible"), (c("l_quantity") / 10 >= F.greatest(F.lit(1.0), c("l_tax") * 50)).alias("relevant"))
