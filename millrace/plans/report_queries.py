"""Queries of roll-ups, metrics, comparisons and draft checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import drafts, rollups
from millrace.plans.catalog import query
from millrace.plans.pool_queries import CANDIDATES_SQL, candidates
from millrace.plans.scalar_queries import CANONICAL_SQL
from millrace.sources.tables import table


@query("stage_rollup", f"""
    with {CANDIDATES_SQL} select tier, region, count(*) as n, count(*) filter (where significance >= 3) as significant, count(*) filter (where quality < 0) as unrated, count(distinct publisher) as identities from scored group by rollup (tier, region)""")  # fmt: skip
def stage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.stage_rollup(candidates(spark, sf_dir), ["tier", "region"], {"significant": F.col("significance") >= 3, "unrated": F.col("quality") < 0}, "publisher")


@query("unique_across_phases", """
    select user_id, count(distinct event_type) as phases, max_by(event_type, event_id) as last_region, count(distinct event_type) > 1 as again from events group by user_id""")  # fmt: skip
def unique_across_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.reconsidered(table(spark, sf_dir, "events", "user_id", "event_type", "event_id"), "user_id", "event_type", "event_id", "event_type")


@query("acquisition", """
    with one as (select o_custkey, arg_max(o_orderstatus, (o_orderpriority = '1-URGENT', o_orderkey)) as method, bool_or(o_orderpriority = '1-URGENT') as urgent, bool_or(o_totalprice > 400000) as large from orders group by 1)
    select method, count(*) as n, count(*) filter (where urgent) as urgent, count(*) filter (where large) as large from one group by 1""")  # fmt: skip
def acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey", "o_totalprice").withColumnRenamed("o_orderstatus", "method")
    flags = rows.withColumns({"is_urgent": F.col("o_orderpriority") == "1-URGENT", "is_large": F.col("o_totalprice") > 400000})
    return rollups.best_then_count(flags, "o_custkey", [F.col("is_urgent"), F.col("o_orderkey")], "method", {"urgent": "is_urgent", "large": "is_large"})


@query("latency_median", """
    select coalesce(event_type, 'ALL') as event_type, k, count(*) as n, median(value) as median_value, count(*) filter (where value > 100) as high from (select event_type, value, user_id % 3 as k from events) group by grouping sets ((event_type, k), (k))""")  # fmt: skip
def latency_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_type", "value", "user_id").withColumn("k", F.col("user_id") % 3)
    return rollups.with_total(rows, ["event_type", "k"], [F.count("*").alias("n"), F.count_if(F.col("value") > 100).alias("high")], ("value", "median_value"))


@query("status_histogram", "select user_id, list(event_type || ':' || n order by event_type) as histogram from (select user_id, event_type, count(*) as n from events group by 1, 2) group by 1")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events", "user_id", "event_type").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(F.array_sort(F.collect_list(F.concat("event_type", F.lit(":"), "n"))).alias("histogram"))


@query("transition_histogram", """
    select was, event_type as became, count(*) as n from (select event_type, lag(event_type) over (partition by user_id order by ts, event_id) as was from events) where was is not null group by 1, 2""")  # fmt: skip
def transition_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events", "user_id", "event_type", "ts", "event_id").withColumn("was", F.lag("event_type").over(w)).where("was is not null")
    return rows.groupBy("was", F.col("event_type").alias("became")).agg(F.count("*").alias("n"))


@query("decision_label", """
    select o_orderstatus, stage, count(*) as n from (select o_orderstatus, case when o_orderpriority = '1-URGENT' then 'final_selection' when o_orderpriority = '2-HIGH' and o_totalprice > 200000 then 'fallback_qualified_not_selected'
        when o_orderstatus = 'P' then 'objective_cleanup_rejection' when o_custkey % 10 = 0 then 'duplicate_before_enrichment' else 'metadata_rejection' end as stage from orders) group by 1, 2""")  # fmt: skip
def decision_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.gates import decision_stage

    orders = table(spark, sf_dir, "orders", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey")
    stage = decision_stage([(F.col("o_orderpriority") == "1-URGENT", "final_selection"), ((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_totalprice") > 200000), "fallback_qualified_not_selected"), (F.col("o_orderstatus") == "P", "objective_cleanup_rejection"), (F.col("o_custkey") % 10 == 0, "duplicate_before_enrichment")])
    return orders.groupBy("o_orderstatus", stage.alias("stage")).agg(F.count("*").alias("n"))


@query("token_usage", "select event_type, coalesce(sum(case when user_id % 7 = 0 then null else event_id % 100 end), 0)::bigint as tokens, count(*) filter (where user_id % 7 = 0) as unknown, count(*) as requests from events group by 1")
def token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = F.when(F.col("user_id") % 7 != 0, F.col("event_id") % 100)
    return rollups.token_usage(table(spark, sf_dir, "events", "event_type", "user_id", "event_id"), ["event_type"], used)


@query("map_merge", "select user_id % 7 as run, event_type as k, count(*) as n from events group by 1, 2")
def map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's counts as a map, the maps of a run added."""
    counts = table(spark, sf_dir, "events", "event_type", "user_id").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return rollups.merged_maps(counts.withColumn("run", F.col("user_id") % 7), ["run"], "m").select("run", F.col("key").alias("k"), F.col("value").alias("n"))


@query("tier_counts", f"with {CANDIDATES_SQL} select region, count(*) filter (tier = 'strict') as strict, count(*) filter (tier = 'fallback') as fallback, 0::bigint as other from scored group by 1")
def tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.tier_counts(candidates(spark, sf_dir), "tier", ("strict", "fallback", "other"), ["region"])


@query("binary_metrics", """
    with p as (select d.lang, case when d.doc_id % 11 = 0 then null else length(d.text) > 800 end as predicted, l.quality = 1 as actual from documents d left join labels l using (doc_id)),
         c as (select lang, count(*) filter (where predicted and actual) as tp, count(*) filter (where predicted and not actual) as fp, count(*) filter (where not predicted and actual) as fn, count(*) filter (where not predicted and not actual) as tn,
                      count(*) filter (where predicted is null or actual is null) as unresolved from p group by 1)
    select *, round(tp / nullif(tp + fp, 0)::double, 6) as precision, round(tp / nullif(tp + fn, 0)::double, 6) as recall from c""")  # fmt: skip
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents", "doc_id", "lang", "text").join(table(spark, sf_dir, "labels", "doc_id", "quality"), "doc_id", "left")
    return rollups.binary_metrics(rows, F.when(F.col("doc_id") % 11 != 0, F.length("text") > 800), F.col("quality") == 1, ["lang"])


@query("run_diff", """
    select o_orderkey, list_filter([case when o_orderstatus is distinct from (case when o_custkey % 3 = 0 then 'X' else o_orderstatus end) then 'status' end, case when o_totalprice > 300000 then 'price' end], lambda x: x is not null) as changed
    from orders where o_totalprice > 300000 or o_custkey % 3 = 0""")  # fmt: skip
def run_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    right = left.withColumns({"status": F.when(F.col("o_custkey") % 3 == 0, "X").otherwise(F.col("status")), "price": F.when(F.col("price") > 300000, F.lit(None)).otherwise(F.col("price"))})
    return rollups.run_diff(left, right, "o_orderkey", ["status", "price"])


@query("headline_setops", """
    with t as (select source, trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^\\p{L}\\p{N}]+', ' ', 'g')) as k from documents), a as (select distinct k from t where source = 'src0'), b as (select distinct k from t where source <> 'src0')
    select (select count(*) from (select k from a intersect select k from b)) as overlap, (select count(*) from (select k from a except select k from b)) as unique_left, (select count(*) from (select k from b except select k from a)) as unique_right""")  # fmt: skip
def headline_setops(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents", "source", "text").select("source", text.headline_key(F.substring_index("text", "\n", 1)).alias("k"))
    return rollups.set_overlap(rows.where("source = 'src0'"), rows.where("source <> 'src0'"), "k")


@query("exclusion_union", "select o_custkey as k from orders union select c_custkey from customer union select s_suppkey from supplier")
def exclusion_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.union_keys((table(spark, sf_dir, "orders", "o_custkey"), "o_custkey"), (table(spark, sf_dir, "customer", "c_custkey"), "c_custkey"), (table(spark, sf_dir, "supplier", "s_suppkey"), "s_suppkey"))


@query("relation_union", """
    with r as (select o_custkey, coalesce(list_sort(list(distinct o_orderstatus) filter (o_orderstatus <> 'P')), []) as old, list_sort(list(distinct o_orderstatus)) as new from orders group by 1)
    select o_custkey, list_concat(old, list_filter(new, lambda x: not list_contains(old, x))) as related, len(list_filter(new, lambda x: not list_contains(old, x))) > 0 as changed from r""")  # fmt: skip
def relation_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = lambda c: F.array_sort(F.collect_set(c))
    rows = table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").groupBy("o_custkey").agg(known("o_orderstatus").alias("new"), known(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))).alias("old"))
    return rows.select("o_custkey", F.inline(F.array(rollups.union_relations(F.col("old"), F.col("new")))))


@query("cost_ledger", """
    select user_id, event_id, round(sum(value::decimal(18,2)) over w, 2)::double as spent, sum(value::decimal(18,2)) over w <= 500 as allowed from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)""")  # fmt: skip
def cost_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "user_id", "event_id", "ts", "value")
    return rollups.running_ledger(rows, ["user_id"], ["ts", "event_id"], F.col("value").cast("decimal(18,2)"), 500).select("user_id", "event_id", F.col("spent").cast("double").alias("spent"), "allowed")


@query("payload_running_size", """
    select event_id, sum(strlen(props)) over (partition by event_type order by event_id rows unbounded preceding)::bigint as bytes, ((row_number() over (partition by event_type order by event_id) - 1) // 100)::int as batch from events""")  # fmt: skip
def payload_running_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.assessment import batches

    return batches(table(spark, sf_dir, "events", "event_id", "event_type", "props"), ["event_type"], "event_id", F.octet_length("props"), 100).select("event_id", "bytes", "batch")


@query("stratified_sample", """
    select source, doc_id, turn::int as turn from (select source, doc_id, row_number() over (partition by source order by n_chars desc, doc_id) as turn from documents) order by turn, source limit 60""")  # fmt: skip
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.stratified_turns(table(spark, sf_dir, "documents", "source", "doc_id", "n_chars"), "source", [F.desc("n_chars"), F.asc("doc_id")], 60).select("source", "doc_id", "turn")


@query("success_rates", """
    select user_id % 10 as publisher, count(*) as n, count(*) filter (where event_type <> 'error') as ok, round(count(*) filter (where event_type <> 'error') / count(*)::double, 6) as share,
           case when count(*) filter (where event_type <> 'error') >= 0.8 * count(*) and median(value) <= 60 then 'GO' else 'NO-GO' end as rule from events group by 1""")  # fmt: skip
def success_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "user_id", "event_type", "value").withColumn("publisher", F.col("user_id") % 10)
    return rollups.success_rates(rows, "publisher", F.col("event_type") != "error", "value", 0.8, 60)


@query("json_fields", "select (props::json->>'k')::int as k, count(*) as n, round(sum(value::decimal(18,2)), 2)::double as total from events group by 1")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "props", "value").select(F.from_json("props", "k int").getField("k").alias("k"), F.col("value").cast("decimal(18,2)").alias("v"))
    return rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").cast("double").alias("total"))


@query("schema_validation", """
    select event_type, count(*) as n, count(*) filter (where try_cast(props::json->>'k' as int) between 0 and 50) as valid, bool_and(try_cast(props::json->>'k' as int) between 0 and 99) as all_known from events group by 1""")  # fmt: skip
def schema_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from millrace.operators.assessment import valid_object

    rows = table(spark, sf_dir, "events", "event_type", "props")
    good = lambda most: valid_object(F.col("props"), {"k": F.get_json_object("props", "$.k").try_cast("int").between(0, most)})
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(good(50)).alias("valid"), F.bool_and(good(99)).alias("all_known"))


@query("section_split", """
    with l as (select doc_id, unnest(generate_series(1, len(x))) as pos, unnest(x) as line from (select doc_id, string_split(text, chr(10)) as x from documents)),
         s as (select *, sum(case when regexp_matches(line, '^(#|=|\\*|[A-ZÀ-Ý][^.]*$)') then 1 else 0 end) over (partition by doc_id order by pos rows unbounded preceding) as section from l)
    select doc_id, section::bigint as section, count(*) as lines from s group by 1, 2""")  # fmt: skip
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drafts.lines(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")
    return drafts.sections(rows, "doc_id", F.col("line").rlike(r"^(#|=|\*|[A-ZÀ-Ý][^.]*$)")).groupBy("doc_id", "section").agg(F.count("*").alias("lines"))


@query("draft_zip", """
    with s as (select conv_id, row_number() over (partition by conv_id order by turn) as place from conversations where role = 'user'), a as (select conv_id, row_number() over (partition by conv_id order by turn) as place from conversations where role = 'assistant')
    select coalesce(s.conv_id, a.conv_id) as conv_id, coalesce(s.place, a.place)::int as place, case when s.place is null then 'missing section' when a.place is null then 'extra section' else 'ok' end as status from s full join a on s.conv_id = a.conv_id and s.place = a.place""")  # fmt: skip
def draft_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    side = lambda role: turns.where(F.col("role") == role).select("conv_id", F.row_number().over(W.partitionBy("conv_id").orderBy("turn")).alias("place"))
    return drafts.zip_by_position(side("user"), side("assistant"), ["conv_id", "place"]).select("conv_id", "place", "status")


@query("draft_numbers", """
    with o as (select o_orderkey as k, o_custkey as c, o_orderstatus as s, regexp_replace(regexp_replace(round(o_totalprice, 2)::decimal(12,2)::varchar, '(\\.\\d*?)0+$', '\\1'), '\\.$', '') as price from orders)
    select k as o_orderkey, unnest(list_filter([{'value': k::varchar, 'unit': 'mw'}, {'value': price, 'unit': ''}, {'value': c::varchar, 'unit': 'ton/year'}],
        lambda x: not case s when 'F' then x.unit <> 'ton/year' or c = 0 when 'O' then x.unit = 'mw' else false end), recursive := true) from o""")  # fmt: skip
def draft_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as stories of three numbers; the evidence of some holds two of them, of others one, of others a wrong unit."""
    k, c, price = F.col("o_orderkey"), F.col("o_custkey"), F.round("o_totalprice", 2).cast("decimal(12,2)")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").select(
        "o_orderkey", F.concat(F.lit("A plant of "), k, F.lit(" MW cost "), price, F.lit(", with an annual output of "), c, F.lit(" tons.")).alias("story"),
        F.when(F.col("o_orderstatus") == "F", F.concat(k, F.lit(" megawatts for "), price, F.lit("; "), F.when(c == 0, "0 tons per year").otherwise("tons")))
        .when(F.col("o_orderstatus") == "O", F.concat(k, F.lit("-MW, "), c + 1, F.lit(" tons annually"))).otherwise(F.concat(k, F.lit(" GW"))).alias("evidence"),
    )
    return drafts.number_warnings(rows.select("o_orderkey", "story"), rows.select("o_orderkey", "evidence"), ["o_orderkey"])


@query("source_lines", CANONICAL_SQL + " select page_id, [canonical] as urls from c")
def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url").withColumn("text", F.concat(F.lit("A story, see https://other.example.org/x\nSources: "), "url", F.lit(".")))
    rows = drafts.lines(pages, "page_id", "text").withColumn("section", F.lit(1))
    return drafts.source_urls(rows, "page_id").select("page_id", "urls")


@query("evidence_ladder", "select user_id, event_type, case when event_type in ('click', 'view') then null when event_type = 'error' then 'no evidence was retrieved' else 'evidence is ' || event_type end as warning, count(*) as n from events group by all")
def evidence_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "click", "extracted").when(kind == "view", "feed_content").when(kind == "error", "").otherwise(kind)
    return table(spark, sf_dir, "events", "user_id", "event_type").groupBy("user_id", "event_type", drafts.evidence_warning(status).alias("warning")).agg(F.count("*").alias("n"))


@query("replace_section", """
    with l as (select doc_id, x[1:1] || ['<new>'] || x[4:] as y from (select doc_id, string_split(text, chr(10)) as x from documents) where len(x) >= 4)
    select doc_id, len(y)::bigint as lines, sha256(array_to_string(y, chr(10))) as sha from l""")  # fmt: skip
def replace_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").where(F.size(F.split("text", "\n")) >= 4)
    rows = drafts.lines(docs, "doc_id", "text")
    marked = rows.withColumn("line", F.when(F.col("pos") == 1, "{{start}}").when(F.col("pos") == 2, "{{end}}").otherwise(F.regexp_replace("line", r"^\s*\{\{(start|end)\}\}\s*$", "")))
    done = drafts.replaced_section(marked, "doc_id", "{{start}}", "{{end}}", docs.select("doc_id", F.lit(0).alias("n"), F.lit("<new>").alias("line")))
    return drafts.joined_lines(done, "doc_id").select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("lines"), F.sha2("text", 256).alias("sha"))


@query("insert_images", """
    select conv_id, turn, sha256(split_part(text, chr(10), 1) || chr(10) || '![i](u)' || case when contains(text, chr(10)) then substring(text, length(split_part(text, chr(10), 1)) + 1) else '' end) as sha from conversations""")  # fmt: skip
def insert_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").withColumn("k", F.struct("conv_id", "turn"))
    done = drafts.inserted_after(drafts.lines(turns, "k", "text"), "k", turns.select("k", F.lit(0).alias("pos"), F.lit("![i](u)").alias("line")))
    return drafts.joined_lines(done, "k").select("k.conv_id", "k.turn", F.sha2("text", 256).alias("sha"))


@query("research_notes", """
    select conv_id, list(text order by turn)[1:8] as notes from conversations where role = 'assistant' group by 1""")  # fmt: skip
def research_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").where("role = 'assistant'")
    return notes.groupBy("conv_id").agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), 1, 8).alias("notes"))


@query("prompt_text", """
    select conv_id, sha256(string_agg(turn || '. ' || role || case when length(text) >= 300 then chr(10) || 'Evidence: ' || text else '' end, chr(10) || chr(10) order by turn)) as sha from conversations group by 1""")  # fmt: skip
def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.concat("turn", F.lit(". "), "role", F.when(F.length("text") >= 300, F.concat(F.lit("\nEvidence: "), "text")).otherwise(""))
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").select("conv_id", F.struct("turn", part.alias("part")).alias("p"))
    return rows.groupBy("conv_id").agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["part"]), "\n\n"), 256).alias("sha"))
