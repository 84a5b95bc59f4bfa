"""Who is who: joins on identity, first-wins choice, and one-to-one matches."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.functions import phrases, urls
from millrace.plans.lineage import cut, stored

#: Phrases that one automaton holds; a task and the driver see as many.
SCANNED = 10_000
#: Rows of holders that are sent to every task; more are joined by a shuffle.
SENT = 500_000


def exclude_seen(rows: DataFrame, key: str, seen: DataFrame, seen_key: str) -> DataFrame:
    """Rows whose key isn't among the seen ones; null keys stay."""
    return rows.join(seen.select(F.col(seen_key).alias(key)).distinct(), key, "left_anti")


def representative(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; a limited rank, which Spark also applies before the shuffle."""
    w = W.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def identity_order(prefix: str = "") -> list[Column]:
    """Registered first, then quality, then the newest, then names."""
    c = lambda name: F.col(prefix + name)
    return [F.desc(F.coalesce(c("registered"), F.lit(False))), F.desc(F.coalesce(c("quality"), F.lit(0.0))), F.desc_nulls_last(c("published")), c("source_id").asc_nulls_first(), c("title").asc_nulls_first()]


def match_publishers(rows: DataFrame, host: str, sources: DataFrame, source_host: str, order: list[Column]) -> DataFrame:
    """``rows`` left-joined with the best source of equal host or one under the other.

    Both directions are equi-joins on exploded domain suffixes: a row's suffixes meet a source's
    host, and a row's host meets a source's suffixes. Rows need a unique ``row_id``. Without a
    match the host is ``publisher_key``.
    """
    dim = sources.withColumn("__suffixes", urls.host_suffixes(F.col(source_host)))
    up = rows.select("row_id", F.explode(urls.host_suffixes(F.col(host))).alias("__at")).join(dim.withColumnRenamed(source_host, "__at").withColumn("matched_host", F.col("__at")), "__at")
    down = rows.select("row_id", F.col(host).alias("__at")).where(F.col(host) != "").join(dim.withColumn("__at", F.explode("__suffixes")).withColumn("matched_host", F.col(source_host)).drop(source_host), "__at")
    both = up.drop("__at", "__suffixes").unionByName(down.drop("__at", "__suffixes")).dropDuplicates(["row_id", "matched_host"])
    best = representative(both, ["row_id"], order)
    return rows.join(best, "row_id", "left").withColumn("publisher_key", F.coalesce("matched_host", F.col(host)))


def keep_existing(records: DataFrame, key: str, existing: DataFrame) -> DataFrame:
    """Records whose key exists; an empty key is kept."""
    there = existing.select(F.col(existing.columns[0]).alias(key)).distinct()
    return records.where(F.coalesce(F.col(key).cast("string"), F.lit("")) == "").unionByName(records.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").join(there, key, "left_semi"))


def named(rows: DataFrame, key: str, names: DataFrame, name_key: str, name: str, into: str, unknown: str = "Unknown source") -> DataFrame:
    """``rows`` with the name that their key has in a table of unique keys, or ``unknown``."""
    known = names.select(F.col(name_key).alias(key), F.col(name).alias(into))
    return rows.join(known, key, "left").withColumn(into, F.coalesce(into, F.lit(unknown)))


def one_to_one(left: DataFrame, right: DataFrame, rules: list[list[str]], left_id: str, right_id: str) -> DataFrame:
    """(left id, right id) of pairs that agree in all columns of any rule, where neither side has another match.

    A key that more than one row of a side has makes its rows of the other side ambiguous, whatever else they match, so
    of such a key at most two rows a side are paired: as many as tell that. Copies of a hot key never multiply.
    """
    found = []
    for on in rules:
        keyed = lambda rows, name, own, on=on: rows.select(F.struct(*on).alias("__key"), F.col(own).alias(name)).where(reduce(lambda a, b: a & b, [F.col(f"__key.{c}").isNotNull() for c in on]))
        sides = {name: keyed(rows, name, own).groupBy("__key").agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high")) for rows, name, own in ((left, "l", left_id), (right, "r", right_id))}
        both = sides["l"].alias("x").join(sides["r"].alias("y"), "__key").select("__key", *(F.col(f"{a}.{c}").alias(f"{a}_{c}") for a in "xy" for c in ("n", "low", "high")))
        ends = lambda a: F.array_distinct(F.array(f"{a}_low", f"{a}_high"))
        # every row of a side, against the one or two ends of the other: that is enough to count to two
        of_left = keyed(left, "left_id", left_id).join(both, "__key").select("left_id", F.explode(ends("y")).alias("right_id"))
        of_right = keyed(right, "right_id", right_id).join(both, "__key").select(F.explode(ends("x")).alias("left_id"), "right_id")
        found.append(of_left.unionByName(of_right))
    pairs = reduce(DataFrame.unionByName, found).distinct()
    count = lambda c: F.count("*").over(W.partitionBy(c))
    return pairs.withColumns({"__l": count("left_id"), "__r": count("right_id")}).where("__l = 1 and __r = 1").select("left_id", "right_id")


@F.pandas_udf(StringType())
def _headline_words(title: pd.Series) -> pd.Series:
    # compatibility forms and full case folding have no expression
    return title.map(lambda t: " ".join(re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", t or "").casefold())))


def full_headline(title: Column, source: Column) -> Column:
    """The words of a whole headline, without its source's name at the end."""
    name = F.replace(source, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    suffix = F.concat(F.lit("(?isu)\\s+[-|]\\s+\\Q"), name, F.lit("\\E(?:\\b|$).*$"))
    return _headline_words(F.when(F.coalesce(source, F.lit("")) == "", title).otherwise(F.regexp_replace(title, suffix, F.lit(""))))


def clear_matches(feed: DataFrame, direct: DataFrame, words: int = 4, seconds: int = 86400) -> DataFrame:
    """(feed_id, direct_id) of articles of one publisher and source with equal canonical addresses, or with equal headlines
    of ``words`` words or more at most ``seconds`` apart.

    Both sides have id, publisher, source, title, canonical and published. Rows of the feed without a valid address match
    nothing. Each of the two rules is an equi-join that gives all pairs, so a key that many rows share gives many; whoever
    needs unambiguous pairs alone takes ``only_matches``.
    """
    told = lambda rows: rows.select("id", "publisher", "source", F.nullif("canonical", F.lit("")).alias("canonical"), full_headline(F.col("title"), F.col("source")).alias("headline"), "published")
    f, d = told(feed).where("canonical is not null").alias("f"), told(direct).alias("d")
    same = lambda *on: reduce(lambda a, b: a & b, [F.col(f"f.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ("publisher", "source")] + [F.col(f"f.{c}") == F.col(f"d.{c}") for c in on])
    near = F.abs(F.col("f.published").cast("double") - F.col("d.published").cast("double")) <= seconds
    ids = F.col("f.id").alias("feed_id"), F.col("d.id").alias("direct_id")
    by_url = f.join(d, same("canonical")).select(*ids)
    by_headline = f.where(F.size(F.split("headline", " ")) >= words).join(d, same("headline")).where(near).select(*ids)
    return by_url.union(by_headline).distinct()


def _ends(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of each key its two first and its two last rows; limited ranks, so each task sends as many of a key."""
    both = []
    for way in (F.asc, F.desc):
        w = W.partitionBy(*key).orderBy(*(way(c) for c in order))
        both.append(rows.withColumn("__n", F.row_number().over(w)).where("__n <= 2").drop("__n"))
    return both[0].unionByName(both[1]).distinct()


def _told_pairs(a: DataFrame, b: DataFrame, key: list[str], seconds: float | None = None) -> DataFrame:
    """(a, b): ids of pairs that agree in ``key`` and, with ``seconds``, are at most so far apart; of a row with more than two matches, two at least.

    Every row of ``a`` meets the ends of a key of ``b``. With a distance, time is cut into buckets
    of that length: all of a row's own bucket matches it, and of the buckets beside it only
    those towards it can, so the ends of three buckets tell whether it has one match or more.
    """
    left = a.select(*key, F.col("id").alias("a"), F.col("published").alias("a_at"))
    if seconds is None:
        right = _ends(b.select(*key, F.col("id").alias("b")), key, ["b"])
        return left.join(right, key).select("a", "b")
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(seconds * 1e6))
    dated = b.where(F.col("published").isNotNull()).select(*key, F.col("id").alias("b"), F.col("published").alias("b_at"), bucket(F.col("published")).alias("__bucket"))
    right = _ends(dated, [*key, "__bucket"], ["b_at", "b"]).withColumn("__bucket", F.explode(F.array(*(F.col("__bucket") + k for k in (-1, 0, 1)))))
    asked = left.where(F.col("a_at").isNotNull()).withColumn("__bucket", bucket(F.col("a_at")))
    near = F.abs(F.unix_micros("a_at") - F.unix_micros("b_at")) <= F.lit(int(seconds * 1_000_000))
    return asked.join(right, [*key, "__bucket"]).where(near).select("a", "b")


def only_matches(feed: DataFrame, direct: DataFrame, words: int = 4, seconds: int = 86400) -> DataFrame:
    """(feed_id, direct_id) of the pairs of ``clear_matches`` in which neither side has another match.

    Both sides have id, publisher, source, title, canonical and published. Copies of a hot
    headline or address never multiply: of each row as many matches are made as tell one from
    more, whatever the number of rows that share its key. Ids are unique on either side.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(c)
    told = lambda rows: rows.select("id", blank("publisher"), blank("source"), F.nullif("canonical", F.lit("")).alias("canonical"), full_headline(F.col("title"), F.col("source")).alias("headline"), "published")
    f, d = cut(told(feed).where("canonical is not null")), cut(told(direct))
    by_url, by_headline = ["publisher", "source", "canonical"], ["publisher", "source", "headline"]
    named = lambda rows: rows.where(F.size(F.split("headline", " ")) >= words)
    addressed = d.where("canonical is not null")
    of_feed = _told_pairs(f, addressed, by_url).union(_told_pairs(named(f), named(d), by_headline, seconds))
    of_direct = _told_pairs(addressed, f, by_url).union(_told_pairs(named(d), named(f), by_headline, seconds))
    pairs = of_feed.select(F.col("a").alias("feed_id"), F.col("b").alias("direct_id")).union(of_direct.select(F.col("b").alias("feed_id"), F.col("a").alias("direct_id"))).distinct()
    one = lambda by, other: pairs.groupBy(by).agg(F.count("*").alias("__n"), F.min(other).alias(other)).where("__n = 1").select("feed_id", "direct_id")
    return one("feed_id", "direct_id").intersect(one("direct_id", "feed_id"))


def merge_supplement(feed: DataFrame, direct: DataFrame, wrapper: Column) -> DataFrame:
    """The feed's rows, each merged with the page that is its only match and it that page's, and the pages left over.

    ``merged`` tells which. The direct address is taken only where the feed's is a ``wrapper``; then also its date, if it
    has one, else the feed's own or, without one, the page's. A page's snippet comes first. No row of the feed is lost.
    """
    only = cut(only_matches(feed, direct))
    pages = direct.select(F.col("id").alias("direct_id"), F.col("canonical").alias("__url"), F.col("published").alias("__date"), F.col("snippet").alias("__snippet"))
    found = feed.join(only.join(pages, "direct_id"), F.col("id") == F.col("feed_id"), "left").withColumn("merged", F.col("feed_id").isNotNull())
    taken = F.col("merged") & F.coalesce(wrapper, F.lit(False))
    merged = found.withColumns({
        "published": F.when(taken, F.coalesce("__date", "published")).otherwise(F.coalesce("published", "__date")),
        "snippet": F.coalesce(F.nullif("__snippet", F.lit("")), "snippet"),
        "canonical": F.when(taken, F.col("__url")).otherwise(F.col("canonical")),
    })
    rest = direct.join(only.select(F.col("direct_id").alias("id")), "id", "left_anti").withColumn("merged", F.lit(False))
    columns = ["id", "publisher", "source", "title", "canonical", "published", "snippet", "merged"]
    return merged.select(*columns).unionByName(rest.select(*columns))


def first_seen(rows: DataFrame, key: str, place: str) -> DataFrame:
    """``rows`` with ``repeated``: whether the key stands at an earlier place; a plain join on the key's first place."""
    first = rows.groupBy(key).agg(F.min(place).alias("__first"))
    return rows.join(first, key).withColumn("repeated", F.col(place) > F.col("__first")).drop("__first")


def once_each(rows: DataFrame, key: list[str], enrich) -> DataFrame:
    """Applies a costly step to each distinct key once and joins the result back to all rows."""
    return rows.join(enrich(rows.select(*key).distinct()), key, "left")


def longest_override(rows: DataFrame, text: str, overrides: DataFrame, phrase: str, value: str) -> DataFrame:
    """(row_id, value) of the longest phrase that the text contains, ties by the phrase.

    Phrases are set by hand; up to ``SCANNED`` of them are sought by one scan of each text. More
    join through their first word, so no row meets them all. Case doesn't count; a phrase that
    is listed twice has its least value, and a null phrase none.
    """
    listed = overrides.where(F.col(phrase).isNotNull()).groupBy(F.lower(phrase).alias("p")).agg(F.min(value).alias("v")).limit(SCANNED + 1).collect()
    if len(listed) <= SCANNED:
        return rows.select("row_id", phrases.longest(F.lower(text), {r["p"]: r["v"] for r in listed}).alias(value)).where(F.col(value).isNotNull())
    first = lambda c: F.substring_index(F.trim(F.lower(c)), " ", 1)
    words = rows.select("row_id", F.lower(text).alias("__t"), F.explode(F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"))).alias("__w"))
    hit = words.join(overrides.select(F.lower(phrase).alias("__p"), F.col(value), first(F.col(phrase)).alias("__w")), "__w").where(F.contains("__t", "__p"))
    return representative(hit, ["row_id"], [F.desc(F.length("__p")), F.col("__p")]).select("row_id", value)


def assign_distinct(offers: DataFrame, rank: str, pos: str, identity: str) -> DataFrame:
    """(rank, pos, identity): each row, by unique ``rank``, gets its first offer that no better row got.

    Resolved in rounds: every row asks for its best offer left, and the best row that asks for an
    identity holds it. Holders only get better, so every row behind one strikes that identity, asked
    for or not. That ends in the same picks as serving rows one by one. Rows whose offers run out get
    none. Offers are stored in columns, and again without what is struck or settled after rounds 1, 2,
    4, 8 and so on; between those a round stores only what is asked and held.
    """
    live = stored(offers.select(rank, pos, identity).where(F.col(identity).isNotNull()))
    open_, done, n = live, None, 0
    while True:
        n += 1
        asked = cut(open_.groupBy(rank).agg(F.min(F.struct(pos, identity)).alias("o")).select(rank, f"o.{pos}", f"o.{identity}"))
        held = cut(asked.groupBy(identity).agg(F.min(rank).alias("__holder"), F.count("*").alias("__n")))
        if held.where("__n > 1").isEmpty():
            return asked if done is None else done.unionByName(asked)
        few = held.count() <= SENT
        open_ = live.join(F.broadcast(held) if few else held, identity, "left").where(F.col("__holder").isNull() | (F.col(rank) <= F.col("__holder"))).select(rank, pos, identity)
        if n & (n - 1) == 0:
            # Settled: asked for by a row that no better one with offers left can take it from.
            least = open_.groupBy(identity).agg(F.min(rank).alias(rank))
            settled = cut(asked.join(least, [rank, identity]))
            done = settled if done is None else done.unionByName(settled)
            live = open_ = stored(open_.join(settled.select(rank), rank, "left_anti"))
