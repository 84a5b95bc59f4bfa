"""URL filters: explicit rules, and a classifier of segmented host and path words.

A rule (host, path) fits its host and all subdomains where the url's path starts with the
rule's; of those that fit, the longest decides (of equal ones that of the longer host, then
one that blocks). Other urls are judged by naive Bayes: names in the host are split at
everything that isn't a letter and by a unigram Viterbi search into words, path segments at
everything that isn't a letter or digit, and a multinomial model over hashed tokens, with a
flag for host or path in the hash, gives the odds of an unwanted page.

Word frequencies come from the visible text of all pages. Only words that occur within a
host can be part of its split, so the substrings of the distinct names, of up to ``LONGEST``
letters, which is all that a host's label may have, are joined with the word counts, and each
name is searched with its own words alone: no vocabulary is held anywhere and no word is cut
off. What the search needs of the rest is one number, the sum of all counts.

The training labels are weak: a page counts as unwanted if a word of its host or path is one
of ``UNWANTED_WORDS``, names of trades that filters of urls are after, or by what it holds:
few words outside links, links that hold much of its text, scripts that make up most of it,
or many input fields. The model learns from these which other words go along with them.
Pages without html aren't learnt from. Token counts over all urls are summed in 2^``BITS``
buckets, so that what the driver holds doesn't grow with the hosts. Where blocking begins is
chosen on held-out urls, a fifth by hash, with a model of the others: the odds of best F1.
The weights then come from all urls. With fewer than ``LEAST`` unwanted held-out urls, too few
to choose by, it begins at even odds.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case.
Path: what follows up to ``?``, ``#`` or the end. Null or without ``://``: both empty, no rule
fits and the model judges by its prior alone. Equal urls get equal verdicts; rules that are
repeated count once; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches
from millrace.llm.scratch import cut

#: Words that names are made of, which page texts may lack; those that do count as often as an average word.
NAME_WORDS = ("app", "best", "blog", "cdn", "club", "data", "farm", "free", "forum", "home", "info", "law", "mail", "media", "mobile", "news", "online", "photo", "shop", "site", "store", "tech", "the", "track", "video", "web", "win", "world")
#: Words of trades that filters of urls are after; own choice. They are words of names too.
UNWANTED_WORDS = ("adult", "bet", "bets", "betting", "bingo", "casino", "casinos", "cheats", "cracked", "dating", "diet", "escort", "escorts", "gamble", "gambling", "jackpot", "keygen", "loan", "loans", "lottery", "payday", "pharmacy", "pill", "pills", "poker", "porn", "replica", "roulette", "sex", "slots", "torrent", "torrents", "viagra", "warez", "xxx")
#: Held-out urls: one of so many. Steps of log odds at which blocking may begin, and the furthest.
FOLDS, STEP, FURTHEST = 5, 0.05, 100.0
#: Unwanted held-out urls that a choice takes.
LEAST = 10
#: Fixed value: the most letters of a host's label.
LONGEST = 63
BITS = 16
#: A host that has more than one of so many rows is looked up by broadcast; there are fewer such hosts than this.
HOT = 1_000
#: An unwanted page: fewer words outside links, a greater share of words in links, a greater share of scripts, more input fields.
FEW_WORDS, LINK_SHARE, SCRIPT_SHARE, INPUTS = 100, 0.25, 0.6, 12


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as the table (host, path, allow) that ``judge`` takes."""
    return spark.createDataFrame([(r.host, r.path, r.allow) for r in rules], "host string, path string, allow boolean")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path)."""
    there = F.instr(url, "://") > 0
    rest = F.when(there, F.expr("substring({0}, instr({0}, '://') + 3)".format("__url"))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


class Segmenter:
    """Splits a run of letters into the likeliest words under unigram frequencies.

    ``counts`` may be the words that occur in the run alone; ``total`` is the sum of all counts.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self.cost = {w: -math.log(n / total) for w, n in counts.items() if n > 0 and w}
        #: An unknown word costs more than any known one, and more the longer it is.
        self.unknown = math.log(total) + 2
        self.longest = max(map(len, self.cost), default=1)

    def words(self, name: str) -> tuple[str, ...]:
        cost, n = self.cost, len(name)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        open_ = 0  # where an unknown word that ends here starts at least cost: its length counts linearly
        for i in range(1, n + 1):
            if best[i - 1] - 2.0 * (i - 1) < best[open_] - 2.0 * open_ - 1e-12:
                open_ = i - 1
            best[i], back[i] = best[open_] + self.unknown + 2.0 * (i - open_), open_
            for j in range(max(0, i - self.longest), i):
                c = best[j] + cost.get(name[j:i], math.inf)
                if c < best[i] - 1e-12:
                    best[i], back[i] = c, j
        out, i = [], n
        while i:
            out.append(name[back[i] : i])
            i = back[i]
        return tuple(reversed(out))


_UNWANTED = frozenset(UNWANTED_WORDS)
_PART = re.compile(r"[^\W\d_]+|\d+")


def path_tokens(path: str) -> list[str]:
    """Words of a path; a number is one token whatever it is."""
    return ["0" if p.isdigit() else p for p in _PART.findall(path.lower())]


def bucket(kind: str, token: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}:{token}") >> (64 - BITS)


@dataclass(frozen=True)
class Model:
    #: (word, count) of all words of pages and names, and the sum of their counts.
    counts: DataFrame
    total: int
    #: Log odds of unwanted against wanted for each bucket, and of the prior.
    weights: np.ndarray
    prior: float
    #: Log odds beyond which a url is blocked, and how that did on held-out urls.
    threshold: float = 0.0
    precision: float = 0.0
    recall: float = 0.0


def _visible(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]+;", " ")


def visible_words(html: Column) -> Column:
    """The lower-case words outside tags, scripts and styles."""
    return F.split(F.trim(F.regexp_replace(F.lower(_visible(html)), r"[^\p{L}]+", " ")), " ")


def unwanted(html: Column) -> Column:
    """The weak label of a page, by what it holds; null without html."""
    n = lambda text: F.regexp_count(text, F.lit(r"\p{L}+"))
    linked = n(_visible(F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>(.*?)</a\s*>"), 1), " ")))
    scripts = F.length(F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)(<script\b.*?</script\s*>)"), 1), ""))
    inputs = F.regexp_count(html, F.lit(r"<(?i:input|select|textarea)\b"))
    told = n(_visible(html))
    return (told - linked < FEW_WORDS) | (linked >= LINK_SHARE * told) | (scripts >= SCRIPT_SHARE * F.length(html)) | (inputs >= INPUTS)


def word_counts(pages: DataFrame, html: str = "html") -> tuple[DataFrame, int]:
    """(word, count) over all pages, stored, and the sum of the counts; words of names that no page has count as an average one."""
    words = pages.select(F.explode(visible_words(F.col(html))).alias("word")).where(F.length("word").between(2, LONGEST))
    counted = cut(words.groupBy("word").agg(F.count("*").alias("count")))
    whole, n = counted.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    usual = max(1, whole // max(1, n))
    names = pages.sparkSession.createDataFrame([(w,) for w in (*NAME_WORDS, *UNWANTED_WORDS)], "word string").join(counted, "word", "left_anti").select("word", F.lit(usual).cast("long").alias("count"))
    missing = cut(names)
    return counted.unionByName(missing), whole + usual * missing.count()


def host_words(hosts: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(host, words) of distinct hosts: the words of their names, in order."""
    named = hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(r"(\p{L}+)"), 1)).alias("at", "name"))
    names = cut(named.select("name").distinct().withColumn("row", F.monotonically_increasing_id()))
    starts = names.select("row", F.length("name").alias("n"), "name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i")).select("row", F.substr("name", F.col("i"), F.lit(LONGEST)).alias("rest"))
    parts = starts.where(F.length("rest") > 1).select("row", F.explode(F.transform(F.sequence(F.lit(2), F.length("rest")), lambda k: F.left("rest", k))).alias("word")).distinct()
    # a name's own words, at most 62 for each of its letters
    known = parts.join(counts, "word").groupBy("row").agg(F.collect_list(F.struct("word", "count")).alias("known"))
    split = names.join(known, "row", "left").select("name", "known").mapInArrow(partial(_segmented, total=total), "name string, words array<string>")
    return named.join(split, "name").groupBy("host").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))


def _segmented(batches: Iterable[pa.RecordBatch], total: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, known = batch.column(0), batch.column(1).to_pylist()
        found = [list(Segmenter({x["word"]: x["count"] for x in own or ()}, total).words(name)) for name, own in zip(names.to_pylist(), known, strict=True)]
        yield pa.RecordBatch.from_arrays([names, pa.array(found, pa.list_(pa.string()))], names=["name", "words"])


def _split(pages: DataFrame, url: str, **more: Column) -> DataFrame:
    taken = pages.select(F.col(url).alias("__url"), *(c.alias(n) for n, c in more.items()))
    host, path = split_url(F.col("__url"))
    return taken.select(*more, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def _hosts(split: DataFrame) -> DataFrame:
    """(host, n) of distinct hosts, stored."""
    return cut(split.groupBy("host").agg(F.count("*").alias("n")))


def _looked_up(split: DataFrame, hosts: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with what ``found`` has for their host; hosts with a large share of the rows are split from the shuffle."""
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = hosts.where(F.col("n") * HOT > total).select("host")  # fewer than HOT rows
    common = split.join(F.broadcast(hot.join(found, "host", "left")), "host")
    return common.unionByName(split.join(F.broadcast(hot), "host", "left_anti").join(found, "host", "left"))


def learn(pages: DataFrame, url: str = "url", html: str = "html") -> Model:
    counts, total = word_counts(pages, html)
    # stored, as what it is read for later would else take pages apart again
    held = F.pmod(F.xxhash64(F.col(url)), F.lit(FOLDS)) == 0
    split = cut(_split(pages.where(F.col(html).isNotNull()), url, unwanted=unwanted(F.col(html)), held=held))
    hosts = _hosts(split)
    told = cut(_looked_up(split, hosts, cut(host_words(hosts, counts, total))).select(F.coalesce("words", F.array().cast("array<string>")).alias("words"), "path", "unwanted", "held"))
    sums = map_batches(told, _count_maker, "bucket int, held boolean, unwanted long, wanted long").groupBy("bucket", "held").agg(F.sum("unwanted").alias("unwanted"), F.sum("wanted").alias("wanted")).collect()  # at most 2 * (2 ** BITS + 1) rows
    seen, urls = np.zeros((2, 2, 1 << BITS)), np.zeros((2, 2))
    for r in sums:
        of = int(r["held"])
        if r["bucket"] < 0:
            urls[of] += [r["wanted"], r["unwanted"]]
        else:
            seen[of, :, r["bucket"]] = r["wanted"], r["unwanted"]
    threshold, precision, recall = begin(told.where("held"), *odds(seen[0], urls[0]))
    return Model(counts, total, *odds(seen.sum(axis=0), urls.sum(axis=0)), threshold, precision, recall)


def odds(seen: np.ndarray, urls: np.ndarray) -> tuple[np.ndarray, float]:
    """Log odds of unwanted against wanted, of each bucket and before any token, from counts of (wanted, unwanted)."""
    used = max(1, int((seen.sum(axis=0) > 0).sum()))
    chance = (seen + 1) / (seen.sum(axis=1, keepdims=True) + used)
    return np.log(chance[1] / chance[0]), float(np.log((urls[1] + 1) / (urls[0] + 1)))


def begin(told: DataFrame, weights: np.ndarray, prior: float) -> tuple[float, float, float]:
    """(log odds beyond which to block, precision, recall) of best F1 on rows (words, path, unwanted); of equal ones the greatest odds."""
    rows = map_batches(told.select("words", "path", "unwanted"), partial(_step_maker, weights, prior), "step int, bad boolean, n long").groupBy("step").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("bad")).orderBy(F.desc("step")).collect()  # as many rows as there are steps
    every, said, right, best = sum(r["bad"] for r in rows), 0, 0, (0.0, 0.0, 0.0, 0.0)
    if every < LEAST:
        return best[1:]
    for r in rows:
        said, right = said + r["n"], right + r["bad"]
        f1 = 2 * right / (said + every)
        if right and f1 > best[0] + 1e-12:
            best = f1, (r["step"] - 1) * STEP, right / said, right / every
    return best[1:]


def is_unwanted(names: list[str], path: str, page: bool | None) -> bool:
    """The weak label: by the page, else by a word of the url."""
    return bool(page) or not _UNWANTED.isdisjoint(names) or not _UNWANTED.isdisjoint(path_tokens(path))


def log_odds(names: list[str], path: str, weights: np.ndarray, prior: float) -> float:
    return prior + float(sum(weights[bucket("h", w)] for w in names) + sum(weights[bucket("p", w)] for w in path_tokens(path)))


def _step_maker(weights: np.ndarray, prior: float) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[int, bool], int] = {}
        for names, path, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at = max(-FURTHEST, min(FURTHEST, log_odds(names, path, weights, prior)))
            told = math.ceil(at / STEP), is_unwanted(names, path, page)
            found[told] = found.get(told, 0) + 1
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([bad for _, bad in found], pa.bool_()), pa.array(found.values(), pa.int64())], names=["step", "bad", "n"])

    return work


def _count_maker() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: dict[tuple[int, bool], list[int]] = {}
        for names, path, page, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bad = is_unwanted(names, path, page)
            for b in (-1, *(bucket("h", w) for w in names), *(bucket("p", w) for w in path_tokens(path))):
                found.setdefault((b, held), [0, 0])[0 if bad else 1] += 1
        rows = sorted(found.items())
        return pa.RecordBatch.from_arrays([pa.array([b for (b, _), _ in rows], pa.int32()), pa.array([h for (_, h), _ in rows], pa.bool_()), *(pa.array([n[k] for _, n in rows], pa.int64()) for k in (0, 1))], names=["bucket", "held", "unwanted", "wanted"])

    return work


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules) of distinct hosts that rules of (host, path, allow) may fit: all those of the host and what it is under."""
    deepest = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
    labels, n = F.split("host", r"\."), F.size(F.split("host", r"\."))
    under = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.least(n, F.lit(max(1, deepest)))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))).alias("of"))
    rule = F.struct(F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("depth"), (~F.col("allow")).alias("block"), F.concat("host", "path").alias("name"), "path")
    own = rules.distinct().select(F.col("host").alias("of"), rule.alias("rule"))
    return under.join(own, "of").groupBy("host").agg(F.collect_list("rule").alias("rules"))


def judge(pages: DataFrame, model: Model, rules: DataFrame | list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Rows (key, host, path, rule, verdict, log_odds, host_words); ``rules`` as a list or as a table (host, path, allow)."""
    rules = rule_table(pages.sparkSession, rules) if isinstance(rules, list) else rules
    split = cut(_split(pages, url, __key=F.col(key)))
    hosts = _hosts(split)
    found = cut(host_words(hosts, model.counts, model.total).join(host_rules(hosts, rules), "host", "full"))
    ruled = _looked_up(split, hosts, found).withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["path"])))
    told = ruled.select("__key", "host", "path", best.alias("best"), "words").select("__key", "host", "path", F.col("best.name").alias("rule"), F.col("best.block").alias("block"), "words")
    kind = dict(pages.dtypes)[key]
    odds = map_batches(told, partial(_judge_maker, model.weights, model.prior), f"__key {kind}, host string, path string, rule string, block boolean, log_odds double, host_words string")
    verdict = F.when(F.coalesce("block", F.col("log_odds") > model.threshold), "block").otherwise("allow")
    return odds.select(F.col("__key").alias(key), "host", "path", "rule", verdict.alias("verdict"), "log_odds", "host_words")


def _judge_maker(weights: np.ndarray, prior: float) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        odds, said = [], []
        for path, names in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist(), strict=True):
            odds.append(log_odds(names, path, weights, prior))
            said.append(" ".join(names))
        return pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(odds, pa.float64()), pa.array(said, pa.string())], names=[*batch.schema.names[:5], "log_odds", "host_words"])

    return work
