"""URL expressions. All are built-in functions, so they fold, push down and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.bind import let
from millrace.plans.values import TRACKING_PARAMS

_DEFAULT_PORTS = {"http": "80", "https": "443"}


def _parts(url: Column) -> dict[str, Column]:
    raw = F.trim(url)
    full = F.when(raw.contains("://"), raw).otherwise(F.concat(F.lit("https://"), raw))
    scheme = F.lower(F.regexp_extract(full, r"^([^:/?#]*)://", 1))
    authority = F.regexp_replace(F.regexp_extract(full, r"://([^/?#]*)", 1), r"^.*@", "")
    return {
        "raw": raw,
        "scheme": scheme,
        "host": F.regexp_replace(F.lower(F.regexp_replace(authority, r":\d*$", "")), r"\.$", ""),
        "port": F.regexp_extract(authority, r":(\d+)$", 1),
        "path": F.regexp_extract(full, r"://[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(full, r"^[^?#]*\?([^#]*)", 1),
    }


def canonical_url(url: Column) -> Column:
    """Lower scheme and host, no user, fragment, default port or tracking parameters, sorted query, no closing slash. Blank: empty."""
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)

    def query_of(raw: Column) -> Column:
        pairs = F.transform(F.filter(F.split(raw, "&"), lambda x: x != ""), lambda x: F.struct(decode(F.substring_index(x, "=", 1)).alias("k"), decode(F.when(F.instr(x, "=") > 0, F.regexp_replace(x, r"^[^=]*=", "")).otherwise("")).alias("v")))
        kept = F.filter(pairs, lambda x: ~F.lower(x["k"]).isin(*TRACKING_PARAMS) & ~F.lower(x["k"]).startswith("utm_"))
        joined = F.array_join(F.transform(F.array_sort(kept), lambda x: F.concat(F.lit("&"), F.url_encode(x["k"]), F.lit("="), F.url_encode(x["v"]))), "")
        return F.regexp_replace(joined, "^&", "?")

    def put_together(p: Column) -> Column:
        default = F.lit(False)
        for scheme, port in _DEFAULT_PORTS.items():
            default = default | ((p["scheme"] == scheme) & (p["port"] == port))
        port = F.when((p["port"] == "") | default, "").otherwise(F.concat(F.lit(":"), p["port"]))
        path = F.when(p["path"].isin("", "/"), p["path"]).otherwise(F.regexp_replace(p["path"], r"/+$", ""))
        return F.when(p["raw"] == "", "").otherwise(F.concat(p["scheme"], F.lit("://"), p["host"], port, path, F.when(p["query"] == "", "").otherwise(query_of(p["query"]))))

    return let(F.struct(*(c.alias(name) for name, c in _parts(url).items())), put_together)


def resolved(href: Column, base: Column) -> Column:
    """A link as it stands on the page at ``base``: whole, without scheme, from the root, a query or fragment alone, or relative to the folder."""
    link = F.trim(href)
    scheme, origin = F.regexp_extract(base, "^([^:]+:)", 1), F.regexp_extract(base, r"^([^:]+://[^/?#]*)", 1)
    page, folder = F.regexp_extract(base, r"^([^:]+://[^?#]*)", 1), F.regexp_extract(base, r"^([^:]+://[^?#]*/)", 1)
    return (
        F.when(link.rlike("(?i)^[a-z][a-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(scheme, link)).when(link.startswith("/"), F.concat(origin, link))
        .when(link.rlike(r"^[?#]"), F.concat(page, link)).when(link == "", base).when(F.length(folder) > F.length(scheme) + 2, F.concat(folder, link)).otherwise(F.concat(origin, F.lit("/"), link))
    )


def hostname(url: Column) -> Column:
    """The host in lower case without a leading ``www.``."""
    return F.regexp_replace(_parts(url)["host"], r"^www\.", "")


def host_is_under(host: Column, domain: Column | str) -> Column:
    """Whether a host is the domain or one of its subdomains."""
    domain = F.lit(domain) if isinstance(domain, str) else domain
    return (host == domain) | F.endswith(host, F.concat(F.lit("."), domain))


def hosts_match(left: Column, right: Column) -> Column:
    """Equal hosts, or either one under the other; empty hosts match nothing."""
    return let(F.struct(left.alias("l"), right.alias("r")), lambda h: (h["l"] != "") & (h["r"] != "") & (host_is_under(h["l"], h["r"]) | host_is_under(h["r"], h["l"])))


def host_suffixes(host: Column) -> Column:
    """The host and every domain above it, so that a join on suffixes is an equi-join."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def loose_suffix(url: Column, domain: str) -> Column:
    """The host ends with the domain's text, look-alikes included."""
    return F.endswith(hostname(url), F.lit(domain))


def url_hash(canonical: Column) -> Column:
    return F.sha2(F.trim(canonical), 256)


def content_hash(title: Column, source: Column) -> Column:
    """Of title and source, each with blanks folded and in lower case."""
    norm = lambda x: F.lower(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " ")))
    return F.sha2(F.concat(norm(title), F.lit("|"), norm(source)), 256)


def refreshed_identity(rows: DataFrame) -> DataFrame:
    """Rows with canonical, url, publisher_key, url_hash and content_hash made anew.

    Each address stands in for the other where one is blank; a publisher's key is the one it
    has, else its registry id ``source_id``, else its host.
    """
    blank = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    had = blank("canonical") if "canonical" in rows.columns else F.lit(None).cast("string")
    full = rows.withColumn("canonical", canonical_url(F.coalesce(had, blank("url"), F.lit(""))))
    named = full.withColumn("url", F.coalesce(F.nullif(canonical_url(F.coalesce(F.col("url"), F.lit(""))), F.lit("")), F.col("canonical")))
    key = F.coalesce(blank("publisher_key"), blank("source_id"), hostname(F.col("canonical")))
    return named.withColumns({"publisher_key": key, "url_hash": F.when(F.col("canonical") != "", url_hash(F.col("canonical"))).otherwise(""), "content_hash": content_hash(F.col("title"), F.col("source"))})


def image_identity(url: Column) -> Column:
    """The canonical address without its query."""
    return F.regexp_replace(canonical_url(url), r"\?.*$", "")


def safe_http_url(url: Column) -> Column:
    """The canonical address if it is http(s) with a dotted host and without blanks, else empty."""
    p = _parts(url)
    good = F.trim(url).rlike(r"(?i)^https?://") & p["host"].contains(".") & ~F.trim(url).rlike(r"\s")
    return F.when(good, canonical_url(url)).otherwise("")


def article_path(url: Column, sections: str) -> Column:
    """Whether a path looks like an article's: two parts or more, no section name, no asset, a long slug or a node's parent."""
    parts = F.filter(F.split(_parts(url)["path"], "/"), lambda x: x != "")
    slug = F.element_at(parts, -1)
    return (
        (F.size(parts) >= 2)
        & ~F.exists(parts, lambda x: x.rlike(f"(?i)^(?:{sections})$"))
        & ~F.coalesce(slug.rlike(r"(?i)\.(?:jpg|jpeg|png|gif|svg|webp|css|js|pdf|zip|xml|mp4|mp3)$"), F.lit(False))
        & ((F.size(F.filter(F.split(slug, "[-_]"), lambda x: x != "")) >= 4) | F.coalesce(F.try_element_at(parts, F.lit(-2)).isin("article", "node"), F.lit(False)))
    )


def public_destination(url: Column) -> Column:
    """http(s), no user, no port, a dotted host that isn't local, and no private address."""
    authority = F.regexp_extract(F.trim(url), r"://([^/?#]*)", 1)
    host = _parts(url)["host"]
    numeric = host.rlike(r"^\d+(\.\d+){3}$")
    octet = lambda k: F.try_element_at(F.split(host, r"\."), F.lit(k)).try_cast("int")
    private = (octet(1).isin(0, 10, 127)) | ((octet(1) == 172) & octet(2).between(16, 31)) | ((octet(1) == 192) & (octet(2) == 168)) | ((octet(1) == 169) & (octet(2) == 254)) | (octet(1) >= 224)
    return F.trim(url).rlike(r"(?i)^https?://") & ~authority.contains("@") & ~authority.rlike(r":\d+$") & host.contains(".") & ~host.rlike(r"(^|\.)(local|localhost|internal)$") & ~(numeric & F.coalesce(private, F.lit(True)))
