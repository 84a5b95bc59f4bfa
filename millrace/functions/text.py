"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.bind import let
from millrace.plans.values import EVENT_STOP_WORDS

#: The entities of markup texts that are replaced without a parser; ``&amp;`` comes last.
ENTITIES = {"&nbsp;": " ", "&#160;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&", "&#38;": "&"}


def fold_blanks(x: Column) -> Column:
    """Every run of white space, of any script, becomes one blank; none at the ends. Null: empty."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def unescape(x: Column) -> Column:
    for entity, char in ENTITIES.items():
        x = F.replace(x, F.lit(entity), F.lit(char))
    return x


def strip_html(x: Column) -> Column:
    """Tags become blanks, entities characters. Texts without either have their blanks folded alone."""
    return F.when(x.contains("<") | x.contains("&"), fold_blanks(unescape(F.regexp_replace(x, r"<[^>]+>", " ")))).otherwise(fold_blanks(x))


def clean_text(x: Column) -> Column:
    """As ``strip_html`` twice, for markup that was escaped once more."""
    return let(strip_html(x), lambda once: F.when(once.contains("<") | once.contains("&"), strip_html(once)).otherwise(once))


def snippet(x: Column, cap: int = 600) -> Column:
    """``clean_text``, cut after ``cap`` characters. A head without markup that cleans to more than these decides alone; nothing behind it changes them."""
    head = F.substring(x, 1, 4 * cap)
    plain = F.when(~(head.contains("<") | head.contains("&")), fold_blanks(head))
    cleaned = let(plain, lambda told: F.when(F.length(told) > cap, told).otherwise(clean_text(x)))
    return let(cleaned, lambda text: F.when(F.length(text) > cap, F.concat(F.rtrim(F.substring(text, 1, cap)), F.lit("..."))).otherwise(text))


def meaningful_title(title: Column) -> Column:
    """Twelve characters and three words with a letter or digit, at least."""
    title = F.trim(F.coalesce(title, F.lit("")))
    return (F.length(title) >= 12) & (F.size(F.filter(F.split(title, r"\s+"), lambda w: w.rlike(r"[\p{L}\p{N}]"))) >= 3)


def title_tokens(title: Column, stop: tuple[str, ...] = EVENT_STOP_WORDS) -> Column:
    """The distinct ASCII words of two letters or more of a title, less its publisher's name and stop words, ascending."""
    bare = F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+[-|:]\s+[^-|:]{2,50}$", "")
    # a match begins where a run does, so none is taken from within a longer run
    words = F.regexp_extract_all(F.lower(bare), F.lit(r"([a-z0-9]{2,})"), 1)
    return F.sort_array(F.array_except(words, F.array(*map(F.lit, stop))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared against all elements; null if there are none."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


def headline_key(title: Column) -> Column:
    """Lower-case words of letters and digits joined by blanks."""
    return F.array_join(F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1), " ")


def merge_labels(*groups: Column) -> Column:
    """Labels of several lists in order, trimmed, without blanks and without repeats in any case."""
    labels = F.filter(F.transform(F.flatten(F.array(*(F.coalesce(g, F.array().cast("array<string>")) for g in groups))), lambda x: F.trim(x)), lambda x: x != "")
    lower = F.transform(labels, lambda x: F.lower(x))
    return F.filter(labels, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def distinct_labels(labels: Column) -> Column:
    """In order, without blanks and exact repeats."""
    return F.array_distinct(F.filter(labels, lambda x: F.trim(x) != ""))


def chunks(text: Column, limit: int = 1900) -> Column:
    """The text in pieces of at most ``limit``, each ending at its last blank if that lies in the second half."""
    half = limit // 2
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(rf"(?s)(.{{1,{limit}}}$|.{{{half},{limit - 1}}}\s|.{{1,{limit}}})"), 1), lambda x: F.trim(x)), lambda x: x != "")


def ordinal(n: Column) -> Column:
    suffix = F.when((n % 100).between(11, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def edition_number(code: Column) -> Column:
    """The number in a code such as ``#012``, else null."""
    return F.regexp_extract(code, r"(\d+)", 1).try_cast("int")


def markdown_image(line: Column) -> Column:
    """struct<alt, url> of a line that is an image, else null."""
    return F.when(line.rlike(r"^\s*!\[[^\]]*\]\([^)\s]+\)\s*$"), F.struct(F.regexp_extract(line, r"!\[([^\]]*)\]", 1).alias("alt"), F.regexp_extract(line, r"\]\(([^)\s]+)\)", 1).alias("url")))


def block_kind(line: Column) -> Column:
    """What a Markdown line becomes: heading, list item, image or paragraph."""
    return (
        F.when(line.startswith("### "), "heading_3").when(line.startswith("## "), "heading_2").when(line.startswith("# "), "heading_1")
        .when(line.rlike(r"^[-*] "), "bulleted_list_item").when(line.rlike(r"^\d+\. "), "numbered_list_item")
        .when(markdown_image(line).isNotNull(), "image").when(F.trim(line) == "", "blank").otherwise("paragraph")
    )


def evidence_status(status: Column) -> Column:
    """A status in one spelling: lower case, blanks as underscores."""
    return F.replace(F.lower(F.trim(F.coalesce(status, F.lit("")))), F.lit(" "), F.lit("_"))


def has_evidence(status: Column) -> Column:
    return evidence_status(status).isin("feed_content", "extracted")
