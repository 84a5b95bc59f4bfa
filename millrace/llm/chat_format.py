"""Chat formatting by schema fingerprints.

Records come as JSON in whatever layout their source uses. The nested field paths of a
record, without value types, are hashed to its fingerprint. Of the paths, those that tell
layouts apart (``MARKS``) are hashed too, and that hash selects one declarative mapping,
whose paths take the record apart into canonical turns (conversation, place, role, text);
what else a record holds doesn't matter, and is listed as ``unmapped``.

A record of no known layout, one whose turns aren't a list of objects, and one that isn't a
JSON object are kept whole, in a row with layout null that has the record and its
fingerprint; ``format_conversations`` leaves these rows out, so they never become blank
conversations, and ``unknown_records`` gives them alone.

A template then writes each conversation as one string in which only the template's own
markers are control strings: every control string of the template or of other common
templates that stands inside a role or a text is escaped, reversibly, and the loss mask is
given as code-point spans of that string.

Null texts and roles count as empty; a text may be a list of parts, of which texts are
joined and others kept as JSON; equal places keep the order of role, then text, and
repeated rows stay; records with an empty list of turns give no row and no conversation;
records of several turns without a key, ``conv_id`` or ``id`` are named by their own hash;
an empty table gives an empty result; columns besides record and key are left alone. All of
it is DataFrame functions, so the rows never leave the JVM.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN, SEP, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that steer some chat template. All begin with < or [.
CONTROL = (TURN, SEP, END, "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<start_of_turn>", "<end_of_turn>")
#: Role names of shared-chat layouts and the canonical ones; other layouts name roles as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Marks that a record of any layout may hold beside those that its mapping needs.
OPTIONAL = ("conv_id", "id", "input", "system", "turn")


def _hash(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """How one layout gives turns.

    ``needs`` are the field paths that a record of the layout has. ``turns`` is the path of an
    array with one object for each turn, whose ``role`` and ``text`` are named; ``parts`` lists
    (role, paths joined by a blank line) within the record, before those turns. ``group`` and
    ``place`` name the conversation's key and the turn's place in records that hold one turn each.
    """

    name: str
    needs: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    group: str | None = None
    place: str | None = None
    renames: bool = False

    @property
    def fingerprint(self) -> str:
        return _hash(list(self.needs))

    def paths(self) -> set[str]:
        """All field paths that the mapping reads."""
        if self.place:
            return {self.group, self.place, self.role, self.text}
        own = {self.turns, f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"} if self.turns else set()
        return own | {p for _, group in self.parts for p in group} | {"conv_id", "id"}


_SYSTEM = ("system", ("system",))


def _asked(*paths: str) -> tuple[str, tuple[str, ...]]:
    return ("user", ("context", *paths, "input"))


MAPPINGS = (
    Mapping("turn_row", ("conv_id", "turn"), role="role", text="text", group="conv_id", place="turn"),
    Mapping("messages", ("messages",), turns="messages", parts=(_SYSTEM,)),
    Mapping("messages_id", ("id", "messages"), turns="messages", parts=(_SYSTEM,)),
    Mapping("share", ("conversations",), turns="conversations", role="from", text="value", parts=(_SYSTEM,), renames=True),
    Mapping("share_id", ("conversations", "id"), turns="conversations", role="from", text="value", parts=(_SYSTEM,), renames=True),
    Mapping("instruction", ("input", "instruction", "output"), parts=(_SYSTEM, _asked("instruction"), ("assistant", ("output",)))),
    Mapping("instruction_bare", ("instruction", "output"), parts=(_SYSTEM, _asked("instruction"), ("assistant", ("output",)))),
    Mapping("prompt", ("completion", "prompt"), parts=(_SYSTEM, _asked("prompt"), ("assistant", ("completion",)))),
    Mapping("prompt_response", ("prompt", "response"), parts=(_SYSTEM, _asked("prompt"), ("assistant", ("response",)))),
    Mapping("system_prompt", ("prompt", "response", "system"), parts=(_SYSTEM, _asked("prompt"), ("assistant", ("response",)))),
    Mapping("question", ("answer", "question"), parts=(_SYSTEM, _asked("question"), ("assistant", ("answer",)))),
)


def marks_of(mappings: tuple[Mapping, ...]) -> list[str]:
    """The field paths that tell layouts apart."""
    return sorted({p for m in mappings for p in m.needs} | set(OPTIONAL))


def layouts(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, str]:
    """hash of a record's marks -> mapping: what each needs, with any of ``OPTIONAL``; the mapping that needs most decides."""
    out: dict[str, str] = {}
    for m in sorted(mappings, key=lambda m: -len(m.needs)):
        free = [p for p in OPTIONAL if p not in m.needs]
        for n in range(len(free) + 1):
            for more in combinations(free, n):
                out.setdefault(_hash([*m.needs, *more]), m.name)
    return out


def field_paths(schema: Column) -> Column:
    """The distinct nested field paths of a JSON object's schema, sorted, such as ``a``, ``a[].b``. Null if it isn't an object's."""
    tokens = F.regexp_extract_all(schema, F.lit(r"((?:`(?:[^`]|``)*`|[^\s<>,:`]+)(?=: )|OBJECT<|ARRAY<|>)"), 1)
    texts = lambda: F.array().cast("array<string>")
    nothing = F.struct(texts().alias("out"), texts().alias("open"), F.lit("").alias("at"))

    def step(acc: Column, token: Column) -> Column:
        at = F.when(token == "ARRAY<", F.concat(acc["at"], F.lit("[]"))).when(token.isin("OBJECT<", ">"), acc["at"]).otherwise(F.concat(F.try_element_at(acc["open"], F.lit(-1)), token))
        inner = F.when(acc["at"] == "", F.lit("")).otherwise(F.concat(acc["at"], F.lit(".")))
        named = ~token.isin("OBJECT<", "ARRAY<", ">")
        return F.struct(
            F.when(named, F.array_append(acc["out"], at)).otherwise(acc["out"]).alias("out"),
            F.when(token == "OBJECT<", F.array_append(acc["open"], inner)).when(token == "ARRAY<", F.array_append(acc["open"], acc["at"])).when(token == ">", F.slice(acc["open"], F.lit(1), F.greatest(F.size(acc["open"]) - 1, F.lit(0)))).otherwise(acc["open"]).alias("open"),
            at.alias("at"),
        )

    return F.when(schema.startswith("OBJECT<"), F.array_sort(F.array_distinct(F.aggregate(tokens, nothing, step, lambda acc: acc["out"]))))


def _print(paths: Column) -> Column:
    return F.left(F.sha2(F.array_join(paths, "\n"), 256), F.lit(16))


def fingerprint(record: Column) -> Column:
    """16 hex digits for the record's nested field paths; null if the record isn't a JSON object."""
    return _print(field_paths(F.schema_of_variant(F.try_parse_json(record))))


def _said(value: Column) -> Column:
    """The text of a JSON value: itself, the texts of its parts one after another, or its JSON."""
    kind = F.schema_of_variant(value)
    part = lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.when(F.schema_of_variant(p).rlike("^(OBJECT|ARRAY)"), F.to_json(p)).otherwise(F.try_variant_get(p, "$", "string")))
    parts = F.array_join(F.transform(F.try_variant_get(value, "$", "array<variant>"), part), "")
    return F.when(kind.startswith("ARRAY<"), parts).when(kind.startswith("OBJECT<"), F.coalesce(F.try_variant_get(value, "$.text", "string"), F.to_json(value))).otherwise(F.try_variant_get(value, "$", "string"))


def _turns(m: Mapping, v: Column) -> Column:
    """array<struct<conv, place, role, text>> of one record under a mapping; null if its turns aren't a list of objects."""
    get = lambda path: _said(F.try_variant_get(v, f"$.{path}", "variant"))
    row = lambda conv, place, role, text: F.struct(conv.cast("string").alias("conv"), place.cast("long").alias("place"), role.alias("role"), text.alias("text"))
    if m.place:
        return F.array(row(F.try_variant_get(v, f"$.{m.group}", "string"), F.try_variant_get(v, f"$.{m.place}", "long"), F.try_variant_get(v, f"$.{m.role}", "string"), get(m.text)))
    own = F.coalesce(F.try_variant_get(v, "$.conv_id", "string"), F.try_variant_get(v, "$.id", "string"))
    join = lambda paths: F.array_join(F.filter(F.array(*(get(p) for p in paths)), lambda x: x != ""), "\n\n")
    rows = F.array(*(row(own, F.lit(i - len(m.parts)), F.lit(role), join(paths)) for i, (role, paths) in enumerate(m.parts)))
    rows = F.filter(rows, lambda x: (x["role"] != "system") | (x["text"] != ""))
    if not m.turns:
        return rows
    items = F.try_variant_get(v, f"$.{m.turns}", "array<variant>")
    good = F.forall(items, lambda x: F.schema_of_variant(x).startswith("OBJECT<"))
    said = F.transform(items, lambda x, i: row(own, i, F.try_variant_get(x, f"$.{m.role}", "string"), _said(F.try_variant_get(x, f"$.{m.text}", "variant"))))
    return F.when(good, F.concat(rows, said))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with a column that is computed once, however often it is used: a projection would be merged into its users."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def canonical_turns(records: DataFrame, record: str, key: str | None = None, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Rows (conv_id string, place, role, text, layout, fingerprint, unmapped, record) of all records.

    A conversation's id is the mapping's own, for records of one turn each, else the record's
    ``key``, else its ``conv_id`` or ``id``. Rows of unknown layout have ``record`` and no turn;
    in others ``record`` is null and ``unmapped`` holds the field paths that weren't read.
    """
    names = F.create_map(*(F.lit(x) for pair in layouts(mappings).items() for x in pair))
    marks, single = F.array(*map(F.lit, marks_of(mappings))), [m.name for m in mappings if m.place] or [""]
    taken = records.select((F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("__key"), F.col(record).alias("record"))
    seen = _once(taken, "__value", F.try_parse_json("record"))
    seen = _once(seen, "__schema", F.schema_of_variant("__value"))
    seen = _once(seen, "__paths", field_paths(F.col("__schema")))
    known = _once(seen, "layout", F.try_element_at(names, _print(F.array_sort(F.array_intersect("__paths", marks)))))
    turns, unmapped = F.lit(None), F.col("__paths")
    for m in mappings:
        turns = F.when(F.col("layout") == m.name, _turns(m, F.col("__value"))).otherwise(turns)
        unmapped = F.when(F.col("layout") == m.name, F.array_except("__paths", F.array(*map(F.lit, sorted(m.paths()))))).otherwise(unmapped)
    found = _once(known, "__turns", turns).withColumns({"fingerprint": _print(F.col("__paths")), "unmapped": unmapped}).withColumn("layout", F.when(F.col("__turns").isNotNull(), F.col("layout")))
    # an empty list of turns is a known layout that has nothing to say
    turn = found.where("__turns is null or size(__turns) > 0").select("__key", "layout", "fingerprint", "unmapped", "record", F.explode_outer("__turns").alias("t"))
    role = F.coalesce(F.col("t.role"), F.lit(""))
    renamed = F.col("layout").isin(*(m.name for m in mappings if m.renames) or ("",))
    for old, new in ROLES.items():
        role = F.when(renamed & (F.lower(F.col("t.role")) == old), F.lit(new)).otherwise(role)
    unnamed = F.concat(F.lit("sha256:"), F.sha2("record", 256))
    conv = F.when(F.col("layout").isNull(), F.col("__key")).when(F.col("layout").isin(*single), F.coalesce("t.conv", "__key")).otherwise(F.coalesce("__key", "t.conv", unnamed))
    return turn.select(conv.alias("conv_id"), F.col("t.place").alias("place"), role.alias("role"), F.coalesce("t.text", F.lit("")).alias("text"), "layout", "fingerprint", "unmapped", F.when(F.col("layout").isNull(), F.col("record")).alias("record"))


def unknown_records(turns: DataFrame) -> DataFrame:
    """(key, fingerprint, record) of what ``canonical_turns`` found no layout for."""
    return turns.where("layout is null").select(F.col("conv_id").alias("key"), "fingerprint", "record")


_TAILS = {head: "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == head) for head in "<["}


def escape(text: Column) -> Column:
    """Doubles backslashes and sets one after the first character of each control string, which no longer is one."""
    text = F.regexp_replace(text, r"\\", r"\\\\")
    for head, tails in _TAILS.items():
        text = F.regexp_replace(text, rf"\{head}(?={tails})" if head == "[" else rf"{head}(?={tails})", rf"{head}\\")
    return text


def unescape(text: Column) -> Column:
    """The inverse: of two backslashes one goes, a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row for each conv_id: ``formatted`` and ``loss_mask``, the spans [start, end) of texts of role ``learn``.

    Places within the string are running sums over the conversation's turns, which need one
    sort by (conv_id, place) and no growing buffer; the string itself is the one value that
    holds a conversation whole. Rows of unknown layout are no turns.
    """
    turns = turns.where("layout is not null") if "layout" in turns.columns else turns
    w = W.partitionBy("conv_id").orderBy("place", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    piece = turns.select("conv_id", "place", "role", "text", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SEP)).alias("head"), escape(F.col("text")).alias("body"))
    upto = F.sum(F.length("head") + F.length("body") + len(END)).over(w)
    placed = piece.select("conv_id", F.row_number().over(w).alias("n"), "role", F.concat("head", "body", F.lit(END)).alias("piece"), F.length("body").alias("size"), upto.alias("upto"))
    stop = F.col("upto") - len(END)
    span = F.when(F.col("role") == learn, F.struct((stop - F.col("size")).alias("start"), stop.alias("end")))
    rows = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "piece"))).alias("p"), F.sort_array(F.collect_list(span)).alias("loss_mask"))
    return rows.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), "loss_mask")


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from a formatted string alone."""
    pieces = F.slice(F.split(formatted, re.escape(TURN)), F.lit(2), F.greatest(F.size(F.split(formatted, re.escape(TURN))) - 1, F.lit(0)))
    return F.transform(pieces, lambda p: F.struct(unescape(F.substring_index(p, SEP, 1)).alias("role"), unescape(F.left(F.substring_index(p, SEP, -1), F.length(F.substring_index(p, SEP, -1)) - len(END))).alias("text")))


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss_mask, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
