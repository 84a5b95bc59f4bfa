"""Secret scans by an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text (null: empty).
Only pairs of blob and rule version that the ledger doesn't hold are scanned, each once
however many paths carry the blob, and findings are joined back to all of them. ``Ledger``
holds what was scanned in a folder that all executors share, so that later versions and
other runs go on from there; a delivery that is repeated adds nothing. One writer at a time.

Empty texts have a blob and no findings; equal rows each get their blob's findings; null
keys are kept as keys; an empty table gives an empty result; columns besides key and text
are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.batches import map_batches
from millrace.llm.scratch import shared_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` is shorter than ``least`` are dropped."""

    kind: str
    pattern: str
    group: int
    least: int
    any_case: bool = False
    #: Lower-cased texts without any of these can't match.
    needs: tuple[str, ...] = ()
    base: bool = True


RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True, ("passw", "secret", "token", "api")),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, False, ("akia",)),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 26, False, ("eyj",), False),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, False, ("-----begin",), False),
)
FINDINGS = "blob string, rule_version string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def scanner(rules: tuple[Rule, ...] = RULES) -> Callable[[str], list[tuple[int, int, int]]]:
    """A function from a text to its spans as (start, rule's place, end), ascending, in code points.

    ``[0-9a-f]+`` of 16 or more is written with that bound: runs are maximal either way.
    """
    made = [(k, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)), r) for k, r in enumerate(rules)]

    def scan(text: str) -> list[tuple[int, int, int]]:
        found, low = [], text.lower()
        for k, pattern, rule in made:
            if rule.needs and not any(x in low for x in rule.needs):
                continue
            for m in pattern.finditer(text):
                a, b = m.span(rule.group)
                if b - a >= rule.least:
                    found.append((m.start(), k, m.end()))
        return sorted(found)

    return scan


def joined(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...], base_only: bool = False) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans if rules[k].base or not base_only)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row of findings for each row (blob, text)."""
    version = rule_version(rules)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        scan, place = scanner(rules), {r.kind: k for k, r in enumerate(rules)}

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            spans = [scan(t or "") for t in batch.column("text").to_pylist()]
            count = {kind: [sum(k == place.get(kind, -1) for _, k, _ in s) for s in spans] for kind in ("assign", "access", "hex")}
            base = [hashlib.sha256(joined(s, rules, True).encode()).hexdigest() for s in spans]
            columns = [batch.column("blob"), pa.array([version] * len(spans)), *(pa.array(count[k], pa.int64()) for k in count), pa.array(base), pa.array([joined(s, rules) for s in spans])]
            return pa.RecordBatch.from_arrays(columns, names=["blob", "rule_version", *(f"n_{k}" for k in count), "base_sha256", "spans"])

        return work

    return map_batches(blobs, make, FINDINGS)


def unseen_findings(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that the ledger lacks for these versions: each new blob scanned once.

    Copies fall together before the shuffle (a partial aggregation by blob), so a blob that
    a third of all rows carry is sent once by each task.
    """
    blobs = versions.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select(F.sha2("text", 256).alias("blob"), "text").dropDuplicates(["blob"])
    if ledger is not None:
        blobs = blobs.join(ledger.where(F.col("rule_version") == rule_version(rules)).select("blob"), "blob", "left_anti")
    return scan_blobs(blobs, rules)


def scan_paths(versions: DataFrame, key: str, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Findings of every version of every path: the key, the blob and the blob's findings.

    The join by blob is a plain equi-join, whose hot blobs adaptive execution splits.
    """
    found = unseen_findings(versions, ledger, rules, text)
    if ledger is not None:
        found = found.unionByName(ledger.where(F.col("rule_version") == rule_version(rules)))
    return _told(versions, key, found, text)


def _told(versions: DataFrame, key: str, found: DataFrame, text: str) -> DataFrame:
    paths = versions.select(F.col(key), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
    return paths.join(found, "blob").select(key, "blob", *[x.split()[0] for x in FINDINGS.split(", ")[2:]])


class Ledger:
    """The findings of all blobs scanned so far, by rule version, stored in a folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        """``folder`` may hold a ledger already; without one a new ledger begins in the shared folder."""
        self.spark, self.folder = spark, folder or f"{shared_folder(spark)}/secret-ledger-{uuid.uuid4().hex}"
        spark.createDataFrame([], FINDINGS).write.mode("append").parquet(self.folder)

    def rows(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        return self.spark.read.schema(FINDINGS).parquet(self.folder).where(F.col("rule_version") == rule_version(rules))

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
        """Scans what the ledger lacks for these versions and stores the findings, those of nothing included."""
        unseen_findings(versions, self.rows(rules), rules, text).write.mode("append").parquet(self.folder)

    def findings(self, versions: DataFrame, key: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
        """The key, the blob and the blob's findings for each row; all blobs have to be in the ledger."""
        return _told(versions, key, self.rows(rules), text)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]", ledger: Ledger | None = None) -> DataFrame:
    """The documents with every found span replaced by ``mark`` and ``n_chars`` renewed; all else is kept.

    Spans that overlap are replaced as one. Documents without findings keep their text, null included.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.update(docs, rules)
    found = ledger.rows(rules).where("spans <> ''").select("blob", "spans")
    columns = docs.columns
    keyed = docs.withColumn("__blob", F.sha2(F.coalesce("text", F.lit("")), 256)).join(found.select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")), "__blob", "left")
    # spans are ordered by start: keep the text between them, one mark for each overlapping run
    start = lambda s: F.split_part(s, F.lit(":"), F.lit(2)).cast("int")
    end = lambda s: F.split_part(s, F.lit(":"), F.lit(3)).cast("int")
    nothing = F.struct(F.lit("").alias("kept"), F.lit(0).alias("upto"))
    step = lambda acc, s: F.struct(
        F.when(start(s) >= acc["upto"], F.concat(acc["kept"], F.substr("text", acc["upto"] + 1, start(s) - acc["upto"]), F.lit(mark))).otherwise(acc["kept"]).alias("kept"),
        F.greatest(acc["upto"], end(s)).alias("upto"),
    )
    clean = F.aggregate(F.split("__spans", ","), nothing, step, lambda acc: F.concat(acc["kept"], F.substr("text", acc["upto"] + 1, F.length("text"))))
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(clean)
    changed = keyed.withColumn("text", text)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return changed.select(*columns)
