"""Assessment by an outside model: batches, replies, and budgeted consumption."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import partial, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranges import running
from millrace.operators import ranges
from millrace.plans.lineage import cut


def batches(rows: DataFrame, by: list[str], order: str, size: Column, most: int = 100) -> DataFrame:
    """``rows`` with ``batch``, ``most`` rows each, and ``bytes``, the running size in the group; groups may be of any size."""
    placed = running(rows, by, [order], {"__place": F.lit(1).cast("long"), "bytes": size.cast("long")})
    return placed.withColumn("batch", F.floor((F.col("__place") - 1) / most).cast("int")).drop("__place")


def valid_object(reply: Column, checks: dict[str, Column]) -> Column:
    """A JSON object with exactly these keys, each passing its check."""
    exact = F.array_sort(F.json_object_keys(reply)).eqNullSafe(F.array(*map(F.lit, sorted(checks))))
    good = F.lit(True)
    for check in checks.values():
        good = good & F.coalesce(check, F.lit(False))
    return exact & good


def whole_batches(replies: DataFrame, batch: str, key: str, valid: Column, asked: DataFrame) -> DataFrame:
    """(batch, accepted): all replies valid, each id once, and as many as were asked for."""
    got = replies.groupBy(batch).agg(F.bool_and(valid).alias("ok"), F.count("*").alias("n"), F.count_distinct(key).alias("ids"))
    return asked.join(got, batch, "left").select(batch, F.coalesce(F.col("ok") & (F.col("n") == F.col("ids")) & (F.col("n") == F.col("asked")), F.lit(False)).alias("accepted"))


Model = Callable[[list[dict]], list[dict]]


def classify(items: list[dict], model: Model, most_bytes: int, attempts: int = 2, latch: list[str] | None = None) -> list[dict]:
    """One outcome for each item: the verdict or an error.

    A group that is too large, or whose replies stay malformed, is halved; a single item that
    fails is an error of its own, so what is bad never costs its neighbours their verdicts.
    A ``PermissionError`` of the model ends all further calls and leaves its text in ``latch``.
    """
    done: dict[str, dict] = {}
    latch = [] if latch is None else latch

    def run(group: list[dict]) -> None:
        if latch or not group:
            return
        fits = len(json.dumps(group).encode()) <= most_bytes
        error = "request too large"
        for _ in range(attempts if fits else 0):
            try:
                replies = model(group)
            except PermissionError as e:
                latch.append(str(e))
                return
            except Exception as e:  # noqa: BLE001  any other failure of a call is an outcome
                error = f"call failed: {e}"
                continue
            if sorted(r.get("id") for r in replies) == sorted(i["id"] for i in group):
                done.update({r["id"]: {"id": r["id"], "decision": r.get("decision"), "error": None} for r in replies})
                return
            error = "malformed reply"
        if len(group) == 1:
            done[group[0]["id"]] = {"id": group[0]["id"], "decision": None, "error": error}
        else:
            run(group[: len(group) // 2])
            run(group[len(group) // 2 :])

    run(sorted(items, key=lambda i: i["id"]))
    return [done.get(i["id"], {"id": i["id"], "decision": None, "error": latch[0] if latch else "not sent"}) for i in items]


REFUSED = "refused: "


def _classify_frames(frames: Iterator[pd.DataFrame], model: Model, most_bytes: int, size: int) -> Iterator[pd.DataFrame]:
    latch: list[str] = []
    for frame in frames:
        for k in range(0, len(frame), size):
            told = classify(frame.iloc[k : k + size].to_dict("records"), model, most_bytes, latch=latch)
            unasked = lambda t: t["decision"] is None and latch and t["error"] == latch[0]
            yield pd.DataFrame([t | {"error": REFUSED + t["error"]} if unasked(t) else t for t in told], columns=["id", "decision", "error"])


def classified(rows: DataFrame, fields: list[str], model: Model, most_bytes: int = 200_000, size: int = 100, rounds: int = 4) -> DataFrame:
    """(id, decision, error) for each row of (id string, *fields), stored; ``model`` maps items to replies.

    Calls are made in rounds over a hash of the id. A refusal ends all further calls of its
    task at once and of the whole run after its round; what wasn't asked has the refusal as its
    error. Each round is stored, so no call is made twice.
    """
    schema = "id string, decision string, error string"
    asked = rows.select("id", *fields).withColumn("__round", F.pmod(F.xxhash64("id"), F.lit(rounds)))
    done, refused = [], None
    for k in range(rounds):
        part = asked.where(F.col("__round") == k).drop("__round")
        if refused is not None:
            done.append(part.select("id", F.lit(None).cast("string").alias("decision"), F.lit(refused).alias("error")))
            continue
        told = cut(part.sortWithinPartitions("id").mapInPandas(partial(_classify_frames, model=model, most_bytes=most_bytes, size=size), schema))
        stopped = told.where(F.col("error").startswith(REFUSED)).limit(1).collect()
        refused = stopped[0]["error"] if stopped else None
        done.append(told)
    return reduce(DataFrame.unionByName, done)


def consume(rows: list[dict], missing: int, initial: int, most: int, step: int = 2, reserve: int = 2) -> list[dict]:
    """A region's ranked rows with ``outcome``: who is assessed before its budget or its need is met.

    Up to ``reserve`` found rows go first. Batches are ``initial`` rows, then ``step`` each. A
    duplicate costs nothing, a failure costs its place; after each batch it ends if enough qualified.
    """
    found = [r for r in rows if r.get("found")][: min(reserve, most)]
    queue = found + [r for r in rows if r not in found]
    out, used, qualified, at, room = [], 0, 0, 0, min(initial, most)
    while at < len(queue) and used < most and qualified < missing:
        stop = min(most, used + room)
        while at < len(queue) and used < stop:
            row = queue[at]
            at += 1
            if row.get("duplicate"):
                out.append(row | {"outcome": "duplicate URL"})
                continue
            used += 1
            good = row.get("verdict") is not None and row["verdict"] >= row["required"]
            out.append(row | {"outcome": "qualified" if good else "enrichment failed" if row.get("verdict") is None else f"relevance below {row['required']}"})
            qualified += good
        room = step
    rest = "shortlist ceiling" if used >= most else "shortlist deferred"
    return out + [row | {"outcome": rest} for row in queue[at:]]


class _Region(ranges.Machine):
    """One region's shortlist: batches of attempts until its need or its budget is met."""

    def __init__(self, initial: int, step: int, reserve: int):
        self.initial, self.more, self.reserve = initial, step, reserve
        self.used = self.qualified = self.places = self.early = 0
        self.room: int | None = None
        self.over = False

    def step(self, stage: int, found: bool, duplicate: bool, good: int | None, missing: int, most: int) -> tuple[str | None, int | None]:
        if self.room is None:
            self.room = min(self.initial, most)
            self.over = missing <= 0 or most <= 0
        if stage == 0 and (self.over or self.places >= min(self.reserve, most)):
            return None, None  # its turn comes by rank
        if stage == 1 and found and self.early:
            self.early -= 1  # told in its reserved place
            return None, None
        if self.over:
            return ("shortlist ceiling" if self.used >= most else "shortlist deferred"), None
        self.early += stage == 0
        if duplicate:
            return "duplicate URL", None
        self.used += 1
        self.room -= 1
        self.places += stage == 0
        self.qualified += good == 1
        if self.room == 0:
            self.over = self.qualified >= missing or self.used >= most
            self.room = min(self.more, most - self.used)
        return ("qualified" if good == 1 else "enrichment failed" if good is None else "relevance too low"), self.used


def adaptive(rows: DataFrame, region: str, rank: list[Column], found: Column, duplicate: Column, verdict: Column, required: Column, missing: Column, most: Column, initial: int = 6, step: int = 2, reserve: int = 2) -> DataFrame:
    """``rows`` with ``outcome`` and ``attempt``: who of each region is assessed before its budget or its need is met.

    Attempts come in batches, ``initial`` of them and then ``step`` each; after a batch a region
    ends if enough qualified or ``most`` attempts are used. Up to ``reserve`` attempts are kept
    for found rows, which take them before all others; a duplicate takes none, so the next found
    row moves up. A failed assessment (null ``verdict``) costs its attempt. Who isn't reached is
    behind the ceiling or deferred. ``missing`` and ``most`` are the same in all rows of a
    region; null ones are 0. Each region is one stream in order, with only its counts in memory.
    """
    truth = lambda c: F.coalesce(c, F.lit(False))
    number = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    kept = rows.withColumns({"__found": truth(found), "__stage": F.explode(F.when(truth(found), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1))))})
    good = F.when(verdict.isNotNull(), truth(verdict >= required).cast("long"))
    told = ranges.folded(kept, [region], [F.col("__stage"), *rank], {"stage": F.col("__stage").cast("long"), "found": F.col("__found"), "duplicate": truth(duplicate), "good": good, "missing": number(missing), "most": number(most)}, partial(_Region, initial, step, reserve), "outcome string, attempt long")
    return told.where(F.col("outcome").isNotNull()).drop("__found", "__stage")
