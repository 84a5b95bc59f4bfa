"""Sequential rules along groups: against plain loops, and over one group that is far larger than a batch."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import assessment, replay


def test_reserved_against_a_loop(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["a", "b", None]), rng.randrange(20), rng.choice([None, 0.5, 1.25, 3.1, -1.0]), rng.choice([None, 0.1, 2.0, 0.000001])) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, at int, r double, v double")
    got = {r.id: (r.spent, r.sent) for r in replay.reserved(df, ["g"], ["at", "id"], F.col("r"), F.col("v"), 9.5).collect()}
    want, spent = {}, {}
    for k, g, _, r, v in sorted(rows, key=lambda x: (str(x[1]), x[2], x[0])):
        before = spent.get(g, 0)
        sent = before + round((r or 0) * 1e6) <= 9_500_000
        want[k] = (before / 1e6, sent)
        spent[g] = before + (round((v or 0) * 1e6) if sent else 0)
    assert got == want and {s for _, s in want.values()} == {True, False}


def test_reserved_over_one_long_group(spark):
    """Two million requests of one run: the state is one number, and rows pass in batches."""
    df = spark.range(2_000_000).select("id", F.lit("one").alias("g"))
    got = replay.reserved(df, ["g"], ["id"], F.lit(2), F.lit(1), 1_000_000).agg(F.count_if("sent").alias("n"), F.max("spent").alias("s"), F.min(F.when(~F.col("sent"), F.col("id"))).alias("first")).first()
    assert (got.n, got.s, got.first) == (999_999, 999_999.0, 999_999)


def shortlist(rows, missing, initial, most, step, reserve):
    """A queue from which the next found row is moved up while reserved places are open."""
    queue, out, used, good, places = sorted(rows, key=lambda r: r["rank"]), {}, 0, 0, 0
    room = min(initial, most)
    while queue and used < most and good < missing:
        stop = used + min(room, most - used)
        while queue and used < stop:
            at = next((k for k, r in enumerate(queue) if r["found"]), 0) if places < min(reserve, most) else 0
            row = queue.pop(at)
            if row["duplicate"]:
                out[row["id"]] = ("duplicate URL", None)
                continue
            used += 1
            places += row["found"] and places < min(reserve, most)
            verdict = row["verdict"]
            out[row["id"]] = ("enrichment failed" if verdict is None else "qualified" if verdict >= 4 else "relevance too low", used)
            good += verdict is not None and verdict >= 4
        room = step
    rest = "shortlist ceiling" if used >= most else "shortlist deferred"
    return out | {r["id"]: (rest, None) for r in queue}


@pytest.mark.parametrize("seed", range(3))
def test_adaptive_against_a_queue(spark, seed):
    rng = random.Random(seed)
    regions = {f"r{k}": (rng.randrange(5), rng.randrange(12)) for k in range(25)} | {None: (2, 6)}
    rows = [{"id": n, "region": g, "rank": rng.random(), "found": rng.random() < 0.2, "duplicate": rng.random() < 0.25, "verdict": rng.choice([None, 2, 3, 4, 5])} for n, g in enumerate(g for g in regions for _ in range(rng.randrange(25)))]
    df = spark.createDataFrame([(r["id"], r["region"], r["rank"], r["found"], r["duplicate"], r["verdict"], *regions[r["region"]]) for r in rows], "id int, region string, rank double, found boolean, duplicate boolean, verdict int, missing int, most int")
    c = F.col
    got = {r.id: (r.outcome, r.attempt) for r in assessment.adaptive(df, "region", [c("rank")], c("found"), c("duplicate"), c("verdict"), F.lit(4), c("missing"), c("most"), 3, 2, 2).collect()}
    want = {}
    for g, (missing, most) in regions.items():
        want |= shortlist([r for r in rows if r["region"] == g], missing, 3, most, 2, 2)
    assert got == want
