"""Evaluation of recorded runs: screens replayed, budgets estimated, cohorts and repeats compared, labels joined, reports written."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import ranges, rollups
from millrace.plans.lineage import cut


def replayed(pool: DataFrame, screens: dict[str, Column], select: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``select`` makes of the rows that each screen keeps, with the screen's name; the pool is stored once."""
    kept = cut(pool)
    return reduce(DataFrame.unionByName, [select(kept.where(F.coalesce(c, F.lit(False)))).withColumn("screen", F.lit(name)) for name, c in screens.items()])


def shortages(told: DataFrame, targets: dict[str, int], by: str = "screen") -> DataFrame:
    """(by, region, target, selected, missing) of winners, for every target region."""
    won = told.where("pick is not null").groupBy(by).agg(*(F.count_if(F.col("region") == r).alias(f"__{k}") for k, r in enumerate(targets)))
    rows = told.select(by).distinct().join(won, by, "left")
    each = F.array(*(F.struct(F.lit(r).alias("region"), F.lit(n).cast("long").alias("target"), F.coalesce(F.col(f"__{k}"), F.lit(0)).alias("selected")) for k, (r, n) in enumerate(targets.items())))
    return rows.select(by, F.inline(each)).withColumn("missing", F.greatest(F.lit(0).cast("long"), F.col("target") - F.col("selected")))


def retained_union(parts: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, experiments): every id that any experiment keeps, and which do."""
    named = [rows.select(key).distinct().withColumn("__e", F.lit(name)) for name, rows in parts.items()]
    return reduce(DataFrame.unionByName, named).groupBy(key).agg(F.array_sort(F.collect_set("__e")).alias("experiments"))


def budget_estimate(rows: DataFrame, size: Column, batch: int, prices: DataFrame, output: int) -> DataFrame:
    """(model, requests, input_tokens, output_tokens, cost): what a classification of all rows would take, by each model's prices per million."""
    need = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.ceil(size / 4)), F.lit(0)).alias("input_tokens"))
    told = need.select(F.ceil(F.col("n") / batch).alias("requests"), "input_tokens", (F.col("n") * output).alias("output_tokens"), F.lit(1).alias("__one"))
    cost = (F.col("input_tokens") * F.col("input_price").cast("decimal(12,6)") + F.col("output_tokens") * F.col("output_price").cast("decimal(12,6)")) / F.lit(1_000_000)
    return prices.withColumn("__one", F.lit(1)).join(F.broadcast(told), "__one").select("model", "requests", "input_tokens", "output_tokens", F.round(cost, 4).cast("double").alias("cost"))  # one row is sent


class _Ledger(ranges.Machine):
    """What a run has spent, in millionths."""

    def __init__(self, cap: int):
        self.cap, self.spent = cap, 0

    def step(self, reserve: int, actual: int) -> tuple[int, bool]:
        before, fits = self.spent, self.spent + reserve <= self.cap
        if fits:
            self.spent += actual
        return before, fits


def reserved(rows: DataFrame, by: list[str], order: list[str], reserve: Column, actual: Column, cap: float) -> DataFrame:
    """``rows`` with ``spent`` before each and ``sent``: a request goes out if what was spent and its reserve stay under the cap.

    As in the ledger, what was refused costs nothing, so the decisions are sequential: each
    group is folded in order, whatever its length. Amounts count in millionths; null ones are 0.
    """
    millionths = lambda c: F.coalesce((c.cast("decimal(18,6)") * 1_000_000).cast("long"), F.lit(0).cast("long"))
    limit = round(cap * 1_000_000)
    told = ranges.folded(rows, by, [F.col(c) for c in order], {"reserve": millionths(reserve), "actual": millionths(actual)}, partial(_Ledger, limit), "__spent long, __sent boolean")
    return told.select(*rows.columns, (F.col("__spent") / F.lit(1_000_000)).alias("spent"), F.col("__sent").alias("sent"))


def cohort_metrics(rows: DataFrame, cohort: str, predicted: Column, actual: Column) -> DataFrame:
    return rollups.binary_metrics(rows, predicted, actual, [cohort])


def consistency(repeats: DataFrame, key: str, decision: str) -> DataFrame:
    """One row: ids, those whose repeats all decide alike, and their share; a missing decision is one of its own."""
    per = repeats.groupBy(key).agg(F.count_distinct(F.coalesce(decision, F.lit("none"))).alias("kinds"))
    return per.agg(F.count("*").alias("ids"), F.count_if(F.col("kinds") == 1).alias("alike")).withColumn("share", F.round(F.try_divide("alike", "ids"), 6))


def labelled_union(parts: dict[str, DataFrame], key: str, label: str) -> DataFrame:
    """(key, label, origin, conflict): labels of several sets, the first listed set deciding, and whether any two differ."""
    named = [rows.select(key, label, F.lit(name).alias("origin"), F.lit(k).alias("__k")) for k, (name, rows) in enumerate(parts.items())]
    every = reduce(DataFrame.unionByName, named).where(F.col(label).isNotNull())
    first = F.min_by(F.struct(label, "origin"), F.struct("__k", label))
    return every.groupBy(key).agg(first.alias("f"), (F.count_distinct(label) > 1).alias("conflict")).select(key, f"f.{label}", "f.origin", "conflict")


def reject_histogram(rows: DataFrame, by: list[str], checks: list[tuple[Column, str]]) -> DataFrame:
    """(by, reason, n): how many rows each first failing check rejects, and how many pass as accepted."""
    reason = reduce(lambda rest, c: F.when(c[0], F.lit(c[1])).otherwise(rest), reversed(checks), F.lit("accepted"))
    return rows.groupBy(*by, reason.alias("reason")).agg(F.count("*").alias("n"))


def markdown_cell(value: Column) -> Column:
    """A value as a table's cell: one line, bars escaped."""
    return F.replace(F.regexp_replace(F.coalesce(value.cast("string"), F.lit("")), r"\s+", " "), F.lit("|"), F.lit("\\|"))


def markdown_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(line): each row as a line of a Markdown table."""
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *(markdown_cell(F.col(c)) for c in columns)), F.lit(" |")).alias("line"))


def markdown_report(summary: DataFrame, columns: list[str], title: str) -> str:
    """A small aggregate as a Markdown section; its rows come to the driver, as those of a report do."""
    lines = [r["line"] for r in markdown_rows(summary, columns).collect()]
    return "\n".join([f"## {title}", "", "| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *sorted(lines), ""])


def written(rows: DataFrame, by: list[str], order: list[str], text: str, write: Callable[[str], str], head: str = "") -> DataFrame:
    """(by, draft): a text for each group, written from its rows' texts in order by a function from outside.

    A group is what one draft tells of, a handful of rows; the function runs where the group is.
    """
    told = rows.groupBy(*by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, text))), lambda x: x[text]), "\n\n").alias("__told"))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", draft string"

    def run(frames):
        for frame in frames:
            frame["draft"] = [write(head + t) for t in frame["__told"]]
            yield frame[[*by, "draft"]]

    return told.mapInPandas(run, schema)
