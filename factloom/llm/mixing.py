"""Mixing sources to target weights by weighted fair queueing.

Within its source each document, in shuffled order, gets the virtual finish time
(words of its source up to and with it) / (target words of the source); a second and third copy follow a whole round later.
The mix is the longest prefix of all copies, ordered by finish time, that fits the budget (the words of all documents).

Running sums never gather a source or the whole table in one task: a source's documents are cut into bins by their shuffle key, about
bin_rows in each, sums of bins are added up first, and only then rows within a bin; finish times are cut into bins likewise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS = 3
_KEY_BITS = 60
#: Cells of finish times that are added up in one group.
CELLS = 4096


def words_in(text: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def keyed(docs: DataFrame, seed: str) -> DataFrame:
    """docs with the size of each text, its source as a key that isn't null, and its shuffle key. Sizes are part of the key, so that rows without an id
    don't all have one."""
    docs = docs.withColumn("_size", words_in("text"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("#"), F.col("_size").cast("string"), F.lit(f"#{seed}"))
    return docs.withColumns({
        "_source": F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("m"), "source")),
        "_key": F.conv(F.substring(F.md5(name), 1, _KEY_BITS // 4), 16, 10).cast("long"),
    })


def targets(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """_source, _words, _rows and _target of each source; one row for each source, so a window over all of them is small.

    A target is the least of EPOCHS times the source's words and rate * weight, with one rate for all sources by which the
    targets add up to all words: what giving the excess of capped sources to the others by weight, again and again, comes to.
    """
    by = sizes.groupBy("_source").agg(F.sum("_size").alias("_words"), F.count("*").alias("_rows"))
    number = F.row_number().over(W.orderBy("_source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    by = by.withColumn("_weight", weight)
    everything = W.partitionBy()
    before = W.orderBy("_full_at", "_source").rowsBetween(W.unboundedPreceding, -1)
    by = by.withColumn("_full_at", F.lit(float(EPOCHS)) * F.col("_words") / F.col("_weight"))
    left = F.sum("_words").over(everything) - F.coalesce(F.sum(F.lit(float(EPOCHS)) * F.col("_words")).over(before), F.lit(0.0))
    among = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    by = by.withColumn("_rate", left / among)
    fits = F.min(F.when(F.col("_rate") <= F.col("_full_at"), F.struct("_full_at", "_source", "_rate"))).over(everything)["_rate"]
    target = F.least(F.lit(float(EPOCHS)) * F.col("_words"), F.coalesce(fits, F.lit(0.0)) * F.col("_weight"))
    return by.withColumn("_target", target).select("_source", "_words", "_rows", "_target")


@dataclass
class Mix:
    """The decisions: sources, sums of the bins before each, and the first copy that doesn't fit."""

    sources: DataFrame
    before: DataFrame
    cut: tuple[float, int, int] | None
    bin_rows: int

    def binned(self, rows: DataFrame) -> DataFrame:
        bins = F.ceil(F.col("_rows") / self.bin_rows)
        at = F.least(F.floor(F.col("_key") / F.lit(float(2**_KEY_BITS)) * bins), bins - 1).cast("long")
        return rows.join(self.sources, "_source").withColumn("_bin", at)

    def finished(self, rows: DataFrame) -> DataFrame:
        """rows with _upto, the words of their source up to and with them."""
        within = W.partitionBy("_source", "_bin").orderBy("_key", "doc_id", "_size").rowsBetween(W.unboundedPreceding, 0)
        rows = self.binned(rows).withColumn("_upto", F.sum("_size").over(within))
        return rows.join(self.before, ["_source", "_bin"]).withColumn("_upto", F.col("_upto") + F.col("_before")).drop("_before")

    def copies(self, rows: DataFrame) -> DataFrame:
        """finished rows with _copies, how many copies of each the mix takes."""
        taken = F.lit(0)
        for k in range(EPOCHS):
            if self.cut is None:
                taken = taken + 1
            else:
                at, key, epoch = (F.lit(v) for v in self.cut)
                f = finish(k)
                taken = taken + ((f < at) | ((f == at) & ((F.col("_key") < key) | ((F.col("_key") == key) & (F.lit(k) < epoch))))).cast("int")
        return rows.withColumn("_copies", F.when(F.col("_size") > 0, taken).otherwise(F.lit(0)))


def finish(epoch: int | Column) -> Column:
    """Virtual finish time of a row's copy; 0 for a source without words."""
    epoch = F.lit(epoch) if isinstance(epoch, int) else epoch
    return F.when(F.col("_target") > 0, (epoch * F.col("_words") + F.col("_upto")) / F.col("_target")).otherwise(F.lit(0.0))


def _over(sums: DataFrame, by: str, start: int, budget: int) -> tuple[int | None, int]:
    """The first of the sums at which they pass the budget, from a start, and what they come to before it."""
    upto = W.orderBy(by).rowsBetween(W.unboundedPreceding, 0)
    found = sums.withColumn("_upto", F.sum("_sum").over(upto) + start).where(F.col("_upto") > budget).orderBy(by).select(by, "_sum", "_upto").first()
    return (None, start) if found is None else (found[0], found[2] - found[1])


def plan(narrow: DataFrame, weights: Sequence[int], bin_rows: int) -> tuple[Mix, DataFrame]:
    """The mix of rows (doc_id, _size, _source, _key), and those rows with their finish times, written."""
    sources = written(targets(narrow, weights), "mix-sources")
    mix = Mix(sources, sources, None, bin_rows)
    sums = mix.binned(narrow).groupBy("_source", "_bin").agg(F.sum("_size").alias("_sum"))
    earlier = W.partitionBy("_source").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    mix.before = written(sums.select("_source", "_bin", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")), "mix-before")
    rows = written(mix.finished(narrow), "mix-rows")

    n, budget = rows.where("_size > 0").agg(F.count("*"), F.coalesce(F.sum("_size"), F.lit(0))).first()
    cells = max(1, EPOCHS * n // bin_rows)
    copies = rows.where("_size > 0").select("_size", "_key", "_words", "_upto", "_target", F.explode(F.sequence(F.lit(0), F.lit(EPOCHS - 1))).alias("_epoch"))
    copies = copies.withColumn("_finish", finish(F.col("_epoch")))
    spread = F.when(F.col("_finish") <= 1, F.col("_finish")).otherwise(1 + F.log("_finish"))  # no more cells, however late the last copy
    copies = copies.withColumn("_cell", F.floor(spread * cells))
    by_cell = written(copies.groupBy("_cell").agg(F.sum("_size").alias("_sum")), "mix-cells").withColumn("_group", F.floor(F.col("_cell") / CELLS))
    # The group of cells that passes the budget first, and in it the cell: no window holds more than the groups, or the cells of one.
    group, start = _over(by_cell.groupBy("_group").agg(F.sum("_sum").alias("_sum")), "_group", 0, budget)
    if group is not None:
        cell, start = _over(by_cell.where(F.col("_group") == group), "_cell", start, budget)
        line = W.orderBy("_finish", "_key", "_epoch").rowsBetween(W.unboundedPreceding, 0)
        last = copies.where(F.col("_cell") == cell).withColumn("_line", F.sum("_size").over(line))
        first = last.where(F.col("_line") + start > budget).orderBy("_finish", "_key", "_epoch").select("_finish", "_key", "_epoch").first()
        mix.cut = tuple(first)
    return mix, rows


def source_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), seed: str = "mix", bin_rows: int = 20_000) -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target and taken (words the mix takes of it).

    A null text has no words and is never taken; a null source is a source of its own, the last; a null doc_id is an id like another.
    Rows of one doc_id and size follow each other in the shuffle; equal rows are interchangeable. A text of any length counts whole. A source without words has
    target 0. An empty table gives an empty result. Other columns are ignored. Reruns give the same result.
    """
    narrow = written(keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), seed).select("doc_id", "_size", "_source", "_key"), "mix-sizes")
    mix, rows = plan(narrow, weights, bin_rows)
    return mix.copies(rows).select(
        "doc_id", F.col("_size").alias("size"), F.col("_words").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), seed: str = "mix", bin_rows: int = 20_000) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, range-sorted by finish time, with columns copy (from 0) and
    finish. Columns of docs with those names are replaced. Cases are as in source_mix; rows that aren't taken are left out."""
    names = [c for c in docs.columns if c not in ("copy", "finish")]
    rows = keyed(docs.select(*names), seed)
    narrow = written(rows.select("doc_id", "_size", "_source", "_key"), "mix-sizes")
    mix, _ = plan(narrow, weights, bin_rows)
    out = mix.copies(mix.finished(rows)).where("_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    out = out.withColumn("finish", finish(F.col("copy")))
    return out.orderBy("finish", "_key", "copy").select(*names, "copy", "finish")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '#' || size || '#mix'), 1, 15) AS BIGINT) AS k
  FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS words,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS weight
  FROM sized GROUP BY source),
rates AS (
  SELECT *, 3.0::DOUBLE * words / weight AS full_at,
         (sum(words) OVER () - coalesce(sum(3.0::DOUBLE * words) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS rate
  FROM by_source
  WINDOW before AS (ORDER BY 3.0::DOUBLE * words / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (SELECT rate FROM rates WHERE rate <= full_at ORDER BY full_at, source NULLS LAST LIMIT 1),
target AS (SELECT source, words, least(3.0::DOUBLE * words, coalesce((SELECT rate FROM rate), 0) * weight) AS target FROM rates),
summed AS (
  SELECT *, row_number() OVER () AS r, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM sized),
copies AS (
  SELECT s.r, s.size, s.k, e, (e * t.words + s.upto) / t.target AS finish
  FROM summed s JOIN target t ON s.source IS NOT DISTINCT FROM t.source CROSS JOIN (SELECT unnest([0, 1, 2]) AS e) WHERE s.size > 0),
lined AS (SELECT *, sum(size) OVER (ORDER BY finish, k, e ROWS UNBOUNDED PRECEDING) AS line FROM copies),
taken AS (SELECT r, sum(size) AS taken FROM lined WHERE line <= (SELECT sum(size) FROM sized) GROUP BY r)
SELECT s.doc_id, s.size, CAST(t.words AS BIGINT) AS source_size, t.target, CAST(coalesce(x.taken, 0) AS BIGINT) AS taken
FROM summed s JOIN target t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN taken x USING (r)
"""
