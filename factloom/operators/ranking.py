"""Rankings of terms: TF-IDF, popularity and their combination.

A document's terms are counted where it is read, by parts of Arrow batches of tokens, and parts pass on sums by term: what is shuffled are terms with
sums, not documents' terms. A document is a row.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.functions import batches
from factloom.functions.text import tokens
from factloom.session import shared_path, written

#: So many terms with their weights a task holds at most: the most frequent ones. Documents' other terms meet their weights in a shuffle.
HELD_TERMS = 400_000


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    return batches.parts(column, pc.list_value_length(column), batches.TOKENS)


def _counted(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of two characters or more in a batch of token lists, and for each row and term of it: row, number of the term, count."""
    flat = column.flatten()
    rows = np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    keep = pc.greater_equal(pc.utf8_length(flat), 2)
    rows, code = rows[keep.to_numpy(zero_copy_only=False)], pc.dictionary_encode(flat.filter(keep))
    key, n = np.unique(rows * max(1, len(code.dictionary)) + code.indices.to_numpy(zero_copy_only=False), return_counts=True)
    return code.dictionary, key // max(1, len(code.dictionary)), key % max(1, len(code.dictionary)), n


def _term_sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (p for batch in rows for p in _parts(batch.column(0))):
        terms, _, code, n = _counted(part)
        if len(terms):
            yield pa.RecordBatch.from_pydict({"term": terms, "df": pa.array(np.bincount(code, minlength=len(terms))), "n": pa.array(np.bincount(code, n, len(terms)).astype(np.int64))})


def term_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """term, df and n: documents that hold it and how often it comes; lower-case terms of two characters or more."""
    each = docs.select(tokens(text, lower=True).alias("t")).mapInArrow(_term_sums, "term string, df long, n long")
    return each.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


def _weights(path: str) -> tuple[pa.Array, np.ndarray]:
    fs, at = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with fs.open_input_stream(at, compression=None) as f:
        return pickle.loads(f.read())  # noqa: S301 - written by _hold


def _hold(docs: DataFrame, table: pa.Table) -> str:
    """A file of terms and their documents in the shared folder."""
    path = shared_path(docs.sparkSession, "terms")
    fs, at = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(at, compression=None) as f:
        f.write(pickle.dumps((table["term"].combine_chunks(), table["df"].to_numpy()), protocol=5))
    return path


def _scored(path: str, n: int):  # noqa: ANN202
    """Sums of scores by term, where all terms are held."""

    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = _weights(path)
        for part in (p for batch in rows for p in _parts(batch.column(0))):
            terms, row, code, tf = _counted(part)
            if not len(terms):
                continue
            place = pc.index_in(terms, value_set=known).to_numpy(zero_copy_only=False)
            raw = tf * (np.log((1 + n) / (1 + df[place]))[code] + 1)
            score = raw / np.sqrt(np.bincount(row, raw * raw))[row]
            k = len(terms)
            yield pa.RecordBatch.from_pydict({"term": terms, "df": pa.array(np.bincount(code, minlength=k)), "n": pa.array(np.bincount(code, tf, k).astype(np.int64)), "s": pa.array(np.bincount(code, score, k)), "q": pa.array(np.bincount(code, score * score, k))})

    return scored


PACKED = "doc long, held double, terms array<string>, tf array<int>, rare array<struct<term:string,tf:int>>"


def _packed(path: str, n: int):  # noqa: ANN202
    """Documents as their terms and counts, with the squared weights of held terms added up and the other terms apart."""

    def lists(rows: np.ndarray, size: int, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=size))]).astype(np.int32)), values)

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = _weights(path)
        for batch in rows:
            at = 0
            for part in _parts(batch.column(1)):
                doc, k = batch.column(0).slice(at, len(part)), len(part)
                at += k
                terms, row, code, tf = _counted(part)
                place = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False)
                weight = np.zeros(len(terms))
                weight[place >= 0] = np.log((1 + n) / (1 + df[place[place >= 0]])) + 1
                words, counts = terms.take(pa.array(code)), pa.array(tf.astype(np.int32))
                rare = np.flatnonzero(place[code] < 0)
                apart = pa.StructArray.from_arrays([words.take(pa.array(rare)), counts.take(pa.array(rare))], ["term", "tf"])
                held = np.bincount(row, (tf * weight[code]) ** 2, k)
                yield pa.RecordBatch.from_pydict({"doc": doc, "held": pa.array(held), "terms": lists(row, k, words), "tf": lists(row, k, counts), "rare": lists(row[rare], k, apart)})

    return packed


def _shared_out(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by term of counts over their document's norm, from rows (norm, terms, tf)."""
    for batch in rows:
        at = 0
        for part in _parts(batch.column(1)):
            size = pc.list_value_length(part).to_numpy(zero_copy_only=False)
            norm = np.repeat(batch.column(0).slice(at, len(part)).to_numpy(zero_copy_only=False), size)
            tf = batch.column(2).slice(at, len(part)).flatten().to_numpy(zero_copy_only=False)
            at += len(part)
            coded = pc.dictionary_encode(part.flatten())
            code, k, w = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary), tf / norm
            if k:
                yield pa.RecordBatch.from_pydict({"term": coded.dictionary, "df": pa.array(np.bincount(code, minlength=k)), "n": pa.array(np.bincount(code, tf, k).astype(np.int64)), "s": pa.array(np.bincount(code, w, k)), "q": pa.array(np.bincount(code, w * w, k))})


def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, term, tf of lower-case terms of two characters or more."""

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for part in _parts(batch.column(1)):
                terms, row, code, n = _counted(part)
                yield pa.RecordBatch.from_pydict({"doc": batch.column(0).take(pa.array(at + row)), "term": terms.take(pa.array(code)), "tf": pa.array(n)})
                at += len(part)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc"), tokens(text, lower=True).alias("t")).mapInArrow(counted, f"doc {kind}, term string, tf long")


def tfidf(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, term, tf, n, score: tf * (ln((1 + n) / (1 + df)) + 1), each document's scores of length 1. n counts all documents; doc is unique."""
    tf = term_counts(docs, key, text)
    df = term_stats(docs, text).select("term", "df")
    n = docs.agg(F.count(F.lit(1)).alias("n"))  # one row
    raw = tf.join(df, "term").crossJoin(F.broadcast(n)).withColumn("raw", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("doc")))  # a window, so that raw isn't worked out twice
    return raw.select("doc", "term", "tf", "n", (F.col("raw") / norm).alias("score"))


def _frequent(stats: DataFrame, held: int) -> DataFrame:
    """The most frequent terms of stats, at most `held`: all from a number of documents on, by eighths of its logarithm to base 2."""
    level = F.floor(F.log2("df") * 8)
    least, total = None, 0
    for r in stats.groupBy(level.alias("level")).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect():
        total += r.k
        if total > held:
            break
        least = r.level
    return stats.where(level >= least if least is not None else F.lit(False))


def _sums(docs: DataFrame, held: int) -> tuple[DataFrame, int, DataFrame]:
    """term, df, n, s and q: documents with it, how often it comes, sums of its scores and of their squares; the number of documents; and term_stats.

    A score is tf * weight / norm. Where more than `held` terms are there, documents are written as terms and counts. Of a norm the frequent terms' part is known where the
    document is read, and only its rare terms are shuffled: to count their documents, and back to the document. Then documents meet their norms, and sum up tf / norm by term.
    """
    n = docs.count()
    stats = written(term_stats(docs), "stats")
    low = tokens("text", lower=True).alias("t")
    if stats.count() <= held:
        each = docs.select(low).mapInArrow(_scored(_hold(docs, stats.select("term", "df").toArrow()), n), "term string, df long, n long, s double, q double")
        return each.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")), n, stats
    path = _hold(docs, _frequent(stats, held).select("term", "df").toArrow())
    packed = written(docs.select(F.monotonically_increasing_id().alias("doc"), low).mapInArrow(_packed(path, n), PACKED), "packed")
    weight = F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1
    rare = packed.select("doc", F.inline("rare")).withColumn("df", F.count("*").over(W.partitionBy("term"))).select("doc", ((F.col("tf") * weight) * (F.col("tf") * weight)).alias("held"))
    norms = packed.select("doc", "held").unionByName(rare).groupBy("doc").agg(F.sqrt(F.sum("held")).alias("norm"))
    met = packed.select("doc", "terms", "tf").where(F.size("terms") > 0).join(norms.hint("shuffle_hash"), "doc").select("norm", "terms", "tf")
    each = met.mapInArrow(_shared_out, "term string, df long, n long, s double, q double")
    by = each.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    return by.select("term", "df", "n", (F.col("s") * weight).alias("s"), (F.col("q") * weight * weight).alias("q")), n, stats


def tfidf_rank(docs: DataFrame, least: int = 1, held: int = HELD_TERMS) -> DataFrame:
    """term, df, avg_score (over documents with the term) and sd_score (population, over all documents with zeros)."""
    return _ranked(docs, held)[0].where(F.col("df") >= least).drop("n")


def _ranked(docs: DataFrame, held: int) -> tuple[DataFrame, DataFrame]:
    by, n, stats = _sums(docs, held)
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("q") / n - (F.col("s") / n) * (F.col("s") / n)))
    return by.select("term", "df", "n", (F.col("s") / F.col("df")).alias("avg_score"), sd.alias("sd_score")), stats


def popularity(docs: DataFrame, least: int = 1) -> DataFrame:
    """term, n and n over the largest n."""
    by = written(term_stats(docs).select("term", "n"), "stats")
    top = by.agg(F.max("n").alias("top"))
    return by.where(F.col("n") >= least).crossJoin(F.broadcast(top)).select("term", "n", (F.col("n") / F.col("top")).alias("popularity"))


def harmonic(docs: DataFrame, least: int = 1, held: int = HELD_TERMS) -> DataFrame:
    """term with its three scores and k * product / (1 + sum) of them."""
    every, stats = _ranked(docs, held)
    top = stats.agg(F.max("n").alias("top"))
    both = every.where(F.col("df") >= least).crossJoin(F.broadcast(top)).withColumn("popularity", F.col("n") / F.col("top"))
    a, b, c = (F.col(x) for x in ("avg_score", "sd_score", "popularity"))
    return both.select("term", "avg_score", "sd_score", "popularity", (3 * a * b * c / (1 + a + b + c)).alias("score"))


def lemma_scores(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """lemma, avg_score and sd_score over its tokens (lemmas: lemma, token): the mean of all scores that are not zero, pooled over the tokens, and the mean
    over the tokens of their deviations (population, over all documents with zeros). Lemmas without a score have none."""
    by, n, _ = _sums(docs, HELD_TERMS)
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("q") / n - (F.col("s") / n) * (F.col("s") / n)))
    each = lemmas.select("lemma", F.lower("token").alias("term")).distinct().join(by.withColumn("sd", sd), "term")
    return each.groupBy("lemma").agg((F.sum("s") / F.sum("df")).alias("avg_score"), F.avg("sd").alias("sd_score"))


def lemma_popularity(docs: DataFrame, lemmas: DataFrame) -> DataFrame:
    """lemma, n and n over the largest n: how often its tokens come."""
    each = lemmas.select("lemma", F.lower("token").alias("term")).distinct().join(term_stats(docs).select("term", "n"), "term")
    by = written(each.groupBy("lemma").agg(F.sum("n").alias("n")), "lemmas")
    return by.crossJoin(F.broadcast(by.agg(F.max("n").alias("top")))).select("lemma", "n", (F.col("n") / F.col("top")).alias("popularity"))


def frame_ranking(scores: DataFrame, units: DataFrame) -> DataFrame:
    """Scored lemmas with the frames they evoke, best first: lemma, score, lu, frame and rank. units (lu, frame): lu is a lemma before its dot."""
    met = scores.join(units.select("lu", "frame", F.element_at(F.split("lu", r"\."), 1).alias("lemma")), "lemma")
    groups = met.groupBy("lemma", "score").agg(F.array_join(F.sort_array(F.collect_set("lu")), " ").alias("lus"), F.array_join(F.sort_array(F.collect_set("frame")), " ").alias("frames"))
    return groups.orderBy(F.desc("score"), "lemma")


def top_per_group(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The n first rows of each group; Spark keeps n of each before the shuffle where it can."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def lemma_of(term: str) -> F.Column:
    return F.regexp_replace(term, "(ing|ed|es|s)$", "")


def lemma_tokens(docs: DataFrame) -> DataFrame:
    """lemma and its distinct tokens, sorted and joined by a space; verbs are terms with a verb's ending."""
    verbs = docs.select(F.explode(F.array_distinct(tokens("text", lower=True))).alias("token")).where(F.col("token").rlike("(ing|ed)$")).distinct()
    return verbs.withColumn("lemma", lemma_of("token")).where("lemma <> ''").groupBy("lemma").agg(F.array_join(F.sort_array(F.collect_set("token")), " ").alias("tokens"), F.count("*").alias("n_tokens"))
