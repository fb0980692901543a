"""Entity linking by a gazetteer: word n-grams of a text meet aliases in an equi-join."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.functions.text import tokens


_WORD = regex.compile(r"[\p{L}\p{N}]+")


def ngrams(docs: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """key, position and chunk of all runs of 1 to most words."""
    words = docs.select(key, tokens(text, lower=True).alias("_w"))
    at = words.select(key, "_w", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("_n")).where(F.size("_w") >= F.col("_n"))
    runs = F.transform(F.sequence(F.lit(0), F.size("_w") - F.col("_n")), lambda i: F.struct(i.alias("position"), F.array_join(F.slice("_w", i + 1, F.col("_n")), " ").alias("chunk")))
    return at.select(key, F.inline(runs))


LINKED = "array<struct<chunk:string,start:int,end:int,uri:string,confidence:double,types:array<string>,alternate_names:array<string>>>"


def linked_entities(docs: DataFrame, gazetteer: DataFrame, things: DataFrame, key: str = "doc_id", text: str = "text", most: int = 3, min_confidence: float = 0.25) -> DataFrame:
    """docs with `linked`, the entities of each text in its order: chunk as written, start and end in characters, uri, confidence, types and alternate names. things
    (entity, uri, types, alternate_names): what is known of the gazetteer's entities. Texts without entities have an empty array; keys are unique."""
    hits = link(docs, gazetteer, key, text, most, min_confidence).join(things, "entity", "left")
    item = F.struct("position", F.size(F.split("chunk", " ")).alias("n"), "uri", "confidence", "types", "alternate_names")
    by = hits.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("_hits"))

    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, found in batches:
            out = []
            for t, h in zip(texts, found, strict=True):
                at = [m.span() for m in _WORD.finditer(t)] if h else []
                spans = [(at[x["position"]][0], at[x["position"] + x["n"] - 1][1], x) for x in json.loads(h)] if h else []
                out.append([{"chunk": t[a:z], "start": a, "end": z, **{c: x.get(c) for c in ("uri", "confidence", "types", "alternate_names")}} for a, z, x in spans])
            yield pd.Series(out)

    return docs.join(by, key, "left").withColumn("linked", F.pandas_udf(placed, LINKED)(F.col(text), F.col("_hits"))).drop("_hits")


def link(docs: DataFrame, gazetteer: DataFrame, key: str = "doc_id", text: str = "text", most: int = 3, min_confidence: float = 0.25, held: int = 100_000) -> DataFrame:
    """key, position, chunk, entity and confidence (1 / entities of the alias) of aliases in a text. Where the gazetteer is small enough to be broadcast, only
    places where the first word of an alias stands are looked at; else all runs of words meet it in a join."""
    names = gazetteer.select(F.lower("alias").alias("chunk"), "entity")
    names = names.withColumn("confidence", 1 / F.count("*").over(W.partitionBy("chunk"))).where(F.col("confidence") >= min_confidence)
    if names.limit(held + 1).count() <= held:
        words = F.split("chunk", " ")
        starts = names.select("*", F.element_at(words, 1).alias("_first"), F.size(words).alias("_n")).where(F.col("_n") <= most)
        firsts = [r[0] for r in starts.select("_first").distinct().limit(65).collect()]
        each = docs.select(key, tokens(text, lower=True).alias("_w"))
        if len(firsts) <= 64:  # a few words are told apart before rows are made
            each = each.where(F.arrays_overlap("_w", F.array(*[F.lit(x) for x in firsts]).cast("array<string>")))
        at = each.select(key, "_w", F.posexplode("_w").alias("position", "_first"))
        met = at.join(F.broadcast(starts), "_first").where((F.col("_n") == 1) | (F.array_join(F.slice("_w", F.col("position") + 1, F.col("_n")), " ") == F.col("chunk")))
        return met.select(key, "position", "chunk", "entity", "confidence")
    share = names.groupBy("chunk").agg(F.max("confidence").alias("confidence"))
    names = names.drop("confidence")
    return ngrams(docs, key, text, most).join(names.join(share, "chunk"), "chunk").where(F.col("confidence") >= min_confidence).select(key, "position", "chunk", "entity", "confidence")
