"""Corpora from files."""

from __future__ import annotations

import json
import tarfile
from collections.abc import Iterator
from io import BytesIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

ITEM = "name string, birth string, death string, bio string, url string, other string"
#: Function words of some languages; others have none.
STOPWORDS = {
    "en": "a an and are as at be by for from has he in is it its of on or that the to was were will with", "fr": "au aux avec ce ces dans de des du elle en et il la le les leur par pas pour que qui sur un une",
    "de": "als am an auf aus bei das dem den der des die ein eine er es für ich im in ist mit nicht sie sich und von zu", "es": "a al como con de del el en es la las lo los no para por que se su un una y",
    "it": "a al che con da di e il in la le lo nel non per si un una", "nl": "aan de den een en het in is niet op te van voor", "pt": "a ao as com da de do e em o os para por que um uma", "bg": "а в и на не от по с се", "ru": "а в и к на не о по с что",
}


def read_items(spark: SparkSession, path: str, schema: str = ITEM) -> DataFrame:
    """JSON lines of a file, or of a folder's *.jsonl and *.jsonlines; lines that don't parse are left out. A nested field stays JSON text."""
    return parsed(spark.read.options(pathGlobFilter="*.{jsonl,jsonlines}").text(path).withColumnRenamed("value", "line"), schema)


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """Rows of a column line that holds JSON; others are left out."""
    return lines.where(F.try_parse_json("line").isNotNull()).select(F.from_json("line", schema).alias("x")).select("x.*")


def read_tar(spark: SparkSession, path: str, schema: str = ITEM) -> DataFrame:
    """JSON lines of the members of tar archives; an archive is read by one task, a member at a time."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with tarfile.open(fileobj=BytesIO(content.as_py())) as tar:
                    for member in tar:
                        f = tar.extractfile(member)
                        if f is not None:
                            yield pa.RecordBatch.from_pydict({"line": pa.array([x.decode("utf-8", "replace").rstrip("\r\n") for x in f], pa.string())})

    raw = spark.read.format("binaryFile").load(path).select("content").mapInArrow(lines, "line string")
    return parsed(raw, schema)


def coalesced(text: Column) -> Column:
    """A text, or the strings of a JSON list of them joined by new lines."""
    parts = F.from_json(text, "array<string>")
    return F.when(F.trim(text).startswith("["), F.coalesce(F.array_join(parts, "\n"), text)).otherwise(text)


def corpus(items: DataFrame, document: str = "bio") -> DataFrame:
    """name, url and document of items whose document isn't empty."""
    out = items.select("name", "url", coalesced(F.col(document)).alias(document))
    return out.where(F.col(document).isNotNull() & (F.col(document) != ""))


def strict_corpus(items: DataFrame, document: str) -> DataFrame:
    """As corpus, but a missing document is an error when the rows are read."""
    return items.select("*", F.when(F.col(document).isNull(), F.raise_error(F.lit(f"no {document}"))).alias("_check")).where("_check is null").drop("_check")


def preprocess(items: DataFrame, document: str = "bio", min_length: int = 50) -> DataFrame:
    """Items with longer documents, and the SHA-1 of each as id."""
    return items.where(F.length(document) > min_length).withColumn("id", F.sha1(document))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document, as a small dimension."""
    return spark.read.json(path, multiLine=True)


def read_pairs(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Two-column CSV files (pk, data), left-joined to the first one by pk: a column for each name."""
    tables = [spark.read.csv(p, header=True).toDF("pk", name) for name, p in paths.items()]
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, "pk", "left")
    return out


def segmented(lines: DataFrame, header: str, order: str = "line_no", text: str = "line", group: str = "path") -> DataFrame:
    """Records of plain text: a line that matches header begins one and its first group is the name; other lines follow without new lines. Blank
    lines and what stands before the first header are left out. A file's lines are ordered in one task."""
    name = F.regexp_extract(text, header, 1)
    rows = lines.where(F.trim(text) != "").withColumn("_is", F.col(text).rlike(header))
    rows = rows.withColumn("segment", F.sum(F.col("_is").cast("int")).over(W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0))).where("segment > 0")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("_is"), F.struct(order, text)))), lambda x: x[text]), "")
    return rows.groupBy(group, "segment").agg(F.max(F.when(F.col("_is"), name)).alias("name"), body.alias("bio"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no and line of text files."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = content.as_py().decode("utf-8", "replace").split("\n")
                yield pa.RecordBatch.from_pydict({"path": pa.array([name] * len(rows)), "line_no": pa.array(range(len(rows)), pa.int64()), "line": pa.array([r.rstrip("\r") for r in rows])})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(lines, "path string, line_no long, line string")


def stopwords(spark: SparkSession, lang: str) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOPWORDS.get(lang, "").split()], "word string")


def fields_of(other: Column) -> Column:
    """A JSON object's fields as a map of strings; null where it isn't one."""
    return F.when(F.trim(other).startswith("{"), F.from_json(other, "map<string,string>"))


def values_of(other: Column) -> Column:
    """Strings in a JSON value: itself, a list's members, an object's keys and values."""
    return F.when(F.trim(other).startswith("["), F.from_json(other, "array<string>")).when(F.trim(other).startswith("{"), F.concat(F.map_keys(fields_of(other)), F.map_values(fields_of(other)))).otherwise(F.array(other))


def lexicon_rows(lexical: dict) -> list[tuple]:
    """A lexical database (unit -> frame, pos, core_fes, extra_fes) as rows lu, frame, pos, fe, core, class, property, qualifiers."""
    out = []
    for lu, entry in lexical.items():
        for core in (True, False):
            for fe in entry.get("core_fes" if core else "extra_fes") or []:
                for cls in fe.get("dbpedia_classes") or [None]:
                    out.append((lu, entry.get("frame"), entry.get("pos"), fe.get("fe"), core, cls, (fe.get("mapping") or {}).get("id"), fe.get("qualifiers") or []))
    return out


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A lexical database from a JSON file; it is a dimension that the driver holds."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return spark.createDataFrame(lexicon_rows(json.loads(text)), "lu string, frame string, pos string, fe string, core boolean, class string, property string, qualifiers array<string>")
