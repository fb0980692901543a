"""Features, classifiers and evaluation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from factloom.operators.sampling import hash_fraction
from factloom.session import shared_path, sized, written

#: Queries in a file, queries and rows compared at once: ROWS x QUERIES distances are 16 MB, and of those three arrays are there at a time.
BLOCK, QUERIES, ROWS = 4096, 128, 16_384
COMPONENTS = 1024


def knn(queries: DataFrame, base: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Exact k nearest rows of base to each query by Euclidean distance, and the most frequent label of them."""
    return voted(queries, nearest(queries, base, k, key, vector, label), k, key, label)


def nearest(queries: DataFrame, base: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """query, other, found and place of the exact k nearest rows of base to each query, and their labels. Queries are written to the shared folder in files
    of BLOCK rows; each task reads them file by file for every ROWS of its rows, and keeps the rows that can be among the k by (distance rounded to 6
    digits, key). So neither driver nor task holds all queries."""
    folder = shared_path(base.sparkSession, "queries")
    queries.select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector)).write.option("maxRecordsPerFile", BLOCK).parquet(folder)
    near = base.select(F.col(key).cast("long"), F.col(vector).cast("array<double>"), F.col(label).cast("int")).mapInArrow(_nearest(folder, k), "query long, other long, found int, distance double")
    places = near.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.round("distance", 6), "other"))).where(F.col("place") <= k)
    return places.select("query", "other", "found", "place")


def voted(queries: DataFrame, found: DataFrame, k: int, key: str, label: str) -> DataFrame:
    """queries with the most frequent label of the first k of what nearest found."""
    votes = found.where(F.col("place") <= k).groupBy("query", "found").agg(F.count("*").alias("votes"))
    first = votes.groupBy("query").agg(F.min_by("found", F.struct(-F.col("votes"), "found")).alias("predicted"))
    return first.join(queries.select(F.col(key).alias("query"), label), "query").select(F.col("query").alias(key), label, "predicted")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pa.array([], pa.float64()) if not len(column) else (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(folder: str, k: int):  # noqa: ANN202
    def near(ids: np.ndarray, q: np.ndarray, other: np.ndarray, x: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        norm, size = (q * q).sum(1), (x * x).sum(1)
        d = q @ x.T
        d *= -2
        d += size
        d += norm[:, None]
        d[ids[:, None] == other] = np.inf
        # Rows up to the k-th distance, and what rounding and the product's error may add; of equal distances k of the least keys.
        limit = np.partition(d, min(k, len(other)) - 1, axis=1)[:, min(k, len(other)) - 1] + 2e-6 + 1e-12 * (norm + size.max())
        at, rows, distance = [], [np.zeros(0, np.int64)], [np.zeros(0)]
        for i in range(len(ids)):
            top = np.flatnonzero((d[i] <= limit[i]) & np.isfinite(d[i]))
            exact = ((q[i] - x[top]) ** 2).sum(1)
            order = np.lexsort((other[top], exact))
            top, exact = top[order], exact[order]
            ok = np.arange(len(top)) - np.searchsorted(exact, exact) < k
            at.append(np.full(int(ok.sum()), ids[i]))
            rows.append(top[ok])
            distance.append(exact[ok])
        at, rows = np.concatenate([ids[:0], *at]), np.concatenate(rows)
        return pa.RecordBatch.from_pydict({"query": pa.array(at), "other": pa.array(other[rows]), "found": pa.array(found[rows].astype(np.int32)), "distance": pa.array(np.concatenate(distance))})

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(at)) if f.path.endswith(".parquet"))

        def against(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            other, x, found = rows.column(0).to_numpy(), _matrix(rows.column(1)), rows.column(2).to_numpy()
            for path in files:
                block = pq.read_table(path, filesystem=fs)
                for i in range(0, len(block), QUERIES):
                    part = block.slice(i, QUERIES)
                    yield near(part.column(0).to_numpy(), _matrix(part.column(1)), other, x, found)

        held, size = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
            if size >= ROWS:
                yield from against(held)
                held, size = [], 0
        if held:
            yield from against(held)

    return nearest


def f1(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Macro and weighted F1 from one small table of confusions."""
    c = df.groupBy(predicted, actual).agg(F.count("*").alias("n"))
    sides = c.select(F.explode(F.array(F.struct(F.col(predicted).alias("k"), F.lit(1).alias("p"), F.lit(0).alias("a")), F.struct(F.col(actual).alias("k"), F.lit(0).alias("p"), F.lit(1).alias("a")))).alias("s"), "n", (F.col(predicted) == F.col(actual)).cast("int").alias("ok"))
    by = sides.groupBy("s.k").agg(F.sum(F.col("s.p") * F.col("n")).alias("p"), F.sum(F.col("s.a") * F.col("n")).alias("a"), F.sum(F.col("s.p") * F.col("n") * F.col("ok")).alias("tp"))
    score = 2.0 * F.col("tp") / (F.col("p") + F.col("a"))
    return by.agg(F.avg(score).alias("macro_f1"), (F.sum(score * F.col("a")) / F.sum("a")).alias("weighted_f1"))


def folds(df: DataFrame, key: Column, k: int) -> DataFrame:
    return df.withColumn("fold", F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % k)


def reverse(index: DataFrame, feature: str, chunks: str) -> DataFrame:
    """chunk and its features, sorted."""
    return index.select(feature, F.explode(chunks).alias("chunk")).groupBy("chunk").agg(F.sort_array(F.collect_set(feature)).alias("features"))


def window_features(tags: DataFrame, group: list[str], position: str, width: int, columns: tuple[str, ...]) -> DataFrame:
    """Features like "lemma-1=be" of the rows around each, as an array of strings, ready for a CountVectorizer."""
    w = W.partitionBy(*group).orderBy(position)
    parts = []
    for c in columns:
        for k in range(-width, width + 1):
            v = F.lag(c, -k).over(w) if k < 0 else F.lead(c, k).over(w) if k else F.col(c)
            parts.append(F.when(v.isNotNull(), F.concat(F.lit(f"{c}{k:+d}="), v)))
    return tags.withColumn("features", F.array_compact(F.array(*parts)))


MODEL = "classes array<string>, weights array<array<double>>"


def fit_bank(rows: DataFrame, unit: str, vector: str, target: str, key: str, fit_rows: int = 50_000, rounds: int = 200, penalty: float = 0.01) -> DataFrame:
    """A linear classifier with squared hinge loss, one class against the others, for each unit: unit, classes and weights. Of a unit with more than fit_rows rows
    about so many are fitted, chosen by the hash of their key; so no task gets an unbounded unit. A table to be kept as it is; see predict_bank."""

    def fit(p: pd.DataFrame) -> pd.DataFrame:
        x = np.column_stack([np.stack(p[vector]).astype(float), np.ones(len(p))])
        names = sorted(p[target].astype(str).unique())
        y = np.where(p[target].astype(str).to_numpy()[:, None] == np.array(names), 1.0, -1.0)
        w, seen = np.zeros((x.shape[1], len(names))), np.full((x.shape[1], len(names)), 1e-8)
        for _ in range(rounds):
            g = -2 * x.T @ (y * np.maximum(0, 1 - y * (x @ w))) / len(x) + penalty * w
            seen += g * g
            w -= 0.5 * g / np.sqrt(seen)
        return pd.DataFrame({unit: [p[unit].iloc[0]], "classes": [names], "weights": [w.T.tolist()]})

    sizes = rows.groupBy(unit).agg(F.least(F.lit(1.0), F.lit(float(fit_rows)) / F.count("*")).alias("_share"))
    some = rows.select(key, unit, vector, target).where(F.col(target).isNotNull() & F.col(vector).isNotNull()).join(sized(sizes), unit).where(hash_fraction(F.col(key).cast("string")) < F.col("_share"))
    kind = rows.schema[unit].dataType.simpleString()
    return some.orderBy(key).drop("_share").groupBy(unit).applyInPandas(lambda p: fit(p.sort_values(key)), f"{unit} {kind}, {MODEL}")


def predict_bank(rows: DataFrame, models: DataFrame, unit: str, vector: str) -> DataFrame:
    """rows with predicted, by the model of their unit: products in the JVM. Null where the unit has no model; of equal scores the first class counts."""
    dot = lambda w: F.aggregate(F.zip_with(w, F.concat(F.col(vector).cast("array<double>"), F.array(F.lit(1.0))), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    scored = rows.join(sized(models), unit, "left").withColumn("_s", F.transform("weights", dot))
    best = F.element_at("classes", F.array_position("_s", F.array_max("_s")).cast("int"))
    return scored.withColumn("predicted", best).drop("_s", "classes", "weights")


def to_elements(predictions: DataFrame, sentence: str, position: str, chunk: str, outside: str = "O") -> DataFrame:
    """Predicted labels of chunks as elements of their sentence: sentence and fes (fe, chunk) by position; chunks outside are none, sentences without any are left out."""
    kept = predictions.where(F.col("predicted").isNotNull() & (F.col("predicted") != outside))
    item = F.struct(F.col(position).alias("at"), F.struct(F.col("predicted").alias("fe"), F.col(chunk).alias("chunk")).alias("x"))
    return kept.groupBy(sentence).agg(F.transform(F.array_sort(F.collect_list(item)), lambda v: v["x"]).alias("fes"))


def dummy(rows: DataFrame, target: str, key: str) -> DataFrame:
    """rows with predicted: a class drawn by the classes' shares, from the hash of the key. What a classifier has to beat."""
    by = rows.groupBy(target).agg(F.count("*").alias("_n"))
    every = W.orderBy(target).rowsBetween(W.unboundedPreceding, 0)  # a row for each class
    upto = by.select(F.col(target).alias("c"), (F.sum("_n").over(every) / F.sum("_n").over(W.partitionBy())).alias("u"))
    table = upto.agg(F.array_sort(F.collect_list(F.struct("u", "c"))).alias("_classes"))
    h = hash_fraction(F.col(key).cast("string"))
    return rows.crossJoin(F.broadcast(table)).withColumn("predicted", F.get(F.filter("_classes", lambda x: h < x["u"]), F.lit(0))["c"]).drop("_classes")


def random_features(rows: DataFrame, vector: str, size: int = 64, gamma: float = 0.5, seed: int = 1) -> DataFrame:
    """rows with `vector` replaced by random Fourier features, whose products approximate the kernel exp(-gamma |x - y|^2): a kernel SVC as a linear one."""

    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            if not len(s):
                yield s
                continue
            x = np.stack(s).astype(float)
            rng = np.random.default_rng(seed)
            w, b = rng.normal(0, np.sqrt(2 * gamma), (x.shape[1], size)), rng.uniform(0, 2 * np.pi, size)
            yield pd.Series(list(np.sqrt(2 / size) * np.cos(x @ w + b)))

    return rows.withColumn(vector, F.pandas_udf(mapped, "array<double>")(F.col(vector).cast("array<double>")))


def model_selection(rows: DataFrame, vector: str, target: str, k: int = 3, key: str | None = None) -> DataFrame:
    """Grids of linear, kernel and tree models, and of neighbours where rows have a key, cross-validated; name and score of each family's best."""
    from pyspark.ml.classification import LinearSVC, RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    def data(df: DataFrame) -> DataFrame:
        return df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"), F.col(target).cast("double").alias("label")).persist()

    plain, kernel = data(rows), data(random_features(rows, vector))
    scored = []
    svc, forest = LinearSVC(maxIter=10), RandomForestClassifier(numTrees=10, seed=1)
    for name, df, model, grid in (
        ("LinearSVC", plain, svc, ParamGridBuilder().addGrid(svc.regParam, [0.01, 0.1]).build()), ("SVC", kernel, svc, ParamGridBuilder().addGrid(svc.regParam, [0.01, 0.1]).build()),
        ("RandomForest", plain, forest, ParamGridBuilder().addGrid(forest.maxDepth, [3, 5]).build()),
    ):
        cv = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="f1"), numFolds=k, seed=1, parallelism=2)
        scored.append((name, float(max(cv.fit(df).avgMetrics))))
    plain.unpersist()
    kernel.unpersist()
    if key:
        parts = folds(rows.withColumn(target, F.col(target).cast("int")), F.col(key).cast("string"), k)
        # The neighbours of a fold are looked for once, and serve both numbers of them.
        found = [written(nearest(parts.where(F.col("fold") == i), parts.where(F.col("fold") != i), 5, key, vector, target), "nearest") for i in range(k)]
        best = 0.0
        for n in (3, 5):
            got = [voted(parts.where(F.col("fold") == i), found[i], n, key, target) for i in range(k)]
            best = max(best, sum(f1(g, "predicted", target).first()["weighted_f1"] or 0.0 for g in got) / k)
        scored.append(("KNN", float(best)))
    return rows.sparkSession.createDataFrame(scored, "model string, score double")


def gazetteer_features(tokens: DataFrame, index: DataFrame, token: str = "token", name: str = "gazetteer") -> DataFrame:
    """tokens with the feature of the gazetteer (chunk, features) for them, the last of several; null without one."""
    known = index.groupBy(F.lower("chunk").alias("_chunk")).agg(F.array_max(F.flatten(F.collect_list("features"))).alias(name))
    return tokens.withColumn("_chunk", F.lower(token)).join(known, "_chunk", "left").drop("_chunk")


def vectorized(rows: DataFrame, features: str, size: int = 1 << 18, reduce_to: int | None = None) -> DataFrame:
    """Arrays of features as sparse vectors by hashing, which needs no pass for a vocabulary; reduce_to: principal components of them, for which they
    are hashed to COMPONENTS columns at most, as the columns' covariance has to be held."""
    from pyspark.ml.feature import PCA, HashingTF

    out = HashingTF(inputCol=features, outputCol="vector", numFeatures=min(size, COMPONENTS) if reduce_to else size, binary=True).transform(rows)
    if reduce_to:
        out = PCA(k=reduce_to, inputCol="vector", outputCol="reduced").fit(out).transform(out)
    return out


def word_vectors(words: DataFrame, vectors: DataFrame, key: list[str], word: str = "word", vector: str = "vector") -> DataFrame:
    """The mean vector of the words of each key; words without one don't count."""
    each = words.select(*key, word).join(vectors.select(word, F.posexplode(vector).alias("_i", "_v")), word)
    return each.groupBy(*key, "_i").agg(F.avg("_v").alias("_v")).groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_v"))), lambda x: x["_v"]).alias(vector))
