from __future__ import annotations

from pyspark.sql import functions as F

from factloom.functions import filters
from factloom.operators import kb, learning
from factloom.sources import sinks


def test_filters(spark):
    df = spark.createDataFrame([("n", "u", "x" * 60), ("", "u", None)], "name string, url string, bio string")
    assert [tuple(r) for r in df.select(filters.has_name_and_url(), filters.has_document("bio"), filters.sourced()).collect()] == [(True, True, True), (False, False, True)]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(filters.semicolon_list(F.lit("a; ;B;none"), ["None"])) == ["a", "B"]
    assert one(filters.type_class(F.lit(filters.PLACE))) == "Place"
    assert one(filters.known_fields(F.create_map(F.lit(" Born: "), F.lit("x"), F.lit("z"), F.lit("y")), ["born"])) == {"born": "x"}
    assert one(filters.past_year(F.lit(2999))) is None
    assert filters.union_all(df, spark.range(1)).columns == ["name", "url", "bio", "id"]


def test_kb(spark):
    labels = spark.createDataFrame([("Q1", "Paris", "en"), ("Q2", "paris", "fr")], "id string, label string, lang string")
    pages = spark.createDataFrame([("Paris", "Q1")], "title string, id string")
    hits = kb.search(spark.createDataFrame([("PARIS",)], "term string"), labels, pages)
    assert sorted((r.id, r["rank"]) for r in hits.collect()) == [("Q1", 1), ("Q1", 3), ("Q2", 2)]
    claims = spark.createDataFrame([("Q1", "P31", "city")], "id string, property string, value string")
    assert {r.id for r in kb.of_type(hits, claims, ["city"]).collect()} == {"Q1"}
    urls = spark.createDataFrame([("http://x/wiki/Paris?a",), ("http://x/wiki/No_one",)], "url string")
    assert sorted(str(r.id) for r in kb.items_of_urls(urls, pages).collect()) == ["None", "Q1"]
    assert {r.label for r in kb.names(labels, "fr").collect()} == {"Paris", "paris"}


def test_features(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a=1", "b=2"]), (2, ["a=1"])], "id int, f array<string>")
    assert learning.vectorized(rows, "f", 64, 2).select("reduced").count() == 2
    words = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z")], "id int, word string")
    vectors = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0])], "word string, vector array<double>")
    assert learning.word_vectors(words, vectors, ["id"]).first().vector == [0.5, 0.5]
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF

    sinks.save_model(Pipeline(stages=[HashingTF(inputCol="f", outputCol="v")]).fit(rows), str(tmp_path / "m"))
    assert sinks.load_model(str(tmp_path / "m")).transform(rows).count() == 2
