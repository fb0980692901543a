from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from factloom.functions import dates
from factloom.functions import text as T
from factloom.operators import annotation, joins, linking, ordering, sampling, statements, tagging
from factloom.sources import files, html, sinks, sites


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column("x").alias("y")).first()[0]


@pytest.mark.parametrize(("text", "want"), [("a  b", "a b"), ("a \n b ", "a b"), (" x", "x"), ("", ""), (None, None), ("a\t\nb", "a\nb")])
def test_clean_whitespace(spark, text, want):
    assert one(spark, text, T.clean_whitespace) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("Fraser, Sir Colin", "colin fraser"), ("Sir Colin Fraser", "colin fraser"), ("Prof. Dr Ann van Dyke", "ann dyke"), ("Mrs Smith (b. 1900)", "smith"), ("Stephen King", "stephen king"), ("Plato", "plato")],
)
def test_fix_name(spark, text, want):
    assert one(spark, text, T.fix_name) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("1820-1890", ("1820", "1890")), ("b. 1820", ("1820", None)), ("d.1890", (None, "1890")), ("c. 1820 – ca. 1890", ("1820", "1890")), ("1820-?", ("1820", None)), ("17th century - 1700", ("17thcentury", "1700")), ("x", (None, None))],
)
def test_birth_death(spark, text, want):
    assert tuple(one(spark, text, T.birth_death)) == want


def test_title_and_host(spark):
    assert one(spark, "o'neil jean-luc", T.title_case) == "O'Neil Jean-Luc"
    assert one(spark, "http://u@h.org:80/a?b", T.host) == "u@h.org:80"
    assert one(spark, "no url", T.host) == ""


def test_zip_map(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3", "4"]), ([], ["1"])], "k array<string>, v array<string>")
    got = [r[0] for r in df.select(T.zip_map(F.col("k"), F.col("v"))).collect()]
    assert got == [{"b": "2", "a": "3"}, {}]


@pytest.mark.parametrize(
    ("text", "category", "value"),
    [
        ("in 1999", "Time", {"year": 1999}), ("in early April 1863", "Time", {"year": 1863, "month": 4}), ("April 1863", "Time", {"year": 1863, "month": 4}), ("on the 3rd of May, 1900", "Time", {"day": 3, "month": 5, "year": 1900}),
        ("May 3, 1900", "Time", {"day": 3, "month": 5, "year": 1900}), ("12 sept", "Time", {"day": 12, "month": 9}), ("c. 1500", "Time", {"year": 1500}), ("from 1900 to 1910", "Duration", {"start": {"year": 1900}, "end": {"year": 1910}}),
        ("until 1950", "Duration", {"end": {"year": 1950}}), ("during 1920", "Duration", {"start": {"year": 1920}, "end": {"year": 1921}}), ("during the 1920s", "Duration", {"start": {"year": 1920}, "end": {"year": 1929}}),
        ("since 1980", "Duration", {"start": {"year": 1980}}), ("between 1914 and 1918", "Duration", {"start": {"year": 1914}, "end": {"year": 1918}}),
    ],
)
def test_expressions(text, category, value):
    _, c, v = dates.normalize_one(text)
    assert (c, v) == (category, value)


def test_no_expression_and_overlaps():
    assert dates.normalize_one("nothing") == ((-1, -1), None, None)
    found = dates.normalize_all("born in 1900, from 1910 to 1920 and in May 1930")
    assert [f[2] for f in found] == ["Time", "Duration", "Time"]
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
    assert dates.normalize_one("in 1900 from 1910 to 1920", "first")[1] == "Time"


@pytest.mark.parametrize(("text", "want"), [("24/2/2016", {"year": 2016, "month": 2, "day": 24}), ("1863", {"year": 1863}), ("b.c. 123", {"year": -123}), ("123Bc", {"year": -123}), ("x", None)])
def test_lenient(text, want):
    assert dates.lenient_date(text) == want


def test_format_and_parse(spark):
    rows = [(2016, 2, 24), (2016, None, None), (-50, 3, None), (None, 3, 4), (2016, None, 4), (None, None, None), (2016, 0, 1)]
    df = spark.createDataFrame(rows, "y int, m int, d int").withColumn("s", dates.format_date(F.col("y"), F.col("m"), F.col("d")))
    got = [r.s for r in df.collect()]
    assert got[:4] == ["+00000002016-02-24T00:00:00Z/11", "+00000002016-00-00T00:00:00Z/9", "-00000000050-03-00T00:00:00Z/10", "+00000000000-03-04T00:00:00Z/11"]
    assert got[4:] == [None] * 3
    back = df.select(dates.parse_date("s").alias("p")).select("p.*").collect()
    assert tuple(back[0]) == (2016, 2, 24) and tuple(back[2]) == (-50, 3, None)


def test_global_index_and_runs(spark):
    df = spark.range(100).withColumn("v", (F.col("id") / 10).cast("int"))
    got = ordering.global_index(df, F.floor(F.col("id") / 7), ["id"], "n").collect()
    assert all(r.n == r.id for r in got)
    runs = ordering.adjacent_groups(df.withColumn("g", F.lit(1)), ["g"], ["id"], "v").groupBy("run").count().collect()
    assert len(runs) == 10


def test_joins(spark):
    df = spark.createDataFrame([("u", "a"), ("u", "a"), ("w", "a"), ("w", "b"), (None, "c")], "url string, id string")
    assert [tuple(r) for r in joins.unambiguous(df, "url", "id").collect()] == [("u", "a")]


def test_linking(spark):
    docs = spark.createDataFrame([(1, "In New York city"), (2, None)], "doc_id int, text string")
    gaz = spark.createDataFrame([("new york", "NY"), ("City", "C1"), ("city", "C2")], "alias string, entity string")
    got = sorted(tuple(r) for r in linking.link(docs, gaz).collect())
    assert got == [(1, 1, "new york", "NY", 1.0), (1, 3, "city", "C1", 0.5), (1, 3, "city", "C2", 0.5)]


def test_statements(spark):
    rows = spark.createDataFrame([("Q1", {"born": "c. 1900", "sex": "?", "x": "y"}, "http://u")], "s string, f map<string,string>, url string")
    good, bad = statements.from_fields(rows, "s", "f", spark.createDataFrame([("born", "P569"), ("sex", "P21")], "field string, property string"), "url")
    assert good.first().statement == 'Q1\tP569\t+00000001900-00-00T00:00:00Z/9\tS854\t"http://u"'
    assert [(r.property, r.chunk) for r in bad.collect()] == [("P21", "?")]
    hits = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (1, 1, "c")], "k int, p int, h string")
    assert statements.single_hits(hits, "k", "p", "h").first().h == "c"


def test_sampling_repeats(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("s"), (F.col("id") % 2).cast("string").alias("u"))
    a, b = (sorted(r.id for r in sampling.balanced(df, "s", "u", F.col("id").cast("string"), 60).collect()) for _ in range(2))
    assert a == b and 60 < len(a) < 200


def test_annotation():
    html_form = annotation.form(["id", "fe_00", "fe_01", "chunk_00"])
    assert html_form.count("cml:radio ") == 3


def test_majority(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "None"), (2, "c")], "u int, x string")
    assert sorted(tuple(r) for r in annotation.majority(df, ["u"], "x").collect()) == [(1, "a", 1), (2, "c", 1)]


def test_tagging(spark):
    tags = tagging.tag("The old man was walking slowly in London.")
    assert [t[1] for t in tags] == ["DT", "NN", "NN", "VB", "VVG", "RB", "IN", "NP", "SENT"]
    assert tagging.chunk_texts([{"word": w, "pos": p} for w, p, _ in tags[:5] + [("the", "DT", ""), ("road", "NN", "")]]) == ["The old man was walking the road"]
    assert one(spark, None, tagging.tagged) == []


def test_html():
    page = '<html><head><title> A  b</title><script>x("</p>")</script></head><body><div class="c d"><p>One<br>two<p>three</div><a href="/x">l</a><a>m</a></body>'
    assert html.select(page, "title") == [" A  b"]
    assert html.select(page, "div.c p")[0].startswith("One")
    assert html.select(page, "a::attr(href)") == ["/x"]
    assert html.select("<p>", "p") == [""]
    assert html.clean([" a ", "", "b"]) == "a b"
    assert sites.many("<h2>A</h2>x<h2>B</h2>y", "h2") == [{"name": "A", "bio": "x"}, {"name": "B", "bio": "y"}]


def test_files(spark, tmp_path):
    import tarfile

    p = tmp_path / "in"
    p.mkdir()
    (p / "a.jsonl").write_text('{"name": "n", "bio": ["x", "y"], "other": {"k": "v"}}\nbad\n{"name": "m", "bio": ""}\n')
    (p / "b.txt").write_text("no")
    items = files.read_items(spark, str(p))
    assert items.count() == 2
    assert [(r.name, r.bio) for r in files.corpus(items).collect()] == [("n", "x\ny")]
    assert items.select(files.fields_of(F.col("other")).alias("f")).where("f is not null").first().f == {"k": "v"}
    with tarfile.open(tmp_path / "t.tar", "w") as tar:
        tar.add(p / "a.jsonl", "a.jsonl")
    assert files.read_tar(spark, str(tmp_path / "t.tar")).count() == 2
    text = tmp_path / "v.txt"
    text.write_text("skip\nNAME: A\none\n\ntwo\nNAME: B\nlast\n")
    got = files.segmented(files.numbered_lines(spark, str(text)), r"^NAME: (.*)$").orderBy("segment").collect()
    assert [(r.name, r.bio) for r in got] == [("A", "onetwo"), ("B", "last")]
    sinks.dump_items(items, str(tmp_path / "out"), 1)
    assert len(list((tmp_path / "out").glob("part-*.json"))) == 2
    sinks.dump_split(items, F.col("bio") != "", str(tmp_path / "ok"), str(tmp_path / "not"))
    assert spark.read.json(str(tmp_path / "not")).count() == 1
    sinks.dump_by(items, "name", str(tmp_path / "by"))
    sinks.dump_statements(spark.createDataFrame([("a\tb",), (None,)], "statement string"), str(tmp_path / "st"))
    assert spark.read.text(str(tmp_path / "st")).count() == 1
    sinks.dump_sheet(items.select("name", "bio"), str(tmp_path / "sheet"))
    assert files.read_csv(spark, str(tmp_path / "sheet")).columns == ["bio", "name"]


def test_stream_equals_batch(spark, data, tmp_path):
    from factloom.streaming import events

    batch = spark.read.parquet(f"{data}/events.parquet")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.parquet").write_bytes(open(f"{data}/events.parquet", "rb").read())
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = events.tumbling(stream).writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    a = sorted((r.start, r.event_type, r.n) for r in spark.table("windows").collect())
    assert a == sorted((r.start, r.event_type, r.n) for r in events.tumbling(batch).collect())
