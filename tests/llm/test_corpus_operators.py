"""Jaccard join, mixing, WARC, language model, pipeline: against brute force or SQL, and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from base64 import b32encode
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import jaccard as J
from factloom.llm import lm, mixing, registry, warc
from factloom.llm.shared import new_path
from tests.compare import same
from tests.llm.conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str | None) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_similar(rows: list[tuple]) -> list[tuple]:
    sets = []
    for _, t in rows:
        w = lowered(t)
        sets.append({tuple(w[i : i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} if w else set())
    near = [[j for j in range(len(rows)) if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), len(near[i]), min(ids) if ids else None))
    return out


def columns(df) -> list[str]:  # noqa: ANN001
    return sorted(str((r.doc_id, r.n_shingles, r.n_similar, r.component_id)) for r in df.collect())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, data, name):
    same(registry.queries()[name](spark, data), registry.oracle_sql()[name], data)


def test_similar_clusters(spark, monkeypatch):
    """Edited copies of some texts, sizes at the bounds, short and common texts."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(160):
        base = random.Random(d % 12)
        text = [base.choice(words) for _ in range(base.randint(1, 60))]
        text = [rnd.choice(words) if rnd.random() < 0.04 * (d % 5) else w for w in text]
        rows.append((d, " ".join(text[: rnd.randint(len(text) * 6 // 10, len(text))])))
    rows += [(None, rows[0][1]), (200, None), (201, ""), (202, "w1"), (203, "W1"), (204, "the the"), (205, "the"), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_similar(rows)
    assert sum(n for _, _, n, _ in want) > 300
    assert columns(J.similar(df)) == sorted(map(str, want))
    monkeypatch.setattr(J.link_classes, "__defaults__", (0,))  # by the join
    assert columns(J.similar(df)) == sorted(map(str, want))
    stay = sorted(str(r.doc_id) for r in J.similar_rows(df).collect())
    assert stay == sorted(str(r.doc_id) for r in J.similar_rows(df, broadcast_rows=0).collect())
    assert stay == sorted(str(x) for x in {c for _, n, _, c in want if n} | {d for d, n, _, _ in want if not n})


def test_similar_edges(spark, edge, clashing, empty):
    rows = [(d, t) for d, t, *_ in EDGE]
    assert columns(J.similar(clashing)) == sorted(map(str, brute_similar(rows)))
    assert J.similar_rows(clashing).columns == clashing.columns
    assert J.similar(empty).count() == 0 and J.similar_rows(empty).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=25, unique=True), min_size=2, max_size=12))
def test_product_and_overlaps(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = J.product(arrays, 7)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(set(a) & set(b))
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in order])
    packed = np.array([(k << 4) | d for d, i in enumerate(order) for k in sets[i]], np.uint64)
    found = Counter()
    for a, b, c in J.overlaps(packed, 4, size, 60, most=3):
        for x, y, n in zip(a.tolist(), b.tolist(), c.tolist(), strict=True):
            found[min(x, y), max(x, y)] += n
    for x in range(len(order)):
        for y in range(x + 1, len(order)):
            common = len(set(sets[order[x]]) & set(sets[order[y]]))
            assert found[x, y] == (common if 100 * size[x] >= 60 * size[y] else 0)


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(20)]
    df = spark.createDataFrame([e for e in edges if e[0] != e[1]], "a long, b long")
    a, b = (sorted(map(tuple, J.components(df, limit).collect())) for limit in (10**6, 0))
    assert a == b and (1020, 1000) in a


def test_mix_closeness(spark):
    """Shares near the targets, no document over three times, a source held down to three times its size, equal reruns."""
    rnd = random.Random(1)
    sources = ["a"] * 900 + ["b"] * 60 + ["c"] * 300 + [None] * 240 + ["d"] * 5
    rows = [(i, "w " * rnd.randint(1, 40), s) for i, s in enumerate(sources)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [mixing.source_mix(df, bin_rows=n).collect() for n in (20_000, 17)]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1]))
    by, total = {}, sum(r["size"] for r in got[0])
    for r in got[0]:
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sum(t for _, t in by) == pytest.approx(total)
    for (words, target), taken in by.items():
        assert target <= 3 * words + 1e-6
        assert abs(sum(taken) - target) <= 120
    assert any(target == 3 * words for words, target in by)
    copies = mixing.mixed(df)
    finish = [r.finish for r in copies.collect()]
    assert finish == sorted(finish) and len(finish) == sum(r.taken // r["size"] for r in got[0] if r["size"])


def test_mix_edges(clashing, empty):
    rows = mixing.source_mix(clashing).collect()
    assert len(rows) == len(EDGE) and sum(r.taken for r in rows if not r["size"]) == 0
    assert set(mixing.mixed(clashing).columns) == set(clashing.columns)
    assert mixing.source_mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = empty.sparkSession.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.source_mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>page {i % 7} é</p>" * (i % 7 + 1)) for i in range(60)] + [(None, None, None), (70, "a b\nc", ""), (3, "x", "<p>page 3 é</p>" * 4), (90, None, "z" * 2_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_path(spark, "test")
    archives = warc.write_warc(df, folder, archive_bytes=2000, hot_rows=5)
    assert archives.count() > 3 and sum(r.records for r in archives.collect()) == len(rows)
    got = warc.read_warc(archives).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h in rows:
        other = first.get(h or "") if i is not None and first[h or ""] != i else None
        body = (h or "").encode()
        want[i, len(body), b32encode(hashlib.sha1(body).digest()).decode(), "response" if other is None else "revisit", other] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    payloads = {r.page_id: bytes(r.payload).decode() for r in got if r.payload is not None and r.page_id is not None}
    assert all(payloads[i] == (h or "") for i, _, h in rows if i in payloads)
    data = open(archives.first().archive.removeprefix("file://"), "rb").read()
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    assert all(warc.parse(zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + int.from_bytes(data[4:8], "little")])).decompress(bytes(f))) for f in warc.frames(memoryview(data)))
    broken = bytearray(data)
    broken[-3] ^= 255
    for bad in (bytes(broken), data[:-5], b"junk" * 9):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(bad))
    for bad in (b"", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n", warc.record(1, "u", b"abc", None) + b"x"):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)
    fields, block = warc.parse(warc.record(1, "u", b"abc", None))
    with pytest.raises(warc.WarcError):
        warc.payload_of(fields, block[:-1] + b"d")
    packed = zstandard.ZstdCompressor().compress(b"hello dictionary " * 9)
    assert warc.decoder(memoryview(warc.dictionary_frame(packed))) is not None
    assert warc.round_trip(df.limit(0)).count() == 0


def built(kind: str, block: bytes, version: str = "WARC/1.0", **more: str) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:00000000-0000-0000-0000-000000000001>", "WARC-Date": "2020-01-01T00:00:00Z", **more, "Content-Length": str(len(block))}
    return (version + "\r\n" + "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def test_warc_of_others(spark, tmp_path):
    """Archives that this library didn't write: other types, ids, versions and digests, and no dictionary."""
    http = "application/http; msgtype=response"
    body = b"<p>hello</p>"
    sha = b32encode(hashlib.sha1(body).digest()).decode()
    ok = b"HTTP/1.1 200 OK\r\nContent-Length: 12\r\n\r\n" + body
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n7\r\n<p>hell\r\n5;x=1\r\no</p>\r\n0\r\n\r\n"
    records = [
        built("warcinfo", b"software: other\r\n", Content_Type="application/warc-fields"),
        built("request", b"GET / HTTP/1.1\r\n\r\n", Content_Type="application/http; msgtype=request"),
        built("response", ok, Content_Type=http, WARC_Target_URI="http://h/"),
        built("response", ok, "WARC/1.1", Content_Type=http, WARC_Payload_Digest="sha1:" + sha, WARC_Block_Digest="sha256:" + hashlib.sha256(ok).hexdigest()),
        built("response", chunked, Content_Type=http, WARC_Payload_Digest="sha1:" + sha), built("response", b"10 example.", Content_Type="text/dns"),
        built("response", ok[:-3], Content_Type=http, WARC_Truncated="length"), built("response", ok, Content_Type=http, X_Folded="a\r\n b"),
        built("revisit", b"", WARC_Refers_To="<urn:uuid:9>", WARC_Payload_Digest="sha1:" + sha), built("metadata", b"x: y"),
    ]
    path = tmp_path / "other.warc.zst"
    path.write_bytes(b"".join(zstandard.ZstdCompressor().compress(r) for r in records))
    archives = spark.createDataFrame([(f"file://{path}",)], "archive string")
    got = warc.read_warc(archives).collect()
    assert [(r.record_type, r.payload and bytes(r.payload), r.payload_bytes) for r in got] == [
        ("response", body, 12), ("response", body, 12), ("response", body, 12), ("response", b"10 example.", 11), ("response", body[:-3], 9), ("response", body, 12), ("revisit", None, None),
    ]
    assert got[0].url == "http://h/" and got[0].payload_digest == got[-1].payload_digest == sha and got[-1].refers_to_id == "<urn:uuid:9>"
    assert all(r.page_id is None and r.record_id.startswith("<urn:uuid:") for r in got)
    assert [r.record_type for r in warc.read_warc(archives, None).collect()] == [r.split(b"WARC-Type: ")[1].split(b"\r\n")[0].decode() for r in records]
    for bad in (
        built("response", ok + b"x", Content_Type=http), built("response", ok, Content_Type=http, WARC_Payload_Digest="sha1:" + sha[::-1]), built("response", b"none", Content_Type=http),
        built("response", ok.replace(b": 12", b": x"), Content_Type=http), built("response", b"x", WARC_Payload_Digest="md5:00"), built("response", b"HTTP/1.1 200", Content_Type=http),
    ):
        with pytest.raises(warc.WarcError):
            warc.payload_of(*warc.parse(bad))
    for bad in (built("response", b"x", "WARC/9"), b"WARC/1.1\r\n\xff: x\r\n\r\n", built("response", b"x", WARC_Block_Digest="sha1:AAAA"), built("response", b"x").replace(b"Length: 1", b"Length: 2")):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)
    for bad in (b"\x28\xb5\x2f\xfd", b"\x28\xb5\x2f\xfd\xff\xff\xff\xff", b"\x5d\x2a\x4d\x18\xff\xff\xff\x7fabc"):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(bad))


def test_warc_edges(spark):
    """Nulls, repeated rows, and columns of names that the writer uses."""
    rows = [(1, "u", "a"), (1, "u", "a"), (None, None, None), (None, "u", "a"), (2, "u", "a"), (3, "v", "long " * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS first", "3 AS n", "4 AS meet", "5 AS hot_first", "6 AS payload")
    got = sorted(str((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in warc.round_trip(df).collect())
    want = [(1, 1, "response", None), (1, 1, "response", None), (None, 0, "response", None), (None, 1, "response", None), (2, 1, "revisit", 1), (3, 1_500_000, "response", None)]
    assert got == sorted(map(str, want))


@pytest.mark.parametrize("share", [1_000_000, 300])
def test_lm(spark, data, share):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    rows = lm.scores(spark.read.parquet(f"{data}/documents.parquet"), hot_share=share, single=30, clusters=30).collect()
    count, tokens = Counter(), {}
    for d, t in docs:
        tokens[d] = [*lowered(t), "\0end"]
        if zlib.crc32(str(d).encode()) % 7 != 2:
            count.update(tokens[d])
    n, v = sum(count.values()), len(count)
    for r in rows:
        w = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2, len(w), sum(count[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_score_by_brute_force(spark):
    """Each text's score from the model's numbers, by sums over all classes and all words of a class, token by token."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    rows = [(d, " ".join(rnd.choice(words[: 12 + d % 40]) for _ in range(rnd.randint(0, 40)))) for d in range(120)] + [(500, "unseen W3 words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    small = {"single": 6, "clusters": 7, "rounds": 2}
    got = {r.doc_id: r.score for r in lm.scores(docs, **small, size=5).collect()}
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    trained = spark.createDataFrame([(t, held(d)) for d, t in rows], "text string, held_out boolean")
    v = lm.count_words(trained, 1_000_000, 3)
    v.set_classes(*lm.classes_of(v, lm.word_vectors(trained, v), 6, 7))
    model = lm.train(trained, v, 5, 2)
    count = Counter(w for d, t in rows if not held(d) for w in lowered(t))
    n_docs = sum(not held(d) for d, _ in rows)
    known = {w: c for w, c in count.items() if c > 3}
    rare_n, rare_v = sum(count.values()) - sum(known.values()), len(count) - len(known)
    assert (v.n, v.v) == (sum(count.values()) + n_docs, len(count) + 1)
    names = sorted(known)
    place = dict(zip(names, v.hot.find(np.concatenate([lm.tokens(b)[0][:-1] for w in names for b in lm.blocks(pa.array([w]))])).tolist(), strict=True))
    cls = {w: int(v.of_hot[i]) for w, i in place.items()}
    r, q, b, c1, c2 = (model.classes.w[x].astype(float) for x in ("R", "Q", "b", "C1", "C2"))
    for d, t in rows:
        total, one, two = 0.0, lm.START, lm.START
        for w in [*lowered(t), None]:
            c = lm.END if w is None else cls.get(w, lm.RARE)
            score = (r[one] @ c1 + r[two] @ c2) @ q.T + b
            total += score[c] - math.log(sum(math.exp(x) for x in score[lm.END :]))
            if c == lm.RARE:
                total += math.log((count[w] + 1) / (rare_n + rare_v + 1))
            elif c != lm.END:
                own = {x: (r[one] @ c1) @ model.within.q[place[x]].astype(float) + math.log(known[x]) for x in names if cls[x] == c}
                total += own[w] - math.log(sum(map(math.exp, own.values())))
            one, two = c, one
        assert got[d] == pytest.approx(total / math.log(10), rel=1e-4), d


def test_lm_partitions_and_gain(spark, data):
    """Scores don't depend on how the table is cut, and held-out texts gain over the base."""
    docs = spark.read.parquet(f"{data.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    got = [{r.doc_id: (r.score, r.base_score, r.n_tokens, r.held_out) for r in lm.scores(docs.repartition(n)).collect()} for n in (1, 13)]
    for d, (score, base, *_) in got[0].items():
        assert got[1][d][0] == pytest.approx(score, rel=1e-6) and got[1][d][1] == pytest.approx(base)
    held = [x for x in got[0].values() if x[3]]
    assert sum(x[0] - x[1] for x in held) / sum(x[2] for x in held) > 0.2


def test_lm_normalised_and_gradient():
    rng = np.random.default_rng(0)
    model = lm.LogBilinear(np.array([0, 0.2, 0.3, 0.25, 0.25]), 4)
    one, two = np.array([0, 1, 2, 3, 4]), np.array([0, 0, 3, 2, 4])
    t = rng.integers(1, 5, 4000)
    c1 = np.roll(t, 1)
    t = np.where(rng.random(4000) < 0.8, 1 + c1 % 4, t)  # each class mostly follows from the one before
    c2 = np.roll(t, 2)
    cells, counts = np.unique((c2 * 25 + c1 * 5 + t).astype(np.uint64), return_counts=True)
    for _ in range(10):
        model.fit(cells, counts)
    model.ready()
    p = np.stack([np.exp(model.log_probability(np.full(5, w), one, two)) for w in range(1, 5)])
    assert p.sum(0) == pytest.approx(np.ones(5), abs=1e-4)
    seen = model.log_probability(t, c1, c2).mean()
    assert seen > np.log(model.p[t] / model.p.sum()).mean() + 0.3


def test_lm_edges(clashing, empty):
    rows = lm.scores(clashing, single=8, clusters=8).collect()
    assert len(rows) == len(EDGE) and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert sorted(str((r.doc_id, r.n_tokens)) for r in rows) == sorted(str((d, len(lowered(t)) + 1)) for d, t, *_ in EDGE)
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.n_tokens), set()).add((r.score, r.base_score))
    assert all(len(x) == 1 for x in by.values())  # repeated rows
    assert lm.scores(empty, single=8, clusters=8).count() == 0


def test_index():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2))
    index = lm.Index(rng.permutation(keys))
    assert (index.find(keys) == np.arange(len(keys))).all() and (index.find(keys + np.uint64(1)) == -1).all()
    assert (lm.Index(keys[:0]).find(keys[:3]) == -1).all()


def test_pipeline(spark, data):
    """Each stage against its operator's decisions, worked out by brute force where they have one."""
    import corpus_pipeline as C
    from factloom.llm import decontaminate, linedup, quality
    from factloom.llm.shared import written

    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = written(C.STAGES[0][1](spark, docs, data), "t")
    verdict = {r.doc_id for r in quality.quality_rules(docs, spark.read.parquet(f"{data}/labels.parquet")).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict
    lines = written(C.STAGES[1][1](spark, kept, data), "t")
    want = {r.doc_id: r.text for r in linedup.dedup_lines(kept).collect() if not r.removed_lines or r.removed_lines < r.n_lines}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    near = written(C.STAGES[2][1](spark, lines, data), "t")
    brute = brute_similar([(r.doc_id, r.text) for r in lines.collect()])
    assert {r.doc_id for r in near.collect()} == {d if not n else c for d, n, _, c in brute}
    clean = written(C.STAGES[3][1](spark, near, data), "t")
    leaked = {r.doc_id for r in decontaminate.leaks(near, spark.read.parquet(f"{data}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect()} - leaked
    mix = C.STAGES[4][1](spark, clean, data).collect()
    taken = {r.doc_id: r.taken // r["size"] for r in mixing.source_mix(clean).collect() if r["size"]}
    assert Counter(r.doc_id for r in mix) == Counter({d: n for d, n in taken.items() if n})
    for stage in (kept, lines, near, clean):
        assert stage.columns == docs.columns
    assert Counter((r.doc_id, r["copy"]) for r in C.run(spark, data).collect()) == Counter((r.doc_id, r["copy"]) for r in mix)


def test_pipeline_edges(spark, data, edge, empty):
    import corpus_pipeline as C

    want = [set(), {1, 2, 3, 4, 5, None, 6, 7, 8, 9}, None, {1, 2, 3, 4, 5, None, 6, 7, 8, 9, 10}, None]
    for (name, stage), ids in zip(C.STAGES, want, strict=True):
        got = stage(spark, edge, data)
        if ids is not None:
            assert {r.doc_id for r in got.collect()} == ids, name
        assert set(edge.columns) <= set(got.columns)
        assert stage(spark, empty, data).count() == 0
    brute = brute_similar([(d, t) for d, t, *_ in EDGE])
    assert {r.doc_id for r in C.near_duplicates(spark, edge, data).collect()} == {c for _, n, _, c in brute if n} | {d for d, n, *_ in brute if not n}
    mixed = [x for _, x in sorted((str(r.doc_id), r.doc_id) for r in C.mixing(spark, edge, data).collect())]
    assert Counter(mixed) == Counter(r.doc_id for r in mixing.source_mix(edge).collect() for _ in range(r.taken // r["size"] if r["size"] else 0))
