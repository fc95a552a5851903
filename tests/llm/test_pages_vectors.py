"""Operators on pages and vectors, the pipeline, and the registered queries."""

import base64
import gzip
import hashlib
import io
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stackweave.llm import bpe, exact_dedup, html, neighbours, oracles, warc
from stackweave.llm.queries import QUERIES
from stackweave.session import Scratch

SF = "/root/testdata/sf0.001"


# Neighbours


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 2), (4, 2)])
def test_hilbert_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    places = neighbours.hilbert(cells, bits)
    assert sorted(places) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(axis=1) == 1).all()


def clustered(rng, n, d=16):
    centres = rng.normal(size=(30, d)) * 3
    return centres[rng.integers(0, 30, n)] + rng.normal(size=(n, d)) * 0.4


def brute(ids, vectors, query, k=20):
    near = (vectors * vectors[query]).sum(axis=1)
    order = [j for j in np.lexsort((ids, -near)) if ids[j] != ids[query]][:k]
    return [(int(ids[j]), float(near[j])) for j in order]


def test_search_recall_and_ties(spark, rng):
    vectors = clustered(rng, 4000)
    vectors[7] *= 3
    vectors[1000:1400] = vectors[7]  # many copies: ties go to the smaller id
    ids = np.arange(4000) * 3
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, label int")
    vectors = vectors.astype(np.float32).astype(np.float64)
    found = neighbours.search(df, Scratch(spark, "t"), F.col("vec_id") % 20 == 0, block=512).toPandas()
    hits = total = 0
    for query, own in found.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and query not in own["vec_id"].tolist()
        want = brute(ids, vectors, int(np.flatnonzero(ids == query)[0]))
        hits += len({i for i, _ in want} & set(own["vec_id"]))
        total += 20
        pairs = list(zip(own["score"], own["vec_id"]))
        assert pairs == sorted(pairs, key=lambda p: (-p[0], p[1]))
        for score, vec in pairs:
            assert score == pytest.approx(float(vectors[vec // 3] @ vectors[query // 3]), abs=1e-9)
    assert total == 20 * (ids % 20 == 0).sum()
    assert hits / total >= 0.9
    tied = found[found.query_id == 3 * 1020].sort_values("rank")["vec_id"].tolist()
    assert tied == [21] + [3 * k for k in range(1000, 1019)]


def test_search_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0]), (3, [1.0, 1.0]), (40, None), (60, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.5]), (9, [])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, label string, score double")
    got = sorted(map(tuple, neighbours.search(df, Scratch(spark, "t"), F.col("vec_id") % 20 == 0).collect()))
    assert got == [(0, 1, 3, 1.0), (0, 2, 3, 1.0), (0, 3, 20, 0.0), (20, 1, 3, 1.0), (20, 2, 3, 1.0), (20, 3, 0, 0.0)]
    assert neighbours.search(df.limit(0), Scratch(spark, "t"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(df.where("vec_id = 3"), Scratch(spark, "t"), F.col("vec_id") % 20 == 0).count() == 0


# Archives


def archive(n, packed=True, seed=1):
    rng = random.Random(seed)
    parts = []
    for k in range(n):
        payload = bytes(rng.randrange(256) for _ in range(rng.randint(0, 900)))
        data = warc.record(k, f"http://x/{k}", payload, warc.payload_digest(payload), None, False)
        parts.append(warc.member(data) if packed else data)
    return parts


def read(data):
    found = list(warc.salvage(io.BytesIO(data)))
    assert sum(size for _, _, size, _ in found) == len(data)  # every byte is in a record or a gap
    return [f["record_id"] for kind, _, _, f in found if kind == "record"], [(at, size) for kind, at, size, _ in found if kind == "gap"]


def names(numbers):
    return [f"<urn:page:{k}>" for k in numbers]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_of_damaged_archives(packed, monkeypatch):
    parts = archive(12, packed)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()
    whole = b"".join(parts)
    assert read(whole) == (names(range(12)), [])
    for chunk in (64, 1 << 16):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        broken = bytearray(whole)
        broken[starts[4] + len(parts[4]) // 2] ^= 0x55  # a flipped byte
        got, gaps = read(bytes(broken))
        assert got == names([0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11]) and gaps == [(starts[4], len(parts[4]))]
        cut = whole[: starts[7] + 9] + whole[starts[9] :]  # a torn record and a lost one
        got, gaps = read(cut)
        assert got == names([0, 1, 2, 3, 4, 5, 6, 9, 10, 11]) and gaps == [(starts[7], 9)]
        junk = b"\x1f\x8b\x08WARC/1.1\r\njunk" + whole + b"\x00" * 5
        got, gaps = read(junk)
        assert got == names(range(12)) and [g[1] for g in gaps] == [17, 5]
        assert read(whole[:-3])[0] == names(range(11))
    assert read(b"") == ([], []) and read(b"no archive") == ([], [(0, 10)])


def test_salvage_checks_digests():
    payload = b"abc"
    data = warc.record(1, "u", payload, warc.payload_digest(b"other"), None, False)
    assert [x[3] for x in warc.salvage(io.BytesIO(data))] == ["payload digest differs"]
    data = warc.record(1, "u", payload, warc.payload_digest(payload), None, False).replace(b"Content-Length: 8", b"Content-Length: 7")
    assert [x[0] for x in warc.salvage(io.BytesIO(data))] == ["gap"]


def test_members_are_plain_gzip():
    assert gzip.decompress(b"".join(archive(3))) == b"".join(archive(3, packed=False))


ODD_PAGES = [
    (1, "http://a", "same"), (9, "http://b", "same"), (5, None, "same"), (2, "", None), (3, "http://c d\r\nX: y", ""), (4, "u" * 70_000, "é🙂\r\n\r\nWARC/1.1\r\n"),
    (6, "http://e", "x" * 300_000), (None, "http://n", "only null"), (None, "http://n", "same"), (7, "http://f", "one"), (7, "http://f", "one"),
]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "clash", 0) for r in ODD_PAGES], "page_id long, url string, html string, same string, owner int").repartition(3)
    top = {}
    for page, _, text in ODD_PAGES:
        if page is not None:
            top[text or ""] = max(top.get(text or "", page), page)
    want = []
    for page, _, text in ODD_PAGES:
        data, owner = (text or "").encode(), top.get(text or "")
        response = page == owner or owner is None
        want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if response else "revisit", None if response else owner))
    got = warc.round_trip(pages, Scratch(spark, "t"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0), Scratch(spark, "t")).count() == 0


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages, Scratch(spark, "t"), least=3).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_are_listed_closed_at_their_size_and_salvaged_by_spark(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"text {k} " * 50) for k in range(60)], "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/archives"
    written = warc.write_archives(warc.owners(pages), folder, archive_bytes=4000).collect()
    assert len(written) > 3
    listed = warc.list_archives(spark, folder)
    assert listed.count() == len(written)
    victim = written[0]["path"].removeprefix("file://")
    with open(victim, "r+b") as file:
        file.seek(40)
        file.write(b"????")
    found = warc.read_archives(listed)
    assert found.where("kind = 'gap'").count() == 1
    assert found.where("kind = 'record' and payload is not null").count() == 59


# HTML

CASES = [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"), ("<title>t</title><style>s</style><script>x='</p>'</script>v<!-- c --><noscript>n</noscript>", "v"),
    ("<p>x<span hidden>no</span>y<b style='Display : NONE'>no<i>no</i></b>z", "xyz"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=9><li>a<li value=20>b<li>c", "9. a\n20. b\n21. c"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"), ("<table><td>x<td>y</table>", "x  y"),
    ("<table><caption>C</caption><thead><tr><th>h<th>i<tbody><tr><td rowspan=2>r<td>1<tr><td>2</table>", "C\nh  i\nr  1\n   2"),
    ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide  z\na  b  c"), ("<table><tr><td><table><tr><td>in</table><td>out</table>", "in  out"),
    ("<pre>a\n  b</pre>c", "a\n  b\n\nc"), ("<blockquote>q</blockquote>r", "> q\n\nr"), ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("&lt;b&gt; &amp; &copy; &#233;", "<b> & © é"), ("<details><summary>s</summary>no<p>no</p></details>yes", "s\nyes"), ("<details open><summary>s</summary>in</details>", "s\nin"),
    ("<select><option>a<option>b</select>", "a\nb"), ("</div></p>x</span>", "x"), ("<td>lost</td>", "lost"), ("a<b>b<p>c</b>d", "ab\n\ncd"), ("<h1>A<h2>B", "A\n\nB"),
]


@pytest.mark.parametrize("source,text", CASES)
def test_visible_text(source, text):
    assert html.visible_text(source) == text


def test_deep_and_odd_markup_ends():
    assert html.visible_text("<div>" * 5000 + "x") == "x"
    assert html.visible_text("<b>" * 2000 + "<p>" * 2000 + "x") == "x"
    assert "x" in html.visible_text("<table>" * 300 + "x")
    for text in ("<", "<a", "<a href='", "&", "<!--", "<![CDATA[", "<!doctype", "</", "<table><tr><td>" * 200):
        html.visible_text(text)


def test_extract_is_a_map(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "u", "")], "page_id long, url string, html string")
    got = html.extract(pages.withColumn("text", F.lit("clash")))
    assert sorted(map(tuple, got.select("page_id", "text").collect()), key=repr) == sorted([(1, "a"), (1, "a"), (None, ""), (2, "")], key=repr)
    assert html.extract(pages.limit(0)).count() == 0


# Queries and pipeline


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_html_query_covers_all_pages(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op5_html_text"](spark, SF).collect()
    assert sorted(pages) == sorted(r["page_id"] for r in found)
    assert all(r["text"] == html.visible_text(pages[r["page_id"]]) for r in found)


def test_pipeline_stages(spark):
    """Each stage against plain Python on what the stage before wrote."""
    from test_documents import normal, plain_groups, plain_print

    scratch = Scratch(spark, "t")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    written = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, SF))
        written.append(docs)
    start, good, unique, apart, mixed, encoded = [w.collect() for w in written]
    assert all(w.columns == written[0].columns for w in written[1:5])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    known = [r["doc_id"] for r in start if r["doc_id"] in labels]
    assert np.mean([(i in kept) == bool(labels[i]) for i in known]) > 0.95
    firsts = {}
    for r in sorted(good, key=lambda r: r["doc_id"]):
        firsts.setdefault(normal(r["text"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in unique) == sorted(firsts.values())
    groups = plain_groups([(r["doc_id"], plain_print(r["text"])) for r in unique], 4)
    assert sorted(r["doc_id"] for r in apart) == sorted(set(groups))
    texts = {r["doc_id"]: r["text"] for r in apart}
    assert all(r["text"] == texts[r["doc_id"]] for r in mixed) and len(mixed) > 0
    words = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    assert words(mixed) == pytest.approx(words(apart), rel=0.25)
    coder = bpe.tokenizer("/opt/tokenizers/byte_bpe_50k.json")
    assert sorted(r["doc_id"] for r in encoded) == sorted(r["doc_id"] for r in mixed)
    assert all(coder.decode(np.array(r["ids"], "<u4").tobytes()) == texts[r["doc_id"]] for r in encoded)


def test_exact_dedup_sql(spark):
    import duckdb
    from compare import connect, differences

    assert duckdb and differences(exact_dedup.dedup(spark.read.parquet(f"{SF}/documents.parquet"), Scratch(spark, "t")), connect(SF), oracles.EXACT_DEDUP) == []


def test_neighbours_with_equal_products(spark):
    """Different vectors with equal products rank by id, in every block; so do rows that repeat an id."""
    rows = [(0, [1.0, 0.0, 0.0])] + [(k, [2.0, float(k), float(-k * k % 97)]) for k in range(1, 401)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = neighbours.search(table, Scratch(spark, "near"), F.col("vec_id") == 0, reach=1.0, block=64)
    assert [r["vec_id"] for r in found.orderBy("rank").collect()] == list(range(1, 21))
    again = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], table.schema)
    found = neighbours.search(again, Scratch(spark, "near"), F.col("vec_id") == 2)
    assert [(r["vec_id"], r["score"]) for r in found.orderBy("rank").collect()] == [(1, 1.0), (1, 1.0), (1, 0.5), (3, 0.0)]
    found = neighbours.search(again, Scratch(spark, "near"), F.col("vec_id") == 1).collect()
    assert len(found) == 12 and sum(r["vec_id"] == 1 for r in found) == 6


def test_neighbours_of_mixed_lengths_and_overflow(spark):
    rows = [(1, [1e200, 1.0]), (2, [1e200, 0.0]), (3, [-1e200, 5.0]), (4, [1.0, 1.0]), (5, [1.0, 2.0, 3.0]), (6, [3.0, 2.0, 1.0]), (7, [1e200, -1e200]), (8, [5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.search(table, Scratch(spark, "near"), F.lit(True))
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    inf = float("inf")
    assert got[2] == [(1, inf), (7, inf), (4, 1e200), (3, -inf)]
    assert got[5] == [(6, 10.0)] and got[6] == [(5, 10.0)] and 8 not in got


def test_archive_with_endless_headers_and_lengths(tmp_path):
    """Headers of any length are read once; lengths that lead nowhere cost nothing."""
    import io
    import time
    long = warc.record(1, "http://a/" + "x" * 20_000_000, b"<p>one", warc.payload_digest(b"<p>one"), None, False)
    second = warc.record(2, None, b"two", warc.payload_digest(b"two"), None, False)
    for packed in (True, False):
        data = b"".join(map(warc.member, (long, second))) if packed else long + second
        found = list(warc.salvage(io.BytesIO(data)))
        assert [(kind, what["record_id"]) for kind, _, _, what in found] == [("record", "<urn:page:1>"), ("record", "<urn:page:2>")]
    big = warc.record(3, None, b"y" * 30_000_000, warc.payload_digest(b"y" * 30_000_000), None, False)
    for wrong in (b"Content-Length: 99999999999", b"Content-Length: 29000000", "Content-Length: ٣".encode()):
        head, _, tail = second.rpartition(b"Content-Length: ")
        broken = head + wrong + tail[tail.index(b"\r\n"):]
        start = time.time()
        found = list(warc.salvage(io.BytesIO(broken + second + big)))
        assert [kind for kind, *_ in found] == ["gap", "record", "record"] and found[1][3]["record_id"] == "<urn:page:2>"
        assert time.time() - start < 5


def test_many_archives_are_many_tasks(spark, tmp_path):
    names = []
    for k in range(12):
        (tmp_path / f"{k}.warc").write_bytes(warc.record(k, None, b"p", warc.payload_digest(b"p"), None, False))
        names.append((f"file://{tmp_path}/{k}.warc", 1))
    found = warc.read_archives(spark.createDataFrame(names, "path string, bytes long").coalesce(1))
    assert found.select(F.spark_partition_id()).distinct().count() > 4 and found.count() == 12
