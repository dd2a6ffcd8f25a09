"""WARC archives with their index, Hamming search, the pipeline and the registry."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from hitframe import session
from hitframe.llm import hamming_search, queries, warc

SF = "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string, file string, offset string, _first long"

# --- WARC -------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(*r, "f", "o", 3) for r in rows], PAGE)


def odd_pages(seed, count=400):
    rnd = random.Random(seed)
    urls = [None, "", "no url", "http://h.com/q?x#f", "https://u@W.Example.com:8080", "http://[bad\r\nX: y"]
    htmls = [None, "", "a", "é\r\n\r\nWARC/1.1", "x" * 5000, "same"]
    rows = [
        (i, rnd.choice([*urls, f"http://a{i % 7}.example.com/{i % 5}"]), rnd.choice([*htmls, str(i)]))
        for i in range(count)
    ]
    return rows + [(None, "http://a/", "a"), (None, "http://a/", None), (None, "http://a/", "same"), (None, None, "only null ids"), (7000, "http://a/", "y" * 300_000)]


def expected_captures(rows, min_bytes=0):
    first, out = {}, Counter()
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    for p, _, h in rows:
        payload = (h or "").encode()
        lead = first.get(h or "") if len(payload) >= min_bytes else p
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = lead is not None and lead != p
        out[p, len(payload), digest, "revisit" if revisit else "response", lead if revisit else None] += 1
    return out


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_pages_survive_the_round_trip(spark, min_bytes):
    rows = odd_pages(min_bytes)
    out = warc.archive_pages(pages(spark, rows), min_bytes=min_bytes)
    assert Counter(map(tuple, out.collect())) == expected_captures(rows, min_bytes)


def test_no_pages(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_lookups_over_many_blocks_and_shards(spark):
    """Blocks of three captures; one key fills several blocks and both shards."""
    rows = [(i, "http://hot.example.com/" if i % 2 else f"http://h{i}.org/p", f"t{i}") for i in range(60)]
    archives, place = session.scratch_path(spark, "warc"), session.scratch_path(spark, "cdx")
    captures = warc.write_archives(pages(spark, rows), archives)
    index = warc.build_index(captures, place, archives, block=3)
    wanted = pages(spark, [rows[5], rows[5], rows[8], (999, "http://h8.org/p", ""), (4, "http://none/", "")])
    out = warc.read_captures(wanted, index, with_payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload)) for r in out) == [(5, b"t5"), (8, b"t8")]


def test_archives_are_plain_warc(spark):
    archives = session.scratch_path(spark, "warc")
    rows = [(1, "http://a.b/c d", "<p>é</p>"), (2, "http://a.b/", "<p>é</p>")]
    files = [r.file for r in warc.write_archives(pages(spark, rows), archives).select("file").distinct().collect()]
    fs, base = warc._open(archives)
    whole = b""
    for name in files:
        data = fs.open_input_stream(f"{base}/{name}", compression=None).read()
        while data:
            member = zlib.decompressobj(wbits=31)
            whole += member.decompress(data)
            data = member.unused_data
    assert whole.count(b"WARC/1.1\r\n") == 2 and whole.endswith(b"\r\n\r\n")
    assert b"WARC-Target-URI: http://a.b/c%20d\r\n" in whole
    assert b"WARC-Type: revisit\r\n" in whole and whole.count("<p>é</p>".encode()) == 1


def test_damage_is_noticed():
    good = warc.record(1, "http://a/", b"payload", 1, True, "2020-01-01T00:00:00Z")
    bad = zlib.decompress(good, wbits=31).replace(b"payload", b"pAyload")
    squeeze = zlib.compressobj(wbits=31)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(squeeze.compress(bad) + squeeze.flush())


def test_url_keys_put_hosts_of_a_site_together():
    keys = ["http://www.a.com/x?q=1#f", "//A.com", "https://me@b.a.com:99/", "mailto:x", "", None]
    assert [warc.url_key(u) for u in keys] == [
        "com,a,www)/x?q=1", "com,a)/", "com,a,b:99)/", "mailto:x", "", ""
    ]


# --- search -----------------------------------------------------------------

VECTOR = "vec_id long, embedding array<float>, label int, code string, q long, distance double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", 1, 0.5) for i, v in rows], VECTOR)


def brute_search(rows, k):
    codes = {i: sum((x is not None and x > 0) << n for n, x in enumerate(v)) for i, v in rows if None not in (i, v)}
    out = set()
    for q in codes:
        if q % 20 == 0:
            found = sorted(((codes[q] ^ codes[i]).bit_count(), i) for i in codes if i != q)[:k]
            out |= {(q, r + 1, i, d) for r, (d, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("sample", [8192, 5])
def test_search_equals_brute_force(spark, monkeypatch, sample):
    """A hot code with many copies, near codes, nulls; a tiny sample gives loose bounds."""
    monkeypatch.setattr(hamming_search, "SAMPLE", sample)
    rnd = random.Random(sample)
    centre = [rnd.choice([-1.0, 1.0]) for _ in range(64)]
    near = lambda n: [-x if rnd.random() < n / 64 else x for x in centre]
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(64)]) for i in range(150)]
    rows += [(200 + i, list(centre)) for i in range(60)] + [(300 + i, near(4)) for i in range(60)]
    rows += [(400, None), (None, centre), (401, []), (420, [0.0] * 64), (440, [None] * 64)]
    out = hamming_search.nearest_codes(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=7)
    assert set(map(tuple, out.collect())) == brute_search(rows, 7)


def test_search_with_too_few_rows(spark):
    rows = [(0, [1.0] * 64), (1, [-1.0] * 64), (20, [1.0] * 64)]
    out = hamming_search.nearest_codes(vectors(spark, rows), F.col("vec_id") % 20 == 0)
    assert set(map(tuple, out.collect())) == brute_search(rows, 10)
    assert hamming_search.nearest_codes(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_vectors_beyond_64_elements_are_refused(spark):
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException, match="more than 64"):
        hamming_search.nearest_codes(vectors(spark, [(0, [1.0] * 65)]), F.col("vec_id") % 20 == 0)


# --- registry and pipeline --------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE_SQL[name]) == []


def test_every_operator_is_registered_once():
    assert Counter(n.split("_")[0] for n in queries.QUERIES) == Counter(f"op{n}" for n in range(1, 14))


def test_pipeline_stages_one_after_another(spark):
    import corpus_pipeline as pipeline

    from hitframe.sources.stages import materialise

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf), name)
        assert docs.columns == columns
        assert docs.select("doc_id").distinct().count() == docs.count() <= before
        before = docs.count()
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == kept
    assert len(kept) > 100


def test_texts_stay_in_place_for_a_few_removed_keys(spark):
    """Also where the list of keys cannot be told to be short from its plan."""
    import corpus_pipeline as pipeline

    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('x', 9) AS text")
    gone = spark.range(10**7).where("id % 1000000 = 7").withColumnRenamed("id", "doc_id")
    out = pipeline._without(docs, gone)
    assert out.count() == 99 and out.where("doc_id = 7").isEmpty()
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_pipeline_stages_keep_odd_rows(spark):
    """No ids, repeated ids, empty texts and columns of clashing names; then nothing at all."""
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    clean = "a plain line of words that nobody else has said so far in this table"
    rows = [
        (None, clean + " one", "en"), (None, None, None), (5, "", "en"), (6, None, "de"), (7, clean + " two", "en"),
        (7, "another text under the same number, as plain and long as the first", "en"), (8, clean + " two", "fr"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _key string, _row long, _id string"
    docs = spark.createDataFrame([(i, t, g, "src", len(t or ""), "k", 1, "x") for i, t, g in rows], schema)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        kept = Counter((r.doc_id, r.text) for r in out.collect())
        assert kept <= Counter((i, t) for i, t, _ in rows) + Counter({(8, ""): 1})
        assert {(None, rows[0][1]), (None, None), (5, ""), (6, None), (7, rows[4][1])} <= kept.keys()
        assert all(r["_key"] == "k" and r["_id"] == "x" for r in out.collect())
        assert stage(spark, docs.limit(0), sf).count() == 0
    packed = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(i for i, _, _ in rows)
    assert pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0
