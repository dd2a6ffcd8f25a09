"""BPE, packing, toxicity, licences and quotations on small rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hitframe.llm import bpe, licenses, packing, quotations, toxicity
from hitframe.llm.common import tokenizer_path

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
DOC = "doc_id long, text string, ids string, piece string, score string, _rank long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "i", "p", "s", 1) for i, t in rows], DOC)


TEXTS = [
    None, "", " ", "Hello, world! it's 2026", "a<|endoftext|>b<|startoftext|>", "<|", "ÀÉî ß µ ª ½²", "\x00'LL",
    "naïve é Σς İ", "日本語 テキスト", "🙂👍🏽", "\x1c\x85　 ", "x" * 3000, "ab " * 2000, "é" * 700, "\n\n\t a",
]

# --- BPE --------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def test_encode_and_decode_equal_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (3, "again")]
    out = bpe.encode_texts(docs(spark, rows), WORD).collect()
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i, tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in out) == want
    assert bpe.encode_texts(docs(spark, []), WORD).count() == 0


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(text=st.text(max_size=60) | st.text(st.characters(max_codepoint=255), max_size=80))
def test_any_text_encodes_as_the_library_does(library, text):
    assert bpe.word_bpe(WORD).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_long_words_merge_as_short_ones():
    coder, rnd = bpe.WordBpe(WORD), random.Random(3)
    for _ in range(60):
        word = "".join(rnd.choice("aeinrst") for _ in range(rnd.randint(2, 200)))
        bounds = [*range(len(word)), len(word) + len(coder.end)]
        marked = word + coder.end
        assert coder._by_heap(marked, list(bounds)) == coder._by_rank_array(marked, list(bounds))


# --- packing ----------------------------------------------------------------


def test_pieces_and_places(spark):
    library = Tokenizer.from_file(BYTE)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, "word " * (i * 7 % 90)) for i in range(80)]
    out = packing.pack_documents(docs(spark, rows), BYTE, capacity=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for n, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length])
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(part))
            assert r.length == 64 or n == 0
            at += r.length
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64


def test_packing_repeated_null_and_no_rows(spark):
    rows = [(1, "same"), (1, "same"), (None, "same"), (None, None)]
    out = packing.pack_documents(docs(spark, rows), BYTE).collect()
    assert Counter(r.doc_id for r in out) == Counter({1: 2, None: 2})
    assert len({(r.sequence_id, r.offset) for r in out}) == 4
    assert packing.pack_documents(docs(spark, []), BYTE).count() == 0


def test_plan_uses_every_length_and_exact_sums_first():
    rnd = random.Random(8)
    for _ in range(20):
        counts = Counter(rnd.choice([rnd.randint(1, 64), 50, 7]) for _ in range(rnd.randint(1, 2000)))
        plan = packing.packing_plan(counts, 64)
        used = Counter()
        for lengths, copies in plan:
            assert copies > 0 and sum(lengths) <= 64
            for x in lengths:
                used[x] += copies
        assert used == counts
        bins = sum(copies for _, copies in plan)
        assert bins <= 1.25 * -(-sum(x * n for x, n in counts.items()) // 64) + 1
    assert packing.packing_plan({40: 5, 24: 5}, 64) == [((40, 24), 5)]
    assert packing.packing_plan({30: 2, 20: 2, 14: 2}, 64) == [((30, 20, 14), 2)]
    assert packing.packing_plan({31: 2, 19: 2, 10: 2, 4: 2}, 64) == [((31, 19, 10, 4), 2)]


def test_ids_come_along_if_asked(spark):
    out = packing.token_pieces(docs(spark, [(1, "a b c")]), BYTE, capacity=2, with_ids=True).collect()
    whole = [x for r in sorted(out, key=lambda r: r.piece) for x in r.ids]
    assert whole == [*Tokenizer.from_file(BYTE).encode("a b c").ids, 2]


# --- toxicity ---------------------------------------------------------------


def test_block_max_search_is_exact():
    rnd = random.Random(2)
    idf = {t: 1 + rnd.random() for t in range(30)}
    counts = [{rnd.randrange(30): rnd.randint(1, 4) for _ in range(rnd.randint(1, 6))} for _ in range(400)]
    vectors = [toxicity.unit_vector(c, idf) for c in counts]
    index = toxicity.BlockMaxIndex(list(range(400)), [0] * 400, vectors, idf, block=16)
    for _ in range(60):
        query = toxicity.unit_vector({rnd.randrange(30): 1 for _ in range(4)}, idf)
        scores = sorted((sum(query[t] * v.get(t, 0) for t in query) for v in vectors), reverse=True)
        got = [s for s, _ in index.nearest(query, 10)]
        want = [min(1.0, s) for s in scores if s > 0][:10]
        assert got == pytest.approx(want)


def test_isotonic_pools_what_is_out_of_order():
    steps = toxicity.isotonic([0.1, 0.2, 0.3, 0.4], [0, 1, 0, 1], [1, 1, 1, 1])
    assert steps == [(0.1, 0.0), (0.3, 0.5), (0.4, 1.0)]
    assert toxicity.isotonic([0.5, 0.5], [0, 1], [3, 1]) == [(0.5, 0.25)]


def toxic_rows(seed=6, count=600):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = ["w" + rnd.choice("abcdefg") * rnd.randint(1, 3) for _ in range(rnd.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(6):
                words[rnd.randrange(len(words))] = rnd.choice(["badword", "nastything", "vileness"])
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = toxic_rows()
    rows += [(None, "badword badword vileness"), (9000, None), (9001, ""), (3, "badword vileness nastything " * 3)]
    known = spark.createDataFrame(labels + [(None, 1), (0, None)], "doc_id long, toxic long")
    out = toxicity.score(docs(spark, rows), known).collect()
    assert len(out) == len(rows)
    for r in out:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    by_id = defaultdict(list)
    for r in out:
        by_id[r.doc_id].append(r)
    right = [by_id[i][0].predicted == int(i % 6 == 0) for i in range(600) if i != 3]
    assert sum(right) / len(right) > 0.97
    assert by_id[None][0].predicted == 1
    assert by_id[9000][0].predicted == by_id[9001][0].predicted == 0
    assert sorted(r.predicted for r in by_id[3]) == [0, 1]


def test_scores_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic long")
    out = toxicity.score(docs(spark, [(1, "text"), (2, None)]), none).collect()
    assert [r.score for r in out] == [0.0, 0.0]
    rows, labels = toxic_rows(count=30)
    assert toxicity.score(docs(spark, []), spark.createDataFrame(labels, "doc_id long, toxic long")).count() == 0


# --- licences ---------------------------------------------------------------


def test_notices_in_any_spelling(spark):
    mit = licenses.NOTICES[-2][1]
    rows = [
        (1, "some text\nreleased under the  MIT Licence"),
        (2, "Copyright (c) 2020 Somebody\nAll rights reserved.\n" + mit.upper()),
        (3, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache Licence, version 2.0\nLicensed under cc by nc 4.0"),
        (4, None), (5, ""), (6, "unlicensed"), (7, "Released under the MIT License."), (7, "Licensed under CC BY 4.0."),
        (None, "Licensed under CC BY 4.0."), (8, "x" * 100_000),
    ]
    out = licenses.license_scan(docs(spark, rows), licenses.known_licenses(spark)).collect()
    got = {r.doc_id: (r.n_notices, r.licenses, r.whole_text) for r in out}
    assert len(out) == 9
    assert got[1] == (1, "MIT", None)
    assert got[2] == (0, "", "MIT")
    assert got[3] == (3, "Apache-2.0,CC-BY-NC-4.0", None)
    assert got[4] == got[5] == got[6] == got[8] == (0, "", None)
    assert got[7][:2] == (2, "CC-BY-4.0,MIT")
    assert got[None] == (1, "CC-BY-4.0", "CC-BY-4.0")
    assert licenses.license_scan(docs(spark, []), licenses.known_licenses(spark)).count() == 0


def test_full_texts_with_and_without_headings(spark):
    mit = licenses.NOTICES[-2][1]
    full = {p.stem: p.read_text() for p in sorted(licenses.TEXTS.glob("*.txt"))}
    bsd = dict(licenses._short_texts())["BSD-3-Clause"]
    wrapped = mit.replace("AUTHORS OR COPYRIGHT", "AUTHORS OR\nCOPYRIGHT")
    rows = list(enumerate([
        "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + mit,
        "The MIT License (MIT)\nCopyright 2020 Somebody\n" + wrapped,
        "Copyright © 2019 Somebody\nAll rights reserved.\n\n" + bsd,
        mit.replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT THIEVES"),
        full["Apache-2.0"].split("END OF TERMS")[0],
        *full.values(),
    ]))
    out = licenses.license_scan(docs(spark, rows), licenses.known_licenses(spark)).collect()
    got = [r.whole_text for r in sorted(out, key=lambda r: r.doc_id)]
    assert got == ["MIT", "MIT", "BSD-3-Clause", None, "Apache-2.0", *full]
    assert {"Apache-2.0", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "CC0-1.0", "Unlicense"} <= {*full}


# --- quotations -------------------------------------------------------------


def test_passages_by_level():
    text = "On Monday Ann wrote:\n> first line\n> goes on\n>> deeper\n> > deeper still\n>\n> second\n\nmy answer\n  two\n\nthird"
    assert quotations.passages(text) == [
        (1, "first line\ngoes on"), (2, "deeper\ndeeper still"), (1, "second"), (0, "my answer\n  two"), (0, "third")
    ]
    assert quotations.passages(None) == quotations.passages("") == []


def brute_threads(rows):
    first, parent, linked = {}, {}, Counter()
    parsed = [(c, t, r, quotations.passages(x)) for c, t, r, x in rows]
    for c, t, _, parts in parsed:
        for level, p in parts:
            if not level:
                key = c, quotations.passage_hash(p)
                first[key] = min(first.get(key, t), t)
    for c, t, _, parts in parsed:
        for level, p in parts:
            said = first.get((c, quotations.passage_hash(p)))
            if level and said is not None and said < t:
                parent[c, t] = max(parent.get((c, t), said), said)
                linked[c, t] += 1

    def root(c, t, depth=0):
        return root(c, parent[c, t], depth + 1) if (c, t) in parent else (t, depth)

    groups = defaultdict(list)
    for c, t, r, parts in parsed:
        own = "\n\n".join(p for level, p in parts if not level)
        groups[c].append((*root(c, t), t, r, own, sum(1 for level, _ in parts if level)))
    out = Counter()
    for c, members in groups.items():
        members.sort(key=lambda m: (m[0], m[2], m[3], m[4]))
        for at, (top, depth, t, r, own, quotes) in enumerate(members, 1):
            out[c, t, r, parent.get((c, t)), top, depth, at, quotes, linked[c, t], own] += 1
    return out


CHAT = "conv_id long, turn long, role string, text string, content string, rank long"


def test_reply_order_equals_brute_force(spark):
    rnd, rows = random.Random(2), []
    for c in range(25):
        said = []
        for t in range(rnd.randint(1, 12)):
            own = f"Text {c} {t} says; some words\nline {rnd.randint(0, 3)}" if rnd.random() < 0.8 else "ok, thanks"
            parts = []
            if said and rnd.random() < 0.7:
                mark = rnd.choice(["> ", ">> ", "> > "])
                parts.append("\n".join(mark + x.upper() for x in rnd.choice(said).split("\n")))
            said.append(own)
            rows.append((c, t, rnd.choice(["user", "assistant"]), "\n".join([*parts, own])))
    rows += [(3, 0, "user", "repeated"), (3, 0, "user", "repeated"), (70, 1, "user", None)]
    df = spark.createDataFrame([(*r, "c", 9) for r in rows], CHAT)
    want = brute_threads([(c, t, r, x) for c, t, r, x in rows])
    assert Counter(map(tuple, quotations.link_quotations(df).collect())) == want


def test_trimmed_and_interleaved_quotes(spark):
    rows = [
        (1, 0, "user", "line one here\nline two here\nline three here\n\nlast words"),
        (1, 1, "user", "thanks\nline nine here"),
        (1, 2, "assistant", "> line one here\nyes\n> Line two here\n> line three here\nno"),
        (1, 3, "user", "> line one here\n> line three here\nskipped"),
        (1, 4, "user", "thanks\nother things"),
        (1, 5, "user", "> thanks\n> other things\n> never said\nno link"),
        (1, 6, "user", "> other things\n> thanks\nof two lines, the first said before"),
        (1, 7, "user", "> line nine here\n> line two here\nof two messages"),
        (1, 8, "user", "> later line\nlink to nothing"),
        (1, 9, "user", "later line\nand more"),
        (2, 1, "user", "> line two here\nanother conversation"),
    ]
    out = quotations.link_quotations(spark.createDataFrame([(*r, "c", 9) for r in rows], CHAT)).collect()
    got = {(r.conv_id, r.turn): (r.parent_turn, r.n_quotes, r.n_linked) for r in out if r.n_quotes}
    assert got == {
        (1, 2): (0, 2, 2), (1, 3): (0, 1, 1), (1, 5): (None, 1, 0), (1, 6): (4, 1, 1), (1, 7): (None, 1, 0),
        (1, 8): (None, 1, 0), (2, 1): (None, 1, 0),
    }


def test_quotations_of_rows_without_ids(spark):
    rows = [(None, 0, "user", "hi there"), (None, 1, None, "> Hi, there\nyes"), (1, None, "user", "x")]
    out = quotations.link_quotations(spark.createDataFrame([(*r, "c", 9) for r in rows], CHAT)).collect()
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth, r.position) for r in out}
    assert got == {(None, 0): (None, 0, 0, 1), (None, 1): (0, 0, 1, 2), (1, None): (None, None, 0, 1)}
    assert quotations.link_quotations(spark.createDataFrame([], CHAT)).count() == 0


def test_digest_columns_of_the_registered_query(spark):
    from hitframe.llm.queries import QUERIES

    rows = QUERIES["op8_bpe"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    library = Tokenizer.from_file(WORD)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), digest(" ".join(map(str, ids))), digest(decoded)
        )


def test_plans_never_need_more_than_best_fit(spark):
    rnd = random.Random(21)
    sequences = lambda plan: sum(copies for _, copies in plan)
    for _ in range(60):
        capacity = rnd.choice([64, 200])
        counts = {rnd.randint(1, capacity): rnd.randint(1, 40) for _ in range(rnd.randint(1, 60))}
        plan = packing.packing_plan(counts, capacity)
        held = Counter()
        for lengths, copies in plan:
            assert sum(lengths) <= capacity and copies > 0
            for x in lengths:
                held[x] += copies
        assert held == Counter(counts)
        assert sequences(plan) <= sequences(packing._best_fit(Counter(counts), capacity))


def test_long_odd_lines_take_linear_time():
    import time

    blanks = " " * 1_000_000
    start = time.perf_counter()
    for line in (blanks + "x", blanks + "wrote:", "on " * 300_000 + "xwrote:", "a" * 1_000_000):
        quotations.passages(line + "\n> quoted")
    assert time.perf_counter() - start < 5
    assert quotations.passages("On Monday, A wrote:\n> q") == [(1, "q")]
    assert quotations.passages(" wrote:\t\n> q") == [(1, "q")]
    assert quotations.passages("rewrote:\n> q") == [(0, "rewrote:"), (1, "q")]


def test_license_sql_has_the_same_texts_and_rules(spark, tmp_path):
    import duckdb
    from compare import compare

    known = licenses._known_rows()
    rows = [(i, text) for i, (_, text) in enumerate(known)]
    rows += [
        (5000 + i, "MIT Licence\n\nCopyright (c) 2020 Someone, Inc.\n\n" + text.upper() if i % 2 else f"prose\n{text}\nprose")
        for i, (_, text) in enumerate(known[:60])
    ]
    rows += [(9000, "Copyright law is old.\n" + known[0][1]), (9001, "copyright holders\n" + known[-1][1]), (9002, None)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    out = licenses.license_scan(spark.read.parquet(path), licenses.known_licenses(spark))
    assert compare(out, con, licenses.oracle_sql()) == []
    found = {r.doc_id: r.whole_text for r in out.collect()}
    assert all(found[i] for i in range(len(known)))
