"""Exact dedup, line dedup, n-gram join and union-find against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hitframe.llm import exact_dedup, line_dedup, ngram_join
from hitframe.llm.components import components
from hitframe.session import scratch_mark

DOC = "doc_id long, text string, source string, _id string, n long"


def docs(spark, rows):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", "x", 7) for i, t in rows], DOC)


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- union-find -------------------------------------------------------------


def test_components_of_chains_hubs_and_cycles(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)]
    links += [(300, 301), (301, 302), (302, 300), (5, 5)]
    links += [(rnd.randrange(400, 500), rnd.randrange(400, 500)) for _ in range(60)]
    rnd.shuffle(links)
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == union_find({n for pair in links for n in pair}, links)


def test_components_without_links(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert components(empty).count() == 0
    assert components(spark.createDataFrame([(None, 1), (2, None)], "a long, b long")).count() == 0


# --- exact dedup ------------------------------------------------------------

COPIES = [
    (5, "a b"), (3, "ab"), (9, " a b\n"), (8, "\ta b "), (1, "c"), (2, None), (4, ""), (6, " \x0b\x0c\r"),
    (7, "é"), (10, "é"), (11, " c"), (12, "x" * 50_000), (13, "x " * 50_000), (None, "c"), (1, "c"),
]


def expected_dedup(rows):
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[strip(t)].append((-len(t or ""), i is None, i, t))
    out = []
    for i, t in rows:
        group = groups[strip(t)]
        keep = min(group, key=lambda g: g[:3])[2]
        digest = hashlib.sha256(strip(t).encode()).hexdigest()
        out.append((i, keep, len(group), i == keep, digest))
    return Counter(out)


@pytest.mark.parametrize("digest", [None, lambda c: F.substring(F.sha2(c, 256), 1, 1)])
def test_exact_dedup(spark, digest):
    """The one-digit digest makes unequal texts collide; their contents still differ."""
    rows = COPIES + [(100 + i, f"t{i % 40}" + " " * (i % 3)) for i in range(200)]
    extra = {"digest": digest} if digest else {}
    out = exact_dedup.exact_dedup(docs(spark, rows), **extra)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = expected_dedup(rows)
    if digest:
        want = Counter({(*k[:4], k[4][0]): 0 for k in want}) + Counter(
            x for k, n in want.items() for x in [(*k[:4], k[4][0])] * n
        )
    assert Counter(map(tuple, out.collect())) == want


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


# --- line dedup -------------------------------------------------------------


def brute_lines(rows, threshold=0.8, k=line_dedup.SHINGLE):
    norm = lambda line: line.strip(" ").lower()
    first = {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        for at, line in enumerate(t.split("\n")):
            if len(norm(line)) >= line_dedup.MIN_CHARS or any(c.isalnum() for c in norm(line)):
                first.setdefault(norm(line), (i, at))
    lines = list(first)
    sets = [frozenset(x[a : a + k] for a in range(max(1, len(x) - k + 1))) for x in lines]
    links = [
        (a, b)
        for b in range(len(lines))
        for a in range(b)
        if min(len(lines[a]), len(lines[b])) >= line_dedup.MIN_CHARS
        and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    ]
    root = union_find(range(len(lines)), links)
    best = {}
    for n, line in enumerate(lines):
        best[root[n]] = min(best.get(root[n], first[line]), first[line])
    keep = {line: best[root[n]] for n, line in enumerate(lines)}
    out = {}
    for i, t in rows:
        out[i] = None if t is None else "\n".join(
            x for at, x in enumerate(t.split("\n")) if norm(x) not in keep or keep[norm(x)] == (i, at)
        )
    return out


def test_line_dedup_equals_brute_force(spark):
    rnd = random.Random(9)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("lo", "mi", "ra", "tenu")]
    lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(8, 40))) for _ in range(60)]
    rows = []
    for i in range(120):
        own = []
        for _ in range(rnd.randint(0, 6)):
            line = rnd.choice(lines)
            if rnd.random() < 0.3:  # one word changed in a long line
                parts = line.split(" ")
                if len(parts) > 25:
                    parts[rnd.randrange(len(parts))] = "changed"
                line = " ".join(parts)
            own.append(line.upper() if rnd.random() < 0.1 else f" {line} " if rnd.random() < 0.1 else line)
        rows.append((i, "\n".join([*own, "short", ""])))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "y" * 3000), (504, "y" * 3000)]
    out = line_dedup.dedup_lines(docs(spark, rows), carry=("source",)).collect()
    want = brute_lines(rows)
    assert {r.doc_id: r.text for r in out} == want
    for r in out:
        text = dict(rows)[r.doc_id]
        assert r.n_lines == (0 if text is None else text.count("\n") + 1)
        assert r.source == "s"


def test_links_of_one_bucket_connect_all_alike(spark):
    """Chains and families whose heads resemble only some of them, all in one bucket."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    lines = []
    for _ in range(12):
        words = [word() for _ in range(40)]
        for _ in range(4):
            lines.append(" ".join(words))
            words = list(words)
            for at in rnd.sample(range(40), 2):
                words[at] = word()
    rnd.shuffle(lines)
    sets = [{x[a : a + 8] for a in range(len(x) - 7)} for x in lines]
    alike = [
        (a, b)
        for b in range(len(lines))
        for a in range(b)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    rows = [(n, line, [n % 2]) for n, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "_n long, _line string, _bands array<long>")
    got = line_dedup.similar_lines(df, df, 0.8)
    found = [(r.a, r.b) for r in got.collect()]
    assert {(min(x), max(x)) for x in found} <= {*alike}
    want = union_find(range(len(lines)), [(a, b) for a, b in alike if a % 2 == b % 2])
    assert union_find(range(len(lines)), found) == want


def test_unlike_lines_of_one_bucket_take_few_rounds(spark, monkeypatch):
    rnd = random.Random(2)
    lines = ["".join(rnd.choice("abcdefghij ") for _ in range(60)) for _ in range(50)]
    rows = [(n, line, [7]) for n, line in enumerate(lines)] + [(99, lines[30], [7])]
    rounds, plain = [], line_dedup._compared
    monkeypatch.setattr(line_dedup, "_compared", lambda *args: (rounds.append(1), plain(*args))[1])
    df = spark.createDataFrame(rows, "_n long, _line string, _bands array<long>")
    got = {(r.a, r.b) for r in line_dedup.similar_lines(df, df, 0.8).collect()}
    assert got == {(30, 99)}
    assert len(rounds) <= 5


def test_pairs_that_sketches_rule_out_leave_no_join(spark, monkeypatch):
    rnd = random.Random(2)
    lines = ["".join(rnd.choice("abcdefghij ") for _ in range(60)) for _ in range(50)]
    rows = [(n, line, [7]) for n, line in enumerate(lines)] + [(99, lines[30], [7])]
    sizes, plain = [], line_dedup._compared
    monkeypatch.setattr(line_dedup, "_compared", lambda *args: (sizes.append(args[0].count()), plain(*args))[1])
    df = spark.createDataFrame(rows, "_n long, _line string, _bands array<long>")
    assert [(r.a, r.b) for r in line_dedup.similar_lines(df, df, 0.8).collect()] == [(30, 99)]
    assert sum(sizes) == 1


def test_what_links_connect_is_not_compared(spark, monkeypatch):
    """A ring of copies, each unlike most others, beside one line that none is like."""
    rnd = random.Random(8)
    ring = "".join(rnd.choice("abcdefghij ") for _ in range(1000))
    ring += ring
    lines = [ring[25 * i : 25 * i + 600] for i in range(40)] + ["".join(rnd.choice("klmnop") for _ in range(600))]
    pairs, plain = [], line_dedup._compared

    def compared(*args):
        pairs.extend((r.a, r.b) for r in args[0].collect())
        return plain(*args)

    monkeypatch.setattr(line_dedup, "_compared", compared)
    df = spark.createDataFrame([(n, line, [7, 8, 9]) for n, line in enumerate(lines)], "_n long, _line string, _bands array<long>")
    links = [(r.a, r.b) for r in line_dedup.similar_lines(df, df, 0.8).collect()]
    assert {*union_find(range(41), links).values()} == {0, 40}
    assert len(pairs) == len({*pairs}) < 41 * 40 / 4


def test_only_what_the_result_reads_stays_in_scratch(spark):
    line = "a line that is long enough to count, and a bit longer than that"
    rows = docs(spark, [(1, line), (2, line + " x"), (3, line)])
    mark = scratch_mark(spark)
    assert line_dedup.dedup_lines(rows).where("n_dropped > 0").count() == 2
    assert scratch_mark(spark) == mark + 1
    assert ngram_join.jaccard_components(rows).where("component_id = 1").count() >= 2
    assert scratch_mark(spark) == mark + 3


def test_short_lines_are_matched_as_they_are(spark):
    rows = [(1, "Share this\n--\n\nown line of one"), (2, " share THIS \n--\n\nown line of two"), (3, "share thus\n--")]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "--\n\nown line of two", 3: rows[2][1]}


def test_bands_recall_of_similar_lines(spark):
    """Pairs at a Jaccard index around 0.85 are found in at least nine of ten cases."""
    rnd = random.Random(1)
    rows, pairs = [], 0
    for i in range(150):
        words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8))) for _ in range(40)]
        rows.append((2 * i, " ".join(words)))
        words[rnd.randrange(40)] = "zz"
        words[rnd.randrange(40)] = "qq"
        rows.append((2 * i + 1, " ".join(words)))
    want = brute_lines(rows)
    pairs = sum(not want[2 * i + 1] for i in range(150))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    found = sum(not got[2 * i + 1] for i in range(150))
    assert pairs > 50 and 0.9 * pairs <= found <= pairs


def test_bands_recall_of_lines_with_few_words(spark):
    """Unbroken lines and lines of long words, one letter changed."""
    rnd = random.Random(3)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for i in range(60):
        line = letters(201) if i % 2 else " ".join(letters(rnd.randint(18, 39)) for _ in range(4))
        # the first letter, or the first of the last word
        at = 0 if i % 2 else line.rindex(" ") + 1
        rows += [(2 * i, line), (2 * i + 1, line[:at] + "z" + line[at + 1 :])]
    want = brute_lines(rows)
    pairs = [i for i in range(60) if not want[2 * i + 1]]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert sum(i % 2 for i in pairs) == 30 and len(pairs) > 45
    assert sum(not got[2 * i + 1] for i in pairs) >= 0.95 * len(pairs)


def test_lines_alike_everywhere_but_at_word_starts(spark):
    """All words are new but one, which most places of the line are in."""
    rnd = random.Random(5)
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    rows = []
    for i in range(20):
        long = letters(1200)
        rows += [(2 * i + j, " ".join([*[letters(3) for _ in range(30)], long])) for j in range(2)]
    want = brute_lines(rows)
    assert all(not want[2 * i + 1] for i in range(20))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert sum(not got[2 * i + 1] for i in range(20)) >= 18


def test_shingles_are_those_at_every_place(spark):
    rnd = random.Random(6)
    lines = ["".join(rnd.choice("ab\u00e9\U0001f600 ") for _ in range(n)) for n in (*range(1, 120), 1000)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    hashed = lambda x: {x[a : a + 8] for a in range(max(len(x) - 7, 1))}
    want = spark.createDataFrame([(x, y) for x in lines for y in hashed(x)], "line string, s string")
    want = {(r.line, r.h) for r in want.selectExpr("line", "xxhash64(s) AS h").collect()}
    got = df.select("line", line_dedup.shingles(df.line).alias("found")).collect()
    assert {(r.line, h) for r in got for h in r.found} == want


def test_hashes_of_any_code_are_those_of_the_shingles(spark):
    """Pieces and whole lines give equal shingles one hash, and unequal ones another."""
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(letters) for _ in range(n)) for letters in ("ab ", "a\u00e9\u4e2d", "a\u00e9\U0001f600b") for n in (20, 23, 24, 200)]
    texts += [texts[3] + "\U0001f600" + texts[7], texts[7] + texts[3]]
    df = spark.createDataFrame([*enumerate(texts)], "_n long, _line string")
    got = {i: set() for i in range(len(texts))}
    for r in line_dedup._hashes(df, "_n").collect():
        got[r._n].update(r[1:])
    names = {}
    for i, x in enumerate(texts):
        want = {x[a : a + 8] for a in range(len(x) - 7)}
        assert len(got[i]) == len(want)
        names[i] = want
    for i in names:
        for j in names:
            assert len(got[i] & got[j]) == len(names[i] & names[j])


def test_line_dedup_takes_costly_steps_once(spark):
    """Lower case is taken once, and what shares a bucket is found without sorting all."""
    rows = docs(spark, [(1, "A Line that is long enough to count")])
    plan = line_dedup._lines(rows, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
    members = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (3, 4), (3, 5)], "_bucket long, b long")
    shared = line_dedup._shared(members)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    assert {tuple(r) for r in shared.collect()} == {(1, 1), (1, 2), (3, 4), (3, 5)}


def test_line_dedup_odd_rows(spark):
    line = "a line that is long enough to count"
    rows = [(None, line), (1, line), (1, line), (2, line + "\n" + line), (None, line)]
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs(spark, rows)).collect())
    assert got == Counter({(None, line): 2, (1, line): 2, (2, ""): 1})
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_runs_no_python(spark):
    out = line_dedup.dedup_lines(docs(spark, [(1, "x" * 30), (2, "x" * 30)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- n-gram join ------------------------------------------------------------


def test_unequal_words_have_unequal_hashes():
    import numpy as np

    thue = "a"
    while len(thue) < 1024:
        thue += thue.translate(str.maketrans("ab", "ba"))
    swap = lambda w: w.translate(str.maketrans("ab", "ba"))
    rnd = random.Random(6)
    words = [thue[:n] for n in range(1, 1025)] + [swap(thue[:n]) for n in range(1, 1025)]
    words += ["".join(rnd.choice("ab") for _ in range(rnd.randint(30, 90))) for _ in range(3000)]
    words = [*{*words}]
    hashes = ngram_join.word_hashes(" ".join(words))
    assert len(hashes) == len(words) == len(np.unique(hashes))
    again = ngram_join.word_hashes("\n\t".join(w.upper() for w in reversed(words)))
    assert (again[::-1] == hashes).all()
    assert len(ngram_join.word_hashes("")) == len(ngram_join.word_hashes(" \n")) == 0


def test_long_sketches_bound_the_unshared_shingles():
    """Also of sets of unlike sizes; the short sketches cannot tell large sets apart."""
    import numpy as np

    rnd = random.Random(7)
    words = [f"w{rnd.randrange(10**9)}" for _ in range(6000)]
    a, b = ngram_join.shingle_set(" ".join(words[:5000])), ngram_join.shingle_set(" ".join(words[1000:]))
    for x, y in ((a, b), (a, b[:900]), (a, a), (a[:3], b)):
        sketches = []
        for s in (x, y):
            bits = ngram_join._long_sketch_bits(len(s))
            flips = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
            sketches.append(np.packbits(flips.astype(np.uint8)).tobytes())
        only = len(np.setxor1d(x, y))
        assert only * (0 if len(x) != len(y) else 0.7) <= ngram_join.unshared(*sketches) <= only


def test_only_likely_links_move_texts(spark, monkeypatch):
    """Long texts with too many words of their own for the short sketches."""
    rnd = random.Random(3)
    words = lambda n: " ".join(f"w{rnd.randrange(10**9)}" for _ in range(n))
    shared = words(2400)
    rows = [(i, f"{shared} {words(500)}") for i in range(12)]
    rows.append((99, rows[4][1] + " end"))
    moved, plain = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda *args: (moved.append(args[0].count()), plain(*args))[1])
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs(spark, rows)).collect()}
    assert got == {i: 4 if i == 99 else i for i, _ in rows}
    assert sum(moved) == 1


def test_thue_morse_words_do_not_link(spark):
    thue = "a"
    while len(thue) < 1024:
        thue += thue.translate(str.maketrans("ab", "ba"))
    rows = [(1, thue), (2, thue.translate(str.maketrans("ab", "ba")))]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 2}


def brute_join(rows, percent=80, n=5):
    sets = {}
    for i, t in rows:
        table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(table))
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = union_find(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


def near_copies(seed, count=260):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "b", "C", "dd", "eé"]) + str(rnd.randint(0, 30))
    base = [[word() for _ in range(rnd.choice([3, 6, 40, 120]))] for _ in range(8)]
    common = [f"z{i}" for i in range(40)]
    rows = []
    for i in range(count):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 5])):
            words[rnd.randrange(len(words))] = f"q{rnd.randint(0, 9)}"
        if rnd.random() < 0.3:
            words = common[: rnd.randint(5, 40)] + words
        rows.append((i, rnd.choice([" ", "\n", "\t"]).join(words)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "x y")]


@pytest.mark.parametrize("large", [64, 4])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, large):
    """With 4 most regions are large and go through several pivots."""
    monkeypatch.setattr(ngram_join, "LARGE", large)
    rows = near_copies(large)
    out = ngram_join.jaccard_components(docs(spark, rows))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute_join(rows)


def test_jaccard_threshold_is_inclusive(spark):
    words = [f"w{i}" for i in range(13)]  # 9 shingles
    exact = words + ["p", "q"]  # 9 of 11 shared
    longer = words[:12]  # 8 of 9
    below = words + ["p", "q", "r"]  # 9 of 12
    eight = [f"v{i}" for i in range(12)]  # 8 shingles
    ten = eight + ["p", "q"]  # 8 of 10, just enough
    rows = [(1, words), (2, exact), (3, longer), (4, below), (6, eight), (7, ten)]
    rows = [(i, " ".join(w)) for i, w in rows]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in brute_join(rows).items()}
    assert got[7] == 6


def test_jaccard_odd_rows(spark):
    t = "one two three four five six"
    rows = [(None, t), (4, t), (4, t), (None, "lone words here"), (None, None)]
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.jaccard_components(docs(spark, rows)).collect())
    assert got == Counter({(None, 4): 1, (4, 4): 2, (None, None): 2})
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0


def test_word_hashes_follow_the_words():
    text = "Ab ab\x0bAB ab  É é\x1cz"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = ngram_join.word_hashes(text).tolist()
    assert len(hashes) == len(words)
    assert hashes[0] == hashes[1] and hashes[3] != hashes[4]
    assert ngram_join.word_hashes("x ab").tolist()[1] == hashes[0]
