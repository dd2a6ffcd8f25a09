import random
from collections import defaultdict

from pyspark.sql import functions as F

from hitframe.operators import edges


def make(spark, seed=3, n=600):
    rnd = random.Random(seed)
    rows = [
        (rnd.randrange(20), rnd.randrange(4), rnd.randrange(2), float(rnd.randrange(12)))
        for _ in range(n)
    ]
    rows += [(77, 1, 0, 5.0), (78, 1, 1, 5.0)]  # a lone leading and a lone trailing edge
    return rows, spark.createDataFrame(rows, "frame_id long, ch int, edge int, timing double")


def brute(rows):
    groups = defaultdict(lambda: ([], []))
    for f, c, e, t in rows:
        groups[f, c][e].append(t)
    return {
        k: sorted((-(b - a), a, b) for a in lead for b in trail)
        for k, (lead, trail) in groups.items()
        if lead and trail
    }


def test_all_pairs(spark):
    rows, df = make(spark, n=150)
    got = defaultdict(list)
    for r in edges.pair_edges(df, ["frame_id", "ch"]).collect():
        got[r.frame_id, r.ch].append((-r.charge, r.timing, r.timing_trail))
    assert {k: sorted(v) for k, v in got.items()} == brute(rows)


def test_summary_equals_all_pairs(spark):
    rows, df = make(spark)
    want = brute(rows)
    got = {(r.frame_id, r.ch): r for r in edges.pair_summary(df, ["frame_id", "ch"]).collect()}
    assert got.keys() == want.keys()
    for k, pairs in want.items():
        widths = [-p[0] for p in pairs]
        r = got[k]
        assert int(r.n_pairs) == len(pairs)
        assert (r.width_min, r.width_max, r.width_sum) == (min(widths), max(widths), sum(widths))
    assert any(r.width_min < 0 for r in got.values())


def test_widest_pairs_are_exact(spark):
    rows, df = make(spark)
    want = brute(rows)
    for k in (1, 2, 3, 5):
        got = defaultdict(list)
        for r in edges.widest_pairs(df, ["frame_id", "ch"], k).collect():
            got[r.frame_id, r.ch].append((-r.charge, r.timing, r.timing_trail))
        assert got.keys() == want.keys()
        for key, pairs in want.items():
            assert sorted(got[key])[:k] == pairs[:k]


def test_pair_count_beyond_a_long(spark):
    from pyspark.sql import functions as F

    # the product of two large counts, as the summary forms it
    df = spark.createDataFrame([(4_000_000_000, 5_000_000_000)], "m long, n long")
    got = df.select(F.col("m").cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")).first()[0]
    assert int(got) == 20_000_000_000_000_000_000


def test_nearest_pairs_in_one_or_many_ranges(spark):
    rows, df = make(spark)
    rows += [(90, 2, 0, float(t)) for t in range(300)] + [(90, 2, 1, 250.0)] * 2  # one hot channel
    df = spark.createDataFrame(rows, df.schema)
    want = []
    for f, c, e, t in rows:
        later = [t2 for f2, c2, e2, t2 in rows if (f2, c2, e2) == (f, c, 1) and t2 > t]
        if e == 0 and later:
            want.append((f, c, t, min(later), min(later) - t))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for ranges in (1, 30):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        got = sorted(map(tuple, edges.nearest_pairs(df, ["frame_id", "ch"]).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", old)
        assert got == sorted(want)


def test_narrowest_pairs_are_exact(spark):
    rnd = random.Random(8)
    rows = [(f, c, rnd.randrange(2), float(rnd.randrange(40))) for f in range(30) for c in range(2) for _ in range(rnd.randrange(14))]
    df = spark.createDataFrame(rows, "frame_id long, ch int, edge int, timing double")
    for k in (1, 3, 5):
        got = {}
        for r in edges.widest_pairs(df, ["frame_id", "ch"], k, narrow=F.col("ch") == 1).collect():
            got.setdefault((r.frame_id, r.ch), []).append((r.charge, r.timing))
        for f in range(30):
            for c in range(2):
                lead = [t for a, b, e, t in rows if (a, b, e) == (f, c, 0)]
                trail = [t for a, b, e, t in rows if (a, b, e) == (f, c, 1)]
                sign = -1 if c == 1 else 1
                want = sorted((-sign * (t - s), s) for s in lead for t in trail)[:k]
                have = sorted((-sign * w, s) for w, s in got.get((f, c), []))[:k]
                # only equal pairs can differ, so widths and their order decide
                assert [w for w, _ in have] == [w for w, _ in want]


def test_width_counts_equal_all_pairs(spark):
    rnd = random.Random(5)
    rows = [(f, c, rnd.randrange(2), rnd.randrange(60) * 0.25) for f in range(20) for c in range(3) for _ in range(rnd.randrange(25))]
    df = spark.createDataFrame(rows, "frame_id long, ch int, edge int, timing double")
    want = edges.pair_edges(df, ["frame_id", "ch"]).groupBy("ch", F.col("charge").alias("width")).count()
    got = edges.width_counts(df, ["frame_id", "ch"], ["ch"], 0.25).select("ch", "width", F.col("n").cast("long").alias("count"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_noisy_channel_does_not_form_its_pairs(spark):
    """40,000 edges at 50 times: 400 million pairs from at most 2,500 rows."""
    df = spark.range(40_000).select(
        F.lit(1).alias("frame_id"), F.lit(3).alias("ch"), (F.col("id") % 2).cast("int").alias("edge"), (F.col("id") % 50 * 1.0).alias("timing")
    )
    out = edges.width_counts(df, ["frame_id", "ch"], ["ch"], 1.0)
    assert out.agg(F.sum("n")).first()[0] == 20_000 * 20_000
