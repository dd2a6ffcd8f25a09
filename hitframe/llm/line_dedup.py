"""Fuzzy line deduplication by MinHash over character shingles, in DataFrame functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitframe.session import drop_paths, release_shuffles, scratch_path, scratch_scope
from hitframe.sources.stages import materialise, write_bucketed

from .components import components

# characters of a shingle
SHINGLE = 8
SIMILARITY = 0.8
BANDS, ROWS = 8, 4
# shorter lines have too few shingles to resemble each other and are matched as they are
MIN_CHARS = 20
# 64-bit words of a line's sketch
SKETCH_WORDS = 16
# places of a line that are cut out in one go
PIECE = 16
# places that are hashed in one row
STEP = 4
# the heads of a bucket are as many times more in each round
GROWTH = 4


def _number(name: str) -> int:
    """A fixed 64-bit number."""
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big", signed=True)


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _pieces(line: Column) -> Column:
    """The line in overlapping pieces that hold each of its shingles once.

    The place of a character is counted from the start of its text, so shingles are cut
    from short pieces, which one pass finds: the work grows with the line and not with its
    square.
    """
    # as many characters are passed over as the piece has shingles
    places = F.lit(f"(?s)(?=(.{{{SHINGLE},{PIECE + SHINGLE - 1}}})).{{1,{PIECE}}}")
    found = F.regexp_extract_all(line, places, F.lit(1))
    return F.when(F.char_length(line) < SHINGLE, F.array(line)).otherwise(found)


def _hashed(piece: Column, at: Column) -> Column:
    """The shingle at a place; a line shorter than one is its own shingle."""
    return F.xxhash64(F.substring(piece, at, F.lit(SHINGLE)))


def _last(length: Column) -> Column:
    return F.greatest(length - (SHINGLE - 1), F.lit(1))


def shingles(line: Column) -> Column:
    """Distinct 64-bit hashes of the shingles at every place.

    Bytes are cut at any place at once, so an ASCII line needs no pieces.
    """
    each = lambda p, n: F.transform(F.sequence(F.lit(1), _last(n)), lambda at: _hashed(p, at))
    in_bytes = F.transform(F.array(line.cast("binary")), lambda p: each(p, F.octet_length(p)))
    in_text = F.transform(_pieces(line), lambda p: each(p, F.char_length(p)))
    return F.array_distinct(F.flatten(F.when(_ascii(line), in_bytes).otherwise(in_text)))


def _with_index(pairs: DataFrame, a: str, b: str, index: str) -> DataFrame:
    """With the exact Jaccard index of two lines.

    The steps are columns of their own, so that each is taken once.
    """
    sets = pairs.withColumns({"_set_a": shingles(F.col(a)), "_set_b": shingles(F.col(b))})
    only = F.size(F.array_except("_set_a", "_set_b")).alias("_only")
    sizes = sets.select(*pairs.columns, only, F.size("_set_a").alias("_in_a"), F.size("_set_b").alias("_in_b"))
    return sizes.select(*pairs.columns, ((F.col("_in_a") - F.col("_only")) / (F.col("_in_b") + F.col("_only"))).alias(index))


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line that says something: whose it is, its place, its normal form.

    The place is the id, then the number of the line, in one decimal that hash
    aggregates can hold.
    """
    place = F.expr(
        "CAST(CAST(coalesce(_id, 9223372036854775807) AS DECIMAL(19,0)) * CAST(10000000000 AS DECIMAL(11,0))"
        " + CAST(_at AS DECIMAL(10,0)) AS DECIMAL(31,0))"
    )
    # lower case of the whole text, as a filter below would have it taken again for each line
    rows = docs.select(
        F.col(key).alias("_id"),
        F.xxhash64(text).alias("_row"),
        F.posexplode(F.split(F.lower(text), "\n", -1)).alias("_at", "_line"),
    )
    says = (F.char_length("_line") >= MIN_CHARS) | F.col("_line").rlike(r"[\p{L}\p{N}]")
    return (
        rows.withColumn("_line", F.trim("_line"))
        .where(says)
        .select("_id", "_row", "_at", place.alias("_place"), "_line", F.unhex(F.md5("_line")).alias("_digest"))
    )


def _buckets_of(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _distinct_lines(lines: DataFrame) -> DataFrame:
    """``(_part, _digest, _line, _times, _place, _n)``: each line once, with its first place.

    The one shuffle of the texts. They are written in buckets of a number that follows
    from the digest, so what goes by line afterwards needs no other; the shuffle itself
    can go.
    """
    spark = lines.sparkSession
    n = _buckets_of(spark)
    dealt = lines.withColumn("_part", F.xxhash64("_digest")).repartition(n, "_part")
    distinct = dealt.groupBy("_part", "_digest", "_line").agg(
        F.count(F.lit(1)).alias("_times"), F.min("_place").alias("_place")
    )
    numbered = distinct.withColumn("_n", F.monotonically_increasing_id())
    table = write_bucketed(numbered, scratch_path(spark, "distinct-lines"), ["_part"], n, True, "zstd")
    release_shuffles(spark)
    return table


def _hashes(lines: DataFrame, *keys: str) -> DataFrame:
    """``keys + [_h0, _h1, ...]``: hashes of the shingles at ``STEP`` places after each other.

    Together the rows hold the shingle at every place of the lines; the last place fills
    up the last row. Bytes are cut at any place at once, so ASCII lines are one piece;
    in other pieces the characters are counted.
    """
    line, piece = F.col("_line"), F.col("_piece")
    pieces = lines.select(*keys, F.explode(F.when(_ascii(line), F.array(line)).otherwise(_pieces(line))).alias("_piece"))
    cut = pieces.select(
        *keys,
        "_piece",
        piece.cast("binary").alias("_bytes"),
        _ascii(piece).alias("_ascii"),
        _last(F.char_length(piece)).alias("_last"),
    )
    names = [c for c in cut.columns if c not in keys]
    steps = cut.select(*keys, *names, F.explode(F.sequence(F.lit(1), F.col("_last"), F.lit(STEP))).alias("_at"))
    at = [F.least(F.col("_at") + i, F.col("_last")) for i in range(STEP)]
    hashed = lambda i: F.when(F.col("_ascii"), _hashed(F.col("_bytes"), at[i])).otherwise(_hashed(piece, at[i]))
    return steps.select(*keys, *[hashed(i).alias(f"_h{i}") for i in range(STEP)])


def _signed(lines: DataFrame) -> DataFrame:
    """``(_n, _bands)``: hashes of the bands of each line's MinHash signature.

    The minima are taken over the shingles at every place of the whole line. Bands have
    hashes of their own; the rows of a band look in one of them for what is nearest to
    a number each.
    """
    hashed = _hashes(lines.where(F.char_length("_line") >= MIN_CHARS), "_part", "_n")
    each = hashed.select(
        "_part",
        "_n",
        *[F.xxhash64(f"_h{i}", F.lit(b)).alias(f"_h{b}_{i}") for b in range(BANDS) for i in range(STEP)],
    )
    nearest = lambda b, r: F.least(
        *[F.col(f"_h{b}_{i}").bitwiseXOR(F.lit(_number(f"row {r}"))) for i in range(STEP)]
    )
    minima = [F.min(nearest(b, r)).alias(f"_m{b}_{r}") for b in range(BANDS) for r in range(ROWS)]
    signed = each.groupBy("_part", "_n").agg(*minima)
    bands = [F.xxhash64(F.lit(b), *[f"_m{b}_{r}" for r in range(ROWS)]) for b in range(BANDS)]
    return materialise(signed.select("_n", F.array(*bands).alias("_bands")), "line-bands")


def _sketches(lines: DataFrame) -> DataFrame:
    """``(_n, _places, _s0, _s1, ...)``: the number of places, and a sketch in which every
    shingle sets a bit."""

    places = _last(F.char_length("_line")).cast("long")
    # in a step of its own, so that it is taken once and not for every word
    each = range(STEP)
    hashed = _hashes(lines.withColumn("_places", places), "_n", "_places").select(
        "_n",
        "_places",
        *[F.expr(f"CAST(shiftrightunsigned(_h{k}, 6) & {SKETCH_WORDS - 1} AS INT)").alias(f"_word{k}") for k in each],
        *[F.expr(f"shiftleft(1L, CAST(_h{k} & 63 AS INT))").alias(f"_bit{k}") for k in each],
    )

    def word(i: int) -> Column:
        none = F.lit(0).cast("long")
        bits = none
        for k in each:
            bits = bits.bitwiseOR(F.when(F.col(f"_word{k}") == i, F.col(f"_bit{k}")).otherwise(none))
        return F.bit_or(bits).alias(f"_s{i}")

    return materialise(hashed.groupBy("_n", "_places").agg(*[word(i) for i in range(SKETCH_WORDS)]), "line-sketches")


def _sketched(rows: DataFrame, sketches: DataFrame, side: str) -> DataFrame:
    """Rows with the places and the sketch of the line in the column ``side``."""
    columns = [F.col(c).alias(f"{c}_{side}") for c in sketches.columns if c != "_n"]
    return rows.join(sketches.select(F.col("_n").alias(side), *columns), side)


def _bound() -> Column:
    """A Jaccard distance that the lines a and b have at least.

    A bit that only one sketch has stands for a shingle or more that only one line has.
    Of u such shingles in sets of at most m and n, the distance is at least
    2u / (m + n + u).
    """
    only = F.lit(0)
    for i in range(SKETCH_WORDS):
        only = only + F.bit_count(F.col(f"_s{i}_a").bitwiseXOR(F.col(f"_s{i}_b")))
    return 2 * only / (F.col("_places_a") + F.col("_places_b") + only)


def _compared(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, alike)`` of distinct pairs, by the exact Jaccard index of the lines."""
    text = lambda side: texts.select(F.col("_n").alias(side), F.col("_line").alias(f"_{side}"))
    both = pairs.join(text("b"), "b").join(text("a"), "a")
    found = _with_index(both, "_a", "_b", "_index")
    return materialise(found.select("a", "b", (F.col("_index") >= threshold).alias("alike")), "compared-lines")


def _shared(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one.

    Both sides are dealt in one way, so one shuffle serves them, and the few buckets are
    looked up in a hash table, so nothing is sorted.
    """
    dealt = members.repartition(_buckets_of(members.sparkSession), "_bucket")
    ends = dealt.groupBy("_bucket").agg(F.min("b").alias("_least"), F.max("b").alias("_most"))
    several = ends.where("_least < _most").select("_bucket")
    return dealt.join(several.hint("shuffle_hash"), "_bucket", "left_semi")


def _texts(lines: DataFrame, members: DataFrame) -> DataFrame:
    """``(_n, _line)`` of the members of buckets, in buckets of their number.

    Lines that lie in buckets already are found where they lie: only what is found is moved.
    """
    wanted = members.select(F.col("b").alias("_n")).distinct()
    by = "_part" if "_part" in lines.columns else "_n"
    if by != "_n":
        wanted = lines.select(by, "_n").join(wanted, "_n", "left_semi").select(by).distinct()
    found = lines.join(wanted.hint("shuffle_hash"), by, "left_semi").select("_n", "_line")
    spark = lines.sparkSession
    return write_bucketed(found, scratch_path(spark, "compared-texts"), ["_n"], _buckets_of(spark), compression="zstd")


def similar_lines(lines: DataFrame, bands: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between distinct lines: enough to connect all that are connected.
    The lines that share a band's hash are compared with a few of them, the heads, four
    times as many in each round. What a head has been compared with needs it no more, so
    heads leave their buckets; and what the links of all buckets are seen to connect needs
    no comparison, so a bucket of which the lines are all connected is done. Lines without a
    link are the first heads: those beside a large group are compared with its members,
    not the members with each other. A bucket of m lines takes some log m rounds at most.
    Every pair that shares a band is thus compared, ruled out by the sketches or
    connected. The sketches are in the joins, so that only pairs that they do not rule
    out leave them.
    """
    with scratch_scope() as made:
        links = _similar(lines, bands, threshold)
    drop_paths(lines.sparkSession, made[:-1])
    return links


def _similar(lines: DataFrame, bands: DataFrame, threshold: float) -> DataFrame:
    # far less than the difference of two Jaccard indices
    radius = 1 - threshold + 1e-9
    spark = lines.sparkSession
    buckets = bands.select(F.explode(F.array_distinct("_bands")).alias("_bucket"), F.col("_n").alias("b"))
    narrow = materialise(_shared(buckets), "band-members")
    release_shuffles(spark)
    # only these texts are ever compared
    texts = _texts(lines, narrow)
    sketches = _sketches(texts)
    with scratch_scope() as written:
        members = materialise(
            _sketched(narrow, sketches, "b").withColumn("_root_b", F.lit(None).cast("long")), "sketched-members"
        )
    release_shuffles(spark)
    links = bands.select(F.col("_n").alias("a"), F.col("_n").alias("b")).limit(0)
    unlike = links
    labels = None
    heads_each = 1
    while not members.isEmpty():
        with scratch_scope() as made:
            first = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.col("_root_b").isNotNull(), "b"))
            heads = materialise(members.withColumn("_at", first).where(F.col("_at") <= heads_each).drop("_at"), "band-heads")
            compared = _compared(_unconnected(members, heads, radius).join(unlike, ["a", "b"], "left_anti"), texts, threshold)
            keep = made[-1]
            links = links.unionByName(compared.where("alike").select("a", "b"))
            unlike = unlike.unionByName(compared.where("NOT alike").select("a", "b"))
            labels = _labels(links, labels)
            members = _left(members, heads, labels)
        drop_paths(spark, [*written, *(p for p in made[:-2] if p != keep)])
        written = made[-2:]
        heads_each *= GROWTH
        release_shuffles(spark)
    return materialise(links, "line-links")


def _unconnected(members: DataFrame, heads: DataFrame, radius: float) -> DataFrame:
    """Distinct pairs ``(a, b)`` of a head and a line of its bucket that may be alike and
    that no links connect."""
    other = heads.select("_bucket", *[F.col(c).alias(c[:-1] + "a") for c in heads.columns if c != "_bucket"])
    met = members.join(other, "_bucket").where(
        (F.coalesce("_root_a", "a") != F.coalesce("_root_b", "b")) & (_bound() <= radius)
    )
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labels(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``(id, root)``: lines of one root are connected, though some connected ones differ.

    One step of ``components`` from the labels of the last round: the smallest label
    around, then the label of that.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if labels is not None:
        known = labels.select(F.col("id").alias("b"), "root")
        both = both.join(known, "b", "left").select("a", F.coalesce("root", "b").alias("b"))
    taken = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_offer"))
    taken = taken.select("id", F.least("id", "_offer").alias("root"))
    onward = taken.select(F.col("id").alias("root"), F.col("root").alias("_next"))
    jumped = taken.join(onward, "root", "left").select("id", F.least("root", "_next").alias("root"))
    return materialise(jumped, "line-labels")


def _left(members: DataFrame, heads: DataFrame, roots: DataFrame) -> DataFrame:
    """The members that have not been heads, in buckets that hold lines not known to be connected."""
    rest = members.drop("_root_b").join(heads.select("_bucket", "b"), ["_bucket", "b"], "left_anti")
    rest = rest.join(roots.select(F.col("id").alias("b"), F.col("root").alias("_root_b")), "b", "left")
    root = F.coalesce("_root_b", "b")
    several = rest.groupBy("_bucket").agg(F.min(root).alias("_least"), F.max(root).alias("_most")).where("_least < _most")
    return materialise(rest.join(several.select("_bucket"), "_bucket"), "sketched-members")


def _dropped(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """``(_id, _row, _dropped)``: the numbers of the lines that go from each document."""
    occurrences = _lines(docs, key, text)
    lines = _distinct_lines(occurrences)
    links = similar_lines(lines, _signed(lines), threshold)
    roots = components(links).withColumnRenamed("id", "_n")
    grouped = (
        lines.select("_n", "_digest", "_times", "_place")
        .join(roots, "_n", "left")
        .where("_times > 1 OR root IS NOT NULL")
        .withColumn("_root", F.coalesce("root", "_n"))
    )
    first = grouped.groupBy("_root").agg(F.min("_place").alias("_first"))
    repeated = materialise(
        grouped.join(first, "_root").select("_digest", "_first"), "repeated-lines"
    )
    dropped = (
        occurrences.drop("_line")
        .join(repeated, "_digest")
        .where("_place != _first")
        .groupBy("_id", "_row")
        .agg(F.collect_set("_at").alias("_dropped"))
    )
    return materialise(dropped, "dropped-lines")


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = SIMILARITY,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(key, text, n_lines, n_dropped)``: every document without the lines said before.

    Lines are the parts between line feeds, compared without case and outer blanks.
    Lines that are alike, directly or through others, are one component, and of all
    its occurrences the one with the smallest id, then line number stays. Lines of
    fewer than ``MIN_CHARS`` characters are alike only if equal, and those of them
    without a letter or digit always stay. A document may end up empty;
    its row stays. Null texts stay null with no lines. Lines under a null id rank
    after all others and are never dropped, as nothing tells their rows apart; rows
    that repeat an id and a text are treated as one. Only the columns in ``carry``
    come along; an empty table gives an empty result.
    """
    with scratch_scope() as made:
        dropped = _dropped(docs, key, text, threshold)
    # the rest has been used up, and a chain of stages needs the disk
    drop_paths(docs.sparkSession, made[:-1])
    release_shuffles(docs.sparkSession)
    parts = F.split(F.col("_text"), "\n", -1)
    stays = F.filter(parts, lambda _, i: ~F.array_contains("_dropped", i))
    return (
        docs.select(
            F.col(key).alias("_id"),
            F.col(text).alias("_text"),
            F.xxhash64(text).alias("_row"),
            *[F.col(c).alias(f"_carried_{c}") for c in carry],
        )
        .join(dropped, ["_id", "_row"], "left")
        .select(
            F.col("_id").alias(key),
            F.when(F.col("_dropped").isNull(), F.col("_text"))
            .otherwise(F.array_join(stays, "\n"))
            .alias(text),
            F.when(F.col("_text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
            F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
            *[F.col(f"_carried_{c}").alias(c) for c in carry],
        )
    )
