"""Pack whole documents into token sequences of a fixed size."""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitframe.sources.stages import materialise

from .common import byte_letters, for_python

# words kept per worker; beyond it the cache starts anew
CACHED = 1 << 19


def _near_words() -> tuple[re.Pattern, re.Pattern]:
    """The vocabulary's pattern as plain character classes, and what lies beyond them.

    The classes cover U+0000 to U+024F, where the categories are settled in every
    version of Unicode, and the common dashes and quotes. Letters lead, which
    changes nothing as no other alternative can start where they match.
    """
    kinds: dict[str, str] = {"L": "", "N": ""}
    for c in map(chr, range(0x250)):
        if (kind := unicodedata.category(c)[0]) in kinds:
            kinds[kind] += c
    letters, numbers, blanks = kinds["L"], kinds["N"], "\t-\r \x85\xa0"
    words = (
        f" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{blanks}{letters}{numbers}]+"
        f"|[{blanks}]+(?![^{blanks}])|[{blanks}]+"
    )
    return re.compile(words), re.compile("[^\x00-\u024f\u2010-\u2027\u20ac]")


# rows that one rank window may hold on average, over all lengths of a salt
SALT_ROWS = 1 << 18


class WordCache:
    """Token ids of a text as little-endian 32-bit bytes, each new word encoded once.

    The vocabulary's pattern cuts a text into words that are encoded one by one, and
    cutting a word again leaves it as it is, so a text is the ids of its words. New
    words go through the same vocabulary in rank form, which costs less per call.
    Texts with letters of other scripts or special tokens go to the library whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        words, beyond = _near_words()
        self.words, self.beyond = words.findall, beyond.search
        self.special = re.compile("|".join(map(re.escape, special))).search
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        ranks = {
            bytes(map(byte.__getitem__, token)): i
            for token, i in self.tokenizer.get_vocab().items()
            if token not in special
        }
        self.of_word = tiktoken.Encoding(
            "words", pat_str=words.pattern, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.cache: dict[str, bytes] = {}

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.beyond(text) or self.special(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        words = self.words(text)
        cache = self.cache
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            if len(cache) > CACHED:
                cache.clear()
            for w in {*words}.difference(cache):
                cache[w] = array("I", self.of_word(w)).tobytes()
            return b"".join([cache[w] for w in words])


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """One per worker process, so that the cache outlives a task."""
    return WordCache(path)


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: the ids of each text and ``end_id`` after them.

    A longer document is cut into full pieces behind a first one that takes the
    remainder. Null and empty texts are one piece of ``end_id`` alone. ``with_ids``
    adds the ids of each piece. Rows are independent; nothing is shuffled.
    """
    for_python(docs.sparkSession)
    numbers = {"piece": T.IntegerType(), "start": T.LongType(), "length": T.LongType(), "ids_crc32": T.LongType()}
    schema = T.StructType([docs.schema[key], *[T.StructField(n, t) for n, t in numbers.items()]])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        words = word_cache(vocabulary)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows, parts = [], []
            for at, t in enumerate(batch.column(1).to_pylist()):
                ids = words.encode(t) + end
                n = len(ids) // 4
                first = n % capacity or capacity
                for piece, start in enumerate([0, *range(first, n, capacity)]):
                    part = ids[4 * start : 4 * (start + capacity if piece else first)]
                    rows.append((at, piece, start, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        parts.append(np.frombuffer(part, "<i4"))
            at, piece, start, length, crc = zip(*rows) if rows else ((),) * 5
            columns = [
                batch.column(0).take(pa.array(at, pa.int32())),
                pa.array(piece, pa.int32()),
                *[pa.array(x, pa.int64()) for x in (start, length, crc)],
            ]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def _exact_sums(left: Counter, capacity: int, parts: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of two to four lengths that fill a sequence exactly.

    For the longest length still there, its gap is looked up among single lengths,
    then sums of two, then sums of three (a pair sum at a time), each as often as
    all its lengths are available. ``parts`` limits the lengths that fill a gap.
    """
    taken = []

    def take(*lengths: int) -> bool:
        need = Counter(lengths)
        copies = min(left[x] // n for x, n in need.items())
        if copies:
            taken.append((lengths, copies))
            for x, n in need.items():
                left[x] -= n * copies
        return copies > 0

    def pairs(total: int, longest: int):
        """Available lengths (a, b) with a + b = total, a >= b."""
        for a in range(min(total - 1, longest), (total - 1) // 2, -1):
            if left[a] and left[total - a]:
                yield a, total - a

    for length in range(capacity, 0, -1):
        if not left[length]:
            continue
        gap = capacity - length
        if not gap:
            take(length)
            continue
        if left[gap]:
            take(length, gap)
        if parts < 2:
            continue
        for a, b in pairs(gap, length):
            if not left[length]:
                break
            take(length, a, b)
        if parts < 3:
            continue
        for a in range(min(gap - 2, length), 0, -1):
            if not left[length]:
                break
            if not left[a]:
                continue
            for b, c in pairs(gap - a, a):
                if not (left[length] and left[a]):
                    break
                take(length, a, b, c)
    return taken


def _best_fit(left: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Decreasing best fit of what remains, by groups of equal sequences."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    gaps: list[int] = []  # ascending, one entry per gap with sequences

    def put(gap: int, content: tuple[int, ...], copies: int) -> None:
        if not groups[gap]:
            insort(gaps, gap)
        groups[gap].append((content, copies))

    for length in range(capacity, 0, -1):
        while left[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # as many new sequences as hold all that is left of this length
                each = capacity // length
                full, rest = divmod(left[length], each)
                if full:
                    put(capacity - each * length, (length,) * each, full)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                left[length] = 0
                continue
            gap = gaps[at]
            content, copies = groups[gap].pop()
            if not groups[gap]:
                del gaps[at]
            used = min(copies, left[length])
            left[length] -= used
            put(gap - length, (*content, length), used)
            if used < copies:
                put(gap, content, copies - used)
    return [entry for of_gap in groups.values() for entry in of_gap]


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, copies)``: sequences of these lengths, so many of them.

    Works on how often each length occurs, never on documents. Every entry uses up
    a length or a group of sequences, so there are a few thousand entries at most
    whatever the number of documents.

    Exact sums of many small lengths use up what best fit would need for other gaps,
    so the plan is made with gaps filled by up to three, two, one and no lengths first;
    the one with the fewest sequences is taken, of equal ones that with the most parts.
    It never needs more sequences than best fit alone.
    """
    plans = []
    for parts in (3, 2, 1, 0):
        left = Counter(counts)
        exact = _exact_sums(left, capacity, parts) if parts else []
        plans.append(exact + _best_fit(left, capacity))
    return min(plans, key=lambda plan: sum(copies for _, copies in plan))


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, past rank, first sequence, offset)`` per place of an entry."""
    out, ranks, sequence = [], Counter(), 0
    for lengths, copies in plan:
        offset = 0
        for x in lengths:
            out.append((x, ranks[x], ranks[x] + copies, sequence, offset))
            ranks[x] += copies
            offset += x
        sequence += copies
    return out


def pack(
    pieces: DataFrame, capacity: int = 1024, key: str = "doc_id", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Give every piece a sequence and an offset in it.

    Exact-complement hashing on the histogram of lengths: single lengths, sums of
    two and sums of three that fill a gap exactly are used up first, the rest goes
    by best fit. The histogram has ``capacity`` entries at most and is all that the
    driver sees; the plan says how many sequences of which lengths there are. Pieces
    take their places by their rank among pieces of equal length: a rank within
    (length, salt) plus the counts of the salts before, so that a length of any
    share is ranked in many tasks.
    """
    spark = pieces.sparkSession
    kept = [key, "piece", "start", "length", *carry]
    pieces = materialise(pieces.select(*kept), "pieces")
    counts = {
        r["length"]: r["n"]
        for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    salts = 64 + sum(counts.values()) // SALT_ROWS
    slots = spark.createDataFrame(
        _slots(packing_plan(counts, capacity)),
        "length long, first_rank long, past_rank long, first_sequence long, offset long",
    )
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)))
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        salted.groupBy("length", "_salt")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    own = Window.partitionBy("length", "_salt").orderBy(key, "piece")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(own))
        .join(before, ["length", "_salt"])
        .withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
    )
    # the plan is a few thousand rows by construction
    placed = ranked.join(F.broadcast(slots), "length").where("_rank >= first_rank AND _rank < past_rank")
    return placed.select(
        *kept,
        (F.col("first_sequence") + F.col("_rank") - F.col("first_rank")).alias("sequence_id"),
        "offset",
    )


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokenise, cut and pack whole documents: one row per piece with its place.

    Every row of the table is packed: null and empty texts as the end id alone,
    repeated rows as often as they come (rows of one id and piece are told apart
    only by their place), null ids like any other. Other columns are not read. An
    empty table gives an empty result.
    """
    pieces = token_pieces(docs, vocabulary, capacity, end_id, key, text)
    return pack(pieces, capacity, key, carry=("ids_crc32",))
