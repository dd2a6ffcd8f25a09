"""Repeated passages by a logarithmic family of suffix arrays."""

from __future__ import annotations

import contextlib
import hashlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import for_python

# Bytes of an anchor: each window of ``width`` bytes is filed under one of its own.
ANCHOR = 16
# k-grams are counted in so many classes to tell common anchors from rare ones
CLASSES = 1 << 18
# a class this many times as full as the average one makes its anchors common
COMMON = 8
# windows whose anchors are sought at once; places within fit 24 bits
PIECE = 1 << 18
# bytes of text that a task turns into one batch of suffixes, and that a shard holds
BATCH_BYTES, SHARD_BYTES = 12 << 20, 6 << 20
# suffixes of one batch within a shard, and copies that are compared at once
BATCH_ROWS = 1 << 17
COMPARED = 1 << 14
# bits of a place in a packed span; the rest is its length
LENGTH_BITS = 8


@lru_cache(maxsize=1)
def _numbers():
    """One fixed odd 64-bit number for each byte, and two to mix with."""
    import numpy as np

    draw = lambda i: int.from_bytes(hashlib.blake2b(b"byte %d" % i, digest_size=8).digest(), "big") | 1
    return np.array([draw(i) for i in range(256)], np.uint64), np.uint64(draw(256)), np.uint64(draw(257))


def _gram_hashes(data, size: int = ANCHOR):
    """A 64-bit number for each run of ``size`` bytes, a power of two, by doubling.

    It only chooses anchors and shards. Whatever is removed is compared byte by byte.
    """
    import numpy as np

    letters, left, mix = _numbers()
    out, span = letters[data], 1
    while span < size:
        out = out[:-span] * left + out[span:]
        out ^= out >> np.uint64(32)
        out *= mix
        span *= 2
    return out


def _least(keys, width: int):
    """The smallest of each ``width`` neighbouring keys."""
    import numpy as np

    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def _heat(texts: DataFrame):
    """How common the anchors of each class are (0: not), and the bytes of all texts.

    A task names only the classes that are common among its own rows; a class that
    holds a sizeable share of all rows is common almost everywhere. One small number
    per class comes back, whatever the size of the input. It steers work away from
    crowded anchors and changes no result.
    """
    import numpy as np

    def run(batches):
        import pyarrow as pa

        counts, size = np.zeros(CLASSES, np.int64), 0
        for batch in batches:
            data, _ = _joined(batch.column(0))
            size += len(data)
            for at in range(0, max(0, len(data) - ANCHOR + 1), PIECE):
                grams = _gram_hashes(data[at : at + PIECE + ANCHOR - 1])
                counts += np.bincount((grams >> np.uint64(46)).astype(np.int64), minlength=CLASSES)
        common = np.flatnonzero(counts > max(COMMON, COMMON * counts.mean()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([[-1], common]).astype(np.int64)),
                pa.array(np.concatenate([[size], counts[common]]).astype(np.int64)),
            ],
            names=["place", "n"],
        )

    rows = texts.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = {r["place"]: r["n"] for r in rows}
    size = found.pop(-1, 0)
    heat = np.zeros(CLASSES, np.uint8)
    for place, n in found.items():
        heat[place] = min(15, max(0, int(n / max(COMMON, COMMON * size / CLASSES)).bit_length()))
    return heat, size


def _joined(column):
    """The texts of an Arrow column as one array of bytes, and where each ends in it."""
    import numpy as np

    texts = [t or b"" for t in column.cast("binary").to_pylist()]
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), ends


def _segments(data, ends, width: int, heat):
    """Anchors of all windows: place, text, gram number, first and last offset.

    A window's anchor is the rarest, then least, then leftmost of its k-grams, so equal
    windows have equal anchors at equal offsets. Neighbouring windows with the same
    anchor form one segment.
    """
    import numpy as np

    found = []
    total = len(data) - width + 1
    sizes = np.diff(ends, prepend=0)
    texts = np.repeat(np.arange(len(ends), dtype=np.int32), sizes)
    last_start = np.repeat(ends - width, sizes)  # windows end with their text
    for at in range(0, max(0, total), PIECE):
        count = min(PIECE, total - at)
        grams = _gram_hashes(data[at : at + count + width - 1])
        keys = heat[(grams >> np.uint64(46)).astype(np.int64)].astype(np.uint64) << np.uint64(60)
        keys |= (grams * _numbers()[1]) >> np.uint64(28) << np.uint64(24)
        keys |= np.arange(len(keys), dtype=np.uint64)
        place = (_least(keys, width - ANCHOR + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        start = np.flatnonzero(np.arange(at, at + count) <= last_start[at : at + count])
        if not len(start):
            continue
        place, text = place[start], texts[at + start]
        first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
        last = np.concatenate([first[1:], [len(start)]]) - 1
        place = place[first]
        found.append((at + place, text[first], grams[place], place - start[last], place - start[first]))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty.view(np.uint64), empty, empty
    return tuple(np.concatenate(x) for x in zip(*found))


def _lines(data, place, low, high, width: int):
    """The bytes around each anchor in their order, and which of them its windows cover."""
    import numpy as np

    before = width - ANCHOR
    padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(width, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, before + width)[place], _covered(low, high, width)


def _covered(low, high, width: int):
    import numpy as np

    at = np.arange(2 * width - ANCHOR) - (width - ANCHOR)
    return (at >= -high.astype(np.int64)[:, None]) & (at < width - low.astype(np.int64)[:, None])


def _covered_bytes(low, high, width: int):
    """How many bytes the windows of each segment cover."""
    import numpy as np

    return high.astype(np.int64) - low + width


def _lines_of(flat, starts, low, high, rows, width: int):
    """The lines of some segments from their covered bytes, zero elsewhere."""
    import numpy as np

    sizes = _covered_bytes(low[rows], high[rows], width)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lines = np.zeros((len(rows), 2 * width - ANCHOR), np.uint8)
    lines[_covered(low[rows], high[rows], width)] = flat[np.repeat(starts[rows], sizes) + within]
    return lines


def _give_back() -> None:
    """Let the allocator return what is free, as the worker lives on into other stages."""
    import ctypes

    with contextlib.suppress(OSError, AttributeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def _rows(lines, low, high, width: int):
    """Sortable rows: the bytes onward from the anchor, then those before it.

    Bytes that no window covers are zero and the two offsets come last, so rows are
    equal exactly if their windows are.
    """
    import numpy as np

    before = width - ANCHOR
    ends = np.stack([low, high], axis=1).astype(np.uint8)
    return np.concatenate([lines[:, before:], lines[:, :before], ends], axis=1)


def _as_strings(rows):
    """Rows of bytes as fixed-size strings, which sort like suffixes."""
    import numpy as np

    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _row_numbers(lines, low, high):
    """A 64-bit number of each row, to bring equal ones together."""
    import numpy as np

    _, left, mix = _numbers()
    words = np.zeros((len(lines), -(-lines.shape[1] // 8) * 8), np.uint8)
    words[:, : lines.shape[1]] = lines
    words = words.view(np.uint64)
    out = low.astype(np.uint64) << np.uint64(8) | high.astype(np.uint64)
    for i in range(words.shape[1]):
        out = (out ^ words[:, i]) * (mix if i % 2 else left)
        out ^= out >> np.uint64(29)
    return out


def _planes(values):
    """Differences of neighbours, byte plane by byte plane, which compress well."""
    import numpy as np

    steps = np.diff(values.astype(np.int64), prepend=0)
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes):
    import numpy as np

    planes = np.frombuffer(data, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view(np.int64).ravel())


def _pack(arrays, raw) -> bytes:
    """Whole numbers and plain bytes as one compressed block."""
    import numpy as np
    import pyarrow as pa

    parts = [_planes(a) for a in arrays] + [r.tobytes() for r in raw]
    whole = np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd", 5).compress(whole, asbytes=True)


def _unpack(block: bytes, arrays: int, raw: int):
    import numpy as np
    import pyarrow as pa

    whole = pa.Codec("zstd").decompress(block[8:], int.from_bytes(block[:8], "little"), asbytes=True)
    head = 8 * (arrays + raw)
    sizes = np.frombuffer(whole[:head], np.int64)
    ends = head + np.cumsum(sizes)
    parts = [whole[e - n : e] for e, n in zip(ends, sizes)]
    return [_unplanes(p) for p in parts[:arrays]], [np.frombuffer(p, np.uint8) for p in parts[arrays:]]


def _blocks(texts: DataFrame, heat, shards: int, width: int) -> DataFrame:
    """``(shard, block)``: the suffixes of each batch of texts, dealt out by anchor.

    Copies of a segment meet within the batch already: all but those of the smallest
    id are settled here, so a passage of any frequency sends one row per batch. What is
    settled rides along as spans.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, size = [], 0

        def flush():
            texts = np.cumsum([0] + [len(x[0]) for x in held[:-1]])
            text = np.concatenate([x[2] + first for x, first in zip(held, texts)])
            ids, marks, place, low, high, grams, numbers = (
                np.concatenate([x[i] for x in held]) for i in (0, 1, 3, 4, 5, 6, 7)
            )
            flat = np.concatenate([x[8] for x in held])
            held.clear()
            ids, marks = ids[text], marks[text]
            sizes = _covered_bytes(low, high, width)
            starts = np.cumsum(sizes) - sizes
            order = np.lexsort((place, marks, ids, numbers))
            near, next_ = order[:-1], order[1:]
            same = (numbers[next_] == numbers[near]) & (low[next_] == low[near]) & (high[next_] == high[near])
            for part in np.array_split(np.flatnonzero(same), 1 + int(same.sum()) // COMPARED):
                one, two = (_lines_of(flat, starts, low, high, x[part], width) for x in (next_, near))
                same[part] = (one == two).all(axis=1)
            head = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
            settled = np.zeros(len(order), bool)
            settled[order] = ids[order] > ids[order][head]
            again = np.zeros(len(order), bool)  # rows that come twice as they are
            again[next_] = same & (ids[next_] == ids[near]) & (marks[next_] == marks[near]) & (place[next_] == place[near])
            shard = (grams % np.uint64(shards)).astype(np.int64)
            by = np.lexsort((place, marks, ids, settled, shard))
            by = by[~again[by]]
            cuts = np.flatnonzero(np.diff(shard[by], prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:]):
                here = by[a:b]
                open_ = here[: int((~settled[here]).sum())]
                done = here[len(open_) :]
                span = (place[done] - high[done]) << LENGTH_BITS | (high[done].astype(np.int64) - low[done] + width)
                lists = [ids[open_], marks[open_], place[open_], ids[done], marks[done], span]
                # of a segment only the bytes that its windows cover
                lines = _lines_of(flat, starts, low, high, open_, width)
                raw = [low[open_], high[open_], lines[_covered(low[open_], high[open_], width)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[here[0]])], pa.int32()), pa.array([_pack(lists, raw)], pa.binary())],
                    names=["shard", "block"],
                )

        for batch in batches:
            ids, marks = (batch.column(i).to_numpy() for i in (0, 1))
            data, ends = _joined(batch.column(2))
            place, text, grams, low, high = _segments(data, ends, width, heat.value)
            if len(place):
                begin = np.concatenate([[0], ends[:-1]])[text]
                lines, covered = _lines(data, place, low, high, width)
                lines[~covered] = 0
                numbers = _row_numbers(lines, low, high)
                small = [low.astype(np.uint8), high.astype(np.uint8)]
                held.append((ids, marks, text, place - begin, *small, grams, numbers, lines[covered]))
                size += len(data)
            if size >= BATCH_BYTES:
                yield from flush()
                size = 0
                _give_back()
        if held:
            yield from flush()
            _give_back()

    return texts.select("id", "mark", "text").mapInArrow(run, "shard int, block binary")


class _Level:
    """Distinct segments in suffix order, each with the smallest id that has it."""

    def __init__(self, rows, ids):
        self.rows, self.ids = rows, ids
        self.strings = _as_strings(rows)  # the same bytes, seen as strings
        self.anchors = _as_strings(rows[:, :ANCHOR])

    def __len__(self):
        return len(self.ids)

    def merged(self, other: _Level) -> _Level:
        """Both in one order; a stable sort of two sorted runs is a merge."""
        import numpy as np

        rows = np.concatenate([self.rows, other.rows])
        order = np.argsort(_as_strings(rows), kind="stable")
        return _Level(rows[order], np.concatenate([self.ids, other.ids])[order])


def _shared_windows(rows, ids, asked, width: int):
    """Bits of the offsets at which a row that ``asked`` shares its window with a smaller id.

    Equal windows have equal offsets, so each offset is settled by itself: windows in
    order of a rolling number, runs of equal ones compared byte by byte.
    """
    import numpy as np

    before = width - ANCHOR
    low, high = rows[:, -2].astype(np.int64), rows[:, -1].astype(np.int64)
    line = np.concatenate([rows[:, width : width + before], rows[:, :width]], axis=1)
    letters, factor, _ = _numbers()
    top = np.uint64(pow(int(factor), width - 1, 1 << 64))
    number = np.zeros(len(rows), np.uint64)
    for i in range(width):
        number = number * factor + letters[line[:, i]]
    bits = np.zeros(len(rows), np.uint64)
    for offset in range(before, -1, -1):
        begin = before - offset
        if begin:
            number = (number - letters[line[:, begin - 1]] * top) * factor + letters[line[:, begin + width - 1]]
        has = np.flatnonzero((low <= offset) & (offset <= high))
        if len(has) < 2:
            continue
        order = has[np.lexsort((ids[has], number[has]))]
        near = np.flatnonzero(number[order][1:] == number[order][:-1])
        if not len(near):
            continue
        cut = slice(begin, begin + width)
        if not (line[order[near], cut] == line[order[near + 1], cut]).all():
            # unequal windows of one number: the order of their bytes tells them apart
            order = has[np.lexsort((ids[has], _as_strings(np.ascontiguousarray(line[has, cut]))))]
        windows = _as_strings(np.ascontiguousarray(line[order, cut]))
        new = np.concatenate([[True], windows[1:] != windows[:-1]])
        least = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        hit = order[(ids[order] > least) & asked[order]]
        bits[hit] |= np.uint64(1) << np.uint64(offset)
    return bits


def _scan(batch_rows, batch_ids, levels: list[_Level], width: int):
    """Bits of the shared offsets of each row of a batch; the batch joins the levels.

    The batch, in order of ids, gets its suffix array and is merge-scanned against the
    levels: equal segments first, then the windows of those that share an anchor only.
    Levels of like size merge.
    """
    import numpy as np

    order = np.argsort(_as_strings(batch_rows), kind="stable")
    rows, ids = batch_rows[order], batch_ids[order]
    strings = _as_strings(rows)
    new = np.concatenate([[True], strings[1:] != strings[:-1]])
    group = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    low, high = rows[:, -2].astype(np.uint64), rows[:, -1].astype(np.uint64)
    whole = (np.uint64(2) << high) - (np.uint64(1) << low)
    own = _Level(rows[heads], ids[heads])
    known = np.zeros(len(own), bool)
    for level in levels:
        at = np.minimum(np.searchsorted(level.strings, own.strings), len(level) - 1)
        known |= (level.strings[at] == own.strings) & (level.ids[at] < own.ids)
    bits = np.where(known, whole[heads], np.uint64(0))
    # anchors in common with another segment, of the batch or of a level
    same = own.anchors[1:] == own.anchors[:-1]
    shares = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    ranges = []
    for level in levels:
        a = np.searchsorted(level.anchors, own.anchors, "left")
        b = np.searchsorted(level.anchors, own.anchors, "right")
        shares |= b > a
        ranges.append((a, b))
    asking = shares & ~known
    if asking.any():
        near = np.isin(own.anchors, np.unique(own.anchors[asking]))
        sets, owners = [own.rows[near]], [own.ids[near]]
        for level, (a, b) in zip(levels, ranges):
            marks = np.zeros(len(level) + 1, np.int64)
            np.add.at(marks, a[asking], 1)
            np.add.at(marks, b[asking], -1)
            there = np.cumsum(marks[:-1]) > 0
            sets.append(level.rows[there])
            owners.append(level.ids[there])
        asked = np.zeros(sum(map(len, owners)), bool)
        asked[: int(near.sum())] = asking[near]
        found = _shared_windows(np.concatenate(sets), np.concatenate(owners), asked, width)
        bits[near] |= found[: int(near.sum())]
    # rows of a larger id than their head are covered as a whole by it
    out = np.empty(len(rows), np.uint64)
    out[order] = np.where(ids > ids[heads][group], whole, bits[group])
    if not known.all():
        levels.append(_Level(own.rows[~known], own.ids[~known]))
        while len(levels) > 1 and len(levels[-2]) <= 2 * len(levels[-1]):
            last = levels.pop()
            levels[-1] = levels[-1].merged(last)
    return out


def _spans_of(bits, place, width: int):
    """Row number and packed span of each run of bits."""
    import numpy as np

    at, spans, rows = np.arange(len(bits)), [], []
    bits = bits.copy()
    while True:
        left = np.flatnonzero(bits)
        if not len(left):
            break
        at, bits, place = at[left], bits[left], place[left]
        lowest = bits & (~bits + np.uint64(1))
        grown = bits + lowest  # the carry runs through the lowest run of bits
        run = bits & ~grown
        first = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
        count = np.bitwise_count(run).astype(np.int64)
        spans.append((place - first - count + 1) << LENGTH_BITS | (count - 1 + width))
        rows.append(at)
        bits = bits & ~run
    if not spans:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(spans)


def _drained(items: list):
    """The items in order, each let go of as the next one is taken."""
    items.reverse()
    while items:
        yield items.pop()


def _shard_spans(width: int):
    """Function of one shard's blocks: ``(id, mark, span)``."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        lists, raws = [], []
        for block in table.column("block"):
            arrays, raw = _unpack(block.as_py(), 6, 3)
            lists.append(arrays)
            raws.append(raw)
        ids, marks, place, done_ids, done_marks, done = (np.concatenate(x) for x in zip(*lists))
        # one array for all rows; what it is filled from goes block by block
        rows, filled = np.empty((len(ids), 2 * width - ANCHOR + 2), np.uint8), 0
        for low, high, flat in _drained(raws):
            lines = np.zeros((len(low), 2 * width - ANCHOR), np.uint8)
            lines[_covered(low, high, width)] = flat
            rows[filled : filled + len(low)] = _rows(lines, low, high, width)
            filled += len(low)
        order = np.argsort(ids, kind="stable")
        ids, marks, place = ids[order], marks[order], place[order]
        levels: list[_Level] = []
        all_ids, all_marks, all_spans = [done_ids], [done_marks], [done]
        begin = 0
        while begin < len(ids):
            # a batch ends with an id, so that levels hold smaller ones only
            end = int(np.searchsorted(ids, ids[min(begin + BATCH_ROWS, len(ids)) - 1], "right"))
            bits = _scan(rows[order[begin:end]], ids[begin:end], levels, width)
            at, spans = _spans_of(bits, place[begin:end], width)
            all_ids.append(ids[begin:end][at])
            all_marks.append(marks[begin:end][at])
            all_spans.append(spans)
            begin = end
        ids, marks, spans = (np.concatenate(x) for x in (all_ids, all_marks, all_spans))
        order = np.lexsort((spans, marks, ids))
        ids, marks, spans = ids[order], marks[order], spans[order]
        same = (ids[1:] == ids[:-1]) & (marks[1:] == marks[:-1])
        once = np.ones(len(ids), bool)
        once[1:] = ~(same & (spans[1:] == spans[:-1]))
        ids, marks, spans = ids[once], marks[once], spans[once]
        del rows, levels
        _give_back()
        return pa.table({"id": pa.array(ids), "mark": pa.array(marks), "span": pa.array(spans)})

    return run


def repeated_spans(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, mark, span)``: where texts repeat ``width`` bytes of a smaller id.

    A span is ``start << 8 | length`` in bytes of the UTF-8 text; spans overlap. ``mark`` is 0 where ids are unique, else a hash of the
    text that tells rows of one id apart.
    """
    return _found(_marked(docs, key, text), width)


def _found(marked: DataFrame, width: int) -> DataFrame:
    if not 2 * ANCHOR <= width <= ANCHOR + 63:
        raise ValueError(f"width must lie between {2 * ANCHOR} and {ANCHOR + 63}")
    spark = marked.sparkSession
    for_python(spark)
    texts = marked.where("id IS NOT NULL")
    heat, size = _heat(texts)
    shards = max(1, -(-size // SHARD_BYTES))
    blocks = _blocks(texts, spark.sparkContext.broadcast(heat), shards, width)
    return blocks.groupBy("shard").applyInArrow(_shard_spans(width), "id long, mark long, span long")


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, mark, text)``; the mark is needed only where an id repeats."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    repeats = rows.where("id IS NOT NULL").groupBy("id").count().where("count > 1").limit(1).count() > 0
    mark = F.xxhash64("text") if repeats else F.lit(0).cast("long")
    return rows.select("id", mark.alias("mark"), "text")


def _compressed(rows: DataFrame) -> DataFrame:
    """The texts as they go through the shuffle: size in bytes, then a zstd frame."""

    def run(batches):
        import pyarrow as pa

        codec = pa.Codec("zstd", 3)
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast("binary").to_pylist()]
            packed = [len(t).to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["id", "mark", "text"]
            )

    return rows.select("id", "mark", "text").mapInArrow(run, "id long, mark long, text binary")


def _cut(rows: DataFrame) -> DataFrame:
    """What is left of each compressed text without its spans, as counts and bytes."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        codec = pa.Codec("zstd")
        for batch in batches:
            texts = [
                codec.decompress(t[8:], int.from_bytes(t[:8], "little"), asbytes=True)
                for t in batch.column(1).to_pylist()
            ]
            removed, runs, kept = [], [], []
            for data, spans in zip(texts, batch.column(2)):
                spans = spans.values
                if spans is None or not len(spans):
                    removed.append(0)
                    runs.append(0)
                    kept.append(data)
                    continue
                spans = np.sort(spans.to_numpy())
                start, end = spans >> LENGTH_BITS, (spans >> LENGTH_BITS) + (spans & ((1 << LENGTH_BITS) - 1))
                reach = np.maximum.accumulate(end)
                first = np.concatenate([[True], start[1:] > reach[:-1]])
                begins = start[first]
                ends = reach[np.concatenate([first[1:], [True]])]
                at = [0, *ends.tolist()]
                kept.append(b"".join([data[a:b] for a, b in zip(at, [*begins.tolist(), len(data)])]))
                removed.append(int((ends - begins).sum()))
                runs.append(len(begins))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return rows.select("id", "text", "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept)``: texts without what smaller ids say.

    Each byte goes that is covered by ``width`` bytes which also start in a text of a
    smaller id; texts are judged as they came in, as UTF-8 bytes, and matches never
    cross texts. ``n_spans`` counts the maximal removed runs, ``kept`` holds the bytes
    that are left, which need not be whole characters.

    Null texts count as empty. A row without an id neither loses nor takes anything.
    Rows that repeat an id do not touch each other; each is judged by itself. Other
    columns are not read; an empty table gives an empty result.

    Windows are filed under an anchor of 16 bytes, so that equal ones meet in one
    shard. Tasks send batches of suffixes; a shard takes them in order of ids, gives
    each batch a suffix array, scans it against the levels that it has and merges levels
    of like size. Shards are sized by the bytes of all texts; the rarest anchor is taken,
    and copies of a segment meet in the task already, so a common passage crowds none.
    """
    rows = _marked(docs, key, text)
    found = _found(rows, width).groupBy("id", "mark").agg(F.collect_list("span").alias("spans"))
    judged = _compressed(rows.where("id IS NOT NULL")).join(found, ["id", "mark"], "left").select("id", "text", "spans")
    without = _compressed(rows.where("id IS NULL")).select(
        "id", "text", F.lit(None).cast("array<bigint>").alias("spans")
    )
    return _cut(judged.unionByName(without)).withColumnRenamed("id", key)
