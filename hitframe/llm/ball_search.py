"""Ranked lexical search by inner products over sparse ball trees."""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitframe.sources.stages import materialise

from .common import arrow_rows, for_python

# A term in UTF-8: digits, letters and whatever is beyond ASCII. Only A-Z are lower-cased.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
# documents, and distinct terms of documents, of one tree
TREE_DOCS, TREE_ENTRIES = 2048, 1 << 20
LEAF = 64
# queries, and terms of queries, that go through the trees together
QUERIES, QUERY_TERMS = 256, 1 << 14
# Bounds are worked out in doubles; they are raised by more than rounding can lower them.
SLACK = 1e-9
# first merges of a query's best documents
PARTS = 64


def terms_of(text: bytes | None) -> list[bytes]:
    return TERM.findall(text.lower()) if text else []


def _bytes_of(column) -> list[bytes | None]:
    return column.cast("binary").to_pylist()


def _pack(**arrays) -> bytes:
    """Arrays in one compressed block."""
    import pyarrow as pa

    names = list(arrays)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([a.tobytes()], pa.large_binary()) for a in arrays.values()], names=names
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(block: bytes, **kinds):
    import numpy as np
    import pyarrow as pa

    row = pa.ipc.open_stream(block).read_all().to_pylist()[0]
    return [np.frombuffer(row[name], kind) for name, kind in kinds.items()]


# --- index ------------------------------------------------------------------


def _tree(starts, terms, weights, n_terms: int):
    """Order of the documents, and the nodes ``(start, end, first child or 0)``.

    From the document farthest from the first and the one farthest from that, the
    members of a node are split halfway along the line between the two. All nodes of a
    level are split in one go.
    """
    import numpy as np

    n = len(starts) - 1
    sizes = np.diff(starts)
    norms = np.add.reduceat(weights * weights, starts[:-1])
    order = np.arange(n)
    nodes = [[0, n, 0]]
    level = [0]
    while level := [i for i in level if nodes[i][1] - nodes[i][0] > LEAF]:
        node = np.zeros(n, np.int64)  # of each document, by its place in this level
        for place, i in enumerate(level):
            node[order[nodes[i][0] : nodes[i][1]]] = place
        entry_node = np.repeat(node, sizes)

        def apart(pivots):
            """Squared distance of each document from its node's pivot."""
            table = np.zeros((len(level), n_terms))
            for place, p in enumerate(pivots):
                table[place, terms[starts[p] : starts[p + 1]]] = weights[starts[p] : starts[p + 1]]
            dots = np.add.reduceat(weights * table[entry_node, terms], starts[:-1])
            return norms - 2 * dots + norms[np.array(pivots)][node]

        def farthest(distance):
            return [int(m[distance[m].argmax()]) for m in (order[nodes[i][0] : nodes[i][1]] for i in level)]

        a = farthest(apart([int(order[nodes[i][0]]) for i in level]))
        from_a = apart(a)
        from_b = apart(farthest(from_a))
        along = from_a - from_b
        below = []
        for i in level:
            start, end, _ = nodes[i]
            members = order[start:end]
            order[start:end] = members[np.argsort(along[members], kind="stable")]
            middle = (start + end + 1) // 2
            nodes[i][2] = len(nodes)
            below += [len(nodes), len(nodes) + 1]
            nodes += [[start, middle, 0], [middle, end, 0]]
        level = below
    return order, np.array(nodes, np.int64)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The trees as a table ``(docs, tokens, terms, counts, tree)``, one row per tree.

    A tree holds up to ``TREE_DOCS`` documents: their terms and frequencies in the
    order of the leaves, the nodes as ranges of that order, and a dictionary of terms
    with the number of its documents that hold each. Documents without terms have no
    place in it. Nothing is shuffled.
    """
    for_python(docs.sparkSession)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def tree():
            sizes = np.array([len(t) for _, _, t, _ in held], np.int64)
            terms = np.concatenate([t for _, _, t, _ in held])
            tf = np.concatenate([f for _, _, _, f in held])
            starts = np.concatenate([[0], np.cumsum(sizes)])
            n_terms = len(names)
            df = np.bincount(terms, minlength=n_terms)
            weights = tf / (tf + 1.2) * np.log((len(held) + 1) / df)[terms]
            order, nodes = _tree(starts, terms, weights, n_terms)
            move = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in order])
            lengths = np.array([n for _, n, _, _ in held], np.int64)
            ids = pa.array([i for i, _, _, _ in held], pa.int64()).take(pa.array(order))
            block = _pack(
                ids=ids.fill_null(0).to_numpy(),
                named=~ids.is_null().to_numpy(zero_copy_only=False),
                lengths=lengths[order],
                sizes=sizes[order],
                terms=terms[move].astype(np.int32),
                tf=tf[move].astype(np.int64),
                nodes=nodes.ravel(),
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([len(held)], pa.int64()),
                    pa.array([int(lengths.sum())], pa.int64()),
                    pa.array([b" ".join(names)], pa.binary()),
                    pa.array([df.astype(np.int32).tobytes()], pa.binary()),
                    pa.array([block], pa.binary()),
                ],
                names=["docs", "tokens", "terms", "counts", "tree"],
            )

        held, entries, names = [], 0, defaultdict(count().__next__)
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), _bytes_of(batch.column(1))):
                found = terms_of(data)
                if not found:
                    continue
                numbers = np.fromiter(map(names.__getitem__, found), np.int64, len(found))
                terms, tf = np.unique(numbers, return_counts=True)
                held.append((i, len(found), terms, tf))
                entries += len(terms)
                if len(held) >= TREE_DOCS or entries >= TREE_ENTRIES:
                    yield tree()
                    held, entries, names = [], 0, defaultdict(count().__next__)
        if held:
            yield tree()

    schema = "docs long, tokens long, terms binary, counts binary, tree binary"
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(run, schema), "ball-trees")


# --- search -----------------------------------------------------------------


def _query_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """The queries as term counts, a bounded number at a time."""
    block, terms = [], 0
    for row in items.toLocalIterator():
        counts = Counter(terms_of(None if row["text"] is None else row["text"].encode()))
        if not counts:
            continue
        if block and (len(block) >= QUERIES or terms + len(counts) > QUERY_TERMS):
            yield block
            block, terms = [], 0
        block.append((row["item"], counts))
        terms += len(counts)
    if block:
        yield block


def _document_counts(index: DataFrame, vocabulary: dict[bytes, int]):
    """In how many documents each term of the vocabulary occurs."""
    import numpy as np

    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        import pyarrow as pa

        known = shared.value
        counts = np.zeros(len(known), np.int64)
        for batch in batches:
            for terms, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                df = np.frombuffer(df, np.int32)
                place = np.array([known.get(t, -1) for t in terms.split(b" ")], np.int64)
                counts[place[place >= 0]] += df[place >= 0]
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["term", "df"])

    rows = index.select("terms", "counts").mapInArrow(run, "term long, df long")
    out = np.zeros(len(vocabulary), np.int64)
    for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def _weights(df, n: int):
    import math

    import numpy as np

    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) if d else 0 for d in df], np.int64)


def _length_factors(lengths, n: int, tokens: int):
    """100 - 25 + (25 * length * n) div tokens, in whole numbers of any size."""
    import numpy as np

    if 25 * int(lengths.max()) * n < 1 << 62:
        return 75 + (25 * lengths * n) // tokens
    return np.array([75 + 25 * int(x) * n // tokens for x in lengths], np.int64)


def _balls(nodes, docs, columns, values, n_docs: int, width: int):
    """Centres and radii of all nodes, over the terms that are asked for.

    The centre of a node is the mean of its documents, the radius the distance of the
    farthest one, raised by more than the rounding of its parts.
    """
    import numpy as np

    values = values.astype(np.float64)
    norms = np.bincount(docs, values * values, n_docs)
    centres, radii = np.zeros((len(nodes), width)), np.zeros(len(nodes))
    starts = np.searchsorted(docs, np.arange(n_docs + 1))
    for i, (a, b, _) in enumerate(nodes):
        cut = slice(starts[a], starts[b])
        centres[i] = np.bincount(columns[cut], values[cut], width) / (b - a)
        norm = centres[i] @ centres[i]
        dots = np.bincount(docs[cut] - a, values[cut] * centres[i][columns[cut]], b - a)
        apart = norms[a:b] - 2 * dots + norm
        radii[i] = np.sqrt(np.maximum(apart + SLACK * (norms[a:b] + norm), 0).max())
    return centres, radii


def _search_tree(row: dict, known: dict[bytes, int], weights, asked, norms, n: int, tokens: int, best, k: int) -> None:
    """Let each query take what it wants from one tree; ``best`` holds a heap per query."""
    import numpy as np

    place = np.array([known.get(t, -1) for t in row["terms"].split(b" ")], np.int64)
    kinds = {"ids": np.int64, "named": bool, "lengths": np.int64, "sizes": np.int64, "terms": np.int32, "tf": np.int64, "nodes": np.int64}
    ids, named, lengths, sizes, terms, tf, nodes = _unpack(row["tree"], **kinds)
    nodes = nodes.reshape(-1, 3)
    column = place[terms]
    docs = np.repeat(np.arange(len(ids)), sizes)
    used = (column >= 0) & named[docs]
    used[used] = weights[column[used]] > 0
    docs, column, tf = docs[used], column[used], tf[used]
    if not len(docs):
        return
    factor = _length_factors(lengths, n, tokens)[docs]
    values = weights[column] * ((1_000_000_000 * tf) // (1000 * tf + 12 * factor))
    centres, radii = _balls(nodes, docs, column, values, len(ids), len(weights))
    # an upper bound of every node for every query
    reach = radii[:, None] * norms[None, :]
    bounds = (centres @ asked.T.astype(np.float64) + reach) * (1 + SLACK) + 1
    starts = np.searchsorted(docs, np.arange(len(ids) + 1))
    for q, heap in enumerate(best):
        floor_ = lambda: heap[0][0] if len(heap) == k else 0
        open_ = [(-bounds[0, q], 0)]
        while open_:
            bound, i = heapq.heappop(open_)
            if -bound < floor_():
                break  # no other node promises more
            a, b, child = nodes[i]
            if child:
                for c in (child, child + 1):
                    if bounds[c, q] >= floor_():
                        heapq.heappush(open_, (-bounds[c, q], c))
                continue
            cut = slice(starts[a], starts[b])
            parts = values[cut] * asked[q][column[cut]]
            totals = np.zeros(b - a, np.int64)
            np.add.at(totals, docs[cut] - a, parts)
            for at in np.flatnonzero(totals >= max(1, floor_())):
                found = (int(totals[at]), -int(ids[a + at]))
                if len(heap) < k:
                    heapq.heappush(heap, found)
                elif found > heap[0]:
                    heapq.heapreplace(heap, found)


def _best(index: DataFrame, block, n: int, tokens: int, k: int) -> DataFrame:
    """``(item, query, doc, score, part)``: the best documents of each task per query."""
    import numpy as np

    known: dict[bytes, int] = {}
    for _, counts in block:
        for term in counts:
            known.setdefault(term, len(known))
    asked = np.zeros((len(block), len(known)), np.int64)
    for q, (_, counts) in enumerate(block):
        for term, times in counts.items():
            asked[q, known[term]] = times
    weights = _weights(_document_counts(index, known), n)
    shared = index.sparkSession.sparkContext.broadcast((known, weights, asked, [i for i, _ in block]))

    def run(batches):
        import pyarrow as pa

        known, weights, asked, items = shared.value
        norms = np.sqrt((asked.astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                _search_tree(row, known, weights, asked, norms, n, tokens, best, k)
        rows = [(items[q], q, -doc, score) for q, heap in enumerate(best) for score, doc in heap]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("item", "query", "doc", "score"), r)) for r in rows],
            schema=pa.schema([("item", pa.int64()), ("query", pa.int32()), ("doc", pa.int64()), ("score", pa.int64())]),
        )

    found = index.select("terms", "tree").mapInArrow(run, "item long, query int, doc long, score long")
    return found.withColumn("part", F.spark_partition_id() % PARTS)


def search(index: DataFrame, items: DataFrame, k: int = 20, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(key, rank, doc_id, score)``: the ``k`` best documents of each item.

    The score is the inner product of an item's term counts with the weighted, length
    normalised frequencies of a document, all in whole numbers. Items go through the
    trees in blocks of bounded size. For a block the ball of every node is drawn in the
    space of the block's terms; a query opens nodes in the order of their bounds until no
    bound reaches its k-th score, and scores the documents of open leaves exactly. What
    the balls cannot rule out is scored, so the result is exact whatever they exclude.

    Equal items are one; items without terms have no rows. Items of one id with other
    texts are ranked each by itself. Documents without an id count, but are not ranked.
    """
    spark = index.sparkSession
    names = [key, "rank", "doc_id", "score"]
    size = index.agg(F.sum("docs").alias("n"), F.sum("tokens").alias("t")).first()
    found = None
    if size["n"]:
        each = items.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).distinct()
        with arrow_rows(spark, 2):
            for number, block in enumerate(_query_blocks(each)):
                part = _best(index, block, size["n"], size["t"], k).withColumn("query", F.col("query") + number * QUERIES)
                part = materialise(part, "ranked-parts")
                found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"{key} long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc")]
    first = F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    kept = found.withColumn("_at", first).where(F.col("_at") <= k).withColumn("rank", rank).where(F.col("rank") <= k)
    return kept.select(F.col("item").alias(key), "rank", F.col("doc").alias("doc_id"), "score").toDF(*names)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Index the documents and rank them for every item: ``build_index``, then ``search``.

    Null and empty texts have no terms: such documents are in no count and such items in
    no result. Repeated documents are ranked each by itself, equal scores by id. Other
    columns are not read; empty tables give no rows.
    """
    return search(build_index(docs), items, k)
