"""Byte-level BPE with word ends: encode whole texts, decode the ids again."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import byte_letters, for_python

# words up to this many symbols use the rank array, longer ones a heap
SHORT = 256
# words kept per worker; beyond it the cache starts anew
CACHED = 1 << 18

# What the vocabulary's own pattern takes from text of Latin-1 characters, which the
# normal form leaves as they are: contractions, letters, single numbers, the rest.
_LETTER = "a-zªµºß-öø-ÿ"
_NUMBER = "0-9²³¹¼½¾"
_BLANK = " \t-\r\x85\xa0"
_LATIN_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+"
)


class WordBpe:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = dict(model["vocab"])
        self.ranks = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.letters = byte_letters()
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.cache: dict[str | tuple[str], list[int]] = {}
        self.path = path
        self._library = None

    def merge(self, symbols: str) -> list[int]:
        """Ids of one word, written in byte letters."""
        bounds = [*range(len(symbols)), len(symbols) + len(self.end)]
        symbols += self.end
        merged = self._by_rank_array if len(bounds) <= SHORT else self._by_heap
        bounds = merged(symbols, bounds)
        return [self.vocab[symbols[a:b]] for a, b in zip(bounds, bounds[1:])]

    def _by_rank_array(self, s: str, bounds: list[int]) -> list[int]:
        """Boundaries of the parts and, beside them, the rank of each neighbour pair.

        The smallest rank is sought again and again; its inner boundary goes and
        the two ranks next to it are looked up anew.
        """
        none = len(self.ranks)
        rank = lambda i: self.ranks.get(
            (s[bounds[i] : bounds[i + 1]], s[bounds[i + 1] : bounds[i + 2]]), none
        )
        ranks = [rank(i) for i in range(len(bounds) - 2)]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(i)
            if i:
                ranks[i - 1] = rank(i - 1)
        return bounds

    def _by_heap(self, s: str, bounds: list[int]) -> list[int]:
        """The same merges for a very long word in n log n steps."""
        end = len(s)
        after = dict(zip(bounds, bounds[1:]))
        before = dict(zip(bounds[1:], bounds))

        def offer(a: int) -> None:
            b = after[a]
            if b < end and (r := self.ranks.get((s[a:b], s[b : after[b]]))) is not None:
                heapq.heappush(heap, (r, a, b, after[b]))

        heap: list[tuple[int, int, int, int]] = []
        for a in bounds[:-1]:
            offer(a)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if after.get(a) != b or after.get(b) != c:
                continue
            after[a], before[c] = c, a
            del after[b], before[b]
            offer(a)
            if a in before:
                offer(before[a])
        return [*sorted(after), end]

    def _words(self, text: str) -> Iterator[str]:
        """Words in byte letters, for text beyond Latin-1: the library's own rules."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        normal = self._library.normalizer.normalize_str(text)
        return (w for w, _ in self._library.pre_tokenizer.pre_tokenize_str(normal))

    def _plain(self, text: str) -> list[int]:
        """Ids of text without special tokens."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            words, in_letters = list(self._words(text)), True
        else:
            words, in_letters = _LATIN_WORD.findall(text.lower()), False
        out: list[int] = []
        cache = self.cache
        for word in words:
            # words in byte letters have keys of their own
            name = (word,) if in_letters else word
            ids = cache.get(name)
            if ids is None:
                letters = self.letters
                ids = self.merge(word if in_letters else "".join([letters[b] for b in word.encode()]))
                if len(cache) >= CACHED:
                    cache.clear()
                cache[name] = ids
            out += ids
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if "<|" not in text:
            return self._plain(text)
        out: list[int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self._plain(part) if part else []
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens side by side: the vocabulary names no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One encoder per worker process, so that its cache outlives a task."""
    return WordBpe(path)


def encode_texts(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, ids, decoded)`` for every row and whole text.

    Rows are independent, so nothing is shuffled; a word's merges are done once per
    worker while they stay in its bounded cache. Null and empty texts have no ids
    and decode to the empty text. Repeated rows come out as often as they came in;
    other columns are not read.
    """
    for_python(docs.sparkSession)
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches):
        import pyarrow as pa

        bpe = word_bpe(vocabulary)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            decoded = [bpe.decode(i) for i in ids]
            columns = [
                batch.column(0),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array(decoded, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "ids", "decoded"])

    return docs.select(key, text).mapInArrow(run, schema)
