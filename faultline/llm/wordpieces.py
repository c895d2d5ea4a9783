"""Token counts by greedy longest match, in one pass over the letters and without building pieces.

The vocabulary is a trie of byte strings; a word ends with a closing symbol, which pieces that end a word contain. The last piece of a
word may be any piece, with or without a closing form of its own; the others have none. Each trie node
has a failure link, the node that stands for what remains once the longest pieces of its string are taken, and the number of pieces taken
on the way. A letter without an edge follows failure links and adds their numbers; no letter is read twice.

Words: runs of small letters and bytes beyond ASCII, single digits, and runs of other signs, between ASCII white space, after lower-casing
A-Z. A word with a byte that is no piece counts as one token; the public vocabulary has every byte. Counts of chunks between white space are kept in a bounded cache.

Cases: null and empty texts have no words and no tokens. A word of any length takes time in proportion to it. Null and repeated ids
are counted row by row.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import Cache, slices, texts_of
from faultline.llm.tokens import WORD_END, byte_of_letter

VOCABULARY = "word_bpe_49k.json"
END = 256  # the closing symbol, beyond all bytes
_WORD = re.compile(rb"[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")
_ROOT, _NONE = 0, -1


def vocabulary(path: str) -> list[tuple[int, ...]]:
    """The pieces of a byte-level vocabulary file as symbols; those that end a word end with END.

    Pieces without a word end come in both forms, as any of them can be a word's last: else greedy words would end on one without a way on.
    """
    letters = byte_of_letter()
    pieces = {}
    for token in json.loads(open(path, encoding="utf-8").read())["model"]["vocab"]:
        ends = token.endswith(WORD_END) and token != WORD_END
        body = token[: -len(WORD_END)] if ends else token
        if all(c in letters for c in body):
            piece = tuple(letters[c] for c in body)
            pieces |= dict.fromkeys([(*piece, END)] if ends else [piece, (*piece, END)])
    return list(pieces)


class Automaton:
    def __init__(self, pieces: Iterable[tuple[int, ...]]):
        self.edges: dict[int, int] = {}  # node * 512 + symbol -> node
        children: list[list[tuple[int, int]]] = [[]]
        whole = [False]
        for piece in pieces:
            node = _ROOT
            for symbol in piece:
                after = self.edges.get(node * 512 + symbol)
                if after is None:
                    after = self.edges[node * 512 + symbol] = len(children)
                    children[node].append((symbol, after))
                    children.append([])
                    whole.append(False)
                node = after
            whole[node] = node != _ROOT
        self.fail = [_NONE] * len(children)
        self.popped = [0] * len(children)
        queue = deque([_ROOT])
        while queue:
            parent = queue.popleft()
            for symbol, node in children[parent]:
                queue.append(node)
                if whole[node]:
                    self.fail[node], self.popped[node] = _ROOT, 1
                    continue
                at, taken = self.fail[parent], self.popped[parent]
                while at != _NONE and at * 512 + symbol not in self.edges:
                    taken += self.popped[at]
                    at = self.fail[at]
                if at != _NONE:
                    self.fail[node], self.popped[node] = self.edges[at * 512 + symbol], taken
        self.ends = {node for node in range(len(children)) if whole[node]}

    def count(self, word: bytes) -> int:
        """The number of pieces of a word, or 1 if it cannot be spelled."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, total = _ROOT, 0
        for symbol in (*word, END):
            after = edges.get(node * 512 + symbol)
            while after is None:
                total += popped[node]
                node = fail[node]
                if node == _NONE:
                    return 1
                after = edges.get(node * 512 + symbol)
            node = after
        while node != _ROOT:
            total += popped[node]
            node = fail[node]
            if node == _NONE:
                return 1
        return total

    def counts(self, chunk: bytes) -> int:
        """Words of a chunk, times 2^32, and its pieces."""
        words = _WORD.findall(chunk.lower())
        return (len(words) << 32) + sum(map(self.count, words))


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary(path or public_tokenizers.path(VOCABULARY))))
    cache = Cache(None)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache.make = shared.value.counts
        for batch in slices(batches):
            both = [sum(map(cache.__getitem__, (t or b"").split())) for t in texts_of(batch)]
            columns = [batch.column("doc_id"), pa.array([x >> 32 for x in both], pa.int64()), pa.array([x & 0xFFFFFFFF for x in both], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(counted, "doc_id long, n_words long, n_tokens long")
