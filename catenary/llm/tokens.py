"""Encoding a corpus with a public byte-level BPE (problem 6).

Method: tree concatenation. A text of more than ``PIECE`` characters is halved, wherever the middle falls, until its pieces are
short; the pieces are encoded in parallel threads, outside Python's lock; then neighbours are joined, and neighbours of those, up
to the whole text. At a join the words around it are split and encoded again in a window that grows until both sides agree: its
first word is the one that the left side has there, so nothing before it can have changed, and one of its later words begins where a
word of the right side begins, from where on the right side's ids stand, since the split of a text from a place on depends on
nothing before it. A single word that runs over the join (a long run without a break) is joined by its ids in the same way: ids
around the join are encoded again as one text, and the window grows until its first and last id are what the two sides have there;
a list of ids is the encoding of a word if every two neighbours are that of theirs.

All of it happens where the text lies: one pass over the corpus without any exchange.

Defined results: null and empty texts have an empty list; blank texts are encoded like any other; strings that look like special
tokens are ordinary text. Each row of the input gives one row, repeated ids too. Other columns are not read. The vocabulary file
is a parameter, read once by each Python worker; it is not copied anywhere.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a piece.
PIECE = 2048
#: Words, or ids within a word, on each side of a join that are encoded again at first.
WINDOW = 4
#: Threads that encode the pieces of one long text.
THREADS = 4


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("catenary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _words():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def joined(left: list[int], right: list[int], encode: Callable[[bytes], list[int]], text: Callable[[list[int]], bytes], window: int = WINDOW) -> list[int]:
    """The encoding of two parts of a word as one, from the encodings of each."""
    if not left or not right:
        return left or right
    a, b = window, window
    while True:
        i, j = max(0, len(left) - a), min(len(right), b)
        ids = encode(text(left[i:]) + text(right[:j]))
        on_left, on_right = i == 0 or ids[0] == left[i], j == len(right) or ids[-1] == right[j - 1]
        if on_left and on_right:
            return left[:i] + ids + right[j:]
        a, b = (a if on_left else 2 * a), (b if on_right else 2 * b)


def _last_words(text: str, start: int, end: int, least: int) -> list[int]:
    """Where the last words of text[start:end] begin: at least so many, or all. The split is begun at a place that surely is one,
    white space after another character, or at the start."""
    reach = 64
    while True:
        at = max(start, end - reach)
        while at > start and not (text[at] in " \n\r\t" and not text[at - 1].isspace()):
            at -= 1
        found = [m.start() for m in _words().finditer(text, at, end)]
        if at == start or len(found) >= least:
            return found
        reach *= 4


def _taken(ids: list[int], size: int, length: Callable[[int], int], from_end: bool) -> int:
    """How many ids at one end make up so many bytes."""
    n = 0
    while size > 0:
        size -= length(ids[-1 - n] if from_end else ids[n])
        n += 1
    return n


class Tree:
    """Encodes texts in pieces. ``counts``: joins made, and windows that had to grow."""

    def __init__(self, path: str, piece: int = PIECE, threads: int = THREADS):
        self.e, self.piece, self.threads, self.counts = encoding(path), piece, threads, Counter()
        self.length = lru_cache(maxsize=None)(lambda i: len(self.e.decode_single_token_bytes(i)))

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.piece:
            return self.e.encode_ordinary(text)
        spans = []

        def halve(a: int, b: int) -> None:
            if b - a <= self.piece:
                spans.append((a, b))
            else:
                halve(a, (a + b) // 2)
                halve((a + b) // 2, b)

        halve(0, len(text))
        parts = self.e.encode_ordinary_batch([text[a:b] for a, b in spans], num_threads=self.threads)
        nodes = [(a, b, ids) for (a, b), ids in zip(spans, parts)]
        while len(nodes) > 1:
            nodes = [self.join(text, nodes[k], nodes[k + 1]) if k + 1 < len(nodes) else nodes[k] for k in range(0, len(nodes), 2)]
        return nodes[0][2]

    def join(self, text: str, left: tuple[int, int, list[int]], right: tuple[int, int, list[int]]) -> tuple[int, int, list[int]]:
        """The encoding of two neighbouring stretches of a text as one."""
        (a, m, ids), (_, b, more) = left, right
        self.counts["joins"] += 1
        words = _words()
        back, ahead = WINDOW, WINDOW
        while True:
            before = _last_words(text, a, m, back + 1)
            start = before[-back] if len(before) > back else a
            begins, end = [], b
            for found in words.finditer(text, m, b):
                begins.append(found.start())
                if len(begins) > ahead + 2:
                    end = found.start()
                    break
            window = [w.span() for w in words.finditer(text, start, end)]
            # the first word is the left side's if it ends where that one ends, before the join
            next_left = before[-back + 1] if len(before) > back and back > 1 else m
            on_left = start == a or (window[0][1] == next_left and next_left < m)
            # words near the window's end may depend on what follows it
            sure = {w[0] for w in window} if end == b else {w[0] for w in window[:-2]}
            stop = b if end == b and not begins[1:] else next((x for x in begins[1:] if x in sure), b if end == b else None)
            if on_left and stop is not None:
                break
            self.counts["grown"] += 1
            back, ahead = (back if on_left else 2 * back), (ahead if stop is not None else 2 * ahead)
        keep = len(ids) - _taken(ids, len(text[start:m].encode()), self.length, True)
        skip = _taken(more, len(text[m:stop].encode()), self.length, False)
        between: list[int] = []
        for x, y in window:
            if x >= stop:
                break
            if x < m < y and y - x > self.piece and x in before and (y in begins or y == b):  # a long word of both sides: by its ids
                own = _taken(ids, len(text[x:m].encode()), self.length, True)
                other = _taken(more, len(text[m:y].encode()), self.length, False)
                between += joined(ids[len(ids) - own :], more[:other], self.e._encode_single_piece, self.e.decode_bytes)
            else:
                between += self.e._encode_single_piece(text[x:y].encode())
        return a, b, ids[:keep] + between + more[skip:]


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, piece: int = PIECE, counts: bool = False) -> DataFrame:
    """key and ids (a list of bigint) of each row; with ``counts`` also how many joins were made for it, and windows grown."""
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(path, piece)
        for batch in batches:
            ids, joins, grown = [], [], []
            for t in batch.column(1).to_pylist():
                tree.counts.clear()
                ids.append(tree.encode(t) if t else [])
                joins.append(tree.counts["joins"])
                grown.append(tree.counts["grown"])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(joins, pa.int64()), pa.array(grown, pa.int64())], ["__key", "ids", "joins", "grown"])

    found = rows.mapInArrow(run, f"__key {kind}, ids array<bigint>, joins bigint, grown bigint")
    return found.select(F.col("__key").alias(key), "ids", *(["joins", "grown"] if counts else []))
