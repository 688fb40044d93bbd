"""Held-out test items that stand in corpus documents (problem 7).

Method: one Aho-Corasick automaton over the normalised items. Items and texts become words in one spelling (compatibility forms,
case and accents folded, markup left out, words broken at a line's end joined; scripts without spaces give a word per character).
The automaton holds every run of ``SHINGLE`` words of every item; a batch of texts goes through it once, as one string. Where
enough of an item's runs are met near each other, the stretch of the text around them is aligned with the item: blocks of equal
words are chained in order, with short insertions and omissions between them, so that the chain holds the most characters of the
item; the characters between neighbouring blocks, so altered and split words, count as far as they agree. The share of the item's
characters that stand in the stretch is the evidence. Chains are sought with long insertions and with short ones, so that a dense
passage is found beside a thin one. Only of a match the words' offsets in the original are worked out.

Stock phrases stand in many texts that hold nothing else of the item. They are found by counting, over all documents and items: a
longer run (of ``SHINGLE + LONGER`` words) that is met mostly in texts that are no case of any item that has it is stock. That
several items share a run says nothing, since items may be near copies or ask about one passage. A
match must have equal words in passages of that length (with at most ``SLIP`` altered words in a row) besides stock. Runs of that
length are hardly met by chance in a corpus of any size, and both counts grow with the corpus, so the rule does not depend on the
number of documents.

The items are a stated query set. They are gathered in blocks of bounded size, one automaton and one pass over the corpus for
each block, so that what a worker holds does not grow with the number of items.

Defined results: null and empty texts, and items without words, give no rows. Repeated items are items of their own; repeated
documents are answered each. A document and an item give at most one row, that of the best stretch.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Cut

#: Words of a run, and characters in scripts that are written without spaces.
SHINGLE, SHINGLE_DENSE = 4, 8
#: Words that an equal block has at least, likewise.
BLOCK, BLOCK_DENSE = 3, 5
#: Words that may be inserted between two blocks of one chain (the larger bound first), and of the item that may be missing there.
INSERTED, MISSING = (30, 12, 4), 60
#: Altered words in a row within one passage.
SLIP = 2
#: Share of the item's words that runs must cover before it is aligned; share of its characters that makes a case: a third of its
#: text, less what small alterations take from it.
GATE, SHARE = 0.12, 0.3
#: Share of its stretch of the text that a match fills at least, insertions and all.
DENSITY = 0.33
#: Characters of items in one automaton; characters of texts that go through it at once (a longer text goes alone).
ITEM_BLOCK, TEXT_BLOCK = 4_000_000, 2_000_000
#: Words by which the runs that tell stock phrases are longer.
LONGER = 2
#: Characters beyond stock phrases that the long blocks of a match have at least, as a share of the item and in all.
OWN_SHARE, OWN_CHARS = 0.06, 20

_DENSE = "぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"
_MARKUP = re.compile(r"<[a-zA-Z/!?][^<>]*>|&(?:#\d{1,6}|#x[0-9a-fA-F]{1,6}|[a-zA-Z]{2,8});")
_BREAK = re.compile(r"(?<=[^\W_])-\s{1,3}(?=[^\W\d_])")
_WORD, _WORD_DENSE = re.compile(r"[^\W_]+"), re.compile(rf"[{_DENSE}][゙゚]*|[^\W_{_DENSE}]+")
_IS_DENSE = re.compile(f"[{_DENSE}]")


@lru_cache(maxsize=1)
def _silent() -> re.Pattern:
    """Marks and characters without width, that no spelling needs; the two sound marks of Japanese stay."""
    codes = [c for c in (*range(0x20000), *range(0xE0000, 0xE1000)) if (unicodedata.combining(chr(c)) and c not in (0x3099, 0x309A)) or c == 0xAD or unicodedata.category(chr(c)) == "Cf"]
    spans = "".join(f"{chr(c)}" if a is None else f"{chr(a)}-{chr(c)}" for a, c in _spans(codes))
    return re.compile(f"[{spans}]")


def _spans(codes: list[int]) -> Iterator[tuple[int | None, int]]:
    start = codes[0]
    for a, b in pairwise([*codes, codes[-1] + 2]):
        if b != a + 1:
            yield (start if start != a else None), a
            start = b


def _blanked(text: str) -> str:
    """The text with blanks for markup, as long as before."""
    return _MARKUP.sub(lambda m: " " * len(m.group()), text) if "<" in text or "&" in text else text


def _folded(text: str) -> str:
    if "-" in text:
        text = _BREAK.sub("", text)
    return text.lower() if text.isascii() else _silent().sub("", unicodedata.normalize("NFKD", text).casefold())


@lru_cache(maxsize=100_000)
def _folded_char(c: str) -> str:
    return _silent().sub("", unicodedata.normalize("NFKD", c).casefold())


def _pattern(folded: str) -> re.Pattern:
    return _WORD if folded.isascii() or not _IS_DENSE.search(folded) else _WORD_DENSE


def spelled(text: str) -> list[str]:
    """The normalised words of a text."""
    folded = _folded(_blanked(text))
    return _pattern(folded).findall(folded)


def spans_of(text: str) -> list[tuple[int, int]]:
    """The places in the original text of its normalised words."""
    blank = _blanked(text)
    gone = {i for m in _BREAK.finditer(blank) for i in range(*m.span())}
    chars, at = [], []
    for i, c in enumerate(blank):
        if i not in gone:
            found = _folded_char(c)
            chars.append(found)
            at += [i] * len(found)
    folded = "".join(chars)
    return [(at[m.start()], at[m.end() - 1] + 1) for m in _pattern(folded).finditer(folded)]


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """The normalised words of a text and their places in it; markup gives none, and a word broken at a line's end is one."""
    return spelled(text), spans_of(text)


def _digest(run: list[str]) -> int:
    """The same number for the same run in every process."""
    return int.from_bytes(blake2b(" ".join(run).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


class Items:
    """The automaton of a block of items, with what alignment needs of each."""

    def __init__(self, rows: list[tuple[int, str]]):
        import ahocorasick

        self.ids, self.own, self.chars, self.dense, self.size, self.runs = [], [], [], [], [], []
        self.blocks: list[dict[tuple[str, ...], list[int]]] = []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, text in rows:
            words = spelled(text or "")
            if not words:
                continue
            at = len(self.ids)
            dense = sum(bool(_IS_DENSE.match(w)) for w in words) * 2 > len(words)
            n = min(SHINGLE_DENSE if dense else SHINGLE, len(words))
            self.ids.append(item)
            self.own.append(words)
            self.chars.append([len(w) for w in words])
            self.dense.append(dense)
            self.size.append(n)
            for k in range(len(words) - n + 1):
                places[f" {' '.join(words[k : k + n])} "].append((at, k))
            self.runs.append([_digest(words[k : k + n + LONGER]) for k in range(len(words) - n - LONGER + 1)])
            least = min(BLOCK_DENSE if dense else BLOCK, len(words))
            self.blocks.append(runs_of(words, least))
        self.automaton = ahocorasick.Automaton()
        for number, run in enumerate(places):
            self.automaton.add_word(run, number)
        if places:
            self.automaton.make_automaton()
        self.empty = not places
        # the places of run r are those from first[r] to first[r + 1]
        self.first = np.cumsum([0, *map(len, places.values())])
        flat = np.array([p for where in places.values() for p in where], np.int64).reshape(-1, 2)
        self.of, self.at = flat[:, 0], flat[:, 1]
        self.n = np.array(self.size, np.int64)
        self.length = np.array([len(w) for w in self.own], np.int64)
        # digests of the longer runs of all items, each item's after each other's
        self.base = np.cumsum([0, *map(len, self.runs)])
        self.digests = np.array([d for r in self.runs for d in r], np.int64)

    @property
    def words(self) -> dict[int, list[str]]:
        return dict(zip(self.ids, self.own))

    def hits(self, words: list[str]) -> dict[int, list[tuple[int, int, int]]]:
        """For each item met in one text: (word of the text, word of the item, length) of its runs, in the text's order."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for _, i, p, k in self.met([words]).T.tolist():
            found[self.ids[i]].append((p, k, self.size[i]))
        return found

    def met(self, texts: list[list[str]]) -> np.ndarray:
        """text, item (its number here), word of the text, word of the item of every run met, sorted by these."""
        whole = "".join(f" {' '.join(words)} " for words in texts)
        met = list(self.automaton.iter(whole)) if whole else []
        if not met:
            return np.zeros((4, 0), np.int64)
        end, run = np.array(met, np.int64).T
        spaces = np.flatnonzero(np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
        base = np.cumsum([0, *(max(1, len(w)) + 1 for w in texts)])  # each text has a space more than words, one without words two
        place = np.searchsorted(spaces, end)
        text = np.searchsorted(base, place, "right") - 1
        last = place - base[text] - 1
        count = self.first[run + 1] - self.first[run]
        row = np.repeat(np.arange(len(run)), count)
        flat = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + self.first[run][row]
        item, k = self.of[flat], self.at[flat]
        found = np.stack([text[row], item, last[row] - self.n[item] + 1, k])
        return found[:, np.lexsort(found[::-1])]

    def longer(self, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text, item and digest of the longer runs met: those of LONGER + 1 runs after each other."""
        text, item, p, k = hits
        order = np.lexsort([p, p - k, item, text])
        text, item, p, k = text[order], item[order], p[order], k[order]
        ahead = lambda x: x[LONGER:]
        here = lambda x: x[: len(x) - LONGER]
        on = (ahead(text) == here(text)) & (ahead(item) == here(item)) & (ahead(p) == here(p) + LONGER) & (ahead(k) == here(k) + LONGER)
        i = np.flatnonzero(on)
        return text[i], item[i], self.digests[self.base[item[i]] + k[i]]

    def stretches(self, hits: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
        """text, item, and the first and last word in text and item, of hits near each other that cover enough of the item."""
        text, item, p, k = hits
        if not len(text):
            return
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (p[1:] - p[:-1] > INSERTED[0] + self.n[item[1:]])
        number = np.cumsum(new) - 1
        order = np.lexsort([k, number])
        step = np.append(k[order][1:] - k[order][:-1], 1 << 40)
        step[:-1][number[order][1:] != number[order][:-1]] = 1 << 40
        covered = np.bincount(number, np.minimum(step, self.n[item[order]]))
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(text)) - 1
        for s in np.flatnonzero(covered >= GATE * self.length[item[start]]).tolist():
            a, b = start[s], stop[s]
            yield int(text[a]), int(item[a]), int(p[a]), int(p[b]), int(k[a]), int(k[b])


_CACHE: dict[int, Items] = {}


def _items(rows: list[tuple[int, str]], token: int) -> Items:
    if token not in _CACHE:
        _CACHE.clear()
        _CACHE[token] = Items(rows)
    return _CACHE[token]


def runs_of(item: list[str], least: int) -> dict[tuple[str, ...], list[int]]:
    """The item's runs of so many words, with the places where they begin."""
    starts: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for k in range(len(item) - least + 1):
        starts[tuple(item[k : k + least])].append(k)
    return starts


def equal_blocks(starts: dict[tuple[str, ...], list[int]], text: list[str]) -> list[tuple[int, int, int]]:
    """(word of the text, word of the item, words) of the longest equal blocks, by the item's runs of the least length."""
    least = len(next(iter(starts)))
    open_: dict[int, list[int]] = {}
    out = []
    for p in range(len(text) - least + 1):
        for k in starts.get(tuple(text[p : p + least]), ()):
            block = open_.get(p - k)
            if block and block[0] + block[2] == p + least - 1:
                block[2] += 1
            else:
                open_[p - k] = block = [p, k, least]
                out.append(block)
    return [tuple(b) for b in out]


def _between(item: list[str], text: list[str]) -> int:
    """Characters of the item's words that stand, altered or split, among the text's."""
    if not item or not text or len(text) > 3 * len(item) + 12:
        return 0
    a, b = "".join(item), "".join(text)
    return min(len(a), sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size >= 3))


def chained(blocks: list[tuple[int, int, int]], chars: list[int], inserted: int, least: int) -> list[tuple[int, int, int]]:
    """The blocks in order in text and item, with bounded gaps, that hold the most characters of the item."""
    blocks = sorted(blocks)
    before = np.concatenate([[0], np.cumsum(chars)]).tolist()
    best, came, cut = [], [], []
    for j, (p, k, n) in enumerate(blocks):
        top, source, trim = before[k + n] - before[k], -1, 0
        for i in range(j - 1, -1, -1):
            p0, k0, n0 = blocks[i]
            t = max(0, p0 + n0 - p, k0 + n0 - k)  # words that both blocks claim
            if n - t >= least and p - p0 - n0 <= inserted and 0 <= k + t - k0 - n0 <= MISSING and (x := best[i] + before[k + n] - before[k + t]) > top:
                top, source, trim = x, i, t
        best.append(top)
        came.append(source)
        cut.append(trim)
    out = []
    j = max(range(len(blocks)), key=best.__getitem__) if blocks else -1
    while j >= 0:
        p, k, n = blocks[j]
        out.append((p + cut[j], k + cut[j], n - cut[j]))
        j = came[j]
    return out[::-1]


def held(item: list[str], chars: list[int], chain: list[tuple[int, int, int]], text: list[str], needed: float) -> int:
    """Characters of the item that stand in a chain's blocks and between them; 0 if they cannot be as many as needed."""
    blocks = sum(sum(chars[k : k + n]) for _, k, n in chain)
    if blocks + sum(min(sum(chars[k + n : l]), sum(map(len, text[p + n : q]))) for (p, k, n), (q, l, _) in pairwise(chain)) < needed:
        return 0
    return blocks + sum(_between(item[k + n : l], text[p + n : q]) for (p, k, n), (q, l, _) in pairwise(chain))


def aligned(item: list[str], text: list[str], least: int) -> tuple[int, int, int, list[int]]:
    """The best chain in a text: characters of the item that stand in it, its first and last word, and the item's words that do."""
    chars = [len(w) for w in item]
    chain = chained(equal_blocks(runs_of(item, least), text), chars, INSERTED[0], least)
    if not chain:
        return 0, 0, 0, []
    return held(item, chars, chain, text, 0), chain[0][0], chain[-1][0] + chain[-1][2] - 1, [x for _, k, n in chain for x in range(k, k + n)]


def passages(chain: list[tuple[int, int, int]], least: int) -> list[int]:
    """The item's words in passages of a chain, blocks with at most SLIP altered words between them, of at least so many words."""
    out, passage, last = [], [], None
    for p, k, n in chain:
        if last and (p - last[0] > SLIP or k - last[1] > SLIP):
            out += passage if len(passage) >= least else []
            passage = []
        passage = passage + list(range(k, k + n))
        last = (p + n, k + n)
    return out + (passage if len(passage) >= least else [])


_FOUND = "kind int, doc_id bigint, item_id bigint, chars bigint, total bigint, first bigint, last bigint, places array<int>, n bigint, runs array<bigint>"


def _scan(rows: list[tuple[int, str]], token: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 1: a possible case. Kind 2: a text with possible cases, and the longer runs in it of their items. Kind 0: how many texts
    (n) have a longer run (first)."""
    items = _items(rows, token)
    met = Counter()
    columns = ("kind", "doc_id", "item_id", "chars", "total", "first", "last", "places", "n", "runs")
    kinds = (pa.int32(), *[pa.int64()] * 6, pa.list_(pa.int32()), pa.int64(), pa.list_(pa.int64()))

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], list(columns))

    def look(docs: list[int], texts: list[str]) -> list[tuple]:
        words = [spelled(t) for t in texts]
        hits = items.met(words)
        text, item, run = items.longer(hits)
        met.update(np.unique(np.stack([text, run]), axis=1)[1].tolist())
        best: dict[tuple[int, int], tuple] = {}
        for t, i, p0, p1, k0, k1 in items.stretches(hits):
            own, chars, total = items.own[i], items.chars[i], sum(items.chars[i])
            reach = 2 * items.size[i] + INSERTED[0]
            lo, hi = max(0, p0 - k0 - reach), min(len(words[t]), p1 + items.size[i] + (len(own) - k1) + reach)
            part, least = words[t][lo:hi], min(BLOCK_DENSE if items.dense[i] else BLOCK, len(own))
            blocks = equal_blocks(items.blocks[i], part)
            for inserted in INSERTED:
                chain = chained(blocks, chars, inserted, least)
                found = held(own, chars, chain, part, SHARE * total) if chain else 0
                if found < SHARE * total:
                    break  # a chain with shorter gaps holds no more
                first, last = chain[0][0], chain[-1][0] + chain[-1][2]
                if found >= DENSITY * sum(map(len, part[first:last])):
                    if found > best.get((t, i), (0,))[0]:
                        long = min(items.size[i] + LONGER, len(own))
                        best[t, i] = (found, total, lo + first, lo + last - 1, passages(chain, long))
                    break
        out = []
        cases: dict[int, set[int]] = defaultdict(set)
        for (t, i), (found, total, first, last, at) in best.items():
            cases[t].add(i)
            spans = spans_of(texts[t])
            out.append((1, docs[t], items.ids[i], found, total, spans[first][0], spans[last][1], at, items.size[i], None))
        runs: dict[int, set[int]] = defaultdict(set)
        for t, i, r in zip(text.tolist(), item.tolist(), run.tolist()):
            if i in cases.get(t, ()):
                runs[t].add(r)
        return out + [(2, docs[t], None, 0, 0, 0, 0, None, 0, sorted(r)) for t, r in runs.items()]

    for batch in batches:
        docs, texts, size, out = [], [], 0, []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text and not items.empty:
                docs.append(doc)
                texts.append(text)
                size += len(text)
                if size >= TEXT_BLOCK:
                    out += look(docs, texts)
                    docs, texts, size = [], [], 0
        if texts:
            out += look(docs, texts)
        if out:
            yield made(out)
    if met:
        yield made([(0, None, None, 0, 0, run, 0, None, c, None) for run, c in met.items()])


def leaked_items(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """doc_id, item_id, share (of the item's characters that stand in the text), start and end (offsets in the original text)."""
    spark = docs.sparkSession
    asked = items.select(F.col(item).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("t IS NOT NULL")
    size = asked.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-size // item_block) or 1
    texts = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL AND text <> ''")
    scanned = []
    for b in range(blocks):  # each gathers about item_block characters
        rows = [(r[0], r[1]) for r in asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()]
        token, shared = hash(tuple(rows)), spark.sparkContext.broadcast(rows)
        found = Cut(texts.mapInArrow(lambda batches, shared=shared, token=token: _scan(shared.value, token, batches), _FOUND), "leaks").df
        scanned.append((rows, found))
    # texts that have a run, and those of them that are a possible case of an item with it, of whatever block
    counts = None
    for _, found in scanned:
        met = found.where("kind = 0").groupBy(F.col("first").alias("run")).agg(F.sum("n").alias("met"))
        cased = found.where("kind = 2").select("doc_id", F.explode("runs").alias("run")).groupBy("doc_id", "run").agg(F.count("*").alias("texts"))
        more = met.select("run", "met", F.lit(None).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("texts")).unionByName(cased.select("run", F.lit(0).cast("bigint").alias("met"), "doc_id", "texts"))
        counts = more if counts is None else counts.unionByName(more)
    counts = counts.groupBy("run", "doc_id").agg(F.max("met").alias("met"), F.max("texts").alias("texts")).groupBy("run").agg(F.max("met").alias("met"), F.sum("texts").alias("cases"))
    stock_runs = Cut(counts.where("met >= 3 AND cases * 2 < met").select("run"), "stock").df
    cases = None
    for rows, found in scanned:
        built = Items(rows)
        # runs of words that are stock: at most as many as the items of the block have words
        stock = {r[0] for r in stock_runs.join(found.where("kind = 0").select(F.col("first").alias("run")).distinct(), "run", "leftsemi").collect()}
        weights = {}
        for i, chars, runs, n in zip(built.ids, built.chars, built.runs, built.size):
            loose = {x for k, run in enumerate(runs) if run in stock for x in range(k, k + n + LONGER)}
            weights[i] = [0 if k in loose else c for k, c in enumerate(chars)]

        def own(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                chars = [sum(weights[i][k] for k in at) for i, at in zip(batch.column(1).to_pylist(), batch.column(6).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(chars, pa.int64())], ["doc_id", "item_id", "chars", "total", "first", "last", "own"])

        kept = found.where("kind = 1").select("doc_id", "item_id", "chars", "total", "first", "last", "places").mapInArrow(own, "doc_id bigint, item_id bigint, chars bigint, total bigint, first bigint, last bigint, own bigint")
        kept = kept.where((F.col("own") >= OWN_SHARE * F.col("total")) & (F.col("own") >= F.least(F.lit(OWN_CHARS), F.col("total") * SHARE)))
        kept = kept.select("doc_id", "item_id", (F.col("chars") / F.col("total")).alias("share"), F.col("first").alias("start"), F.col("last").alias("end"), "own")
        cases = kept if cases is None else cases.unionByName(kept)
    return cases
