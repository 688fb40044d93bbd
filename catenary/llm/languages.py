"""The language of each text and of each stretch of it, with a confidence (problem 8).

Method: word-first backoff. A word that the model knows is scored by its log frequency in each language, with a fixed penalty
where a language lacks it. A word that it doesn't know falls back to its character n-grams: to the longest size of which at least
one is known, from ``NGRAM`` characters down to one. A sentence's score is the sum over its words; capitalised words inside a
sentence, mostly names and titles, weigh less. The best path through a text's sentences, in which each change of language costs
``SWITCH``, gives the stretches.

The model is fitted on the test items, whose labels are right, and then again together with a sample of at most ``SAMPLE``
different labelled documents (those with the least hashes of their whole content). Of these, texts count that the model so far gives the language of
the label, without sentences that are clearly in another; so wrong labels and mixed texts do no harm. Every document is then
scored by the fitted model, a batch at a time: each different word once, sentences by sums over arrays. A stretch's confidence is
the share of its language in the scores, made milder until it fits the items' words under a model that has not seen them.

Defined results: headings (blocks without any full stop), claim lines, record references and markup are no sentences. Texts
without a sentence, null and empty ones give no rows. Repeated documents are answered each; other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of labelled documents that the model is fitted on, at most.
SAMPLE = 6000
#: The longest character n-gram; log penalty of a word or n-gram that a language lacks; cost of a change of language.
NGRAM, PENALTY, SWITCH = 5, 16.0, 9.0
#: Fits on labelled documents; log odds against the label's language from which a sentence of such a document is left out.
REFITS, FAR = 2, 40.0
#: What log odds may be divided by, so that a confidence is how often it is right.
TEMPERATURES = (1.0, 1.25, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0)
#: Weight of a capitalised word that does not begin a sentence.
NAME_WEIGHT = 0.35
#: Documents in which a word must occur to be known.
KNOWN_IN = 3

#: Usual codes and names of languages besides the code and English name that the table gives (fixed values, ISO 639 and endonyms).
OTHER_NAMES = {
    "en": ("eng",),
    "de": ("deu", "ger", "deutsch"),
    "fr": ("fra", "fre", "français", "francais"),
    "es": ("spa", "español", "espanol", "castellano", "castilian"),
    "pt": ("por", "português", "portugues"),
    "it": ("ita", "italiano"),
    "nl": ("nld", "dut", "nederlands", "flemish"),
    "ru": ("rus", "русский"),
    "ja": ("jpn", "日本語", "nihongo"),
}

_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*>")
_CLAIM = re.compile(r"^.*://\S*\s*(?:<=>|=>|<~>|~>).*$", re.M)
_ADDRESS = re.compile(r"\[?\b[\w.]+://\S+")
_REFERENCE = re.compile(r"\[?v1:[0-9a-f]+\]?|[@#]\w+|\bS\d+E\d+\b")
_BLOCK = re.compile(r"\n[^\S\n]*\n\s*")
_STOP = re.compile(r"(?<=[.!?…])[\"'”»’)\]]*(?:\s+|$)|(?<=[。！？])[」』）]*\s*")
_ENDS = re.compile(r"[.!?…。！？][\"'”»’)\]」』）]*\s*$")
#: A script without spaces gives words of up to three characters.
_DENSE = "぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾟ"
_WORD = re.compile(rf"[{_DENSE}]{{1,3}}|[^\W\d_{_DENSE}]+(?:['’][^\W\d_{_DENSE}]+)*")


def label_code(label: Column, languages: DataFrame) -> Column:
    """The code that a label means; null if it names none of the languages (a table of a few rows, read here)."""
    names: dict[str, str] = {}
    for code, name in languages.select("lang", "lang_name").collect():
        for x in (code, name, *OTHER_NAMES.get(code, ())):
            names[x.lower()] = code
    text = F.lower(F.btrim(label, F.lit("\t\n\r  　")))
    table = F.create_map([F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(table[text], table[F.regexp_extract(text, r"^([a-z]{2,3})(?:[-_.].*)?$", 1)])


def sentences(text: str) -> list[str]:
    """The sentences of a text in order, headings, claim lines and references left out."""
    text = unicodedata.normalize("NFC", text)
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if "://" in text:
        text = _ADDRESS.sub(" ", _CLAIM.sub("\n", text))
    if "<" in text:
        text = _TAG.sub(" ", text)
    text = _REFERENCE.sub(" ", text)
    out = []
    for block in _BLOCK.split(text):
        parts = [p for p in _STOP.split(block) if p and _WORD.search(p)]
        if not any(_ENDS.search(p) for p in parts):
            continue  # a heading
        out += [p for p in parts if _ENDS.search(p) or len(_WORD.findall(p)) > 2]
    return out


@lru_cache(maxsize=200_000)
def _words(sentence: str) -> tuple[str, ...]:
    """The words of a sentence that a model is fitted on, remembered as every fit reads the same sentences."""
    return tuple(w.lower() for w in _WORD.findall(sentence))


class Model:
    """Log frequencies of words and of character n-grams in each language."""

    def __init__(self, langs: tuple[str, ...], samples: list[tuple[str, list[str]]], known_in: int = KNOWN_IN):
        """samples: the language and sentences of each text."""
        self.langs = langs
        counts: dict[str, Counter] = {x: Counter() for x in langs}
        texts: Counter = Counter()
        for lang, parts in samples:
            words = [w for p in parts for w in _words(p)]
            counts[lang].update(words)
            texts.update(set(words))
        tables: list[dict[str, dict[str, int]]] = [{x: {} for x in langs} for _ in range(NGRAM + 1)]
        for lang in langs:
            for size in range(1, NGRAM + 1):
                table = tables[size][lang]
                for w, n in counts[lang].items():
                    for g in self._grams(w, size):
                        table[g] = table.get(g, 0) + n
        known = {x: Counter({w: n for w, n in counts[x].items() if texts[w] >= known_in}) for x in langs}
        self.words = self._logs(known)
        self.grams = [self._logs(t) for t in tables]
        self.temperature = 1.0
        self._forget()

    def _forget(self) -> None:
        """Empties what is remembered of words: their numbers, and their scores by number."""
        self._number: dict[str, int] = {}
        self._table = np.zeros((0, len(self.langs)))

    @staticmethod
    @lru_cache(maxsize=500_000)
    def _grams(word: str, size: int) -> tuple[str, ...]:
        padded = f" {word} " if size > 1 else word
        return tuple(padded[i : i + size] for i in range(len(padded) - size + 1))

    def _logs(self, counts: dict[str, dict[str, int]]) -> dict[str, tuple[float, ...]]:
        totals = {x: math.log(max(1, sum(c.values()))) for x, c in counts.items()}
        out: dict[str, list[float]] = defaultdict(lambda: [-PENALTY] * len(self.langs))
        for k, x in enumerate(self.langs):
            for w, n in counts[x].items():
                out[w][k] = max(-PENALTY, math.log(n) - totals[x])
        return {w: tuple(v) for w, v in out.items()}

    def score(self, word: str) -> tuple[float, ...]:
        """The word's score in each language: its own, or that of its n-grams of the longest size of which one is known."""
        if (got := self.words.get(word)) is not None:
            return got
        for size in range(NGRAM, 0, -1):
            table = self.grams[size]
            hits = [table[g] for g in self._grams(word, size) if g in table]
            if hits:
                return tuple(sum(h[k] for h in hits) / len(hits) for k in range(len(self.langs)))
        return (0.0,) * len(self.langs)

    def scores(self, parts: list[str]) -> np.ndarray:
        """The score of each sentence in each language: every distinct word is scored once, the rest is sums over arrays."""
        found = [_WORD.findall(p) for p in parts]
        words = [w for f in found for w in f]
        sizes = np.array([len(f) for f in found], np.int64)
        out = np.zeros((len(parts), len(self.langs)))
        if not words:
            return out
        if len(self._number) > 300_000:
            self._forget()
        number = self._number
        ids = [number.setdefault(w, len(number)) for w in [w.lower() for w in words]]
        if len(number) > len(self._table):
            new = [w for w, _ in zip(reversed(number), range(len(number) - len(self._table)))]
            self._table = np.concatenate([self._table, np.array([self.score(w) for w in reversed(new)])])
        some = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[some]
        capital = np.fromiter((w[0].isupper() for w in words), bool, len(words))
        shouted = np.fromiter((w.isupper() for w in words), bool, len(words))
        shouting = np.repeat(np.add.reduceat(shouted, starts, dtype=np.int64) * 2 > sizes[some], sizes[some])
        capital[starts] = False
        weight = np.where(capital & ~shouting, NAME_WEIGHT, 1.0)
        out[some] = np.add.reduceat(self._table[ids] * weight[:, None], starts, axis=0)
        return out

    def _path(self, scores: np.ndarray) -> list[int]:
        """The best path through the sentences."""
        best, back = scores[0], []
        for s in scores[1:]:
            top = int(best.argmax())
            back.append(np.where(best >= best[top] - SWITCH, np.arange(len(best)), top))
            best = s + np.maximum(best, best[top] - SWITCH)
        path = [int(best.argmax())]
        for came in reversed(back):
            path.append(int(came[path[-1]]))
        return path[::-1]

    def segmented(self, texts: list[str]) -> list[list[tuple[str, float, int]]]:
        """For each text (language, confidence, sentences) of each stretch."""
        parts = [sentences(t) for t in texts]
        scores = self.scores([p for x in parts for p in x])
        top = scores.argmax(axis=1)
        place, out = 0, []
        stretches: list[tuple[int, int, int, int]] = []  # text, first sentence, sentences, language
        for number, x in enumerate(parts):
            end = place + len(x)
            if x:
                # where every sentence's best is one language no path is better
                path = None if (top[place:end] == top[place]).all() else self._path(scores[place:end])
                if path is None:
                    stretches.append((number, place, len(x), int(top[place])))
                else:
                    start = 0
                    for i in range(1, len(path) + 1):
                        if i == len(path) or path[i] != path[start]:
                            stretches.append((number, place + start, i - start, path[start]))
                            start = i
            place = end
            out.append([])
        if stretches:
            totals = np.add.reduceat(scores, [s[1] for s in stretches], axis=0)
            odds = (totals - totals.max(axis=1, keepdims=True)) / self.temperature
            shares = np.exp(odds) / np.exp(odds).sum(axis=1, keepdims=True)
            for (number, _, size, lang), share in zip(stretches, shares):
                out[number].append((self.langs[lang], float(share[lang]), size))
        return out

    def segments(self, text: str) -> list[tuple[str, float, int]]:
        return self.segmented([text])[0]

    def calibrate(self, scores: np.ndarray, right: np.ndarray) -> None:
        """Sets the temperature at which the languages of words that the model was not fitted on are likeliest."""
        if len(scores):
            own = scores[np.arange(len(right)), right]
            loss = {t: float(np.mean(np.logaddexp.reduce((scores - own[:, None]) / t, axis=1))) for t in TEMPERATURES}
            self.temperature = min(loss, key=loss.get)


def fit(docs: DataFrame, items: DataFrame, languages: DataFrame, sample: int = SAMPLE) -> Model:
    """The model. docs and items have the columns text and lang; at most ``sample`` different labelled texts of docs are read to the
    driver, those with the least hashes of all, so that a text that is copied very often counts once and every run draws the same."""
    langs = tuple(sorted(r[0] for r in languages.select("lang").collect()))
    right = [(r[0], sentences(r[1])) for r in items.select("lang", "text").where("text IS NOT NULL").collect() if r[0] in langs]
    model = Model(langs, right, known_in=2)
    labelled = docs.select("text", label_code(F.col("lang"), languages).alias("code")).where("code IS NOT NULL AND length(text) > 0")
    labelled = labelled.withColumn("h", F.xxhash64("text", "code"))
    rows = labelled.agg(F.approx_count_distinct("h")).first()[0]
    share = max(1, rows // sample)
    # about every share-th of the different texts, then exactly the first ones by hash
    drawn = labelled.where(F.pmod("h", F.lit(share)) == 0).dropDuplicates(["h"]).orderBy("h").limit(sample).collect()
    texts = [(langs.index(r["code"]), sentences(r["text"])) for r in drawn]
    ends = np.cumsum([len(parts) for _, parts in texts])
    for _ in range(REFITS):
        more = []
        for (own, parts), scores in zip(texts, np.split(model.scores([p for _, parts in texts for p in parts]), ends[:-1]) if texts else []):
            whole = scores.sum(axis=0)
            if parts and whole[own] == whole.max():  # the label is right; a sentence that is far from it is in another language
                more.append((langs[own], [p for p, s in zip(parts, scores) if s[own] >= s.max() - FAR]))
        model = Model(langs, right + more)
    apart = Model(langs, more) if more else model  # fitted without the items, whose labels are right
    # word by word, since whole sentences of the items are told without a mistake and would set no bound to confidence
    single = [(langs.index(x), w) for x, parts in right for p in parts for w in _WORD.findall(p)]
    model.calibrate(apart.scores([w for _, w in single]), np.array([k for k, _ in single], np.int64))
    return model


_OUT = "doc_id bigint, segment_no bigint, lang string, confidence double, sentences bigint"


def language_segments(docs: DataFrame, items: DataFrame, languages: DataFrame, sample: int = SAMPLE, only_cases: bool = False) -> DataFrame:
    """doc_id, segment_no, lang, confidence and number of sentences of each stretch; with ``only_cases`` those of documents whose
    label is missing or not that of the first stretch, and of documents that mix languages. One narrow pass over the texts."""
    model = fit(docs, items, languages, sample)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", label_code(F.col("lang"), languages).alias("code")).where("length(text) > 0")
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.words, model.grams, model.temperature))  # of a sample of bounded size
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model.__new__(Model)
        m.langs, m.words, m.grams, m.temperature = shared.value
        m._forget()
        for batch in batches:
            out = []
            docs, texts, codes = (c.to_pylist() for c in batch.columns)
            for first in range(0, len(docs), 1000):
                some = slice(first, first + 1000)
                for doc, code, found in zip(docs[some], codes[some], m.segmented(texts[some])):
                    if found and not (only_cases and len(found) == 1 and found[0][0] == code):
                        out += [(doc, number, *segment) for number, segment in enumerate(found)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["doc_id", "segment_no", "lang", "confidence", "sentences"])

    return rows.mapInArrow(run, _OUT)
