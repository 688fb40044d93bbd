"""Matching episodes of two catalogs that share no identifier (problem 2).

Method: sorted neighbourhood. Rows of both catalogs are sorted together by several composite keys, and in each order a row is
compared with its ``WINDOW`` neighbours. The first orders go by title and date (as spelled, read backwards, without vowels), so
that a slip anywhere in a title leaves one of them near. What agrees there tells which shows correspond, by how many days their
dates differ and how their numbering runs (a title counts the less, the more other rows with it are to be expected on that date by
chance, so that the rule is the same at any size); then rows of corresponding shows are sorted by show and date, show and number, and
show and title, which finds episodes without a usable title. Each pair has a confidence from weighted similarities of title,
date, season and episode, and of the pairs those are kept that give every episode at most one partner at the greatest sum of
confidences.

Sorting is by range, so no key, however frequent, is gathered in one task: rows with one title or show lie in one order beside each
other and each meets only its window. Rows at the borders of ranges are compared once more across them. The assignment is exact:
pairs that compete with no other are kept as they are; the rest fall apart into small groups of competing pairs, each solved whole.

Defined results: a repeated episode counts once, by its greatest row. Null or empty titles, dates and numbers are no evidence for or
against. Of equal sums the pairs with smaller ids win. Other sources than the two asked for are left out. Empty tables give no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Cut
from .groups import contract

#: Neighbours on each side that a row is compared with in every order.
WINDOW = 10
#: The least confidence of a pair.
LEAST = 0.5
#: What similarities add to the log odds of a pair. Fitted by logistic regression on 511,000 pairs of corresponding shows (sf 1,
#: other rows than the test tables), labelled by the rules this sum replaces, and divided by ten to leave pairs that compete apart;
#: it decides 99.99 % of them as those rules did. "no corresponding shows" is set by hand.
WEIGHTS = {
    "base": -3.89, "no title": 3.45, "title to 0.45": 0.52, "title to 0.72": 3.69, "title to 1": 3.65, "the usual date": 1.40, "a day off": 0.21, "days off": -0.42, "another date": -4.34,
    "the usual number": 0.62, "another number": -0.29, "usual date and number": 1.02, "no corresponding shows": -1.7,
}
#: How far apart numbers of rows of corresponding shows may be, after they are moved.
NUMBERS_APART = 3
#: Rows with the same title that may be expected near a date by chance, for a title there to count in full.
CHANCE = 0.02

_ARTICLES = {"a", "an", "the"}
_NUMBERED = re.compile(r"^(?:episode|ep\.?|folge|#|tba)\s*(\d+)\s*(?:[:.\-–]\s*|$)", re.I)
_PART = re.compile(r"\(\s*(\d)\s*\)|(?<=\s)(\d)(?=\s*(?:$|[:/,]))")
_PART_WORD = re.compile(r"(?<![^\W\d_])([^\W\d_]{2,6})\.?\s*(\d)\b")
_ALTERNATIVE = re.compile(r"\s+/\s+|\s+[-–—]\s+|:\s+")
_DATE = re.compile(r"^\s*(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[T ].*)?\s*$")


def _plain(text: str) -> str:
    text = unicodedata.normalize("NFKD", text).lower().replace("&", " and ").replace("’", "'")
    text = "".join(c for c in text if not unicodedata.combining(c) or c in "゙゚").replace("'", "")
    return " ".join(w for w in re.findall(r"[^\W_]+", unicodedata.normalize("NFC", text)) if w not in _ARTICLES)


def _is_part(word: str) -> bool:
    """Whether a word is "part" or "pt", or "part" with letters doubled, one left out or two neighbours that changed places."""
    word = re.sub(r"(.)\1+", r"\1", word.lower())
    return word in ("part", "pt") or any(word in ("part"[:i] + "part"[i + 1 :], "part"[:i] + "part"[i + 1 : i + 2] + "part"[i] + "part"[i + 2 :]) for i in range(4))


def _part(text: str) -> tuple[int | None, str]:
    """The number of the part that a title names, and the title without it."""
    named = next((m for m in _PART_WORD.finditer(text) if _is_part(m[1])), None)
    if named:
        text = text[: named.start()] + " " + text[named.end() :]
    found = _PART.search(text)
    return int(named[2] if named else found[1] or found[2]) if named or found else None, _PART.sub(" ", text)


def title_names(title: str | None) -> tuple[list[str], int | None, bool]:
    """The names a title gives (none if it only numbers the episode), the number of the part, whether it is cut short."""
    text = unicodedata.normalize("NFKC", title or "").strip()
    cut = bool(re.search(r"(?:…|\.\.\.)\s*$", text)) or (title or "").rstrip().endswith("…")
    text = _NUMBERED.sub("", text.strip(" .…")).strip()
    if not text:
        return [], None, False
    number = _part(text)[0]
    names = []
    for name in _ALTERNATIVE.split(text):
        plain = _plain(_part(name)[1])
        if plain and not plain.isdigit() and plain not in names:
            names.append(plain)
    return names, number, cut


def day_of(date: str | None) -> int | None:
    """Days since 1970; null for what is no full date."""
    m = _DATE.match(date or "")
    if not m:
        return None
    try:
        return int(np.datetime64(f"{int(m[1]):04d}-{int(m[2]):02d}-{int(m[3]):02d}", "D").astype(int))
    except ValueError:
        return None


_ROW = "id bigint, side int, show string, season bigint, episode bigint, names array<string>, sorted array<string>, part int, cut boolean, day int, year int"


def prepared(episodes: DataFrame, left: str, right: str) -> DataFrame:
    """One row for each episode of the two sources, with what the comparison needs: its names, also with their words in order."""
    fields = ("source", "order_ref", "reference", "season", "episode", "title", "air_date", "linked_reference")
    rows = episodes.where(F.col("source").isin(left, right) & F.col("episode_id").isNotNull()).groupBy(F.col("episode_id").cast("bigint").alias("id")).agg(F.max(F.struct(*fields)).alias("r"))
    rows = rows.select("id", "r.source", "r.order_ref", "r.season", "r.episode", "r.title", "r.air_date")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            titles = [title_names(t) for t in batch.column(5).to_pylist()]
            dates = batch.column(6).to_pylist()
            years = [int(m.group()) if (m := re.match(r"\s*\d{4}", d or "")) and m.group().strip() != "0000" else None for d in dates]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([int(s == right) for s in batch.column(1).to_pylist()], pa.int32()), batch.column(2), batch.column(3).cast(pa.int64()), batch.column(4).cast(pa.int64()),
                    pa.array([t[0] for t in titles], pa.list_(pa.string())), pa.array([[" ".join(sorted(n.split(" "))) for n in t[0]] for t in titles], pa.list_(pa.string())),
                    pa.array([t[1] for t in titles], pa.int32()), pa.array([t[2] for t in titles], pa.bool_()), pa.array([day_of(d) for d in dates], pa.int32()), pa.array(years, pa.int32()),
                ],
                ["id", "side", "show", "season", "episode", "names", "sorted", "part", "cut", "day", "year"],
            )

    return rows.mapInArrow(run, _ROW)


#: What is known of an entry besides its row: the place of its range and its own, what is compared with neighbours.
_PLACED = (("part", pa.int32()), ("place", pa.int64()), ("count", pa.int64()), ("side", pa.int32()), ("day", pa.int64()), ("most", pa.int64()), ("same", pa.int64()), ("equal", pa.bool_()), ("group", pa.int64()), ("known", pa.int64()), ("id", pa.int64()))


class _Entries:
    """Sorted entries as arrays, with their rows."""

    def __init__(self, batch):
        column = lambda n, t: pc.fill_null(batch.column(n).cast(t), _NO_DAY if n == "day" else 0 if t != pa.bool_() else False).to_numpy(zero_copy_only=False)
        self.arrays = {n: column(n, t) for n, t in _PLACED[3:]}
        row = batch.column("row")
        self.rows = row.combine_chunks() if isinstance(row, pa.ChunkedArray) else row

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, at: slice) -> _Entries:
        return _Entries.of({n: x[at] for n, x in self.arrays.items()}, self.rows[at])

    @staticmethod
    def of(arrays: dict, rows: pa.Array) -> _Entries:
        new = _Entries.__new__(_Entries)
        new.arrays, new.rows = arrays, rows
        return new

    def __add__(self, other: _Entries) -> _Entries:
        return _Entries.of({n: np.concatenate([x, other.arrays[n]]) for n, x in self.arrays.items()}, pa.concat_arrays([self.rows, other.rows]))

    def pairs(self, window: int, allowed) -> pa.RecordBatch:
        """Rows of side 0 and side 1 that lie at most ``window`` places apart and are near in day or alike in their first key."""
        side, day, most, same, equal, group, known, ids = (self.arrays[n] for n in ("side", "day", "most", "same", "equal", "group", "known", "id"))
        left, right = [], []
        for k in range(1, min(window, len(self) - 1) + 1):
            here, there = slice(None, -k), slice(k, None)
            near = (np.abs(day[there] - day[here]) <= most[here]) | (day[there] == _NO_DAY) | (day[here] == _NO_DAY) | (equal[here] & (same[there] == same[here]))
            new = (group[there] == group[here]) & ((known[there] != known[here]) | (known[here] == 0))
            i = np.flatnonzero((side[there] != side[here]) & near & new & (ids[there] != ids[here]) & allowed(k))
            left.append(np.where(side[i] == 0, i, i + k))
            right.append(np.where(side[i] == 0, i + k, i))
        a, b = (pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (left, right))
        return pa.RecordBatch.from_arrays([self.rows.take(a), self.rows.take(b), *[pa.nulls(len(a), t) for _, t in _PLACED]], ["l", "r", *[n for n, _ in _PLACED]])


def neighbours(entries: DataFrame, window: int = WINDOW, compare: list[Column] | None = None) -> DataFrame:
    """a, b: ids of side 0 and side 1 that lie at most ``window`` places apart when ``entries`` (id, side, day, and the sort
    columns k1, k2, k3) are sorted; only pairs whose days are at most ``most`` (8) apart or not both known, or, where ``equal`` (true),
    that agree in k1.

    Only entries of one ``group`` are compared; two with equal ``known`` (not 0) are left out, as another order puts them together.
    With ``compare`` these columns, of pairs of rows (structs l and r, of the entries' column ``row``), so that no pair need be joined
    with its rows again; a pair comes as often as orders put it together.
    Rows at the borders of ranges are compared once more, border by border, in parallel; only the ranges' sizes come to the driver.
    """
    has = set(entries.columns)
    entries = entries.select(
        "k1", "k2", "k3", F.col("id").cast("bigint").alias("id"), F.col("side").cast("int").alias("side"), F.col("day").cast("bigint").alias("day"), (F.col("most") if "most" in has else F.lit(8)).cast("bigint").alias("most"),
        F.xxhash64("k1").alias("same"), (F.col("equal") if "equal" in has else F.lit(True)).alias("equal"),
        (F.col("group") if "group" in has else F.lit(0)).cast("bigint").alias("group"), (F.col("known") if "known" in has else F.lit(0)).cast("bigint").alias("known"), F.col("row") if "row" in has else F.struct("id").alias("row"),
    )
    once, compare = compare is None, compare or [F.col("l.id").alias("a"), F.col("r.id").alias("b")]
    kind = entries.schema["row"].dataType.simpleString()
    placed = ", ".join(f"{n} {'int' if t == pa.int32() else 'boolean' if t == pa.bool_() else 'bigint'}" for n, t in _PLACED)
    schema = f"l {kind}, r {kind}, {placed}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, done = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = _Entries(batch)
            whole, old = (new, 0) if held is None else (held + new, len(held))
            yield whole.pairs(window, lambda k, n=len(whole), old=old: np.arange(k, n) >= old)  # the held rows met each other before
            if done < window:
                first = new[: window - done] if first is None else first + new[: window - done]
            done += len(new)
            held = whole[max(0, len(whole) - window) :]
        if done:  # the rows near the range's borders
            border = first + held
            place = np.concatenate([np.arange(len(first)), np.arange(done - len(held), done)])
            keep = np.unique(place, return_index=True)[1]
            border, n = _Entries.of({c: x[keep] for c, x in border.arrays.items()}, border.rows.take(pa.array(keep))), len(keep)
            own = {"part": np.full(n, TaskContext.get().partitionId()), "place": place[keep], "count": np.full(n, done)} | border.arrays
            yield pa.RecordBatch.from_arrays([border.rows, border.rows.take(pa.nulls(n, pa.int64())), *[pa.array(own[c], t) for c, t in _PLACED]], ["l", "r", *[c for c, _ in _PLACED]])

    columns = entries.select(F.col("row").alias("l"), F.col("row").alias("r")).select(*compare).columns
    out = entries.repartitionByRange("k1", "k2", "k3", "id").sortWithinPartitions("k1", "k2", "k3", "id").mapInArrow(run, schema)
    names = [n for n, _ in _PLACED]
    # pairs are compared before they are written; border rows, which are no pairs yet, stay beside them
    found = Cut(out.select(*[F.when(F.col("part").isNull(), c).alias(n) for n, c in zip(columns, compare)], F.when(F.col("part").isNotNull(), F.col("l")).alias("__row"), *names), "neighbours").df
    border = found.where("part IS NOT NULL")
    sizes = sorted((r[0], r[1]) for r in border.groupBy("part").agg(F.max("count")).collect())
    pairs = found.where("part IS NULL").select(*columns)
    if len(sizes) < 2:
        return pairs.distinct() if once else pairs
    parts, begins = np.array([p for p, _ in sizes]), np.concatenate([[0], np.cumsum([n for _, n in sizes])[:-1]])

    def to_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each border row once for every border it lies at: that before its own range, and those after it within the window."""
        for batch in batches:
            part, place = batch.column("part").to_numpy(), batch.column("place").to_numpy()
            own = np.searchsorted(parts, part)
            at = begins[own] + place
            take, group = [], []
            for i in range(batch.num_rows):
                if place[i] < window and own[i]:
                    take.append(i)
                    group.append(own[i])
                g = own[i] + 1
                while g < len(parts) and begins[g] - at[i] <= window:
                    take.append(i)
                    group.append(g)
                    g += 1
            some = batch.take(pa.array(take, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(at[take] if take else np.zeros(0, np.int64), pa.int64()), *some.columns], ["border", "at", *some.schema.names])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in [*batches, None]:
            table = held if batch is None else pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            border = table.column("border").to_numpy()
            end = len(border) if batch is None else int(np.searchsorted(border, border[-1]))  # the last border may go on
            done, held = table.slice(0, end), table.slice(end)
            if done.num_rows:
                border, at, part = (done.column(c).to_numpy() for c in ("border", "at", "part"))
                entries = _Entries(done)
                own = np.searchsorted(parts, part)
                yield entries.pairs(2 * window, lambda k, n=len(at), at=at, border=border, own=own: (border[k:] == border[: n - k]) & (own[k:] == border[k:]) & (own[: n - k] < border[k:]) & (at[k:] - at[: n - k] <= window))

    row = found.select(F.col("__row").alias("row"), *names).where("part IS NOT NULL")
    spread = row.mapInArrow(to_borders, f"border int, at bigint, row {kind}, {placed}")
    more = spread.repartition("border").sortWithinPartitions("border", "at").mapInArrow(across, schema)
    pairs = pairs.unionByName(more.select(*compare))
    return pairs.distinct() if once else pairs


_NO_DAY = -(1 << 40)


def _likeness(x: Column, y: Column, xs: Column, ys: Column) -> Column:
    """Similarity of two names: by single letters, with words in either order."""
    longest = F.greatest(F.length(x), F.length(y), F.lit(1))
    return F.when(xs == ys, 1.0).otherwise(1 - F.least(F.levenshtein(x, y), F.levenshtein(xs, ys)) / longest)


def _title_similarity(a: str, b: str) -> Column:
    """Of the best pair of names; of a title that is cut short the beginning counts. Null if a side has none, or if the two are in
    scripts that cannot be compared. Most titles give one name: these are compared without a loop over names."""
    x, y, xs, ys, cut = F.col(f"{a}.names"), F.col(f"{b}.names"), F.col(f"{a}.sorted"), F.col(f"{b}.sorted"), F.col(f"{a}.cut") | F.col(f"{b}.cut")

    def alike(p: Column, q: Column, ps: Column, qs: Column) -> Column:
        short = F.least(F.length(p), F.length(q))
        begun = 0.95 - F.levenshtein(F.substring(p, F.lit(1), short), F.substring(q, F.lit(1), short)) / short
        return F.when(cut & (short >= 4), F.greatest(_likeness(p, q, ps, qs), begun)).otherwise(_likeness(p, q, ps, qs))

    pair = lambda n, s: F.arrays_zip(n.alias("n"), s.alias("s"))
    all_names = F.array_max(F.transform(pair(x, xs), lambda p: F.array_max(F.transform(pair(y, ys), lambda q: alike(p["n"], q["n"], p["s"], q["s"])))))
    one = lambda c: F.element_at(c, 1)
    best = F.when((F.size(x) == 1) & (F.size(y) == 1), alike(one(x), one(y), one(xs), one(ys))).otherwise(all_names)
    latin = lambda c: one(c).rlike("[a-z]")
    return F.when((F.size(x) > 0) & (F.size(y) > 0) & (latin(x) == latin(y)), best)


def _comparison(*more: str) -> list[Column]:
    """What is kept of a pair of rows: numbers, and ``more`` of its row of side 0 (l) or 1 (r)."""
    a, b = (lambda n: F.col(f"l.{n}")), (lambda n: F.col(f"r.{n}"))
    return [
        a("id").alias("a"), b("id").alias("b"), a("season").alias("a_season"), b("season").alias("b_season"), a("episode").alias("a_episode"), b("episode").alias("b_episode"),
        a("part").alias("a_part"), b("part").alias("b_part"), a("year").alias("a_year"), b("year").alias("b_year"), (b("day") - a("day")).cast("bigint").alias("shift"),
        _title_similarity("l", "r").alias("title"), *[F.expr(m) for m in more],
    ]


def _rivals(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Compared pairs with the column rivals: how many other rows of one catalog with the pair's title (and season and episode, if
    these agree) are to be expected by chance in the days that its dates are apart. Null without title or dates."""
    dated = rows.where("day IS NOT NULL")
    days = dated.groupBy("side", "day").agg(F.count("*").alias("n")).groupBy("side").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    same_day = max((r["pairs"] / (r["n"] * (r["n"] - 1)) for r in days.collect() if r["n"] > 1), default=0.0)  # the chance that two rows have one date
    number = [F.coalesce(c, F.lit(-1)).alias(f"__{c}") for c in ("season", "episode")]
    counts = dated.select(F.explode("names").alias("name"), "side", *number).groupBy("name", "__season", "__episode").agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"))
    # a name has few numbers beside its rows; its sums run over these
    of_name = Window.partitionBy("name")
    counts = Cut(counts.select("name", "__season", "__episode", F.greatest("n0", "n1").alias("of_number"), F.greatest(F.sum("n0").over(of_name), F.sum("n1").over(of_name)).alias("of_name")), "names").df
    near = F.least(F.lit(1.0), (2 * F.least(F.abs("shift"), F.lit(8)) + 1) * F.lit(float(same_day)))
    others = F.when((F.col("a_season") == F.col("b_season")) & (F.col("a_episode") == F.col("b_episode")), F.col("of_number")).otherwise(F.col("of_name")) - 1
    found = pairs.withColumn("__season", F.coalesce("a_season", F.lit(-1))).withColumn("__episode", F.coalesce("a_episode", F.lit(-1)))
    return found.join(counts, ["name", "__season", "__episode"], "left").withColumn("rivals", F.when(F.col("shift").isNotNull(), others * near)).drop("of_name", "of_number", "__season", "__episode")


def _assigned(scored: DataFrame) -> DataFrame:
    """Of pairs a, b, confidence those that give each id at most one partner at the greatest sum."""
    degree = lambda k: F.count("*").over(Window.partitionBy(k))  # noqa: E731 (an episode has a bounded number of pairs: those of its windows)
    counted = Cut(scored.withColumn("a_n", degree("a")).withColumn("b_n", degree("b")), "scored").df
    alone = counted.where("a_n = 1 AND b_n = 1").select("a", "b", "confidence")
    rest = counted.where("a_n > 1 OR b_n > 1").select("a", "b", "confidence")
    edges = rest.select((F.col("a") * 2).alias("a"), (F.col("b") * 2 + 1).alias("b"))
    groups = contract(edges).select((F.col("v") / 2).cast("bigint").alias("a"), "root", (F.col("v") % 2).alias("odd")).where("odd = 0").drop("odd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, current = [], None
        out: list[tuple] = []
        for batch in batches:
            for root, a, b, c in zip(*(x.to_pylist() for x in batch.columns)):
                if root != current and group:
                    out += best_assignment(group)
                    group = []
                current = root
                group.append((a, b, c))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "confidence"])
                out = []
        if group:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*best_assignment(group)), (pa.int64(), pa.int64(), pa.float64()))], ["a", "b", "confidence"])

    solved = rest.join(groups, "a").select("root", "a", "b", "confidence").repartition("root").sortWithinPartitions("root", "a", "b").mapInArrow(run, "a bigint, b bigint, confidence double")
    return alone.unionByName(solved)


def best_assignment(pairs: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The matching of greatest total weight, by augmenting along best alternating paths (all weights are positive)."""
    weight = {(a, b): w for a, b, w in pairs}
    near: dict[int, list[int]] = defaultdict(list)
    for a, b, _ in sorted(pairs):
        near[a].append(b)
    mate: dict[int, int] = {}  # of b
    free = set(near)
    while free:
        # Bellman-Ford over alternating paths from all free a: the gain of reaching b
        gain: dict[int, float] = {}
        came: dict[int, int] = {}
        at_a = {a: 0.0 for a in free}
        changed = set(free)
        while changed:
            reached = set()
            for a in sorted(changed):
                for b in near[a]:
                    if mate.get(b) != a and (g := at_a[a] + weight[a, b]) > gain.get(b, 0.0) + 1e-12:
                        gain[b], came[b] = g, a
                        if b in mate:
                            reached.add(b)
            changed = set()
            for b in reached:
                a = mate[b]
                g = gain[b] - weight[a, b]
                if g > at_a.get(a, -1e18) + 1e-12:
                    at_a[a] = g
                    changed.add(a)
        ends = [(gain[b], -b) for b in gain if b not in mate]
        # a path may also end by leaving an a free
        drops = [(at_a[a], a) for a in at_a if a not in free and at_a[a] > 1e-12]
        best_end, best_drop = max(ends, default=(0.0, 0)), max(drops, default=(0.0, 0))
        if max(best_end[0], best_drop[0]) <= 1e-12:
            break
        if best_end[0] >= best_drop[0]:
            b = -best_end[1]
        else:
            b = next(b for b, a in mate.items() if a == best_drop[1])
        while True:
            a = came[b]
            previous = next((x for x, y in mate.items() if y == a), None)
            mate[b] = a
            if a in free:
                free.discard(a)
                break
            b = previous
        if best_end[0] < best_drop[0]:
            free.add(best_drop[1])
    return [(a, b, weight[a, b]) for b, a in sorted(mate.items())]


def _links(first: DataFrame) -> DataFrame:
    """a_show, b_show, link: shows that have more titles in common with each other than with any other show."""
    sure = first.where("title >= 0.8 AND shift IS NOT NULL AND (a_part IS NULL OR b_part IS NULL OR a_part = b_part)")
    vote = F.when(F.col("rivals") <= CHANCE, 1.0).when(F.col("rivals") < 1, F.log("rivals") / float(np.log(CHANCE))).otherwise(0.0)
    by_shift = sure.groupBy("a_show", "b_show", F.when(F.abs("shift") > 8, F.col("shift")).alias("far")).agg(F.sum(vote).alias("votes"))
    # dates far apart count only if several titles agree in the distance
    votes = by_shift.where("far IS NULL OR votes >= 3").groupBy("a_show", "b_show").agg(F.max("votes").alias("votes"))
    place = lambda k, other: F.row_number().over(Window.partitionBy(k).orderBy(F.desc("votes"), F.desc(other)))
    best = votes.where("votes >= 1").withColumn("a_place", place("a_show", "b_show")).withColumn("b_place", place("b_show", "a_show"))
    return best.where("a_place = 1 AND b_place = 1").select("a_show", "b_show", F.xxhash64("a_show", "b_show").alias("link"))


def _habits(known: DataFrame) -> DataFrame:
    """How corresponding shows differ in dates and numbers, as rows of four kinds: ``date`` (of a season) and ``show_date`` shifts and
    ``number`` steps with their shares, and ``move``: the usual ones. All of it is counted by link, season, shift and step first,
    so that only these counts are brought together by link."""
    keys = ["link", "a_season", "b_season", "shift", "step"]
    counts = known.withColumn("step", F.col("b_episode") - F.col("a_episode")).groupBy(*keys).agg(F.count("*").alias("n")).repartition("link")
    over = lambda *k: Window.partitionBy("link", *k)
    dated = F.when(F.col("shift").isNotNull(), F.col("n"))
    rows = counts.select("*", F.sum(dated).over(over("a_season")).alias("season_n"), F.sum(dated).over(over()).alias("show_n"), F.sum(dated).over(over("a_season", "shift")).alias("of_season"), F.sum(dated).over(over("shift")).alias("of_show"))
    # a distance that is seen once or twice proves nothing but itself
    often = lambda n: (F.abs("shift") <= 1) | (F.col(n) >= 3)
    rows = rows.withColumn("season_share", F.when(often("of_season"), F.col("of_season") / F.col("season_n"))).withColumn("show_share", F.when(often("of_show"), F.col("of_show") / F.col("show_n")))
    numbered = rows.where("step IS NOT NULL AND (abs(shift) <= 8 OR show_share >= 0.2)").groupBy("link", "a_season", "b_season", "step").agg(F.sum("n").alias("n"))
    numbered = numbered.withColumn("share", F.col("n") / F.sum("n").over(over("a_season")))
    made = lambda d, kind, **c: d.select("link", F.lit(kind).alias("kind"), *[c.get(n, F.lit(None)).cast(t).alias(n) for n, t in (("a_season", "bigint"), ("b_season", "bigint"), ("shift", "bigint"), ("step", "bigint"), ("share", "double"))])
    parts = [
        made(rows.where("season_share IS NOT NULL").groupBy("link", "a_season", "shift").agg(F.max("season_share").alias("share")), "date", a_season=F.col("a_season"), shift=F.col("shift"), share=F.col("share")),
        made(rows.where("show_share IS NOT NULL").groupBy("link", "shift").agg(F.max("show_share").alias("share")), "show_date", shift=F.col("shift"), share=F.col("share")),
        made(numbered, "number", a_season=F.col("a_season"), b_season=F.col("b_season"), step=F.col("step"), share=F.col("share")),
        made(rows.where("season_share IS NOT NULL").groupBy("link", "a_season").agg(F.max_by("shift", F.struct("season_share", -F.abs("shift"))).alias("shift")), "season_move", a_season=F.col("a_season"), shift=F.col("shift")),
        made(rows.where("show_share IS NOT NULL").groupBy("link").agg(F.max_by("shift", F.struct("show_share", -F.abs("shift"))).alias("shift")), "show_move", shift=F.col("shift")),
        made(numbered.groupBy("link", "a_season").agg(F.max(F.struct("share", "b_season", "step")).alias("to")), "to", a_season=F.col("a_season"), b_season=F.col("to.b_season"), step=F.col("to.step")),
    ]
    return reduce(DataFrame.unionByName, parts)


def candidates(episodes: DataFrame, left: str, right: str, window: int = WINDOW) -> DataFrame:
    """The pairs that windows put together, once each, with what is known of their titles, dates and numbers."""
    rows = Cut(prepared(episodes, left, right), "episodes").df
    row, name = F.struct(*rows.columns).alias("row"), F.col("name")
    # rows of one name lie beside each other in every order, so that the first one finds their pairs
    order = lambda n, k: F.struct(F.concat(F.lit(f"{n}|"), k).alias("k1"), F.lit(n).alias("group"), (F.xxhash64(name) if n else F.lit(0)).alias("known"))
    orders = F.array(order(0, name), order(1, F.reverse(name)), order(2, F.regexp_replace(name, "[aeiou ]", "")))
    entries = rows.select("id", "side", "day", row, F.explode("names").alias("name")).select("id", "side", "day", "row", F.explode(orders).alias("x")).select("id", "side", "day", "row", "x.*")
    compared = _comparison("l.show AS a_show", "r.show AS b_show", "CASE WHEN size(l.names) > 0 THEN l.names[0] END AS name")
    found = neighbours(entries.withColumn("k2", F.col("day").cast("string")).withColumn("k3", F.lit("")), window, compared)
    first = Cut(_rivals(rows, found.where("title >= 0.5").dropDuplicates(["a", "b"])), "first").df

    links = Cut(_links(first), "shows").df
    known = first.where("title >= 0.8 AND (a_part IS NULL OR b_part IS NULL OR a_part = b_part)").join(links, ["a_show", "b_show"])
    habits = Cut(_habits(known), "habits").df
    habit = lambda kind, *c: habits.where(F.col("kind") == kind).select("link", *c)
    dates, show_dates = habit("date", "a_season", "shift", F.col("share").alias("season_share")), habit("show_date", "shift", F.col("share").alias("show_share"))
    numbers = habit("number", "a_season", "b_season", "step", F.col("share").alias("number_share"))
    show_move = habit("show_move", F.col("shift").alias("show_move"))

    # rows of corresponding shows, side 0 moved to where side 1 has them
    one = rows.where("side = 0").select(F.col("show").alias("a_show"), F.col("season").alias("a_season"), row).join(links.select("a_show", "link"), "a_show")
    one = one.join(habit("season_move", "a_season", F.col("shift").alias("season_move")), ["link", "a_season"], "left").join(show_move, "link", "left").join(habit("to", "a_season", F.col("b_season").alias("to_season"), F.col("step").alias("to_step")), ["link", "a_season"], "left")
    one = one.select("link", F.col("row").withField("link", F.col("link")).alias("row"), (F.col("row.day") + F.coalesce("season_move", "show_move", F.lit(0))).alias("at"), F.coalesce("to_season", "row.season").alias("s"), (F.col("row.episode") + F.coalesce("to_step", F.lit(0))).alias("e"))
    two = rows.where("side = 1").select(F.col("show").alias("b_show"), row).join(links.select("b_show", "link"), "b_show").select("link", F.col("row").withField("link", F.col("link")).alias("row"), F.col("row.day").alias("at"), F.col("row.season").alias("s"), F.col("row.episode").alias("e"))
    pad = lambda c: F.format_string("%012d", F.coalesce(c, F.lit(0)).cast("bigint") + 500_000_000)
    link = lambda p: F.concat(F.lit(p), F.hex("link"), F.lit("|"))
    # by date, by number (those nearby), and by each name
    entry = lambda k1, k2, k3, near, most, equal: F.struct(k1.alias("k1"), k2.alias("k2"), k3.alias("k3"), near.cast("bigint").alias("day"), F.lit(most).alias("most"), F.lit(equal).alias("equal"))
    at, s, e = F.col("at"), F.col("s"), F.col("e")
    by_place = F.concat(
        F.array(F.when(at.isNotNull(), entry(F.concat(link("d|"), pad(at)), pad(s), pad(e), at, 8, True)), F.when(e.isNotNull(), entry(F.concat(link("e|"), pad(s)), pad(e), F.lit(""), e, NUMBERS_APART, False))),
        F.transform("row.names", lambda n: entry(F.concat(link("n|"), n), pad(at), F.lit(""), at, 8, True)),
    )
    placed = one.unionByName(two).select(F.col("row.id").alias("id"), F.col("row.side").alias("side"), "row", F.col("link").alias("group"), F.explode(F.filter(by_place, lambda x: x.isNotNull())).alias("x")).select("id", "side", "row", "group", "x.*")
    more = neighbours(placed, window, _comparison("l.link")).withColumn("rivals", F.lit(None).cast("double"))
    # all columns are numbers that follow from a and b, so that repeats fold by hash
    pairs = first.join(links, ["a_show", "b_show"], "left").select(*more.columns).unionByName(more).repartition("a").groupBy("a", "b").agg(*[F.max(c).alias(c) for c in more.columns if c not in ("a", "b")])
    pairs = pairs.withColumn("step", F.col("b_episode") - F.col("a_episode"))
    pairs = pairs.join(dates, ["link", "a_season", "shift"], "left").join(show_dates, ["link", "shift"], "left").join(show_move, "link", "left").withColumn("date_share", F.greatest("season_share", "show_share")).join(numbers, ["link", "a_season", "b_season", "step"], "left")
    return pairs


def match_episodes(episodes: DataFrame, left: str = "org.themoviedb", right: str = "com.thetvdb", window: int = WINDOW, least: float = LEAST) -> DataFrame:
    """a, b (episode ids of the left and the right source) and their confidence."""
    pairs = candidates(episodes, left, right, window)
    return _assigned(pairs.select("a", "b", confidence().alias("confidence")).where(F.col("confidence") >= least))


def confidence() -> Column:
    """The logistic function of a weighted sum of similarities of title, date and number, with unknown evidence weighing as it was
    fitted. Pairs of shows that do not correspond count only with a like title near in date that is rare there, and weigh less. 0
    where the titles name different parts."""
    title, linked = F.col("title"), F.col("link").isNotNull()
    near = F.least(F.abs("shift"), F.abs(F.col("shift") - F.col("show_move")))
    date = (
        F.when(F.col("shift").isNull(), F.when(F.abs(F.col("a_year") - F.col("b_year")) > 1, WEIGHTS["another date"]).otherwise(0.0))
        .when((linked & (F.col("date_share") >= 0.2)) | (~linked & (F.col("shift") == 0)), WEIGHTS["the usual date"])
        .when(near <= 1, WEIGHTS["a day off"])
        .when(near <= 8, WEIGHTS["days off"])
        .otherwise(WEIGHTS["another date"])
    )
    usual = F.coalesce(F.col("number_share") >= 0.2, F.lit(False))
    alike = F.when(linked, F.lit(False)).otherwise(F.coalesce((F.col("step") == 0) & (F.col("a_season") == F.col("b_season")), F.lit(False)))
    number = F.when(F.col("step").isNull() | alike, 0.0).when(usual, WEIGHTS["the usual number"]).when(F.col("number_share").isNotNull(), 0.0).otherwise(WEIGHTS["another number"])
    both = F.when((date == WEIGHTS["the usual date"]) & usual & F.col("step").isNotNull(), WEIGHTS["usual date and number"]).otherwise(0.0)
    part = lambda low, high: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (title - low) / (high - low)))
    titles = F.when(title.isNull(), WEIGHTS["no title"]).otherwise(WEIGHTS["title to 0.45"] * part(0.0, 0.45) + WEIGHTS["title to 0.72"] * part(0.45, 0.72) + WEIGHTS["title to 1"] * part(0.72, 1.0))
    score = WEIGHTS["base"] + titles + date + number + both
    lone = F.coalesce((title >= 0.85) & (date >= WEIGHTS["a day off"]) & (F.col("rivals") <= CHANCE), F.lit(False))
    sure = F.when(linked, score).when(lone, score + WEIGHTS["no corresponding shows"])
    parts = F.coalesce(F.col("a_part") != F.col("b_part"), F.lit(False))
    return F.when(~parts & sure.isNotNull(), 1 / (1 + F.exp(-sure))).otherwise(0.0)
