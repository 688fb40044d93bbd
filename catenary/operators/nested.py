"""Deeply nested JSON records as flat tables with parent-child links (problem 1).

Method: vectorised structural indexing. All texts of an Arrow batch form one byte buffer; bitmaps of quotes, brackets and
delimiters are made over it, the strings are masked by the parity of the quotes before a byte, the nesting depth is a prefix
sum over the brackets, and every container's owner, position and span follow from one sort of the structural bytes by depth.
No text is decoded value by value.

Defined results:

* A text encoded once more than needed (a JSON string holding JSON) is decoded first, as often as needed.
* A null, an empty text and a text whose quotes or brackets do not close properly give no rows; other slips of grammar are not
  looked for.
* A null element counts as a position and gives no row; a list in a list is walked, only objects give rows.
* A bare object in one of the fields ``BARE`` counts as a list of one.
* ``native_id``: a string as it is, a number or boolean as written, a container as its JSON text; empty if missing or null.
* Of fields that occur twice in one object the last ``id``, and the last container of a name, count.
* Rows delivered repeatedly: one delivery per version is walked, the one that is smallest as text.
* Columns of the input other than those named are left out of the work, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean

#: Fields in which an object without a list counts as a list of one.
BARE = ("seasons", "results", "groups", "remoteIds", "titles")
#: Bytes of JSON indexed at once; only memory depends on it.
BLOCK = 1 << 20

_KIND = np.zeros(256, np.uint8)
_QUOTE, _OPEN_OBJECT, _OPEN_LIST, _CLOSE_OBJECT, _CLOSE_LIST, _COMMA, _COLON = range(1, 8)
for _byte, _kind in zip(b'"{[}],:', range(1, 8)):
    _KIND[_byte] = _kind


def _slices(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """The texts buffer[start:end] of many spans, gathered at once."""
    size = np.maximum(end - start, 0)
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buffer[at]))).cast(pa.string())


def _unescaped(texts: pa.StringArray) -> pa.StringArray:
    """The contents of JSON strings; only those with a backslash are decoded one by one."""
    odd = pc.match_substring(texts, "\\")
    if not pc.any(odd).as_py():
        return texts
    out = texts.to_pylist()
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        try:
            out[i] = json.loads(f'"{out[i]}"', strict=False).encode("utf-8", "replace").decode()
        except ValueError:
            pass
    return pa.array(out, pa.string())


def _decoded(text: str) -> str:
    """A text without superfluous encodings; empty if it is no JSON."""
    try:
        while text.lstrip()[:1] == '"':
            text = json.loads(text)
        json.loads(text)  # what was a mere string is no record
        return text
    except ValueError:
        return ""


def _owners(level: np.ndarray, opens: np.ndarray, child: np.ndarray, comma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each structural byte the container that it stands in (its own for a bracket), and for each opening bracket (child)
    the container around it, -1 at the top, and the number of commas before it in there.

    Sorted by level and place, a container's opening bracket comes before all that stands directly in it.
    """
    n = len(level)
    place = np.concatenate([np.arange(n), child])
    depth = np.concatenate([level, level[child] - 1])
    order = np.argsort(depth * (n + 1) + place, kind="stable")
    is_owner = np.concatenate([opens, np.zeros(len(child), bool)])[order]
    last = np.maximum.accumulate(np.where(is_owner, np.arange(len(order)), 0))
    count = np.cumsum(np.concatenate([comma, np.zeros(len(child), bool)])[order])
    owner, index = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    owner[order] = place[order][last]
    index[order] = count - count[last]
    around = owner[n:]
    around[level[child] <= 1] = -1
    return owner[:n], around, index[n:]


def index_block(texts: pa.StringArray, bare: tuple[str, ...] = BARE) -> pa.RecordBatch:
    """The elements of all texts: row (the text's number), parent_pointer, pointer, native_id, field (of the list that
    the element belongs to) and body (the element's JSON)."""
    empty = pa.RecordBatch.from_pydict({"row": pa.array([], pa.int64()), **{k: pa.array([], pa.string()) for k in ("parent_pointer", "pointer", "native_id", "field")}, "body": pa.array([], pa.string())})
    texts = pc.coalesce(texts, "").cast(pa.string())
    coded = pc.starts_with(pc.utf8_ltrim_whitespace(texts), '"').to_numpy(zero_copy_only=False)
    if coded.any():
        plain = texts.to_pylist()
        for i in np.flatnonzero(coded):
            plain[i] = _decoded(plain[i])
        texts = pa.array(plain, pa.string())
    # one buffer, a line end after each text, so that no text's end can touch the next
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pc.binary_join_element_wise(texts, "", "\n").cast(pa.large_string())
    first = np.concatenate([[0], np.cumsum(lengths + 1)])
    raw = joined.buffers()[2]
    if raw is None or not lengths.sum():
        return empty
    begin = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset]
    buffer = np.frombuffer(raw, np.uint8)[begin : begin + first[-1]]

    kind = _KIND[buffer]
    at = np.flatnonzero(kind)
    kind = kind[at]
    slash = np.flatnonzero(buffer == 92)
    if len(slash):  # a quote after an odd run of backslashes is part of its string
        starts = np.flatnonzero(np.diff(slash, prepend=-9) != 1)
        size = np.diff(starts, append=len(slash))
        masked = slash[starts + size - 1][size % 2 == 1] + 1
        spot = np.searchsorted(at, masked)
        spot = spot[(spot < len(at))]
        hit = np.isin(at[spot], masked) & (kind[spot] == _QUOTE)
        keep = np.ones(len(at), bool)
        keep[spot[hit]] = False
        at, kind = at[keep], kind[keep]
    row = np.searchsorted(first, at, side="right") - 1
    quote = kind == _QUOTE
    total = np.concatenate([[0], np.cumsum(quote)])
    lead = np.searchsorted(at, first)  # the first structural byte of each text
    inside = (total[:-1] - total[lead][row]) % 2 == 1  # an odd number of quotes before it in its text
    bad = (np.diff(total[lead]) % 2) == 1
    keep = (quote | ~inside) & ~bad[row]
    at, kind, row, quote, closing = at[keep], kind[keep], row[keep], quote[keep], (quote & inside)[keep]

    # brackets and delimiters, the quotes set aside
    opens, closes = (kind == _OPEN_OBJECT) | (kind == _OPEN_LIST), (kind == _CLOSE_OBJECT) | (kind == _CLOSE_LIST)
    step = opens.astype(np.int64) - closes
    depth = np.cumsum(step)
    lead = np.searchsorted(row, np.arange(len(texts) + 1))
    base = np.concatenate([[0], depth])[lead]
    depth = depth - base[row]
    level = depth + closes
    bad = np.zeros(len(texts), bool)
    bad[row[(level < 1) & ~quote]] = True
    bad[(np.concatenate([[0], np.cumsum(step)])[lead][1:] - base[:-1]) != 0] = True
    bad |= np.bincount(row[opens & (level == 1)], minlength=len(texts)) != 1
    keep = ~bad[row] & (level > 0)  # a root that is a mere string has no level
    if not keep.any():
        return empty
    at, kind, row, closing, opens, level = at[keep], kind[keep], row[keep], closing[keep], opens[keep], level[keep]
    child = np.flatnonzero(opens)
    owner, around, position = _owners(level, opens, child, kind == _COMMA)
    closed = np.full(len(at), -1, np.int64)
    ends = np.flatnonzero((kind == _CLOSE_OBJECT) | (kind == _CLOSE_LIST))
    closed[owner[ends]] = ends
    mixed = kind[ends] - kind[owner[ends]] != _CLOSE_OBJECT - _OPEN_OBJECT
    if mixed.any():  # a bracket closed by one of the other kind
        bad[row[ends[mixed]]] = True

    # containers: number, pointer segment, pointer
    number = np.full(len(at), -1, np.int64)
    number[child] = np.arange(len(child))
    parent = np.where(around >= 0, number[np.maximum(around, 0)], -1)
    in_object = (around >= 0) & (kind[np.maximum(around, 0)] == _OPEN_OBJECT)
    keyed = child[in_object]
    if len(keyed) and not ((kind[keyed - 1] == _COLON) & closing[keyed - 2] & (kind[keyed - 3] == _QUOTE)).all():
        wrong = keyed[~((kind[keyed - 1] == _COLON) & closing[keyed - 2] & (kind[keyed - 3] == _QUOTE))]
        bad[row[wrong]] = True
    keys = _unescaped(_slices(buffer, at[keyed - 3] + 1, at[keyed - 2]))
    field = np.full(len(child), "", object)
    field[in_object] = keys.to_numpy(zero_copy_only=False)
    segment = position.astype(str).astype(object)
    segment[in_object] = pc.replace_substring(pc.replace_substring(keys, "~", "~0"), "/", "~1").to_numpy(zero_copy_only=False)
    lone = in_object & (kind[child] == _OPEN_OBJECT) & np.isin(field, np.array(bare, object)) if bare else np.zeros(len(child), bool)
    segment[lone] += "/0"
    element = (kind[child] == _OPEN_OBJECT) & (around >= 0) & (~in_object | lone)

    # of containers under one name in one object the last counts
    alive = np.ones(len(child), bool)
    if len(keyed):
        code = keys.dictionary_encode()
        name = parent[in_object] * len(code.dictionary) + code.indices.to_numpy(zero_copy_only=False)
        if len(np.unique(name)) < len(name):
            alive[in_object] = np.isin(np.arange(len(name)), len(name) - 1 - np.unique(name[::-1], return_index=True)[1])

    pointer, enclosing = np.full(len(child), "", object), np.full(len(child), "", object)
    listed = field.copy()  # the field whose list an element belongs to
    depth_of = level[child]
    for d in range(2, int(depth_of.max()) + 1):
        own = np.flatnonzero(depth_of == d)
        up = parent[own]
        pointer[own] = pointer[up] + "/" + segment[own]
        enclosing[own] = np.where(element[up], pointer[up], enclosing[up])
        alive[own] &= alive[up]
        nameless = own[~in_object[own]]
        listed[nameless] = listed[parent[nameless]]

    # the elements' own ids
    text = np.full(len(at), "", object)
    colon = np.flatnonzero(kind == _COLON)
    colon = colon[(colon >= 2)]
    colon = colon[closing[colon - 1]]
    size = at[colon - 1] - at[colon - 2] - 1
    is_id = (size == 2) & (buffer[at[colon - 2] + 1] == 105) & (buffer[np.minimum(at[colon - 2] + 2, len(buffer) - 1)] == 100)
    escaped = np.flatnonzero((size >= 7) & (buffer[np.minimum(at[colon - 2] + 1, len(buffer) - 1)] == 92))
    for i in escaped:  # "id"
        is_id[i] |= _unescaped(_slices(buffer, at[colon[i : i + 1] - 2] + 1, at[colon[i : i + 1] - 1])).to_pylist() == ["id"]
    colon = colon[is_id]
    chosen = np.zeros(len(at), bool)
    chosen[child[element]] = True
    colon = colon[chosen[owner[colon]] & (colon + 1 < len(at))]
    if len(colon):
        follows = kind[colon + 1]
        as_text, as_container = follows == _QUOTE, (follows == _OPEN_OBJECT) | (follows == _OPEN_LIST)
        value = np.full(len(colon), "", object)
        j = colon[as_text]
        value[as_text] = _unescaped(_slices(buffer, at[j + 1] + 1, at[j + 2])).to_numpy(zero_copy_only=False)
        j = colon[as_container]
        value[as_container] = _slices(buffer, at[j + 1], at[closed[j + 1]] + 1).to_numpy(zero_copy_only=False)
        j = colon[~as_text & ~as_container]
        bare_value = pc.utf8_trim_whitespace(_slices(buffer, at[j] + 1, at[j + 1]))
        value[~as_text & ~as_container] = pc.if_else(pc.equal(bare_value, "null"), "", bare_value).to_numpy(zero_copy_only=False)
        text[owner[colon]] = value

    picked = np.flatnonzero(element & alive & ~bad[row[child]])
    at_open = child[picked]
    return pa.RecordBatch.from_pydict(
        {
            "row": row[at_open],
            "parent_pointer": pa.array(enclosing[picked], pa.string()),
            "pointer": pa.array(pointer[picked], pa.string()),
            "native_id": pa.array(text[at_open], pa.string()),
            "field": pa.array(listed[picked], pa.string()),
            "body": _slices(buffer, at[at_open], at[closed[at_open]] + 1),
        }
    )


def _blocks(texts: pa.StringArray) -> Iterator[tuple[int, pa.StringArray]]:
    """Runs of texts of about BLOCK bytes."""
    ends = np.cumsum(pc.coalesce(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def explode_objects(df: DataFrame, text: str, keep: tuple[str, ...], bare: tuple[str, ...] = BARE, body: bool = False) -> DataFrame:
    """One row for each object that is an element of a list anywhere in the JSON of column ``text``.

    Gives the columns ``keep``, then parent_pointer, pointer, native_id, and with ``body`` also field (the list's field) and
    body (the element's JSON). No shuffle: a narrow step after whatever made ``df``.
    """
    names = ["parent_pointer", "pointer", "native_id", *(["field", "body"] if body else [])]
    clash = set(keep) & set(names)
    if clash:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    source = df.select(*keep, F.col(text).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text")
    schema = ", ".join([types, *(f"{n} string" for n in names)]) if types else ", ".join(f"{n} string" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for start, texts in _blocks(batch.column(batch.num_columns - 1)):
                found = index_block(texts, bare)
                if found.num_rows:
                    kept = batch.slice(start, len(texts)).select(list(keep)).take(found.column("row")) if keep else None
                    yield pa.RecordBatch.from_arrays([*(kept.columns if keep else []), *(found.column(n) for n in names)], [*keep, *names])

    return source.mapInArrow(run, schema)


def one_per_version(versions: DataFrame, *more: Column) -> DataFrame:
    """source, key, revision, payload of each distinct version that carries a payload; the deliveries of one version are folded
    before the shuffle, so a key or a version with very many rows stays small."""
    return (
        versions.where(F.col("payload").isNotNull())
        .groupBy("source", clean("key").alias("key"), F.col("revision").cast("bigint").alias("revision"))
        .agg(F.min("payload").alias("payload"), *more)
    )


def nested_objects(versions: DataFrame, body: bool = False) -> DataFrame:
    """The elements of every version's payload: source, key, revision, parent_pointer, pointer, native_id."""
    return explode_objects(one_per_version(versions), "payload", ("source", "key", "revision"), body=body)
