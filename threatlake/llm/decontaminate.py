"""Removing passages of test items from documents, by a generalised suffix automaton.

1. Items are cut into pieces that share window - 1 words, so that no window is
   lost and none is larger than a piece, and dealt to groups of bounded size. A
   group's distinct pieces make one suffix automaton over word numbers, with the items of every window.
2. Documents are streamed through it: at each word the longest suffix that is
   part of an item is tracked; a match of a window's length marks its words, and
   the suffix links lead from there to the items that hold the window.
3. Only stretches of words between windows whose hashes are in a bit array of
   all windows' hashes are streamed: no window is missed, and a false one fails to match.

The bit array and one automaton, both of checked size, are broadcast at a time;
more groups mean more passes over the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, kept_fields, map_columns, materialize, release, unused
from .kernel import U64, Words, blocks, find_words, mix, range_hash, text_buffer, window_hash, window_valid

#: 0-9, a-z and all bytes of other than ASCII letters are in words; A-Z become a-z, all else a space.
FOLD = np.full(256, 0x20, np.uint8)
FOLD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)

#: Words of an item's piece and of a group of pieces; bits of the windows' array at least and at most.
PIECE_WORDS, GROUP_WORDS = 4096, 400_000
FILTER_BITS = (1 << 16, 1 << 28)
SPAN = "array<struct<start:long,end:long,item:string>>"


class Automaton:
    """The suffix automaton of word-number sequences, and the windows that end in its states.

    edges[state] leads to the state after one more word. A window of k words
    belongs to the state whose strings hold it: link length < k <= length.
    """

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.link, self.length = [-1], [0]
        self.edges: list[dict[int, int]] = [{}]
        self.windows: list[dict[int, set[str]]] = [{}]

    def add(self, words: list[bytes]) -> None:
        """One more sequence; strings that are there already make no new states."""
        last = 0
        for word in words:
            last = self._extend(last, self.words.setdefault(word, len(self.words)))

    def _extend(self, last: int, word: int) -> int:
        edges, link, length = self.edges, self.link, self.length
        to = edges[last].get(word)
        if to is not None and length[to] == length[last] + 1:
            return to
        if to is not None:
            return self._split(last, word, to)
        new = self._state(length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in edges[at]:
            edges[at][word] = new
            at = link[at]
        if at >= 0:
            to = edges[at][word]
            link[new] = to if length[to] == length[at] + 1 else self._split(at, word, to)
        return new

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.edges.append(edges)
        self.windows.append({})
        return len(self.length) - 1

    def _split(self, at: int, word: int, to: int) -> int:
        """The state of the strings of `to` that are no longer than one word after `at`."""
        new = self._state(self.length[at] + 1, self.link[to], dict(self.edges[to]))
        self.link[to] = new
        while at >= 0 and self.edges[at].get(word) == to:
            self.edges[at][word] = new
            at = self.link[at]
        return new

    def mark(self, words: list[bytes], window: int, item: str) -> None:
        """Each window of an item that was added belongs to its state from now on; do this after the last add()."""
        size, state, have = min(window, len(words)), 0, 0
        for k, word in enumerate(words):
            state, have = self.step(state, have, self.words[word])
            if k + 1 >= size:
                at = state
                while self.length[self.link[at]] >= size:
                    at = self.link[at]
                self.windows[at].setdefault(size, set()).add(item)

    def close(self) -> None:
        """Links that skip the states without windows, shortest strings first."""
        self.up = [0] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.up[state] = state if self.windows[state] else self.up[self.link[state]]

    def step(self, state: int, have: int, word: int) -> tuple[int, int]:
        """The longest suffix after one more word: its state and its length."""
        edges = self.edges
        while state and word not in edges[state]:
            state = self.link[state]
            have = self.length[state]
        to = edges[state].get(word)
        return (to, have + 1) if to is not None else (0, 0)

    def stream(self, words: list[bytes]):
        """(first word, end, items) of each occurrence of a window, in order of ends."""
        state = have = 0
        number = self.words.get
        for k, word in enumerate(words):
            w = number(word)
            if w is None:
                state = have = 0
                continue
            state, have = self.step(state, have, w)
            at = self.up[state] if state else 0
            while at:
                for size, items in self.windows[at].items():
                    if size <= have:
                        yield k + 1 - size, k + 1, items
                at = self.up[self.link[at]]


def folded(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words]:
    """The bytes in lower case with a space for each that isn't in a word, and the words."""
    flat = FOLD[buffer]
    return flat, find_words(flat, offsets)


def window_slots(h: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Places in the bit array of all windows of `size` words: two for each."""
    got = window_hash(h, size, 5)
    return np.stack([mix(got + U64(k * 1000 + size)) & U64(bits - 1) for k in (1, 2)]).astype(np.int64)


def item_pieces(items: DataFrame, window: int, text: str, item: str) -> DataFrame:
    """(item string, piece string): the words of each item joined by a space, cut where they are many. Items without an id or words have none."""

    def cut(batches):
        for batch in batches:
            names, out_items, out = column(batch, "item").to_pylist(), [], []
            buffer, offsets = text_buffer(column(batch, "text"))
            for lo, _, b, o in blocks(buffer, offsets):
                flat, words = folded(b, o)
                raw, s, e, first = flat.tobytes(), words.start.tolist(), words.end.tolist(), words.first.tolist()
                for d in range(len(o) - 1):
                    own = [raw[s[k] : e[k]] for k in range(first[d], first[d + 1])]
                    for at in range(0, max(1, len(own) - window + 1) if own else 0, PIECE_WORDS):
                        out_items.append(names[lo + d])
                        out.append(b" ".join(own[at : at + PIECE_WORDS + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out_items, pa.string()), pa.array(out, pa.string())], names=["item", "piece"])

    rows = items.where(f"`{item}` is not null").select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "item string, piece string").distinct()


def window_filter(pieces: DataFrame, window: int, n_words: int) -> tuple[np.ndarray, list[int]]:
    """The bit array of all windows and the windows' lengths that occur; of bounded size for any number of items."""
    bits = 1 << max(FILTER_BITS[0].bit_length() - 1, min(FILTER_BITS[1].bit_length() - 1, (16 * n_words).bit_length()))

    def slots(batches):
        for batch in batches:
            for _, _, b, o in blocks(*text_buffer(column(batch, "piece"))):
                words = find_words(b, o)
                h, n = range_hash(b, words.start, words.end), np.diff(words.first)
                for size in np.unique(np.minimum(n, window)).tolist():
                    ok = window_valid(words.first, size, len(h) - size + 1)
                    ok &= (np.minimum(n, window) == size)[words.doc()[: len(ok)]]
                    at = np.unique(window_slots(h, size, bits)[:, ok])
                    mask = np.left_shift(U64(1), (at & 63).astype(U64))
                    word, begin = np.unique(at >> 6, return_index=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), size, np.int32)), pa.array(word), pa.array(np.bitwise_or.reduceat(mask, begin).view(np.int64))], names=["size", "word", "mask"])

    rows = materialize(pieces.select("piece").mapInArrow(slots, "size int, word long, mask long").groupBy("size", "word").agg(F.bit_or("mask").alias("mask")), "window-filter")
    table, sizes = np.zeros(bits >> 6, U64), [r.size for r in rows.select("size").distinct().collect()]
    for r in rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        table[r.word] = r.mask & ((1 << 64) - 1)
    release(rows)
    return table, sorted(sizes)


class Group:
    """Pieces of items that are sent to workers; each worker builds the automaton once."""

    def __init__(self, pieces: list[tuple[str, str]], window: int):
        self.pieces, self.window, self.built = pieces, window, None

    def automaton(self) -> Automaton:
        if self.built is None:
            self.built = build(self.pieces, self.window)
        return self.built


def build(pieces: list[tuple[str, str]], window: int) -> Automaton:
    out, split = Automaton(), [(item, piece.encode().split(b" ")) for item, piece in pieces]
    for words in {tuple(words) for _, words in split}:
        out.add(list(words))
    for item, words in split:
        out.mark(words, window, item)
    out.close()
    return out


def candidate_stretches(h: np.ndarray, first: np.ndarray, table: np.ndarray, sizes: list[int]) -> np.ndarray:
    """(first word, end) of the stretches of words that windows in the bit array cover, by document."""
    cover = np.zeros(len(h) + 1, np.int64)
    for size in sizes:
        if len(h) < size:
            continue
        a, b = window_slots(h, size, len(table) << 6)
        ok = window_valid(first, size, len(a))
        for at in (a, b):
            ok &= table[at >> 6] >> (at & 63).astype(U64) & U64(1) == 1
        begin = np.flatnonzero(ok)
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + size, -1)
    inside = np.zeros(len(h) + 2, np.int8)
    inside[1:-1] = np.cumsum(cover[:-1]) > 0
    starts, ends = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    # Stretches of neighbouring documents touch where both are covered: cut at the documents' edges.
    edges = first[1:-1]
    inner = edges[(edges > 0) & (edges < len(h))]
    inner = np.unique(inner[inside[inner] & inside[inner + 1] > 0]) if len(inner) else inner
    return np.stack([np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))], 1)


def _spans(words: list[bytes], shift: int, automaton: Automaton) -> list[tuple[int, int, str]]:
    """Merged spans of each item in a stretch of words."""
    out: dict[str, list[list[int]]] = {}
    for s, e, items in automaton.stream(words):
        for item in items:
            own = out.setdefault(item, [])
            if own and s <= own[-1][1]:
                own[-1][0], own[-1][1] = min(s, own[-1][0]), max(e, own[-1][1])
            else:
                own.append([s, e])
    return [(s + shift, e + shift, item) for item, own in out.items() for s, e in own]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, text: str = "text", item_text: str = "text", item_id: str = "item_id", group_words: int | None = None) -> DataFrame:
    """docs with n_words, n_hit, longest (words of the longest hit stretch), spans, items, contaminated, and text without hit stretches.

    Words are maximal runs of 0-9, a-z and characters from U+0080 on, after A-Z
    are in lower case. A window is `window` consecutive words of an item, all
    of them where the item has fewer. A word in any occurrence of a window is
    hit; spans are the hit stretches of each item (words [start, end)), items the
    ids (as strings, sorted, each once) of items with an occurring window.
    The text loses the characters from each hit stretch's first word to its
    last; if more than max_coverage of its words are hit, it becomes empty.
    Null and empty texts have no words and come back empty. Items without an
    id, a text or words take no part; rows of one id are one item. Rows of docs
    are told apart by place, so null and repeated ids do no harm. Columns of the new
    names are replaced; others pass through. No documents, no rows.
    """
    pieces = materialize(item_pieces(items, window, item_text, item_id), "item-pieces")
    n_words = pieces.agg(F.coalesce(F.sum(F.size(F.split("piece", " "))), F.lit(0)).alias("n")).first().n
    groups = max(1, -(-n_words // (group_words or GROUP_WORDS)))
    filter_table, sizes = window_filter(pieces, window, n_words)
    context = docs.sparkSession.sparkContext
    filter_shared = context.broadcast((filter_table, sizes))
    carried, out, before = unused(docs, "spans_so_far"), docs, None
    for g in range(groups):
        own = pieces if groups == 1 else pieces.where(F.pmod(F.xxhash64("piece"), F.lit(groups)) == g)
        shared = context.broadcast(Group([(r.item, r.piece) for r in own.collect()], window))
        last = g == groups - 1
        out = map_columns(out, _pass(filter_shared, shared, text, carried if g else None, last, max_coverage), _schema(text, carried, last))
        if not last:
            out = materialize(out, "decontaminated")
            if before is not None:
                release(before)
            before = out
    release(pieces)
    return out.drop(carried) if groups > 1 else out


def _schema(text: str, carried: str, last: bool) -> T.StructType:
    if not last:
        return T._parse_datatype_string(f"`{carried}` {SPAN}")
    return T._parse_datatype_string(f"n_words long, n_hit long, longest long, spans {SPAN}, items array<string>, contaminated boolean, `{text}` string")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("item", pa.string())]))


def _pass(filter_shared, shared, text: str, carried: str | None, last: bool, max_coverage: float):
    def start():
        table, sizes = filter_shared.value
        automaton = shared.value.automaton()

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            col = column(batch, text)
            spans = [[(x["start"], x["end"], x["item"]) for x in own or ()] for own in column(batch, carried).to_pylist()] if carried else [[] for _ in range(batch.num_rows)]
            n, hit, longest, texts = [], [], [], []
            buffer, offsets = text_buffer(col)
            for lo, hi, b, o in blocks(buffer, offsets):
                flat, words = folded(b, o)
                first = words.first
                if sizes:
                    raw = flat.tobytes()
                    for s, e in candidate_stretches(range_hash(flat, words.start, words.end), first, table, sizes).tolist():
                        d = int(np.searchsorted(first, s, "right")) - 1
                        spans[lo + d] += _spans([raw[x:y] for x, y in zip(words.start[s:e].tolist(), words.end[s:e].tolist(), strict=True)], s - int(first[d]), automaton)
                if last:
                    n += np.diff(first).tolist()
                    for d in range(hi - lo):
                        own = spans[lo + d]
                        merged = _merged(own)
                        x, y, f = int(o[d]), int(o[d + 1]), int(first[d])
                        count = sum(e - s for s, e in merged)
                        hit.append(count)
                        longest.append(max((e - s for s, e in merged), default=0))
                        texts.append(_without(b[x:y].tobytes(), [(int(words.start[f + s]) - x, int(words.end[f + e - 1]) - x) for s, e in merged], count > max_coverage * (first[d + 1] - first[d])))
            found = pa.array([[{"start": s, "end": e, "item": i} for s, e, i in sorted(set(own))] for own in spans], SPANS)
            if not last:
                return [found]
            ids = pa.array([sorted({i for _, _, i in own}) for own in spans], pa.list_(pa.string()))
            return [pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(longest, pa.int64()), found, ids, pa.array([k > 0 for k in hit], pa.bool_()), pa.array(texts, pa.string())]

        return step

    return start


def _merged(spans: list[tuple[int, int, str]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e, _ in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return out


def _without(raw: bytes, spans: list[tuple[int, int]], all_of_it: bool) -> str:
    if all_of_it:
        return ""
    at, kept = 0, []
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]]).decode()
