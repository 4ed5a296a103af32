"""Byte-level BPE encoding and decoding by merge replay over a corpus block.

A block's texts are split by the vocabulary's pattern and every distinct piece
is encoded once, all pieces together: their bytes lie in one array of symbols
with links to both neighbours, and an inverted index leads from a token pair
(named by the rank of the token it merges to) to its positions in all pieces.
Merges are applied in rank order, each to all its positions at once, and only
the two touched neighbours of a merge get new pairs. Pieces don't interact, so
blocks are independent: a task needs its own block and the vocabulary, there is
no shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import column, map_columns

#: Text characters of a block, and pieces whose ids are kept for later blocks.
BLOCK_CHARS = 4 << 20
KEPT_PIECES = 1_000_000
NONE = np.int32(np.iinfo(np.int32).max)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 bytes and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Ranks, and the pairs that merge: a pair's name is the rank of its joined bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.size = max(ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.decimal = [str(i) for i in range(self.size)]
        self.byte = np.full(256, -1, np.int32)
        for b in range(256):
            self.byte[b] = ranks[bytes([b])]
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pairs = pairs
        #: Tokens that have a pair of lower rank than their own: after such a merge a lower one may follow.
        self.lowering = {t for key, m in pairs.items() for t in divmod(key, self.size) if m < t}
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.fromiter(pairs.values(), np.int32, len(pairs))[order]

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair merges to, NONE where it doesn't."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.merged[at], NONE)


def replay(pieces: list[bytes], vocabulary: Vocabulary) -> list[np.ndarray]:
    """The ids (int32) of each piece; a piece that is a token is that token."""
    v = vocabulary
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(lengths.sum())
    begin = np.concatenate([[0], np.cumsum(lengths)])
    symbol = v.byte[np.frombuffer(b"".join(pieces), np.uint8)] if n else np.zeros(0, np.int32)
    after = np.arange(1, n + 1, dtype=np.int64)
    before = np.arange(-1, n - 1, dtype=np.int64)
    full = lengths > 0
    after[begin[1:][full] - 1] = n  # n stands for no neighbour
    before[begin[:-1][full]] = n
    rank = np.full(n + 1, NONE, np.int32)
    inner = np.flatnonzero(after < n)
    rank[inner] = v.merge(symbol[inner], symbol[inner + 1])
    symbol = np.append(symbol, np.int32(-1))
    alive = np.ones(n + 1, bool)
    alive[n] = False

    index: dict[int, list] = {}
    live = np.flatnonzero(rank[:n] != NONE)
    order = live[np.argsort(rank[live], kind="stable")]
    cut = np.flatnonzero(np.diff(rank[order])) + 1
    for group in np.split(order, cut) if len(order) else []:
        index[int(rank[group[0]])] = [group]
    queue = list(index)
    heapq.heapify(queue)
    get, size = v.pairs.get, v.size
    none = int(NONE)

    def add(ranks: list[int], at: list[int]) -> None:
        for r, p in zip(ranks, at, strict=True):
            if r != none:
                own = index.get(r)
                if own is None:
                    index[r] = [p]
                    heapq.heappush(queue, r)
                else:
                    own.append(p)

    def one(p: int, r: int) -> None:
        """Merge at one position."""
        q = int(after[p])
        far, back = int(after[q]), int(before[p])
        symbol[p], after[p], rank[q], alive[q] = r, far, NONE, False
        new = none
        if far < n:
            before[far] = p
            new = get(r * size + int(symbol[far]), none)
        rank[p] = new
        ranks, at = [new], [p]
        if back < n:
            left = get(int(symbol[back]) * size + r, none)
            rank[back] = left
            ranks.append(left)
            at.append(back)
        add(ranks, at)

    def lowers(at: np.ndarray, r: int) -> bool:
        """Whether merging at these positions makes a pair of lower rank than r."""
        far, back = after[after[at]], before[at]
        far, back = far[far < n], back[back < n]
        right = v.merge(np.full(len(far), r, np.int32), symbol[far])
        left = v.merge(symbol[back], np.full(len(back), r, np.int32))
        return get(r * size + r, none) < r or bool((right < r).any()) or bool((left < r).any())

    while queue:
        r = heapq.heappop(queue)
        found = index.pop(r, None)
        if not found:
            continue
        arrays = [x for x in found if isinstance(x, np.ndarray)]
        single = [x for x in found if not isinstance(x, np.ndarray)]
        at = np.concatenate([*arrays, np.array(single, np.int64)]) if arrays else np.array(single, np.int64)
        at = at[rank[at] == r]
        if len(at) > 1:
            at = np.unique(at)
        if not len(at):
            continue
        clash = len(at) > 1 and bool((rank[after[at]] == r).any())
        if len(at) <= 6 or clash or r in v.lowering and lowers(at, r):
            # Left to right. A merge that makes a pair of lower rank in its piece leaves the rest for later.
            rest, stop = [], -1
            for p in at.tolist():
                if rank[p] != r or not alive[p]:
                    continue
                if p < stop:
                    rest.append(p)
                    continue
                one(p, r)
                back = int(before[p])
                if rank[p] < r or (back < n and rank[back] < r):
                    stop = int(begin[np.searchsorted(begin, p, "right")])
            if rest:
                add([r] * len(rest), rest)
            continue
        q = after[at]
        far = after[q]
        symbol[at] = r
        after[at] = far
        rank[q] = NONE
        alive[q] = False
        has = far < n
        before[far[has]] = at[has]
        new = np.full(len(at), NONE, np.int32)
        new[has] = v.merge(np.full(int(has.sum()), r, np.int32), symbol[far[has]])
        rank[at] = new
        back = before[at]
        left_at = back[back < n]
        left = v.merge(symbol[left_at], np.full(len(left_at), r, np.int32))
        rank[left_at] = left
        live = new != NONE
        add(new[live].tolist(), at[live].tolist())
        live = left != NONE
        add(left[live].tolist(), left_at[live].tolist())

    kept = np.flatnonzero(alive[:n])
    ids = symbol[kept]
    where = np.searchsorted(kept, begin)
    return [ids[a:b] for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]


def slices(text: str, limit: int) -> list[str]:
    """A long text in slices that end before white space after another character.

    Patterns whose matches never hold white space after another character, as those of
    public byte-level vocabularies, split each slice as they split the whole.
    """
    out, at = [], 0
    while len(text) - at > limit:
        cut = _TURN.search(text, at + limit)
        if cut is None:
            break
        out.append(text[at : cut.start() + 1])
        at = cut.start() + 1
    return [*out, text[at:]]


_TURN = regex.compile(r"\S(?=\s)")


class Codec:
    """Encodes and decodes blocks of texts, keeping the pieces it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.seen: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Memory follows the block's distinct pieces; a long text is taken in slices."""
        if len(texts) == 1 and len(texts[0]) > 2 * BLOCK_CHARS:
            return [np.concatenate([self._encode([part])[0] for part in slices(texts[0], BLOCK_CHARS)])]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        v, seen = self.vocabulary, self.seen
        split = [v.split(t) for t in texts]
        distinct = {*chain.from_iterable(split)}
        fresh = [piece for piece in distinct if piece not in seen]
        if len(seen) + len(fresh) > KEPT_PIECES:
            seen.clear()
            fresh = [*distinct]
        todo = []
        for piece in fresh:
            raw = piece.encode()
            whole = v.ranks.get(raw)
            if whole is None:
                todo.append((piece, raw))
            else:
                seen[piece] = np.int32(whole).tobytes()
        for (piece, _), ids in zip(todo, replay([raw for _, raw in todo], v), strict=True):
            seen[piece] = ids.tobytes()
        find = seen.__getitem__
        return [np.frombuffer(b"".join(map(find, own)), np.int32) for own in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))

    def decimals(self, ids: list[int]) -> str:
        return ",".join(map(self.vocabulary.decimal.__getitem__, ids))


def text_blocks(col: pa.Array, limit: int = BLOCK_CHARS):
    """Lists of texts of about `limit` characters together; null is empty, a longer text is alone."""
    out, size = [], 0
    for x in col:
        t = x.as_py() if x.is_valid else ""
        if out and size + len(t) > limit:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


def _mapped(docs: DataFrame, ranks: str, pattern: str, new: str, each: Callable, text: str) -> DataFrame:
    """docs with the columns `new`: a row's values are each(codec, ids)."""
    # The vocabulary is a file of fixed size on the driver; executors get its bytes.
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def start():
        codec = Codec(Vocabulary(shared.value, pattern))

        def step(batch):
            rows = [each(codec, ids) for texts in text_blocks(column(batch, text)) for ids in codec.encode(texts)]
            return [pa.array(c) for c in zip(*rows, strict=True)]

        return step

    return map_columns(docs, start, new)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """docs and an array<int> column of each text's ids, without special tokens.

    Each match of the pattern is encoded by itself. Null text is empty and
    has no ids; a column of the same name is replaced, others pass through.
    """
    return _mapped(docs, ranks, pattern, f"`{name}` array<int>", lambda _, ids: (ids,), text)


def decode(df: DataFrame, ranks: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """df and a binary column of the bytes that the ids stand for; null stays null."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def start():
        of = {rank: token for token, rank in shared.value.items()}

        def step(batch):
            return [pa.array([b"".join(map(of.__getitem__, x.as_py())) if x.is_valid else None for x in column(batch, ids)], pa.binary())]

        return step

    return map_columns(df, start, f"`{name}` binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256.

    Encodes and decodes in one pass, so that ids of long texts needn't leave the task.
    """

    def each(codec: Codec, ids: np.ndarray):
        listed = ids.tolist()
        return len(listed), hashlib.sha256(codec.decimals(listed).encode()).hexdigest(), hashlib.sha256(codec.decode(listed)).hexdigest()

    return _mapped(docs, ranks, pattern, "n_tokens long, ids_sha256 string, decoded_sha256 string", each, text)
