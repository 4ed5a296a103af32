"""The most similar name of a list for each asked one: an exact top-1 join by difflib's ratio.

The ratio of two names of lengths a and b is 2 * M / (a + b), where M matched
characters lie in blocks. M is at most the number of characters that both have,
and as between two blocks at least one character is unmatched, names that share
g pairs of neighbouring characters have M <= (g + a + b + 1) / 3. Names are dealt to
cells by length; asked names go to the cells whose lengths allow the best ratio
first, and to others only while those can still beat, or tie with, what was found.
M is also at most the longest common subsequence. In a cell names of one length
are a prefix tree, and asked names go down it together: a branch is left when its
letters so far and all letters to come can't reach what was found, or reach it only
at a later ordinal. So the cost hangs on the names that resemble an asked one, not on
all names. Names too long for that have the bounds of the whole cell computed at once.

Nothing is collected or broadcast: both sides are shuffled by cell, a length
with very many names is cut by hash, and so are the asked names.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of a cell and asked names of a cell, about.
CELL_NAMES, CELL_ASKED = 200_000, 100_000
#: Asked names of a block at least, where there are fewer blocks than cores.
LEAST_ASKED = 2_000
#: Ratios that the lengths of a round's cells allow at least.
ROUNDS = (0.9, 0.6, 0.0)
CHARS, PAIRS = 32, 64
#: Asked names of at most 63 characters (bits of a word) go down the tree, through listed names of at most 256.
TREE_ASKED, TREE_NAMES = 63, 256
#: Branches of an asked name that are tried first, and branches opened at once.
BEAM, OPENED = 4, 500_000


def signature(name: str) -> np.ndarray:
    """Counts of characters and of pairs of neighbours, several kinds to a place, so that common counts are never too low."""
    points = np.frombuffer(name.encode("utf-32-le"), "<u4").astype(np.int64)
    pairs = points[:-1] * 31 + points[1:] * 7
    return np.concatenate([np.bincount(points % CHARS, minlength=CHARS), np.bincount(pairs % PAIRS, minlength=PAIRS)]).astype(np.uint16)


class Cell:
    """Names of any lengths, with their bounds' counts."""

    def __init__(self, names: list[str], ordinals: list[int]):
        self.names, self.ordinals = names, np.array(ordinals, np.int64)
        self.lengths = np.array([len(n) for n in names], np.int64)
        self.counts = np.stack([signature(n) for n in names]) if names else np.zeros((0, CHARS + PAIRS), np.uint16)

    def bounds(self, name: str) -> np.ndarray:
        """What the ratio of each name is at most; computed as difflib does, so that equal numbers are equal."""
        both = np.minimum(self.counts, signature(name))
        total = self.lengths + len(name)
        chars, pairs = both[:, :CHARS].sum(1, dtype=np.int64), both[:, CHARS:].sum(1, dtype=np.int64)
        return np.where(total > 0, 2.0 * np.minimum(chars, (pairs + total + 1) // 3) / np.maximum(total, 1), 1.0)

    def best(self, name: str, score: float = 0.0, ordinal: int = 1 << 62) -> tuple[int, float]:
        """(place, ratio) of the most similar name that beats score, or ties with it at a smaller ordinal; -1 if none does."""
        bound, found = self.bounds(name), -1
        matcher = SequenceMatcher(None, "", name)
        hopeful = np.flatnonzero((bound > score) | ((bound == score) & (self.ordinals < ordinal)))
        for k in hopeful[np.lexsort((self.ordinals[hopeful], -bound[hopeful]))].tolist():
            if bound[k] < score:
                break
            own = int(self.ordinals[k])
            if bound[k] == score and own > ordinal:
                continue
            matcher.set_seq1(self.names[k])
            quick = matcher.quick_ratio()
            if quick < score or quick == score and own > ordinal:
                continue
            got = matcher.ratio()
            if got > score or got == score > 0 and own < ordinal:
                found, score, ordinal = k, got, own
        return found, score


class Tree:
    """Names of one length as a prefix tree in arrays: a node is a stretch of the sorted names."""

    def __init__(self, names: list[str], ordinals: list[int]):
        self.order = sorted(range(len(names)), key=lambda k: (names[k], ordinals[k]))
        self.names, self.length = [names[k] for k in self.order], len(names[0])
        self.ordinals = np.array(ordinals, np.int64)[self.order]
        points = np.frombuffer("".join(self.names).encode("utf-32-le"), "<u4").reshape(len(names), self.length)
        self.alphabet, codes = np.unique(points, return_inverse=True)
        self.codes = codes.reshape(points.shape).astype(np.int32)
        differ = points[1:] != points[:-1]
        shared = np.where(differ.any(1), differ.argmax(1), self.length)
        self.starts, self.least = [], []  # by depth; depths without a new branch share their arrays
        for depth in range(self.length + 1):
            at = np.concatenate([[0], 1 + np.flatnonzero(shared < depth)]).astype(np.int32)
            if depth and len(at) == len(self.starts[-1]):
                self.starts.append(self.starts[-1])
                self.least.append(self.least[-1])
            else:
                self.starts.append(at)
                self.least.append(np.minimum.reduceat(self.ordinals, at))

    def best(self, asked: list[str], scores: list[float], ordinals: list[int]) -> list[int]:
        """Cell.best of each asked name: the places of names that beat its score (-1: none); scores and ordinals are brought up to date."""
        found, size = [-1] * len(asked), max(1, 1_000_000 // len(self.alphabet))
        for lo in range(0, len(asked), size):
            part = slice(lo, min(lo + size, len(asked)))
            search = _Search(self, asked[part], scores[part], ordinals[part])
            search.walk(BEAM)
            search.walk(None)
            scores[part], ordinals[part] = search.scores.tolist(), search.ordinals.tolist()
            found[part] = [self.order[k] if k >= 0 else -1 for k in search.found]
        return found


class _Search:
    """Some asked names on their way down a tree."""

    def __init__(self, tree: Tree, asked: list[str], scores: list[float], ordinals: list[int]):
        self.tree, self.asked, self.found = tree, asked, [-1] * len(asked)
        self.scores, self.ordinals = np.array(scores, np.float64), np.array(ordinals, np.int64)
        self.lengths = np.array([len(n) for n in asked], np.int64)
        points = np.frombuffer("".join(asked).encode("utf-32-le"), "<u4")
        owner = np.repeat(np.arange(len(asked)), self.lengths)
        bit = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        code = np.minimum(np.searchsorted(tree.alphabet, points), len(tree.alphabet) - 1)
        known = tree.alphabet[code] == points
        self.masks = np.zeros((len(asked), len(tree.alphabet)), np.uint64)
        np.add.at(self.masks, (owner[known], code[known]), np.uint64(1) << bit[known].astype(np.uint64))

    def hopeful(self, a: np.ndarray, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        ratio = 2.0 * bound / (self.tree.length + self.lengths[a])
        return (ratio > self.scores[a]) | ((ratio == self.scores[a]) & (ratio > 0) & (least < self.ordinals[a]))

    def walk(self, beam: int | None) -> None:
        """Down to the leaves that may be the best: all of them, or those of the best `beam` branches at each depth."""
        n, tree = len(self.asked), self.tree
        # A bit of `unmatched` that is 0 ends a longer common subsequence of the branch's letters and the asked name so far.
        todo = [(0, np.arange(n), np.full(n, ~np.uint64(0)), np.zeros(n, np.int64), np.minimum(self.lengths, tree.length))]
        while todo:
            depth, a, unmatched, node, bound = todo.pop()
            keep = self.hopeful(a, bound, tree.least[depth][node])
            a, unmatched, node, bound = a[keep], unmatched[keep], node[keep], bound[keep]
            if depth == tree.length:
                self.compare(a, node, bound)
                continue
            ends = np.append(tree.starts[depth][1:], len(tree.names))
            below = tree.starts[depth + 1]
            first = np.searchsorted(below, tree.starts[depth][node])
            many = np.searchsorted(below, ends[node]) - first
            fit = len(a) if beam else max(1, int(np.searchsorted(np.cumsum(many), OPENED, "right")))
            if fit < len(a):
                todo.append((depth, a[fit:], unmatched[fit:], node[fit:], bound[fit:]))
                a, unmatched, first, many = a[:fit], unmatched[:fit], first[:fit], many[:fit]
            if not len(a):
                continue
            child = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            a, unmatched = np.repeat(a, many), np.repeat(unmatched, many)
            hit = unmatched & self.masks[a, tree.codes[below[child], depth]]
            unmatched = (unmatched + hit) | (unmatched - hit)
            rest = tree.length - depth - 1
            head = np.maximum(self.lengths[a] - rest, 0)
            bound = np.bitwise_count(~unmatched & ((np.uint64(1) << head.astype(np.uint64)) - np.uint64(1))) + np.minimum(self.lengths[a], rest)
            least = tree.least[depth + 1][child]
            keep = np.flatnonzero(self.hopeful(a, bound, least))
            if beam:
                keep = keep[np.lexsort((least[keep], -bound[keep], a[keep]))]
                own = a[keep]
                keep = keep[np.arange(len(own)) - np.searchsorted(own, own) < beam]
            if len(keep):
                todo.append((depth + 1, a[keep], unmatched[keep], child[keep], bound[keep]))

    def compare(self, a: np.ndarray, leaf: np.ndarray, bound: np.ndarray) -> None:
        places = self.tree.starts[-1][leaf]
        own = self.tree.ordinals[places]
        by = np.lexsort((own, -bound, a))
        last, matcher = -1, SequenceMatcher(None, "", "")
        for i, k, ordinal, b in zip(a[by].tolist(), places[by].tolist(), own[by].tolist(), bound[by].tolist(), strict=True):
            if i != last:
                last, score, least = i, float(self.scores[i]), int(self.ordinals[i])
                matcher.set_seq2(self.asked[i])
            most = 2.0 * b / (self.tree.length + len(self.asked[i]))
            if most < score or most == score and ordinal >= least:
                continue
            matcher.set_seq1(self.tree.names[k])
            got = matcher.ratio()
            if got > score or got == score > 0 and ordinal < least:
                self.found[i], score, least = k, got, ordinal
                self.scores[i], self.ordinals[i] = got, ordinal


def _bound(length: Column, own: Column) -> Column:
    return F.lit(2.0) * F.least(length, own) / (length + own)


def most_similar(asked: DataFrame, index: DataFrame, column: str = "name_key") -> DataFrame:
    """(name_key, actor_id, score) of each distinct asked name: the index's name of the highest ratio, of the smallest ordinal on ties.

    asked and index (name_key, actor_id, ordinal) have no null or empty names.
    Score and id are null where no name shares a character with the asked one.
    """
    wanted = asked.select(F.col(column).alias("key")).distinct()
    cells = max(1, -(-index.count() // CELL_NAMES))
    n = wanted.count()
    blocks = max(1, -(-n // CELL_ASKED), min(asked.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_ASKED)))
    kind = index.schema["actor_id"].dataType.simpleString()
    names = index.select(F.length("name_key").alias("length"), F.pmod(F.xxhash64("name_key"), F.lit(cells)).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "name_key", "actor_id", "ordinal")
    lengths = index.agg(F.collect_set(F.length("name_key")).alias("lengths"))  # one row
    best = wanted.withColumns({"score": F.lit(0.0), "ordinal": F.lit(1 << 62), "actor_id": F.lit(None).cast(kind)})

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, scores, ordinals, ids = (left.column(c).to_pylist() for c in ("key", "score", "ordinal", "actor_id"))
        if keys and right.num_rows:
            own, listed, places = right.column("actor_id"), right.column("name_key").to_pylist(), right.column("ordinal").to_pylist()
            short = [i for i, key in enumerate(keys) if len(key) <= TREE_ASKED and len(listed[0]) <= TREE_NAMES]
            if short:
                near, order = [scores[i] for i in short], [ordinals[i] for i in short]
                for i, k, score, ordinal in zip(short, Tree(listed, places).best([keys[i] for i in short], near, order), near, order, strict=True):
                    if k >= 0:
                        scores[i], ordinals[i], ids[i] = score, ordinal, own[k].as_py()
            if len(short) < len(keys):
                cell, done = Cell(listed, places), set(short)
                for i, key in enumerate(keys):
                    if i in done:
                        continue
                    k, score = cell.best(key, scores[i], ordinals[i])
                    if k >= 0:
                        scores[i], ordinals[i], ids[i] = score, int(cell.ordinals[k]), own[k].as_py()
        return pa.table({"key": pa.array(keys, pa.string()), "score": pa.array(scores, pa.float64()), "ordinal": pa.array(ordinals, pa.int64()), "actor_id": pa.array(ids, left.schema.field("actor_id").type)})

    most = 2.0
    for least in ROUNDS:
        own = F.length("key")
        allowed = F.filter("lengths", lambda n: (_bound(n, own) >= least) & (_bound(n, own) < most) & (_bound(n, own) >= F.col("score")))
        # A name without a cell in this round keeps what it has, in its block's cell of no names.
        places = F.flatten(F.transform(allowed, lambda n: F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda p: F.struct(n.alias("length"), p.cast("long").alias("part")))))
        none = F.array(F.struct(F.lit(-1).alias("length"), F.lit(0).cast("long").alias("part")))
        routed = best.join(F.broadcast(lengths)).select("key", "score", "ordinal", "actor_id", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.explode(F.when(F.size(places) > 0, places).otherwise(none)).alias("at"))
        routed = routed.select("*", F.col("at.length").alias("length"), F.col("at.part").alias("part")).drop("at")
        met = routed.groupBy("length", "part", "block").cogroup(names.groupBy("length", "part", "block")).applyInArrow(meet, f"key string, score double, ordinal long, actor_id {kind}")
        best = met.groupBy("key").agg(F.max(F.struct("score", (-F.col("ordinal")).alias("earlier"), "actor_id")).alias("b")).select("key", "b.score", (-F.col("b.earlier")).alias("ordinal"), "b.actor_id")
        most = least
    return best.select(F.col("key").alias(column), "actor_id", F.when(F.col("score") > 0, F.col("score")).alias("score"))
