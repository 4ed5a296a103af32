"""Quality rules: base rules and a calibrated hashed n-gram classifier.

The classifier is logistic regression over hashed word n-grams and character
n-grams, each group averaged over its occurrences, trained on labelled rows.
Training rows are a bounded sample; a held-out part of it calibrates
the probability (Platt's sigmoid, weighted to the labels' true rate). Documents
are scored in Arrow batches: numpy hashes every n-gram of a whole batch, looks
weights up in one table of fixed size and averages by document.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, give_back, map_columns
from .kernel import BLOCK_BYTES, U64, Words, blocks, find_words, mix, range_hash, text_buffer, window_hash, window_valid

#: Symbols that the base rules count.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document is rejected below this calibrated probability of being good: only
#: where the classifier is sure, as a lost good document can't be had back. Few
#: labels calibrate to no smaller probabilities than about this.
THRESHOLD = 0.1
#: At most so many labelled rows of each label are fitted.
SAMPLE_ROWS = 1500
BITS = 16
#: Text bytes scored at once: a quarter of other kernels', since a block's n-grams of several kinds are held side by side.
SCORE_BYTES = 512 << 10
#: (kind, n): word n-grams and character n-grams (bytes, across words too).
GROUPS = (("word", 1), ("word", 2), ("char", 3))

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[0x20, 9, 10, 11, 12, 13]] = True


def _sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values over [bounds[d], bounds[d + 1])."""
    if len(bounds) == 2:  # one document, which may be long
        return np.array([values[bounds[0] : bounds[1]].sum(dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def base_counts(buffer: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each document."""
    lead = ((buffer & 0xC0) != 0x80) & ~_SEPARATES[buffer]
    out = {"n_words": np.diff(words.first), "word_chars": _sum(lead, offsets), "n_symbols": _sum(_IS_SYMBOL[buffer], offsets)}

    raw = buffer.tobytes()
    dup = np.zeros(len(offsets) - 1, np.int64)
    for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        lines = raw[a:b].split(b"\n")
        if len({*lines}) < len(lines):
            seen = set()
            for x in lines:
                if x in seen:
                    dup[d] += bool(x.strip())
                else:
                    seen.add(x)
    out["n_dup_lines"] = dup

    word = range_hash(buffer, words.start, words.end)
    doc = words.doc()
    h = window_hash(word, REPEAT_WINDOW)
    h = mix(h ^ mix(doc[: len(h)].astype(U64) + U64(1)))
    at = np.flatnonzero(window_valid(words.first, REPEAT_WINDOW, len(h)))
    order = at[np.argsort(h[at], kind="stable")]
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(len(doc) + 1, np.int64)
    np.add.at(edge, order[twice], 1)
    np.add.at(edge, order[twice] + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = _sum(np.cumsum(edge)[: len(doc)] > 0, words.first)
    return out


def features(buffer: np.ndarray, offsets: np.ndarray, words: Words):
    """(group, slots, bounds): the hashed slot of every n-gram in order, and the documents' bounds among them.

    The characters of a long document come in slices, so a group may come again.
    """
    word = range_hash(buffer, words.start, words.end)
    for g, (kind, size) in enumerate(GROUPS):
        if kind == "word":
            yield g, *_slots(word, words.first, size, g)
        elif len(offsets) > 2 or len(buffer) <= 2 * BLOCK_BYTES:
            yield g, *_slots(_byte_hash(buffer), offsets, size, g)
        else:
            for lo in range(0, len(buffer), BLOCK_BYTES):
                part = buffer[lo : lo + BLOCK_BYTES + size - 1]
                if len(part) >= size:
                    yield g, *_slots(_byte_hash(part), np.array([0, len(part)]), size, g)


def _byte_hash(buffer: np.ndarray) -> np.ndarray:
    return mix((buffer.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))


def _slots(base: np.ndarray, first: np.ndarray, size: int, g: int) -> tuple[np.ndarray, np.ndarray]:
    h = window_hash(base, size, 10 + g) if size > 1 else base
    ok = window_valid(first, size, len(h))
    slot = (mix(h + U64(g)) >> U64(64 - BITS)).astype(np.int64)[ok] + (g << BITS)
    return slot, np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - size + 1, 0))])


@dataclass
class Model:
    weights: np.ndarray  # float32, 2 ** BITS for each group
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, buffer: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
        total, count = np.zeros((2, len(GROUPS), len(offsets) - 1))
        for g, slot, bounds in features(buffer, offsets, words):
            total[g] += _sum(self.weights[slot], bounds)
            count[g] += np.diff(bounds)
        return self.bias + (total / np.maximum(count, 1)).sum(axis=0)

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -50, 50)))


def _sparse(batches):
    """Rows (label, slots, values) of texts: each group's mean counts."""
    for batch in batches:
        buffer, offsets = text_buffer(column(batch, "text"))
        labels, at, rows = column(batch, "label").to_pylist(), 0, []
        for lo, hi, b, o in blocks(buffer, offsets, SCORE_BYTES):
            parts = list(features(b, o, find_words(b, o)))
            for d in range(hi - lo):
                slots, values = [], []
                for g in range(len(GROUPS)):
                    own, n = np.unique(np.concatenate([slot[bounds[d] : bounds[d + 1]] for k, slot, bounds in parts if k == g] or [np.zeros(0, np.int64)]), return_counts=True)
                    slots.append(own)
                    values.append(n / max(1, n.sum()))
                rows.append((labels[at], np.concatenate(slots).astype("<i4").tobytes(), np.concatenate(values).astype("<f4").tobytes()))
                at += 1
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["label", "slots", "values"])
        del batch, buffer, offsets, rows, cols
        give_back()


def near_groups(slots: list[np.ndarray], similarity: float = 0.5) -> np.ndarray:
    """For each row the smallest row of its group; rows whose word pairs have about that Jaccard similarity (by 64 MinHash values) are of one group.

    For the bounded rows of a sample, whose pairs are compared in memory.
    """
    seeds = mix(np.arange(1, 65, dtype=U64))
    pairs = [s[(s >> BITS) == GROUPS.index(("word", 2))].astype(U64) for s in slots]
    sketch = np.stack([mix((s * U64(0x9E3779B97F4A7C15))[None, :] ^ seeds[:, None]).min(axis=1) if len(s) else np.zeros(64, U64) for s in pairs])
    alike = np.zeros((len(slots), len(slots)), bool)
    for k, row in enumerate(sketch):
        alike[k] = (sketch == row).sum(axis=1) >= similarity * 64
    group = np.arange(len(slots))
    while True:
        new = np.array([group[row].min() for row in alike], np.int64)
        new = new[new]
        if (new == group).all():
            return group
        group = new


def held_out_rows(slots: list[np.ndarray], labels: np.ndarray, share: float = 0.25) -> np.ndarray:
    """Which rows calibrate: about a share of each label's, near copies of fitted rows never among them.

    Whole groups of near copies go one way, by a hash of their content; a label's
    groups calibrate in that order until its share is full, and one at least is fitted.
    """
    group = near_groups(slots)
    out = np.zeros(len(labels), bool)
    content = {g: hashlib.sha256(slots[g].tobytes()).digest() for g in set(group.tolist())}
    for label in sorted(set(labels.tolist()), reverse=True):
        sizes = Counter(group[(labels == label) & ~out].tolist())
        mixed = set(group[labels != label].tolist())
        room = share * (labels == label).sum()
        for g in sorted((g for g in sizes if g not in mixed), key=content.__getitem__):
            if sizes[g] <= room:
                out[group == g] = True
                room -= sizes[g]
    return out


def fit(slots: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, rate: float, steps: int = 120, held_out: float = 0.25) -> Model:
    """Logistic regression by full-batch Adam; held-out rows calibrate. rate: the share of good rows at large."""
    n = len(labels)
    own = ~held_out_rows(slots, labels, held_out)
    used, column_of = np.unique(np.concatenate(slots), return_inverse=True)
    row = np.repeat(np.arange(n), [len(s) for s in slots])
    value = np.concatenate(values).astype(np.float64)
    # Rare n-grams get a larger scale, by the root of their mean.
    scale = 1 / np.sqrt(np.bincount(column_of, value, len(used)) / n + 1e-6)
    value *= scale[column_of]
    keep = own[row]
    weight = np.where(labels == 1, rate / max(1e-9, labels[own].mean()), (1 - rate) / max(1e-9, 1 - labels[own].mean()))
    w, bias = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    r, c, x, y = row[keep], column_of[keep], value[keep], labels.astype(float)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(r, x * w[c], n), -50, 50)))
        error = np.where(own, (p - y) * weight, 0) / own.sum()
        grad = np.bincount(c, x * error[r], len(used)) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.999 * vb + 0.001 * error.sum() ** 2
        rate_t = 0.05 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= rate_t * m / (np.sqrt(v) + 1e-8)
        bias -= rate_t * mb / (np.sqrt(vb) + 1e-8)
    logit = bias + np.bincount(row, value * w[column_of], n)
    slope, shift = _platt(logit[~own], labels[~own], weight[~own])
    table = np.zeros(len(GROUPS) << BITS, np.float32)
    table[used] = w * scale
    return Model(table, bias, slope, shift)


def _platt(logit: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrating sigmoid, with Platt's smoothed targets, by Newton steps."""
    if len(set(labels.tolist())) < 2:
        return 1.0, 0.0
    up, down = (labels == 1).sum(), (labels == 0).sum()
    y = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([logit, np.ones_like(logit)])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -50, 50)))
        grad = x @ (weight * (p - y)) + 1e-3 * (at - [1, 0])
        curve = (x * (weight * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, grad)
        at = at - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """The model from labelled documents; None without rows of both labels.

    At most sample_rows labelled ids of each label are fitted, chosen by a
    hash of the id, so any input size costs the driver the same. Rows whose label
    is not 0 or 1 are left out; an id labelled twice has its smaller label. Texts
    of the same n-grams are fitted once, and near copies never lie on both sides
    of the split between fitting and calibration. Rows that repeat a labelled id
    are rows of their own; empty tables give None.
    """
    clean = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(label).cast("int").alias("label"))
    counts = {r.label: r.n for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    ranked = F.xxhash64("id", F.lit("quality"))
    chosen = clean.where("label = 0").orderBy(ranked, "id").limit(sample_rows).unionByName(clean.where("label = 1").orderBy(ranked, "id").limit(sample_rows))
    # At most 2 * sample_rows rows, so this broadcast has a fixed bound.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")
    got = rows.select("label", "text", F.xxhash64("id").alias("order")).select("label", "text").mapInArrow(_sparse, "label int, slots binary, values binary").collect()
    if len({r.label for r in got}) < 2:
        return None
    # Copies count once, in an order that doesn't depend on how tasks ended; a copy labelled both ways has its smaller label.
    once: dict[bytes, object] = {}
    for r in sorted(got, key=lambda r: (r.label, bytes(r["values"]))):
        once.setdefault(bytes(r.slots), r)
    got = [once[k] for k in sorted(once)]
    if len({r.label for r in got}) < 2:
        return None
    slots = [np.frombuffer(r.slots, "<i4") for r in got]
    values = [np.frombuffer(r["values"], "<f4") for r in got]
    return fit(slots, values, np.array([r.label for r in got]), counts[1] / (counts[0] + counts[1]))


NEW = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, p_good double, kept boolean"


def judge(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs with the base counts, base_failed, p_good and kept.

    base_failed: fewer than 10 words, or over a fifth of the words lie in 5-word
    windows that the text has twice. kept: not base_failed and p_good at least
    the threshold. Without a model p_good is null and only base rules decide.
    Null text has no words. Repeated rows are judged each by itself, an empty table stays
    empty. Columns of the new names are replaced, others pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def step(batch):
            buffer, offsets = text_buffer(column(batch, text))
            parts = []
            for _, _, b, o in blocks(buffer, offsets, SCORE_BYTES):
                words = find_words(b, o)
                own = base_counts(b, o, words)
                own["p_good"] = model.probability(model.logit(b, o, words)) if model else np.full(len(o) - 1, np.nan)
                parts.append(own)
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            got = {n: np.concatenate([p[n] for p in parts]) if parts else np.zeros(0) for n in [*names, "p_good"]}
            failed = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > MAX_REPEAT_PERCENT * got["n_words"])
            kept = ~failed & ((got["p_good"] >= threshold) | (model is None))
            return [*(pa.array(got[n].astype(np.int64)) for n in names), pa.array(failed), pa.array(got["p_good"], pa.float64(), from_pandas=True), pa.array(kept)]

        return step

    return map_columns(docs, start, NEW)


__all__ = ["Model", "base_counts", "fit", "judge", "train"]
