"""How filters interact: what each removes in every order, over a whole table.

1. One pass over the texts gives each row its number of code points, a chain of
   hashes of successive blocks (each eight times as long as the one before) and the filters
   that look at the text alone.
2. Duplicates by partition refinement: rows are split by length, then by one
   block's hash after the other; a class of one row drops out and is asked nothing
   further. The full texts of the classes that are left are compared, and of
   equal texts all but the smallest id's are marked.
3. Rows are counted by part, mask of failed filters and labels; at most 32 masks
   and 4 kinds of label a part meet the orders.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, release, unused
from .kernel import U64, blocks, combine, find_words, mix, range_hash, text_buffer

#: Bytes of a text's first block, and how many times longer each next one is.
FIRST_BLOCK, GROWTH = 512, 8
#: Bits of the array that keeps classes of one row out of the comparison, at most.
FILTER_BITS = 1 << 28

_LEAD = (np.arange(256) & 0xC0) != 0x80
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b"#$%&*|")] = True


def block_hashes(raw: bytes) -> list[int]:
    """A hash of each successive block of a text's bytes."""
    out, at, size = [], 0, FIRST_BLOCK
    while at < len(raw):
        out.append(xxhash.xxh3_64_intdigest(raw[at : at + size]))
        at, size = at + size, size * GROWTH
    return out


def class_key(n_chars: int, hashes: list[int]) -> int:
    """One 64-bit name for a length and all its blocks' hashes."""
    return xxhash.xxh3_64_intdigest(np.array([n_chars, *hashes], "<u8").tobytes())


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_features(col: pa.Array, hash_bits: int = 64) -> dict[str, np.ndarray | list]:
    """n_chars, n_words, n_distinct, n_upper, n_signs of each text, its blocks' hashes, and key, one name for all of these hashes and the length."""
    buffer, offsets = text_buffer(col)
    mask = (1 << hash_bits) - 1
    out: dict[str, list] = {k: [] for k in ("n_chars", "n_words", "n_distinct", "n_upper", "n_signs", "hashes")}
    for _, _, b, o in blocks(buffer, offsets):
        words = find_words(b, o)
        doc = words.doc()
        own = np.unique(combine(range_hash(b, words.start, words.end), mix(doc.astype(U64) + U64(1)), 3), return_index=True)[1]
        out["n_words"].append(np.diff(words.first))
        out["n_distinct"].append(np.bincount(doc[own], minlength=len(o) - 1))
        for name, table in (("n_chars", _LEAD), ("n_upper", _UPPER), ("n_signs", _SIGN)):
            out[name].append(_sums(table[b], o))
        raw = b.tobytes()
        out["hashes"] += [[h & mask for h in block_hashes(raw[x:y])] for x, y in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
    made = {k: v if k == "hashes" else np.concatenate([np.zeros(0, np.int64), *v]) for k, v in out.items()}
    return made | {"key": np.array([class_key(n, own) for n, own in zip(made["n_chars"].tolist(), made["hashes"], strict=True)], np.uint64)}


def scan(docs: DataFrame, columns: dict[str, Column | str], text: str = "text", with_text: bool = False, hash_bits: int = 64) -> DataFrame:
    """The named columns and n_chars, n_words, n_distinct, n_upper, n_signs, hashes (array<long>), key (long) of each row.

    with_text adds body, the text with null as empty. hash_bits: how many bits of each hash count (tests take few).
    """
    rows = docs.select(*((F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()), F.coalesce(text, F.lit("")).alias("body"))
    names, counts = rows.columns[:-1], ["n_chars", "n_words", "n_distinct", "n_upper", "n_signs"]

    def run(batches):
        for batch in batches:
            got = text_features(column(batch, "body"), hash_bits)
            ends = pa.array(np.cumsum([0, *map(len, got["hashes"])]), pa.int32())
            flat = pa.array(np.array([h for own in got["hashes"] for h in own], np.uint64).view(np.int64))
            made = [pa.array(got[c].astype(np.int64)) for c in counts] + [pa.ListArray.from_arrays(ends, flat), pa.array(got["key"].view(np.int64))]
            body = [column(batch, "body")] if with_text else []
            yield pa.RecordBatch.from_arrays([column(batch, n) for n in names] + made + body, names=[*names, *counts, "hashes", "key", *["body"] * with_text])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kinds}, {', '.join(f'{c} long' for c in counts)}, hashes array<long>, key long" + ", body string" * with_text)


def refine(rows: DataFrame) -> DataFrame:
    """(key): the classes of two rows or more when rows (n_chars, hashes, key) are split by length, then by each block's hash.

    A class that is one row after a split drops out. The rows that went through
    all their blocks end with their key; longer ones go on.
    """
    ended, now, depth = None, rows.select("n_chars", "hashes", "key", F.col("n_chars").alias("cls")), 0
    scratch = []
    while True:
        # Written first, so that both sides of the join are plain exchanges and a class of very many rows can be split.
        split = materialize(now.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select("cls"), "refined")
        left = materialize(now.join(split, "cls", "left_semi"), "refine")
        scratch += [split, left]
        over = left.where(F.size("hashes") <= depth).select("key")
        ended = over if ended is None else ended.unionByName(over)
        going = left.where(F.size("hashes") > depth)
        if going.isEmpty():
            break
        now = going.withColumn("cls", F.xxhash64("cls", F.get("hashes", F.lit(depth))))
        depth += 1
    out = materialize(ended.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "classes")
    release(*scratch)
    return out


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.stack([mix(keys.view(U64) + U64(k)) & U64(bits - 1) for k in (1, 2)]).astype(np.int64)


def key_filter(classes: DataFrame) -> np.ndarray:
    """A bit array of the classes' keys, of bounded size for any number of them; with very many, more rows of no class pass."""
    bits = max(1 << 16, min(FILTER_BITS, 1 << (16 * classes.count()).bit_length()))

    def slots(batches):
        for batch in batches:
            at = np.unique(_slots(column(batch, "key").to_numpy(), bits))
            word, begin = np.unique(at >> 6, return_index=True)
            mask = np.bitwise_or.reduceat(np.left_shift(U64(1), (at & 63).astype(U64)), begin) if len(at) else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], names=["word", "mask"])

    table = np.zeros(bits >> 6, U64)
    for r in classes.mapInArrow(slots, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        table[r.word] = r.mask & ((1 << 64) - 1)
    return table


def first_ids(docs: DataFrame, classes: DataFrame, id: str = "doc_id", text: str = "text", hash_bits: int = 64) -> DataFrame:
    """(key, body, first, n): each text of the classes, compared in full, its smallest id and how many rows have it. Rows of no class may be among them."""
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(classes))

    def pick(batches):
        table = shared.value
        for batch in batches:
            keys = text_features(column(batch, "body"), hash_bits)["key"]
            a, b = _slots(keys, len(table) << 6)
            ok = (table[a >> 6] >> (a & 63).astype(U64)) & (table[b >> 6] >> (b & 63).astype(U64)) & U64(1) == 1
            yield pa.RecordBatch.from_arrays([column(batch, "first"), column(batch, "body"), pa.array(keys.view(np.int64))], names=["first", "body", "key"]).filter(pa.array(ok))

    rows = docs.select(F.col(id).alias("first"), F.coalesce(text, F.lit("")).alias("body"))
    kind = rows.schema["first"].dataType.simpleString()
    return rows.mapInArrow(pick, f"first {kind}, body string, key long").groupBy("key", "body").agg(F.min("first").alias("first"), F.count("*").alias("n"))


def mark_duplicates(docs: DataFrame, columns: dict[str, Column | str], id: str = "doc_id", text: str = "text", hash_bits: int = 64) -> DataFrame:
    """scan()'s rows and duplicate: whether a row of smaller id has the very same text.

    Null text is empty. Rows of null id are no duplicates and make none; rows that
    repeat an id and a text are marked alike.
    """
    names = {unused(docs.select(text), "own_id"): id} | columns
    own = next(iter(names))
    rows = materialize(scan(docs, names, text, hash_bits=hash_bits), "features")
    classes = refine(rows)
    found = materialize(first_ids(docs, classes, id, text, hash_bits).where("n > 1"), "first-ids")
    release(classes)
    # Texts of one key that differ: a clash of hashes. Such keys' rows are told apart by their texts.
    keys = materialize(found.groupBy("key").agg(F.count("*").alias("texts"), F.min("first").alias("first")), "first-keys")
    later = F.coalesce(F.col(own) > F.col("first"), F.lit(False)).alias("duplicate")
    single = keys.where("texts = 1").select("key", "first")
    clash = keys.where("texts > 1").select("key")
    if clash.isEmpty():
        return rows.join(single, "key", "left").select(*columns, *SCANNED, later)
    alone = rows.join(clash, "key", "left_anti").join(single, "key", "left").select(*columns, *SCANNED, later)
    again = scan(docs, names, text, with_text=True, hash_bits=hash_bits).join(clash, "key", "left_semi")
    return alone.unionByName(again.join(found.select("key", "body", "first"), ["key", "body"], "left").select(*columns, *SCANNED, later))


SCANNED = ["n_chars", "n_words", "n_distinct", "n_upper", "n_signs"]


def interactions(rows: DataFrame, filters: dict[str, Column], part: Column, counts: dict[str, Column]) -> DataFrame:
    """What each filter removes in each order: a row for each part, filter_order and step.

    filters: one letter to the condition under which a row fails, six at most;
    null is no failure. part: null is the empty string. counts: name to a
    condition; <name>_lost counts the removed rows that meet it. All counts are
    long: kept, removed, redundant (fails, but removed earlier), unique_fails
    (fails this filter only), and shapley, what the filter removes in all orders
    together. Each part of rows has all its orders and steps; no rows, no parts.
    """
    letters = list(filters)
    if len(letters) > 6:
        raise ValueError("orders grow with the factorial: six filters at most")
    mask = sum((F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(filters.values())), F.lit(0))
    counted = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask"), *(F.coalesce(c, F.lit(False)).cast("long").alias(n) for n, c in counts.items()))
    counted = counted.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.sum(n).alias(n) for n in counts))
    steps = []
    for order in permutations(range(len(letters))):
        before = 0
        for step, k in enumerate(order, 1):
            steps.append((before, 1 << k, step, "".join(letters[j] for j in order)))
            before |= 1 << k
    table = F.array(*(F.struct(F.lit(b).alias("before"), F.lit(bit).alias("bit"), F.lit(s).alias("step"), F.lit(o).alias("filter_order")) for b, bit, s, o in steps))
    each = counted.select("*", F.inline(table))
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    orders = len(steps) // max(1, len(letters))

    def total(when: Column, what: str | Column = "n") -> Column:
        return F.sum(F.when(when, F.col(what) if isinstance(what, str) else what).otherwise(0)).cast("long")

    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        *(total(fails & ~earlier, n).alias(f"{n}_lost") for n in counts),
        # Of a row's failed filters each comes first in an equal share of the orders.
        total(fails, F.col("n") * F.lit(orders) / F.bit_count("mask")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", part: str = "lang", hash_bits: int = 64) -> DataFrame:
    """interactions() of five filters of texts: A under 100 words, B under 80 % distinct words, C over 10 % A-Z, D a sign of #$%&*|, E a duplicate of a smaller id.

    Null text is empty, null part the empty string. labels (id, quality, toxic): good
    is any row of the id with quality 1, toxic any with toxic 1; documents without
    labels are neither. Other columns are left out. No documents, no rows.
    """
    known = labels.groupBy(F.col(id).alias("label_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = mark_duplicates(docs, {"id": id, "part": part}, id, text, hash_bits)
    rows = rows.join(known, rows["id"] == known["label_id"], "left")
    return interactions(
        rows,
        {
            "A": F.col("n_words") < 100,
            "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
            "C": 100 * F.col("n_upper") > 10 * F.col("n_chars"),
            "D": F.col("n_signs") > 0,
            "E": F.col("duplicate"),
        },
        F.col("part"),
        {"good": F.col("good"), "toxic": F.col("toxic")},
    )
