"""Finding many names in texts in one pass: an Aho-Corasick automaton over words, leftmost and longest.

Texts and names are cut into units, a word (letters, numbers, underscores) or one
other character, so a name never matches inside a word. The automaton's root leads
on by a name's first unit and failure links by what is left after it; a unit costs
one look-up, however many names there are. Of the occurrences the leftmost counts,
of those that begin together the longest, and those that overlap it don't.

Names come in shards of bounded size; more shards are further passes in the same
task, which hand on what they found.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names that are sent to workers at once.
SHARD_NAMES = 200_000
_UNIT = re.compile(r"\w+|\W")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("key", pa.string())]))
SPANS = "array<struct<start:long,end:long,key:string>>"


@lru_cache(1 << 16)
def fold(unit: str) -> str:
    """A unit without case, character by character."""
    if unit.isascii():
        return unit.lower()
    return "".join(c.upper().lower() if len(c.upper()) == 1 else c.lower() for c in unit)


def units(text: str) -> list[str]:
    return [fold(u) for u in _UNIT.findall(text)]


def _word(unit: str) -> bool:
    return unit[0] == "_" or unit[0].isalnum()


class Automaton:
    def __init__(self, names: list[tuple[str, str]]):
        """names: (name, key); of names that are equal without case the first's key counts."""
        self.next: list[dict[str, int]] = [{}]
        self.key: list[str | None] = [None]
        self.depth = [0]
        for name, key in names:
            at = 0
            for u in units(name):
                to = self.next[at].get(u)
                if to is None:
                    to = self.next[at][u] = len(self.next)
                    self.next.append({})
                    self.key.append(None)
                    self.depth.append(self.depth[at] + 1)
                at = to
            if at and self.key[at] is None:
                self.key[at] = key
        self.fail, self.out = [0] * len(self.next), [0] * len(self.next)
        todo = deque(self.next[0].values())
        while todo:
            at = todo.popleft()
            for u, to in self.next[at].items():
                back = self.fail[at]
                while back and u not in self.next[back]:
                    back = self.fail[back]
                self.fail[to] = self.next[back].get(u, 0)
                todo.append(to)
            # The longest shorter name that ends here as well.
            self.out[at] = self.fail[at] if self.key[self.fail[at]] is not None else self.out[self.fail[at]]

    def all(self, text: str) -> list[tuple[int, int, str]]:
        """Every occurrence (first unit, end, key)."""
        said, found, at = units(text), [], 0
        step, fail = self.next, self.fail
        for k, u in enumerate(said):
            while at and u not in step[at]:
                at = fail[at]
            at = step[at].get(u, 0)
            hit = at if self.key[at] is not None else self.out[at]
            while hit:
                start = k + 1 - self.depth[hit]
                # A name that begins or ends with another character than a word's mustn't touch one there.
                if (_word(said[start]) or not start or not _word(said[start - 1])) and (_word(u) or k + 1 == len(said) or not _word(said[k + 1])):
                    found.append((start, k + 1, self.key[hit]))
                hit = self.out[hit]
        return found


def leftmost_longest(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out, end = [], 0
    for s, e, key in sorted(found, key=lambda x: (x[0], -x[1])):
        if s >= end:
            out.append((s, e, key))
            end = e
    return out


class _Shard:
    """Names that are sent to workers; each builds the automaton once."""

    def __init__(self, names: list[tuple[str, str]]):
        self.names, self.built = names, None

    def automaton(self) -> Automaton:
        if self.built is None:
            self.built = Automaton(self.names)
        return self.built


def find_names(documents: DataFrame, names: DataFrame, doc: str = "doc", text: str = "text", shard_names: int | None = None) -> DataFrame:
    """(doc, key): the keys of names (name, key) that stand in each document's text, case aside; null and empty texts and names have none."""
    named = names.where("name != ''").select("name", "key")
    shards = max(1, -(-named.count() // (shard_names or SHARD_NAMES)))
    rows = documents.select(F.col(doc).alias("doc"), F.col(text).alias("text"), F.array().cast(SPANS).alias("spans"))
    schema = T.StructType([rows.schema["doc"], T.StructField("text", T.StringType()), *T._parse_datatype_string(f"spans {SPANS}").fields])
    for g in range(shards):
        own = named if shards == 1 else named.where(F.pmod(F.xxhash64("name"), F.lit(shards)) == g)
        shared = documents.sparkSession.sparkContext.broadcast(_Shard([tuple(r) for r in own.orderBy("name").collect()]))
        rows = rows.mapInArrow(_look(shared, g == shards - 1), schema)
    return rows.select(F.col("doc").alias(doc), F.explode("spans.key").alias("key")).distinct()


def _look(shared, last: bool):
    def run(batches):
        automaton = shared.value.automaton()
        for batch in batches:
            out = []
            for text, before in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                spans = [(x["start"], x["end"], x["key"]) for x in before or ()] + (automaton.all(text) if text else [])
                out.append([{"start": s, "end": e, "key": k} for s, e, k in (leftmost_longest(spans) if last else spans)])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(out, _SPANS)], names=["doc", "text", "spans"])

    return run
