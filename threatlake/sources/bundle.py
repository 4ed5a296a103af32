"""Large JSON bundles as many tasks: byte ranges cut into the objects of one list by bracket depth.

A bundle is one JSON object that has, among others, a key whose value is a list of
objects. Its bytes are dealt to ranges. A first pass gives each range's effect on a
reader's state, whether a string is open and the bracket depth; added up in order
they tell the state in which every range begins. A second one tells likewise where the
wanted list is open, the third cuts the objects that begin in a range, which reads on
past its end until its last object is whole. Memory follows the range and the
largest object, not the bundle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

RANGE_BYTES = 8 << 20
#: What can change the state: quotes, escapes, brackets.
_MARK = re.compile(rb'\\.|["{}\[\]]', re.S)
_OPEN, _CLOSE = b"{[", b"}]"


def effect(data: bytes, inside: bool) -> tuple[bool, int]:
    """Whether a string is open after the bytes, and by how much they change the depth, if one was open before or not."""
    depth = 0
    for m in _MARK.finditer(data):
        c = m[0]
        if c == b'"':
            inside = not inside
        elif not inside and len(c) == 1:
            depth += 1 if c in _OPEN else -1
    return inside, depth


#: Bytes before a list's bracket in which its key is looked for.
KEY_BYTES = 256


def walk(data: bytes, skip: int, inside: bool, depth: int, key: re.Pattern, in_list: bool | None) -> Iterator[tuple[int, str]]:
    """(place, event) of data[skip:]: the wanted list opens or closes, an object in it begins or ends. in_list: None if that isn't known yet."""
    for m in _MARK.finditer(data, skip):
        c, at = m[0], m.start()
        if c == b'"':
            inside = not inside
        elif inside or len(c) == 2:
            continue
        elif c in _OPEN:
            depth += 1
            if depth == 2:
                in_list = c == b"[" and key.search(data[max(0, at - KEY_BYTES) : at + 1]) is not None
                yield at, "open" if in_list else "other"
            elif depth == 3 and in_list and c == b"{":
                yield at, "begin"
        else:
            if depth == 3 and in_list and c == b"}":
                yield at, "end"
            depth -= 1
            if depth == 1:
                in_list = False
                yield at, "other"


def cut(data: bytes, skip: int, length: int, inside: bool, depth: int, key: re.Pattern, in_list: bool) -> list[tuple[int, bytes]] | None:
    """(place, bytes) of each object that begins in data[skip : skip + length]; None if data ends before the last of them."""
    out, start = [], None
    for at, event in walk(data, skip, inside, depth, key, in_list):
        if event == "begin":
            start = at
        elif event == "end" and start is not None:
            out.append((start, data[start : at + 1]))
            start = None
        if start is None and at >= skip + length:
            break
        if start is not None and start >= skip + length:
            return out
    return out if start is None else None


class File:
    """Reads of a bundle where a task runs."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.at = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.size = self.fs.get_file_info(self.at).size

    def read(self, begin: int, end: int) -> bytes:
        begin, end = max(0, begin), min(end, self.size)
        with self.fs.open_input_file(self.at) as f:
            return f.read_at(end - begin, begin)

    def range(self, offset: int, end: int) -> tuple[bytes, int]:
        """The bytes with KEY_BYTES before them, and where they begin there; a first byte that is escaped is blanked."""
        begin, n = max(0, offset - KEY_BYTES), KEY_BYTES
        data = self.read(begin, end)
        skip = offset - begin
        while not (before := self.read(offset - n, offset)).strip(b"\\") and n < offset:
            n *= 2
        if (len(before) - len(before.rstrip(b"\\"))) % 2:
            data = data[:skip] + b" " + data[skip + 1 :]
        return data, skip


def split(spark: SparkSession, paths: list[str], key: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, position, object): every object of the list `key` in each bundle, position being its first byte's place.

    Bundles are read through Arrow's file systems, each range where its task runs. An empty or missing list has no objects.
    """
    ranges = [(p, k, min(k + range_bytes, size)) for p, size in ((p, File(p).size) for p in paths) for k in range(0, size, range_bytes)]
    if not ranges:
        return spark.createDataFrame([], "path string, position long, object string")
    wanted = re.compile(rb'"' + re.escape(key.encode()) + rb'"\s*:\s*\[\Z')

    def told(rows: list[tuple], schema: str, fn, out: str) -> list:
        """fn of each range, as a row for each: some tens for a bundle."""

        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    yield pa.RecordBatch.from_pylist([{"path": r["path"], "offset": r["offset"]} | fn(**r)], schema=batches_schema)

        batches_schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), *out_fields[out]])
        return spark.createDataFrame(rows, schema).repartition(len(rows), "path", "offset").mapInArrow(run, f"path string, offset long, {out}").orderBy("path", "offset").collect()

    effects = "closed_in boolean, closed_by long, open_in boolean, open_by long"
    out_fields = {effects: [("closed_in", pa.bool_()), ("closed_by", pa.int64()), ("open_in", pa.bool_()), ("open_by", pa.int64())], "last string": [("last", pa.string())]}

    def measure(path: str, offset: int, end: int) -> dict:
        data, skip = File(path).range(offset, end)
        closed, opened = effect(data[skip:], False), effect(data[skip:], True)
        return {"closed_in": closed[0], "closed_by": closed[1], "open_in": opened[0], "open_by": opened[1]}

    def last_list(path: str, offset: int, end: int, inside: bool, depth: int) -> dict:
        data, skip = File(path).range(offset, end)
        found = [event for _, event in walk(data, skip, inside, depth, wanted, None) if event in ("open", "other")]
        return {"last": found[-1] if found else None}

    states, at, inside, depth = [], None, False, 0
    for r, (_, _, end) in zip(told(ranges, "path string, offset long, end long", measure, effects), sorted(ranges), strict=True):
        if r.path != at:
            at, inside, depth = r.path, False, 0
        states.append((r.path, r.offset, end, inside, depth))
        inside, by = (r.open_in, r.open_by) if inside else (r.closed_in, r.closed_by)
        depth += by
    begins, at, in_list = [], None, False
    for r, state in zip(told(states, "path string, offset long, end long, inside boolean, depth long", last_list, "last string"), states, strict=True):
        if r.path != at:
            at, in_list = r.path, False
        begins.append((*state, in_list))
        in_list = in_list if r.last is None else r.last == "open"

    def objects(batches):
        for batch in batches:
            for r in batch.to_pylist():
                file, more, found = File(r["path"]), 1 << 16, None
                while found is None:
                    data, skip = file.range(r["offset"], r["end"] + more)
                    found = cut(data, skip, r["end"] - r["offset"], r["inside"], r["depth"], wanted, r["in_list"])
                    if found is None and r["end"] + more >= file.size:
                        raise ValueError(f"{r['path']} ends inside an object")
                    more *= 4
                shift = r["offset"] - skip
                for lo in range(0, len(found), 1000):
                    part = found[lo : lo + 1000]
                    yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(part)), pa.array([shift + k for k, _ in part], pa.int64()), pa.array([x.decode("utf-8", "replace") for _, x in part], pa.string())], names=["path", "position", "object"])

    rows = spark.createDataFrame(begins, "path string, offset long, end long, inside boolean, depth long, in_list boolean").repartition(len(begins), "path", "offset")
    return rows.mapInArrow(objects, "path string, position long, object string")
