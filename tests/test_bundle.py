"""The splitter gives the objects that a JSON parser gives, whatever the ranges' ends cut through."""

from __future__ import annotations

import json
import random
import re

import pytest

from threatlake.sources import bundle, reference

TRICKY = ['a"b', "\\", "\\\\\"", "[{", "}]", "é日本", '"objects": [', "x" * 300, "\\u0041", "{\"a\": [1, {}]}", "\n\t"]


def made(seed, n, key="objects"):
    r = random.Random(seed)

    def value(depth=0):
        k = r.randrange(6)
        if k == 0 and depth < 3:
            return {r.choice(TRICKY): value(depth + 1) for _ in range(r.randrange(3))}
        if k == 1 and depth < 3:
            return [value(depth + 1) for _ in range(r.randrange(4))]
        return r.choice(TRICKY) if k < 4 else r.choice([1, None, True, 2.5])

    objects = [{"n": k, "v": value(), "w": value()} for k in range(n)]
    return objects, {"type": "bundle", "objects2": [{"no": 1}], "before": {"objects": [{"nested": 1}]}, key: objects, "after": [{"objects": 1}], "values2": [[{}]], "z": "\\"}


@pytest.mark.parametrize(("size", "indent", "ascii_only"), [(7, None, True), (64, None, False), (101, 2, True), (1 << 20, 1, False)])
def test_equals_the_parser(spark, tmp_path, size, indent, ascii_only):
    want = []
    paths = []
    for seed in range(2):
        objects, whole = made(seed, 3 if size < 10 else 25)
        path = tmp_path / f"b{seed}.json"
        path.write_text(json.dumps(whole, indent=indent, ensure_ascii=ascii_only))
        paths.append(str(path))
        want += [(str(path), o) for o in objects]
    got = bundle.split(spark, paths, "objects", range_bytes=size).orderBy("path", "position").collect()
    assert [(r.path, json.loads(r.object)) for r in got] == want


def test_empty_and_missing_lists(spark, tmp_path):
    for k, text in enumerate(('{"objects": []}', '{"other": [{"a": 1}]}', "{}", "")):
        (tmp_path / f"{k}.json").write_text(text)
        assert bundle.split(spark, [str(tmp_path / f"{k}.json")], "objects", 4).collect() == []


def test_every_cut_through_escapes():
    """Each place of a text of quotes and backslashes as a range's end."""
    whole = json.dumps({"objects": [{"a": '\\\\"\\"[{'}, {"b": "\\"}, {"c": "]}"}]}).encode()
    wanted = re.compile(rb'"objects"\s*:\s*\[\Z')
    for k in range(1, len(whole)):
        first, second = whole[:k], whole[k:]
        escaped = (len(first) - len(first.rstrip(b"\\"))) % 2 == 1
        inside, depth = bundle.effect(first, False)
        assert bundle.effect((b" " if escaped else second[:1]) + second[1:], inside)[1] + depth == 0
        one = bundle.cut(whole, 0, k, False, 0, wanted, False)
        last = [e for _, e in bundle.walk(first, 0, False, 0, wanted, None) if e in ("open", "other")]
        data = first + b" " + second[1:] if escaped else whole
        two = bundle.cut(data, k, len(second), inside, depth, wanted, bool(last) and last[-1] == "open")
        assert [x for _, x in one + two] == [x for _, x in bundle.cut(whole, 0, len(whole), False, 0, wanted, False)]


def test_reference_rows_are_those_of_whole_bundles(spark, tmp_path):
    attack = {"objects": [{"type": "attack-pattern", "name": f"n{k}", "revoked": k % 5 == 0, "external_references": [{"source_name": "mitre-attack", "external_id": f"T{1000 + k}"}], "kill_chain_phases": [{"kill_chain_name": "mitre-attack", "phase_name": "execution"}]} for k in range(200)]}
    galaxy = {"values": [{"value": f"Actor {k}", "uuid": None, "meta": {"country": "CN", "synonyms": [f"A{k}", "é"]}} for k in range(150)], "version": 1}
    for name, data in (("a", attack), ("g", galaxy)):
        (tmp_path / name).write_text(json.dumps(data))
    whole = {n: spark.createDataFrame([((tmp_path / n).read_text(),)], "body string") for n in "ag"}
    assert sorted(map(tuple, reference.split_techniques(spark, [str(tmp_path / "a")], range_bytes=900).collect())) == sorted(map(tuple, reference.techniques(whole["a"]).collect()))
    got = [tuple(r)[:4] for r in reference.split_actors(spark, [str(tmp_path / "g")], range_bytes=900).orderBy("load_ordinal").collect()]
    assert str(got) == str([tuple(r)[:4] for r in reference.actors(whole["g"]).orderBy("load_ordinal").collect()])
