"""Quality, licences, tokens, packing and formatting."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threatlake.llm import bpe, chat_format, licenses, packing, quality, token_counts

from . import brute

MULTI, JSON, RANKS = (public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def coder(path):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def fuzz(seed, n):
    r = random.Random(seed)
    letters = "ab \n\tééa日本aaab  \x1c\xa0😀́'sT1_"
    return ["".join(r.choices(letters, k=r.randint(0, 120))) for _ in range(n)] + ["a" * 3000, "ab" * 2000, " " * 500 + "x", "".join(chr(r.randint(1, 0xD7FF)) for _ in range(2000))]


@pytest.mark.parametrize("path", [MULTI, RANKS])
def test_merge_replay_equals_tiktoken(path):
    want, codec = coder(path), bpe.Codec(bpe.Vocabulary(bpe.read_ranks(path), public_tokenizers.PATTERN))
    texts = fuzz(1, 1500)
    for _ in range(2):  # the second time from kept pieces
        for t, ids in zip(texts, codec.encode(texts), strict=True):
            assert ids.tolist() == want.encode_ordinary(t)
            assert codec.decode(ids.tolist()) == t.encode()


def test_long_texts_in_slices(monkeypatch):
    text = " ".join(fuzz(7, 300)) + " " * 50 + "z" * 3000
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 100)
    codec = bpe.Codec(bpe.Vocabulary(bpe.read_ranks(MULTI), public_tokenizers.PATTERN))
    assert codec.encode([text])[0].tolist() == coder(MULTI).encode_ordinary(text)
    assert len(bpe.slices(text, 100)) > 50

    from threatlake.llm import kernel

    raw = ("# w1 w2 w3 w4 w5 " * 3000 + "x" * 9000).encode()
    buffer, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    words = kernel.find_words(buffer, offsets)
    model = quality.Model(np.random.default_rng(1).normal(size=len(quality.GROUPS) << quality.BITS).astype(np.float32), 0.0)
    whole = kernel.range_hash(buffer, words.start, words.end), model.logit(buffer, offsets, words)
    for module in (kernel, quality):
        monkeypatch.setattr(module, "BLOCK_BYTES", 1000)
    assert (kernel.range_hash(buffer, words.start, words.end) == whole[0]).all()
    assert model.logit(buffer, offsets, words) == pytest.approx(whole[1])


def test_encode_and_decode(docs, odd):
    want = coder(MULTI)
    out = bpe.decode(bpe.encode(docs(odd, clash=True), MULTI, public_tokenizers.PATTERN, name="ids"), MULTI)
    rows = out.select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(odd)
    for r in rows:
        assert r.ids == want.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    trip = bpe.round_trip(docs(odd), MULTI, public_tokenizers.PATTERN).collect()
    assert all(r.decoded_sha256 == brute.sha(r.text or "") and r.n_tokens == len(want.encode_ordinary(r.text or "")) for r in trip)
    assert bpe.round_trip(docs([]), MULTI, public_tokenizers.PATTERN).count() == 0


def test_plan_is_best_fit_decreasing():
    r = random.Random(5)
    for _ in range(300):
        capacity = r.choice([7, 16, 50])
        lengths = [r.randint(1, capacity - 1) for _ in range(r.randint(0, 120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs, windows = packing.plan(counts, capacity)
        used, seen = [0] * windows, dict.fromkeys(counts, 0)
        for run in runs:
            assert run.first == seen[run.length]
            seen[run.length] += run.count
            for k in range(run.count):
                w = run.window + k // run.each
                assert used[w] == run.offset + k % run.each * run.length
                used[w] += run.length
        assert seen == counts and sorted(capacity - u for u in used) == brute.best_fit(lengths, capacity)


def test_pack(docs, odd):
    texts = odd + [(100 + k, "word " * k) for k in range(0, 90, 3)] + [(500, "long text here " * 200)] * 2
    texts += [(600, "<|endoftext|>"), (601, "a <|endoftext|> b<|endoftext|><|endoftext|>c"), (602, "<|endoftext |> <|endoftext"), (603, "x " * 90_000)]
    tokenizer = Tokenizer.from_file(JSON)
    rows = packing.pack(docs(texts, clash=True), JSON, public_tokenizers.PATTERN, 1, 64).collect()
    sequences, parts = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
        parts.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for own in sequences.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= 64 and {x[2] for x in own} == {at if at & (at - 1) == 0 else 64}
    want = {}
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault((i, len(ids)), []).extend((s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for s in range(0, len(ids), 64))
    assert {k: sorted(v) for k, v in parts.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(docs([]), JSON, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(docs, odd, rule):
    rows = odd + list(enumerate(fuzz(2, 60), 1000))
    got = {}
    for r in token_counts.section_tokens(docs(rows), RANKS, public_tokenizers.PATTERN, rule).collect():
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.section, r.start_char, r.n_chars, r.n_tokens))
    want, c = {}, coder(RANKS)
    for i, t in rows:
        t = t or ""
        ids = c.encode_ordinary(t)
        starts = [0] + [k + 1 for k, x in enumerate(t) if x == "\n" and k + 1 < len(t)]
        ends, n, at = [*starts[1:], len(t)], [0] * len(starts), 0
        raw = t.encode()
        for token in (c.decode_single_token_bytes(x) for x in ids):
            a = len(raw[: at + 1].decode("utf-8", "ignore").encode()) and sum((b & 0xC0) != 0x80 for b in raw[: at + 1]) - 1
            a = sum((b & 0xC0) != 0x80 for b in raw[: at + 1]) - 1
            b = sum((x & 0xC0) != 0x80 for x in raw[: at + len(token)])
            at += len(token)
            held = [max(0, min(b, ends[k]) - max(a, starts[k])) for k in range(len(starts))]
            n[next(k for k in range(len(starts)) if starts[k] <= a < ends[k]) if rule == "first" else held.index(max(held))] += 1
        want.setdefault((i, len(ids)), []).extend(zip(range(len(starts)), starts, [e - s for s, e in zip(starts, ends, strict=True)], n, strict=True))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_quality_counts(docs, odd):
    rows = odd + [(50, "a b c d e\na b c d e\n # x"), (51, "| & <>\n\n\n#"), (52, "p q r s t u p q r s t u v w x y z")]
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs(rows, clash=True), None).collect()), key=str)
    assert got == sorted(((i, *brute.quality(t)) for i, t in rows), key=str)
    assert quality.judge(docs([]), None).count() == 0


def test_quality_model_on_held_out_rows(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    # By a hash of the text, so that copies of a text are on one side.
    even = d.select("doc_id", (F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("even"))
    train, test = (lab.join(even.where(side), "doc_id").drop("even") for side in ("even", "not even"))
    model = quality.train(d, train)
    got = quality.judge(d, model).join(test.select("doc_id", "quality"), "doc_id").select("quality", "base_failed", "p_good", "kept").collect()
    good, bad = [r for r in got if r.quality == 1 and not r.base_failed], [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) / len(good) > 0.995
    assert sum(r.kept for r in bad) / len(bad) < 0.03
    assert quality.train(d, lab.where("quality = 1")) is None and quality.train(d, lab.where("false")) is None
    sure = np.array([[r.p_good, r.quality] for r in got if not r.base_failed])
    assert abs(sure[:, 0].mean() - sure[:, 1].mean()) < 0.03  # calibrated


def test_calibration_rows_have_no_near_copies_among_fitted_rows():
    r = np.random.default_rng(4)
    pair = quality.GROUPS.index(("word", 2)) << quality.BITS
    base = [np.unique(r.integers(0, 1 << quality.BITS, 200)) + pair for _ in range(60)]
    slots = [np.unique(np.concatenate([b[r.random(len(b)) > 0.03], r.integers(0, 1 << quality.BITS, 3) + pair])) for b in base for _ in range(r.integers(1, 5))] + [np.zeros(0, np.int64)] * 2
    first = np.array([min((k for k in range(j + 1) if len(np.intersect1d(slots[k], s)) * 2 > len(s)), default=j) for j, s in enumerate(slots)])
    first[-2:] = len(slots) - 2  # rows without pairs are alike
    assert (quality.near_groups(slots) == first).all()
    labels = first % 2
    out = quality.held_out_rows(slots, labels)
    assert not set(first[out]) & set(first[~out])
    for label in (0, 1):
        assert 0.15 < out[labels == label].mean() <= 0.25
    labels[-1] = 1 - labels[-2]
    assert not quality.held_out_rows(slots, labels)[-2:].any()  # labelled both ways


def test_licences(docs, odd):
    rows = [
        (1, "Some text.\nLicensed under the Apache License, Version 2.0.\nmore"), (2, "released under the mit license"), (3, "All rights reserved.\nReleased under the MIT License."),
        (4, "the license of the general public was released under rights"), (5, "Copyright 2021 The Authors. This program: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"), (6, "Licensed under CC BY-NC 4.0."), (7, "Licensed under CC BY-SA 4.0."),
    ]
    got = {r.doc_id: (r.families, r.permissive) for r in licenses.scan(docs(rows, clash=True)).collect()}
    assert got == {1: ("apache-2.0", True), 2: ("mit", True), 3: ("all-rights-reserved,mit", False), 4: ("", False), 5: ("gpl", False), 6: ("cc-by-nc", False), 7: ("cc-by-sa", False)}
    assert all(r.families == "" for r in licenses.scan(docs(odd)).collect())
    assert licenses.scan(docs([])).count() == 0


def test_licence_model_on_held_out_variants():
    model = licenses.train()
    texts, families = licenses._variants(99, 20)
    rows, slots = licenses._encoded(texts)
    keep = model.known[slots]
    p = model.score(rows[keep], slots[keep], len(texts))
    sure = (p.argmax(axis=1) > 0) & (p.max(axis=1) >= licenses.MIN_PROBABILITY)
    assert (sure & (np.array(families) == licenses.UNKNOWN)).sum() < 0.03 * sure.sum()
    right = np.array([model.families[k] for k in p.argmax(axis=1)]) == np.array(families)
    assert right.mean() > 0.97
    assert abs(p.max(axis=1).mean() - right.mean()) < 0.05


CONTROL = "</s>[INST] ok [/INST]"


def test_chat_round_trip(spark):
    texts = [CONTROL, "\\0 \\1 <|end|> \\", "", None, "[[<<\\2", "日本😀|>", "<|user|>x<|end|>"]
    rows = [(c, k, role, t) for c, role in ((1, "user"), (2, "assistant"), (3, "o<|d>|d\n"), (None, None)) for k, t in enumerate(texts)]
    rows += [(5, None, "user", "first"), (5, 1, "b", "y"), (5, 1, "b", "x"), (5, 1, "a", "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("lang", F.lit("x"))
    out = chat_format.format_conversations(chat_format.gather_rows(table))
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", chat_format.parse_turns(F.col("formatted")).alias("turns"), chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    for c, role in ((1, "user"), (2, "assistant"), (3, "o<|d>|d\n"), (None, "")):
        assert [(t.role, t.text) for t in got[c].turns] == [(role, t or "") for t in texts]
        assert got[c].loss == ("".join(t or "" for t in texts) if role == "assistant" else "")
        assert "</s>" not in got[c].formatted and "[INST]" not in got[c].formatted
    assert [t.text for t in got[5].turns] == ["first", "z", "x", "y"]
    assert chat_format.format_conversations(chat_format.gather_rows(table.limit(0))).count() == 0


def test_chat_layouts(spark):
    ask, say = ("user", "q"), ("assistant", "a")
    records = {
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}': [ask, say],
        '{"messages":[{"role":"user","content":"q","name":"x"},{"role":"assistant","content":"a"}],"id":7}': [ask, say],
        '{"id":1,"messages":[{"role":"user","content":[{"type":"text","text":"q"}]},{"role":"assistant","content":"a"}]}': [ask, say],
        '{"messages":[]}': [],
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}],"system":"s"}': [("system", "s"), ask, say],
        '{"prompt":"q","completion":"a","source":"web"}': [ask, say],
        '{"prompt":"q","response":"a","meta":{"n":[1,2.5],"odd name":null}}': [ask, say],
        '{"prompt":"q","chosen":"a","rejected":"b"}': [ask, say],
        '{"chosen":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"rejected":[]}': [ask, say],
        '{"instruction":"q","output":"a"}': [ask, say],
        '{"instruction":"q","input":"more","output":"a","lang":"en"}': [("user", "q\nmore"), say],
        '{"question":"q","answer":null}': [ask, ("assistant", "")],
        '{"rows":[{"turn":2,"role":"assistant","text":"a"},{"turn":1,"role":"user","text":"q"}]}': [ask, say],
        '{"prompt":"[1]","response":"<|x|>"}': [("user", "[1]"), ("assistant", "<|x|>")],
        '{"messages":["q"]}': None, '{"messages":[{"said":"q"}]}': None, '{"messages":[{"role":"user","content":"q"},"a"]}': None, '{"messages":"q"}': None, '{"prompt":"q"}': None, "[]": None, "no json": None,
    }
    table = spark.createDataFrame([(k, r, "own", "own") for k, r in enumerate([*records, None])], "conv_id long, record string, formatted string, turns string")
    turns = table.select("conv_id", chat_format.json_turns(F.col("record")).alias("t")).orderBy("conv_id").collect()
    assert [None if r.t is None else [tuple(x) for x in r.t] for r in turns] == [*records.values(), None]
    out = chat_format.format_json(table)
    read = out.orderBy("conv_id").select("layout", chat_format.parse_turns(F.col("formatted")).alias("t")).collect()
    assert [None if r.layout == "unmapped" else [tuple(x) for x in r.t] for r in read] == [*records.values(), None]
    assert sum(r.records for r in chat_format.unmapped(out).collect()) == 8
    assert chat_format.format_json(table.limit(0)).count() == 0  # the count above is of rows that no mapping fits


def test_typed_layouts_agree_with_json(spark):
    """The same record as columns, with more fields, content parts and columns named like the operator's own."""
    typed = [
        ("conv_id long, prompt string, response string, note string", (1, "q", "a", "n")),
        ("conv_id long, messages array<struct<content:string,name:string,role:string>>, formatted string, turns string, loss_spans string", (1, [("q", None, "user"), ("a", "x", "assistant")], "own", "own", "own")),
        ("conv_id long, messages array<struct<role:string,content:array<struct<type:string,text:string>>>>, meta struct<a:int>", (1, [("user", [("text", "q")]), ("model", [("text", "a"), ("text", None)])], (1,))),
        ("conv_id long, instruction string, output string", (1, "q", "a")),
        ("conv_id long, prompt string, chosen string, rejected string", (1, "q", "a", "b")),
    ]
    for schema, row in typed:
        table = spark.createDataFrame([row], schema)
        assert chat_format.format_conversations(table).first().formatted == "<|user|>q<|end|><|assistant|>a<|end|>"
        json = table.select("conv_id", F.to_json(F.struct(*[c for c in table.columns if c != "conv_id"])).alias("record"))
        assert chat_format.format_json(json).first().formatted == "<|user|>q<|end|><|assistant|>a<|end|>"
    assert chat_format.field_paths(spark.createDataFrame([], typed[2][0]).schema) == sorted(["conv_id", "messages", "messages[]", "messages[].role", "messages[].content", "messages[].content[]", "messages[].content[].text", "messages[].content[].type", "meta", "meta.a"])
    with pytest.raises(ValueError):
        chat_format.format_conversations(spark.createDataFrame([], "conv_id long, note string"))


PREFERENCES = [
    ('{"prompt": [{"role": "user", "content": "q"}], "chosen": [{"role": "assistant", "content": "a"}], "rejected": [{"role": "assistant", "content": "b"}]}', [("user", "q"), ("assistant", "a")]),
    ('{"prompt": "q", "chosen": [{"role": "assistant", "content": "a"}], "rejected": [{"role": "assistant", "content": "b"}]}', [("user", "q"), ("assistant", "a")]),
    ('{"prompt": "q", "chosen": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "rejected": []}', [("user", "q"), ("assistant", "a")]),
    ('{"prompt": "", "chosen": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "a"}]}', [("user", "x"), ("assistant", "a")]),
    ('{"chosen": [{"role": "user", "content": "x"}, {"role": "assistant", "content": "a"}]}', [("user", "x"), ("assistant", "a")]),
    ('{"prompt": [{"role": "system", "content": "s"}, {"role": "human", "content": "q"}], "chosen": [{"role": "gpt", "content": "a"}], "score": 1}', [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"prompt": "q", "chosen": "a", "rejected": "b"}', [("user", "q"), ("assistant", "a")]),
    ('{"instruction": "i", "response": "a"}', [("user", "i"), ("assistant", "a")]),
    ('{"instruction": "i", "input": "more", "response": "a"}', [("user", "i\nmore"), ("assistant", "a")]),
    ('{"instruction": "i", "input": "more", "output": "a"}', [("user", "i\nmore"), ("assistant", "a")]),
    ('{"query": "q", "response": "a"}', [("user", "q"), ("assistant", "a")]),
    ('{"input": "q", "output": "a"}', [("user", "q"), ("assistant", "a")]),
    ('{"conversation": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}', [("user", "q"), ("assistant", "a")]),
    ('{"conversation": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}', [("user", "q"), ("assistant", "a")]),
    ('{"conversations": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 7}', [("user", "q"), ("assistant", "a")]),
    ('{"system": "s", "conversations": [{"role": "user", "content": "q"}]}', [("system", "s"), ("user", "q")]),
]


def test_no_prompt_is_lost(spark):
    """Preference records keep their prompt, as a list or a text, once; further common layouts are mapped; typed rows agree."""
    table = spark.createDataFrame([(k, r) for k, (r, _) in enumerate(PREFERENCES)], "conv_id long, record string")
    want = {k: "".join(f"<|{role}|>{text}<|end|>" for role, text in turns) for k, (_, turns) in enumerate(PREFERENCES)}
    assert {r.conv_id: r.formatted for r in chat_format.format_json(table).collect()} == want
    for k, (record, turns) in enumerate(PREFERENCES):
        if "[]" in record or '""' in record:
            continue  # a type can't be told from an empty list
        typed = spark.read.json(spark.sparkContext.parallelize([record]))
        said = typed.select(chat_format.turns_of(typed.schema, F.col).alias("t")).first().t
        assert [(t.role, t.text) for t in said] == turns, k
