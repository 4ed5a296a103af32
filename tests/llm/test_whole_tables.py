"""The registered queries over the whole of a test table, against plain versions."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from threatlake.llm import bpe, queries

from . import brute

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def coder(name):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path(name)), special_tokens={})


def test_pack(spark, texts):
    tokenizer, want, ends = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}, []
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        ends.append(len(ids))
        for s in range(0, len(ids), 2048):
            want[i, s] = len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids)
    rows = queries.op4_pack(spark, FOLDER).collect()
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in rows} == want and len(rows) == len(want)
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 2048
    assert len(at) == sum(n // 2048 for n in ends) + len(brute.best_fit([n % 2048 for n in ends if n % 2048], 2048))


def test_quality_counts(spark, texts):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in queries.op5_quality(spark, FOLDER).collect()}
    assert got == {i: brute.quality(t) for i, t in texts}


def test_simhash(spark, texts):
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, FOLDER).collect())
    assert got == sorted((i, f"{f:016x}", c) for i, f, c in brute.near(texts, 3, 3))


def test_token_counts(spark, texts):
    got, c = {}, coder("byte_bpe_50k.tiktoken")
    for r in queries.op8_token_counts(spark, FOLDER).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.n_chars, r.n_tokens, r.doc_tokens))
    for i, t in texts:
        t = t or ""
        ids = c.encode_ordinary(t)
        chars = [0, *accumulate((b & 0xC0) != 0x80 for b in t.encode())]
        starts = [0, *(k + 1 for k, x in enumerate(t) if x == "\n" and k + 1 < len(t))]
        ends, n, at = [*starts[1:], len(t)], [0] * len(starts), 0
        for size in map(len, c.decode_tokens_bytes(ids)):
            # A token begins with the character of its first byte, whole or not.
            a, b, at = chars[at + 1] - 1, chars[at + size], at + size
            held = [max(0, min(b, e) - max(a, s)) for s, e in zip(starts, ends, strict=True)]
            n[held.index(max(held))] += 1
        assert sorted(got.pop(i)) == [(k, s, e - s, m, len(ids)) for k, (s, e, m) in enumerate(zip(starts, ends, n, strict=True))]
    assert not got


def test_bpe(spark, texts):
    c = coder("byte_bpe_multi_50k.tiktoken")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op9_bpe(spark, FOLDER).collect()}
    want = {i: c.encode_ordinary(t or "") for i, t in texts}
    assert got == {i: (len(want[i]), brute.sha(",".join(map(str, want[i]))), brute.sha(t or "")) for i, t in texts}
