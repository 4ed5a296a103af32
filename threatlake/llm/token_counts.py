"""Token counts of a document's sections from one encoding of the whole document.

A document is encoded once; the tokens' byte lengths give their character spans
(the offset mapping), and an interval join of those sorted spans with the
sections' spans allocates every token to one section. A token that crosses a
boundary is allocated by a rule:

* "first": to the section that holds its first character;
* "most": to the section that holds most of its characters, the earlier on a tie.

Sections cover the document without gaps, so their counts add up to its tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import read_ranks, text_blocks
from .common import column

RULES = ("first", "most")


def line_starts(utf32: bytes) -> np.ndarray:
    """Where each line begins, in characters; a line holds its newline. Empty text is one section."""
    points = np.frombuffer(utf32, "<u4")
    starts = np.flatnonzero(points == 10) + 1
    starts = np.concatenate([[0], starts])
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(points) else starts


def token_spans(raw: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of tokens that lie end to end over the UTF-8 bytes.

    A token that begins or ends inside a character has that character in its span.
    """
    lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    chars = np.cumsum(lead)  # characters begun up to and with each byte
    end = np.cumsum(lengths)
    start = end - lengths
    return chars[start] - 1, chars[end - 1]


def allocate(start: np.ndarray, end: np.ndarray, sections: np.ndarray, n_chars: int, rule: str) -> np.ndarray:
    """The section of each token. sections: where each begins, ascending, the first at 0."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    first = np.searchsorted(sections, start, "right") - 1
    if rule == "first" or not len(start):
        return first
    last = np.searchsorted(sections, end - 1, "right") - 1
    out = first.copy()
    bounds = np.append(sections, n_chars)
    for t in np.flatnonzero(first != last).tolist():  # few tokens cross
        own = np.arange(first[t], last[t] + 1)
        held = np.minimum(bounds[own + 1], end[t]) - np.maximum(bounds[own], start[t])
        out[t] = own[int(np.argmax(held))]
    return out


def section_tokens(docs: DataFrame, ranks: str, pattern: str, rule: str = "first", doc_id: str = "doc_id", text: str = "text", sections=line_starts) -> DataFrame:
    """One row for each section: doc_id, section, start_char, n_chars, n_tokens, doc_tokens.

    `sections` tells from a text (UTF-32, little-endian) where sections begin;
    lines by default. Null or empty text is one section without tokens. Null or
    repeated doc_ids keep their rows; no documents, no rows; other columns
    are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    names = ["doc_id", "section", "start_char", "n_chars", "n_tokens", "doc_tokens"]

    def run(batches):
        import tiktoken

        coder = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        size = np.zeros(max(shared.value.values()) + 1, np.int64)
        for token, rank in shared.value.items():
            size[rank] = len(token)
        for batch in batches:
            ids, at, out = column(batch, "doc_id"), 0, []
            for texts in text_blocks(column(batch, "text")):
                for t in texts:
                    begins = sections(t.encode("utf-32-le"))
                    tokens = coder.encode_to_numpy(t, disallowed_special=()).astype(np.int64)
                    if len(tokens):
                        start, end = token_spans(t.encode(), size[tokens])
                        n = np.bincount(allocate(start, end, begins, len(t), rule), minlength=len(begins))
                    else:
                        n = np.zeros(len(begins), np.int64)
                    out.append((at, begins, np.diff(np.append(begins, len(t))), n, len(tokens)))
                    at += 1
                if out:
                    yield _batch(ids, out, names)
                    out = []

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in names[1:])])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _batch(ids: pa.Array, rows: list, names: list[str]) -> pa.RecordBatch:
    counts = [len(r[1]) for r in rows]
    doc = np.repeat([r[0] for r in rows], counts)
    section = np.concatenate([np.arange(c) for c in counts])
    begins, chars, n = (np.concatenate([r[k] for r in rows]) for k in (1, 2, 3))
    total = np.repeat([r[4] for r in rows], counts)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), *(pa.array(x.astype(np.int64)) for x in (section, begins, chars, n, total))], names=names)
