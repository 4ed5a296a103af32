"""What a Python worker keeps between tasks."""

from __future__ import annotations

import subprocess
import sys

KEPT = """
import random, re
import numpy as np, pyarrow as pa
from pyspark.sql import types as T
from threatlake.llm import quality

class Docs:  # stands for a DataFrame, so that the task's function can be run here
    schema = T.StructType().add("doc_id", "long").add("text", "string")
    sparkSession = sparkContext = property(lambda self: self)
    def broadcast(self, value):
        self.value = value
        return self
    def mapInArrow(self, run, schema):
        return run

def own():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

quality.NEW = T.StructType([T.StructField(c.split()[0], T.LongType()) for c in quality.NEW.split(", ")])  # its string needs a session
r = random.Random(1)
words = ["".join(r.choices("abcdefgh", k=6)) for _ in range(5000)]
texts = [" ".join(r.choices(words, k=500)) for _ in range(2000)]
batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array(texts)], names=["doc_id", "text"])
run = quality.judge(Docs(), quality.Model(np.ones(len(quality.GROUPS) << quality.BITS, np.float32), 0.0))
before = own()
rows = sum(b.num_rows for b in run(iter([batch])))
print(rows, own() - before)
"""


def test_a_worker_gives_back_what_scoring_took():
    """7 MB of text: a worker keeps the hashes' tables (32 MB), not the blocks' arrays."""
    rows, kept = subprocess.run([sys.executable, "-c", KEPT], capture_output=True, text=True, check=True).stdout.split()
    assert int(rows) == 2000
    assert float(kept) < 50
