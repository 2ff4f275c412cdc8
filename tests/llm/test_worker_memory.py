"""What a Python worker holds while texts are read, and after: Spark keeps the worker for later stages."""

import os
import subprocess
import sys

import pytest

SCRIPT = """
import re, sys
import numpy as np, pyarrow as pa
from tabmill.llm import near_dedup, toxicity

def held():
    return sum(map(int, re.findall(r"Private_Dirty: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024

rng = np.random.default_rng(3)
texts = [" ".join(f"w{i:x}" for i in rng.integers(0, 1 << 30, 300)) for _ in range(8000)]
batch = pa.RecordBatch.from_arrays([pa.array(range(8000), pa.int64()), pa.array(texts)], ["doc_id", "text"])
given = batch.append_column("wanted", pa.array([[] for _ in texts], pa.list_(pa.struct([("mark", pa.binary()), ("id", pa.int64())]))))
learned = pa.table({"toxic": [i % 2 for i in range(600)], "key": [str(i) for i in range(600)], "doc_id": range(600), "text": texts[:600]})
del texts
runs = {
    "sketches": lambda: near_dedup._sketch_rows(5, 40)(iter([batch])),
    "sets": lambda: near_dedup._set_rows(5)(iter([given])),
    "learning": lambda: iter([toxicity._trained(0.5)(learned)]),
}
before = held()
most = max(held() for _ in runs[sys.argv[1]]()) - before
print(round(most), round(held() - before))
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory is read from Linux")
@pytest.mark.parametrize("run, limits", [("sketches", (42, 18)), ("sets", (42, 28)), ("learning", (40, 40))])
def test_workers_hand_memory_back(run, limits):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYTHONPATH": root, "OMP_NUM_THREADS": "1"}
    said = subprocess.run([sys.executable, "-c", SCRIPT, run], cwd=root, env=env, capture_output=True, text=True, check=True).stdout
    most, after = map(int, said.split())
    assert most <= limits[0] and after <= limits[1], said
