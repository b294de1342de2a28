"""What a worker keeps between tasks."""

import os
import subprocess
import sys

import pytest

_LIKE_A_TASK = """
import re
import pyarrow as pa
from evrange.llm.common import giving_back

def held():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", file.read()))) / 1024

def run(batches):
    kept = []
    for batch in batches:
        texts = [t + "!" for t in batch.column(0).to_pylist()]
        kept.append(texts[::50])      # keeps the top of the heap in use
        yield pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    kept = None

batches = lambda: (pa.RecordBatch.from_arrays([pa.array([str(i) * 150 for i in range(20_000)])], ["t"]) for _ in range(4))
before = held()
last = sum(b.num_rows for b in giving_back(run)(batches()))
print(last, held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="needs Linux")
def test_a_task_gives_its_memory_back():
    out = subprocess.run([sys.executable, "-c", _LIKE_A_TASK], capture_output=True, text=True,
                         env=os.environ, timeout=100)
    assert out.returncode == 0, out.stderr
    rows, held = out.stdout.split()
    assert int(rows) == 80_000 and float(held) < 90          # 159 if nothing is given back
