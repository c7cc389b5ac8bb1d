import subprocess
import sys
from pathlib import Path

import pyarrow as pa

from freshet.llm import words

#: A worker's memory, in MB, after a step has ended, less that before it.
WORKER = """
import random, re
import pyarrow as pa
from freshet.llm import setjoin

class Documents:
    def mapInArrow(self, run, schema):
        return run

def own():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024

run = setjoin._sets(Documents(), 5)
draw = random.Random(1)

def batches():
    for at in range(0, 8000, 500):
        texts = [" ".join(str(draw.randrange(10**6)) for _ in range(400)) for _ in range(500)]
        ids = pa.array(range(at, at + 500), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], ["key", "text", "sum"])

before = own()
for _ in run(batches()):
    pass
print(own() - before)
"""


def test_a_worker_that_is_done_gives_its_memory_back():
    done = subprocess.run([sys.executable, "-c", WORKER], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, timeout=120, check=True)
    assert int(done.stdout) < 64


def test_frugal_changes_no_batch(monkeypatch):
    given = []
    monkeypatch.setattr(words, "give_back", lambda: given.append(1))
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * n)], ["text"]) for n in (0, 3, 30_000, 30_000, 1)]
    assert list(words.frugal(lambda rows: (b.slice(0, 2) for b in rows))(iter(batches))) == [b.slice(0, 2) for b in batches]
    assert len(given) == 2
    assert list(words.frugal(lambda rows: rows)(iter(()))) == []
