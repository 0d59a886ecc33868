import subprocess
import sys
from pathlib import Path

import pytest

from newscov.llm.common import freeing

# in a process of its own, as a worker is: small arrays, and one behind them that stays
HELD = """
import sys
import numpy as np
from newscov.llm.common import freeing

kept = []

def task(batches):
    rows = [np.ones(512) for _ in range(50_000)]
    kept.append(np.ones(512))
    for batch in batches:
        yield len(rows) + batch

def resident():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

before = resident()
run = freeing(task) if sys.argv[1] == "freeing" else task
assert list(run(iter([0]))) == [50_000]
print(resident() - before)
"""


def held(how):
    root = Path(__file__).resolve().parents[2]
    return int(subprocess.run([sys.executable, "-c", HELD, how], cwd=root, capture_output=True, text=True, check=True, timeout=120).stdout)


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_task_hands_its_memory_back():
    assert held("plain") > 100
    assert held("freeing") < 50


def test_a_task_that_is_stopped_ends_as_well():
    ended = []

    def task(batches):
        try:
            yield from batches
        finally:
            ended.append(True)

    run = freeing(task)(iter([1, 2]))
    assert next(run) == 1
    run.close()
    assert ended == [True]
