"""Results are unchanged when tasks fail and are retried."""

import json
import os
import subprocess
import sys

import pyarrow.parquet as pq


def test_packing_and_row_index_survive_task_retries():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_job.py")], capture_output=True, text=True,
                         timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    assert "injected task failure" in out.stderr  # tasks really failed and were retried
    got = json.loads(out.stdout.strip().splitlines()[-1])
    rows = sorted(pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist(),
                  key=lambda r: r["doc_id"])
    stream = [ord(c) for r in rows for c in r["text"]]
    n = len(stream) // 300
    assert got["n"] == n and got["flat"] == stream[: n * 300]
    assert got["ranks"] == [[r["doc_id"], i] for i, r in enumerate(rows)]
