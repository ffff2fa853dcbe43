"""End-to-end CPT and SFT jobs on fresh folders."""

import json
import os
import tempfile

from scriptorium.plans import jobs

BOOK = "hdr\n*** START OF THE PROJECT GUTENBERG EBOOK {n} ***\n{body}\n*** END OF THE PROJECT GUTENBERG EBOOK ***\nlicence"


def _tree(files):
    root = tempfile.mkdtemp(prefix="scriptorium-job-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return root


def test_prepare_cpt(spark):
    bodies = {"a": "alpha " * 30, "b": "beta\n" * 40, "c": "gamma"}
    root = _tree({f"{k}.txt": BOOK.format(n=k, body=v).encode() for k, v in bodies.items()} | {"bad.txt": b"\xff"})
    out = tempfile.mkdtemp(prefix="scriptorium-out-")
    p = jobs.CPTParams(max_seq_len=16, tokenizer="codepoints", eval_split=0.25)
    r = jobs.prepare_cpt(spark, root, out, p)
    stream = "".join(v.strip() for v in (bodies["a"], bodies["b"], bodies["c"]))
    n = len(stream) // 16
    rows = spark.read.parquet(r["packed"]).orderBy("seq_id").collect()
    assert len(rows) == n
    assert "".join(chr(x) for row in rows for x in row.input_ids) == stream[: n * 16]
    assert r["counts"]["eval"] == -(-n // 4) and sum(r["counts"].values()) == n
    assert r["stats"]["books"] == 3
    assert r["stats"]["files"] == 4 and r["stats"]["undecodable"] == 1
    assert spark.read.json(f"{out}/rejected").count() == 1
    man = spark.read.json(r["manifest"]).first()
    assert man.sequences == n and man.method == "cpt" and man.max_seq_len == 16


def test_prepare_sft(spark):
    lines = [json.dumps({"messages": [{"role": "user", "content": f"q{i}"}, {"role": "assistant", "content": f"a{i}"}]})
             for i in range(20)]
    lines.append(json.dumps({"messages": []}))
    root = tempfile.mkdtemp(prefix="scriptorium-sft-")
    path = os.path.join(root, "chat.jsonl")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n\n")
    out = tempfile.mkdtemp(prefix="scriptorium-sft-out-")
    r = jobs.prepare_sft(spark, path, out, jobs.SFTParams(max_seq_len=64, eval_split=0.1))
    assert r["counts"] == {"tokenized": 20, "train": 18, "eval": 2}
    ex = spark.read.parquet(r["examples"])
    for row in ex.collect():
        assert len(row.input_ids) == len(row.labels) == len(row.attention_mask) <= 64
        assert row.labels[: row.prompt_len] == [-100] * min(row.prompt_len, len(row.labels))
    assert spark.read.json(f"{out}/rejected").count() == 1


def test_cli_cpt(spark, capsys):
    from scriptorium.__main__ import main
    root = _tree({"a.txt": BOOK.format(n="a", body="word " * 50).encode()})
    out = tempfile.mkdtemp(prefix="scriptorium-cli-")
    main(["cpt", "--corpus", root, "--out", out, "--max-seq-len", "32", "--tokenizer", "codepoints",
          "--use-ddp", "false"])
    printed = json.loads(capsys.readouterr().out)
    assert printed["plan"]["sequences"] == len(("word " * 50).strip()) // 32
    assert os.path.isdir(printed["packed"])
