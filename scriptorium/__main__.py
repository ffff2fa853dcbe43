"""Command line for the two preparation jobs.

    spark-submit -m scriptorium cpt --corpus DIR --out DIR [--max-seq-len 2048 ...]
    spark-submit -m scriptorium sft --jsonl PATH --out DIR [--max-seq-len 1024 ...]

Parameters are the fields of ``CPTParams`` / ``SFTParams``; the session is
whatever ``spark-submit`` (or a local default) provides.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from scriptorium.plans import jobs


def _add_params(parser: argparse.ArgumentParser, cls) -> None:
    for f in dataclasses.fields(cls):
        flag = "--" + f.name.replace("_", "-")
        if f.type in ("bool", bool):
            parser.add_argument(flag, type=lambda v: v.lower() in ("1", "true", "yes"), default=f.default)
        else:
            kind = {"int": int, "float": float}.get(str(f.type), str)
            parser.add_argument(flag, type=kind, default=f.default)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="scriptorium")
    sub = ap.add_subparsers(dest="cmd", required=True)
    cpt = sub.add_parser("cpt", help="corpus folder -> packed sequences")
    cpt.add_argument("--corpus", required=True)
    cpt.add_argument("--out", required=True)
    _add_params(cpt, jobs.CPTParams)
    sft = sub.add_parser("sft", help="chat JSONL -> masked train/eval examples")
    sft.add_argument("--jsonl", required=True)
    sft.add_argument("--out", required=True)
    _add_params(sft, jobs.SFTParams)
    args = vars(ap.parse_args(argv))
    cmd = args.pop("cmd")
    spark = SparkSession.builder.appName(f"scriptorium-{cmd}").getOrCreate()
    if cmd == "cpt":
        corpus, out = args.pop("corpus"), args.pop("out")
        result = jobs.prepare_cpt(spark, corpus, out, jobs.CPTParams(**args))
    else:
        path, out = args.pop("jsonl"), args.pop("out")
        result = jobs.prepare_sft(spark, path, out, jobs.SFTParams(**args))
    print(json.dumps(result, default=str, indent=2))


if __name__ == "__main__":
    main()
