"""End-to-end preparation jobs.

``prepare_cpt``: corpus folder -> decoded, cleaned books -> tokens -> packed
sequences (Parquet) -> train/eval split -> manifest.
``prepare_sft``: chat JSONL -> rejects split off -> system injection,
rendering, tokenising, masking -> train/eval (Parquet, ``split=`` folders)
-> manifest.
Each returns a dict of output paths and the counts the jobs computed.
``sinks.open_run`` finds the data of the last complete run.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import chat as CH
from scriptorium.functions import tokens as K
from scriptorium.operators import chat as M
from scriptorium.operators import clean as C
from scriptorium.operators import long_books as LB
from scriptorium.operators import pack as P
from scriptorium.operators.batches import effective_batch
from scriptorium.operators import split as SP
from scriptorium.sources import corpus as CO
from scriptorium.sources import jsonl as J
from scriptorium.session import intermediates, materialize, ship_package
from scriptorium.sources import sinks


# Parameter names and defaults of both jobs (tokenizer,
# missing_start, strict_jsonl and require_assistant_last are our own).
@dataclass(frozen=True)
class CPTParams:
    max_seq_len: int = 2048
    batch_size: int = 2
    grad_accum: int = 4
    num_epochs: int = 3
    num_gpus: int = 2
    use_ddp: bool = True
    eval_split: float = 0.05
    seed: int = 42
    tokenizer: str = "bpe"          # "bpe" (default tokenizer file), "codepoints" or a file path
    missing_start: str = "empty"    # "keep" treats a text without START as all body
    piece_bytes: int = 0            # above 0, books are read and cleaned in ranges of this size

    def __post_init__(self):
        if self.max_seq_len <= 0 or self.batch_size <= 0 or self.grad_accum <= 0 or self.num_epochs <= 0:
            raise ValueError("sizes and counts must be positive")
        if not 0.0 <= self.eval_split < 1.0:
            raise ValueError("eval_split must be in [0, 1)")


@dataclass(frozen=True)
class SFTParams:
    max_seq_len: int = 1024
    batch_size: int = 2
    grad_accum: int = 8
    num_epochs: int = 3
    eval_split: float = 0.05
    seed: int = 42
    default_system_prompt: str = M.DEFAULT_SYSTEM_PROMPT
    tokenizer: str = "bpe"
    strict_jsonl: bool = True
    require_assistant_last: bool = False  # True drops conversations ending on another role

    def __post_init__(self):
        if self.max_seq_len <= 0 or self.batch_size <= 0 or self.grad_accum <= 0 or self.num_epochs <= 0:
            raise ValueError("sizes and counts must be positive")
        if not 0.0 <= self.eval_split < 1.0:
            raise ValueError("eval_split must be in [0, 1)")


def _encoder(tokenizer: str):
    if tokenizer == "codepoints":
        return K.codepoint_ids
    return K.bpe_encoder(None if tokenizer == "bpe" else tokenizer)


def prepare_cpt(spark: SparkSession, corpus_dir: str, output_dir: str, params: CPTParams = CPTParams()) -> dict:
    """Outputs go to a folder of this run; the manifest is written last and
    names it, so a job that ends early leaves nothing that :func:`open_run`
    finds. Intermediate folders of this job alone are deleted at its end."""
    ship_package(spark)
    with intermediates(spark):
        return _prepare_cpt(spark, corpus_dir, output_dir.rstrip("/"), params)


def _prepare_cpt(spark: SparkSession, corpus_dir: str, out: str, params: CPTParams) -> dict:
    run = sinks.staged_folder(out)
    # Book order is sorted first path; packing orders by it directly. All
    # counts are observed in the passes that do the work.
    scanned, cleaned_obs, packed_obs = Observation("files"), Observation("cleaned"), Observation("packed")
    if params.piece_bytes:
        cleaned, audit, found = _books_in_ranges(spark, corpus_dir, params)
    else:
        books, audit = CO.load_books(spark, corpus_dir, with_ord=False, observation=scanned)
        cleaned = C.clean_corpus(books, "text", "clean", params.missing_start).withColumnRenamed("first_path", "at")
    tokens = cleaned.select("at", "text", "clean", _encoder(params.tokenizer)(F.col("clean")).alias("input_ids")).observe(
        cleaned_obs, F.count(F.lit(1)).alias("books"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("raw_chars"),
        F.coalesce(F.sum(F.length("clean")), F.lit(0)).alias("clean_chars"),
        F.coalesce(F.sum(F.size("input_ids")), F.lit(0)).alias("total_tokens"))
    packed = P.pack_sequences(tokens.select("at", "input_ids"), params.max_seq_len, order_col="at")
    packed = packed.observe(packed_obs, F.count(F.lit(1)).alias("sequences"))
    packed_path = sinks.write_packed(packed, f"{run}/packed")
    packed = sinks.read_packed(spark, packed_path)
    split = SP.train_eval_split(packed, "seq_id", params.eval_split, params.seed)
    sinks.write_split(split, f"{run}/split")
    audit.write.mode("overwrite").json(f"{out}/rejected")
    n = packed_obs.get["sequences"]
    stats = {**cleaned_obs.get, **(found if params.piece_bytes else scanned.get)}
    counts = spark.createDataFrame([{
        "sequences": n, "tokens": n * params.max_seq_len, "discarded_tokens": stats["total_tokens"] - n * params.max_seq_len,
        **stats}], "sequences long, tokens long, discarded_tokens long, books long, raw_chars long, clean_chars long, "
                   "total_tokens long, files long, undecodable long")
    plan = P.plan_of_count(counts, params.batch_size, params.grad_accum, params.num_epochs, P.steps_per_second_for(params.use_ddp))
    by_split = spark.read.parquet(f"{run}/split").groupBy("split").count()
    result = {
        "packed": packed_path,
        "split": f"{run}/split",
        "counts": {r["split"]: r["count"] for r in by_split.collect()},
        "stats": stats,
        "plan": plan.first().asDict(),
    }
    batch = effective_batch(params.num_gpus, params.batch_size, params.grad_accum, params.use_ddp)
    man = sinks.dataset_manifest(counts, corpus_dir=corpus_dir, method="cpt", effective_batch=batch, **_flat(params))
    result["manifest"] = sinks.commit_manifest(man, out, run)
    return result


def _books_in_ranges(spark: SparkSession, corpus_dir: str, params: CPTParams) -> tuple[DataFrame, DataFrame, dict]:
    """``at, text, clean`` of the parts of all books, ``at`` sorting by book and
    part; the audit; and the counts that parts do not show. Only the text of
    the file that a name keeps goes on."""
    books = LB.clean_ranges(spark, corpus_dir, params.piece_bytes, params.missing_start)
    names = materialize(CO.resolve_names(books.paths), "range-names")
    if books.paths.isEmpty() and books.audit.isEmpty():
        raise FileNotFoundError(f"No .txt files found under {corpus_dir}")
    raw = books.probe.join(names, "path").agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    # a part's text stands for its cleaned form; raw characters come from the probe
    at = F.concat(F.col("first_path"), F.lit("\0"), F.lpad(F.col("part").cast("string"), 19, "0"))
    parts = books.parts.join(names, "path").select(at.alias("at"), F.lit("").alias("text"), F.col("text").alias("clean"))
    bad = books.audit.count()
    return parts, books.audit, {"books": names.count(), "raw_chars": raw, "files": books.paths.count() + bad, "undecodable": bad}


def build_sft(messages: DataFrame, params: SFTParams = SFTParams(), template: CH.ChatTemplate = CH.CHATML,
              key_col: str = "example_id") -> tuple[DataFrame, DataFrame]:
    """(examples with ``split``, rejects) from ``key_col, messages`` rows."""
    good, rejects = M.split_rejects(messages, require_assistant_last=params.require_assistant_last)
    tok = "codepoints" if params.tokenizer == "codepoints" else (
        K.default_tokenizer_file() if params.tokenizer == "bpe" else params.tokenizer)
    ex = M.sft_examples(good, params.max_seq_len, tok, template, params.default_system_prompt, keep=(key_col,))
    # The split depends only on the keys: find the threshold on them, then
    # label the examples with one comparison (no join back).
    threshold = SP.eval_threshold(good.select(key_col), key_col, params.eval_split, params.seed)
    ex = ex.withColumn("split", F.when(SP.is_eval(key_col, params.seed, threshold), "eval").otherwise("train"))
    return ex, rejects


def prepare_sft(spark: SparkSession, jsonl_path: str, output_dir: str, params: SFTParams = SFTParams()) -> dict:
    """As :func:`prepare_cpt`: staged outputs, the manifest last."""
    ship_package(spark)
    with intermediates(spark):
        return _prepare_sft(spark, jsonl_path, output_dir.rstrip("/"), params)


def _prepare_sft(spark: SparkSession, jsonl_path: str, out: str, params: SFTParams) -> dict:
    run = sinks.staged_folder(out)
    msgs = J.read_chat_jsonl(spark, jsonl_path, strict=params.strict_jsonl)
    ex, rejects = build_sft(msgs, params)
    written = Observation("examples")
    is_eval = F.col("split") == "eval"
    ex = ex.observe(written, F.count(F.lit(1)).alias("tokenized"), F.count_if(~is_eval).alias("train"), F.count_if(is_eval).alias("eval"))
    sinks.write_split(ex, f"{run}/examples")
    rejects.write.mode("overwrite").json(f"{out}/rejected")
    found = written.get
    counts = spark.createDataFrame([found], "tokenized long, train long, eval long")
    # this trainer runs on one GPU process
    batch = effective_batch(1, params.batch_size, params.grad_accum, use_ddp=False)
    man = sinks.dataset_manifest(counts, dataset=jsonl_path, method="sft", effective_batch=batch, **_flat(params))
    return {"examples": f"{run}/examples", "counts": found, "manifest": sinks.commit_manifest(man, out, run)}


def _flat(params) -> dict:
    return {k: v for k, v in asdict(params).items()}
