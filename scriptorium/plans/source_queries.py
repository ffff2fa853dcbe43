"""Source and sink queries.

The corpus queries run on a directory that Spark writes from ``documents``
(one ``.txt`` per distinct text and folder, under the checkpoint folder):
``<source>/<lang>/<first 12 hex of md5(text)>.txt``. Equal texts in
different folders share a book name, so the duplicate-name rule applies;
documents of ``src0`` are written in Latin-1, so those with non-ASCII
characters are undecodable and land in the audit table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.functions import tokens as K
from scriptorium.operators import clean as C
from scriptorium.operators import chat as M
from scriptorium.operators import long_books as LB
from scriptorium.plans import fixtures
from scriptorium.plans import oracle as O
from scriptorium.plans.registry import query
from scriptorium.plans.token_queries import SEQ_LEN
from scriptorium.session import scratch_path
from scriptorium.sources import corpus as CO
from scriptorium.sources import jsonl as J
from scriptorium.sources import sinks
from scriptorium.sources.tables import table

LATIN1_SOURCE = "src0"


def _rel_col():
    """One file per document; every tenth document shares its name with
    another one in a folder of its own, so the duplicate-name rule has work."""
    shared = F.concat("doc_id", F.lit("/shared-"), F.expr("doc_id div 20"))
    name = F.when(F.col("doc_id") % 10 == 0, shared).otherwise(F.concat(F.md5("text"), F.lit("-"), "doc_id"))
    return F.concat_ws("/", "source", "lang", F.concat(name, F.lit(".txt")))


_STEM_SQL = "CASE WHEN doc_id % 10 = 0 THEN 'shared-' || (doc_id // 20) ELSE md5(text) || '-' || doc_id END"
_REL_SQL = f"source || '/' || lang || '/' || CASE WHEN doc_id % 10 = 0 THEN doc_id || '/' ELSE '' END || {_STEM_SQL} || '.txt'"


def write_corpus(spark, data_dir):
    """Write the corpus directory for ``documents``; returns its root."""
    root = scratch_path(spark, "corpus")
    d = table(spark, data_dir, "documents")
    rows = d.select(_rel_col().alias("relpath"), "text",
                    F.when(F.col("source") == LATIN1_SOURCE, "latin-1").otherwise("utf-8").alias("encoding")
                    )
    sinks.write_text_files(rows, root, encoding_col="encoding").agg(F.count(F.lit(1))).collect()
    return root


def _rel(path_col, root):
    prefix = root.rstrip("/") + "/"
    return F.substring_index(path_col, prefix, -1)


_FILES = f"""
files AS (SELECT {_REL_SQL} AS rel, {_STEM_SQL} AS name, text,
                 NOT (source = '{LATIN1_SOURCE}' AND regexp_matches(text, '[^\\x{{00}}-\\x{{7f}}]')) AS ok,
                 CASE WHEN source = '{LATIN1_SOURCE}' THEN length(text) ELSE strlen(text) END AS n_bytes
          FROM documents),
books AS (SELECT name, min(rel) AS first_path, arg_max(text, rel) AS text FROM files WHERE ok GROUP BY name),
ordered AS (SELECT (row_number() OVER (ORDER BY first_path) - 1)::BIGINT AS ord, name, text FROM books)
"""


@query("corpus_scan", f"WITH {_FILES} SELECT rel, n_bytes::BIGINT AS n_bytes FROM files")
def corpus_scan(spark, data_dir):
    root = write_corpus(spark, data_dir)
    files, _ = CO.scan_corpus(spark, root)
    return files.select(_rel(F.col("path"), root).alias("rel"), F.col("length").alias("n_bytes"))


@query("corpus_decode_audit", f"WITH {_FILES} SELECT rel, 'invalid utf-8' AS reason FROM files WHERE NOT ok")
def corpus_decode_audit(spark, data_dir):
    root = write_corpus(spark, data_dir)
    files, _ = CO.scan_corpus(spark, root)
    _, audit = CO.decode_files(files)
    return audit.select(_rel(F.col("path"), root).alias("rel"), "reason")


@query("corpus_names", f"WITH {_FILES} SELECT rel, name FROM files WHERE ok")
def corpus_names(spark, data_dir):
    root = write_corpus(spark, data_dir)
    files, _ = CO.scan_corpus(spark, root)
    good, _ = CO.decode_files(files)
    return good.select(_rel(F.col("path"), root).alias("rel"), CO.book_name(F.col("path")).alias("name"))


@query("corpus_resolve_names", f"""
WITH {_FILES}
SELECT ord, name, length(text)::BIGINT AS n_chars, md5(text) AS text_md5 FROM ordered
""")
def corpus_resolve_names(spark, data_dir):
    books, _ = CO.load_books(spark, write_corpus(spark, data_dir))
    return books.select("ord", "name", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5"))


@query("corpus_load_stats", f"WITH {_FILES} SELECT name, length(text)::BIGINT AS n_chars FROM ordered")
def corpus_load_stats(spark, data_dir):
    books, _ = CO.load_books(spark, write_corpus(spark, data_dir), with_ord=False)
    return CO.load_stats(books)


@query("build_dataset", f"""
WITH {_FILES}
SELECT ord, name, md5(text) AS text_md5 FROM ordered
""")
def build_dataset(spark, data_dir):
    books, _ = CO.load_books(spark, write_corpus(spark, data_dir))
    return books.select("ord", "name", F.md5("text").alias("text_md5"))


@query("dataset_totals", f"""
WITH {_FILES}
SELECT count(*)::BIGINT AS books, coalesce(sum(length(text)), 0)::BIGINT AS total_chars FROM ordered
""")
def dataset_totals(spark, data_dir):
    books, _ = CO.load_books(spark, write_corpus(spark, data_dir), with_ord=False)
    return CO.dataset_totals(books)


@query("normalize_newlines", """
SELECT doc_id, md5(text) AS text_md5, length(text)::BIGINT AS n_chars FROM documents
""")
def normalize_newlines(spark, data_dir):
    """Texts re-encoded with CRLF (``en``) or CR (``fr``) line ends come back
    identical after universal-newline normalisation."""
    d = table(spark, data_dir, "documents")
    variant = (F.when(F.col("lang") == "en", F.regexp_replace("text", "\n", "\r\n"))
               .when(F.col("lang") == "fr", F.regexp_replace("text", "\n", "\r"))
               .otherwise(F.col("text")))
    n = T.normalize_newlines(variant)
    return d.select("doc_id", F.md5(n).alias("text_md5"), F.length(n).cast("bigint").alias("n_chars"))


def _books_sql(extra: str) -> str:
    """Framed documents as files, by the path they have in the folder."""
    return f"""
WITH {_STREAM_FILES}, {O.marker_ctes()},
cleaned AS (SELECT doc_id, text, {O.strip_ws(O.collapsed_body_sql())} AS clean FROM body)
SELECT doc_id AS rel, length(clean)::BIGINT AS clean_chars, md5(clean) AS clean_md5{extra} FROM cleaned
"""


_STREAM_FILES = (
    f"framed AS (SELECT {_REL_SQL} AS doc_id, text "
    f"FROM ({fixtures.framed_sql('documents', 'source, lang')}))"
)


def write_framed_corpus(spark, data_dir, name):
    """Write the framed documents as files; returns the folder."""
    root = scratch_path(spark, name)
    d = fixtures.framed_documents(table(spark, data_dir, "documents"), "source", "lang")
    rows = d.select(_rel_col().alias("relpath"), "text")
    sinks.write_text_files(rows, root).agg(F.count(F.lit(1))).collect()
    return root


@query("clean_long_books", _books_sql(
    f", {O.splitlines_count('text')} AS lines_before, {O.splitlines_count('clean')} AS lines_after"))
def clean_long_books(spark, data_dir):
    """Files cleaned in ranges of 4 KB, most of them in several; the parts of a
    file are put together only to compare them."""
    root = write_framed_corpus(spark, data_dir, "long-books")
    books = LB.clean_ranges(spark, root, piece_bytes=4096)
    whole = books.parts.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p")).select(
        "path", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("clean"))
    return whole.join(LB.range_stats(books), "path").select(
        _rel(F.col("path"), root).alias("rel"), F.col("chars_after").alias("clean_chars"), F.md5("clean").alias("clean_md5"),
        "lines_before", "lines_after")


# -- JSONL -------------------------------------------------------------------------------

@query("jsonl_scan", """
WITH msgs AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m
              FROM conversations GROUP BY conv_id)
SELECT (row_number() OVER (ORDER BY conv_id) - 1)::BIGINT AS example_id, len(m)::BIGINT AS n_messages,
       md5(array_to_string(list_transform(m, lambda x: x.role || chr(31) || x.content), chr(30))) AS messages_md5
FROM msgs
""")
def jsonl_scan(spark, data_dir):
    """Conversations written as JSONL (blank and whitespace-only lines between
    records, an extra key per record) and read back."""
    msgs = M.assemble_messages(table(spark, data_dir, "conversations"))
    path = scratch_path(spark, "jsonl")
    lines = J.to_jsonl_lines(msgs, extra=(F.col("conv_id").alias("id"),))
    (lines.select(F.concat("value", F.lit("\n\n \t")).alias("value"))
     .orderBy(F.get_json_object("value", "$.id").cast("bigint")).write.text(path))
    back = J.read_chat_jsonl(spark, path, strict=True)
    md5 = F.md5(F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit("\x1f"), x["content"])), "\x1e"))
    return back.select("example_id", F.size("messages").cast("bigint").alias("n_messages"), md5.alias("messages_md5"))


# -- manifest -----------------------------------------------------------------------------

@query("dataset_manifest", f"""
WITH {O.cleaned_ctes()},
t AS (SELECT count(*)::BIGINT AS books, sum(length(clean))::BIGINT AS total_chars FROM cleaned)
SELECT 'documents' AS input, {SEQ_LEN}::BIGINT AS max_seq_len, 'codepoints' AS tokenizer, books, total_chars,
       total_chars AS total_tokens, (total_chars // {SEQ_LEN})::BIGINT AS sequences
FROM t
""")
def dataset_manifest(spark, data_dir):
    d = fixtures.framed_documents(table(spark, data_dir, "documents"))
    c = C.clean_corpus(d).select(F.col("doc_id").alias("ord"), F.col("clean").alias("text"))
    toks = c.select("ord", K.codepoint_ids(F.col("text")).alias("input_ids"))
    counts = toks.agg(
        F.count(F.lit(1)).cast("bigint").alias("books"),
        F.sum(F.size("input_ids")).cast("bigint").alias("total_chars"),
    ).select("books", "total_chars", F.col("total_chars").alias("total_tokens"),
             F.expr(f"total_chars div {SEQ_LEN}").alias("sequences"))
    man = sinks.dataset_manifest(counts, input="documents", max_seq_len=SEQ_LEN, tokenizer="codepoints")
    # committed with the data it counts, and read back through the manifest
    out = scratch_path(spark, "manifest")
    run = sinks.staged_folder(out)
    c.write.parquet(f"{run}/cleaned")
    sinks.commit_manifest(man, out, run)
    _, data = sinks.open_run(spark, out)
    held = spark.read.parquet(f"{data}/cleaned").agg(F.count(F.lit(1)).alias("held"))
    return spark.read.json(f"{out}/manifest").join(held, F.col("books") == F.col("held")).select("input", F.col("max_seq_len").cast("bigint").alias("max_seq_len"), "tokenizer",
                      "books", "total_chars", "total_tokens", "sequences")


# -- streaming ------------------------------------------------------------------------------

@query("stream_clean_corpus", _books_sql(""))
def stream_clean_corpus(spark, data_dir):
    """Framed documents land as ``.txt`` files; a Structured Streaming query
    (availableNow) cleans and tokenises them into Parquet, which is read back."""
    from scriptorium.streaming.corpus_stream import start_corpus_stream
    root = write_framed_corpus(spark, data_dir, "stream-in")
    out = scratch_path(spark, "stream-out")
    queries = start_corpus_stream(spark, root, out, checkpoint_location=scratch_path(spark, "stream-ckpt"))
    for q in queries:
        q.awaitTermination()
    got = spark.read.parquet(f"{out}/cleaned")
    return got.select(_rel(F.col("path"), root).alias("rel"), F.length("clean").cast("bigint").alias("clean_chars"),
                      F.md5("clean").alias("clean_md5"))
