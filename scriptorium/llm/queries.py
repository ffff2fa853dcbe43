"""The registered queries of this package: thin uses of its operators over
whole tables, with the digest columns derived from their results."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(lambda t: spark.read.parquet(f"{data_dir.rstrip('/')}/{t}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op4_minhash_tensor")
def op4_minhash_tensor(table):
    from scriptorium.llm.minhash_tensor import near_duplicates

    return near_duplicates(table("documents"), words_per_shingle=4, percent=80)


@query("op1_suffix_decontam")
def op1_suffix_decontam(table):
    from scriptorium.llm.suffix_decontam import contamination

    return contamination(table("documents"), table("benchmark"), window=10).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "longest", "longest_item", "longest_at")


PLANTED_TEXT = "\\### Assistant: </turn> ok"


@query("op2_chat_prefix", r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, row_number() OVER o - 1 AS position,
    sum(length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g'))
      + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) + 15) OVER o AS upto
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0) AS BIGINT) AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM sized GROUP BY conv_id
""")
def op2_chat_prefix(table):
    from scriptorium.llm.chat_prefix import format_conversations, read_back

    turns = table("conversations").select("conv_id", "turn", "role", "text")
    planted = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", PLANTED_TEXT), (-7, 1, "assistant", PLANTED_TEXT)], turns.schema)
    formatted = format_conversations(turns.unionByName(planted))
    return read_back(formatted)


@query("op5_id_store")
def op5_id_store(table):
    import public_tokenizers

    from scriptorium.llm.id_store import read_ids, write_ids

    files, dictionary = write_ids(table("documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_ids(files, dictionary)


@query("op6_warc_bundle", """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
    coalesce(html, '') AS html FROM pages
), groups AS (SELECT html AS same, min(page_id) AS first FROM hashed GROUP BY html)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) % 32, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed JOIN groups ON html = same
""")
def op6_warc_bundle(table):
    from scriptorium.llm.warc_bundle import read_bundles, write_bundles

    return read_bundles(write_bundles(table("pages"), min_revisit_bytes=0))


@query("op8_vector_search", """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op8_vector_search(table):
    from scriptorium.llm.vector_search import top_k

    return top_k(table("embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def training_labels(labels: DataFrame) -> DataFrame:
    """Rows that a model may learn from."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


@query("op9_toxicity")
def op9_toxicity(table):
    from scriptorium.llm import toxicity

    docs = table("documents")
    model = toxicity.train(docs, training_labels(table("labels")))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op7_quality")
def op7_quality(table):
    from scriptorium.llm import quality

    docs = table("documents")
    model = quality.train(docs, training_labels(table("labels")))
    return quality.score(docs, model, grade=1).withColumn("kept", F.col("p_at_least") >= 0.5)


def token_count(docs: DataFrame) -> DataFrame:
    """Token counts under a public tokenizer, stored in the shared folder."""
    import public_tokenizers

    from scriptorium.llm.length_buckets import token_lengths
    from scriptorium.llm.shared import qualified, write_bytes
    from scriptorium.session import scratch_path

    spark = docs.sparkSession
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        tokenizer = write_bytes(f"{qualified(spark, scratch_path(spark, 'tokenizer'))}/tokenizer.json", f.read())
    return token_lengths(docs, tokenizer, end_id=1)


TOKEN_BUDGET, LENGTH_BUCKETS = 32_768, 16


@query("op3_length_buckets")
def op3_length_buckets(table):
    from scriptorium.llm.length_buckets import pack

    return pack(token_count(table("documents")), TOKEN_BUDGET, LENGTH_BUCKETS)


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


@query("op10_url_filter")
def op10_url_filter(table):
    from scriptorium.llm.url_filter import judge

    return judge(table("pages"), URL_RULES)


def language_fold() -> Column:
    """True for documents that language identification must not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@query("op11_lang_compress")
def op11_lang_compress(table):
    from scriptorium.llm import lang_compress

    docs = table("documents")
    model = lang_compress.train(docs.where(~language_fold()))
    return lang_compress.identify(docs, model).select(
        "doc_id", language_fold().alias("held_out"), F.col("best").alias("lang_pred"), "score", "margin",
        (F.col("language") == lang_compress.UNKNOWN).alias("rejected"))


@query("op12_collocations_pfp", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents
), counts AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) v(m))
  ) GROUP BY lang, m, phrase
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang
), cand AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE m > 1 AND f >= 30
), halves AS MATERIALIZED (
  SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
), cuts AS MATERIALIZED (
  SELECT s.lang, s.phrase, s.f AS a, k, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * s.f) // (l.f + r.f) AS BIGINT) AS score
  FROM halves s JOIN counts l ON l.lang = s.lang AND l.phrase = s.head JOIN counts r ON r.lang = s.lang AND r.phrase = s.rest
), best AS (
  SELECT lang, phrase, any_value(a) AS a, arg_min({'l': l, 'r': r, 'score': score}, {'score': score, 'k': k}) AS c FROM cuts GROUP BY lang, phrase
), inside AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, array_to_string(w[i:i + j - 1], ' ') AS phrase
    FROM (SELECT lang, f, w, j, unnest(range(1, m - j + 2)) AS i FROM cand, (VALUES (2), (3)) v(j) WHERE j < m)
  ) GROUP BY lang, phrase
), ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY c.score DESC, a DESC, b.phrase) AS rank, b.phrase, a, c.l AS l, c.r AS r, n, c.score AS score
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase JOIN totals t ON t.lang = b.lang
  WHERE i.f IS NULL OR 100::HUGEINT * i.f < 80::HUGEINT * a
)
SELECT * FROM ranked WHERE rank <= 2000
""")
def op12_collocations_pfp(table):
    from scriptorium.llm.collocations_pfp import collocations

    return collocations(table("documents"), least=30, top=2000, percent=80)


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


@query("op13_lexical_cse", f"""
WITH docs AS (
  SELECT r, doc_id, w, len(w) AS n FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0
), total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs
), tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY r, term
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), items AS (
  SELECT i, item_id, unnest(list_distinct(w)) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark)
), scored AS (
  SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms))))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN df USING (term) JOIN docs USING (r), total
  GROUP BY i, r HAVING score > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op13_lexical_cse(table):
    from scriptorium.llm.lexical_cse import search

    return search(table("documents"), table("benchmark"), k=10)
