import random
import zlib

import numpy as np

from scriptorium.llm import lang_compress
from scriptorium.llm.lang_compress import Dictionaries, identify, train
from tests.llm.helpers import frame

SYLLABLES = {"aa": "ka ru mi to shi na ko".split(), "bb": "vel brod szk nij pra om".split(), "cc": "thu ell wyn dow cair ffi".split()}
NOTICE = "this work may be copied by anyone under the shared licence"


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        lang = "aa" if i % 3 else rng.choice(["bb", "cc"])
        body = "\n".join(words(rng, lang, rng.choice([2, 20, 60])) for _ in range(rng.choice([1, 4])))
        rows.append((i, body + "\n" + NOTICE, lang))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_languages(spark):
    rows = corpus()
    docs = frame(spark, rows, "doc_id long, text string, lang string", ["h", "line", "content"])
    model = train(docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    got = {r.doc_id: r for r in identify(docs, model).collect()}
    test = [(got[i], lang) for i, _, lang in rows if held(i)]
    assert len(test) > 30 and np.mean([r.best == lang for r, lang in test]) > 0.95
    assert all(0 <= r.score <= 1 and 0 <= r.margin <= 1 for r in got.values())
    assert all(r.language in (r.best, "und") and (r.language == "und") == (r.margin < lang_compress.MARGIN) for r in got.values())


def test_shared_lines_end_every_dictionary(spark):
    model = train(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))
    content = {r.lang: r.content for r in spark.read.parquet(model).collect()}
    assert sorted(content) == ["aa", "bb", "cc"]
    assert all(c.endswith("\n" + NOTICE) and c.count(NOTICE) == 1 for c in content.values())
    assert all(len(c.encode()) <= lang_compress.DICTIONARY_BYTES for c in content.values())


def test_sample_is_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(lang_compress, "SAMPLE_DOCS", 3)
    rows = [(i, f"line{i}", "aa") for i in range(40)] + [(100 + i, "line7", "aa") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    order = [r.text for r in docs.select("text").distinct().selectExpr("text", "xxhash64(text) h").orderBy("h").limit(3).collect()]
    for parts in (1, 7):
        (row,) = spark.read.parquet(train(docs.repartition(parts))).collect()
        assert sorted(row.content.split("\n")) == sorted(order) and row.docs == 240


def test_sizes_against_plain_encoding():
    rng = random.Random(3)
    rows = [{"lang": x, "docs": n, "content": words(rng, x, 4000)} for x, n in (("aa", 5), ("bb", 9), ("cc", 5))]
    d = Dictionaries(rows)
    assert d.languages == ["bb", "aa", "cc"]
    long = words(rng, "cc", 3000).encode()
    cut = [long[i:i + lang_compress.BLOCK_BYTES] for i in range(0, len(long), lang_compress.BLOCK_BYTES)]
    assert d.sizes(long) == [sum(d.sizes(b)[i] for b in cut) for i in range(3)]
    best, share, gap = lang_compress._judge(np.array([d.sizes(long), [7, 7, 9], [5, 4, 4]]))
    assert best.tolist() == [2, 0, 1] and gap[1] == gap[2] == 0
    assert abs(share[1] - 1 / 2.25) < 1e-12


def test_edges(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(1, "kami toshi", "aa"), (2, None, "aa"), (3, "", "bb"), (4, "123 !?\n", "aa"), (None, "kami", None), (6, "kami " * 60_000, "aa"),
            (7, "x", "cc"), (7, "x", "cc")]
    docs = spark.createDataFrame(rows, schema)
    got = [tuple(r) for r in identify(docs, train(docs)).select("doc_id", "best", "score").collect()]
    assert sorted(r[:2] for r in got if r[0] in (2, 3, 4)) == [(2, "und"), (3, "und"), (4, "und")]
    assert [r[1] for r in got if r[0] in (1, 6, None)] == ["aa"] * 3 and len(got) == len(rows)
    assert len({r for r in got if r[0] == 7}) == 1
    assert identify(docs.limit(0), train(docs)).count() == 0
    nothing = train(docs.limit(0))
    assert {(r.best, r.language, r.score) for r in identify(docs, nothing).collect()} == {("und", "und", 0.0)}
    one = train(docs.where("lang = 'aa'"))
    assert {(r.best, r.score) for r in identify(docs, one).where("doc_id = 6").collect()} == {("aa", 1.0)}
