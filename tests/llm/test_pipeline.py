import random

import corpus_pipeline
from tests.llm.helpers import text


def test_stages_keep_whole_rows(spark, tmp_path):
    rng = random.Random(9)
    bench = text(rng, 40)
    docs, labels = [], []
    for i in range(300):
        words = text(rng, 60)
        junk, bad = i % 7 == 0, i % 4 == 0 and i % 7 != 0
        if junk:
            words = " ".join(w + "###" for w in words.split())
        if bad:
            words = "numbskull " + words
        docs.append((i, words, "en", "s", len(words)))
        labels.append((i, int(not junk), int(bad)))
    docs += [(1000 + i, docs[1][1], "en", "s", 1) for i in range(5)]
    docs += [(2000, "before " + bench + " after", "en", "s", 1), (None, text(rng, 70), None, None, None), (1, docs[1][1], "en", "s", 1)]
    own = [text(rng, 60) for _ in range(3)]
    docs += [(3001, docs[1][1], "en", "s", 1), (3001, own[0], "en", "s", 1), (3002, own[1], "en", "s", 1), (3002, own[2], "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, step, str(tmp_path))
        assert after.columns == step.columns, name
        after.write.parquet(f"{tmp_path}/{name}")
        step = spark.read.parquet(f"{tmp_path}/{name}")
    kept = [r.doc_id for r in step.collect()]
    expected = [i for i in range(300) if i % 7 and i % 4]
    assert sorted(i for i in kept if i is not None) == expected + [3001, 3002, 3002] and None in kept
    assert {r.text for r in step.where("doc_id > 3000").collect()} == set(own)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, kept)) == sorted(str(r.doc_id) for r in packed.collect())
