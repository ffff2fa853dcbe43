import random
import re

from scriptorium.llm import suffix_decontam
from scriptorium.llm.suffix_decontam import contamination, remove_contaminated
from tests.llm.helpers import frame, text, thue_morse

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)) if t else []


def brute(docs, bench, window):
    out = []
    for doc_id, t in docs:
        w, hit, items = words(t), set(), set()
        for item, bt in bench:
            b = words(bt)
            n = min(window, len(b))
            for i in range(len(b) - n + 1 if b else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == b[i:i + n]:
                        hit.update(range(j, j + n))
                        items.add(str(item))
        out.append((doc_id, len(w), len(hit), sorted(items)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(1)
    bench = [(i, text(rng, rng.choice([4, 12, 30]))) for i in range(12)]
    bench += [(12, None), (13, ""), (14, "?!"), (15, bench[0][1]), (None, "river stone green"), (16, "Übung")]
    docs = [(i, text(rng, rng.choice([0, 3, 20, 80]))) for i in range(40)]
    for i in range(40, 60):
        passage = words(rng.choice(bench[:12])[1])
        docs.append((i, text(rng, 10) + " -- " + " ".join(passage).upper() + ". " + text(rng, 9)))
    docs += [(60, None), (61, ""), (62, "übung " * 3), (62, "übung " * 3), (None, bench[3][1]), (63, text(rng, 20_000))]
    return docs, bench


def test_against_brute_force(spark):
    docs, bench = cases()
    d, b = frame(spark, docs, DOC, ["items", "item"]), frame(spark, bench, ITEM, ["block"])
    known = [x for x in bench if x[0] is not None]
    for window in (10, 4):
        got = contamination(d, b, window).collect()
        assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got], key=str) == brute(docs, known, window)
        for r in got:
            assert sum(s.end - s.start for s in r.spans) == r.n_hit
            assert (r.longest > 0) == (r.n_hit > 0)
    kept = remove_contaminated(d, b, 10)
    assert kept.columns == d.columns
    clean = [x[0] for x in brute(docs, known, 10) if not x[2]]
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(map(str, clean))


def test_nothing_to_find(spark):
    docs, bench = cases()
    d, b = spark.createDataFrame(docs[:20], DOC), spark.createDataFrame(bench, ITEM)
    assert contamination(d.limit(0), b).count() == 0
    assert {r.n_hit for r in contamination(d, b.limit(0)).collect()} == {0}
    # words of the benchmark, but no window of it
    shuffled = [(1, " ".join(sorted(set(words(bench[2][1])))) * 3)]
    assert contamination(spark.createDataFrame(shuffled, DOC), b).first().n_hit == 0


def test_long_words_that_hash_alike(spark):
    for n in (1024, 4096):
        a, b = thue_morse(n)
        docs = [(1, f"x {a} y"), (2, f"x {b} y"), (3, a), (4, b)]
        bench = [(7, f"X {a.upper()} Y"), (8, a)]
        got = contamination(spark.createDataFrame(docs, DOC), spark.createDataFrame(bench, ITEM)).collect()
        assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got]) == brute(docs, bench, 10)
        assert {r.doc_id for r in got if r.n_hit} == {1, 3}


def test_many_blocks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_decontam, "BLOCK_BYTES", 200)
    docs, bench = cases()
    d, b = spark.createDataFrame(docs, DOC), spark.createDataFrame(bench + bench[:5], ITEM)
    assert len(suffix_decontam._store_blocks(b, 10, "item_id", "text")) > 3
    got = contamination(d, b, 10)
    known = [x for x in bench if x[0] is not None]
    assert sorted([(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()], key=str) == brute(docs, known, 10)
    monkeypatch.undo()
    one = contamination(d, b, 10).drop("longest_item")  # equal items tie
    assert sorted(map(str, got.drop("longest_item").collect())) == sorted(map(str, one.collect()))
