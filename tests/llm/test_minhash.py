import random
import re

import pytest

from scriptorium.llm.minhash_tensor import near_duplicates, remove_duplicates
from tests.llm.helpers import frame, text, thue_morse

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, k):
    w = tuple(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    if len(w) < k:
        return {w} if w else set()
    return {w[i:i + k] for i in range(len(w) - k + 1)}


def brute(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def cases():
    rng = random.Random(2)
    docs = []
    for i in range(12):
        base = text(rng, rng.choice([3, 15, 60, 200])).split()
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                copy[rng.randrange(len(copy))] = "changed"
            docs.append((len(docs), " ".join(copy)))
    # a chain: each is similar to the next, the ends are not
    chain = text(rng, 120).split()
    for i in range(6):
        docs.append((len(docs), " ".join(chain[6 * i:6 * i + 90])))
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "Word"), (1004, "word"), (1005, "word\tword")]
    docs += [(1006 + i, docs[0][1].upper()) for i in range(30)]
    rng.shuffle(docs)
    return docs


def test_against_brute_force(spark):
    docs = cases()
    df = frame(spark, docs, "doc_id long, text string", ["rep", "key", "h1"])
    for k, percent in ((4, 80), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, words_per_shingle=k, percent=percent).collect()}
        assert got == brute(docs, k, percent)


def test_edges(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (None, None), (5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(5, 5, True), (5, 5, True), (9, 5, False), (None, None, True), (None, None, True)]


def test_long_words_that_hash_alike(spark):
    docs = []
    for n in (64, 65, 1024, 4096):
        a, b = thue_morse(n)
        docs += [(len(docs), a), (len(docs) + 1, b), (len(docs) + 2, a.upper()), (len(docs) + 3, f"one two three {a} four"), (len(docs) + 4, f"one two three {b} four")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs, 5, 80)


def test_word_hashes():
    import numpy as np
    import pyarrow as pa

    from scriptorium.llm.textbytes import byte_class, split_words, utf8, word_hashes

    rng = random.Random(12)
    words = {"".join(rng.choice("ab\x00é") for _ in range(rng.randrange(1, 90))) for _ in range(3000)}
    words |= {"a" * n for n in range(1, 200)} | {"\x00" * n for n in range(1, 40)}
    words = sorted(words)
    texts = [" ".join(words), " ".join(reversed(words)), " ".join(words).upper()]
    buf, off = utf8(pa.array(texts))
    w = split_words(buf, off, byte_class(b" "))
    a, b, c = np.split(word_hashes(w.data, w.start, w.end), 3)
    assert len(set(a.tolist())) == len(words) and np.array_equal(a, b[::-1])
    folded = np.array(["É" not in x and "é" not in x for x in words])
    assert np.array_equal(a[folded], c[folded])
    assert not np.array_equal(a, np.split(word_hashes(w.data, w.start, w.end, fold_case=False), 3)[2])


def test_rows_of_one_id_are_told_apart(spark):
    rng = random.Random(14)
    a, b, c, d, e = (text(rng, 40) for _ in range(5))
    rows = [(1, a), (2, a), (2, b), (5, c), (5, d), (None, a), (None, e), (None, e.upper()), (7, None), (7, ""), (8, " ")]
    docs = frame(spark, rows, "doc_id long, text string", ["row", "component_id", "kept"])
    left = remove_duplicates(docs.repartition(3))
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    texts = {t.lower() for i, t in got if t and i is None}
    assert sorted((x for x in got if x[0] is not None), key=str) == sorted([(1, a), (2, b), (5, c), (5, d), (7, None), (7, ""), (8, " ")], key=str)
    assert texts == {e.lower()} and len(got) == 8
    assert remove_duplicates(docs.limit(0)).count() == 0


def test_percent_has_a_lower_end(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    with pytest.raises(ValueError):
        near_duplicates(docs, percent=60)


def test_ids_of_all_sizes(spark):
    """Ids whose upper bits differ, as those of numbered rows do."""
    rng = random.Random(15)
    ids = [p << 33 | i for p in (0, 1, 5, 2 ** 29) for i in range(6)] + [-1, -2 ** 63, 2 ** 63 - 1, -(7 << 33)]
    texts = [text(rng, 30) for _ in range(7)]
    docs = [(i, rng.choice(texts)) for i in ids]
    docs += [(100 + i, t + " end") for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute(docs, 5, 80)
