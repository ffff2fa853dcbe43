import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import bits
from scriptorium.llm import collocations_pfp as C
from scriptorium.llm.collocations_pfp import Grams, collocations, dictionary, parse_text, phrase_counts
from scriptorium.llm.textbytes import utf8
from tests.llm.helpers import frame


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(docs):
    """Counter of (lang, phrase), the empty phrase for all words."""
    out = Counter()
    for _, text, lang in docs:
        for w in pieces(text):
            out[lang or "und", ""] += len(w)
            out.update((lang or "und", " ".join(w[i:i + m])) for m in (1, 2, 3, 4) for i in range(len(w) - m + 1))
    return out


def brute(docs, least, top, percent):
    f = counted(docs)
    words = {k: k[1].split(" ") for k, n in f.items() if k[1]}
    cand = {k: f[k] for k, w in words.items() if len(w) > 1 and f[k] >= least}
    longer = Counter()
    for k, n in cand.items():
        w = words[k]
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                sub = k[0], " ".join(w[i:i + m])
                longer[sub] = max(longer[sub], n)
    rows = []
    for (lang, phrase), a in cand.items():
        if 100 * longer[lang, phrase] >= percent * a:
            continue
        w = words[lang, phrase]
        cuts = []
        for k in range(1, len(w)):
            l, r = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((2000000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        rows.append((lang, -score, -a, phrase.encode(), a, l, r, score))
    out, rank = [], Counter()
    for lang, _, _, phrase, a, l, r, score in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), a, l, r, f[lang, ""], score))
    return sorted(out)


def corpus(seed=4, n=60):
    rng = random.Random(seed)
    common = "the of And to in a is été日 that's x".split()
    passage = " ".join(rng.choice(common) + rng.choice(["", ",", " y", "."]) for _ in range(90))
    rows = []
    for i in range(n):
        body = " ".join(rng.choice(common) + rng.choice(["", "", "", ",", "\n", " \t", "!"]) for _ in range(rng.choice([0, 1, 3, 60, 200])))
        if rng.random() < 0.4:
            body += rng.choice([" ", ". "]) + passage
        rows.append((i, body, rng.choice(["en", "en", "en", "fr", None])))
    rows += [(100, None, "en"), (101, "", "en"), (102, " .,\n\t", "de"), (None, "The of", None), (103, "x " * 30_000, "xx"),
             (104, "nul\x00a nul\x00a", "en"), (105, "the of", "und")]
    return rows + [rows[5]] * 40


@pytest.mark.parametrize("period,most", [(1, 4096), (5, 4096), (32, 4096), (32, 1), (5, 3), (10 ** 6, 7)])
def test_every_phrase_is_in_one_chunk(period, most, monkeypatch):
    """Weighted counts inside the chunks are those of the texts."""
    monkeypatch.setattr(C, "PERIOD", period)
    monkeypatch.setattr(C, "MOST_WORDS", most)
    docs = [(i, t, "xx") for i, t, _ in corpus()]
    buf, off = utf8(pa.array([t for _, t, _ in docs]))
    doc, chunks, last = parse_text(buf, off)
    table = pa.table({"lang": pa.array(["xx"] * len(chunks)), "chunk": [c.decode() for c in chunks], "last": last, "n": np.ones(len(chunks), np.int64)})
    grams = Grams(table)
    got = Counter()
    for m in (1, 2, 3, 4):
        if m > 1:
            grams.extend(m, m - 1)
        got.update({("xx", r["phrase"]): r["n"] for r in grams.counts(m).to_pylist()})
    got["xx", ""] = grams.totals()["n"][0].as_py()
    assert got == +counted(docs)
    assert max(len(c.split()) for c in chunks) <= most + 2 * C.OVERLAP


def test_shared_passages_share_chunks():
    rng = random.Random(9)
    passage = " ".join(f"p{rng.randrange(10 ** 6)}" for _ in range(400))
    texts = [" ".join(f"q{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(50))) + " " + passage + " end" for _ in range(10)]
    _, chunks, _ = parse_text(*utf8(pa.array(texts)))
    common = [c for c, n in Counter(chunks).items() if n == 10]
    assert sum(len(c.split()) for c in common) > 250


@pytest.mark.parametrize("least,top,percent", [(3, 1000, 80), (30, 7, 80), (5, 1000, 40)])
def test_against_direct_counts(spark, least, top, percent):
    docs = corpus()
    df = frame(spark, docs, "doc_id long, text string, lang string", ["chunk", "phrase", "n", "h", "words"])
    got = sorted(map(tuple, collocations(df.repartition(5), least, top, percent).collect()))
    assert got == brute(docs, least, top, percent) and got


def test_small_slabs_and_full_tables(spark, monkeypatch):
    """A task that counts little at a time, and bit tables that stop nothing."""
    monkeypatch.setattr(C, "SLAB_BYTES", 500)
    docs = corpus(5)
    chunks = dictionary(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    want = {k: n for k, n in counted(docs).items() if n >= 10 or (k[1] == "" and n)}
    for most in (29, 3):
        monkeypatch.setattr(bits, "BITS_LEAST", min(bits.BITS_LEAST, most))
        monkeypatch.setattr(bits, "BITS_MOST", most)
        got = {(r.lang, r.phrase): r.n for r in phrase_counts(chunks, 10).collect()}
        assert {k: n for k, n in got.items() if n} == want


def test_bit_table_has_all_it_was_given(spark, monkeypatch):
    monkeypatch.setattr(bits, "BLOCK_BITS", 12)
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    h[:3] = [0, 2 ** 64 - 1, 2 ** 63]
    df = spark.createDataFrame(pa.table({"h": h.view(np.int64)}).to_pandas())
    for least in (12, 20):
        monkeypatch.setattr(bits, "BITS_LEAST", least)
        monkeypatch.setattr(bits, "BITS_EACH", 1)
        table = bits.load.__wrapped__(bits.write(df))
        assert bits.held(table, h).all()
        other = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
        assert bits.held(table, other).mean() < 0.8


def test_empty_table(spark):
    none = collocations(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert none.count() == 0 and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_beyond_64_bits(spark):
    """The score's product passes 64 bits."""
    expr = "(cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"
    a, l, r = 7 * 10 ** 17 + 3, 8 * 10 ** 18 + 1, 9 * 10 ** 17 + 7
    got = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr(expr + " AS s").first().s
    assert got == 2000000 * a // (l + r)
