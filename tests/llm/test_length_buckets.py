import itertools
import random

import public_tokenizers

from scriptorium.llm.length_buckets import batches, choose_boundaries, length_histogram, pack, token_lengths
from tests.llm.helpers import frame
from tests.llm.test_id_store import TEXTS


def padding(lengths, counts, cuts):
    return sum(n * (min(c for c in cuts if c >= x) - x) for x, n in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = random.Random(3)
    for _ in range(150):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.choice([1, 1, 2, 50]) for _ in lengths]
        buckets = rng.randrange(1, 6)
        cuts, cost = choose_boundaries(lengths, counts, buckets)
        least = min(padding(lengths, counts, [*c, lengths[-1]])
                    for r in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], r))
        assert cost == least == padding(lengths, counts, cuts)
        assert cuts == sorted(set(cuts)) and len(cuts) <= buckets and cuts[-1] == lengths[-1]
    assert choose_boundaries([], [], 4) == ([], 0)


def test_batches_hold_all_rows_within_the_budget(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 5, 7, 30, 31, 200])) for i in range(500)]
    rows += [(None, 9), (7, 5), (7, 5), (900, None), (901, 0), (902, -3), (903, 5000)]
    df = frame(spark, rows, "doc_id long, n_tokens long", ["bucket", "part", "batch", "row"])
    packed = pack(df, budget=400, buckets=4)
    out = packed.collect()
    assert sorted(str((r.doc_id, r.n_tokens)) for r in out) == sorted(str((i, max(n or 0, 0))) for i, n in rows)
    groups = {}
    for r in out:
        assert r.n_tokens <= r.padded_to
        groups.setdefault(r.batch, []).append(r)
    assert sorted(groups) == list(range(len(groups)))
    part_full = {}
    for b, own in groups.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert len({r.bucket for r in own}) == 1
        most = max(1, 400 // own[0].padded_to)
        assert len(own) <= most
        part_full[own[0].bucket] = part_full.get(own[0].bucket, 0) + (len(own) < most)
    assert max(part_full.values()) <= 1
    by_batch = {r.batch: r for r in batches(packed).collect()}
    assert all(by_batch[b].n_docs == len(own) and by_batch[b].n_padding == sum(r.padded_to - r.n_tokens for r in own)
               for b, own in groups.items())
    assert pack(df.limit(0), 400).count() == 0


def test_token_lengths_against_the_tokenizer(spark):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (0, "other"), (None, None), (2 ** 63 - 1, "x")]
    docs = frame(spark, rows, "doc_id long, text string", ["n_tokens", "batch"])
    tokenizer = Tokenizer.from_file(file)
    expected = [(i, 1 + len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    got = token_lengths(docs.repartition(3), "file://" + file, end_id=1)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert token_lengths(docs.limit(0), "file://" + file, end_id=1).count() == 0


def test_histogram_is_exact(spark):
    rows = spark.createDataFrame([(n % 40,) for n in range(96)], "n_tokens long")
    lengths, counts = length_histogram(rows)
    assert lengths == list(range(1, 40)) and sum(counts) == 96 and counts[0] == 6


def test_very_long_documents_change_nothing_for_others(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([3, 7, 19, 33, 101, 257, 400])) for i in range(300)]
    long = [(1000, 1_300_000), (1001, 401), (1002, 70_001), (1003, 70_001)]
    short = {r.doc_id: r for r in pack(spark.createDataFrame(rows, "doc_id long, n_tokens long"), 400, 3).collect()}
    out = {r.doc_id: r for r in pack(spark.createDataFrame(rows + long, "doc_id long, n_tokens long"), 400, 3).collect()}
    lengths = sorted({n for _, n in rows})
    _, least = choose_boundaries(lengths, [sum(n == x for _, n in rows) for x in lengths], 3)
    assert sum(out[i].padded_to - n for i, n in rows) == least
    assert [(out[i].bucket, out[i].padded_to) for i, _ in rows] == [(short[i].bucket, short[i].padded_to) for i, _ in rows]
    assert all(out[i].padded_to == n and out[i].slot == 0 for i, n in long)
    assert len({out[i].batch for i, _ in long}) == 4 and not {out[i].batch for i, _ in long} & {out[i].batch for i, _ in rows}
    only = pack(spark.createDataFrame(long, "doc_id long, n_tokens long"), 400, 3).collect()
    assert sorted((r.batch, r.padded_to - r.n_tokens) for r in only) == [(b, 0) for b in range(4)]
