import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from scriptorium.llm.id_store import IdFile, read_ids, write_ids
from scriptorium.llm.shared import read_bytes
from tests.llm.helpers import frame

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["Plain words, here.", "Ünïcode×÷ ÀÉÞßÿ-12.5%x<<|a|> DON'T \x1cq ½²³ ÐÑ\u0301 a1b22!!c", None, "", "ÉCOLE déjà-vu ß İstanbul ﬁne", "日本語 テキスト mixed", "it's they'll I'VE 'S 2024 <|endoftext|> x<|y",
         "a\u00a0b\u2003c\u200bd\ufeff", "tab\tnew\nline\r\n", "x" * 5000, "word " * 30_000, "e\u0301 combining \u0307", "😀😀 ok", "\x00\x1f\x7f ctrl"]


def test_against_the_tokenizer(spark):
    rows = [(i * 3 - 5, t) for i, t in enumerate(TEXTS)] + [(100, "same"), (100, "same"), (None, "no id"), (None, None), (-2 ** 63, "least"), (2 ** 63 - 1, "most")]
    files, dictionary = write_ids(frame(spark, rows, "doc_id long, text string", ["frame", "n_tokens"]), FILE, end_id=1)
    got = sorted(read_ids(files, dictionary).collect(), key=lambda r: r.start)
    tokenizer, start, expected = Tokenizer.from_file(FILE), 0, []
    # rows of one id go by their frames, which for null ids are those of short and null texts
    rows = [r for r in rows if r[0] is not None] + sorted((r for r in rows if r[0] is None), key=lambda r: (r[1] is None) != (got[0].n_tokens == 1))
    for doc_id, t in sorted(rows, key=lambda r: -2 ** 64 if r[0] is None else r[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == expected
    # one document by its id, without the others
    raw = read_bytes(dictionary)
    found = [ids for r in files.collect() if (ids := IdFile(r.file, raw).document(-5)) is not None]
    assert sum(IdFile(r.file, raw).document(2 ** 63 - 1) is not None for r in files.collect()) == 1
    assert [x.tolist() for x in found] == [[*tokenizer.encode(TEXTS[0], add_special_tokens=False).ids, 1]]


def test_many_words_over_small_tables(spark, monkeypatch):
    """Texts that share few words, through a table that is emptied often."""
    import random

    import pyarrow as pa

    from scriptorium.llm import id_store
    from scriptorium.llm.textbytes import utf8

    monkeypatch.setattr(id_store, "CACHE_WORDS", 50)
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choice("abcéßЖ1-'.!") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(60))) for _ in range(200)]
    with open(FILE) as f:
        encoder = id_store.WordEncoder(f.read())
    tokenizer = Tokenizer.from_file(FILE)
    for lo in range(0, 200, 20):
        ids, counts = encoder.encode(*utf8(pa.array(texts[lo:lo + 20])))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[lo:lo + 20]]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_empty_table(spark):
    files, dictionary = write_ids(spark.createDataFrame([], "doc_id long, text string"), FILE, end_id=1)
    assert read_ids(files, dictionary).count() == 0
