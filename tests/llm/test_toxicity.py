import math
import random
import re

import numpy as np

from scriptorium.llm import toxicity
from tests.llm.helpers import frame, text

BAD = ["blockhead", "numbskull", "dimwit"]
HIDDEN = {"blockhead": ["bl0ckhe4d", "b l o c k h e a d", "bloooockhead", "BLOCKH3AD", "b.l.o.c.k.h.e.a.d"],
          "numbskull": ["numb$kull", "n-u-m-b-s-k-u-l-l", "nuuuumbskull"], "dimwit": ["d1mw1t", "d i m w i t", "dimw!t"]}


def made(rng, n):
    rows = []
    for i in range(n):
        words = text(rng, rng.randrange(20, 60)).split()
        if bad := rng.random() < 0.3:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_and_hidden_words(spark):
    rng = random.Random(8)
    rows = made(rng, 500)
    docs = frame(spark, [r[:2] for r in rows], "doc_id long, text string", ["score", "label"])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert np.mean([(got[i] >= 0.5) == y for i, _, y in rows if i % 5 == 0]) > 0.97
    hidden = [h for forms in HIDDEN.values() for h in forms]
    tests = [(i, text(rng, 20) + " " + h + " " + text(rng, 20)) for i, h in enumerate(hidden)]
    found = toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()
    assert [hidden[r.doc_id] for r in found if r.score < 0.5] == []
    kept = toxicity.remove_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_restoring(spark):
    docs = spark.createDataFrame([(0, (" ".join(BAD) + " silly goose ") * 50)], "doc_id long, text string")
    channel = toxicity.Channel(toxicity.character_model(docs))
    for word, forms in HIDDEN.items():
        for form in forms:
            assert channel.text(f"you {form}, really") == f"you {word}, really", form
    plain = "Nothing to see here, 100 % sure; a b c."
    assert channel.text("goose silly goose") == "goose silly goose"
    assert channel.text(plain).startswith("nothing to see here")
    assert len(channel.text("1a" * 20_000)) > 0


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a" * 100_000), (3, "! " * 10)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.5] * 5
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), none)


def test_spacing_and_outer_signs(spark):
    docs = spark.createDataFrame([(0, ("you are a idiot " + "what an ass you idiot " + "as good as a pretty nest here ") * 50)],
                                 "doc_id long, text string")
    channel = toxicity.Channel(toxicity.character_model(docs))
    forms = {
        "you are a i d i o t": "you are a idiot", "y o u i d i o t": "you idiot", "y o u  i d i o t": "you idiot",
        "i d 1 o t": "idiot", "i  d  i o t": "idiot", "i -- d _ i\u00a0o * t": "idiot", "an a s s": "an ass", "an a $ $": "an ass",
        "an a$$ here": "an ass here", "an as$": "an ass", "idio+": "idiot", "you idio+, a$$.": "you idiot, ass.", "@$$": "ass",
        "i d i i o t": "idiot", "i i i d d i i o t t": "idiot", "pr€tty": "pretty", "n€st": "nest", "1 2 3 4": "1 2 3 4", "2019 $100 1,000": "2019 $100 1,000",
    }
    assert {f: channel.text(f) for f in forms} == forms
    assert channel.text("pretty!").startswith("pretty")


def test_marks_hold_whatever_is_restored():
    rng = random.Random(5)
    pieces = ["a", "i", "é", "1", "4", "$", "€", "£", "+", "!", " ", " ", "  ", ".", "-", "_", "\u00a0", "\u2014", "zz", "ß", "中"]
    for _ in range(20_000):
        given = "".join(rng.choice(pieces) for _ in range(rng.randrange(3, 9)))
        found = toxicity._SIGN.search(given) or any(toxicity._LETTER.search(m[0]) for m in toxicity._APART.finditer(given))
        if found:
            assert toxicity._suspicious(np.frombuffer(given.encode(), np.uint8)).any(), given


def every_path(channel, steps, only=None):
    """The cheapest reading of a lattice (or of those that give ``only``), all
    paths tried one by one."""
    from scriptorium.llm import toxicity as t

    whole = "".join(steps)
    plain = " " in whole or not re.search(t._S, whole.strip("@$!|+(<€£"))
    repeated = t.REPEATED_ONCE if plain and not t._STRETCHED.search(whole.replace(" ", "")) else t.REPEATED
    best = [(math.inf, "")]

    def go(i, a, b, last, total, out):
        if i == len(steps):
            total += channel.cost[a][b][0] if b else 0
            if total < best[0][0] and only in (None, out):
                best[0] = (total, out)
            return
        c, row = steps[i], channel.cost[a][b]
        if c.isspace():
            if b:
                go(i + 1, a, b, last, total + (t.JOINED_WIDE if len(c) > 1 else 0), out)
                go(i + 1, b, 0, "", total + row[0] + (0 if len(c) > 1 else t.ENDED), out + " ")
            else:
                go(i + 1, a, b, last, total, out + " " if out else out)
            return
        for x, extra in [(c, 0)] if c.isalpha() else [(x, t.IMITATED) for x in t.IMITATES.get(c, "")]:
            go(i + 1, b, t._symbol(x), x, total + row[t._symbol(x)] + extra, out + x)
            if x == last:
                go(i + 1, a, b, last, total + extra + repeated, out)
        if not c.isalpha():
            if not c.isdigit():
                go(i + 1, a, b, last, total + (t.DROPPED_FIRM if c in t.FIRM else t.DROPPED), out)
            go(i + 1, b, 0, "", total + row[0] + t.KEPT_SIGN, out + c)

    go(0, 0, 0, "", 0.0, "")
    return best[0]


def test_viterbi_against_all_paths(spark):
    docs = spark.createDataFrame([(0, (" ".join(BAD) + " silly goose idiot all see ") * 30)], "doc_id long, text string")
    channel = toxicity.Channel(toxicity.character_model(docs))
    rng = random.Random(11)
    for _ in range(300):
        steps = tuple(rng.choice(["a", "l", "l", "s", "e", "o", "1", "0", "$", "!", "+", " ", "  "]) for _ in range(rng.randrange(1, 8)))
        found = channel._decode(steps)
        assert math.isclose(every_path(channel, steps, found)[0], every_path(channel, steps)[0], abs_tol=1e-9), steps


def test_logistic_fit_against_direct_sums(monkeypatch):
    """At the fitted weights, the gradient of the weighted loss is nearly 0."""
    monkeypatch.setattr(toxicity, "STEPS", 5000)
    rng = np.random.default_rng(2)
    x = rng.random((200, 4)) < 0.4
    y = (x @ [2.0, -2.0, 1.0, 0.0] + rng.normal(0, 1, 200) > 0.8).astype(float)
    doc, feature = np.nonzero(x)
    w, b = toxicity.fit_logistic(y, doc, feature, 4)
    odds = (y.sum() + 1) / (200 - y.sum() + 1)
    weigh = [odds ** -0.25 if v else odds ** 0.25 for v in y]
    error = [(1 / (1 + math.exp(-(sum(w[j] for j in range(4) if r[j]) + b))) - v) * g / sum(weigh) for r, v, g in zip(x, y, weigh)]
    for j in range(4):
        assert abs(sum(e for e, r in zip(error, x) if r[j]) + toxicity.DECAY * w[j]) < 2e-3
    assert abs(sum(error)) < 2e-3


def test_sample_is_bounded_in_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 50)
    seen = []
    fit = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda label, *a: seen.append(len(label)) or fit(label, *a))
    docs = spark.createDataFrame([(i % 20, f"numbskull word{i}") for i in range(2000)], "doc_id long, text string")
    toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int"))
    assert seen == [50]
