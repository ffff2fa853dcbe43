"""Column text functions and the cleaner against a plain-Python model."""

import random
import re

from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import clean as C
from scriptorium.plans import fixtures

# Plain-Python model of the cleaning rules, by character sets and word scans.
_MAP = {0x2018: "'", 0x2019: "'", 0x201C: '"', 0x201D: '"', 0x2013: "-", 0x2014: "--"}


def has_marker(line, which):
    """Three asterisks, then ``which``, of and the if given, and the project's name."""
    at = line.find("***")
    while at >= 0:
        words = [w.upper() for w in line[at + 3:].split()]
        if words[:1] == [which]:
            rest = words[1:]
            for optional in ("OF", "THE"):
                rest = rest[1:] if rest[:1] == [optional] else rest
            if rest[:1] == ["PROJECT"] and rest[1:] and rest[1].startswith("GUTENBERG"):
                return True
        at = line.find("***", at + 1)
    return False


def is_numbering(line):
    line = line.strip()
    roman = line.removesuffix(".")
    if roman and set(roman) <= set("IVXLCDM"):
        return True
    if line.startswith("{") and line.endswith("}") and len(line) > 1:
        return line[1:-1].strip().isdecimal()
    return line.removeprefix("-").removesuffix("-").strip().isdecimal()


def is_decoration(line):
    line = line.strip()
    return bool(line) and all(c.isspace() or c in "*_=#$%&~+" for c in line)


def model_clean(text):
    lines = text.split("\n")
    starts = [i for i, l in enumerate(lines) if has_marker(l, "START")]
    ends = [i for i, l in enumerate(lines) if has_marker(l, "END") and not has_marker(l, "START")]
    if not starts:
        return ""
    s, e = starts[0], (ends[0] if ends else len(lines))
    out = []
    for i in range(s + 1, len(lines)):
        if i >= e:
            break
        line = lines[i]
        if has_marker(line, "START") or is_numbering(line):
            continue
        norm = re.sub(r"---?", "--", line.translate(_MAP))
        if is_decoration(norm):
            continue
        out.append(norm)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


POOL = [
    "I", "XII. ", "MIX", "CIVIL", "iv", "I am", "1984", "- 12 -", "12-", "{ 7 }", "٣",
    "– 12 –", "* * *", "===", "~ + ~", "--", "-", "---", "----", "-----", "——",
    "“q” ‘s’", "", "", "   ", "x ", "y ", "\u000b", "\u001c", "  keep  ",
    "*** START OF THE PROJECT GUTENBERG EBOOK X", "*** END OF THE PROJECT GUTENBERG EBOOK X",
    "***ſtart of project gutenberg", "***END PROJECT GUTENBERG", "plain words here", "a\rb",
    "*** START OF PROJECT GUTENBERG *** END OF THE PROJECT GUTENBERG",
]


def _docs(n, seed=7):
    rnd = random.Random(seed)
    docs = [""]
    for _ in range(n):
        docs.append("\n".join(rnd.choice(POOL) for _ in range(rnd.randint(1, 25))))
    return docs


def test_strip_matches_python(spark):
    ws = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert set(ws) == set(T.WS_CHARS)
    samples = [ws + "a b" + ws, "\u001cx\u001f", " ", "", "x"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(T.strip_ws(F.col("t"))).collect()]
    assert got == [s.strip() for s in samples]


def test_splitlines_count(spark):
    samples = ["", "a", "a\n", "a\r\nb", "a\rb\n", "\n\n", "a b", "a\x0bb\x0c", "a\x1c\x1d\x1eb",
               "a\u0085", "x\r\n", "\r"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(T.count_splitlines(F.col("t"))).collect()]
    assert got == [len(s.splitlines()) for s in samples]


def test_cleaner_matches_model_on_adversarial_docs(spark):
    docs = _docs(400)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: r.clean for r in C.clean_corpus(df).select("doc_id", "clean").collect()}
    for i, d in enumerate(docs):
        assert got[i] == model_clean(d), (i, d)


def test_frames_behave_as_documented(spark):
    body = "First line.\nSecond line."
    rows = [(k, body) for k in range(8)]
    df = fixtures.framed_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.clean for r in C.clean_corpus(df).collect()}
    assert got[0] == "" and got[2] == ""
    for k in (1, 3, 5, 6):
        assert got[k] == body
    assert got[4] == body + "\ntail"
    # frame 7: debris rules applied before the text
    assert got[7].endswith(body)
    assert "XII" not in got[7] and "1984" not in got[7] and "* * *" not in got[7]
    assert "- 12 -" in got[7] and "\"Quoted,\" she said -- 'yes' - no." in got[7]


def test_line_rules(spark):
    cases = {
        "I": False, "XII. ": False, "MIX": False, "CIVIL": False, "iv": True, "I am": True,
        "1984": False, "- 12 -": False, "12-": False, "{ 7 }": False, "٣": False,
        "* * *": False, "===": False, "~ + ~": False, "--": True, "-": True,
    }
    lines = list(cases)
    text = "\n".join(["*** START OF THE PROJECT GUTENBERG"] + lines)
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    out = C.clean_corpus(df).first().clean.split("\n")
    assert out == [l for l in lines if cases[l]]


def test_hyphen_and_punctuation(spark):
    lines = ["---", "----", "-----", "——", "– 12 –", "“a” ‘b’"]
    df = spark.createDataFrame([(l,) for l in lines], "l string")
    got = [r[0] for r in df.select(T.collapse_hyphens(T.normalize_punctuation(F.col("l")))).collect()]
    assert got == ["--", "---", "----", "---", "- 12 -", "\"a\" 'b'"]


def test_missing_start_keep(spark):
    df = spark.createDataFrame([(0, "a\nb\n*** END OF THE PROJECT GUTENBERG\nlicence")], "doc_id long, text string")
    assert C.clean_corpus(df).first().clean == ""
    assert C.clean_corpus(df, missing_start="keep").first().clean == "a\nb"


def test_long_book_is_linear_in_lines(spark):
    import time
    lines = ["*** START OF THE PROJECT GUTENBERG EBOOK BIG ***"]
    lines += [f"line {i} -- “quoted”" if i % 97 else "XII." for i in range(150_000)]
    lines += ["*** END OF THE PROJECT GUTENBERG EBOOK BIG ***", "licence"]
    text = "\n".join(lines)
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    t0 = time.time()
    out = C.clean_corpus(df).first().clean
    assert time.time() - t0 < 60
    assert out == model_clean(text)


def test_line_rules_are_linear(spark):
    """A blank line of 1 MB, and digits, a long gap and a letter."""
    import time

    n = 1 << 20
    lines = [" " * n, "7" * 1000 + " " * n + "x", "{" + " " * n + "7" + " " * n, "-" + " " * n + "I"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    df.limit(1).select(T.is_numbering_line(F.lit("x"))).collect()
    began = time.time()
    rows = df.select(T.is_numbering_line(F.col("t")), T.is_page_number_line(F.col("t")), T.is_roman_line(F.col("t"))).collect()
    assert not any(v for r in rows for v in r) and time.time() - began < 5
