import itertools
import math
import random
import re
from collections import Counter

from scriptorium.llm.url_filter import cut, judge, segment
from tests.llm.helpers import frame

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
SCHEMA = "page_id long, url string, html string"


def rule_of(host, path):
    fits = [(len(r), r, how) for how, r in RULES
            if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h):])]
    return max(fits)[1:] if fits else (None, None)


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def test_rules_and_parts(spark):
    urls = ["http://A.Example.ORG/en/12?x=/es/", "https://example.org/es/", "http://xexample.org/es/", "http://example.org", "http://b.com/fr/1#/de/",
            "http://b.com/de/", "http://com/de/x", "http://É.com/fr/", "x://y://z/p", "nothing", "", None, "http://?q", "http:///path", "http://e.net/a\nb"]
    rows = [(i, u, "<b>words</b> here") for i, u in enumerate(urls)] + [(3, urls[3], None), (None, urls[0], "")]
    got = judge(frame(spark, rows, SCHEMA, ["host", "score", "name", "words"]), RULES).collect()
    assert len(got) == len(rows)
    url_of = {i: u for i, u, _ in rows}
    for r in got:
        host, path = parts(url_of[r.page_id])
        rule, how = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), url_of[r.page_id]
        assert r.verdict == how if how else r.verdict in ("allow", "block")
    assert judge(spark.createDataFrame([], SCHEMA), RULES).count() == 0


def test_segmented_words_decide(spark):
    html = "<p>" + "casino poker garden flower news " * 20
    rows = [(i, f"http://casinopoker{'.com/de/' if i % 2 else '.example.org/es/'}{i}", html) for i in range(30)]
    rows += [(100 + i, f"http://gardenflower{i % 3}.org/x", html) for i in range(30)]
    rows += [(200, "http://pokercasino.net/", html), (201, "http://flowergarden.net/", html), (202, "http://flowergarden.net/", html)]
    got = {r.page_id: r.verdict for r in judge(spark.createDataFrame(rows, SCHEMA), RULES).collect()}
    assert (got[200], got[201], got[202]) == ("block", "allow", "allow")


def known_words(name, counts, unknown):
    return [(i, n, math.log(counts[name[i:i + n]]) + unknown)
            for i in range(len(name)) for n in range(1, len(name) - i + 1) if name[i:i + n] in counts]


def test_cut_is_the_likeliest():
    counts = {"the": 50, "them": 8, "me": 9, "theme": 2, "park": 5, "men": 3, "a": 20}
    unknown = -math.log(sum(counts.values()) + 10)

    def score(words):
        return sum(math.log(counts[w]) + unknown if w in counts else unknown - 2.3 * len(w) for w in words)

    for name in ("themepark", "themen", "apark", "xyz", "theme", "xtheqme", "thexxpark", "qa", "aq"):
        known = known_words(name, counts, unknown)
        ways = [[name[a:b] for a, b in itertools.pairwise([0, *c, len(name)])]
                for r in range(len(name)) for c in itertools.combinations(range(1, len(name)), r)]
        assert math.isclose(score(cut(name, known, unknown)), max(map(score, ways)))


def test_long_names_and_words(spark):
    """No place and no length is special: a word across letter 64, a word of
    25 letters, one of 300, names of 10,000 letters, letters of many bytes."""
    long, longer = "donaudampfschifffahrtsamt", "llanfair" * 40
    filler = "qx" * 30
    counts = [("casino", 40), ("poker", 30), (long, 9), (longer, 3), ("größe", 12), ("日本", 5), ("a", 2)]
    names = [filler + "casinopoker", "poker" + long + "casino", longer + "casino", "größepoker日本", "#3", "casino" * 2000, "zz"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.words for r in segment(df, spark.createDataFrame(counts, "word string, n long")).collect()}
    assert got == {names[0]: [filler, "casino", "poker"], names[1]: ["poker", long, "casino"], names[2]: [longer, "casino"],
                   names[3]: ["größe", "poker", "日本"], "#3": ["#3"], names[5]: ["casino"] * 2000, "zz": ["zz"]}


def brute_odds(rows):
    """Score of every url that no rule decides, by counters."""
    plain = [re.findall(r"[^\W\d_]+", re.sub("<[^>]*>", " ", h or "").lower()) for _, _, h in rows]
    counts = Counter(w for p in plain for w in p)
    unknown = -math.log(sum(counts.values()) + 10)
    urls = []
    for i, u, _ in rows:
        host, path = parts(u)
        words = []
        for run in re.findall(r"[^\W\d_]+|[0-9]+", f"{host}/{path}".lower()):
            words += [f"#{len(run)}"] if run[0].isdigit() else cut(run, known_words(run, counts, unknown), unknown)
        urls.append((i, rule_of(host, path)[1], words))
    tokens = {how: Counter(w for _, h, words in urls for w in words if h == how) for how in ("block", "allow")}
    vocabulary = {w for _, _, words in urls for w in words}
    decided = Counter(h for _, h, _ in urls)
    out = {}
    for i, how, words in urls:
        if how is None:
            p = {h: math.log(decided[h] + 1) + sum(math.log((tokens[h][w] + 1) / (tokens[h].total() + len(vocabulary) + 1)) for w in words)
                 for h in tokens}
            out[i] = p["block"] - p["allow"]
    return out


def test_naive_bayes_against_counters(spark):
    rng = random.Random(6)
    vocabulary = "casino poker garden flower news river bridge".split()
    rows = []
    for i in range(120):
        name = "".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 4)))
        host = rng.choice(["{}.com/de/", "{}.com/fr/", "{}.example.org/es/", "{}.org/", "{}.net/", "www.{}.info/"]).format(name)
        rows.append((i, f"https://{host}{rng.choice(vocabulary)}{rng.randrange(2000)}", f"<p>{' '.join(rng.choices(vocabulary, k=5))}</p>"))
    rows += [(200, None, None), (201, "no scheme", ""), (202, rows[4][1], "x")]
    got = {r.page_id: r.score for r in judge(spark.createDataFrame(rows, SCHEMA), RULES).collect() if r.rule is None}
    want = brute_odds(rows)
    assert set(got) == set(want) and all(math.isclose(got[i], want[i], abs_tol=1e-4) for i in want)
