"""Resampling, page text and hard negatives against plain versions, on rows that ordinary data lacks."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from larkspur.llm import common, negatives, pagetext, queries, resampling  # noqa: E402

# --- importance resampling ------------------------------------------------------------------------------------------


def plain_words(text: str | None) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_features(text: str | None, low: int, high: int) -> list[int]:
    w = plain_words(text)
    runs = [" ".join(w[i : i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain_draw(rows: list[tuple], target: list, low: int = 1, high: int = 1, least: int = 20, percent: int = 10) -> list[tuple]:
    mine = [plain_features(t, low, high) for _, t in rows]
    s, t = Counter(b for f in mine for b in f), Counter(b for text in target for b in plain_features(text, low, high))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for (key, text), f in zip(rows, mine, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * percent // 100], start=1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    words = "Apple pear PLUM naïve 12 x7 Größe the a of quick\tbrown fox-trot 東京".split()
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(60))) for _ in range(120)]
    texts += [None, "", " \x00--", "word " * 40, "word " * 40, "word " * 40, "long text " * 90_000]
    return list(enumerate(texts)) + [(None, "null id " * 15), (7, "repeated id " * 15), (124, "word " * 40)]


@pytest.mark.parametrize("runs", [(1, 1), (1, 3), (2, 2)])
def test_draw_equals_plain(spark, corpus, runs):
    target = ["quick fox-trot Größe", None, "the the of"]
    documents = spark.createDataFrame(corpus, "doc_id bigint, text string").selectExpr("*", "'x' as row", "'y' as t", "'z' as score").repartition(3)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.draw(resampling.weigh(documents, wanted, low=runs[0], high=runs[1]))
    found = sorted((tuple(r) for r in got.select("row.doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    expected = plain_draw(corpus, target, *runs)
    # equal rows of one id share their ranks in any order
    assert Counter(f[:4] for f in found) == Counter(e[:4] for e in expected)
    assert sorted(f[3:] for f in found if f[4]) == sorted(e[3:] for e in expected if e[4])


def test_draw_of_empty_tables(spark, corpus):
    documents = spark.createDataFrame(corpus[:50], "doc_id bigint, text string")
    none = documents.limit(0)
    assert resampling.draw(resampling.weigh(none, documents)).count() == 0
    assert {r["weight"] for r in resampling.weigh(documents, none).where("n_features = 0").collect()} <= {0}
    assert resampling.weigh(documents, none).count() == 50
    kept = resampling.resample(spark.createDataFrame(corpus, "doc_id bigint, text string"), documents, percent=50)
    assert kept.columns == ["doc_id", "text"] and kept.where("size(split(text, ' ')) < 20").count() == 0


def test_same_as_sql(spark, in_duckdb, tmp_path, corpus):
    spark.createDataFrame(corpus[:124], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, "the quick 東京"), (1, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = queries.op11_importance_resampling(spark, str(tmp_path))
    frames = {n: spark.read.parquet(str(tmp_path / f"{n}.parquet")) for n in ("documents", "benchmark")}
    columns, expected = in_duckdb(queries.LLM_ORACLES["op11_importance_resampling"], **frames)
    assert columns == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_bit_planes_sum_exactly():
    draw = np.random.default_rng(3)
    counts, gains = draw.integers(0, 40_000, (5, 130)), draw.integers(-90_000, 90_000, 130)
    assert (resampling.weighted_sums(counts, resampling.gain_planes(gains)) == counts @ gains).all()
    assert (resampling.weighted_sums(counts * 0, resampling.gain_planes(gains)) == 0).all()
    assert (resampling.weighted_sums(counts, resampling.gain_planes(-np.abs(gains))) == counts @ -np.abs(gains)).all()


def test_pieces_lose_no_run(monkeypatch):
    text = b"a bb ccc dddd e f ggg hh i j k l m " * 5
    whole = resampling.features(text, 1, 4, 500)
    original = resampling.word_lists
    for size in (1, 3, 7, 50):
        monkeypatch.setattr(resampling, "word_lists", lambda t, c, size=size: original(t, c, size))
        n, counts = resampling.features(text, 1, 4, 500)
        assert n == whole[0] and (counts == whole[1]).all()


def test_places_follow_the_order(spark):
    rows = spark.range(5_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 50 END AS k", "id AS one").repartition(7)
    got = common.in_order(rows, F.desc("k"), F.col("one")).collect()
    expected = sorted(got, key=lambda r: (-r["k"], r["one"]))
    assert [r["at"] for r in expected] == list(range(5_000))
    assert common.in_order(rows.limit(0), F.col("k")).count() == 0


# --- page text ------------------------------------------------------------------------------------------------------

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><!-- ad --><div class="ad-box">Buy <p>now</div>
<div role=search>Find</div><article><header><h1>The&nbsp;Title &amp;
 more</h1></header><p><b>First <i>line</i><br>goes&#32;on.<p class="share-links">Tweet<p>a &lt;b&gt; &am c</p><aside>Aside</aside>
<form><p>Mail</p></form><ul><li>One<li>Two <a href="x">link</a></ul><div hidden>no</div><section id="comments"><article>They say</article></section>
</article><div class="cookieNotice">Cookies</div><footer>&copy; us</footer></body></html>"""


def used(page: str) -> list[str]:
    lines, use, _ = pagetext.main_lines(page)
    return [line for line, u in zip(lines, use, strict=True) if u]


def test_markup_decides():
    assert used(ARTICLE) == ["The Title & more", "First line goes on.", "a <b> &am c", "One", "Two link"]
    assert used("<main><p>A</p><nav>n</nav>B</main><p>C") == ["A", "B"]
    assert used('<div id="content"><p>A<p>B</div><p>C') == ["A", "B"]
    assert used("<p>A<ul><li><a>x</a><li><a>y</a></ul><p>B <a>c</a>") == ["A", "B c"]
    assert used("plain < text & <<b>more</b>") == ["plain < text & <more"]
    assert used("<p>&am<b>p;</b> &lt<i>b&gt;&#x41;&#32;&nbsp;x") == ["&amp; <b>A x"]
    assert used("<article><p>cut off &am") == ["cut off &am"]
    assert used("<article><p>A</p><p class='x") == ["A"]
    assert used('<p title="a>b">A</p><p title="x>B') == ["A", "B"]
    assert used("<article><p>A<div aria-label=Advertisement>x</div><div aria-label='an alert of mine'>B</div><div class='site-Alert'>y</div>") == ["A", "B"]
    assert used("") == used("<!-- all") == used("<script>x") == []


MARKS = ["<!-- ", "<a ", "<html ", "<script", '<a "', "<a '\">\"", "<a ='\">\"", "<b><i>", "<div>", "<p>", "<i></b>", "<b><div></b>", "</div><b>", "<",
         "&", "<li><ul>", "<td><b>", "<!x", "</", '<p class="ad"><b>', '="', "<div id='x' class=ad>"]


@pytest.mark.parametrize("mark", MARKS)
def test_a_megabyte_of_any_mark_takes_seconds(mark):
    start = time.process_time()
    pagetext.main_lines(mark * (1_000_000 // len(mark)))
    assert time.process_time() - start < 12  # linear: some 1 to 3 s; quadratic would be minutes


def lcs(a: list, b: list) -> int:
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [40_000_000, 6])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(pagetext, "TABLE_BITS", bits)
    draw = random.Random(bits)
    for _ in range(500):
        kinds = draw.randint(1, 6)
        a, b = ([draw.randrange(kinds) for _ in range(draw.randrange(14))] for _ in range(2))
        pairs = pagetext.aligned(a, b)
        assert len(pairs) == lcs(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))


def plain_extract(rows: list[tuple]) -> dict:
    """The definition, host by host: neighbours in the order of paths, lines that enough of them share go."""
    parse = {k: pagetext.main_lines(h or "") for k, _, h in rows}
    place = lambda u: (re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "") or [None, "", ""])
    hosts: dict = {}
    for k, u, _ in rows:
        m = place(u)
        lines = tuple(parse[k][0])
        group = hosts.setdefault(m[1].lower(), {})
        if lines:
            group[lines] = min(group.get(lines, m[2]), m[2])
    out = {}
    for k, u, _ in rows:
        lines, use, marked = parse[k]
        group = hosts[place(u)[1].lower()]
        order = sorted(group, key=lambda x: (group[x], hashlib.md5("\n".join(x).encode()).hexdigest()))
        gone: set = set()
        if lines and not marked:
            i = order.index(tuple(lines))
            near = [order[j] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < len(order)]
            votes = Counter(p for n in near for p, _ in pagetext.aligned(lines, list(n)))
            gone = {p for p, v in votes.items() if v >= min(2, len(near))}
        out[k] = "\n".join(x for p, (x, keep) in enumerate(zip(lines, use, strict=True)) if keep and p not in gone)
    return out


@pytest.fixture(scope="module")
def site():
    draw = random.Random(9)
    page = lambda body, foot: f"<body><div>Home of things</div><p>Welcome</p>{body}<p>{foot}</p><div>All rights</div></body>"
    rows = []
    for i in range(60):
        body = "".join(f"<p>{' '.join(draw.choice('abcdefgh') for _ in range(6))} {i}</p>" for _ in range(draw.randrange(1, 6)))
        rows.append((i, f"http://{draw.choice(['a.com', 'a.com', 'b.org'])}/p/{draw.randrange(40)}", page(body, draw.choice(["Foot", "Other foot"]))))
    copies = [(100 + i, f"HTTP://A.com/p/{i}?q", rows[3][2]) for i in range(40)]
    alone = [(200, "http://two.net/1", page("<p>x</p>", "F")), (201, "http://two.net/2", page("<p>y</p>", "F")), (202, "http://one.net", page("<p>z</p>", "F"))]
    odd = [(300, None, "<p>no host</p>"), (301, "no scheme", "<p>no host</p><p>more</p>"), (302, "http://a.com/p/3", None), (303, "http://a.com/", ""),
           (304, "http://a.com/p/4", ARTICLE), (304, "http://a.com/p/4", ARTICLE), (None, "http://a.com/p/5", "<p>null id</p>")]
    return rows + copies + alone + odd


def test_differencing_equals_plain(spark, site):
    pages = spark.createDataFrame(site, "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as host", "3 as digest").repartition(4)
    got = pagetext.extract(pages).collect()
    expected = plain_extract(site)
    assert len(got) == len(site)
    assert {(r["row"]["page_id"], r["text"]) for r in got} == set(expected.items())
    assert any(r["n_shared"] for r in got)
    by = {r["row"]["page_id"]: r for r in got}
    assert by[200]["text"] == "x" and by[202]["text"].startswith("Home of things")
    assert by[100]["text"] == by[139]["text"] == expected[100]


def test_page_text_of_nothing(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert pagetext.extract(none).count() == 0
    only = spark.createDataFrame([("<p>a",)], "html string").selectExpr("html", "CAST(NULL AS string) AS url")
    assert [r["text"] for r in pagetext.extract(only).collect()] == ["a"]


# --- hard negatives -------------------------------------------------------------------------------------------------


def plain_negatives(rows: list[tuple], anchors, positives=5, wanted=3, low=50, high=95) -> list[tuple]:
    whole = lambda x: [math.floor(c * 256) if abs(c) < 1e300 else int(c) * 256 for c in x]
    fine = lambda x: x is not None and all(c is not None and math.isfinite(c) for c in x)
    seen = {(i, lab, tuple(x)): whole(x) for i, x, lab in rows if i is not None and lab is not None and fine(x)}
    out = []
    for (i, lab, _), q in seen.items():
        if not anchors(i):
            continue
        score = lambda v, q=q: sum(a * b for a, b in zip(v, q, strict=False))
        others = [(-score(v), j, other == lab) for (j, other, _), v in seen.items() if j != i]
        best = sorted((s, j) for s, j, same in others if same)[:positives]
        for s, j in best:
            inside = sorted((t, n) for t, n, same in others if not same and low * -s <= 100 * -t <= high * -s)
            out += [(i, j, rank, n, -s, -t) for rank, (t, n) in enumerate(inside[:wanted], start=1)]
    return sorted(out)


SHAPE = "vec_id bigint, embedding array<double>, label int"


def mined(spark, rows, **settings):
    vectors = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'x' as id", "'y' as uid", "'z' as anchor").repartition(3)
    return sorted(map(tuple, negatives.mine(vectors, F.col("vec_id") % 50 == 0, **settings).collect()))


@pytest.mark.parametrize("blocks", [(8_192, 1_024), (40, 3)])
def test_negatives_equal_plain(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", blocks[1])
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(4, 8))
    rows = [(i, (centres[i % 4] + draw.normal(size=8) * draw.choice([0.1, 1])).tolist(), int(i % 4) if i % 11 else int(i % 3)) for i in range(400)]
    rows += [(1000 + i, rows[100][1], 0) for i in range(60)] + [rows[50], rows[50]]  # ties and repeated rows
    rows += [(50, [1.0] * 8, 2), (2000, None, 1), (2001, [1.0, None] + [0.0] * 6, 1), (2002, [math.nan] * 8, 1), (2003, [math.inf] * 8, 0),
             (2050, [1.0] * 8, None), (None, [1.0] * 8, 1), (2100, [0.0] * 8, 1), (2101, [], 1), (2150, [1.0, 1.0], 2)]
    got = mined(spark, rows)
    assert got == plain_negatives(rows, lambda i: i % 50 == 0)
    assert len(got) > 60


def test_large_vectors_take_part(spark):
    """Components that no 32-bit, 64-bit or double product holds."""
    rows = [(0, [1.0, 0.0], 0), (1, [2e5, 1.0], 0), (2, [1.5e5, -7.0], 1), (3, [1e9, 3.0], 0), (4, [6e8, 0.0], 1), (5, [-1e300, 1.0], 1),
            (50, [1e9, -2e5], 2), (6, [1e5, 1e5], 2), (7, [7e4, 5e4], 1), (8, [-1e308, 1.0], 2)]
    assert mined(spark, rows) == plain_negatives(rows, lambda i: i % 50 == 0)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, [1e30], 0), (1, [1e30], 0)])


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == mined(spark, [(1, [1.0], 0)]) == mined(spark, [(0, [1.0], 0)]) == []


def test_a_block_is_rounded_once_for_all_anchors(monkeypatch):
    """Ordinary vectors need no product that rounds the whole block again; very large ones still take the unbounded way."""
    calls, plainly = [], negatives.whole_products
    monkeypatch.setattr(negatives, "whole_products", lambda *a: calls.append(1) or plainly(*a))
    draw = np.random.default_rng(2)
    raw, references = draw.normal(size=(50, 4)), np.eye(4)[:2]
    for factor, asked in ((1.0, 0), (1e150, 2)):
        calls.clear()
        big = raw * factor
        stored = dict(zip(("norms", "cosines", "sines"), negatives.angles(big, 256.0, references), strict=True))
        record = {"ids": list(range(50)), "labels": ["a", "b"] * 25, "x": big.tobytes(), **{k: np.ascontiguousarray(v).tobytes() for k, v in stored.items()}}
        block = negatives.Block(record, 4, references)
        for rows in (np.arange(50), np.array([3, 7])):
            got = block.scores(rows, big[5], 256.0).tolist()
            assert got == [sum(a * b for a, b in zip(common.whole_numbers(big[r], 256.0), common.whole_numbers(big[5], 256.0), strict=True)) for r in rows]
        assert len(calls) == asked


def test_bounds_hold():
    draw = np.random.default_rng(5)
    rows = np.concatenate([draw.normal(size=(200, 6)), draw.normal(size=(3, 6)) * 1e7, np.zeros((2, 6)), np.ones((2, 6))])
    references = negatives.reference_directions(rows[:50])
    norms, cosines, sines = negatives.angles(rows, 256.0, references)
    whole = np.floor(rows * 256)
    for i in range(len(rows)):
        low, high = negatives.score_bounds(norms[i], cosines[i], sines[i], norms, cosines, sines)
        exact = whole @ whole[i]
        assert (low <= exact).all() and (exact <= high).all()
    assert (high - low).min() < 0.5 * (norms * norms[-1]).max()


def test_negatives_same_as_sql(spark, in_duckdb, tmp_path):
    draw = np.random.default_rng(2)
    rows = [(i, (np.eye(10)[i % 10] + draw.normal(size=10) * 0.4).astype("float32").tolist(), i % 10 if i % 13 else None) for i in range(300)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = queries.op13_hard_negatives(spark, str(tmp_path))
    columns, expected = in_duckdb(queries.LLM_ORACLES["op13_hard_negatives"], embeddings=spark.read.parquet(str(tmp_path / "embeddings.parquet")))
    assert columns == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(expected) and expected
