"""Scoring, archives, mixing, vectors and URL rules against plain versions, on rows that ordinary data lacks."""

from __future__ import annotations

import math
import random
import re
import sys
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402
from larkspur.llm import bitslice, common, epsilon, graph, lm_score, mixing, queries, urls, warc  # noqa: E402

# --- language-model scores ----------------------------------------------------------------------------------------


def plain_scores(rows: list[tuple], role: dict) -> list[float | None]:
    def fit(texts):
        c = Counter()
        for t in texts:
            s = "\0\0" + (t or "")
            c.update(s[k : k + 3] for k in range(len(s) - 2))
        return c

    every, target = fit(t for k, t in rows if role[k, t] == 2), fit(t for k, t in rows if role[k, t] == 1)
    kinds = len({g[2] for g in fit(t for _, t in rows)})

    def model(c):
        two, one, ab, b, kab, kb = (Counter() for _ in range(6))
        for g, n in c.items():
            two[g[1:]] += n
            ab[g[:2]] += n
            kab[g[:2]] += 1
        for g, n in two.items():
            one[g[1]] += n
            b[g[0]] += n
            kb[g[0]] += 1

        def p(g):
            p1 = (one[g[2]] + 1) / (sum(one.values()) + kinds)
            p2 = (two[g[1:]] + kb[g[1]] * p1) / (b[g[1]] + kb[g[1]]) if b[g[1]] else p1
            return (c[g] + kab[g[:2]] * p2) / (ab[g[:2]] + kab[g[:2]]) if ab[g[:2]] else p2

        return p

    of_target, of_every, out = model(target), model(every), []
    for _, t in rows:
        s = "\0\0" + (t or "")
        g = [s[k : k + 3] for k in range(len(s) - 2)]
        out.append(sum(math.log2(of_every(x) / of_target(x)) for x in g) / len(g) if g else None)
    return out


def roles(frame, good, groups: int = 5) -> dict:
    """1 for rows of the target, 2 for rows of the background, 0 for others, by id and text."""
    dealt, target = lm_score.deal(frame, good, "doc_id", "text", groups)
    wanted = set(map(tuple, target.collect()))
    rows = dealt.select("row.doc_id", "row.text", "drawn", "grp").collect()
    return {(r.doc_id, r.text): 1 if (r.doc_id, r.grp) in wanted else 2 if r.drawn else 0 for r in rows}


@pytest.mark.parametrize("target", [[1, 2, 2, None, 99, 5], []])
def test_scores_equal_the_plain_version(spark, docs, target):
    texts = [None, "", "the cat sat", "the cat ran", "zebra zebra", "日本語 text", "a", "the cat sat", "cab " * 200]
    keyed = dict(enumerate(texts)) | {None: "the null cat"}
    frame = docs(keyed, extra=True).union(docs({3: "again the cat"}, extra=True))
    rows = [*keyed.items(), (3, "again the cat")]
    good = spark.createDataFrame([(k,) for k in target], "doc_id bigint")
    got = lm_score.score(frame, good, group_bytes=40).select("row.doc_id", "row.text", "n_tokens", "score").collect()
    show = lambda x: None if x is None else round(x, 8)
    role = roles(frame, good)
    assert all((role[k, t] == 1) == (k in set(target) - {None}) for k, t in rows)
    assert target or set(role.values()) == {0}
    want = Counter((k, t, len(t or ""), show(s)) for (k, t), s in zip(rows, plain_scores(rows, role), strict=True))
    assert Counter((r.doc_id, r.text, r.n_tokens, show(r.score)) for r in got) == want
    assert lm_score.score(frame.where("false"), good).count() == 0


def test_background_matches_the_target_in_size(spark):
    rows = [(i, f"text number {i} " * (1 + i % 5)) for i in range(4_000)] + [(i % 3, f"one id on many rows {i}") for i in range(1_000)]
    frame, good = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.range(500).selectExpr("id * 3 + 1 AS doc_id")
    sizes = Counter()
    for (_, text), role in roles(frame, good).items():
        sizes[role] += len(text)
    assert abs(sizes[2] / sizes[1] - 1) < 0.15
    assert 0 not in roles(frame, spark.range(3_900).selectExpr("id AS doc_id")).values()  # less other text than target: all of it


def test_one_id_on_many_rows_is_spread_over_the_groups(spark):
    rows = spark.range(3_000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "concat('text ', id) AS text")
    sizes = [r["count"] for r in rows.groupBy(common.group_of("doc_id", "text", 16)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.4 * 3_000 / 16


# --- web archive records ------------------------------------------------------------------------------------------

HTML = (
    '<!DOCTYPE html><html lang="de-AT"><head><title>A &amp; <b>B</b>\n C</title><style>p{}</style></head><body><!-- x <a href="no"> -->'
    '<h1>Head</h1><p>one&nbsp;two &lt;3</p><script>var a = "<a href=\'no\'>";</script><ul><li><a class=x href="/p?a=1&amp;b=2">link</a>'
    "<li><A HREF='http://x.org/'>two</A></ul> a < b <br/>end"
)
PAGES = [(1, "http://a.org/x", HTML), (2, None, None), (3, "", ""), (4, "http://b.org/\r\nX: y", "<p>un<b>closed"), (None, "http://c", "plain"), (1, "http://a.org/x", HTML)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(2)


def test_records_equal_the_sql(spark, pages, in_duckdb, tmp_path):
    folder = str(tmp_path / "in")
    pages.selectExpr("*", "'x' as record", "'y' as content").write.parquet(f"{folder}/pages.parquet")
    ours = queries.LLM_QUERIES["op4_warc_derivatives"](spark, folder)
    names, rows = in_duckdb(queries.LLM_ORACLES["op4_warc_derivatives"], pages=pages)
    assert Counter(map(tuple, ours.select(*names).collect())) == Counter(rows) and len(rows) == 12
    assert warc.derivatives(warc.responses(pages.where("false"))).count() == 0


def test_text_and_links_of_a_page(pages):
    made = {r.record_type: r for r in warc.derivatives(warc.responses(pages.where("page_id = 1"))).collect()}
    assert made["conversion"].content == "Head\none two <3\nlink\ntwo\na < b\nend"
    fields = made["metadata"].content.split("\r\n")
    assert fields[:2] == ["title: A & B C", "language: de-AT"] and fields[-3:] == ["outlink: /p?a=1&b=2", "outlink: http://x.org/", ""]
    assert made["metadata"].refers_to == made["conversion"].refers_to != made["conversion"].record_id


def test_written_files_are_valid(pages, tmp_path):
    records = warc.derivatives(warc.responses(pages))
    warc.write(records, str(tmp_path / "warc"))
    found = Counter()
    for path in (tmp_path / "warc").glob("part-*"):
        data = path.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            n = int(fields["Content-Length"])
            assert lines[0] == "WARC/1.1" and rest[n : n + 4] == b"\r\n\r\n"
            found[fields["WARC-Record-ID"], fields["WARC-Refers-To"], rest[:n].decode()] += 1
            data = rest[n + 4 :]
    assert found == Counter((r.record_id, r.refers_to, r.content) for r in records.collect())


MARKS = ["<!-- a ", "<html ", "<a ", '<a href="x" ', "<a href ", "<script", "<script>", "<title ", "<title>", "</title  ", "<style><!--", "<p", "<p ", "&lt;",
         "<", ">", " \n", "<html lang", "<a href=", "<!-- --"]


@pytest.mark.parametrize("mark", MARKS)
def test_a_megabyte_of_any_mark_takes_seconds(mark):
    start = time.process_time()
    warc.read_page(mark * (1_000_000 // len(mark)))
    assert time.process_time() - start < 6  # linear: under two seconds on an idle core


def test_pages_by_hand():
    """Title, language, links and text as a reader of the page would give them."""
    page = ('<!-- <html lang="xx"> --><HTML class=x lang = "pt-BR"><title>A &lt;b&gt;\n c</title><style>p</style><body><p>One&nbsp;two<br>three'
            '<A class=q href=\'/x?a&amp;b\'>link</a><script>var a = "<a href=\\"no\\">";</script> x < y <!-- gone --> z<li>four')  # fmt: skip
    title, language, links, text = warc.read_page(page)
    assert (title, links, text) == ("A <b> c", ["/x?a&b"], "One two\nthreelink x < y z\nfour")
    assert language == "xx"  # of the first tag, as the patterns of the records have it
    assert warc.read_page("<title>open <p>a<a href='1' <a href='2'>b<!-- open") == ("", "", ["1", "2"], "open\nab<!-- open")
    assert warc.read_page("") == ("", "", [], "")


# --- mixing -------------------------------------------------------------------------------------------------------


def test_period_is_within_a_block_of_its_targets():
    rng = random.Random(2)
    for _ in range(40):
        parts = {f"s{i}": rng.randrange(1, 40) for i in range(rng.randrange(1, 9))}
        total, had = sum(parts.values()), Counter()
        for s, k, slot in mixing.period(parts):
            assert k == had[s] and k * total // parts[s] <= slot < -(-(k + 1) * total // parts[s])
            had[s] += 1
            assert all(abs(had[x] - (slot + 1) * p / total) < 1 for x, p in parts.items())
        assert had == Counter(parts)


@pytest.mark.parametrize("bucket_rows", [50_000, 10])
def test_mix_places_every_document_once(spark, bucket_rows):
    sizes = {"hot": 300, "mid": 70, "low": 11, None: 9}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)] + [(1, "hot"), (None, "hot")]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string").selectExpr("*", "1 as block", "2 as slot").repartition(3)
    shares = mixing.tempered_parts(frame, least=50, per_source=2)
    parts = {r.s: r.parts for r in shares.collect()}
    placed = mixing.interleave(frame, shares, block=4, bucket_rows=bucket_rows).select("row.doc_id", "row.source", "block", "slot", "place").collect()
    assert Counter((r.doc_id, r.source) for r in placed) == Counter(rows)
    assert len({(r.slot, r.place) for r in placed}) == len(rows)
    own = defaultdict(list)
    for r in sorted(placed, key=lambda r: (r.slot, r.place)):
        own[r.source].append((r.block, r.place))
    name = lambda s: "" if s is None else f"={s}"
    total, slots = sum(parts.values()), {(r.source, r.block): r.slot for r in placed}
    for source, got in own.items():
        assert got == [(i // 4, i % 4) for i in range(len(got))]
        p = parts[name(source)]
        assert all(k * total // p <= slots[source, k] < -(-(k + 1) * total // p) for k in range(got[-1][0] + 1))
    assert mixing.interleave(frame.where("false"), {}).count() == 0
    with pytest.raises(Exception, match="no parts"):
        mixing.interleave(frame, {"=hot": 1}).collect()


def plain_parts(sizes: dict, power: float = 0.7) -> dict:
    total, whole = max(1_000, 100 * len(sizes)), sum(n**power for n in sizes.values())
    return {s: max(1, math.floor(n**power * total / whole + 0.5)) for s, n in sizes.items()}


@pytest.mark.parametrize("n", [10, 1_000, 10_000])
def test_a_third_stays_a_third_with_many_sources(spark, n):
    """Every other source has one document; the hot one as many as give it a third of the tempered weight."""
    hot = round(((n - 1) / 2) ** (1 / 0.7))
    frame = spark.range(n - 1).selectExpr("concat('s', id) AS source").union(spark.range(hot).selectExpr("'hot' AS source"))
    shares = mixing.tempered_parts(frame)
    parts = {r.s[1:]: r.parts for r in shares.collect()}
    assert parts == plain_parts({"hot": hot, **{f"s{i}": 1 for i in range(n - 1)}})
    assert abs(parts["hot"] / sum(parts.values()) - 1 / 3) < 0.01
    if n == 1_000:
        slots = mixing.schedule(shares).collect()
        total = sum(parts.values())
        assert sorted(r["first"] for r in slots) == list(range(total)) and Counter(r["s"][1:] for r in slots) == Counter(parts)
        assert all(r["k"] * total // parts[r["s"][1:]] <= r["first"] < -(-(r["k"] + 1) * total // parts[r["s"][1:]]) for r in slots)


def plain_schedule(parts: dict) -> dict:
    """Slot by slot: of the blocks released by then, the one with the earliest deadline, ties by source."""
    total, had, out = sum(parts.values()), Counter(), {}
    for slot in range(total):
        able = [(-(-(had[s] + 1) * total // p), s) for s, p in parts.items() if had[s] < p and had[s] * total // p <= slot]
        s = min(able)[1]
        out[s, had[s]] = slot
        had[s] += 1
    return out


def test_mixing_query_equals_plain(spark, tmp_path):
    """op5 over a whole table: the order inside a source is a shuffle, everything else follows from the sizes."""
    sizes = {"web": 700, "books": 90, "code": 33, None: 5}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    spark.createDataFrame(rows, "doc_id bigint, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op5_pfair_mixing(spark, str(tmp_path)).collect()
    name = lambda s: "" if s is None else f"={s}"
    parts = plain_parts({name(s): n for s, n in sizes.items()})
    slots, total = plain_schedule(parts), sum(parts.values())
    want = Counter()
    for s, n in sizes.items():
        p = parts[name(s)]
        for i in range(n):
            block = i // 32
            want[s, block, block // p * total + slots[name(s), block % p], i % 32] += 1
    assert Counter((r.source, r.block, r.slot, r.place) for r in got) == want
    assert {(r.doc_id, r.source) for r in got} == set(rows) and len(got) == len(rows)


# --- vectors ------------------------------------------------------------------------------------------------------


def usable(v) -> bool:
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def awkward_vectors(seed: int, n: int, dims: int) -> list[tuple[int | None, list | None]]:
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)) * 0.2
    base[n // 2 : n // 2 + n // 5] = base[0]  # exact copies
    base[-n // 5 :] = base[1] + rng.normal(size=(n // 5, dims)) * 0.012  # near copies
    rows: list[tuple[int | None, list | None]] = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(n, None), (n + 1, [0.0] * dims), (n + 2, [math.nan] * dims), (n + 3, [1.0, None] + [0.0] * (dims - 2)), (n + 4, [math.inf] * dims)]
    return [*rows, rows[0], (None, rows[1][1]), (n + 5, [1e-30] + [0.0] * (dims - 1)), (n + 6, [1.0]), (-7, [2.0] + [0.0] * (dims - 1))]


VECTORS = "vec_id bigint, embedding array<double>"


@pytest.mark.parametrize(("n", "blocks"), [(120, (8_192, 1_024)), (150, (32, 8))])
def test_top_rows_equal_brute_force(spark, monkeypatch, n, blocks):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(bitslice, "BLOCK_QUERIES", blocks[1])
    rows = awkward_vectors(n, n, 6)
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as id", "'y' as q", "1 as label").repartition(3)
    got = bitslice.search(frame, frame.where("vec_id % 7 = 0"), k=5).collect()
    known = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and usable(v)}
    want = set()
    for i, q in known:
        if i % 7 == 0:
            dot = lambda v, q=q: sum(a * b for a, b in zip(q, v, strict=False))
            best = sorted(((-dot(v), j) for j, v in known if j != i))[:5]
            want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_large_vectors_are_found(spark):
    """Components whose products 32 bits, 64 bits or doubles do not hold, beside small ones and in signs of both kinds."""
    rows = [(0, [0.5, 0.5]), (50, [0.25, -1.0]), (1, [1.0, 1.0]), (2, [2e5, 0.0]), (3, [1e9, -2e5]), (4, [-1e9, 7.0]), (5, [3.0, -1e12]),
            (6, [0.001, 2e5]), (7, [-1e300, 1e-3]), (8, [2e5 + 1 / 512, 0.0]), (9, [2e5, -1 / 512]), (8, [2e5 + 3 / 512, 0.0])]
    frame = spark.createDataFrame(rows, VECTORS)
    whole = lambda v: [math.floor(256 * x) for x in v]
    want = set()
    for i, q in rows[:2]:
        best = sorted((-sum(a * b for a, b in zip(whole(q), whole(v), strict=True)), j) for j, v in rows if j != i)[:9]
        want |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    got = bitslice.search(frame, frame.where("vec_id % 50 = 0"), k=9).collect()
    assert {tuple(r) for r in got} == want and len(got) == 18
    with pytest.raises(Exception, match="64 bits"):
        bitslice.search(spark.createDataFrame([(0, [1e30]), (1, [1e30])], VECTORS), frame.where("vec_id = 0")).collect()


def test_top_rows_of_few_or_no_vectors(spark):
    two = spark.createDataFrame([(0, [1.0, -1.0]), (1, [0.5, 0.5])], VECTORS)
    assert [tuple(r) for r in bitslice.search(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 0)]
    assert bitslice.search(two.where("false"), two).count() == bitslice.search(two, two.where("false")).count() == 0


@pytest.mark.parametrize(("n", "block"), [(90, 4_096), (900, 64)])
def test_vector_links_equal_brute_force(spark, monkeypatch, n, block):
    monkeypatch.setattr(epsilon, "LEAF", 16)
    rows = awkward_vectors(n, n, 5)
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' as id", "'y' as sound", "1 as label").repartition(3)
    got = epsilon.near_duplicates(frame, block=block).collect()
    once = list(dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows if v is None or not any(x != x for x in v if x is not None)))
    sound = [(i, v) for i, v in once if i is not None and usable(v) and any(v)]
    x = np.array([list(v) + [0.0] * (5 - len(v)) for _, v in sound])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    label = plain.smallest_reachable([i for i, _ in sound], lambda i, j: near[i, j])
    want = Counter((i, int(k), c, i == c) for (i, _), k, c in zip(sound, near.sum(axis=1), label, strict=True))
    want += Counter((i, 0, i, True) for i, v in once if (i, v) not in sound) + Counter({(n + 2, 0, n + 2, True): 1})
    assert Counter(map(tuple, got)) == want
    assert epsilon.near_duplicates(frame.where("false")).count() == epsilon.near_duplicates(frame.where("embedding is null")).count() - 1 == 0


def test_vector_links_equal_the_sql(spark, in_duckdb, tmp_path):
    rows = [(i, v, 0) for i, v in dict(awkward_vectors(300, 7, 5)).items() if i is not None and (v is None or len(v) == 5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    ours = queries.LLM_QUERIES["op8_epsilon_grid"](spark, str(tmp_path))
    names, want = in_duckdb(queries.LLM_ORACLES["op8_epsilon_grid"], embeddings=frame)
    assert Counter(map(tuple, ours.select(*names).collect())) == Counter(want) and any(n for _, n, _, _ in want)


@pytest.mark.parametrize("hot_links", [50_000, 4])
def test_components_of_paths_stars_and_rings(spark, hot_links):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links += [(5, 4), (7, 7), (None, 3), (300, None), (999, 400), (400, 500)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(links, "a bigint, b bigint"), hot_links).collect()))
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {200 + i: 200 for i in range(9)} | {999: 400, 400: 400, 500: 400}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- URL rules ----------------------------------------------------------------------------------------------------

ADDRESSES = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://example.com/en", "http://example.com/en/",
    "http://notexample.com/en/", "http://a.b.example.com/en/1", "x://www.example.com.evil.net/es/", "http://net/fr/", "http://example.net:80/fr/",
    "http://com/en/", "http://u@example.com/en/", "http://exa,mple.com/", "http://example.com#/en/", "http://a//b://c/en/", "http://É.com/", "http://.com/x",
    "http://x\n.com/en/\n1", "http://example.com./en/",
]


def test_verdicts_equal_the_sql(spark, in_duckdb, tmp_path):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(ADDRESSES * 2)] + [(None, "http://x.net/es/")], "page_id bigint, url string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    ours = queries.LLM_QUERIES["op9_url_filters"](spark, str(tmp_path))
    names, rows = in_duckdb(queries.LLM_ORACLES["op9_url_filters"], pages=frame)
    assert Counter(map(tuple, ours.select(*names).collect())) == Counter(rows)


def test_many_nested_rules_equal_brute_force(spark):
    rng = random.Random(8)
    label, part = lambda: rng.choice(["a", "b", "ab", "c"]), lambda: rng.choice(["/", "/x", "/x/", "/x/y/", "/z/", ""])
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 5)))
    rules = {(host(), part()): rng.choice(["allow", "block"]) for _ in range(120)}
    pages = [(i, f"http://{host()}{part()}{rng.choice(['', 'y/', '?q'])}") for i in range(600)]
    table = [(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block"), ("", "/", "block")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string").selectExpr("*", "1 as host", "2 as key", "3 as salt", "4 as stack").repartition(3)
    got = urls.judge(frame, spark.createDataFrame(table, "host string, path string, verdict string"), salts=3)
    for r in got.select("row.url", "host", "path", "rule", "verdict").collect():
        fit = [(len(h + p), len(h), h + p, v) for (h, p), v in rules.items() if ("." + r.host).endswith("." + h) and r.path.startswith(p)]
        assert (r.rule, r.verdict) == (max(fit)[2:] if fit else (None, "allow")), r
    assert got.count() == 600
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in urls.judge(frame, none).collect()} == {"allow"} and urls.judge(frame.where("false"), none).count() == 0


def test_url_rules_stay_in_the_engine(spark, tmp_path, capsys):
    spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    queries.LLM_QUERIES["op9_url_filters"](spark, str(tmp_path)).explain()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", capsys.readouterr().out)


def test_many_rules_of_one_host(spark):
    """100,000 path rules of one host, nested and apart: no row carries more of them than it lies in."""
    draw = random.Random(8)
    paths = list({f"/{draw.randrange(300)}/{draw.randrange(400)}" + draw.choice(["", "/", f"/{draw.randrange(9)}"]) for _ in range(130_000)})[:100_000]
    table = [("big.org", p, "block" if len(p) % 2 else "allow") for p in paths] + [("org", "/1", "block"), ("www.big.org", "/2", "allow")]
    rules = spark.createDataFrame(table, "host string, path string, verdict string")
    urls_ = [f"http://{draw.choice(['big.org', 'www.big.org', 'x.org'])}/{draw.randrange(310)}/{draw.randrange(410)}/{draw.randrange(12)}/z" for _ in range(2_000)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls_)], "page_id int, url string")
    known = {(h, p): v for h, p, v in table}
    got = urls.judge(pages, rules, salts=2).collect()
    assert len(got) == len(urls_) and sum(r.rule is not None for r in got) > 500
    for r in got:
        host, path = re.match(r"http://([^/]*)(.*)", r.row.url).groups()
        fits = [(len(h + p), len(h), h + p, known[h, p]) for h in ("org", "big.org", "www.big.org") if f".{host}".endswith(f".{h}")
                for p in (path[:n] for n in range(len(path) + 1)) if (h, p) in known]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r.rule, r.verdict) == best[2:], r.row.url
    widest = urls._path_stacks(rules.selectExpr("concat(array_join(reverse(split(host, '[.]')), '.'), '.') AS key", "path", "concat(host, path) AS rule", "verdict"))
    assert widest.agg(F.max(F.size("stack"))).first()[0] <= 8


@pytest.mark.parametrize("axes", [1, 2, 4])
def test_near_blocks_are_those_within_reach(spark, axes):
    draw = np.random.default_rng(axes)
    low = draw.uniform(-1, 0.8, (120, axes))
    high = low + draw.uniform(0, 0.5, (120, axes))
    cut = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(low, high, strict=True))], "blk bigint, low array<double>, high array<double>")
    got = sorted(map(tuple, epsilon.near_blocks(cut, 0.2, axes).collect()))
    gap = lambda i, j: np.maximum(0, np.maximum(low[i] - high[j], low[j] - high[i]))
    assert got == [(i, j) for i in range(120) for j in range(i, 120) if gap(i, j) @ gap(i, j) <= 0.04]
