"""Language, fingerprints, passages and tokens against plain Python, on rows that ordinary data lacks."""

from __future__ import annotations

import random
import sys
import time
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import plain  # noqa: E402
from larkspur.llm import bpe, langid, queries, simhash, substrings  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [None, "", "  \t\n ", "12 34 !?", "a", "A b", "ß É 日本語 テキスト", "x y z", "word " * 30, "é \U0001f600 𝒜𝒷"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# --- language -----------------------------------------------------------------------------------------------------

LANGS = {
    "de": "der die das und nicht ist ein eine zu den mit sich des auf für im dem von wird aber auch noch werden durch",
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec aux ou être",
}


@pytest.fixture(scope="module")
def spoken(spark):
    rng, rows = random.Random(1), []
    for i in range(90):
        lang = sorted(LANGS)[i % 3]
        rows.append((i, " ".join(rng.choices(LANGS[lang].split(), k=rng.randrange(4, 120))), lang))
    rows += [(100 + i, t, "en" if i % 2 else None) for i, t in enumerate(ODD)]
    rows += [(None, "the and of", "en"), (5, rows[5][1], rows[5][2]), (200, "der the die and", None), (201, "the " * 40_000, "en")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)


def test_languages_equal_the_plain_version(spoken):
    rows, frame = spoken
    got = langid.identify_all(frame).select("row.*", "lang_pred", "score").collect()
    want = Counter((*r, lang, round(score, 9)) for r, (lang, score) in zip(rows, plain.languages(rows), strict=True))
    assert Counter((r.doc_id, r.text, r.lang, r.lang_pred, round(r.score, 9)) for r in got) == want
    held = frame.select("doc_id", langid.held_out().alias("h")).collect()
    assert all(r.h == plain.held_out(r.doc_id) for r in held)


def test_language_and_source_are_no_inputs_of_a_prediction(spoken):
    _, frame = spoken
    known = langid.profiles(frame.where(~langid.held_out()))
    other = frame.withColumn("lang", F.lit("de")).withColumn("doc_id", F.lit(1))
    said = [Counter(map(tuple, langid.identify(f, known).select("row.text", "lang_pred").collect())) for f in (frame, other)]
    assert said[0] == said[1]


def test_language_without_rows_or_teachers(spark, docs):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert langid.identify_all(empty).count() == 0
    untaught = docs(["the and of", None]).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify_all(untaught).collect()} == {("und", 0.0)}
    kept = langid.recognised(docs(["the and of the", None, "12", "und so the"], extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3] and len(kept.columns) == 16


# --- fingerprints -------------------------------------------------------------------------------------------------


def test_fingerprints_and_components_equal_the_plain_version(docs):
    texts = list(ODD)
    for seed in range(8):
        words = prose(seed, 600).split()
        texts.append(" ".join(words))
        for k in range(6):  # near copies: some words changed
            copy = list(words)
            for at in random.Random(100 * seed + k).sample(range(600), k):
                copy[at] = f"changed{k}"
            texts.append(" ".join(copy))
    texts += [texts[12].upper(), texts[12], "one two", "ONE\ttwo", prose(77, 30_000)]
    table = dict(enumerate(texts)) | {}
    frame = docs(table, extra=True).unionByName(docs({None: texts[12]}, extra=True)).unionByName(docs({12: texts[12]}, extra=True))
    got = simhash.near_duplicates(frame).collect()
    keys, all_texts = [*table, None, 12], [*texts, texts[12], texts[12]]
    prints = [plain.simhash(t) for t in all_texts]
    label = plain.smallest_reachable(keys, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    assert Counter((r.key, r.fp % 2**64, r.component) for r in got) == Counter(zip(keys, prints, label, strict=True))
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label) - {None})


def test_copies_without_a_key_leave_one(docs, spark):
    frame = docs({None: "same text here now"}).union(docs({None: "same text here now"})).union(docs({4: None, 3: ""}))
    assert sorted((r.doc_id is None, r.doc_id) for r in simhash.keep_first(frame).collect()) == [(False, 3), (True, None)]
    assert simhash.near_duplicates(docs([]).where("false")).count() == 0


@pytest.mark.parametrize("file_rows", [2_048, 40])
def test_links_connect_what_two_bits_connect(spark, file_rows):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(3):
        base = rng.getrandbits(64)  # many near one, so that files are large
        prints |= {base ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(64)) for _ in range(150)} | {base}
    prints |= {0, 2**64 - 1, 2**63, 1, 3, 7}
    prints = sorted(p - 2**64 if p >> 63 else p for p in prints)
    linked = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp bigint"), file_rows=file_rows).collect()
    close = lambda a, b: ((a ^ b) % 2**64).bit_count() <= 2
    want = plain.smallest_reachable(prints, lambda i, j: close(prints[i], prints[j]))
    pairs = {(r.a, r.b) for r in linked} | {(r.b, r.a) for r in linked}
    assert plain.smallest_reachable(prints, lambda i, j: (prints[i], prints[j]) in pairs) == want


# --- repeated passages --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("group_bytes", [8_000_000, 3_000])
def test_passages_equal_the_plain_version(docs, group_bytes):
    shared = [prose(500 + k, 50) for k in range(4)]
    texts = [*ODD, prose(1, 34), prose(2, 35), prose(2, 35), prose(3, 36), f"{prose(4, 20)} {shared[0]} \n\n{prose(5, 20)}"]
    texts += [f"{shared[0]}\t{prose(6, 10)}", f"{shared[1]} {shared[1]}", f"lead {shared[2]}", f"{shared[2]} tail", shared[3]]
    texts += [f"  {shared[3]}  end ", "ba " * 40, "ba " * 200, "x" * 5_000, f"{prose(9, 20_000, 10**6)} {shared[1]}"]
    texts += [f"{prose(40 + k, 30)} {shared[k % 3]} {prose(60 + k, 30)}" for k in range(12)]
    frame = docs(dict(enumerate(texts)) | {None: texts[14]}, extra=True)
    texts.append(texts[14])
    keys = [*range(len(texts) - 1), None]
    gone = plain.covered(texts, 35)
    words = [plain.WORD.findall(t or "") for t in texts]
    got = substrings.cut_repeats(frame, group_bytes=group_bytes).select("row.doc_id", "n_words", "spans", "kept").collect()
    assert Counter((r.doc_id, r.n_words, sum(s.stop - s.begin for s in r.spans), r.kept) for r in got) == Counter(
        (k, len(w), sum(g), " ".join(x for x, y in zip(w, g, strict=True) if not y)) for k, w, g in zip(keys, words, gone, strict=True)
    )
    for r in got:  # spans are maximal
        assert all(a.stop < b.begin for a, b in zip(r.spans, r.spans[1:], strict=False)) and all(s.begin < s.stop for s in r.spans)
    laid = substrings.cut_repeats(frame, layout=True, group_bytes=group_bytes).select("row.doc_id", "kept").collect()
    assert Counter(map(tuple, laid)) == Counter((k, None if t is None else plain.cut_layout(t, g)) for k, t, g in zip(keys, texts, gone, strict=True))


def test_passages_equal_the_sql(spark, docs, in_duckdb, tmp_path):
    shared = prose(500, 50)
    texts = [*ODD, prose(1, 34), prose(2, 35), prose(2, 35), f"{shared} {shared}", f"a {shared}", "ba " * 200, f"{prose(9, 3_000, 10**6)} {shared}"]
    frame = docs(texts).union(docs({3: f"again {shared}", None: "no id"}))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    ours = queries.LLM_QUERIES["op6_substring_dedup"](spark, str(tmp_path))
    names, want = in_duckdb(queries.LLM_ORACLES["op6_substring_dedup"], documents=frame)
    assert Counter(map(tuple, ours.select(*names).collect())) == Counter(want) and any(r[2] for r in want)


def test_passages_of_no_documents(docs):
    assert substrings.cut_repeats(docs([]).where("false")).count() == 0


# --- tokens -------------------------------------------------------------------------------------------------------


def strange_texts() -> list[str | None]:
    rng = random.Random(5)
    ranks = bpe.read_ranks(RANKS)
    tokens = [t for t in ranks if len(t) > 1]
    both = [t for t in tokens if any(t[:i] in ranks and t[i:] in ranks and t.startswith(t[i:]) for i in range(1, len(t)))]
    out: list[str | None] = [*ODD, "don't we'll I'VE", "<|endoftext|>", "a\r\n\r\n  b   c", "x" * 3_000, "\x00\x7f\x80", "-" * 77, "=" * 50 + " " * 40 + "\n" * 9]
    for _ in range(300):  # overlapping places where one token could form in two ways
        t = rng.choice(both)
        out.append((b"".join(rng.choice([t, t[: rng.randrange(1, len(t))], t[-1:]]) for _ in range(6))).decode("utf-8", "ignore"))
    for _ in range(200):
        out.append(b"".join(rng.choices(tokens, k=8)).decode("utf-8", "ignore"))
        out.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x3000), rng.randrange(0x10000, 0x1FFFF)])) for _ in range(20)))
    return out


def test_tokens_equal_the_reference_library(spark, docs):
    texts = strange_texts()
    frame = docs(texts, extra=True)
    encoded = bpe.encode(frame, RANKS, public_tokenizers.PATTERN, offsets=True)
    reference = plain.tokenizer()
    for r in encoded.select("row.doc_id", "ids", "begins", "stops").collect():
        text = texts[r.doc_id] or ""
        assert list(r.ids) == reference.encode_ordinary(text), text
        for token, begin, stop in zip(r.ids, r.begins, r.stops, strict=True):
            assert reference.decode_single_token_bytes(token) in text[begin:stop].encode()
    once = bpe.encode(frame, RANKS, public_tokenizers.PATTERN, back=True).select("row.doc_id", "bytes").collect()
    assert all(bytes(r.bytes).decode() == (texts[r.doc_id] or "") for r in once) and len(once) == len(texts)
    back = bpe.decode(encoded.select("row.doc_id", "ids"), RANKS).select("row.doc_id", "bytes").collect()
    assert all(bytes(r.bytes).decode() == (texts[r.doc_id] or "") for r in back) and len(back) == len(texts)


def test_split_characters_and_missing_ids(spark):
    text = "日本 🙂"
    ids = plain.tokenizer().encode_ordinary(text)
    rows = spark.createDataFrame([(0, ids[:1]), (1, ids[1:]), (2, None), (3, [])], "n int, ids array<int>")
    got = {r.n: bytes(r.bytes) for r in bpe.decode(rows, RANKS).select("row.n", "bytes").collect()}
    assert got[0] + got[1] == text.encode() and got[2] == got[3] == b""
    assert bpe.encode(spark.createDataFrame([], "text string"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_table_and_its_reverse():
    characters, back = bpe.byte_characters(), bpe.character_bytes()
    assert len(set(characters)) == len(back) == 256 and all(c.isprintable() and not c.isspace() for c in characters)
    assert [back[c] for c in characters] == list(range(256))
    assert [characters[b] for b in b"A!~ \n\x00"] == ["A", "!", "~", "\u0120", "\u010a", "\u0100"]
    ranks = {bytes([b]): b for b in range(256)} | {"é".encode(): 256, "\U0001f600".encode()[:2]: 257}
    assert bpe.token_characters(ranks)[256:] == ["Ã©", "ð\u0141"]
    assert bpe._token_table(ranks)[257] + bpe._token_table(ranks)[0x98] == b"\xf0\x9f\x98"


@pytest.mark.parametrize("buckets", [64, 51_031])
def test_lookup_of_windows_takes_one_search_whatever_the_buckets(buckets):
    draw = np.random.default_rng(buckets)
    hashes, places = np.sort(draw.integers(0, 2**62, 100_000, np.uint64)), draw.integers(0, buckets, 100_000)
    hashes[5_000:5_003] = hashes[5_000]  # one hash in three places
    pick = draw.integers(0, 100_000, 80_000)
    wanted, at = hashes[pick].copy(), places[pick].copy()
    at[::2] = draw.integers(0, buckets, len(at[::2]))
    wanted[::5] = draw.integers(0, 2**62, len(wanted[::5]), np.uint64)
    start = time.process_time()
    found = substrings._known(hashes, places, wanted, at)
    assert time.process_time() - start < 0.5
    pairs = set(zip(hashes.tolist(), places.tolist(), strict=True))
    assert found.tolist() == [p in pairs for p in zip(wanted.tolist(), at.tolist(), strict=True)]
    assert not substrings._known(hashes[:0], places[:0], wanted, at).any()
