"""The whole pipeline against a plain Python version, stage by stage and end to end."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
import plain  # noqa: E402
from larkspur.llm import queries  # noqa: E402

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, note string"
WORDS = {"en": "the of and to in is that for it as was with be by on not he this are or his from at which",
         "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il"}


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    rng, out = random.Random(4), []
    passage = " ".join(rng.choices(WORDS["en"].split(), k=60))
    for i in range(60):
        lang = ("en", "fr")[i % 2]
        text = " ".join(f"{w}{rng.choice(['', 's', 'ed'])}" for w in rng.choices(WORDS[lang].split(), k=rng.randrange(20, 160)))
        text = f"{text}\n\n{passage}  {text[::2]}" if i % 7 == 0 else text
        out.append([i, text, lang, f"src{i % 3 if i % 5 else 0}"])
    long = " ".join(rng.choices(WORDS["fr"].split(), k=2_000))
    out += [[60, out[3][1], "fr", "src1"], [61, out[3][1].upper(), "fr", None], [62, long + " un", "fr", "src2"], [63, long, "fr", "src2"]]
    out += [[64, None, "en", "src0"], [65, "", None, "src0"], [66, "123 !", "en", "src1"], [67, "the and of", None, "src1"], [60, out[3][1], "fr", "src1"]]
    return [(*r, len(r[1] or ""), f"note {r[0]}") for r in out]


def expected(rows: list[tuple]) -> list[list[tuple]]:
    """Rows after each of the first four stages."""
    told = plain.languages([r[:3] for r in rows])
    first = [r for r, (lang, score) in zip(rows, told, strict=True) if lang != "und" and score > 0]
    prints = [plain.simhash(r[1]) for r in first]
    label = plain.smallest_reachable([r[0] for r in first], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    second = sorted({r for r, least in zip(first, label, strict=True) if r[0] == least})
    gone = plain.covered([r[1] for r in second], 35)
    third = []
    for r, g in zip(second, gone, strict=True):
        text = plain.cut_layout(r[1], g) if any(g) else r[1]
        third.append((r[0], text, r[2], r[3], len(text) if any(g) else r[4], r[5]))
    return [first, second, third, third]


def test_stages_and_run_equal_the_plain_version(spark, rows, tmp_path):
    frame = spark.createDataFrame(rows, COLUMNS).repartition(3)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    docs, want = frame, expected(rows)
    assert len(want[0]) < len(rows) and len(want[1]) < len(want[0]) and want[2] != want[1]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == frame.columns and Counter(map(tuple, docs.collect())) == Counter(want[k]), name
    tokens = plain.tokenizer()
    ids = {r[0]: tokens.encode_ordinary(r[1]) for r in want[3]}
    final = queries.LLM_QUERIES["pipeline"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.decoded_sha256) for r in final) == Counter(
        (r[0], tuple(ids[r[0]]), len(ids[r[0]]), plain.sha256(r[1])) for r in want[3]
    )


def test_documents_come_in_the_order_of_the_mix(spark, rows):
    from larkspur.llm import mixing

    frame = spark.createDataFrame([r for r in rows if r[0] is not None], COLUMNS).dropDuplicates(["doc_id"])
    mixed = [r.doc_id for r in corpus_pipeline.mix_sources(spark, frame, "").collect()]
    placed = mixing.interleave(frame, mixing.tempered_parts(frame)).selectExpr("row.doc_id", "slot", "place").collect()
    assert mixed == [r.doc_id for r in sorted(placed, key=lambda r: (r.slot, r.place))]


def test_run_returns_the_mix_whatever_the_order_of_files(spark, tmp_path):
    words = WORDS["en"].split()
    made = [(i, " ".join(random.Random(i).choices(words, k=60)), "en", f"src{min(i % 10, 3)}", 0, "") for i in range(1_500)]
    spark.createDataFrame(made, COLUMNS).repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    at = sorted((r.slot, r.place, r.source) for r in final)
    assert len(at) > 1_400 and len({a[:2] for a in at}) == len(at)
    slots = {slot: {a[2] for a in at if a[0] == slot} for slot in {a[0] for a in at}}
    assert all(len(s) == 1 for s in slots.values())  # a slot is a block of one source
    size = Counter(r.source for r in final)
    total = sum(n**0.7 for n in size.values())
    for source, n in size.items():
        mine = sorted(slot for slot, s in slots.items() if s == {source})
        assert len(mine) == -(-n // 32)
        for k, slot in enumerate(mine):  # to within a block, and what rounding to thousandths moves
            assert abs(k - slot * n**0.7 / total) < 1.2


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_offers_every_operator_and_the_pipeline():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in queries.LLM_QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(queries.LLM_QUERIES) <= names and set(queries.LLM_ORACLES) <= set(__spark_entry__.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "mixing", "byte_level_bpe"]
