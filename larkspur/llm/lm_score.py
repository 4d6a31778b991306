"""Cross-entropy difference: how much better a target model than a background model predicts each document's text.

Both models are character trigram models of one form, over one vocabulary (all characters of the corpus), with Witten-Bell
smoothing.  The target model learns from the rows whose key is in a given table.  The background model is matched to it: it
learns from as much text of other rows, drawn by a hash of the row; where there is less other text, from all of it.  A
document's score is its mean loss per token, in bits, under the target model less that under the background model; the lower,
the more it is like the target.

Documents are dealt into groups of bounded size.  A group sends its distinct trigrams with their counts, gets back the two
losses of just these trigrams, and scores its documents with them: neither model is ever whole in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import GROUP_BYTES, adding, checkpointed, codepoints, decoded, group_of, group_total, packed

BACKGROUND_SEED, DRAWS = 17, 1 << 30  # of the hash that draws the background
START = 0x110000  # stands twice before every text; no character has this number
_ONE, _TWO = (1 << 21) - 1, (1 << 42) - 1


def trigrams(text: str) -> np.ndarray:
    """One number per character of ``text``: it and the two before it, 21 bits each."""
    x = np.concatenate([np.full(2, START, np.int64), codepoints(text).astype(np.int64)])
    return (x[:-2] << 42) | (x[1:-1] << 21) | x[2:]


def deal(documents: DataFrame, target_keys: DataFrame, key: str, text: str, groups: int) -> tuple[DataFrame, DataFrame]:
    """``(row, drawn, grp)``, whether a row that is not of the target belongs to the background; and the target's ``(key, grp)``.

    Which rows are of the target is found by their ids and groups alone: texts do not move for it, and an id that many rows
    share stands once per group.
    """
    k = F.col(f"`{key}`")
    grp = group_of(key, text, groups)
    wanted = target_keys.select(F.col(f"`{target_keys.columns[0]}`").cast(documents.schema[key].dataType).alias("key"))
    wanted = wanted.where("key is not null").distinct()
    size = F.coalesce(F.length(F.col(f"`{text}`")), F.lit(0))
    per_key = documents.select(k.alias("key"), grp.alias("grp"), size.alias("size")).groupBy("key", "grp").agg(F.sum("size").alias("size"))
    target = checkpointed(per_key.join(wanted, "key", "left_semi"))
    whole, mine = documents.agg(F.sum(size)).first()[0] or 0, target.agg(F.sum("size")).first()[0] or 0
    share = min(1.0, mine / (whole - mine)) if whole > mine else 0.0
    drawn = F.pmod(F.xxhash64(F.lit(BACKGROUND_SEED), k, F.col(f"`{text}`")), F.lit(DRAWS)) < round(share * DRAWS)
    return packed(documents, drawn=drawn, grp=grp), target.select("key", "grp")


def count_trigrams(dealt: DataFrame, target: DataFrame, key: str, text: str) -> DataFrame:
    """``(grp, gram, n_target, n_all)`` of every group, from what ``deal`` gives; ``n_all`` counts the background."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.column("row").combine_chunks() if left.num_rows else None
        wanted = set(right.column("key").to_pylist())
        parts = [trigrams(t or "") for t in (decoded(row.field(text)) if row else [])]
        gram, at = np.unique(np.concatenate([*parts, np.zeros(0, np.int64)]), return_inverse=True)
        lengths = [len(p) for p in parts]
        of_target = np.array([k in wanted for k in (row.field(key).to_pylist() if row else [])], bool)
        drawn = np.array(left.column("drawn").to_pylist(), bool) & ~of_target
        group = left.column("grp")[0].as_py() if left.num_rows else 0
        return pa.table({
            "grp": pa.array(np.full(len(gram), group, np.int32)), "gram": pa.array(gram),
            "n_target": pa.array(np.bincount(at[np.repeat(of_target, lengths)], minlength=len(gram)).astype(np.int64)),
            "n_all": pa.array(np.bincount(at[np.repeat(drawn, lengths)], minlength=len(gram)).astype(np.int64)),
        })

    shape = "grp int, gram bigint, n_target bigint, n_all bigint"
    return dealt.groupBy("grp").cogroup(target.groupBy("grp")).applyInArrow(count, shape)


def losses(counts: DataFrame) -> DataFrame:
    """``(gram, loss_target, loss_all)``: bits per trigram under the target and the background, from summed ``counts(gram, n_target, n_all)``."""
    models = ("n_target", "n_all")
    kinds = lambda n: F.sum((F.col(n) > 0).cast("bigint"))
    context = lambda frame, by: frame.groupBy(by).agg(
        *[F.sum(n).alias(f"{by}_{n}") for n in models], *[kinds(n).alias(f"{by}_kinds_{n}") for n in models]
    )
    three = counts.select(
        "gram", *models, F.shiftrightunsigned("gram", 21).alias("ab"), F.col("gram").bitwiseAND(F.lit(_TWO)).alias("bc")
    )
    two = three.groupBy("bc").agg(*[F.sum(n).alias(n) for n in models]).select(
        "bc", *models, F.shiftrightunsigned("bc", 21).alias("b"), F.col("bc").bitwiseAND(F.lit(_ONE)).alias("c")
    )
    one = two.groupBy("c").agg(*[F.sum(n).alias(n) for n in models])
    whole = one.agg(F.count("*").alias("kinds"), *[F.sum(n).alias(n) for n in models]).first()  # three numbers

    def smoothed(own: Column, total: Column, kinds_seen: Column, lower: Column) -> Column:
        return F.when(total > 0, (own + kinds_seen * lower) / (total + kinds_seen)).otherwise(lower)

    first = one.select("c", *[((F.col(n) + 1) / F.lit(float((whole[n] or 0) + whole["kinds"]))).alias(f"p1_{n}") for n in models])
    second = two.join(first, "c").join(context(two, "b"), "b").select(
        "bc", *[smoothed(F.col(n), F.col(f"b_{n}"), F.col(f"b_kinds_{n}"), F.col(f"p1_{n}")).alias(f"p2_{n}") for n in models]
    )
    third = three.join(second, "bc").join(context(three, "ab"), "ab")
    bits = {
        n: -F.log2(smoothed(F.col(n), F.col(f"ab_{n}"), F.col(f"ab_kinds_{n}"), F.col(f"p2_{n}"))) for n in models
    }
    return third.select("gram", bits["n_target"].alias("loss_target"), bits["n_all"].alias("loss_all"))


def score(
    documents: DataFrame, target_keys: DataFrame, key: str = "doc_id", text: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``(row, n_tokens, loss_target, loss_all, score)`` per row of ``documents``; see the module for their meaning.

    Tokens are characters, unchanged.  ``target_keys(key)`` may repeat keys, hold null ones (ignored) and unknown ones.  Rows
    that repeat a key all belong to the target with it.  Null and empty texts have no tokens and null losses and score;
    with no target rows at all both models are uniform.  An empty table gives an empty result.
    """
    groups = group_total(documents, text, group_bytes)
    dealt, target = deal(documents, target_keys, key, text, groups)
    counts = checkpointed(count_trigrams(dealt, target, key, text))
    model = losses(checkpointed(counts.groupBy("gram").agg(F.sum("n_target").alias("n_target"), F.sum("n_all").alias("n_all"))))
    answers = counts.select("grp", "gram").join(model, "gram")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.column("row").combine_chunks()
        gram = right.column("gram").to_numpy()
        order = np.argsort(gram)
        gram = gram[order]
        bits = np.stack([right.column(c).to_numpy()[order] for c in ("loss_target", "loss_all")])
        sums = []
        for t in decoded(row.field(text)):
            own = trigrams(t or "")
            sums.append((len(own), *(bits[:, np.searchsorted(gram, own)].mean(axis=1) if len(own) else (None, None))))
        n, target, every = zip(*sums, strict=True)
        apart = [None if a is None else a - b for a, b in zip(target, every, strict=True)]
        return pa.table([row, pa.array(n, pa.int64()), *[pa.array(x, pa.float64()) for x in (target, every, apart)]],
                        names=["row", "n_tokens", "loss_target", "loss_all", "score"])

    shape = adding(dealt.select("row").schema, "n_tokens bigint, loss_target double, loss_all double, score double")
    return dealt.select("row", "grp").groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(judge, shape)
