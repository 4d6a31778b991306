"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark; repeated windows become spans to cut.

Documents are dealt into groups of bounded size.  Each group hashes all its windows and sends every distinct hash once to
the hash's bucket, with a mark if the group itself holds it twice, so a passage that a third of all documents share is one
entry per group.  A bucket finds the hashes that came twice and tells each group which of its own they are; the group then
hashes its windows again and merges the repeated ones into maximal spans.

Two windows are the same if their bucket number and 64-bit hash agree, which come from two independent polynomials over
two independent hashes of the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larkspur.llm.common import GROUP_BYTES, adding, group_of, group_total, mixed, packed, pieces, text_bytes

WINDOW = 35
# Fixed odd multipliers of the two polynomials and a fixed random value per byte; any others would do.
_BASE, _SECOND = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_BYTE, _OTHER_BYTE = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, powers: dict) -> np.ndarray:
    """Rolling polynomial, modulo 2^64, of ``values[start:end]`` for every pair, by one running sum.

    ``powers`` keeps the powers of the bases and of their inverses between calls.
    """
    size = len(values) + 1
    if base not in powers or len(powers[base][0]) < size:
        powers[base] = _powers(base, 2 * size), _powers(pow(base, -1, 2**64), 2 * size)
    up, down = powers[base]
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return mixed((running[ends] - running[starts]) * down[starts])


def word_bounds(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of ``texts``, the start and end of every word in them, and the number of words up to each text's end."""
    joined = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # the line feed ends a text's last word
    space = _SPACE[joined]
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    text_ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    return joined, starts, ends, np.searchsorted(starts, text_ends)


def window_hashes(texts: list[bytes], window: int, powers: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, second hash and first word of every window inside one text, then word starts, ends and counts of texts."""
    joined, starts, ends, last = word_bounds(texts)
    words = _range_hashes(_BYTE[joined], starts, ends, _BASE, powers)
    other = _range_hashes(_OTHER_BYTE[joined], starts, ends, _SECOND, powers)
    first = np.concatenate([[0], last[:-1]])
    room = np.maximum(last - first - window + 1, 0)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(room)[:-1]]), room) + np.arange(room.sum())
    return _range_hashes(words, at, at + window, _BASE, powers), _range_hashes(other, at, at + window, _SECOND, powers), at, starts, ends, last


def _bucket(second: np.ndarray, buckets: int) -> np.ndarray:
    return (second % np.uint64(buckets)).astype(np.uint16 if buckets <= 65_536 else np.uint32)  # short ones sort faster


def _counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values that occur once, and those that occur more often; both sorted."""
    values, counts = np.unique(hashes, return_counts=True)
    return values[counts == 1], values[counts > 1]


def _known(hashes: np.ndarray, places: np.ndarray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which pairs (``wanted``, ``at``) are among the pairs (``hashes``, ``places``), by one search whatever the number of places.

    ``hashes`` are sorted; equal ones of other places stand side by side.
    """
    found = np.zeros(len(wanted), bool)
    spot = np.searchsorted(hashes, wanted)
    left = np.flatnonzero(spot < len(hashes))
    while len(left):  # a second round only where one 64-bit hash stands in two places
        left = left[hashes[spot[left]] == wanted[left]]
        found[left] = places[spot[left]] == at[left]
        left = left[~found[left]]
        spot[left] += 1
        left = left[spot[left] < len(hashes)]
    return found


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64)


def repeated_hashes(dealt: DataFrame, text: str, window: int, buckets: int) -> DataFrame:
    """``(grp, bucket, hashes)``: for each group, those of its window hashes that occur at two or more places."""
    powers: dict = {}  # filled anew in each task

    def send(table: pa.Table) -> pa.Table:
        texts = text_bytes(table.column("row").combine_chunks().field(text))
        parts = [window_hashes(texts[lo:hi], window, powers)[:2] for lo, hi in pieces(texts)]
        hashes = np.concatenate([p[0] for p in parts])
        place = np.concatenate([_bucket(p[1], buckets) for p in parts])
        order = np.argsort(place, kind="stable")
        hashes, cuts = hashes[order], np.searchsorted(place[order], np.arange(buckets + 1))
        rows = [(b, *(x.tobytes() for x in _counted(hashes[cuts[b] : cuts[b + 1]]))) for b in np.flatnonzero(np.diff(cuts))]
        group = table.column("grp")[0].as_py()
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        return pa.table({"bucket": pa.array(columns[0], pa.int32()), "grp": pa.array([group] * len(rows), pa.int32()),
                         "once": pa.array(columns[1], pa.binary()), "more": pa.array(columns[2], pa.binary())})

    def judge(table: pa.Table) -> pa.Table:
        more = _joined(table.column("more"))
        _, twice = _counted(np.concatenate([_joined(table.column("once")), more, more]))
        told = []
        for once, more in zip(table.column("once").to_pylist(), table.column("more").to_pylist(), strict=True):
            own = np.frombuffer(once, np.uint64)
            spot = np.minimum(np.searchsorted(twice, own), max(len(twice) - 1, 0))
            told.append((own[twice[spot] == own].tobytes() if len(twice) else b"") + more)
        out = pa.table({"grp": table.column("grp"), "bucket": table.column("bucket"), "hashes": pa.array(told, pa.binary())})
        return out.filter(pa.array([bool(t) for t in told], pa.bool_()))

    sent = dealt.groupBy("grp").applyInArrow(send, "bucket int, grp int, once binary, more binary")
    return sent.groupBy("bucket").applyInArrow(judge, "grp int, bucket int, hashes binary")


def _spans(repeated: np.ndarray, at: np.ndarray, last: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """Maximal runs of covered words per text, counted from the text's first word."""
    words = int(last[-1]) if len(last) else 0
    cover = np.zeros(words + 1, np.int64)
    np.add.at(cover, at[repeated], 1)
    np.add.at(cover, at[repeated] + window, -1)
    covered = np.cumsum(cover)[:words] > 0
    first = np.concatenate([[0], last[:-1]])
    edge = np.zeros(words + 1, bool)
    edge[first] = True
    edge[words] = True
    begins = np.flatnonzero(covered & (np.concatenate([[True], ~covered[:-1]]) | edge[:words]))
    stops = np.flatnonzero(covered & (np.concatenate([~covered[1:], [True]])[:words] | edge[1:])) + 1
    owner = np.searchsorted(last, begins, side="right")
    out: list[list[tuple[int, int]]] = [[] for _ in last]
    for b, e, o in zip(begins, stops, owner, strict=True):
        out[o].append((int(b - first[o]), int(e - first[o])))
    return out


def cut_repeats(
    documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, layout: bool = False, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """``(row, n_words, spans, kept)`` per document: repeated passages of ``window`` or more words, and the rest.

    Words are maximal runs of bytes other than space and 0x09-0x0D, unchanged.  A word goes if any window of ``window``
    consecutive words of its document that covers it also starts anywhere else in ``documents``, the same document
    included; all windows are judged on the input.  ``spans`` holds [first word, word after the last) of each maximal run
    that goes.  ``kept`` has the other words joined by one space, or with ``layout`` the text with the spans (up to the
    next kept word) cut out and its white space otherwise as it was.

    Null texts have no words and an empty ``kept``, or with ``layout`` a null one.  Texts shorter than the window keep all
    words.  Rows are compared as they are: rows with null or repeated keys count like others, so two equal rows lose
    what they share.  An empty table gives an empty result.
    """
    powers: dict = {}
    groups = group_total(documents, text, group_bytes)
    dealt = packed(documents, grp=group_of(key, text, groups))  # by the whole row's key and text: an id that many rows share is spread
    told = repeated_hashes(dealt, text, window, groups)
    result = adding(dealt.select("row").schema, "n_words bigint, spans array<struct<begin: bigint, stop: bigint>>, kept string")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.column("row").combine_chunks()
        texts = text_bytes(row.field(text))
        absent = row.field(text).is_null().to_pylist()
        lists = [np.frombuffer(h, np.uint64) for h in right.column("hashes").to_pylist()]
        told_hashes = np.concatenate([np.zeros(0, np.uint64), *lists])
        told_places = np.repeat(right.column("bucket").to_numpy().astype(np.int64), [len(h) for h in lists])
        order = np.argsort(told_hashes, kind="stable")
        told_hashes, told_places = told_hashes[order], told_places[order]
        n_words, spans, kept = [], [], []
        for lo, hi in pieces(texts):
            hashes, second, at, starts, ends, last = window_hashes(texts[lo:hi], window, powers)
            repeated = _known(told_hashes, told_places, hashes, _bucket(second, groups).astype(np.int64))
            found = _spans(repeated, at, last, window)
            offset = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts[lo:hi]])])
            first = np.concatenate([[0], last[:-1]])
            for i, t in enumerate(texts[lo:hi]):
                begin, stop = starts[first[i] : last[i]] - offset[i], ends[first[i] : last[i]] - offset[i]
                n_words.append(len(begin))
                spans.append([{"begin": b, "stop": e} for b, e in found[i]])
                if layout:
                    kept.append(None if absent[lo + i] else _cut_layout(t, begin, found[i]))
                else:
                    kept.append(_cut_words(t, found[i]))
        return pa.table(
            [row, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))),
             pa.array(kept, pa.binary()).cast(pa.string())],
            names=["row", "n_words", "spans", "kept"],
        )

    return dealt.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(cut, result)


def _cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    words = text.split()
    for begin, stop in reversed(spans):
        del words[begin:stop]
    return b" ".join(words)


def _cut_layout(text: bytes, starts: np.ndarray, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for begin, stop in spans:
        out.append(text[at : starts[begin]])
        at = int(starts[stop]) if stop < len(starts) else len(text)
    return b"".join([*out, text[at:]])
