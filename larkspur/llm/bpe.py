"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

A rank file maps byte strings to ids.  For the library each byte gets a printable character, so tokens are strings of such
characters, and the ranks become merges: every way to split a token into two known ones, in order of the token's rank.
Texts are cut by the vocabulary's pattern first; the library merges each distinct piece once per task.  Decoding goes from ids
to token characters and back to bytes by the reversed byte table, and joins the bytes, so that characters which a token
boundary splits come together again.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larkspur.llm.common import BATCH_ROWS, adding, decoded, packed, small

CACHE_PIECES = 300_000  # distinct pieces whose ids a task remembers before it starts anew


def byte_characters() -> list[str]:
    """A printable character for every byte: itself where it is printable, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def character_bytes() -> dict[str, int]:
    """The byte of every printable character that stands for one: the byte table reversed."""
    return {character: byte for byte, character in enumerate(byte_characters())}


def read_ranks(path: str) -> dict[bytes, int]:
    """Ids by token bytes from a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


def _splits(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Where ``token`` falls into two known tokens.  If the end of one split is the beginning of another, so that both
    could apply to overlapping places, the one that applies further left comes first."""
    known = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    return sorted(known, key=lambda i: (not token.startswith(token[i:]), -i))


def library_model(ranks: dict[bytes, int]) -> str:
    """The ranks as a tokenizers file without normalizer; pieces are cut by the caller."""
    characters = byte_characters()
    name = {token: "".join(characters[b] for b in token) for token in ranks}
    merges = [
        [name[token[:i]], name[token[i:]]] for token in sorted(ranks, key=ranks.get) if len(token) > 1 for i in _splits(token, ranks)
    ]
    return json.dumps(
        {
            "version": "1.0",
            "added_tokens": [],
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
            "model": {"type": "BPE", "vocab": {name[t]: i for t, i in ranks.items()}, "merges": merges, "ignore_merges": True},
        }
    )


def _class(name: str, last: int) -> str:
    """The characters up to ``last`` of a Unicode class, as the tokenizers library sees it, as ranges of a character set."""
    from tokenizers import Regex, normalizers

    every = "".join(chr(c) for c in range(last + 1) if not 0xD800 <= c < 0xE000)
    inside = np.zeros(last + 2, bool)
    inside[[ord(c) for c in normalizers.Replace(Regex(f"[^{name}]+"), "").normalize_str(every)]] = True
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


def python_pattern(pattern: str, last: int = 0x10FFFF) -> str:
    """``pattern`` for Python's ``re`` and characters up to ``last``: Unicode classes are written out, so that both
    libraries' Unicode versions agree."""
    for name, negated in ((r"\p{L}", None), (r"\p{N}", None), (r"\s", r"\S")):
        ranges = _class(name, last)
        inside = re.sub(r"\[[^\]]*\]", lambda m, name=name, ranges=ranges: m[0].replace(name, ranges), pattern)
        pattern = "".join(
            part if part.startswith("[") else part.replace(name, f"[{ranges}]").replace(negated or name, f"[^{ranges}]")
            for part in re.split(r"(\[[^\]]*\])", inside)
        )
    return pattern


def encode(
    documents: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False, back: bool = False
) -> DataFrame:
    """``(row, ids)`` per row: the token ids of its whole text, without special tokens; null texts are empty.

    With ``offsets`` also ``begins`` and ``stops``: the characters of the text that each token touches, so tokens that
    split a character all report it.  With ``back`` also ``bytes``: the ids decoded again, as ``decode`` does, in the same
    pass.  Text is cut into the matches of ``pattern``, each encoded by itself; characters no
    match covers have no token.  Nothing in a text stands for a special token.  Repeated rows, extra columns and empty
    tables are as good as any.  The rank file is read once, by the driver.
    """
    rows = packed(documents)
    ranks = read_ranks(path)
    model, cut = library_model(ranks), python_pattern(pattern)
    short = python_pattern(pattern, 0xFFFF)  # the same for texts without characters beyond, and much faster
    table = _token_table(ranks)
    lengths = np.array([len(t or b"") for t in table])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library, beyond = Tokenizer.from_str(model), re.compile("[\U00010000-\U0010ffff]")
        whole, basic = re.compile(cut), re.compile(short)
        seen: dict[str, bytes] = {}  # ids of a piece as 32-bit integers
        for batch in small(batches):
            row = batch.column(0)
            texts = [t or "" for t in decoded(row.field(text))]
            cuts = [(whole if beyond.search(t) else basic).findall(t) for t in texts]
            fresh = list(set().union(*cuts).difference(seen))
            if len(seen) + len(fresh) > CACHE_PIECES:
                seen.clear()
                fresh = list(set().union(*cuts))
            for low in range(0, len(fresh), BATCH_ROWS):
                part = fresh[low : low + BATCH_ROWS]
                seen.update(zip(part, (array("i", e.ids).tobytes() for e in library.encode_batch_fast(part, add_special_tokens=False)), strict=True))
            ids = [b"".join(map(seen.__getitem__, c)) for c in cuts]
            ends = pa.array(np.cumsum([0, *(len(i) // 4 for i in ids)]).astype(np.int32))
            columns = [row, pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), np.int32)))]
            if offsets:
                touched = [_touched(t, np.frombuffer(i, np.int32), lengths, whole) for t, i in zip(texts, ids, strict=True)]
                columns += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([t[k] for t in touched]))) for k in (0, 1)]
            if back:
                columns.append(pa.array([_bytes_of(np.frombuffer(i, np.int32).tolist(), table) for i in ids], pa.binary()))
            yield pa.record_batch(columns, names)

    shape = "ids array<int>" + ", begins array<int>, stops array<int>" * offsets + ", bytes binary" * back
    names = ["row", "ids"] + ["begins", "stops"] * offsets + ["bytes"] * back
    return rows.mapInArrow(run, adding(rows.schema, shape))


def _touched(text: str, ids: np.ndarray, lengths: np.ndarray, matches: re.Pattern) -> tuple[np.ndarray, np.ndarray]:
    """First and last character (exclusive) of each token."""
    covered = np.concatenate([np.arange(m.start(), m.end()) for m in matches.finditer(text)] or [np.zeros(0, np.int64)])
    sizes = [len(text[c].encode("utf-8", "surrogatepass")) for c in covered.tolist()]
    character_of = np.repeat(covered, sizes)  # character of every encoded byte
    stops = np.cumsum(lengths[ids])
    begins = stops - lengths[ids]
    return character_of[begins].astype(np.int32), (character_of[stops - 1] + 1).astype(np.int32)


def token_characters(ranks: dict[bytes, int]) -> list[str | None]:
    """Tokens by id, as the library has them: strings of the characters that stand for bytes."""
    characters = byte_characters()
    out: list[str | None] = [None] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = "".join(characters[b] for b in token)
    return out


def _token_table(ranks: dict[bytes, int]) -> list[bytes | None]:
    """Bytes of every id: its characters, taken back by the reversed table once for all texts."""
    back = character_bytes()
    return [None if token is None else bytes(back[c] for c in token) for token in token_characters(ranks)]


def _bytes_of(ids: list[int], table: list[bytes | None]) -> bytes:
    """The bytes of tokens joined: parts of a split character meet again."""
    return b"".join(map(table.__getitem__, ids))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``(row, bytes)`` per row of ``encoded``: the bytes that its ids stand for; null ids give no bytes.

    Bytes, not text: a list of ids may begin or end inside a character.  Cast to string where whole texts were encoded.
    An id that the rank file lacks is an error.
    """
    rows = packed(encoded)
    table = _token_table(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            row = batch.column(0)
            out = [_bytes_of(i or [], table) for i in row.field(ids).to_pylist()]
            yield pa.record_batch([row, pa.array(out, pa.binary())], ["row", "bytes"])

    return rows.mapInArrow(run, adding(rows.schema, "bytes binary"))
