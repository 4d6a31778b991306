"""Plain Python versions of the text operators, written from their definitions."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import tiktoken
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text: str | None) -> int:
    words = WORD.findall(lower_ascii(text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(nodes: list, linked) -> dict:
    """Smallest node reachable from each, None last; ``linked(i, j)`` over positions."""
    n, label = len(nodes), list(range(len(nodes)))
    near = [[j for j in range(n) if j != i and linked(i, j)] for i in range(n)]
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        label[i] = min((nodes[j] for j in seen if nodes[j] is not None), default=None)
    return label


def covered(texts: list[str | None], window: int) -> list[list[bool]]:
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


def cut_layout(text: str, gone: list[bool]) -> str:
    """The text without covered words and the white space up to the next kept word."""
    spots = [m.start() for m in WORD.finditer(text)] + [len(text)]
    first = text[: spots[0]]
    return first + "".join(text[a:b] for a, b, g in zip(spots, spots[1:], gone, strict=False) if not g)


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def grams(text: str) -> list[str]:
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = []
    for w in words:
        padded = f" {w} "
        out += list(w) + [padded[i : i + 3] for i in range(len(padded) - 2)]
    joined = " " + " ".join(words) + " " if words else ""
    return out + [joined[i : i + 2] for i in range(len(joined) - 1)]


def packed(gram: str) -> int:
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def profile(counts: Counter, length: int = 400) -> list[str]:
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], packed(x[0])))][:length]


def languages(rows: list[tuple], length: int = 400) -> list[tuple[str, float]]:
    """Prediction and score of (doc_id, text, lang) rows."""
    learned: dict[str, Counter] = {}
    for i, t, lang in rows:
        if lang is not None and t is not None and not held_out(i):
            learned.setdefault(lang, Counter()).update(grams(t))
    places = {k: {g: p for p, g in enumerate(profile(c, length))} for k, c in learned.items() if c}
    out = []
    for _, t, _ in rows:
        own = profile(Counter(grams(t or "")), length)
        if not own or not places:
            out.append(("und", 0.0))
            continue
        sums = {k: sum(abs(p - at[g]) if g in at else length for p, g in enumerate(own)) for k, at in places.items()}
        best = min(sorted(sums), key=sums.get)
        out.append((best, 1 - sums[best] / (length * len(own))))
    return out


def tokenizer() -> tiktoken.Encoding:
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
