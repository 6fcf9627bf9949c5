"""Plain versions of the operators, for small inputs."""

import functools
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from tokenizers import Tokenizer

from lexloom.llm import tokens


def low(doc_id):
    return float("-inf") if doc_id is None else doc_id


# language ID
def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    for w in words:
        found.update(w)
        padded = f" {w} "
        found.update(padded[i:i + 2] for i in range(len(padded) - 1))
        found.update(padded[i:i + 3] for i in range(len(padded) - 2))
    return found


def _order(gram):
    """n-grams as numbers: a boundary sorts below every letter, shorter n-grams below longer ones."""
    return len(gram), [1 if c == " " else ord(c) for c in gram]


def ranked(counts, k=300):
    # a boundary in front counts as a character, so that the order is by length first
    return sorted(counts, key=lambda g: (-counts[g], _order(g)))[:k]


def profiles(rows, k=300):
    held = {}
    for text, lang in rows:
        if lang is not None and text and any(c.isalpha() for c in text):
            held.setdefault(lang, Counter()).update(grams(text))
    return {lang: ranked(c, k) for lang, c in held.items()}


def language(text, profile, k=300):
    top = ranked(grams(text or ""), k)
    if not top or not profile:
        return "und", 0.0
    away = {}
    for lang, order in sorted(profile.items()):
        place = {g: i for i, g in enumerate(order)}
        away[lang] = sum(abs(place[g] - i) if g in place else k for i, g in enumerate(top))
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (k * len(top))


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


# line dedup
def line_dedup(docs, min_chars=30):
    """{(doc_id, text): (n_lines, n_removed, kept text)}"""
    cut = {d: [x.strip(" \t\r") for x in d[1].split("\n")] for d in docs if d[1] is not None}
    places, out = {}, {}
    for doc, lines in cut.items():
        for i, line in enumerate(lines):
            places.setdefault(line, []).append((low(doc[0]), i, lines))
    for doc, lines in cut.items():
        gone = set()
        for i in range(len(lines)):
            longest = 0  # lines from here on that also stand from an earlier place on
            for d, j, other in places[lines[i]]:
                n = 0
                while (d, j) < (low(doc[0]), i) and i + n < len(lines) and j + n < len(other) and lines[i + n] == other[j + n]:
                    n += 1
                longest = max(longest, n)
            if sum(map(len, lines[i:i + longest])) >= min_chars:
                gone.update(range(i, i + longest))
        raw = doc[1].split("\n")
        out[doc] = len(raw), len(gone), "\n".join(x for i, x in enumerate(raw) if i not in gone)
    return out


# SimHash
def fingerprint(text, shingle=3):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    value = 0
    for bit in range(64):
        if sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) * 2 > len(shingles):
            value |= 1 << bit
    return value


def simhash_components(docs, radius=3):
    """[(doc_id, fingerprint, component_id)] in the order of docs."""
    prints = [fingerprint(t) for _, t in docs]
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(b)] = find(a)
    least = {}
    for (d, _), p in zip(docs, prints):
        if d is not None:
            least[find(p)] = min(least.get(find(p), d), d)
    return [(d, f"{p:016x}", least.get(find(p))) for (d, _), p in zip(docs, prints)]


# decontamination
SOLID = [(0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def words(text):
    spaced = "".join((f" {c} " if any(a <= ord(c) <= b for a, b in SOLID) else c) if re.match(r"\w", c) else " " for c in (text or "").lower())
    found = spaced.split()
    return f" {' '.join(found)} " if found else ""


def distance(item, text):
    """Smallest edit distance of item to any part of text, by the full table."""
    row = np.arange(len(item) + 1)
    best = row[-1]
    item = np.array([ord(c) for c in item])
    for c in text:
        new = np.minimum(row[1:] + 1, row[:-1] + (item != ord(c)))
        new = np.concatenate(([0], new))
        new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        row = new
        best = min(best, row[-1])
    return int(best)


@functools.lru_cache(None)
def edits(items, text):
    """Smallest edit distance of every item to any part of text: all tables side by side, a row of each per character."""
    width = max(map(len, items))
    table = np.zeros((len(items), width), np.int32)
    for i, item in enumerate(items):
        table[i, :len(item)] = [ord(c) for c in item]
    steps, ends = np.arange(width + 1, dtype=np.int16), (np.arange(len(items)), np.array([len(x) for x in items]))
    row = np.tile(steps, (len(items), 1))
    best, unequal = row[ends], {}
    for c in text:
        if c not in unequal:
            unequal[c] = (table != ord(c)).astype(np.int16)
        new = np.zeros_like(row)
        np.minimum(row[:, 1:] + 1, row[:, :-1] + unequal[c], out=new[:, 1:])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        best = np.minimum(best, row[ends])
    return best.tolist()


def leaks(docs, items):
    """{(doc_id, item_id): edits}"""
    held = [(i, words(t)) for i, t in items if words(t)]
    found = {}
    for d, text in docs:
        for (i, item), n in zip(held, edits(tuple(t for _, t in held), words(text))):
            if n <= len(item) // 20:
                found[d, i] = n
    return found


# suffix dedup
def suffix_dedup(docs, width=50):
    """[(doc_id, n_bytes, n_removed, n_spans, kept hash)] in the order of docs."""
    rank = lambda d: float("inf") if d is None else d
    first, out = {}, []
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        for i in range(len(b) - width + 1):
            first[b[i:i + width]] = min(first.get(b[i:i + width], float("inf")), rank(d))
    for d, b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if first[b[i:i + width]] < rank(d):
                gone[i:i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


# tokens
def token_ids(texts):
    library = Tokenizer.from_file(tokens.default_path())
    return [np.array([*e.ids, 0], "<u4") for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packing(rows, docs, size=1024):
    """Every id in one piece, sequences gapless, right sums; returns the share of padding."""
    left = Counter()
    ids = {}
    for (d, t), x in zip(docs, token_ids([t for _, t in docs])):
        ids.setdefault(d, []).append(x)
        n = len(x)
        for a in range(0, n, size):
            left[d, a, min(size, n - a), zlib.crc32(x[a:a + size].tobytes()), n] += 1
    left.subtract(Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows))
    assert not any(left.values())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = 0
    for held in sequences.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert 0 < at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding / max(1, sum(r["length"] for r in rows))
