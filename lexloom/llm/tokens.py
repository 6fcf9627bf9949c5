"""Token ids by a public tokenizer file, for whole Arrow batches."""

import functools
import itertools
import os
import re
from array import array

import numpy as np

END = 0  # id behind every document
_HELD = 500_000  # pieces kept by a worker
_HELD_IDS = 4_000_000
_PART = 1 << 21  # characters cut into pieces at a time
_MARK = "\x01"
_MARKS = (",", ".", "\n")
# Where none of these occurs and every piece is a plain word or mark, no cut can matter.
_NEAR = ("\x01", ",,", "..", ",.", ".,", " ,", " .", "\n,", "\n.", "\n\n", "\n ", " \n")
# A byte-level tokenizer never joins what precedes a space with what follows it, but for runs of white space: a space
# between white space and white space or the end. The same holds before a comma or full stop that stands alone behind a
# letter or digit, and around a line break that stands alone.
_ODD = re.compile(r"\s (?:\s|\Z)|\x01")
_ODD_MARKS = re.compile(r"[,.][^\s\w]|[^\w][,.]|_[,.]|[,.]_|\A[,.]|\n\s|\s\n|\A\n")


class Encoder:
    """ids of texts, equal to the library's encode_batch(texts, add_special_tokens=False).

    For byte-level tokenizers texts are cut where no token can span, mostly before spaces, and each distinct piece is
    encoded once by the library. The pieces held are bounded; beyond that they are forgotten. Other tokenizers, and texts
    where a cut could matter or that hold an added token's string, are encoded whole.
    """

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        kind = repr(self.library.pre_tokenizer)
        self.cuts = self.library.normalizer is None and kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind
        line = self._encode(["\n"])[0]
        self.cuts, self.line = self.cuts and len(line) == 1, line[0] if line else 0
        self._forget()

    def _forget(self):
        self.place, self.dirty, self.ids, self.starts, self.lengths = {}, set(), array("I"), array("q"), array("q")

    def _encode(self, texts):
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys):
        new = keys - self.place.keys()
        if self.place and (len(self.place) + len(new) > _HELD or len(self.ids) > _HELD_IDS):
            self._forget()
            new = keys
        # a text of many plain pieces, a line each, saves the library's cost for each text
        plain, rest = [], []
        for k in new:
            (plain if k.isalnum() or (k[0] in " ,." and k[1:].isalnum()) else rest).append(k)
        for i in range(0, len(plain), 1000):
            part = plain[i:i + 1000]
            ids = np.array(self._encode(["\n".join(part) + "\n"])[0], np.uint32)
            line = ids == self.line
            self._hold(part, ids[~line].tolist(), (np.diff(np.flatnonzero(line), prepend=-1) - 1).tolist())
        for k, ids in zip(rest, self._encode(rest)):
            self._hold([k], ids, [len(ids)])
        self.dirty.update(k for k in rest if k not in _MARKS)

    def _hold(self, keys, ids, lengths):
        at = len(self.starts)
        self.place.update(zip(keys, range(at, at + len(keys))))
        self.starts.extend((np.cumsum(lengths) - lengths + len(self.ids)).tolist())
        self.lengths.extend(lengths)
        self.ids.extend(ids)

    def encode(self, texts):
        """(all ids, END behind each text; where each text starts, one entry more than texts)."""
        parts, held, size = [], [], 0
        for t in texts:
            if held and size + len(t) > _PART:
                parts.append(self._encode_part(held))
                held, size = [], 0
            held.append(t)
            size += len(t)
        parts.append(self._encode_part(held))
        lengths = np.concatenate([np.diff(at) for _, at in parts])
        return np.concatenate([ids for ids, _ in parts]), np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)

    def _encode_part(self, texts):
        pieces = [None] * len(texts)
        if self.cuts:
            held = [any(x in t for x in self.added) for t in texts]
            fine = [not h and not any(x in t for x in _NEAR) for h, t in zip(held, texts)]
            pieces = [t.replace(" ", "\x01 ").replace(",", "\x01,").replace(".", "\x01.").replace("\n", "\x01\n\x01").split(_MARK) if f else None for t, f in zip(texts, fine)]
            self._learn({k for p in pieces if p for k in p} - {""})
            for i, t in enumerate(texts):
                if held[i]:
                    pieces[i] = None
                elif not fine[i] or not self.dirty.isdisjoint(pieces[i]):
                    if _ODD.search(t):
                        pieces[i] = None
                    elif not fine[i] or _ODD_MARKS.search(t):
                        pieces[i] = t.replace(" ", "\x01 ").split(_MARK)
        cut = [p is None for p in pieces]
        pieces = [p or [] for p in pieces]
        flat = list(itertools.chain.from_iterable(pieces))
        self._learn(set(flat) - {""})
        if "" not in self.place:
            self._hold([""], [], [0])
        at = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        lengths = np.frombuffer(self.lengths, np.int64)[at] if len(flat) else at
        starts = np.frombuffer(self.starts, np.int64)[at] if len(flat) else at
        first = np.cumsum(lengths) - lengths
        ids = np.frombuffer(self.ids, np.uint32)[np.repeat(starts - first, lengths) + np.arange(int(lengths.sum()))] if len(self.ids) else np.zeros(0, np.uint32)
        bounds = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(lengths)))
        n = np.diff(total[bounds])
        whole = {i: np.array(self._encode([texts[i]])[0], np.uint32) for i in np.flatnonzero(cut)}
        for i, x in whole.items():
            n[i] = len(x)
        ends = np.cumsum(n + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        out[ends - 1] = END
        if not whole:
            keep = np.ones(len(out), bool)
            keep[ends - 1] = False
            out[keep] = ids
        else:
            for i, e in enumerate(ends):
                out[e - 1 - n[i]:e - 1] = whole[i] if i in whole else ids[total[bounds[i]]:total[bounds[i + 1]]]
        return out, np.concatenate(([0], ends)).astype(np.int64)


@functools.lru_cache(2)
def encoder(path):
    """One encoder for each worker process and file."""
    return Encoder(path)


def default_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
