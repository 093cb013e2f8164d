"""Token ids of texts, through the tokenizers library, with a word table.

The tokenizer splits at white space, and a run of letters from a following
run of punctuation, before it does anything else; so the ids of a text are
the ids of such pieces in order. A batch of texts is cut into pieces and
hashed with array operations; each Python worker keeps a table from piece
hash to ids, and only pieces it has not met go through the library. Letter
runs are encoded without the (slow) normaliser, of which only lower-casing
touches them; other pieces go through the full tokenizer, and so do whole
texts that hold ``<|``, the start of a special token. The table is emptied
when it holds ``MAX_PIECES``, so memory is bounded whatever the vocabulary.
"""

from __future__ import annotations

import os
import re

import numpy as np

from oddsline.llm.common import _IS_WHITE, lowered, segments, span_hashes, spans

MAX_PIECES = 1_200_000
SLOTS = 1 << 21
BATCH = 1 << 20  # bytes of text per round
GROUP = 1 << 14  # new letter runs per call of the library

_LETTERS = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+\Z")

# Classes of bytes for the cut between letters and punctuation. An apostrophe
# never starts a cut: the tokenizer knows contractions.
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = True
_PUNCT = np.zeros(256, bool)
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _PUNCT[_a:_b] = True
_PUNCT[39] = False
_LATIN = np.zeros(256, bool)  # second bytes of U+00C0..U+00FF that are letters
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def pieces(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of a buffer."""
    white = _IS_WHITE[raw]
    starts, ends = spans(white)
    if len(raw) < 2:
        return starts, ends
    after_letter = np.zeros(len(raw), bool)
    after_letter[1:] = _LETTER[raw[:-1]]
    after_letter[2:] |= (raw[:-2] == 0xC3) & _LATIN[raw[1:-1]]
    cut = np.flatnonzero(_PUNCT[raw] & after_letter)
    if len(cut):
        starts, ends = np.sort(np.concatenate((starts, cut))), np.sort(np.concatenate((ends, cut)))
    return starts, ends


class WordTokenizer:
    """``encode_many(texts)``: each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.light = Tokenizer.from_file(path)
        self.light.normalizer = normalizers.Sequence([])
        self.light.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.vocab = self.full.get_vocab_size()
        self.ends = np.zeros(self.vocab + 1, bool)
        for token, i in self.full.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self._empty()

    def _empty(self) -> None:
        self.key = np.zeros(SLOTS, np.uint64)
        self.entry = np.zeros(SLOTS, np.int32)
        self.n = 0
        self.at = np.zeros(MAX_PIECES + 1, np.int64)     # entry -> first id
        self.length = np.zeros(MAX_PIECES + 1, np.int32)  # entry -> ids
        self.ids = np.zeros(1 << 20, "<u4")
        self.used = 0

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word)."""
        if not words:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        plain = np.array([_LETTERS.match(w) is not None for w in words])
        counts = np.zeros(len(words), np.int64)
        letters = [w.lower() for w, p in zip(words, plain, strict=True) if p]
        odd = [w for w, p in zip(words, plain, strict=True) if not p]
        flat = np.zeros(0, "<u4")
        if letters:
            groups = [" ".join(letters[k : k + GROUP]) for k in range(0, len(letters), GROUP)]
            flat = np.concatenate([np.asarray(self.light.encode_batch_fast([g], add_special_tokens=False)[0].ids, "<u4")
                                   for g in groups])
            cuts = np.flatnonzero(self.ends[flat]) + 1
            if len(cuts) != len(letters):  # this vocabulary has no end mark: one call a word
                got = self.full.encode_batch_fast(letters, add_special_tokens=False)
                flat, cuts = np.concatenate([np.asarray(e.ids, "<u4") for e in got]), np.cumsum([len(e.ids) for e in got])
            counts[plain] = np.diff(np.concatenate(([0], cuts)))
        got = [np.asarray(e.ids, "<u4") for e in self.full.encode_batch_fast(odd, add_special_tokens=False)] if odd else []
        counts[~plain] = [len(g) for g in got]
        both = np.concatenate([flat, *got])
        where = np.zeros(len(words), np.int64)  # of each word in ``both``
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        where[order] = np.cumsum(counts[order]) - counts[order]
        return both[ragged(where, counts)], counts

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if not in the table (two slots a hash)."""
        one = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        e = np.where(self.key[one] == h, self.entry[one], -1)
        miss = np.flatnonzero(e < 0)
        if len(miss):
            two = (h[miss] >> np.uint64(43)).astype(np.int64) & (SLOTS - 1)
            e[miss] = np.where(self.key[two] == h[miss], self.entry[two], -1)
        return e

    def _learn(self, h: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
        """Encode pieces (distinct hashes) and keep them; returns their ids and counts."""
        data = raw.tobytes()
        words = [data[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids, counts = self._encode(words)
        if self.n + len(h) > MAX_PIECES:
            self._empty()
        k = min(len(h), MAX_PIECES - 1)
        total = int(counts[:k].sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), "<u4")))
        self.ids[self.used : self.used + total] = ids[:total]
        new = np.arange(self.n, self.n + k)
        self.length[new] = counts[:k]
        self.at[new] = self.used + np.cumsum(counts[:k]) - counts[:k]
        one = (h[:k] & np.uint64(SLOTS - 1)).astype(np.int64)
        two = (h[:k] >> np.uint64(43)).astype(np.int64) & (SLOTS - 1)
        slot = np.where(self.key[one] == 0, one, two)
        self.key[slot], self.entry[slot] = h[:k], new
        self.n, self.used = self.n + k, self.used + total
        return ids, counts

    def _buffer(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a buffer, and how many ids lie before each bound."""
        starts, ends = pieces(raw)
        h = span_hashes(raw, starts, ends) | np.uint64(1 << 42)  # never 0, the empty slot
        e = self._find(h)
        counts, where = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        hit = e >= 0
        counts[hit], where[hit] = self.length[e[hit]], self.at[e[hit]]
        store = self.ids
        miss = np.flatnonzero(~hit)
        if len(miss):
            uniq, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            new, n = self._learn(uniq, raw, starts[miss[first]], ends[miss[first]])
            where[miss] = len(store) + (np.cumsum(n) - n)[inverse]
            counts[miss] = n[inverse]
            store = np.concatenate((store, new))
        ids = store[ragged(where, counts)]
        before = np.concatenate(([0], np.cumsum(counts)))
        return ids, before[np.searchsorted(starts, bounds)]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        group: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            nonlocal group, size
            if group:
                at = np.concatenate(([0], np.cumsum([len(b) + 1 for _, b in group])))
                ids, before = self._buffer(lowered(b"\n".join(b for _, b in group)), at[:-1])
                ends = [*before[1:].tolist(), len(ids)]
                flat = ids.tobytes()
                for (i, _), a, b in zip(group, before.tolist(), ends, strict=True):
                    out[i] = flat[4 * a : 4 * b]
            group, size = [], 0

        for i, t in enumerate(texts):
            if "<|" in t:
                out[i] = np.asarray(self.full.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            b = t.encode("utf-8")
            if len(b) > BATCH:
                raw, parts = lowered(b), []
                for a, z in segments(_IS_WHITE[raw]):
                    parts.append(self._buffer(raw[a:z], np.zeros(0, np.int64))[0].tobytes())
                out[i] = b"".join(parts)
                continue
            if size + len(b) > BATCH:
                flush()
            group.append((i, b))
            size += len(b)
        flush()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]


def ragged(where: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices where[0], where[0]+1, .. counts[0] of them, then those of the next."""
    ends = np.cumsum(counts)
    return np.repeat(where - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """This worker's tokenizer for a vocabulary file (kept between tasks)."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
