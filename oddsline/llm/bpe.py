"""Op 12. BPE encoding and decoding in batched numpy merge rounds.

The vocabulary, merges and added tokens are read from a tokenizer file (BPE
with word ends over byte-level symbols, white space dropped). A batch of texts
is cut into pieces with array operations; pieces that a worker has met before
are answered from its bounded table. The words of all new pieces are merged
together:

* Their byte symbols lie in one flat array with a word number each.
* A round keys every pair of neighbours as left * size + right, finds its rank
  by binary search over the sorted keys of all merges, takes each word's lowest
  rank, and merges that pair wherever the word holds it, leftmost first where
  occurrences overlap. Words without a known pair leave the array.
* A merge's result takes part in later merges only, so this is the order in
  which one merge at a time would go. A word of n bytes takes at most n - 1
  rounds, and no more than there are merges.

Decoding gathers the bytes of the ids' tokens from one flat table. As in the
library, a file without a decoder gives the tokens joined by blanks.

Normalising (composition, lower case) and cutting of pieces that are not plain
letters are left to the normaliser and pre-tokenizer that the file names; the
library's encoder and decoder are not used.

Defined cases: null and empty texts have no ids and decode to the empty text;
texts are encoded whole, however long; the strings of added tokens become their
ids; null ids are kept; repeated rows are returned each for itself; ids out of
the vocabulary decode to nothing; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddsline.llm.common import _IS_WHITE, lowered, segments, tidy
from oddsline.llm.tokens import _LETTERS, BATCH, WordTokenizer, ragged

DECODED = 1 << 18  # ids decoded at once
NEVER = np.iinfo(np.int32).max  # the rank of no pair


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the
    next of those from U+0100 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Merges:
    """Vocabulary and merges as arrays."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or model.get("dropout") or model.get("unk_token") or model.get("byte_fallback") \
                or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("not a plain BPE vocabulary")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.size = max(self.vocab.values()) + 1
        symbols = byte_symbols()
        self.inner = np.array([self.vocab[s] for s in symbols], np.int32)           # by byte
        self.last = np.array([self.vocab[s + self.end] for s in symbols], np.int32)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        key = np.array([self.vocab[a] * self.size + self.vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys = np.append(key[order], np.iinfo(np.int64).max)
        self.ranks = np.append(order, NEVER).astype(np.int32)
        self.results = np.array([self.vocab[a + b] for a, b in pairs], np.int32)  # by rank

    def _rank(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each of these places, NEVER without one."""
        after = np.minimum(at + 1, len(sym) - 1)
        key = sym[at].astype(np.int64) * self.size + sym[after]
        found = np.searchsorted(self.keys, key)
        return np.where((self.keys[found] == key) & (word[after] == word[at]) & (after > at), self.ranks[found], NEVER)

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words (bytes in one flat array, at least one each): all ids, ids per word."""
        sym = self.inner[data]
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        rank = self._rank(sym, word, np.arange(len(sym)))
        ids, owner = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.minimum.reduceat(rank, first)
            if (lowest == NEVER).any():  # finished words leave
                done = np.repeat(lowest == NEVER, np.diff(np.append(first, len(sym))))
                ids.append(sym[done])
                owner.append(word[done])
                sym, word, rank = sym[~done], word[~done], rank[~done]
                continue
            pick = np.flatnonzero(rank == np.repeat(lowest, np.diff(np.append(first, len(sym)))))
            opens = np.concatenate(([True], pick[1:] != pick[:-1] + 1))
            offset = np.arange(len(pick)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
            pick = pick[offset % 2 == 0]  # of overlapping occurrences every second one
            sym[pick] = self.results[rank[pick]]
            keep = np.ones(len(sym), bool)
            keep[pick + 1] = False
            sym, word, rank = sym[keep], word[keep], rank[keep]
            new = pick - np.arange(len(pick))  # where the merged symbols are now
            changed = np.concatenate((new, new[new > 0] - 1))
            rank[changed] = self._rank(sym, word, changed)
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        return ids[np.argsort(owner, kind="stable")].astype("<u4"), np.bincount(owner, minlength=len(lengths))


class MergeTokenizer(WordTokenizer):
    """``encode_many``, from pieces that the table lacks by merge rounds, and ``decode``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.merges = Merges(file["model"])
        added = file["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added) or file["decoder"] \
                or any(p["type"] not in ("Split", "ByteLevel") for p in file["pre_tokenizer"]["pretokenizers"]):
            raise ValueError("not a vocabulary with word ends over byte-level symbols")
        self.added = {t["content"]: t["id"] for t in added}
        self.cut_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        full = Tokenizer.from_file(path)
        self.normalizer, self.pre = full.normalizer, full.pre_tokenizer
        self.to_byte = np.zeros(512, np.uint8)
        self.to_byte[[ord(c) for c in byte_symbols()]] = np.arange(256)
        names = {i: t for t, i in [*self.merges.vocab.items(), *self.added.items()]}
        self.vocab = max(names) + 1
        tokens = [names[i].encode("utf-8") + b" " if i in names else b"" for i in range(self.vocab)] + [b""]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_length = np.array([len(t) for t in tokens])
        self.token_at = np.cumsum(self.token_length) - self.token_length
        self._empty()

    def _words(self, pieces: list[str]) -> tuple[bytes, list[int], list[int]]:
        """Bytes of all words of the pieces, bytes per word, words per piece."""
        data, lengths, counts = [], [], []
        for p in pieces:
            if _LETTERS.match(p):
                own = [p.lower().encode("utf-8")]
            else:
                cut = self.pre.pre_tokenize_str(self.normalizer.normalize_str(p))
                own = [self.to_byte[np.frombuffer(w.encode("utf-32-le"), "<u4")].tobytes() for w, _ in cut if w]
            data += own
            lengths += map(len, own)
            counts.append(len(own))
        return b"".join(data), lengths, counts

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, lengths, counts = self._words(words)
        ids, per_word = self.merges.merge(np.frombuffer(data, np.uint8), np.array(lengths, np.int64))
        before = np.concatenate(([0], np.cumsum(per_word)))
        return ids, np.diff(before[np.concatenate(([0], np.cumsum(counts)))].astype(np.int64))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit bytes."""
        parts, owner, fixed = [], [], []
        for k, text in enumerate(texts):
            for n, part in enumerate(self.cut_added.split(text) if self.cut_added and "<|" in text else [text]):
                owner.append(k)
                fixed.append(np.array([self.added[part]], "<u4").tobytes() if n % 2 else None)
                parts.append("" if n % 2 else part)
        out: list[list[bytes]] = [[] for _ in texts]
        for k, own, ids in zip(owner, fixed, self._plain(parts), strict=True):
            out[k].append(ids if own is None else own)
        return [b"".join(x) for x in out]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without added tokens: many short ones in one buffer, a long one in stretches."""
        out, data = [b""] * len(texts), [t.encode("utf-8") for t in texts]
        k = 0
        while k < len(data):
            first, size = k, 0
            while k < len(data) and (k == first or size + len(data[k]) < BATCH):
                size += len(data[k]) + 1
                k += 1
            raw = lowered(b"\n".join(data[first:k]))
            bounds = np.cumsum([0] + [len(d) + 1 for d in data[first:k]])[:-1]
            if k == first + 1:
                out[first] = b"".join(self._buffer(raw[a:z], bounds[:0])[0].tobytes() for a, z in segments(_IS_WHITE[raw]))
                continue
            ids, before = self._buffer(raw, bounds)
            flat, cuts = ids.tobytes(), [*before.tolist(), len(ids)]
            out[first:k] = [flat[4 * a : 4 * z] for a, z in zip(cuts, cuts[1:], strict=False)]
        return out

    def decode(self, ids: bytes):
        """The text of the ids as UTF-8, in stretches of bounded size."""
        flat, last = np.frombuffer(ids, "<u4"), b""
        for a in range(0, len(flat), DECODED):
            at = np.minimum(flat[a : a + DECODED], self.vocab).astype(np.int64)
            data = last + self.token_bytes[ragged(self.token_at[at], self.token_length[at])].tobytes()
            yield data[:-1]  # the blank after the last token goes if nothing follows
            last = data[-1:]


_LOADED: dict[str, MergeTokenizer] = {}


def merge_tokenizer(path: str) -> MergeTokenizer:
    """This worker's tokenizer for a vocabulary file (kept between tasks)."""
    if path not in _LOADED:
        _LOADED[path] = MergeTokenizer(path)
    return _LOADED[path]


def _mapped(docs: DataFrame, kind: str, fields: list[pa.Field], of) -> DataFrame:
    def run(batches):
        for b in batches:
            columns = of(["" if t is None else t for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(columns, fields, strict=True))],
                                             ["doc_id", *(f.name for f in fields)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(tidy(run), kind)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): every document's ids as little-endian unsigned 32-bit integers."""
    return _mapped(docs, "doc_id long, ids binary", [pa.field("ids", pa.binary())],
                   lambda texts: [merge_tokenizer(path).encode_many(texts)])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): the text of every row of ``encode``."""
    def run(batches):
        for b in batches:
            texts = [b"".join(merge_tokenizer(path).decode(x or b"")).decode("utf-8") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(run), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    def of(texts):
        tokens = merge_tokenizer(path)
        ids = tokens.encode_many(texts)
        decoded = []
        for x in ids:
            digest = hashlib.sha256()
            for part in tokens.decode(x):
                digest.update(part)
            decoded.append(digest.hexdigest())
        return [len(x) // 4 for x in ids], [hashlib.sha256(x).hexdigest() for x in ids], decoded

    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return _mapped(docs, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", fields, of)
