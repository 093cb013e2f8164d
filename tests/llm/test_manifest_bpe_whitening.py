"""Operators 11 (Merkle manifest), 12 (BPE) and 13 (whitening) against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oddsline.llm import bpe, merkle, whitening
from oddsline.llm.queries import TOKENIZER
from oddsline.session import share_modules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module", autouse=True)
def modules(spark):
    share_modules(spark)


# ------------------------------------------------------------------ 11

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def siblings(level, at):
    """Levels of a tree, and the siblings of a leaf with their side."""
    path = []
    while len(level) > 1:
        if (at ^ 1) < len(level):
            path.append((level[at ^ 1], not at & 1))
        else:
            path.append(None)
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
        at >>= 1
    return level[0], path


def plain_audit(rows):
    first = lambda v: (v is not None, v)
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        trees.setdefault(lang, []).append((doc_id, plain_leaf(doc_id, source, lang, n_chars, text), source, n_chars, text))
    order = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for t in trees.values():
        t.sort(key=lambda r: (first(r[0]), r[1]))
    subroots = [siblings([r[1] for r in trees[lang]], 0)[0] for lang in order]
    out = []
    for k, lang in enumerate(order):
        root, above = siblings(subroots, k)
        for at, (doc_id, leaf, source, n_chars, text) in enumerate(trees[lang]):
            path = siblings([r[1] for r in trees[lang]], at)[1] + above
            now = leaf
            if doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                now = plain_leaf(doc_id, source, lang, n_chars + 1, text)
            for step in path:
                now = h(now) if step is None else h(now, step[0]) if step[1] else h(step[0], now)
            out.append((doc_id, leaf, subroots[k], root, h(*(s[0] for s in path if s)), now, now == root))
    return sorted(out, key=str)


def odd_docs():
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 9), rng.choice(["en", "de", "zz", "é"]), rng.choice(["s", None, ""]), i * 3) for i in range(61)]
    rows += [(100, None, None, None, None), (101, "", "", "", 0), (102, "w " * 200_000, "en", "s", 400_000),
             (None, "a", "en", "s", 1), (None, "b", "en", "s", 1), (7, "other", "de", "s", 1), (7, "other", "de", "s", 1),
             (-5, "neg", "solo", "s", 2**63 - 1), (13, "null n_chars", "de", "s", None)]
    return rows


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest_against_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "FETCHES", 3)
    rows = odd_docs()
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("at", "n", "tree", "leaf", "digest", "part")})
    assert sorted([tuple(r) for r in merkle.audit(df, levels).collect()], key=str) == plain_audit(rows)


def test_manifest_of_many_blocks(spark):
    """Several blocks a tree, so that nodes are fetched."""
    df = spark.range(5000).selectExpr("id as doc_id", "concat('t', id) as text", "if(id % 3 = 0, 'a', concat('b', id % 2)) as lang",
                                      "'s' as source", "if(id % 11 = 0, null, id) as n_chars")
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted([tuple(r) for r in merkle.audit(df).collect()], key=str) == plain_audit(rows)


def test_manifest_proofs_and_empty_table(spark):
    assert merkle.audit(spark.createDataFrame([], DOCS)).collect() == []
    df = spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", "en", "s", 1)], DOCS)
    rows = {r.doc_id: r for r in merkle.Manifest(merkle.document_leaves(df)).proofs().collect()}
    assert rows[1].proof == rows[2].leaf and rows[2].proof == rows[1].leaf


def test_octopus_is_the_least_union():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 40)
        known = rng.sample(range(n), rng.randint(1, n))
        need, have = set(), set()
        for k in known:
            at = k
            for level in range(merkle.height(n)):
                have.add((level, at))
                if at ^ 1 < merkle.width(n, level):
                    need.add((level, at ^ 1))
                at >>= 1
        assert sorted(merkle.octopus(np.array(known), n)) == sorted(need - have)


# ------------------------------------------------------------------ 12

def test_bpe_equals_the_library(spark):
    rng = random.Random(6)
    alphabet = list("abcdefghij'stredvmll  \n\tAÉéßñΣσςİıKÅǺ̈ 　​0129½²①,.!?-_<|>endoftext😀👍漢字かなكहि์ﬁ\x00\x1c\x85")
    texts = [None, "", " ", "<|endoftext|>", "a<|startoftext|><|endoftext|> b", "<|endoftext", "aaaaaaaaaaaa", "ab" * 20_000,
             "DON'T it's i've we'll", "ΣΑΣ ΟΔΟΣ", "long text, " * 150_000]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    rows = [(i if i != 5 else None, t, "en", "s", 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).withColumns({"ids": F.lit(1), "n_tokens": F.lit("x")})
    library = Tokenizer.from_file(TOKENIZER)
    want = {}
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(df, TOKENIZER).collect()}
    assert got == want
    assert bpe.round_trip(df.where("false"), TOKENIZER).collect() == []
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df.where("doc_id < 4"), TOKENIZER), TOKENIZER).collect()}
    assert back == {0: "", 1: "", 2: "", 3: "<|endoftext|>"}


def test_bpe_decodes_long_and_unknown_ids(monkeypatch):
    tokens = bpe.merge_tokenizer(TOKENIZER)
    ids = tokens.encode_many(["some words to cut, and more of them"])[0]
    whole = b"".join(tokens.decode(ids))
    monkeypatch.setattr(bpe, "DECODED", 3)
    assert b"".join(tokens.decode(ids)) == whole and whole.startswith(b"some</w> words</w> to</w>")
    assert b"".join(tokens.decode(np.array([320, 10**6, 320], "<u4").tobytes())).count(b" ") == 1


def test_merges_equal_one_merge_at_a_time():
    """The rounds against the textbook loop, on a small vocabulary with overlaps."""
    symbols = bpe.byte_symbols()
    vocab = {s: i for i, s in enumerate([*symbols, *(s + "</w>" for s in symbols)])}
    pairs = [("a", "a"), ("a", "b"), ("aa", "aa"), ("b", "a"), ("aa", "b"), ("ab", "ab"), ("aaaa", "a</w>"), ("b", "b</w>")]
    for a, b in pairs:
        vocab[a + b] = len(vocab)
    merges = bpe.Merges({"type": "BPE", "vocab": vocab, "merges": [list(p) for p in pairs], "end_of_word_suffix": "</w>"})
    rng = random.Random(7)
    words = ["".join(rng.choices("aab", k=rng.randint(1, 14))) for _ in range(400)]
    want = []
    for w in words:
        now = [*w[:-1], w[-1] + "</w>"]
        while True:
            found = [(pairs.index(p), k) for k, p in enumerate(zip(now, now[1:], strict=False)) if p in pairs]
            if not found:
                break
            _, k = min(found)
            now[k : k + 2] = [now[k] + now[k + 1]]
        want.append([vocab[s] for s in now])
    ids, counts = merges.merge(np.frombuffer("".join(words).encode(), np.uint8), np.array([len(w) for w in words]))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


# ------------------------------------------------------------------ 13

def plain_whitening(rows, k=4):
    """By the full covariance matrix: rows of (vec_id, component, n, deviation, |whitened|, explained)."""
    kept = [(i, v) for i, v, _ in rows if v is not None and not any(x is None or not math.isfinite(x) for x in v)]
    dims = max(len(v) for _, v in kept)
    x = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dims - len(v)) for _, v in kept]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array(sums) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = []
    for (i, _), row in zip(kept, x, strict=True):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True))
        for j in range(len(e)):
            if e[j] > 1e-9 * e[0]:
                out.append((i, j + 1, n, deviation, abs((np.array(row) - np.array(sums) / n) @ v[:, j] / math.sqrt(e[j])),
                            e[j] / np.trace(centred.T @ centred / n)))
    return out


def compare(got, want):
    key = lambda r: (str(r[0]), r[1], r[3], r[4])
    got = sorted([(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got], key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    np.testing.assert_allclose([r[4:] for r in got], [r[4:] for r in want], atol=1e-8)


def test_whitening_against_the_covariance_matrix(spark, monkeypatch):
    rng = np.random.default_rng(8)
    mixing = rng.normal(size=(7, 7)) * 3
    rows = [(i, (rng.normal(size=7) @ mixing).tolist(), 0) for i in range(400)]
    rows += [(i, rows[0][1], 0) for i in range(400, 450)]  # copies count once in the fit
    rows += [(500, None, 0), (501, [1.0, None, 0, 0, 0, 0, 0], 0), (502, [math.nan] * 7, 0), (503, [math.inf] * 7, 0),
             (504, [], 0), (505, [2.0, 1.0], 0), (None, [1.0] * 7, 0), (3, [-0.001] * 7, 0)]
    rows = [(i, v and [c if c is None else float(c) for c in v], k) for i, v, k in rows]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("n", "x", "data", "component")})
    got = whitening.whiten(df).collect()
    compare(got, plain_whitening(rows))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 50)
    compare(whitening.whiten(df).collect(), plain_whitening(rows))


def test_whitening_of_few_directions(spark):
    def run(vectors):
        rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)]
        return whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect(), rows

    assert run([])[0] == [] and run([[1, 2]])[0] == [] and run([[1, 2]] * 5)[0] == [] and run([[]])[0] == []
    line, rows = run([[k, 2 * k, 0] for k in range(9)])  # one direction
    compare(line, plain_whitening(rows))
    assert {r.component for r in line} == {1}
    # Deviations 3, 3, 2, 2 and 1: an exhausted Krylov space, and repeated ones.
    axes = [[s * a * (d == k) for d in range(5)] for k, a in enumerate([3, 3, 2, 2, 1]) for s in (-1, 1)]
    got, _ = run(axes)
    assert sorted({(r.component, round(r.explained, 9)) for r in got}) == [(1, round(9 / 27, 9)), (2, round(9 / 27, 9)), (3, round(4 / 27, 9)), (4, round(4 / 27, 9))]
    assert got[0].identity_error < 1e-9


def test_whitening_with_huge_entries(spark):
    rows = [(0, [3e38, 1.0], 0), (1, [-3e38, 2.0], 0), (2, [1e15, -5.0], 0)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.deviation for r in got} == {None} and all(math.isfinite(r.whitened) for r in got)


# ------------------------------------------------------------------ components, rewritten in this round

def test_components_over_many_tasks(spark):
    from oddsline.llm.components import components, stars

    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(3000)] + [(5000, rng.randrange(6000, 9000)) for _ in range(4000)]
    edges += [(20_000 + 2 * k, 20_001 + 2 * k) for k in range(500)] + [(7, 7), (50_000, 50_000)]
    rng.shuffle(edges)
    want = {k: 0 for k in range(3001)} | {x: 5000 for e in edges if e[0] == 5000 for x in e}
    want |= {x: min(e) for e in edges if 20_000 <= e[0] < 50_000 for x in e}
    for tasks in (1, 40):
        got = components(spark.createDataFrame(edges, "a long, b long").repartition(tasks))
        assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
    node, root = stars(np.array([5, 4, 9]), np.array([4, 3, 9]))
    assert node.tolist() == [4, 5] and root.tolist() == [3, 3]
