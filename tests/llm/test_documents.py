"""Operators on documents against plain versions: packing (3), toxicity (4),
token files (5), mixing (6) and the n-gram join (10)."""

import math
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oddsline.llm import mixing, ngram_join, packing, rans, tokens, toxicity
from oddsline.llm.queries import TOKENIZER
from oddsline.session import share_modules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
EDGE = ["", None, " \n\t", "one", "one two three four", "a\tb\x1cc d e", "Don't STOP it's <|endoftext|> x<|endoftext|>",
        "naïve… “q” 日本語 🙂🙂 ÅB İstanbul ΣΑΣ", "x_y __ 12,3.5 'S o'clock", "w" * 9000, "ab " * 6000, "\n\n a\r\nb\x0bc\x85d"]


@pytest.fixture(scope="module", autouse=True)
def modules(spark):
    share_modules(spark)


def documents(spark, rows, extra=True):
    df = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    return df.withColumns({"score": F.lit("x"), "block": F.lit(1), "size": F.lit(None), "rec": F.lit(2)}) if extra else df


def word_ids(text, end):
    t = Tokenizer.from_file(TOKENIZER)
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


# ------------------------------------------------------------------ tokens

def test_word_table_gives_the_tokenizers_ids(monkeypatch):
    full = Tokenizer.from_file(TOKENIZER)
    texts = [t for t in EDGE if t is not None]
    for most in (50, 1_200_000):  # a table that must be emptied again and again, too
        monkeypatch.setattr(tokens, "MAX_PIECES", most)
        enc = tokens.WordTokenizer(TOKENIZER)
        got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode_many(texts * 2)]
        assert got == [full.encode(t, add_special_tokens=False).ids for t in texts * 2]


# ------------------------------------------------------------------ 3

def check_packing(spark, rows):
    got = packing.pack_documents(documents(spark, rows), TOKENIZER).collect()
    cover = {}
    for r in got:
        assert 0 < r.length <= 4096
        cover.setdefault(r.doc_id, []).append(r)
    for i in {i for i, *_ in rows}:
        texts = [t for j, t, _ in rows if i == j]
        ids = word_ids(texts[0], 2)
        parts = sorted(cover[i], key=lambda r: r.start)
        assert sum(r.length for r in parts) == len(ids) * len(texts)
        for r in parts:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for w in windows.values():
        at = 0
        for o, n in sorted(w):
            assert o == at
            at += n
        assert at <= 4096
    return len(windows), sum(r.length for r in got)


def test_packing_edges(spark):
    check_packing(spark, [(k, t, "s") for k, t in enumerate(EDGE)] + [(3, "one", "s"), (None, "null id", "s")])
    assert documents(spark, []).count() == 0
    assert packing.pack_documents(documents(spark, []), TOKENIZER).collect() == []


def test_best_fit_takes_the_tightest_window():
    where, offset = packing.best_fit([6, 5, 4, 3, 2], window=10)
    assert where.tolist() == [0, 1, 0, 1, 1] and offset.tolist() == [0, 0, 6, 5, 8]
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 4095) for _ in range(3000)), reverse=True)
    where, _ = packing.best_fit(lengths)
    assert where.max() + 1 <= 1.03 * sum(lengths) / 4096 + 1


# ------------------------------------------------------------------ 4

def test_toxicity_learns_and_handles_edges(spark):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(700):
        words = rng.choices(plain, k=rng.randint(5, 60))
        toxic = i % 6 == 0
        if toxic:
            for k in range(rng.randrange(4), len(words), 4):
                words[k] = rng.choice(["idiot", "stupid", "zorglub", "worthless"])
        rows.append((i, " ".join(words), f"s{i % 3}"))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, None), (901, "", "s"), (902, "idiot " * 20000, "s"), (None, "hello", "s"), (1, rows[1][1], "s")]
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    by = {r.doc_id: r for r in got}
    assert by[900].predicted == by[901].predicted == 0 and by[902].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    none = toxicity.toxicity(docs, marks.where("false"))
    assert none.count() == len(rows)
    assert toxicity.toxicity(docs.where("false"), marks).collect() == []


def test_held_out_labels_are_never_read(spark):
    rows = [(i, "you stupid idiot" if i % 2 else "a nice day", "s") for i in range(60)]
    docs = documents(spark, rows)
    flip = lambda i: i % 2 ^ (crc32(str(i).encode()) % 5 == 0)  # noqa: E731  wrong where it is held out
    a = toxicity.fit(docs, spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int"))
    b = toxicity.fit(docs, spark.createDataFrame([(i, 1, int(flip(i))) for i in range(60)], "doc_id long, quality int, toxic int"))
    assert np.array_equal(a.weights, b.weights)


# ------------------------------------------------------------------ 5

def test_rans_round_trip_and_checkpoints():
    rng = np.random.default_rng(0)
    ids = (rng.zipf(1.3, 600_000) % 500).astype(np.uint32)
    table = rans.Table(rans.normalise(np.bincount(ids, minlength=700)))
    assert table.freq.sum() == 1 << rans.SCALE and table.freq.min() >= 1
    for n in (1, 33, 5000, len(ids)):
        coded = rans.encode(ids[:n], table)
        assert (rans.decode(n, *coded, table) == ids[:n]).all()
        spans = -(-n // (coded[0] * rans.CHECKPOINT))
        assert (np.concatenate([rans.decode(n, *coded, table, span=k) for k in range(spans)]) == ids[:n]).all()
    a, b = b"hello", b"world" * 99
    assert rans.crc_join(crc32(a), crc32(b), len(b)) == crc32(a + b)


@pytest.mark.parametrize("block", [500, 1 << 20])
def test_rans_files_read_back(spark, block):
    rows = [(k, t, "s") for k, t in enumerate(EDGE)] + [(None, "null id", "s"), (3, "one", "s"), (-5, "first", "s")]
    got = sorted(rans.encode_documents(documents(spark, rows), TOKENIZER, block=block).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, (i, t, _) in zip(got, order, strict=True):
        ids = word_ids(t, 1)
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(ids))
        assert r.ids_crc32 == crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert rans.encode_documents(documents(spark, []), TOKENIZER).collect() == []


def test_rans_detects_damage(spark):
    path = rans.scratch(spark, "damage")
    rans.write_files(documents(spark, [(k, "some words here", "s") for k in range(50)]), TOKENIZER, path)
    bad = f"{path}-bad"
    spark.read.parquet(f"{path}/table").write.parquet(f"{bad}/table")
    spark.read.parquet(f"{path}/blocks").withColumn("ids_crc32", F.col("ids_crc32") + 1).write.parquet(f"{bad}/blocks")
    with pytest.raises(Exception, match="checksum"):
        rans.read_files(spark, bad).collect()


# ------------------------------------------------------------------ 6

def test_targets_stop_at_three_times_the_source():
    got = mixing.targets({"a": 100, "b": 10, "c": 100}, {"a": 1, "b": 2, "c": 3}, 210)
    assert got["b"] == 30 and got["a"] + got["c"] == pytest.approx(180) and got["c"] == pytest.approx(3 * got["a"])
    assert mixing.targets({}, {}, 0) == {} and mixing.targets({"a": 0}, {"a": 1}, 0) == {"a": 0.0}


def test_flow_spreads_repetition_over_overlapping_sources():
    # "both" can serve either quota; filling b needs it, so a falls back on its own documents.
    assert mixing.route([("a",), ("a", "b")], [10, 10], {"a": 10, "b": 10}) == [10, 10]
    assert mixing.route([("a",), ("a", "b")], [10, 10], {"a": 5, "b": 30}) == [5, 30]
    assert mixing.route([("a",)], [10], {"a": 30}) == [30]


def test_mixing_nears_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["hot", "hot", "hot", "b", "c", None])) for i in range(4000)]
    rows += [(5000, None, "b"), (5001, "", None), (7, "x y", "tiny"), (7, "x y", "tiny"), (None, "z", "c")]
    sized = mixing.sized(documents(spark, rows))
    got = mixing.mixed(sized, mixing.plan(sized)).collect()
    again = mixing.mixed(sized, mixing.plan(sized)).collect()
    key = lambda r: (r.key is not None, r.key or 0, r.size, r.sources[0] or "", r.copies)
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    assert all(0 <= r.copies <= 3 for r in got)
    sizes, taken, goal = {}, {}, {}
    for r in got:
        s = r.sources[0]
        sizes[s], taken[s], goal[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.size * r.copies, r.target
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", next(t or "" for i, t, z in rows if i == r.key and z == s)))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets(sizes, {s: k % 3 + 1 for k, s in enumerate(order)}, sum(sizes.values()))
    for s in sizes:
        assert goal[s] == pytest.approx(want[s]) and abs(taken[s] - goal[s]) <= max(3, 0.01 * goal[s])
    empty = mixing.sized(documents(spark, []))
    assert mixing.mixed(empty, mixing.plan(empty)).collect() == []


def test_mixing_places_what_a_long_document_leaves(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    # Source a has documents with a tenth of its words each, by many short ones.
    rng = random.Random(0)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), s) for s, k in (("a", 0), ("b", 10_000)) for i in range(k, k + 1500)]
    words = sum(len(t.split()) for _, t, s in rows if s == "a")
    rows += [(20_000 + k, " ".join(["w"] * (words // 5)), "a") for k in range(5)]
    sized = mixing.sized(documents(spark, rows))
    for at in range(5):  # long documents lie before, in or after the bucket at the boundary
        got = mixing.mixed(sized, mixing.plan(sized, seed=at), seed=at).collect()
        taken, goal = {}, {}
        for r in got:
            taken[r.sources[0]], goal[r.sources[0]] = taken.get(r.sources[0], 0) + r.size * r.copies, r.target
        missed = {s: round(goal[s]) - taken[s] for s in goal}
        assert len(got) == len(rows) and all(abs(n) <= 2 for n in missed.values()), (at, missed)


def test_mixing_exchanges_documents_at_the_boundary():
    def fill(sizes, rest):
        n = len(sizes)
        return mixing._fill(pa.table({"order": list(range(n)), "key": list(range(n)), "size": sizes, "rest": [rest] * n}))

    assert fill([4, 9, 7], 10) == ({1}, 1)          # 4 goes, 9 comes: nearer than 7
    assert fill([5, 5, 8, 0], 10) == ({0, 1}, 0)
    assert fill([4, 6, 6], 11) == ({0, 1}, 1)       # nothing gains
    assert fill([20, 30], 10) == (set(), 10)
    rng = random.Random(1)
    for _ in range(300):
        sizes, rest = [rng.randint(0, 40) for _ in range(rng.randint(1, 9))], rng.randint(1, 120)
        placed, left = fill(sizes, rest)
        assert left == rest - sum(sizes[i] for i in placed) >= 0
        outside = [z for i, z in enumerate(sizes) if i not in placed and z]
        assert all(z > left for z in outside)
        assert all(not 0 < z - sizes[i] <= left for z in outside for i in placed)


def test_mixing_runs_over_parts_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 8)
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), rng.choice(["a", "a", "b", None])) for i in range(1500)]
    sized = mixing.sized(documents(spark, rows))
    key = lambda r: (r.key, r.copies)
    whole = sorted(mixing.mixed(sized, mixing.plan(sized)).collect(), key=key)
    monkeypatch.setattr(mixing, "PART", 3)
    assert sorted(mixing.mixed(sized, mixing.plan(sized)).collect(), key=key) == whole


# ------------------------------------------------------------------ 10

def shingles(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            u = len(sets[a] | sets[b])
            if u and 100 * len(sets[a] & sets[b]) >= 80 * u:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    name = {}
    for k, r in enumerate(rows):
        name[find(k)] = min(name.get(find(k), r[0]), r[0])
    return sorted((r[0], len(sets[k]), name[find(k)], links[k]) for k, r in enumerate(rows))


def near_copies(seed, families=25, members=8):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 6, 8, 12, 20, 45, 150, 400]))]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 12)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(50)}"
            cut = rng.randrange(0, 1 + len(text) // 8)
            rows.append((len(rows), " ".join(text[cut:] if rng.random() < 0.3 else text).upper() if rng.random() < 0.2 else " ".join(text), "s"))
    rows += [(len(rows) + k, t, "s") for k, t in enumerate(EDGE)]
    return rows + [(rows[0][0], rows[0][1], "s")]  # a repeated row


@pytest.mark.parametrize("seed,slack,block", [(1, 1.25, 1 << 18), (2, 0.3, 1 << 18), (3, 1.25, 300)])
def test_ngram_join_equals_brute_force(spark, monkeypatch, seed, slack, block):
    """Also with far too few segments (deletion neighbourhoods and single
    elements carry the join) and with clusters cut into many blocks."""
    top = ngram_join._TOP
    monkeypatch.setattr(ngram_join, "SEGMENTS", np.maximum(1, np.ceil(slack * ((5 * top // 4 + top) // 9 + 1))).astype(np.int64))
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    rows = near_copies(seed)
    got = ngram_join.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == brute(rows)


def test_signatures_meet_for_every_linked_pair():
    """The pigeonhole itself, without Spark: linked sets share a probed-side signature."""
    rng = np.random.default_rng(4)
    for size in (1, 2, 4, 5, 8, 9, 20, 60, 300):
        for _ in range(60):
            a = np.unique(ngram_join.mix(rng.integers(1, 1 << 62, size).astype(np.uint64)))
            change = rng.integers(0, size // 4 + 1)
            b = np.unique(np.concatenate((a[change:], ngram_join.mix(rng.integers(1, 1 << 62, rng.integers(0, size // 4 + 1)).astype(np.uint64)))))
            common = len(np.intersect1d(a, b))
            if not len(b) or not ngram_join.linked(common, len(a), len(b)):
                continue
            sig, unit, who, _, _ = ngram_join.signatures([a, b])
            assert set(sig[who[unit] == 0].tolist()) & set(sig[who[unit] == 1].tolist())


def test_ngram_join_of_nothing(spark):
    assert ngram_join.near_duplicates(documents(spark, [])).collect() == []
    got = ngram_join.near_duplicates(documents(spark, [(None, "a b", "s"), (4, None, "s"), (None, "a b", "s")])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.n_links) for r in got if r.doc_id) == [(4, 0, 4, 0)]
    assert [(r.n_shingles, r.component_id, r.n_links) for r in got if r.doc_id is None] == [(1, None, 1)] * 2


def plain_label_model(votes, labels, rounds):
    """Expectation maximisation, one row and one voter at a time."""
    n, m = len(votes), len(votes[0])
    q = [0.9 if y else 0.1 for y in labels]
    for step in range(rounds):
        prior, by_class = min(max(sum(q) / n, 1e-3), 0.999), ([1 - x for x in q], q)
        rate = [[{v: (sum(wi for wi, row in zip(w, votes) if row[k] == v) + {1: 0.3, -1: 0.3, 0: 0.4}[v]) / (sum(w) + 1) for v in (1, -1, 0)}
                 for k in range(m)] for w in by_class]
        right = [(sum(wi for wi, y in zip(w, labels) if y == c) + 0.9 * toxicity.LABEL_SEEN) / (sum(w) + toxicity.LABEL_SEEN)
                 for c, w in enumerate(by_class)]
        share = [1.0] * m
        if step >= 2:
            most = [[0.0] * m for _ in range(m)]
            for w in by_class:
                mean = [sum(wi * row[k] for wi, row in zip(w, votes)) / sum(w) for k in range(m)]
                cov = [[sum(wi * (row[i] - mean[i]) * (row[j] - mean[j]) for wi, row in zip(w, votes)) / sum(w) for j in range(m)]
                       for i in range(m)]
                for i in range(m):
                    for j in range(m):
                        most[i][j] = max(most[i][j], cov[i][j] / math.sqrt(cov[i][i] * cov[j][j]))
            share = [1 / (1 + sum(most[k][j] for j in range(m) if j != k and most[k][j] > 0.2)) for k in range(m)]
        new = []
        for row, y in zip(votes, labels):
            z = math.log(prior / (1 - prior)) + sum(share[k] * math.log(rate[1][k][v] / rate[0][k][v]) for k, v in enumerate(row))
            z += math.log(right[1] / (1 - right[0])) if y else math.log((1 - right[1]) / right[0])
            new.append(1 / (1 + math.exp(-min(max(z, -30), 30))))
        q = new
    return q, prior, right, share


def test_label_model_equals_a_plain_one():
    rng = random.Random(8)
    votes, labels = [], []
    for i in range(120):
        hidden = i % 5 == 0
        say = lambda p1, p0, v: v if rng.random() < (p1 if hidden else p0) else 0
        first = say(0.8, 0.1, 1)
        votes.append([first, first if rng.random() < 0.9 else 0, say(0.6, 0.05, 1), say(0.2, 0.7, -1), rng.choice([-1, 0, 1])])
        labels.append(int(hidden) if rng.random() < 0.9 else int(not hidden))
    for rounds in (1, 2, 4):
        model = toxicity.LabelModel(np.array(votes, np.int8), np.array(labels), rounds)
        q, prior, right, share = plain_label_model(votes, labels, rounds)
        assert np.allclose(model.posterior, q, atol=1e-9) and abs(model.prior - prior) < 1e-9
        assert np.allclose(model.label_right, right) and np.allclose(model.share, share)
    done = toxicity.LabelModel(np.array(votes, np.int8), np.array(labels))
    truth = np.arange(120) % 5 == 0
    assert ((done.posterior > 0.5) == truth).mean() > (np.array(labels) == truth).mean()  # better than the labels alone
    assert done.share[0] < 0.75 and done.share[1] < 0.75  # one voter repeats the other


def test_toxicity_with_one_class_or_no_label():
    rude, kind = "you are a stupid idiot and a worthless clown , loser {}", "the garden is green and the river runs by the town {}"
    texts = [(rude if i % 5 == 0 else kind).format(i) for i in range(100)]
    for one in (0, 1):  # labels of one class tell nothing; the voters do
        s = toxicity.train(texts, [one] * 100).score([rude, kind, "", None])
        assert s[0] > 0.5 > s[1] and s[2] < 0.5 and s[2] == s[3]
    s = toxicity.train([], []).score([rude, kind, ""])
    assert s[0] > 0.5 > s[1] and s[2] < 0.5
    for n in (7, 20):  # few rows
        s = toxicity.train(texts[:n], [int(i % 5 == 0) for i in range(n)]).score([rude, kind])
        assert ((0 <= s) & (s <= 1)).all() and (n == 7 or s[0] > 0.5 > s[1])
