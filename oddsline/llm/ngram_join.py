"""Op 10. N-gram Jaccard self join: universe partition and the pigeonhole.

Two sets of sizes s and t with Jaccard similarity of at least 4/5 differ in
at most H = (s + t) // 9 elements. The universe of shingle hashes is cut into
segments, their number fixed per band of sizes; H differing elements touch at
most H segments, so of H + 1 non-empty segments of a set at least one holds
the very same subset in its partner.

* Index: every set emits a signature for each of its non-empty segments under
  its own size band's partition, and under the band below if it may be the
  larger set of a pair there. There are about a quarter more segments than
  H + 1, so most sets have more signatures than they need ("slack").
* One-deletion neighbourhoods: a set with too few non-empty segments also
  emits, for every segment, the subset and the subset without each element in
  turn; such a segment survives one difference and counts twice. A set for
  which even that is too little emits every element by itself.
* Cost-based allocation: only signatures that occur in two or more sets can
  give candidates, all others are free. A set may leave out as many signatures
  as it has slack; it leaves out those found in the most sets (passages that
  many documents share) and probes with the rest.
* Candidates are tied into clusters (a star per probed signature, then
  connected components), never listed pair by pair. Every cluster is cut into
  blocks of bounded size; each pair of blocks is compared exactly by counting
  common elements, and yields link counts and stars that name the components of its links.

Sets are compared once per distinct set: copies share a 64-bit fingerprint,
meet in a partial aggregation and add to the link counts of others only as a
weight. Signatures travel as packed arrays per (chunk of sets, bucket), and a
signature found often within a chunk sends one entry. Clusters' texts travel
compressed and are cut into shingles where they are compared, which is a
fraction of the bytes of their hashes. Elements are 64-bit
hashes of shingles, so equality holds up to hash collisions.

Defined cases: null or empty text has an empty set (n_shingles 0, no links,
a component of its own); fewer words than the shingle length make one
shingle; a component is named by its least non-null doc_id (null if there is
none); repeated rows are copies; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oddsline.llm.common import mix, shingle_set, tidy, written
from oddsline.llm.components import CONTRACTED, components, stars

SHINGLE = 5
SLACK = 1.25                 # segments per needed segment
CHUNK_SIGNATURES = 1_000_000  # packed together by a task
BUCKET_SIGNATURES = 1_000_000
BLOCK_SHINGLES = 1 << 18     # compared at once: two such blocks


def _bands() -> np.ndarray:
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, -(-3 * low[-1] // 2)))
    return np.array(low, np.int64)


LOW = _bands()  # band k holds sizes LOW[k] .. LOW[k+1] - 1
_TOP = LOW[1:] - 1
SEGMENTS = np.ceil(SLACK * ((5 * _TOP // 4 + _TOP) // 9 + 1)).astype(np.int64)  # of band k's partition


def linked(common, s, t):
    """Jaccard similarity of at least 4/5, in integers."""
    return 100 * common >= 80 * (s + t - common)


def fingerprint(h: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        x = mix(np.array([mix(h).sum(dtype=np.uint64) + np.uint64(len(h))], np.uint64))
    return int(x.view(np.int64)[0])


# ------------------------------------------------------------------ signatures

def _units(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, band, needed segments) of every role a set plays."""
    own = np.searchsorted(LOW, sizes, side="right") - 1
    need = (sizes + 5 * sizes // 4) // 9 + 1
    below = np.flatnonzero((own > 0) & (-(-4 * sizes // 5) < LOW[own]))
    need_below = (sizes[below] + LOW[own[below]] - 1) // 9 + 1
    return (np.concatenate((np.arange(len(sizes)), below)), np.concatenate((own, own[below] - 1)),
            np.concatenate((need, need_below)))


def _seed(band: np.ndarray, segment: np.ndarray, domain: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((band.astype(np.uint64) << np.uint64(50)) + (segment.astype(np.uint64) << np.uint64(2)) + np.uint64(domain))


def signatures(sets: list[np.ndarray]) -> tuple:
    """(signature, unit) of all roles of the sets, and (set, band, slack) of each unit."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, begin = np.concatenate(sets), np.cumsum(sizes) - sizes
    who, band, need = _units(sizes)
    n = sizes[who]
    at = np.repeat(begin[who] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    h, unit = flat[at], np.repeat(np.arange(len(who)), n)
    segment = ((h >> np.uint64(32)) * SEGMENTS[band].astype(np.uint64)[unit]) >> np.uint64(32)
    m = mix(h)
    first = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]) | (segment[1:] != segment[:-1]))))
    content = np.add.reduceat(m, first)
    run_unit, run_segment = unit[first], segment[first]
    with np.errstate(over="ignore"):
        sig = mix(content + _seed(band[run_unit], run_segment, 0))
    have = np.bincount(run_unit, minlength=len(who))
    slack = have - need
    size = np.diff(np.concatenate((first, [len(h)])))
    sigs, units = [sig], [run_unit]
    weak = np.flatnonzero(slack < 0)
    if len(weak):  # one-deletion neighbourhoods
        is_weak = np.zeros(len(who), bool)
        is_weak[weak] = True
        runs = np.flatnonzero(is_weak[run_unit])
        seeds = _seed(band[run_unit[runs]], run_segment[runs], 1)
        with np.errstate(over="ignore"):
            sigs.append(mix(content[runs] + seeds))
            units.append(run_unit[runs])
            more = runs[size[runs] > 1]
            k = size[more]
            e = np.repeat(first[more] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            sigs.append(mix(np.repeat(content[more], k) - m[e] + np.repeat(seeds[size[runs] > 1], k)))
            units.append(np.repeat(run_unit[more], k))
        strength = np.bincount(run_unit, weights=np.minimum(size, 2), minlength=len(who))
        rest = np.flatnonzero(strength < need)
        if len(rest):  # every element by itself
            is_weak[:] = False
            is_weak[rest] = True
            e = np.flatnonzero(is_weak[unit])
            with np.errstate(over="ignore"):
                sigs.append(mix(m[e] + _seed(band[unit[e]], np.zeros(len(e)), 2)))
            units.append(unit[e])
    return np.concatenate(sigs), np.concatenate(units), who, band, np.maximum(slack, 0)


_UNIT = np.dtype([("rec", "<i8"), ("band", "u1"), ("slack", "<u2")])


def _pack(sig: np.ndarray, unit: np.ndarray, table: np.ndarray) -> bytes:
    used, index = np.unique(unit, return_inverse=True)
    kind = "<u2" if len(used) <= 1 << 16 else "<u4"
    return (np.array([len(sig), len(used)], "<i8").tobytes() + sig.astype("<u4").tobytes()
            + table[used].tobytes() + index.astype(kind).tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, k = np.frombuffer(blob, "<i8", 2)
    at = 16
    sig = np.frombuffer(blob, "<u4", n, at)
    at += 4 * n
    table = np.frombuffer(blob, _UNIT, k, at)
    at += _UNIT.itemsize * k
    return sig, table[np.frombuffer(blob, "<u2" if k <= 1 << 16 else "<u4", n, at)]


def _chunk(sets: dict[int, np.ndarray], buckets: int):
    """A chunk's packed signatures: (bucket, entries, entries shared within the chunk)."""
    recs = np.array(list(sets), np.int64)
    sig, unit, who, band, slack = signatures(list(sets.values()))
    table = np.zeros(len(who), _UNIT)
    table["rec"], table["band"], table["slack"] = recs[who], band, np.minimum(slack, 65535)
    dealt = ((sig >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    short = sig & np.uint64(0xFFFFFFFF)
    order = np.lexsort((short, dealt)) if buckets >= 1 << 31 else np.argsort((dealt.astype(np.uint64) << np.uint64(32)) | short)
    short, unit, dealt = short[order], unit[order], dealt[order]
    new = np.concatenate(([True], (short[1:] != short[:-1]) | (dealt[1:] != dealt[:-1])))
    group = np.cumsum(new) - 1
    counts = np.bincount(group)
    many = counts[group] > 1
    edges = np.searchsorted(dealt, np.unique(dealt))
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(dealt)], strict=True):
        send, local = new[a:b], many[a:b]
        yield (int(dealt[a]), _pack(short[a:b][send], unit[a:b][send], table),
               _pack(short[a:b][local], unit[a:b][local], table) if local.any() else None)


def _emit(docs: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        def flush(sets):
            for bucket, shared, local in _chunk(sets, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([shared], pa.binary()),
                                                  pa.array([local], pa.binary())], ["bucket", "shared", "local"])

        sets: dict[int, np.ndarray] = {}
        size = 0
        for b in batches:
            for text in b.column(0):
                h = shingle_set(text.as_py(), SHINGLE)
                if len(h):
                    rec = fingerprint(h)
                    if rec not in sets:
                        sets[rec] = h
                        size += len(h)
                if size > CHUNK_SIGNATURES:
                    yield from flush(sets)
                    sets, size = {}, 0
        if sets:
            yield from flush(sets)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        tidy(run), "bucket int, shared binary, local binary")


def _survivors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Signatures of a bucket that occur in more than one set."""
    bucket = int(pdf["bucket"].iloc[0])
    parts = [_unpack(b) for b in pdf["shared"]]
    sig, unit = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(sig, kind="stable")
    s = sig[order]
    same = np.concatenate(([False], s[1:] == s[:-1]))
    keep = order[same | np.concatenate((same[1:], [False]))]
    local = [_unpack(b) for b in pdf["local"] if b is not None]
    sig = np.concatenate([sig[keep], *[p[0] for p in local]]).astype(np.int64)
    unit = np.concatenate([unit[keep], *[p[1] for p in local]])
    order = np.lexsort((unit["rec"], sig))
    sig, unit = sig[order], unit[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (unit["rec"][1:] != unit["rec"][:-1])
    sig, unit = sig[new], unit[new]
    _, group, counts = np.unique(sig, return_inverse=True, return_counts=True)
    counts = counts[group]
    ok = counts > 1
    return pd.DataFrame({"sig": (np.int64(bucket) << np.int64(32)) + sig[ok], "rec": unit["rec"][ok],
                         "band": unit["band"][ok].astype("int32"), "slack": unit["slack"][ok].astype("int32"),
                         "cost": counts[ok]})


# ------------------------------------------------------------------ verification

def _compare(recs, sets, copies, block, one_block: bool):
    """Exact links between the sets of a pair of blocks: (rec, partner, links)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    value = flat[order]
    start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    length = np.diff(np.concatenate((start, [len(value)])))
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.repeat(np.arange(len(start)), length)
    by_value = owner[order]
    begin = np.cumsum(sizes) - sizes
    links, ties, held = np.zeros(len(sets), np.int64), [], 0
    for a in range(len(sets)):
        r = rank[begin[a] : begin[a] + sizes[a]]
        r = r[length[r] > 1]
        if not len(r):
            continue
        k = length[r]
        at = np.repeat(start[r] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        common = np.bincount(by_value[at], minlength=len(sets))
        common[a] = 0
        hit = linked(common, sizes[a], sizes) & (common > 0)
        if not one_block:
            hit &= block != block[a]
        b = np.flatnonzero(hit)
        links[a] = copies[b].sum()
        b = b[b > a]
        if len(b):
            ties.append((np.full(len(b), a), b))
            held += len(b)
        if held > CONTRACTED:
            ties = [stars(*map(np.concatenate, zip(*ties, strict=True)))]
            held = 0
    has = np.flatnonzero(links)
    forest = list(zip(*(recs[x] for x in stars(*map(np.concatenate, zip(*ties, strict=True)))), strict=True)) if ties else []
    return ([int(recs[i]) for i in has] + [int(u) for u, _ in forest],
            [None] * len(has) + [int(v) for _, v in forest],
            [int(links[i]) for i in has] + [0] * len(forest))


def _verify(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("rec")
    i, j, unpack = pdf["i"].iloc[0], pdf["j"].iloc[0], zstandard.ZstdDecompressor()
    rec, partner, links = _compare(pdf["rec"].to_numpy(),
                                   [shingle_set(unpack.decompress(b).decode("utf-8"), SHINGLE) for b in pdf["text"]],
                                   pdf["copies"].to_numpy(np.int64), pdf["block"].to_numpy(), i == j)
    return pd.DataFrame({"rec": pd.array(rec, "Int64"), "partner": pd.array(partner, "Int64"), "links": pd.array(links, "Int64")})


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, rec) of every document; rec is null for an empty set."""
    def run(batches):
        for b in batches:
            n, rec = [], []
            for text in b.column(1):
                h = shingle_set(text.as_py(), SHINGLE)
                n.append(len(h))
                rec.append(fingerprint(h) if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(rec, pa.int64())],
                                             ["doc_id", "n_shingles", "rec"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(tidy(run), "doc_id long, n_shingles long, rec long")


def _texts(docs: DataFrame) -> DataFrame:
    """(rec, text): compressed texts, each set once per task."""
    def run(batches):
        pack, seen = zstandard.ZstdCompressor(level=3), set()
        for b in batches:
            rec, data = [], []
            for text in b.column(0).to_pylist():
                h = shingle_set(text, SHINGLE)
                if len(h) and (key := fingerprint(h)) not in seen:
                    seen.add(key)
                    rec.append(key)
                    data.append(pack.compress(text.encode("utf-8")))
            yield pa.RecordBatch.from_arrays([pa.array(rec, pa.int64()), pa.array(data, pa.binary())], ["rec", "text"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "rec long, text binary")


def candidate_clusters(docs: DataFrame, shingles: int) -> DataFrame:
    """(node, root): sets that a probed signature ties together, about ``shingles`` elements in all."""
    buckets = max(1, -(-shingles // (2 * BUCKET_SIGNATURES)))
    found = _emit(docs, buckets).groupBy("bucket").applyInPandas(
        _survivors, "sig long, rec long, band int, slack int, cost long")
    found = written(found, "signatures")
    dearest = Window.partitionBy("rec", "band").orderBy(F.col("cost").desc(), "sig")
    probed = found.withColumn("probe", F.row_number().over(dearest) > F.col("slack"))
    hubs = probed.groupBy("sig").agg(F.min("rec").alias("hub"), F.max("probe").alias("any")).where("any").select("sig", "hub")
    return components(found.select("sig", "rec").join(hubs, "sig").select(F.col("rec").alias("a"), F.col("hub").alias("b")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links (linked
    documents, copies included, itself not)."""
    rows = written(_sets(docs), "sets")
    classes = rows.where("rec is not null").groupBy("rec").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n_shingles").alias("n"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    clusters = candidate_clusters(docs, total)
    inside = written(clusters.select(F.col("node").alias("rec"), F.col("root").alias("cluster")).join(classes, "rec"), "clusters")
    blocks = inside.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    placed = (inside.join(blocks, "cluster")
              .withColumn("block", F.pmod(F.xxhash64("rec"), F.col("blocks")).cast("int"))
              .select("cluster", "rec", "copies", "block", "blocks"))
    # One plan at every size: the clustered sets grow with the data and are never broadcast.
    payload = _texts(docs).join(placed.hint("merge"), "rec").dropDuplicates(["rec"])
    pairs = (payload.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "rec", "copies", "block", "text"))
    links = written(pairs.groupBy("cluster", "i", "j").applyInPandas(_verify, "rec long, partner long, links long"), "links")
    joined = components(links.where("partner is not null").select(F.col("rec").alias("a"), F.col("partner").alias("b")))
    named = joined.join(classes.select(F.col("rec").alias("node"), "rep"), "node")
    names = named.groupBy("root").agg(F.min("rep").alias("component"))
    members = named.select(F.col("node").alias("rec"), "root").join(names, "root").select("rec", "component")
    degree = links.where("partner is null").groupBy("rec").agg(F.sum("links").alias("links"))
    answer = written(classes.join(members, "rec", "left").join(degree, "rec", "left").select(
        "rec", F.coalesce("component", "rep").alias("component"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("links")), "answer")
    # Copies of one set share a key, and its rows may be split: both sides are read from the shared folder.
    full = rows.where("rec is not null").join(answer, "rec").select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("links").alias("n_links"))
    return full.union(rows.where("rec is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))
