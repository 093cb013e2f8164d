"""Op 6. Mixing sources to target weights: min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their
pattern). A flow network then decides how many words of each pattern go to
each source's quota: a pattern may be used up to ``COPIES`` times, and each
further repetition costs more (convex), so repetition is spread before it is
piled up. The network has a node per pattern and source and is solved by
successive shortest paths; only these aggregates reach the driver.

Documents of a pattern are then chosen in a seeded order: everything is taken
as often as the flow fills whole passes, and for the rest, documents are dealt
into seeded buckets whose sizes are summed up; buckets before the boundary are
taken whole, and the bucket at the boundary is filled document by document;
then documents of it are exchanged for others of it that fill the target
better. What that bucket cannot place goes on to the next buckets in the same
way, until it is below the smallest document left. Every step is an
aggregation of the buckets' sums (in two levels, so that no task holds all
buckets of a source) and one small grouped step, whatever the size of a source.

Defined cases: null text has size 0; a null source is a source of its own,
last in order; documents without any source are not taken; documents of size
0 count no words (they follow their pattern's whole passes); repeated rows are
documents of their own; an empty table gives an empty result; extra columns
are kept by ``mixed`` and ignored by the query.
"""

from __future__ import annotations

import bisect
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oddsline.llm.common import WORD, written

COPIES = 3          # no document is used more often
BUCKET_ROWS = 256   # documents in a seeded bucket, about
PART = 4096         # buckets whose sums are run over in one task
BROADCAST_ROWS = 100_000  # patterns; beyond, an ordinary join


def words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, total: float, copies: int = COPIES) -> dict:
    """Shares of ``total`` by weight; a share stops at ``copies`` times its
    source's size and the excess is shared again by weight among the others."""
    out, free, left = {}, [s for s in sizes], float(total)
    while free:
        weight = sum(weights[s] for s in free)
        share = {s: left * weights[s] / weight for s in free}
        above = [s for s in free if share[s] > copies * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = float(copies * sizes[s])
        left -= sum(out[s] for s in above)
        free = [s for s in free if s not in above]
    return out


class Network:
    """Min-cost flow by successive shortest paths (Dijkstra with potentials)."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to, self.room, self.cost = [], [], []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        potential = [0] * len(self.out)
        while True:
            far, via = [None] * len(self.out), [-1] * len(self.out)
            far[source], queue = 0, [(0, source)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    b = self.to[e]
                    step = d + self.cost[e] + potential[a] - potential[b]
                    if self.room[e] > 0 and (far[b] is None or step < far[b]):
                        far[b], via[b] = step, e
                        heapq.heappush(queue, (step, b))
            if far[sink] is None:
                return
            potential = [p + (d if d is not None else far[sink]) for p, d in zip(potential, far, strict=True)]
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.to[via[at] ^ 1]
            push = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= push
                self.room[e ^ 1] += push


def route(patterns: list[tuple], sizes: list[int], quotas: dict, copies: int = COPIES) -> list[int]:
    """Words taken of each pattern so that the quotas are filled at the least repetition."""
    sources = list(quotas)
    node = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    net = Network(2 + len(patterns) + len(sources))
    sink = len(net.out) - 1
    used = []
    for p, (members, size) in enumerate(zip(patterns, sizes, strict=True)):
        used.append([net.arc(0, 1 + p, int(size), n * n) for n in range(copies)])
        for s in members:
            if s in node:
                net.arc(1 + p, node[s], int(copies * size), 0)
    for s in sources:
        net.arc(node[s], sink, int(quotas[s]), 0)
    net.run(0, sink)
    return [sum(net.room[e ^ 1] for e in arcs) for arcs in used]


def _order(s):
    return (s is None, (s or "").encode("utf-8"))


def plan(sized: DataFrame, weight_cycle: tuple[int, ...] = (1, 2, 3), seed: int = 11) -> DataFrame:
    """What to take of every pattern. ``sized``: key, sources (array), size.

    Columns: sources, source_size, target (of the pattern's first source),
    passes, buckets, and steps: buckets from ``first`` to before ``bucket`` are
    taken whole, of ``bucket`` the documents that fit ``rest``."""
    spark = sized.sparkSession
    rows = sized.groupBy("sources").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # aggregates
    rows = sorted(rows, key=lambda r: [_order(s) for s in r["sources"] or []])
    patterns = [tuple(r["sources"] or ()) for r in rows]
    totals: dict = {}
    for p, r in zip(patterns, rows, strict=True):
        for s in p:
            totals[s] = totals.get(s, 0) + r["size"]
    order = sorted(totals, key=_order)
    weights = {s: weight_cycle[i % len(weight_cycle)] for i, s in enumerate(order)}
    goal = targets({s: totals[s] for s in order}, weights, sum(r["size"] for r in rows))
    quotas = {s: min(round(goal[s]), COPIES * totals[s]) for s in order}
    flow = route(patterns, [r["size"] for r in rows], quotas)
    made = []
    for p, r, f in zip(patterns, rows, flow, strict=True):
        passes, rest = divmod(f, r["size"]) if r["size"] else (0, 0)
        made.append((list(p), int(totals[p[0]]) if p else 0, float(goal[p[0]]) if p else 0.0, int(passes),
                     int(-(-r["n"] // BUCKET_ROWS)), int(rest)))
    schema = T.StructType([T.StructField("sources", T.ArrayType(T.StringType())), T.StructField("source_size", T.LongType()),
                           T.StructField("target", T.DoubleType()), T.StructField("passes", T.LongType()),
                           T.StructField("buckets", T.IntegerType()), T.StructField("rest", T.LongType())])
    first = spark.createDataFrame([m[:5] for m in made], T.StructType(schema.fields[:5]))
    sums = written(_with(sized, first.select("sources", "buckets"), len(made)).withColumn("bucket", _bucket(seed))
                   .groupBy("sources", "bucket").agg(F.sum("size").alias("size"),
                                                     F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")), "buckets")
    steps: dict = {tuple(m[0]): [] for m in made}
    buckets = {tuple(m[0]): m[4] for m in made}
    left = {tuple(m[0]): (0, m[5]) for m in made if m[5] > 0}  # of a pattern: the next bucket, words to place
    while left:
        edge = {}
        for e in _edges(sums, left).collect():  # one row per pattern
            of, at = tuple(e["sources"]), e["edge"]
            steps[of].append((e["first"], at["bucket"] if at else buckets[of], at["rest"] if at else 0))
            if at and at["rest"] > 0:
                edge[of] = (at["bucket"], at["rest"])
        left = {of: (edge[of][0] + 1, n) for of, n in _unplaced(sized, edge, buckets, seed).items() if n > 0} if edge else {}
    return spark.createDataFrame([(*m[:5], steps[tuple(m[0])]) for m in made], T.StructType(
        [*schema.fields[:5], T.StructField("steps", T.ArrayType(T.StructType([
            T.StructField("first", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("rest", T.LongType())])))]))


def _edges(sums: DataFrame, left: dict) -> DataFrame:
    """Per pattern: the first bucket with a document that fits, and the bucket at which the words to
    place end with what is left for it (null: all buckets fit)."""
    table = sums.sparkSession.createDataFrame([(list(p), a, n) for p, (a, n) in left.items()],
                                              "sources array<string>, start int, words long")
    rows = _with(sums, table, len(left)).where("bucket >= start and least <= words")
    first = rows.groupBy("sources", "words").agg(F.min("bucket").alias("first"))
    rows = _with(sums, first, len(left)).where("bucket >= first").withColumn("part", F.expr(f"bucket div {PART}"))
    upto = Window.unboundedPreceding
    parts = rows.groupBy("sources", "part").agg(F.sum("size").alias("whole")).select(
        F.col("sources").alias("of"), F.col("part").alias("of_part"), F.coalesce(F.sum("whole").over(
            Window.partitionBy("sources").orderBy("part").rowsBetween(upto, -1)), F.lit(0)).alias("before"))
    rows = rows.join(parts, F.col("sources").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))).withColumn(
        "upto", F.col("before") + F.sum("size").over(Window.partitionBy("sources", "part").orderBy("bucket").rowsBetween(upto, 0)))
    return rows.groupBy("sources").agg(F.min("first").alias("first"), F.min(F.when(F.col("upto") > F.col("words"), F.struct(
        "bucket", (F.col("words") - F.col("upto") + F.col("size")).alias("rest")))).alias("edge"))


def _unplaced(sized: DataFrame, edge: dict, buckets: dict, seed: int) -> dict:
    """Words of every pattern that its bucket at the boundary cannot place."""
    table = sized.sparkSession.createDataFrame([(list(p), buckets[p], a, n) for p, (a, n) in edge.items()],
                                               "sources array<string>, buckets int, at int, rest long")
    rows = _with(sized.select("key", "sources", "size"), table, len(edge)).where(_bucket(seed) == F.col("at")) \
        .withColumn("order", _seeded(seed))

    def rest(table: pa.Table) -> pa.Table:
        return table.select(["sources"]).slice(0, 1).append_column("rest", pa.array([_fill(table)[1]], pa.int64()))

    found = rows.groupBy("sources").applyInArrow(rest, "sources array<string>, rest long").collect()  # one row per pattern
    return {tuple(r["sources"]): r["rest"] for r in found}


def _fill(table: pa.Table) -> tuple[set[int], int]:
    """The rows of a bucket that are placed, in seeded order, and the words that are not.

    As long as it fills more of them, a placed row is exchanged for one that
    is not: the pair that gains most, the first of equal ones."""
    order, key, size = (table.column(c).to_pylist() for c in ("order", "key", "size"))
    placed, left = set(), table.column("rest")[0].as_py()
    turn = sorted(range(len(order)), key=lambda i: (order[i], key[i] is not None, key[i] or 0))
    for i in turn:
        if 0 < size[i] <= left:
            placed.add(i)
            left -= size[i]
    while left:
        inside = sorted((i for i in turn if i in placed), key=size.__getitem__)
        gain, goes, comes = 0, None, None
        for j in turn:
            if j not in placed and size[j] > 0:
                at = bisect.bisect_left(inside, size[j] - left, key=size.__getitem__)
                if at < len(inside) and size[j] - size[inside[at]] > gain:
                    gain, goes, comes = size[j] - size[inside[at]], inside[at], j
        if not gain:
            break
        placed = placed - {goes} | {comes}
        left -= gain
    return placed, left


def _seeded(seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 1), "key", "size")


def _bucket(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "key", "size"), F.col("buckets")).cast("int")


def _with(sized: DataFrame, table: DataFrame, rows: int) -> DataFrame:
    table = table.withColumnRenamed("sources", "of")
    return sized.join(F.broadcast(table) if rows <= BROADCAST_ROWS else table,
                      F.col("sources").eqNullSafe(F.col("of"))).drop("of")


def mixed(sized: DataFrame, decided: DataFrame, seed: int = 11) -> DataFrame:
    """All rows of ``sized`` (key, sources, size, any others) with copies,
    source_size and target."""
    rows = _with(sized, decided, decided.count()).withColumn("bucket", _bucket(seed))
    keep = sized.columns + ["source_size", "target"]
    whole = F.exists("steps", lambda x: (F.col("bucket") >= x["first"]) & (F.col("bucket") < x["bucket"]))
    rows = rows.withColumn("rest", F.get(F.filter("steps", lambda x: x["bucket"] == F.col("bucket")), 0)["rest"])
    plain = rows.where("rest is null").select(*keep, F.when(
        whole, F.least(F.col("passes") + 1, F.lit(COPIES))).otherwise(F.col("passes")).alias("copies"))
    edge = rows.where("rest is not null").withColumn("order", _seeded(seed))

    def fill(table: pa.Table) -> pa.Table:
        placed, copies = _fill(table)[0], table.column("passes").to_pylist()
        made = [min(c + (i in placed), COPIES) for i, c in enumerate(copies)]
        return table.select(keep).append_column("copies", pa.array(made, pa.int64()))

    schema = T.StructType(edge.select(*keep).schema.fields + [T.StructField("copies", T.LongType())])
    return plain.unionByName(edge.groupBy("sources", "bucket").applyInArrow(fill, schema))


def sized(docs: DataFrame, *columns: Column) -> DataFrame:
    """The documents as ``plan`` and ``mixed`` take them, with one source each."""
    return docs.select(F.col("doc_id").cast("long").alias("key"), F.array(F.col("source").cast("string")).alias("sources"),
                       words(F.col("text").cast("string")).alias("size"), *columns)
