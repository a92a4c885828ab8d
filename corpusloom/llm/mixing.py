"""Records of several sources combined so that each source has its share of the total size.

Texts may stand in several sources. They are grouped by membership pattern (the set of sources that hold the text), and
tokens are routed from patterns to the quotas of their sources by min-cost flow: using a pattern's tokens once is free,
each further time costs more (a convex cost), and no source may take a pattern's tokens more often than it may repeat
them. The total is the largest for which all quotas can be filled. Each pattern's texts, in a seeded order, are then a
tape from which every source takes its stretch, so that copies are spread as evenly as the flow asks for.

The flow has a node per pattern and per source; patterns number at most 2 to the power of the sources. The tape's
running sums are made from sums per piece of the order, so that a pattern of a third of all texts is summed in many
tasks.

Defined results: texts without tokens and documents without a source or of one without a target are left out; a text
repeated within a source counts once there (its smallest doc_id stands for it); NULL shares and repeats count as 0;
shares are scaled to sum to 1. A source with a target but without texts gets nothing, and the other shares are scaled.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.tokens import VOCABULARY, with_tokens
from corpusloom.session import cut

SEED = 17
#: A pattern's order is cut into 2 to the power of this pieces.
PIECE_BITS = 12
#: Sets of sources that share texts; more are refused, as the flow is solved by one task.
MOST_PATTERNS = 100_000


class Flow:
    """Min-cost flow by successive shortest paths with potentials; capacities and costs are whole numbers."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def edge(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def used(self, edge: int) -> int:
        return self.room[edge ^ 1]

    def run(self, source: int, sink: int, most: int) -> int:
        n, sent = len(self.out), 0
        height = [0] * n
        while sent < most:
            dist, via = [None] * n, [-1] * n
            dist[source] = 0
            heap = [(0, source)]
            while heap:
                d, u = heapq.heappop(heap)
                if d > dist[u]:
                    continue
                for e in self.out[u]:
                    if self.room[e] > 0:
                        v = self.to[e]
                        nd = d + self.cost[e] + height[u] - height[v]
                        if dist[v] is None or nd < dist[v]:
                            dist[v], via[v] = nd, e
                            heapq.heappush(heap, (nd, v))
            if dist[sink] is None:
                break
            far = max(d for d in dist if d is not None)
            for v in range(n):
                height[v] += dist[v] if dist[v] is not None else far
            step, v = most - sent, sink
            while v != source:
                step = min(step, self.room[via[v]])
                v = self.to[via[v] ^ 1]
            v = sink
            while v != source:
                self.room[via[v]] -= step
                self.room[via[v] ^ 1] += step
                v = self.to[via[v] ^ 1]
            sent += step
        return sent


def route(patterns: dict[str, int], shares: dict[str, float], repeats: dict[str, int], total: int) -> tuple[int, dict[tuple[str, str], int]]:
    """(tokens sent, tokens by (pattern, source)); a pattern is its sources joined by "|"."""
    names, kinds = sorted(shares), sorted(patterns)
    at = {s: k for k, s in enumerate(names)}
    base = len(names)
    most = max([1, *repeats.values()])
    flow = Flow(base + len(kinds) + 2)
    start, end = base + len(kinds), base + len(kinds) + 1
    for s in names:
        flow.edge(at[s], end, int(shares[s] * total))
    links = {}
    for k, p in enumerate(kinds):
        own = [s for s in p.split("|") if s in at]
        for again in range(min(most * len(own), sum(repeats[s] for s in own))):  # the convex cost: 0, 1, 3, 6, ...
            flow.edge(start, base + k, patterns[p], again * (again + 1) // 2)
        for s in own:
            links[p, s] = flow.edge(base + k, at[s], patterns[p] * repeats[s])
    sent = flow.run(start, end, sum(int(shares[s] * total) for s in names))
    return sent, {key: flow.used(e) for key, e in links.items() if flow.used(e) > 0}


def largest_total(patterns: dict[str, int], shares: dict[str, float], repeats: dict[str, int]) -> int:
    """The largest total whose quotas can all be filled."""
    low, high = 0, sum(n * sum(repeats.get(s, 0) for s in p.split("|")) for p, n in patterns.items()) + 1
    while high - low > max(1, low // 100_000):
        mid = (low + high) // 2
        want = sum(int(s * mid) for s in shares.values())
        low, high = (mid, high) if route(patterns, shares, repeats, mid)[0] >= want else (low, mid)
    return low


def _texts(documents: DataFrame, targets: DataFrame, path: str) -> DataFrame:
    """text_key, pattern, tokens, ids (source → smallest doc_id) of each text."""
    wanted = targets.select("source").distinct()
    sized = with_tokens(documents.select("doc_id", "source", "text", F.md5(F.encode("text", "UTF-8")).alias("text_key")), "text", ["doc_id", "source", "text_key"], path)
    sized = sized.where("tokens > 0").join(F.broadcast(wanted), "source", "left_semi")
    one = sized.groupBy("text_key", "source").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens"))
    grouped = one.groupBy("text_key").agg(F.max("tokens").alias("tokens"), F.array_sort(F.collect_list(F.struct("source", "doc_id"))).alias("members"))
    return grouped.select("text_key", F.array_join("members.source", "|").alias("pattern"), "tokens", "members")


def tape(texts: DataFrame) -> DataFrame:
    """Texts with ``start``, the running sum of tokens before them in their pattern's seeded order."""
    at = F.xxhash64("text_key", F.lit(SEED))
    placed = texts.withColumn("at", at).withColumn("piece", F.shiftrightunsigned("at", 64 - PIECE_BITS).cast("int"))
    sums = placed.groupBy("pattern", "piece").agg(F.sum("tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("pattern").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("pattern", "piece", before.alias("offset"))
    inside = Window.partitionBy("pattern", "piece").orderBy("at", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return placed.join(sums, ["pattern", "piece"]).withColumn("start", F.col("offset") + F.col("inside")).drop("piece", "offset", "inside", "at")


def mix(documents: DataFrame, targets: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, source, tokens, copies of every chosen document."""
    spark = documents.sparkSession
    texts = cut(_texts(documents, targets, path))
    found = texts.groupBy("pattern").agg(F.sum("tokens").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} different sets of sources share texts")
    patterns = {r["pattern"]: r["n"] for r in found}
    rows = targets.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("times")).collect()
    have = {s for p in patterns for s in p.split("|")}
    shares = {r["source"]: r["share"] or 0.0 for r in rows if r["source"] in have and (r["share"] or 0) > 0 and (r["times"] or 0) > 0}
    repeats = {r["source"]: int(r["times"] or 0) for r in rows if r["source"] in shares}
    whole = sum(shares.values())
    shares = {s: x / whole for s, x in shares.items()}
    patterns = {p: n for p, n in patterns.items() if any(s in shares for s in p.split("|"))}
    total = largest_total(patterns, shares, repeats) if shares else 0
    taken = route(patterns, shares, repeats, total)[1] if total else {}
    plan, used = [], {}
    for (p, s), n in sorted(taken.items()):
        plan.append((p, s, used.get(p, 0), n, patterns[p]))
        used[p] = used.get(p, 0) + n
    stretches = spark.createDataFrame(plan, "pattern string, source string, begin long, length long, whole long")
    each = tape(texts).join(F.broadcast(stretches), "pattern")  # a row per pattern and source

    def turns(point):  # how often a point of the endless tape has come round before ``point``
        return F.floor((point - F.col("start") - 1) / F.col("whole"))

    copies = (turns(F.col("begin") + F.col("length")) - turns(F.col("begin"))).cast("int")
    doc = F.filter("members", lambda m: m["source"] == F.col("source"))[0]["doc_id"]
    return each.select(doc.alias("doc_id"), "source", "tokens", copies.alias("copies")).where("copies > 0")


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: documents, tokens with repeats, most copies, actual and target share."""
    got = mixed.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies")
    )
    want = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    out = want.join(got, "source", "left").na.fill(0, ["documents", "tokens", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy())  # a row per source
    return out.withColumn("actual_share", F.round(F.col("tokens") / total, 6))
