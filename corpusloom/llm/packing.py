"""Texts into containers of fixed capacity, with little unused space.

A grouping genetic algorithm. A solution is a set of containers; its fitness is the mean of their squared fills. A child
takes over whole well-filled containers of one parent, drops the other parent's containers that hold any of the same
texts, and puts the displaced texts where they fit best. Each shard (a seeded share of the texts, of bounded size) is
evolved on several islands; after each round every island receives the best solutions of the others. What remains badly
filled after a level is packed again in shards made of the rests, ``LEVELS`` times in all.

Defined results: a text longer than the capacity is split into full containers and a rest, which is packed like a text;
no other text is split; texts without tokens are left out; a text that is in the table twice is packed twice; a
capacity that is NULL or not positive has no containers; more than ``MOST_CAPACITIES`` different containers are refused.
With no texts there are no containers.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import VOCABULARY, with_tokens
from corpusloom.session import cut

#: A shard has about so many containers, and no more texts than SHARD_ITEMS on average.
SHARD_BINS, SHARD_ITEMS = 1_000, 20_000
ISLANDS, ROUNDS, GENERATIONS, POPULATION = 2, 2, 8, 5
#: Containers filled less than this are taken apart for the next level.
FILLED = 0.985
LEVELS = 3
MOST_CAPACITIES = 1_000
SEED = 11

Bins = list[list[int]]


def best_fit(bins: Bins, items: list[int], sizes: list[int], capacity: int) -> Bins:
    """The items, the largest first, each into the fullest container that still has room."""
    room = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: -sizes[i]):
        at = bisect_left(room, (sizes[i], -1))
        if at == len(room):
            bins.append([i])
            insort(room, (capacity - sizes[i], len(bins) - 1))
        else:
            free, k = room.pop(at)
            bins[k].append(i)
            insort(room, (free - sizes[i], k))
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> float:
    if not bins:
        return 1.0
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / len(bins)


def best_possible(sizes: list[int], capacity: int) -> float:
    """The fitness of as few containers as there can be, all but one full; less a rounding."""
    full, rest = divmod(sum(sizes), capacity)
    return (full + (rest / capacity) ** 2) / max(1, full + (rest > 0)) - 1e-9


def first_solution(sizes: list[int], capacity: int, rng: random.Random, noise: float) -> Bins:
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (1 + noise * rng.random()))
    bins: Bins = []
    room: list[tuple[int, int]] = []
    for i in order:
        at = bisect_left(room, (sizes[i], -1))
        if at == len(room):
            bins.append([i])
            insort(room, (capacity - sizes[i], len(bins) - 1))
        else:
            free, k = room.pop(at)
            bins[k].append(i)
            insort(room, (free - sizes[i], k))
    return bins


def crossover(a: Bins, b: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Whole containers of b, the fullest more likely, injected into a."""
    ranked = sorted(b, key=lambda x: -sum(sizes[i] for i in x))
    taken = [x for k, x in enumerate(ranked) if rng.random() < 0.6 * (1 - k / len(ranked))] or ranked[:1]
    moved = {i for x in taken for i in x}
    child, displaced = [list(x) for x in taken], []
    for x in a:
        if moved.isdisjoint(x):
            child.append(list(x))
        else:
            displaced += [i for i in x if i not in moved]
    return best_fit(child, displaced, sizes, capacity)


def mutated(bins: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """The worst containers and a few others taken apart and filled anew."""
    ranked = sorted(bins, key=lambda x: sum(sizes[i] for i in x))
    few = max(1, len(ranked) // 20)
    apart = ranked[:few] + [x for x in ranked[few:] if rng.random() < 0.03]
    gone = {id(x) for x in apart}
    return best_fit([list(x) for x in bins if id(x) not in gone], [i for x in apart for i in x], sizes, capacity)


def evolve(sizes: list[int], capacity: int, seeds: list[Bins], rng: random.Random, generations: int = GENERATIONS) -> list[Bins]:
    """The population after some generations, the best first; over at once when no solution can be better: none has fewer
    containers, and all but one are full."""
    best = best_possible(sizes, capacity)
    people = [list(map(list, s)) for s in seeds]
    while len(people) < POPULATION:
        people.append(first_solution(sizes, capacity, rng, 0.0 if not people else 0.3 * len(people) / POPULATION))
        if fitness(people[-1], sizes, capacity) >= best:
            break
    scored = sorted(((fitness(p, sizes, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    for turn in range(generations):
        if len(scored) < 2 or scored[0][0] >= best:
            break
        a, b = rng.sample(scored[: max(2, POPULATION // 2 + 1)], 2)
        child = crossover(a[2], b[2], sizes, capacity, rng)
        child = mutated(child, sizes, capacity, rng)
        scored[-1] = (fitness(child, sizes, capacity), POPULATION + turn, child)
        scored.sort(reverse=True)
    return [p for _, _, p in scored]


def _flat(bins: Bins, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _bins(flat) -> Bins:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(flat):
        out.setdefault(int(k), []).append(i)
    return list(out.values())


_SHARD = "bin_name string, capacity int, shard int, items array<struct<item:long,part:int,size:int>>"


def _islands(shards: DataFrame, seeded: bool) -> DataFrame:
    """A round on every island of every shard; gives the two best solutions of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for rec in pdf.to_dict("records"):
                sizes = [x["size"] for x in rec["items"]]
                rng = random.Random(f"{SEED}/{rec['bin_name']}/{rec['shard']}/{rec['island']}/{seeded}")
                seeds = [_bins(s) for s in rec["elites"]] if seeded else []
                best = evolve(sizes, rec["capacity"], seeds, rng)[:2]
                elites = [_flat(b, len(sizes)) for b in best]
                score = fitness(best[0], sizes, rec["capacity"])
                rows.append((rec["bin_name"], rec["capacity"], rec["shard"], rec["items"], elites, score))
            yield pd.DataFrame(rows, columns=["bin_name", "capacity", "shard", "items", "elites", "score"])

    spread = shards.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    spread = spread.repartition("bin_name", "shard", "island")
    return spread.mapInPandas(run, f"{_SHARD}, elites array<array<int>>, score double")


def _solved(items: DataFrame, level: int) -> DataFrame:
    """bin_name, capacity, container, items, fill of one level over bin_name, capacity, item, part, size."""
    per = items.groupBy("bin_name").agg(F.sum("size").alias("total"), F.count("*").alias("n"), F.first("capacity").alias("c"))
    shards = F.ceil(F.greatest(F.col("total") / (F.col("c") * SHARD_BINS), F.col("n") / SHARD_ITEMS, F.lit(1))).cast("int")
    per = per.select("bin_name", shards.alias("shards"))  # a row per container size
    dealt = items.join(F.broadcast(per), "bin_name")
    # copies of one text go to different shards
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("item", "part", "again", F.lit(SEED + level)), "shards").cast("int"))
    grouped = dealt.groupBy("bin_name", "capacity", "shard").agg(F.array_sort(F.collect_list(F.struct("item", "part", "size"))).alias("items"))
    state = _islands(grouped, seeded=False)
    for _ in range(ROUNDS - 1):
        met = state.groupBy("bin_name", "capacity", "shard").agg(
            F.max_by("items", "score").alias("items"), F.flatten(F.collect_list("elites")).alias("elites")
        )
        state = _islands(met, seeded=True)
    best = F.max(F.struct("score", "elites", "items")).alias("x")
    won = state.groupBy("bin_name", "capacity", "shard").agg(best)
    won = won.select("bin_name", "capacity", "shard", F.col("x.items").alias("items"), F.element_at("x.elites", 1).alias("ks"))
    zipped = won.select("bin_name", "capacity", "shard", F.explode(F.arrays_zip("items", "ks")).alias("y"))
    flat = zipped.select("bin_name", "capacity", "shard", F.col("y.items").alias("item"), F.col("y.ks").alias("k"))
    return flat.groupBy("bin_name", "capacity", "shard", "k").agg(F.collect_list("item").alias("items"), F.sum("item.size").alias("fill")).select(
        "bin_name", "capacity", F.concat_ws("-", F.lit(level), "shard", "k").alias("container"), "items", "fill"
    )


def pack(sized: DataFrame, bins: DataFrame) -> DataFrame:
    """bin_name, container, item, part, size, fill, capacity: where each text (or part of one too long) lies.
    ``sized`` has item (long) and tokens; ``bins`` bin_name and capacity_tokens."""
    rooms = bins.where("capacity_tokens > 0").select("bin_name", F.col("capacity_tokens").cast("int").alias("capacity")).distinct().limit(MOST_CAPACITIES + 1).collect()
    if len(rooms) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} different containers")
    known = F.array(*[F.struct(F.lit(r["bin_name"]).cast("string").alias("bin_name"), F.lit(r["capacity"]).alias("capacity")) for r in rooms])
    room = F.explode(known if rooms else F.array().cast("array<struct<bin_name:string,capacity:int>>"))
    sized = sized.where("tokens > 0").groupBy("item", "tokens").agg(F.count("*").cast("int").alias("times"))
    each = sized.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))).withColumn("room", room).select("*", "room.*").drop("room")
    parts = F.sequence(F.lit(0), F.floor((F.col("tokens") - 1) / F.col("capacity")).cast("int"))
    each = each.withColumn("part", F.explode(parts))
    size = F.least(F.col("capacity").cast("long"), F.col("tokens") - F.col("part") * F.col("capacity")).cast("int")
    each = each.select("bin_name", "capacity", "item", "again", "part", size.alias("size"))
    full = each.where("size = capacity").select(
        "bin_name", "capacity", F.concat_ws("-", F.lit("full"), "item", "again", "part").alias("container"), "item", "part", "size", F.col("size").cast("long").alias("fill")
    )
    low = F.col("fill") < F.col("capacity") * FILLED
    packed, rest = None, each.where("size < capacity")
    for level in range(LEVELS):
        got = cut(_solved(rest, level)) if level < LEVELS - 1 else _solved(rest, level)
        good = got.where(~low) if level < LEVELS - 1 else got
        packed = good if packed is None else packed.unionByName(good)
        rest = got.where(low).select("bin_name", "capacity", F.posexplode("items").alias("again", "x")).select("bin_name", "capacity", "again", "x.*")
    packed = packed.select("bin_name", "capacity", "container", F.explode("items").alias("x"), "fill").select("bin_name", "capacity", "container", "x.*", "fill")
    return full.unionByName(packed)


def packed_documents(documents: DataFrame, bins: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The assignment of the texts of ``documents`` (doc_id, text)."""
    return pack(cut(with_tokens(documents.withColumnRenamed("doc_id", "item"), "text", ["item"], path)), bins)


def summary(packed: DataFrame) -> DataFrame:
    """Per container size: containers, texts, split texts, tokens, share of unused space, and the least possible number."""
    per = packed.groupBy("bin_name", "capacity", "container").agg(
        F.sum("size").alias("fill"), F.count("*").alias("pieces"), F.sum((F.col("part") > 0).cast("int")).alias("later")
    )
    return per.groupBy("bin_name", "capacity").agg(
        F.count("*").alias("containers"),
        (F.sum("pieces") - F.sum("later")).alias("texts"),
        F.sum("fill").alias("tokens"),
        F.round(1 - F.sum("fill") / (F.count("*") * F.first("capacity")), 6).alias("unused"),
        F.ceil(F.sum("fill") / F.first("capacity")).alias("least_containers"),
    )
