"""One answer per item from people who disagree, with their agreement and each person's reliability.

The answers are edges between items and annotators. For each class against the rest, two kinds of messages run along
every edge until they settle:

* item to annotator: the odds that the item is of the class, from all its other edges;
* annotator to item: how much this answer of this annotator speaks for the class, from all the annotator's other edges
  (how often the annotator gives this answer on items of the class, and on the rest).

A message never counts the edge it is sent along, so nobody confirms themselves. Constant or contrary annotators get
messages of no or negative weight.

State of one round: an edge table hashed by item, and one row per annotator. The annotators' row sums are combined
before the shuffle, so a busy annotator costs one row per task. Rows of the edge table are cut from their lineage every
few rounds through the shared checkpoint folder.

Defined results: an annotator's answer to an item is the one of the latest ``labelled_at`` (then ``received_at``, then
``label_id``; NULL times count as oldest); if that one is empty or unsure, the annotator has no answer to the item.
Repeated rows count once. Names and answers are compared in one spelling. Items without an answer get the most frequent
class; ties go to the class named first in ``CLASSES``. Answers to items that are not in ``items`` count for nothing.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.vote import CLASSES, annotator_name, answer_class, counting_answers  # noqa: F401
from corpusloom.session import cut

#: Annotators whose rows are broadcast; beyond, the join is left to Spark.
BROADCAST_ANNOTATORS = 100_000
#: Pseudo-counts, as shares of an annotator's answers, that keep few answers from meaning certainty.
PRIOR_WEIGHT = 4.0
#: Share of right answers that an annotator is taken to have before anything is known.
PRIOR_RIGHT = 0.6


def answers(labels: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, annotator, label: each annotator's counting answer to each item."""
    return counting_answers(labels).join(items.select("item_id").distinct(), "item_id", "left_semi")


def _each(name: str, f) -> dict[str, Column]:
    """A column for every class; plain columns, so that none is computed more than once."""
    return {f"{name}{c}": f(c) for c in range(len(CLASSES))}


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def messages(edges: DataFrame, people: DataFrame) -> DataFrame:
    """Edges with ``m0``..: for each class the log odds that this answer adds, from the annotator's other edges. The
    shares of the classes come as data beside the annotators, so that every round runs the same compiled code."""
    k = len(CLASSES)

    def expected(c: int) -> Column:
        """How often an unknown annotator gives the answer ``l`` to items of class ``c``."""
        return F.when(F.col("l") == c, PRIOR_RIGHT).otherwise((1 - PRIOR_RIGHT) / (k - 1))

    def odds(c: int) -> Column:
        own, same, total = F.col(f"q{c}"), F.col("same")[F.col("l") * k + c], F.col("total")[c]
        given, n = F.col("given")[F.col("l")], F.col("n")
        rest = reduce(lambda a, b: a + b, [expected(r) * F.col("prior")[r] for r in range(k) if r != c]) / (1 - F.col("prior")[c])
        yes = (same - own + PRIOR_WEIGHT * expected(c)) / (total - own + PRIOR_WEIGHT)
        no = (given - same - (1 - own) + PRIOR_WEIGHT * rest) / (n - total - (1 - own) + PRIOR_WEIGHT)
        return F.log(F.greatest(yes, F.lit(1e-6)) / F.greatest(no, F.lit(1e-6)))

    return edges.join(people, "annotator").withColumns(_each("m", odds)).drop("same", "total", "given", "n")


def _people(edges: DataFrame) -> DataFrame:
    """Per annotator: same[l * 4 + c], the weight of class c among the items answered l; total[c]; given[l]; n. Beside
    them the annotator's part of the items' posteriors and of the movement since the last round."""
    k = len(CLASSES)
    same = [F.sum(F.when(F.col("l") == r, F.col(f"q{c}")).otherwise(0.0)) for r in range(k) for c in range(k)]
    return edges.groupBy("annotator").agg(
        F.array(*same).alias("same"),
        F.array(*[F.sum(f"q{c}") for c in range(k)]).alias("total"),
        F.array(*[F.sum((F.col("l") == r).cast("double")) for r in range(k)]).alias("given"),
        F.count("*").cast("double").alias("n"),
        F.array(*[F.sum(F.col(f"p{c}") / F.col("n_item")) for c in range(k)]).alias("posterior"),
        F.sum("moved").alias("moved"),
        F.max("moved").alias("most"),
    )


def _prior_odds(c: int) -> Column:
    return F.log(F.col("prior")[c] / (1 - F.col("prior")[c]))


def _logit(p: float) -> float:
    return log(p / (1 - p))


def run(edges: DataFrame, rounds: int = 20, tolerance: float = 1e-2, keep: int = 5) -> tuple[DataFrame, DataFrame, list[float], dict]:
    """Messages to convergence (no message's probability changes by ``tolerance`` or more) over item_id, annotator,
    label. Gives the edges with their last messages, one row per annotator, the share of each class, and how it ended:
    rounds, mean_change, largest_change, converged. A round is one job: the annotators' sums make the new messages."""
    spark, k = edges.sparkSession, len(CLASSES)
    number = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("label")).cast("int") - 1
    edges = edges.select("item_id", "annotator", number.alias("l")).repartition("item_id")
    # sums over an item are windows: the plan uses the state once a round and so grows in proportion to the rounds
    item = Window.partitionBy("item_id")
    counts = {"n_item": F.count("*").over(item).cast("double")} | _each("v", lambda c: F.sum((F.col("l") == c).cast("double")).over(item))
    # the first message of an item is the smoothed share of the other answers
    first = _each("q", lambda c: (F.col(f"v{c}") - (F.col("l") == c).cast("double") + 1 / k) / F.col("n_item"))
    share = _each("p", lambda c: F.col(f"v{c}") / F.col("n_item"))
    now = edges.withColumns(counts).withColumns(first | share | {"moved": F.lit(1.0)}).drop(*[f"v{c}" for c in range(k)])
    now, before = now.persist(StorageLevel.MEMORY_AND_DISK), None
    few = now.select("annotator").distinct().count() <= BROADCAST_ANNOTATORS
    how = {"rounds": 0, "mean_change": 0.0, "largest_change": 0.0, "converged": True}
    while True:
        told = _people(now)
        if few:  # a row per annotator, of checked number
            rows = told.collect()
            sums = [sum(r["n"] for r in rows), sum(r["moved"] for r in rows), max((r["most"] for r in rows), default=0.0)]
            mass = [sum(r["posterior"][c] for r in rows) for c in range(k)]
        else:
            told = cut(told)
            one = told.agg(F.sum("n"), F.sum("moved"), F.max("most"), *[F.sum(F.col("posterior")[c]) for c in range(k)]).first()
            sums, mass = one[:3], one[3:]
        if before is not None:
            before.unpersist()
        prior = [min(max(x / sum(mass), 1e-4), 1 - 1e-4) for x in mass] if sums[0] else [1 / k] * k
        if few:
            names = ["annotator", "same", "total", "given", "n", "prior"]
            kind = "annotator string, same array<double>, total array<double>, given array<double>, n double, prior array<double>"
            people = spark.createDataFrame([(*(r[c] for c in names[:-1]), prior) for r in rows], kind)
        else:
            people = told.drop("posterior", "moved", "most").withColumn("prior", F.array(*map(F.lit, prior)))
        sent = messages(now, F.broadcast(people) if few else people)
        if sums[0]:
            how |= {"mean_change": sums[1] / sums[0], "largest_change": sums[2], "converged": sums[2] < tolerance}
        if not sums[0] or how["converged"] or how["rounds"] >= rounds:
            return sent, people, prior, how
        how["rounds"] += 1
        after = sent.withColumnsRenamed({f"q{c}": f"b{c}" for c in range(k)}).drop(*[f"p{c}" for c in range(k)])
        after = after.withColumns(_each("t", lambda c: F.sum(f"m{c}").over(item)))
        after = after.withColumns(
            _each("q", lambda c: _sigmoid(F.col(f"t{c}") - F.col(f"m{c}") + _prior_odds(c)))
            | _each("p", lambda c: _sigmoid(F.col(f"t{c}") + _prior_odds(c)))
        )
        moved = reduce(lambda a, b: a + b, [F.abs(F.col(f"q{c}") - F.col(f"b{c}")) for c in range(k)]) / k
        state = [f"{x}{c}" for x in "qp" for c in range(k)]
        after = after.select("item_id", "annotator", "l", "n_item", *state, moved.alias("moved"))
        if how["rounds"] % keep == 0:
            after = cut(after).repartition("item_id")
        before, now = now, after.persist(StorageLevel.MEMORY_AND_DISK)


def convergence(items: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: rounds, mean_change and largest_change of a message's probability in the last round, converged."""
    how = run(answers(labels, items))[3]
    kind = "rounds int, mean_change double, largest_change double, converged boolean"
    return items.sparkSession.createDataFrame([(how["rounds"], round(how["mean_change"], 6), round(how["largest_change"], 6), how["converged"])], kind)


def consensus(items: DataFrame, labels: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """(items, annotators): item_id, label, confidence, n_answers, agreement (share of the answers that equal the
    label; NULL without answers), and annotator, n_answers, reliability (expected share of right answers), informed
    (reliability beyond what answering by the annotator's own habits alone would give)."""
    k = len(CLASSES)
    sent, people, prior, _ = run(answers(labels, items), **how)
    by_item = sent.groupBy("item_id").agg(
        *[F.sum(f"m{c}").alias(f"t{c}") for c in range(k)],
        *[F.sum((F.col("l") == c).cast("int")).alias(f"v{c}") for c in range(k)],
        F.count("*").alias("n_answers"),
    )
    all_items = items.select("item_id").where(F.col("item_id").isNotNull()).distinct().join(by_item, "item_id", "left")
    score = [_sigmoid(F.coalesce(F.col(f"t{c}"), F.lit(0.0)) + _logit(prior[c])) for c in range(k)]
    scored = all_items.withColumn("score", F.array(*score))
    best = (F.array_position("score", F.array_max("score")) - 1).cast("int")
    total = F.aggregate("score", F.lit(0.0), lambda a, b: a + b)
    votes = F.coalesce(F.array(*[F.coalesce(F.col(f"v{c}"), F.lit(0)) for c in range(k)])[best], F.lit(0))
    out = scored.select(
        "item_id",
        F.array(*map(F.lit, CLASSES))[best].alias("label"),
        F.round(F.array_max("score") / total, 6).alias("confidence"),
        F.coalesce(F.col("n_answers"), F.lit(0)).alias("n_answers"),
        F.round(votes / F.col("n_answers"), 6).alias("agreement"),
    )
    right = reduce(lambda a, b: a + b, [F.col("same")[c * k + c] for c in range(k)]) / F.col("n")
    habit = reduce(lambda a, b: a + b, [F.col("given")[c] * F.col("total")[c] for c in range(k)]) / (F.col("n") * F.col("n"))
    who = people.select(
        "annotator",
        F.col("n").cast("long").alias("n_answers"),
        F.round(right, 6).alias("reliability"),
        F.round((right - habit) / (1 - habit), 6).alias("informed"),
    )
    return out, who


def alpha(edges: DataFrame) -> DataFrame:
    """Krippendorff's alpha of the counting answers, nominal: items, answers, observed and expected disagreement, alpha
    (NULL if no item has two answers or all answers are equal)."""
    per = edges.groupBy("item_id").agg(
        F.count("*").alias("n"), *[F.sum((F.col("label") == c).cast("double")).alias(f"v_{c}") for c in CLASSES]
    ).where("n > 1")
    same = reduce(lambda a, b: a + b, [F.col(f"v_{c}") * (F.col(f"v_{c}") - 1) for c in CLASSES])
    sums = per.agg(
        F.count("*").alias("items"),
        F.sum("n").alias("answers"),
        F.sum(F.col("n") - same / (F.col("n") - 1)).alias("apart"),
        *[F.sum(f"v_{c}").alias(f"v_{c}") for c in CLASSES],
    )
    squares = reduce(lambda a, b: a + b, [F.col(f"v_{c}") * (F.col(f"v_{c}") - 1) for c in CLASSES])
    observed = F.col("apart") / F.col("answers")
    expected = 1 - squares / (F.col("answers") * (F.col("answers") - 1))
    return sums.select(
        "items",
        F.coalesce("answers", F.lit(0)).alias("answers"),
        F.round(observed, 6).alias("observed"),
        F.round(expected, 6).alias("expected"),
        F.round(F.when(expected > 0, 1 - observed / expected), 6).alias("alpha"),
    )
