"""Boxes, lines and columns of a page as relations: range joins bucketed by page, least squares, phases, reading order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x0, y0, x1, y1); 0 where both are empty."""
    width = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    height = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    inter = width * height
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def best_overlaps(old: DataFrame, new: DataFrame, page: str, ident: str, least: float) -> DataFrame:
    """page, old id, new id, iou: each old box with the new one it overlaps most (of equals the first), if by more than
    ``least``. A new box is taken by the first of the old ones that want it; the others, and boxes that overlap none enough,
    are orphans: their new id is NULL. Boxes are joined over the coarse cells they touch, not all with all."""
    cell = 500

    def cells(df: DataFrame, prefix: str) -> DataFrame:
        xs = F.sequence(F.floor(F.col("x0") / cell), F.floor(F.col("x1") / cell))
        ys = F.sequence(F.floor(F.col("y0") / cell), F.floor(F.col("y1") / cell))
        df = df.select(page, F.col(ident).alias(f"{prefix}_id"), *[F.col(c).alias(f"{prefix}_{c}") for c in ("x0", "y0", "x1", "y1")], xs.alias("_xs"), ys.alias("_ys"))
        return df.withColumn("_x", F.explode("_xs")).withColumn("_y", F.explode("_ys")).drop("_xs", "_ys")

    pairs = cells(old, "o").join(cells(new, "n"), [page, "_x", "_y"]).drop("_x", "_y").distinct()
    box = lambda p: [F.col(f"{p}_{c}").cast("double") for c in ("x0", "y0", "x1", "y1")]
    scored = pairs.withColumn("iou", F.round(iou(box("o"), box("n")), 6)).where(F.col("iou") > least)
    wanted = scored.groupBy(page, "o_id").agg(F.min_by(F.struct("n_id", "iou"), F.struct(-F.col("iou"), F.col("n_id"))).alias("_w")).select(page, "o_id", "_w.*")
    first = wanted.groupBy(page, "n_id").agg(F.min_by(F.struct("o_id", "iou"), "o_id").alias("_t")).select(page, "n_id", "_t.*")
    every = old.select(page, F.col(ident).alias("o_id")).distinct()
    return every.join(first, [page, "o_id"], "left").select(page, "o_id", "n_id", "iou")


def points_in_boxes(points: DataFrame, boxes: DataFrame, keys: list[str], x: str, y: str, slack: float = 1.0, cell: float = 200.0) -> DataFrame:
    """Points with the boxes of the same keys that hold them (within the slack), joined by rows of cells."""
    rows = F.sequence(F.floor((F.col("y0") - slack) / cell), F.floor((F.col("y1") + slack) / cell))
    tall = boxes.withColumn("_cell", F.explode(rows))
    near = points.withColumn("_cell", F.floor(F.col(y) / cell)).join(tall, [*keys, "_cell"]).drop("_cell")
    inside = F.col(x).between(F.col("x0") - slack, F.col("x1") + slack) & F.col(y).between(F.col("y0") - slack, F.col("y1") + slack)
    return near.where(inside)


def span_overlaps(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, a's s and e, b's s2 and e2 and their common length, for all spans of a key that overlap."""
    other = b.select(key, F.col("s").alias("s2"), F.col("e").alias("e2"))
    both = a.select(key, "s", "e").join(other, key).where("s < e2 and e > s2")
    return both.withColumn("common", F.least("e", "e2") - F.greatest("s", "s2"))


def weighted_line(x: Column, y: Column, w: Column) -> tuple[Column, Column]:
    """(intercept, slope) aggregates of the weighted least-squares line; a slope of 0 where x does not vary."""
    sw, sx, sy = F.sum(w), F.sum(w * x), F.sum(w * y)
    sxx, sxy = F.sum(w * x * x), F.sum(w * x * y)
    base = sw * sxx - sx * sx
    slope = F.when(base != 0, (sw * sxy - sx * sy) / base).otherwise(F.lit(0.0))
    return (sy - slope * sx) / sw, slope


def circular(angle: Column) -> tuple[Column, Column]:
    """(mean angle, concentration) aggregates of angles in radians."""
    c, s = F.avg(F.cos(angle)), F.avg(F.sin(angle))
    return F.atan2(s, c), F.hypot(c, s)


def upper_median(values: str) -> Column:
    """The aggregate that is the middle value of a SQL expression, of an even number the upper one. A task keeps how often each
    value stands, not the values."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {values} DESC)")


def mode_low(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value of each group, the smallest of equally frequent ones."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col(value))).alias(name), F.max("_n").alias("times"))


def mean_confidence(c: Column) -> Column:
    """The rounded mean (halves to even) of confidences without the unknown (negative); -1 if none is known."""
    return F.coalesce(F.bround(F.avg(F.when(c >= 0, c))), F.lit(-1)).cast("int")


def gutter(words: DataFrame, keys: list[str], width: str, steps: int = 400) -> DataFrame:
    """keys, gutter, covered: the place between 0.35 and 0.65 of the width, in steps of a 400th of it (a pixel at least), that
    the fewest words cover; of equals the nearest to the middle, then the leftmost. Places are only counted where a word
    begins or ends to cover them: a word is a range of places, counted by its two ends."""
    pages = words.select(*keys, F.col(width).cast("double").alias("_w")).distinct()
    step = F.greatest(F.lit(1), F.floor(F.col("_w") / steps))
    lo, hi = F.floor(0.35 * F.col("_w")), F.floor(0.65 * F.col("_w"))
    pages = pages.withColumn("_s", step).withColumn("_lo", lo).withColumn("_m", F.ceil((hi - lo) / step) - 1)
    first = F.greatest(F.floor((F.col("x0") - F.col("_lo")) / F.col("_s")) + 1, F.lit(0))
    last = F.least(F.ceil((F.col("x1") - F.col("_lo")) / F.col("_s")) - 1, F.col("_m"))
    spans = words.select(*keys, "x0", "x1").join(pages, keys).select(*keys, first.alias("_a"), last.alias("_b")).where("_a <= _b")
    ends = spans.select(*keys, F.col("_a").alias("_k"), F.lit(1).alias("_d")).unionByName(spans.select(*keys, (F.col("_b") + 1).alias("_k"), F.lit(-1).alias("_d")))
    places = pages.where("_m >= 0").select(*keys, "_w", "_s", "_lo", F.explode(F.sequence(F.lit(0), F.col("_m"))).alias("_k"))
    changes = places.join(ends.groupBy(*keys, "_k").agg(F.sum("_d").alias("_d")), [*keys, "_k"], "left")
    covered = F.sum(F.coalesce("_d", F.lit(0))).over(Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0))
    at = F.col("_lo") + F.col("_k") * F.col("_s")
    best = changes.withColumn("_n", covered).groupBy(*keys).agg(F.min(F.struct("_n", F.abs(at - F.col("_w") / 2).alias("_off"), at.alias("_x"))).alias("_b"))
    return best.select(*keys, F.col("_b._x").alias("gutter"), F.col("_b._n").alias("covered"))


def body_gutter(lines: DataFrame, keys: list[str], width: str) -> DataFrame:
    """keys, gutter: without a column rule, the place between 0.3 and 0.7 of the width, every ten pixels, that the fewest body
    lines (over 300 wide) cross, of equals the one nearest the middle; none for pages of fewer than ten such lines or where
    over a tenth of them cross it (a single column)."""
    body = lines.where(F.col("x1") - F.col("x0") > 300).select(*keys, "x0", "x1", F.col(width).cast("double").alias("_w"))
    pages = body.groupBy(*keys).agg(F.max("_w").alias("_w"), F.count("*").alias("_all")).where("_all >= 10")
    places = pages.withColumn("_x", F.explode(F.sequence(F.floor(0.3 * F.col("_w")), F.ceil(0.7 * F.col("_w")) - 1, F.lit(10))))
    crossed = places.join(body.drop("_w"), keys, "left").where("x0 < _x and x1 > _x").groupBy(*keys, "_x").agg(F.count("*").alias("_n"))
    both = places.join(crossed, [*keys, "_x"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    best = both.groupBy(*keys).agg(F.min(F.struct("_n", F.abs(F.col("_x") - F.col("_w") / 2).alias("_off"), "_x")).alias("_b"), F.max("_all").alias("_all"))
    return best.where(F.col("_b._n") <= 0.1 * F.col("_all")).select(*keys, F.col("_b._x").cast("double").alias("gutter"))


def column_rule(seps: DataFrame, keys: list[str], width: str) -> DataFrame:
    """keys, g0, g1: the column rule x = g0 + g1 * y through the ends of the longest upright separator near the middle and of
    those in line with it, weighted by their lengths, the slope within a hundredth. Separators are x0, y0, x1, y1."""
    mid, tall = (F.col("x0") + F.col("x1")) / 2, F.abs(F.col("y1") - F.col("y0"))
    upright = seps.withColumn("_mid", mid).withColumn("_l", tall).where((F.abs(F.col("x0") - F.col("x1")) < 60) & (F.col("_l") > 400))
    upright = upright.where((F.col("_mid") > 0.3 * F.col(width)) & (F.col("_mid") < 0.7 * F.col(width)))
    longest = upright.groupBy(*keys).agg(F.max_by("_mid", F.struct("_l", -F.col("_mid"))).alias("_at"))
    some = upright.join(longest, keys).where(F.abs(F.col("_mid") - F.col("_at")) < 60)
    ends = some.select(*keys, "_l", F.explode(F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")))).alias("_p"))
    x, y, w = F.col("_p.x").cast("double"), F.col("_p.y").cast("double"), F.col("_l").cast("double")
    sums = ends.groupBy(*keys).agg(F.sum(w).alias("_w"), F.sum(w * x).alias("_x"), F.sum(w * y).alias("_y"), F.sum(w * y * y).alias("_yy"), F.sum(w * x * y).alias("_xy"))
    base = F.col("_yy") - F.col("_y") * F.col("_y") / F.col("_w")
    slope = F.when(base > 1e-9, (F.col("_xy") - F.col("_x") * F.col("_y") / F.col("_w")) / base).otherwise(0.0)
    slope = F.greatest(F.lit(-0.01), F.least(F.lit(0.01), slope))
    return sums.withColumn("_g", slope).select(*keys, F.round((F.col("_x") - F.col("_g") * F.col("_y")) / F.col("_w"), 1).alias("g0"), F.round("_g", 5).alias("g1"))


def skew_grid(lines: DataFrame, keys: list[str], indent: float, slopes: list[float]) -> DataFrame:
    """keys, slope, strength: the skew at which left edges (x0 at y0) fall best on multiples of the indent, by the length
    of their mean phase; the least slope of equally good ones."""
    from math import pi

    each = lines.withColumn("slope", F.explode(F.array(*map(F.lit, slopes))))
    mean, strength = circular(2 * pi * (F.col("x0") - F.col("slope") * F.col("y0")) / indent)
    got = each.groupBy(*keys, "slope").agg(F.round(strength, 6).alias("strength"))
    del mean
    best = F.max(F.struct("strength", (-F.abs(F.col("slope"))).alias("_a"), (-F.col("slope")).alias("_b"))).alias("_x")
    return got.groupBy(*keys).agg(best).select(*keys, (-F.col("_x._b")).alias("slope"), "_x.strength")


def flush_level(lines: DataFrame, keys: list[str], level: str, start: str) -> DataFrame:
    """keys, flush, f1, precision: the indent level up to which lines start entries, that agrees best with the evidence
    ``start`` (of equals the lowest). Levels -1 (none) and 0 are tried, and 1 where the lowest level has no more than two lines
    or a twentieth of them. It is accepted with a precision of a half and three starts, or if all hit; where it says that no
    line starts an entry, only if the evidence has none. Groups without an accepted level have no row."""
    group = Window.partitionBy(*keys)
    lines = lines.withColumn("_low", F.min(level).over(group)).withColumn("_of", F.count("*").over(group))
    lowest = F.sum((F.col(level) == F.col("_low")).cast("int")).over(group)
    choices = F.when(lowest <= F.greatest(F.lit(2.0), 0.05 * F.col("_of")), F.array(F.lit(-1), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(-1), F.lit(0)))
    each = lines.withColumn("_choices", choices).withColumn("flush", F.explode("_choices")).withColumn("_said", F.col(level) - F.col("_low") <= F.col("flush"))
    sums = each.groupBy(*keys, "flush").agg(
        F.sum((F.col("_said") & F.col(start)).cast("int")).alias("hit"), F.sum(F.col("_said").cast("int")).alias("said"), F.sum(F.col(start).cast("int")).alias("truth")
    )
    f1 = F.when(F.col("said") + F.col("truth") > 0, 2 * F.col("hit") / (F.col("said") + F.col("truth"))).otherwise(1.0)
    sums = sums.withColumn("f1", F.round(f1, 6)).withColumn("precision", F.round(F.when(F.col("said") > 0, F.col("hit") / F.col("said")), 6))
    best = sums.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("f1"), "flush"))).where("_k = 1")
    return best.where("(precision >= 0.5 and said >= 3) or (said > 0 and hit = said) or (said = 0 and truth = 0)").select(*keys, "flush", "f1", "precision")


def unanimous(verdicts: DataFrame, keys: list[str], witness: str, verdict: str, readers: int = 2) -> DataFrame:
    """Verdicts that all of at least ``readers`` witnesses give; undecided and contradicted lines are left out."""
    got = verdicts.where(F.col(verdict).isNotNull()).groupBy(*keys).agg(F.countDistinct(witness).alias("n"), F.min(verdict).alias("lo"), F.max(verdict).alias("hi"))
    return got.where((F.col("n") >= readers) & (F.col("lo") == F.col("hi"))).select(*keys, F.col("lo").alias(verdict))


def log_odds(parts: list[tuple[Column, float, float]]) -> Column:
    """A naive-Bayes score: of each feature the first weight where it holds, else the second (also where NULL)."""
    return reduce(lambda a, b: a + b, [F.when(F.coalesce(c, F.lit(False)), w1).otherwise(w0) for c, w1, w0 in parts])
