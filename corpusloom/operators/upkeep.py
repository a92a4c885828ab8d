"""Keeping derived tables up to date: work lists, partial overwrite, upserts, seeded samples, splits, ledgers, writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def work_list(df: DataFrame, version: str, current: int) -> DataFrame:
    """Rows whose version stamp is missing or not the current one."""
    return df.where(~F.col(version).eqNullSafe(F.lit(current)))


def replaced(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The old rows of keys that are not in ``new``, and all new rows."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """New rows with the kept columns of the old row of the same key where that has a value; old rows without a new
    one are gone."""
    before = old.groupBy(*keys).agg(*[F.max(c).alias(f"_old_{c}") for c in kept])
    joined = new.join(before, keys, "left")
    return joined.select(*[F.coalesce(F.col(f"_old_{c}"), F.col(c)).alias(c) if c in kept else F.col(c) for c in new.columns])


def newest_match(answers: DataFrame, readings: DataFrame, ident: str, shown: str, stamp: str) -> DataFrame:
    """Each answer with the newest reading table row of the same id that showed what the answer saw."""
    both = answers.join(readings, [ident]).where(F.col("saw").eqNullSafe(F.col(shown)))
    return both.groupBy(ident, "saw").agg(F.max_by(F.struct(*[c for c in readings.columns if c != ident]), F.col(stamp)).alias("_r")).select(ident, "saw", "_r.*")


def bucket_sample(df: DataFrame, key: Column, buckets: int, keep: int) -> DataFrame:
    """Rows whose key falls into the first ``keep`` of so many CRC-32 buckets: the same rows on every run."""
    return df.where(F.crc32(key.cast("string")) % buckets < keep)


def seeded_sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows without replacement, by the order of a hash of key and seed."""
    return df.orderBy(F.md5(F.concat_ws("/", F.lit(seed), F.col(key))), key).limit(n)


def split_of(key: Column, test: list[int], every: int = 20, rest: int = 7) -> Column:
    """test for fixed keys, val for every so-manieth key, else train; NULL keys train."""
    return F.when(key.isin(test), "test").when(key % every == rest, "val").otherwise("train")


def batches(df: DataFrame, order: list[str], size: int, name: str = "batch", parts: int = 64) -> DataFrame:
    """Consecutive numbers of ``size`` rows in the order of a hash-partitioned range: rows are counted per piece of the
    order first, so that no task sees more than a piece."""
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    piece = ranged.withColumn("_p", F.spark_partition_id())
    sizes = piece.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per piece
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    placed = piece.withColumn("_i", inside).join(F.broadcast(sizes.withColumn("_b", before).drop("_n")), "_p")
    return placed.withColumn(name, F.floor((F.col("_i") + F.col("_b")) / size).cast("int")).drop("_p", "_i", "_b")


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Parquet in place of what was there; with ``by`` only the partitions that occur in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text with a header; tabs and line ends in values become spaces, NULL becomes empty."""
    flat = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]", " ").alias(c) for c in df.columns]
    df.select(*flat).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def ledger_merge(ledger: DataFrame, news: DataFrame, key: str, at: str) -> DataFrame:
    """One row per key: its latest state; adding the same news again changes nothing."""
    cols = ledger.columns
    every = ledger.unionByName(news.select(*cols))
    return every.groupBy(key).agg(F.max(F.struct(at, *[c for c in cols if c not in (key, at)])).alias("_x")).select(key, "_x.*").select(*cols)


def page_dump(lines: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A text row for every printed line as JSON, in order within its page, so that a change of one line changes one row of
    the file (``write.partitionBy(...).text``). NULL fields are left out."""
    fields = [c for c in lines.columns if c not in keys]
    return lines.select(*keys, *order, F.to_json(F.struct(*fields)).alias("value")).sort(*keys, *order).select(*keys, "value")


def write_pages(pages: DataFrame, path: str, key: str = "leaf") -> None:
    """Pages written back by their key: partitions of pages that are not given stay as they are."""
    spread_by = pages.repartition(key)
    spread_by.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_samples(samples: DataFrame, path: str, split: str = "split", ident: str = "id") -> DataFrame:
    """Samples written by split, beside a list of the ids of each; gives the counts."""
    samples.write.mode("overwrite").partitionBy(split).parquet(f"{path}/samples")
    samples.select(split, F.col(ident).cast("string").alias("value")).sort("value").write.mode("overwrite").partitionBy(split).text(f"{path}/lists")
    return samples.groupBy(split).agg(F.count("*").alias("n"))


def candidates(spark, path: str, registry: dict, name: str, leaves: DataFrame, refresh: bool = False) -> DataFrame:
    """The texts of a candidate (``registry``: name to a function of leaves that gives leaf, text) for the leaves, made only where
    they are not kept in ``path`` yet, or all anew with ``refresh``."""
    from pyspark.errors import AnalysisException

    folder = f"{path}/cand={name}"
    try:
        kept = spark.read.schema("text string, leaf int").parquet(folder)
        kept.limit(1).count()
    except AnalysisException:
        kept = None
    missing = leaves if refresh or kept is None else leaves.join(kept, "leaf", "left_anti")
    made = registry[name](missing.select("leaf").distinct())
    write_pages(made.select("text", "leaf"), folder)
    return spark.read.schema("text string, leaf int").parquet(folder).join(leaves.select("leaf").distinct(), "leaf", "left_semi")


def stored_readings(hints: DataFrame, readings: DataFrame, keys: list[str], witnesses: dict[str, str]) -> DataFrame:
    """Hints with the newest reading of each (readings: keys, reading, source, read_at; a NULL reading says that there is no
    head), and which witnesses' texts hold it: ``confirmed_by`` and ``check`` (confirmed, disputed, no_entry; NULL where nothing was
    read). ``witnesses`` names the columns of ``hints`` with their texts."""
    from corpusloom.functions.text import squash
    from corpusloom.operators.vote import confirmed_by

    last = readings.groupBy(*keys).agg(F.max(F.struct("read_at", "source", "reading")).alias("_r"))
    both = hints.join(last, keys, "left").withColumn("headword", F.col("_r.reading")).withColumn("headword_source", F.col("_r.source"))
    by = confirmed_by(squash(F.col("headword")), **{name: squash(F.col(c)) for name, c in witnesses.items()})
    check = F.when(F.col("_r").isNull(), None).when(F.col("headword").isNull(), "no_entry").when(F.length(by) > 0, "confirmed").otherwise("disputed")
    return both.withColumn("confirmed_by", F.when(F.col("headword").isNotNull(), by)).withColumn("check", check).drop("_r")
