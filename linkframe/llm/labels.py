"""Labelled rows for the classifiers: the training fold, and a bounded sample of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from. A null id is the text of no number and is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``label`` (0/1), ``text`` of about ``most`` labelled documents outside the held-out fold, chosen by a hash of the id.

    Of several labels for an id the most frequent counts (1 on a tie); null labels and ids are no labels. The chosen
    labels are at most a little over ``most`` rows, so they are broadcast and only the sample's texts are shuffled.
    Copies of a text are one example, with the label that most of them have.
    """
    one = labels.where(F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("id_")).agg(
        (F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    total = one.count()
    share = min(1.0, most / max(total, 1))
    chosen = one.where(F.pmod(F.xxhash64(F.lit(17), "id_"), F.lit(1 << 30)) < int(share * (1 << 30)) if share < 1 else F.lit(True))
    return docs.select(F.col(key).alias("id_"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "id_").groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
