"""A bounded sample of labelled documents, and training on it.

Training runs in one executor task; the driver gets the fitted model only.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import id_text

SAMPLE_ROWS = 3000
SAMPLE_BYTES = 48 << 20
#: Longer texts are not learnt from, so that one cannot use up the bytes.
LONGEST = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, **bounds) -> list:
    """The rows of ``sample_frame``, in order, as Row(label, text)."""
    return sample_frame(docs, labels, label_col, **bounds).orderBy("h", "doc_id", "text") \
        .select("label", "text").collect()


def fitted(sample: DataFrame, train: Callable[[list], object]):
    """``train`` applied to a sample's rows in one executor task. Fails if it
    has one label only, though the labels it was drawn from have two."""
    place = ("h", "doc_id", "text")

    def run(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: tuple(r[c] for c in place))
        found = {r["label"] for r in rows}
        if rows and len(found) < rows[0]["kinds"]:
            raise ValueError(f"the sample holds the labels {sorted(found)} only, "
                             f"the table {rows[0]['kinds']}")
        model = train([SimpleNamespace(label=r["label"], text=r["text"]) for r in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())],
                                         names=["model"])

    return pickle.loads(sample.coalesce(1).mapInArrow(run, "model binary").first().model)


def sample_frame(docs: DataFrame, labels: DataFrame, label_col: str, *,
                 rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES,
                 longest: int = LONGEST, ones: int | None = None, where=None) -> DataFrame:
    """At most ``rows`` labelled texts of at most ``most_bytes`` together, none
    longer than ``longest`` bytes: (h, doc_id, text, label, kinds).

    Rows are taken in the order of a hash of doc_id, so the sample is spread
    evenly and is the same in every run. With ``ones``, at most that many have
    label 1 and the rest label 0 (for rare labels). Rows without id or label
    do not count; a document with two labels keeps the smaller. ``where`` is a
    condition on ``doc_id``. ``kinds``: how many labels the documents have that
    could be drawn.
    """
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("label"))
             .where("doc_id is not null and label is not null"))
    if where is not None:
        marks = marks.where(where)
    marks = (marks.groupBy("doc_id").agg(F.min("label").alias("label"))
             .withColumn("h", F.xxhash64("doc_id", F.lit(7))))

    def first(df, n):
        return df.orderBy("h", "doc_id").limit(n)
    if ones is None:
        marks = first(marks, rows)
    else:
        marks = first(marks.where("label = 1"), ones).unionByName(
            first(marks.where("label = 0"), rows - ones))
    # at most `rows` narrow rows, so the broadcast is bounded
    found = (id_text(docs).join(F.broadcast(marks), "doc_id")
             .withColumn("size", F.octet_length("text").cast("long")))
    whole = Window.partitionBy()  # bounded rows
    order = Window.orderBy("h", "doc_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    found = (found.withColumn("text", F.when(F.col("size") <= longest, F.col("text")))
             .orderBy("h", "doc_id", "text").limit(rows)
             .withColumn("kinds", F.size(F.collect_set("label").over(whole)))
             .where("text is not null"))
    return (found.withColumn("total", F.sum("size").over(order))
            .where(F.col("total") <= most_bytes)
            .select("h", "doc_id", "text", "label", "kinds"))


def label_odds(labels: DataFrame, label_col: str, where=None) -> float:
    """Rows with label 1 for each row with label 0."""
    rows = labels if where is None else labels.where(where)
    one, zero = rows.agg(F.count_if(F.col(label_col) == 1),
                         F.count_if(F.col(label_col) == 0)).first()
    return one / zero if zero else float("inf")
