"""Hard negatives by slots: for each anchor and positive, the best rows of other labels in a score band.

A row's score is the integer inner product of its quantised vector with the anchor's. An
anchor's positives are its first ``positives`` other rows of the same label, best first. A
positive of score p asks for the first ``negatives`` rows of other labels with
low * p <= 100 * score <= high * p. These bands overlap; their upper limits, in descending
order, cut the scores below the highest into disjoint slots, and each band's rows are in its own slot and
the slots after it. So one pass keeps the first rows of each (anchor, slot), combined inside
every task before they are shuffled, and a merge over each suffix of slots answers all bands,
their lower limits cut at the end.

All rows meet all anchors in blocks: both are dealt into blocks of a bounded number, and one
task multiplies a block of rows with a block of anchors, a slice at a time.

Rows with a null label, a null vector, or a null or non-finite component take no part. Ties
go by the smaller id, null ids last. Rows of an anchor's own id are not others to it. A row
listed twice is two rows, but one anchor. Missing components of shorter vectors count as 0.
An anchor without positives, or a band without rows, gives no rows; so does an empty table.
A score beyond 64 bits fails the run. Columns other than the three named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawstar.session import materialize, shuffle_width

# Rows, and anchors, of a block; scores of one slice.
BLOCK = 1 << 16
SLICE = 1 << 22
ANCHOR = ["anchor_id", "anchor_key"]
EXACT = 2**53


def quantised(table: pa.Table, width: int) -> np.ndarray:
    """floor(256 * x) of the vectors as whole doubles, with zeros up to ``width``."""
    column = table.column("vector").combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * 256)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _widest(*tables: pa.Table) -> int:
    sizes = [np.diff(c.offsets.to_numpy()).max(initial=0) for t in tables for c in t.column("vector").chunks]
    return int(max(sizes, default=0))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles hold whole numbers up to 2**53, beyond that whole numbers are used."""
    bound = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if bound < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in anchors], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    if max(map(abs, exact.flat)) >= 2**63:
        raise ValueError("a score needs more than 64 bits")
    return exact.astype(np.int64)


def first_of(values: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the positions ``at``, in ascending id, the first k by descending value; ties keep their order."""
    if len(at) > k:
        own = values[at]
        least = np.partition(own, len(own) - k)[len(own) - k]
        above, level = at[own > least], at[own == least]
        at = np.sort(np.concatenate([above, level[: k - len(above)]]))
    return at


def _in_id_order(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("id", "ascending")]).combine_chunks()


def _ids(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name)
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy()


def _sliced(anchors: pa.Table, rows: pa.Table):
    """(position of an anchor, its scores with all rows)."""
    width = _widest(anchors, rows)
    right, left = quantised(rows, width), quantised(anchors, width)
    step = max(1, SLICE // max(1, len(right)))
    for a in range(0, len(left), step):
        yield from enumerate(scores(left[a : a + step], right), a)


def _out(anchors: pa.Table, rows: pa.Table, found: list[tuple]) -> pa.Table:
    """``found``: (anchor's position, slot, rows' positions, their scores)."""
    reps = [len(at) for _, _, at, _ in found]
    which = np.repeat(np.array([i for i, *_ in found], np.int64), reps)
    at = np.concatenate([x[2] for x in found]) if found else np.zeros(0, np.int64)
    score = np.concatenate([x[3] for x in found]) if found else np.zeros(0, np.int64)
    return pa.table(
        {
            "anchor_id": anchors.column("id").take(pa.array(which)),
            "anchor_key": anchors.column("key").take(pa.array(which)),
            "slot": pa.array(np.repeat(np.array([s for _, s, *_ in found], np.int32), reps)),
            "id": rows.column("id").take(pa.array(at.astype(np.int64))),
            "score": pa.array(score.astype(np.int64)),
        }
    )


PARTIAL = "anchor_id long, anchor_key long, slot int, id long, score long"


def _best_positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = _in_id_order(rows)
        ids, no_id = _ids(rows, "id")
        labels = rows.column("label").to_numpy()
        own_ids, own_labels = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        found = []
        for i, values in _sliced(anchors, rows):
            at = np.nonzero((labels == own_labels[i]) & (no_id | (ids != own_ids[i])))[0]
            at = first_of(values, at, k)
            found.append((i, 0, at, values[at]))
        return _out(anchors, rows, found)

    return run


def _best_of_slots(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = _in_id_order(rows)
        labels, own_labels = rows.column("label").to_numpy(), anchors.column("label").to_numpy()
        limits, least = anchors.column("limits").to_pylist(), anchors.column("least").to_numpy()
        found = []
        for i, values in _sliced(anchors, rows):
            at = np.nonzero((values <= limits[i][0]) & (values >= least[i]) & (labels != own_labels[i]))[0]
            # The slot of a score: how many upper limits are at or above it, less one.
            slot = np.searchsorted(-np.array(limits[i]), -values[at], side="right") - 1
            for s in np.unique(slot):
                best = first_of(values, at[slot == s], k)
                found.append((i, s, best, values[best]))
        return _out(anchors, rows, found)

    return run


def _in_blocks(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], run) -> DataFrame:
    """``run`` on each pair of a block of rows and a block of anchors."""
    spread, anchor_blocks = max(shuffle_width(rows.sparkSession), -(-counts[0] // BLOCK)), max(1, -(-counts[1] // BLOCK))

    def block(of: int):
        return F.pmod(F.xxhash64("id", "key", "label"), F.lit(of)).cast("int")

    def every(of: int):
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    left = rows.withColumn("rb", block(spread)).withColumn("ab", every(anchor_blocks))
    right = anchors.withColumn("ab", block(anchor_blocks)).withColumn("rb", every(spread))
    return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInArrow(run, PARTIAL)


def _first_rows(partial: DataFrame, k: int) -> DataFrame:
    """The first k of each (anchor, slot); Spark limits each task's rows before the shuffle."""
    order = Window.partitionBy(*ANCHOR, "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return partial.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """id, key, label, vector of the rows that take part. ``vectors``: vec_id, embedding, label."""
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), F.col("embedding").alias("vector"))
    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("key", F.xxhash64("label", "vector"))


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on vec_id, ``label`` an expression over the row.
    """
    rows = materialize(usable(vectors, label), "vectors")
    chosen = rows.where(F.col("id").isNotNull()).withColumn("vec_id", F.col("id")).where(anchors).drop("vec_id")
    chosen = materialize(chosen.dropDuplicates(["id", "key"]), "anchors")
    counts = rows.count(), chosen.count()
    own = _first_rows(_in_blocks(rows, chosen, counts, _best_positives(positives)), positives)
    whole = "({0} - pmod({0}, 100)) div 100"
    own = own.select(
        *ANCHOR,
        "place",
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.expr(whole.format(f"({high} * score)")).alias("upper"),
        F.expr(f"-({whole.format(f'(-{low} * score)')})").alias("lower"),
    )
    own = materialize(own.where("lower <= upper"), "positives")
    # At most ``positives`` limits of an anchor, highest first.
    limits = own.groupBy(*ANCHOR).agg(F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("least"))
    asking = chosen.join(limits.select(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key"), "limits", "least"), ["id", "key"])
    best = _first_rows(_in_blocks(rows, materialize(asking, "asking"), counts, _best_of_slots(negatives)), negatives)
    entry = F.struct("slot", "place", F.col("id").alias("id"), "score")
    by_anchor = best.groupBy(*ANCHOR).agg(F.array_sort(F.collect_list(entry)).alias("slots"))
    answered = own.join(limits, ANCHOR).join(by_anchor, ANCHOR)
    first = F.array_position("limits", F.col("upper")) - 1
    suffix = F.slice(F.filter("slots", lambda x: x["slot"] >= first), 1, negatives)
    band = F.filter(suffix, lambda x: x["score"] >= F.col("lower"))
    return answered.select("anchor_id", "positive_id", "positive_score", F.posexplode(band).alias("at", "row")).select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("row.id").alias("negative_id"),
        "positive_score",
        F.col("row.score").alias("negative_score"),
    )
