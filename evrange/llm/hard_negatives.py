"""Hard negatives by coordinate pruning, in blocks of rows and anchors.

Rows are dealt into blocks, and a block's rows into buckets of like length, longest first. A
bucket keeps, per coordinate, its rows' unit values in sorted order. An anchor that wants inner
products of at least t wants a cosine of at least c = t / (its length * the bucket's longest);
then coordinate f of a row lies within a_f c -+ sqrt((1 - a_f^2) (1 - c^2)). The ranges of the
anchor's largest coordinates are cut out of the sorted lists and intersected, and what is left
is verified by exact integer products. Thresholds rise with what a block has found so far,
and whole buckets fall out once c is above one.

Two passes: the first finds each anchor's positives, the second takes the scores of those as
bounds for the negatives. A block gives at most k rows a question, so what is shuffled grows with
the number of blocks, not of rows.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from evrange.llm.common import col, staged

SCALE = 256
BLOCK_ROWS, BLOCK_ANCHORS = 4096, 2048
FOCUS = 4               # coordinates of an anchor whose ranges are intersected
LONGER = 1.05           # lengths in a bucket differ by this factor at most
_SLACK = 1e-6           # room for rounding in the ranges


class Buckets:
    """The vectors of one block by length, each bucket with sorted coordinate lists."""

    def __init__(self, vectors: np.ndarray):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.parts = []
        while len(order):
            top = lengths[order[0]]
            n = max(1, int(np.searchsorted(-lengths[order], -top / LONGER, "right")))
            rows, order = order[:n], order[n:]
            unit = vectors[rows] / np.maximum(lengths[rows], 1e-300)[:, None]
            at = np.argsort(unit, axis=0)
            self.parts.append((top, rows, at, np.take_along_axis(unit, at, axis=0)))
        self.vectors = vectors

    def candidates(self, part, anchor, length, least, focus):
        """Rows of a bucket that may reach the product `least` with the anchor, or None for nobody."""
        top, rows, at, values = part
        if least <= 0 or not length or not top:
            return rows if least <= 0 else None
        cosine = least / (length * top) - _SLACK
        if cosine > 1:
            return None
        inside, asked = None, 0
        cosine = max(cosine, -1.0)
        for f in focus:
            a = min(1.0, max(-1.0, anchor[f] / length))
            reach = np.sqrt(1 - a * a) * np.sqrt(1 - cosine * cosine) + _SLACK
            # the angle to the axis is that of the anchor, give or take that of the cosine
            low = 0 if a <= -cosine else np.searchsorted(values[:, f], a * cosine - reach)
            high = len(rows) if a >= cosine else np.searchsorted(values[:, f], a * cosine + reach, "right")
            if high - low == len(rows):
                continue
            if inside is None:
                inside = np.zeros(len(rows), np.int8)
            inside[at[low:high, f]] += 1
            asked += 1
        return rows if inside is None else rows[inside == asked]


def _best(scores, ids, k):
    """Indices of the k best by score, then smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _matrix(series) -> np.ndarray:
    return np.stack(series.to_list()).astype(np.float64)


_KEY = ["anchor", "slot", "positive", "positive_score"]


def _search(rows: pd.DataFrame, questions: pd.DataFrame, k: int) -> pd.DataFrame:
    """For each question the k best rows of the block between its bounds, of its label or of others."""
    out = [pd.DataFrame(columns=[*_KEY, "id", "score"])]
    if not len(rows) or not len(questions):
        return out[0]
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    buckets = Buckets(_matrix(rows["v"]))
    for anchor, asked in questions.groupby("anchor", sort=False):
        vector = np.asarray(asked["anchor_v"].iloc[0], np.float64)
        length = float(np.sqrt(vector @ vector))
        focus = np.argsort(-np.abs(vector), kind="stable")[:FOCUS]
        same = labels == asked["anchor_label"].iloc[0]
        lows, highs, own = asked["low"].to_numpy(), asked["high"].to_numpy(), asked["same"].to_numpy()
        best = [(np.empty(0), np.empty(0, np.int64))] * len(asked)
        for part in buckets.parts:
            # a full list asks for its worst score again, as a smaller id may take its place
            least = min(max(low, s.min()) if len(s) == k else low for low, (s, _) in zip(lows, best))
            found = buckets.candidates(part, vector, length, least, focus)
            if found is None:
                break
            scores = buckets.vectors[found] @ vector
            for n, (s, i) in enumerate(best):
                fits = np.flatnonzero((same[found] == own[n]) & (scores >= lows[n]) & (scores <= highs[n])
                                      & (ids[found] != anchor))
                s, i = np.concatenate((s, scores[fits])), np.concatenate((i, ids[found][fits]))
                top = _best(s, i, k)
                best[n] = s[top], i[top]
        for n, (s, i) in enumerate(best):
            if len(s):
                out.append(pd.DataFrame({**{c: asked[c].iloc[n] for c in _KEY}, "id": i, "score": s.astype(np.int64)}))
    return pd.concat(out[1:]) if len(out) > 1 else out[0]


def _ask(rows: DataFrame, questions: DataFrame, n_rows: int, n_anchors: int, k: int) -> DataFrame:
    """The k best rows of all blocks for every question (anchor, slot), with score and rank."""
    row_blocks = max(1, -(-n_rows // BLOCK_ROWS))
    anchor_blocks = max(1, -(-n_anchors // BLOCK_ANCHORS))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(key, n):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    left = rows.withColumn("rb", dealt("id", row_blocks)).withColumn("ab", every(anchor_blocks))
    right = questions.withColumn("ab", dealt("anchor", anchor_blocks)).withColumn("rb", every(row_blocks))
    found = left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInPandas(
        lambda a, b: _search(a, b, k),
        "anchor long, slot int, positive long, positive_score long, id long, score long")
    nth = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k)


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, components as floor(scale * x)."""
    rows = vectors.select(col(vec_id).cast("long").alias("id"), col(label).alias("label"), col(embedding).alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(whole)
            .withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double"))))


def mine(vectors: DataFrame, is_anchor: str, relabel: str = None, positives: int = 5, negatives: int = 5, low: int = 80,
         vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is the inner product of the scaled components; ties go to the smaller id.
    Positives of an anchor are the best other rows of its label. The negatives of a positive
    are the best rows of other labels whose score s has low * p <= 100 * s <= 100 * p, p being
    the positive's. `is_anchor` is a condition on `id` in SQL, `relabel` an expression on
    `id` and `label` for the label to use. Rows with a null id, label, vector or component, or one that
    is not finite, take no part; of several rows of one id the one of the smallest label and
    vector does. Vectors must be of one length. Few rows give few partners; an anchor without any gives no row,
    and an empty table an empty table. Other columns of `vectors` play no part.
    """
    rows = usable(vectors, vec_id, embedding, label, scale)
    if relabel is not None:
        rows = rows.withColumn("label", F.expr(relabel))
    first = F.min(F.struct("label", "v")).alias("first")
    rows = staged(rows.groupBy("id").agg(first).select("id", "first.*"))
    n_rows, n_anchors = rows.agg(F.count("*"), F.count_if(F.expr(is_anchor))).first()
    anchors = rows.where(is_anchor).select(F.col("id").alias("anchor"), F.col("label").alias("anchor_label"),
                                              F.col("v").alias("anchor_v"))
    asks = anchors.select("*", F.lit(0).alias("slot"), F.lit(0).cast("long").alias("positive"),
                          F.lit(0).cast("long").alias("positive_score"), F.lit(True).alias("same"),
                          F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"))
    found = staged(_ask(rows, asks, n_rows, n_anchors, positives).select(
        "anchor", F.col("rank").alias("slot"), F.col("id").alias("positive"), F.col("score").alias("positive_score")))
    # products are whole numbers of up to 2^53, so these doubles compare as the whole numbers do
    least = F.ceil(F.col("positive_score").cast("decimal(20,0)") * low / 100)
    asks = found.join(anchors, "anchor").select(
        *_KEY, "anchor_label", "anchor_v", F.lit(False).alias("same"), least.cast("double").alias("low"),
        F.col("positive_score").cast("double").alias("high"))
    return _ask(rows, asks, n_rows, n_anchors, negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
