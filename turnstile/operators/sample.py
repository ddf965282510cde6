"""Splitting and balancing (M8, M9).

``train_test_split`` — exact size ``ceil(test_size·n)`` ordered by
``md5(id|seed)``: histograms of the digest prefix (≤ 65,536 buckets each, so
bounded on the driver) narrow down the bucket holding the k-th key; only that
small bucket is sorted; the split itself is then a comparison with the k-th
``(key, id)`` — a projection, no shuffle of the table.

``smote_neighbors`` — exact nearest neighbour inside each class without
emitting all pairs: exact duplicates are resolved by aggregation, distinct
points by a search over k-d leaves (``neighbors.py``).

``smote`` — every non-majority class is raised to the majority count with
points on the segment between a row and its neighbour; which rows get one
extra copy is again a k-th-key cutoff; copies are generated in chunks so a
single minority row never produces an unbounded run in one task.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile import defaults as D
from turnstile.functions.expressions import hash_rank_key, hash_uniform, name_lookup
from turnstile.operators.neighbors import LEAF_POINTS, class_values, nearest_points
from turnstile.session import cut_lineage, maybe_broadcast

# Rows a final boundary bucket may hold before it is sorted in one task.
BOUNDARY_SORT_MAX = 200_000
# Hex digits added per histogram level (16**4 = 65,536 buckets).
PREFIX_STEP = 4
# Copies generated per row in one chunk.
COPY_CHUNK = 10_000


# ---------------------------------------------------------------------------
# k-th smallest (key, id) without a global sort
# ---------------------------------------------------------------------------

def kth_key(df: DataFrame, key: Column, tie: str,
            k: int | Callable[[int], int]) -> tuple[str, object] | None:
    """The k-th smallest ``(key, tie)`` (1-based) where ``key`` is a 32-hex-digit
    string; None for k <= 0.

    ``k`` may be a function of the row count: the first histogram gives the
    count, so no separate counting pass is needed."""
    found = kth_rows(df, key, tie, k)
    return found and found[:2]


def kth_rows(df: DataFrame, key: Column, tie: str,
             k: int | Callable[[int], int]) -> tuple[str, object, int, int] | None:
    """(key, tie, need, count): the k-th smallest ``(key, tie)``, how many rows have
    it, and how many of those are among the first k."""
    if not callable(k) and k <= 0:
        return None
    frame = df.select(key.alias("_key"), F.col(tie).alias("_tie"))
    prefix, remaining, level_rows = "", k, frame
    while True:
        width = len(prefix) + PREFIX_STEP
        hist = (level_rows.groupBy(F.substring("_key", 1, width).alias("_p"))
                .agg(F.count(F.lit(1)).alias("_n")).orderBy("_p").collect())
        total = sum(r._n for r in hist)
        if callable(remaining):
            remaining = k = remaining(total)
            if k <= 0:
                return None
        if remaining > total:
            raise ValueError(f"k={k} exceeds the number of rows")
        before = 0
        for r in hist:
            if before + r._n >= remaining:
                prefix, count = r._p, r._n
                break
            before += r._n
        remaining -= before
        level_rows = level_rows.where(F.substring("_key", 1, len(prefix)) == F.lit(prefix))
        # Rows of one whole key are counted by tie below, however many they are.
        if count <= BOUNDARY_SORT_MAX or len(prefix) >= 32:
            break
    ties = level_rows.groupBy("_key", "_tie").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_key", "_tie"))
    row = ties.withColumn("_upto", upto).where(F.col("_upto") >= remaining).orderBy("_key", "_tie").first()
    return row["_key"], row["_tie"], remaining - (row["_upto"] - row["_n"]), row["_n"]


def _at_or_before(key: Column, tie: Column, cut: tuple[str, object] | None) -> Column:
    if cut is None:
        return F.lit(False)
    ck, ct = cut
    return (key < F.lit(ck)) | ((key == F.lit(ck)) & (tie <= F.lit(ct)))


# ---------------------------------------------------------------------------
# M9: train/test split
# ---------------------------------------------------------------------------

def train_test_split(df: DataFrame, id_col: str, test_size: float = D.TEST_SIZE,
                     seed: int = D.SPLIT_SEED, exact: bool = True,
                     output: str = "split") -> DataFrame:
    """Add ``split`` ∈ {'train','test'}.

    ``exact=True``: the test part is the first ``ceil(test_size·n)`` rows by
    ``(md5(id|seed), id)`` — shuffled, unstratified, exact size, and the same
    rows for the same ids and seed.  Of rows that share the id at the boundary
    those with the smaller digest of the whole row come first; of equal rows as
    many as are needed, which makes the table be written once.  ``exact=False``: each row independently
    (hash below ``test_size``) — no extra job at all.
    """
    (i,) = name_lookup(df, [id_col])
    key = hash_rank_key([i], seed)
    if not exact:
        flag = hash_uniform([i], seed) < F.lit(float(test_size))
    else:
        df, flag = _first_rows(df, key, i, lambda n: math.ceil(test_size * n))
    return df.withColumn(output, F.when(flag, F.lit("test")).otherwise(F.lit("train"))).drop("_row_at", "_first")


def _first_rows(df: DataFrame, key: Column, tie: str, k: Callable[[int], int]) -> tuple[DataFrame, Column]:
    """``df`` and a flag that holds for exactly k of its rows, the first by
    ``(key, tie)`` whatever repeats."""
    found = kth_rows(df, key, tie, k)
    if found is None:
        return df, F.lit(False)
    cut_key, cut_tie, need, count = found
    if need == count:
        return df, _at_or_before(key, F.col(tie), (cut_key, cut_tie))
    at_cut = (key == F.lit(cut_key)) & (F.col(tie) == F.lit(cut_tie))
    before = (key < F.lit(cut_key)) | ((key == F.lit(cut_key)) & (F.col(tie) < F.lit(cut_tie)))
    row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    cut_row, _, need, count = kth_rows(df.where(at_cut), row, tie, need)
    if need == count:
        return df, before | (at_cut & (row <= F.lit(cut_row)))
    # Equal rows: any will do, but a number must stay with its row.
    columns = [F.col(f"`{c}`") for c in df.columns]
    df = cut_lineage(df.select(*columns, row.alias("_row"), F.monotonically_increasing_id().alias("_row_at")))
    place = F.lower(F.lpad(F.hex("_row_at"), 32, "0"))
    same = at_cut & (F.col("_row") == F.lit(cut_row))
    cut_place = kth_key(df.where(same), place, "_row_at", need)[1]
    flag = before | (at_cut & (F.col("_row") < F.lit(cut_row))) | (same & (F.col("_row_at") <= F.lit(cut_place)))
    return df.select(*columns, flag.alias("_first"), "_row_at"), F.col("_first")


# ---------------------------------------------------------------------------
# M8: nearest neighbour within class
# ---------------------------------------------------------------------------

def smote_neighbors(df: DataFrame, id_col: str, features: Sequence[str], label: str,
                    classes: Sequence | None = None,
                    leaf_points: int = LEAF_POINTS, k: int = D.SMOTE_K) -> DataFrame:
    """``(id, label, neighbor_id, distance)``: nearest other row of the same
    class by Euclidean distance on the raw features, ties → smaller id.

    Exact.  Rows whose class has a single member get a null neighbour.  With
    ``k`` over 1 a row for each of the k nearest (all, if fewer) and their
    ``rank`` from 1 before the last column.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    i, lab = name_lookup(df, [id_col, label])
    feats = name_lookup(df, features)
    pts = df.select(F.col(i).alias("_id"), F.col(lab).alias("_cls"),
                    *[F.col(c).cast("double").alias(f"_x{a}") for a, c in enumerate(feats)])
    if classes is not None:
        pts = pts.where(F.col("_cls").isin(list(classes)))
    xs = [f"_x{a}" for a in range(len(feats))]

    # Exact duplicates (same class, same point): distance 0, partner is the
    # smallest other id of the group.  Aggregated, so a hot point is fine; the
    # duplicated points are few distinct keys, joined back behind a size check.
    data = cut_lineage(pts.groupBy("_cls", *xs).agg(F.min("_id").alias("_id"),
                                                    F.count(F.lit(1)).alias("_cnt")))
    dup_keys = data.where(F.col("_cnt") > 1).select("_cls", *xs, F.col("_id").alias("_m1"))
    dup_rows = pts.join(maybe_broadcast(dup_keys), ["_cls", *xs])
    if k > 1:
        found = _rows_of_points(data, dup_rows, nearest_points(data, "_id", "_cls", xs, leaf_points, k), k)
        return found.select(F.col("_id").alias(i), F.col("_cls").alias(lab), "rank",
                            F.col("_nn").alias("neighbor_id"), F.sqrt(F.col("_d2")).alias("distance"))
    second = cut_lineage(dup_rows.where(F.col("_id") != F.col("_m1"))
                         .groupBy("_cls", *xs).agg(F.min("_id").alias("_m2")))
    dup_nn = (dup_rows.join(maybe_broadcast(second), ["_cls", *xs])
              .select("_id", "_cls",
                      F.when(F.col("_id") == F.col("_m1"), F.col("_m2"))
                      .otherwise(F.col("_m1")).alias("_nn"),
                      F.lit(0.0).alias("_d2")))
    # Distinct points search among one representative (smallest id) per point.
    single = data.where(F.col("_cnt") == 1).select("_id")
    found = nearest_points(data, "_id", "_cls", xs, leaf_points).join(single, "_id", "left_semi")
    return dup_nn.unionByName(found).select(
        F.col("_id").alias(i), F.col("_cls").alias(lab), F.col("_nn").alias("neighbor_id"),
        F.sqrt(F.col("_d2")).alias("distance"))


def _rows_of_points(data: DataFrame, dup_rows: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """(_id, _cls, rank, _nn, _d2) of the k nearest rows from the k nearest points.

    ``data`` has a row per distinct point under the smallest id of its rows,
    ``dup_rows`` the rows of points with several (``_m1``: that id), ``near`` the k
    nearest other points of each.  The k nearest rows are among the first k + 1
    rows of the point itself (one of them may be the row that asks) and the first
    k of each near point, so no more of a hot point is ever gathered.
    """
    place = F.row_number().over(Window.partitionBy("_m1").orderBy("_id"))
    members = cut_lineage(dup_rows.select("_m1", "_id").withColumn("_place", place)
                          .where(F.col("_place") <= k + 1))
    others = near.where(F.col("_nn").isNotNull()).join(
        maybe_broadcast(members.select(F.col("_m1").alias("_nn"), F.col("_id").alias("_member"))), "_nn", "left")
    cands = others.select(F.col("_id").alias("_m1"), "_d2", F.coalesce("_member", "_nn").alias("_nn")).unionByName(
        members.select("_m1", F.lit(0.0).alias("_d2"), F.col("_id").alias("_nn")))
    best = F.row_number().over(Window.partitionBy("_m1").orderBy("_d2", "_nn"))
    cands = (cands.withColumn("_place", best).where(F.col("_place") <= k + 1)
             .groupBy("_m1").agg(F.array_sort(F.collect_list(F.struct("_d2", "_nn"))).alias("_cands")))
    single = data.where(F.col("_cnt") == 1).select("_id", "_cls", F.col("_id").alias("_m1")).join(cands, "_m1", "left")
    dup_cands = cut_lineage(cands.join(maybe_broadcast(members.select("_m1").distinct()), "_m1", "left_semi"))
    repeated = dup_rows.select("_id", "_cls", "_m1").join(maybe_broadcast(dup_cands), "_m1")
    rows = single.select("_id", "_cls", "_cands").unionByName(repeated.select("_id", "_cls", "_cands"))
    other = F.slice(F.filter("_cands", lambda c: c["_nn"] != F.col("_id")), 1, k)
    return rows.select("_id", "_cls", F.posexplode_outer(other).alias("_at", "_c")).select(
        "_id", "_cls", (F.coalesce("_at", F.lit(0)) + 1).alias("rank"), "_c._nn", "_c._d2")


# ---------------------------------------------------------------------------
# M8: SMOTE
# ---------------------------------------------------------------------------

def smote(df: DataFrame, id_col: str, features: Sequence[str], label: str,
          seed: int = D.SMOTE_SEED, neighbors: DataFrame | None = None,
          k: int = D.SMOTE_K) -> DataFrame:
    """Raise every class below the majority count to it with synthetic rows
    ``x + u·(nn − x)``, ``u = md5(id|copy|seed)`` mapped to [0, 1).

    Each class needs ``M − n`` new rows; every row of the class gives
    ``(M − n) div n`` copies and the first ``(M − n) mod n`` rows by
    ``md5(id|seed)`` give one more.  Output: the original rows plus the
    synthetic ones, with ``is_synthetic`` and ``copy_index`` (null for
    originals).  A class with one member cannot be raised (error).  With ``k``
    over 1 a copy's partner is one of the row's k nearest (all, if fewer),
    drawn by the md5 of id, copy and ``seed + 1``.
    """
    i, lab = name_lookup(df, [id_col, label])
    feats = name_lookup(df, features)
    class_values(df, lab)                       # raises if it is no class label
    # Private names: the id may be a feature as well.
    xs = [f"_f{a}" for a in range(len(feats))]
    base = df.select(F.col(i).alias("_sid"), F.col(lab).alias("_scls"),
                     *[F.col(c).cast("double").alias(x) for c, x in zip(feats, xs)])
    names = [F.col("_sid").alias(i), F.col("_scls").alias(lab),
             *[F.col(x).alias(c) for c, x in zip(feats, xs) if c not in (i, lab)]]
    originals = base.select(*names, F.lit(False).alias("is_synthetic"),
                            F.lit(None).cast("bigint").alias("copy_index"))
    counts = {r["_scls"]: r["n"] for r in
              base.groupBy("_scls").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return originals
    top = max(counts.values())
    need = {c: top - n for c, n in counts.items() if n < top}
    if not need:
        return originals
    small = [c for c, n in counts.items() if c in need and n < 2]
    if small:
        raise ValueError(f"classes {small} have fewer than 2 rows; cannot interpolate")

    key = hash_rank_key(["_sid"], seed)
    copies = F.lit(0).cast("bigint")
    for c, m_c in need.items():
        q, r = divmod(m_c, counts[c])
        cut = kth_key(base.where(F.col("_scls") == F.lit(c)), key, "_sid", r)
        extra = _at_or_before(key, F.col("_sid"), cut).cast("bigint")
        copies = F.when(F.col("_scls") == F.lit(c), F.lit(q).cast("bigint") + extra).otherwise(copies)

    raised = base.where(F.col("_scls").isin(list(need)))
    nn = neighbors if neighbors is not None else smote_neighbors(raised, "_sid", xs, "_scls", k=k)
    rows = raised.select("*", copies.alias("_copies"))
    rows = rows.where(F.col("_copies") > 0)
    chunks = F.sequence(F.lit(0).cast("bigint"),
                        ((F.col("_copies") - 1) / F.lit(COPY_CHUNK)).cast("bigint"))
    rows = rows.select("*", F.explode(chunks).alias("_chunk"))
    if max(divmod(m, counts[c])[0] + 1 for c, m in need.items()) > COPY_CHUNK:
        rows = rows.repartition("_sid", "_chunk")
    lo = F.col("_chunk") * F.lit(COPY_CHUNK)
    hi = F.least(F.col("_copies"), lo + F.lit(COPY_CHUNK)) - F.lit(1)
    rows = rows.select("*", F.explode(F.sequence(lo, hi)).alias("copy_index"))

    partner = raised.select(F.col("_sid").alias("_nid"), *[F.col(x).alias(f"_n{x}") for x in xs])
    nnk = nn.select(F.col(nn.columns[0]).alias("_qid"), F.col("neighbor_id").alias("_nid"))
    same = F.col("_sid") == F.col("_qid")
    if k > 1:
        nnk = nn.select(F.col(nn.columns[0]).alias("_qid"), F.col("rank").alias("_rank"), F.col("neighbor_id").alias("_nid"))
        choice = F.lit(0)
        for c in need:
            choice = F.when(F.col("_scls") == F.lit(c), F.lit(min(k, counts[c] - 1))).otherwise(choice)
        drawn = F.floor(hash_uniform([F.col("_sid"), F.col("copy_index")], seed + 1) * choice) + 1
        rows = rows.withColumn("_drawn", drawn)
        same = same & (F.col("_drawn") == F.col("_rank"))
    joined = rows.join(nnk, same).join(partner, "_nid")
    u = hash_uniform([F.col("_sid"), F.col("copy_index")], seed)
    synth = joined.select("_sid", "_scls", *[(F.col(x) + u * (F.col(f"_n{x}") - F.col(x))).alias(x) for x in xs],
                          F.lit(True).alias("is_synthetic"), F.col("copy_index").cast("bigint"))
    return originals.unionByName(synth.select(*names, "is_synthetic", "copy_index"))
