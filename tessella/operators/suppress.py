"""Ordered greedy suppression: visit boxes in a total order, keep one unless a kept one conflicts with it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import boxes as bx
from ..storage import write_through

#: Most boxes of a group that one task keeps in memory; larger groups go by the conflict graph.
GROUP_LIMIT = 100_000
#: A box over more cells than this is compared with all instead of being listed in each.
WIDE = 64
#: Most pairs of a group that are compared block by block, and pairs of a block.
PAIRS, BLOCK = 100_000_000, 500_000
#: Side of the regions that decide conflicts by themselves, in sides of a usual box, and most pairs of one.
REGION, REGION_PAIRS = 24.0, 2_000_000


@dataclass(frozen=True)
class Rule:
    """Order and conflict of one kind of suppression. Ties are broken by id, so results are defined."""

    name: str
    by_area: bool  # visit by area, then confidence, then ascending id; else by confidence, then descending id
    iou: float | None = None  # conflict: intersection over union above this
    inclusive: bool = False  # ... or equal to it
    coverage: float | None = None  # conflict: this share of the candidate covered, or near containment
    tolerance: float = 0.0
    margin: float | None = None  # ... and the candidate's confidence at most the kept one's plus this
    ordered: bool = False  # put corners in order first, areas EPS_AREA at least


def nms(iou: float = 0.30) -> Rule:
    """Keeps the most confident; drops what overlaps it by more than ``iou``."""
    return Rule("nms", False, iou=iou)


def nested(coverage: float = 0.85, tolerance: float = 3.0, margin: float = 0.0) -> Rule:
    """Keeps the largest; drops boxes inside or mostly covered, unless they are more confident."""
    return Rule("nested", True, coverage=coverage, tolerance=tolerance, margin=margin)


def cut_boxes(coverage: float = 0.90, tolerance: float = 3.0) -> Rule:
    """Keeps the largest; drops boxes inside or mostly covered whatever their confidence."""
    return Rule("cut_boxes", True, coverage=coverage, tolerance=tolerance, ordered=True)


def duplicates(iou: float = 0.90) -> Rule:
    """Keeps the most confident; drops what overlaps it by ``iou`` or more."""
    return Rule("duplicates", False, iou=iou, inclusive=True, ordered=True)


def suppress(df: DataFrame, rule: Rule, keys: Sequence[str] = ("image_id", "class_id"), id_col: str = "det_id", strategy: str = "auto") -> DataFrame:
    """The rows of ``df`` (columns x1, y1, x2, y2, conf, ``id_col`` and ``keys``) that ``rule`` keeps, per group of ``keys``.

    Strategies give the same rows: "pandas" visits each group in one task, "graph" works on pairs of
    conflicting boxes without ever gathering a group, "fold" is plain expressions for small groups.
    "auto" counts the groups and sends those above GROUP_LIMIT to the graph, so a group with a third
    of all rows makes no large task. Rows with a null or NaN coordinate, a null confidence or a null id
    are dropped; a NaN confidence is the lowest. Ids must be unique within a group. Empty in, empty out.
    """
    # A NaN counts as missing to dropna, so the confidence is asked separately.
    data = df.dropna(subset=["x1", "y1", "x2", "y2", id_col]).filter(F.col("conf").isNotNull())
    if strategy == "pandas":
        return _by_group(data, rule, keys, id_col)
    if strategy == "graph":
        return _by_graph(data, rule, keys, id_col)
    if strategy == "fold":
        return _by_fold(data, rule, keys, id_col)
    if strategy != "auto":
        raise ValueError(f"unknown strategy {strategy}")
    sizes = data.groupBy(*keys).agg(F.count("*").alias("_n")) if keys else data.agg(F.count("*").alias("_n"))
    large = sizes.filter(F.col("_n") > GROUP_LIMIT)
    if large.isEmpty():
        return _by_group(data, rule, keys, id_col)
    if not keys:
        return _by_graph(data, rule, keys, id_col)
    # As many rows as there are groups above the limit: fewer than rows / GROUP_LIMIT.
    large = large.select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [data[k].eqNullSafe(large[f"_{k}"]) for k in keys]
    small = _by_group(data.join(large, same, "left_anti"), rule, keys, id_col)
    return small.unionByName(_by_graph(data.join(large, same, "left_semi"), rule, keys, id_col))


# --- one group in one task -------------------------------------------------------------------


def visiting_order(rule: Rule, box: np.ndarray, conf: np.ndarray, ids: np.ndarray) -> np.ndarray:
    if rule.by_area:
        return np.lexsort((ids, -conf, -_areas(rule, box)))
    return np.lexsort((-ids, -conf))


def _areas(rule: Rule, box: np.ndarray) -> np.ndarray:
    w, h = box[:, 2] - box[:, 0], box[:, 3] - box[:, 1]
    if rule.ordered:
        return np.maximum(w * h, bx.EPS_AREA)
    plain = np.maximum(w, 0) * np.maximum(h, 0)
    return plain + bx.EPS_AREA if rule.by_area else plain


def _conflicts(rule: Rule, box: np.ndarray, conf: np.ndarray, area: np.ndarray, kept: np.ndarray, kept_conf: np.ndarray, kept_area: np.ndarray) -> np.ndarray:
    """For each pair whether the box of ``kept``, were it kept, rules out that of ``box``; either side may be a single box."""
    w = np.minimum(kept[..., 2], box[..., 2]) - np.maximum(kept[..., 0], box[..., 0])
    h = np.minimum(kept[..., 3], box[..., 3]) - np.maximum(kept[..., 1], box[..., 1])
    inter = np.maximum(w, 0) * np.maximum(h, 0)
    if rule.iou is not None:
        union = kept_area + area - inter
        share = inter / (np.maximum(union, bx.EPS_AREA) if rule.ordered else union + bx.EPS_AREA)
        return share >= rule.iou if rule.inclusive else share > rule.iou
    t = rule.tolerance
    near = (box[..., 0] >= kept[..., 0] - t) & (box[..., 1] >= kept[..., 1] - t) & (box[..., 2] <= kept[..., 2] + t) & (box[..., 3] <= kept[..., 3] + t)
    hit = near | (inter / area >= rule.coverage)
    if rule.margin is not None:
        hit &= conf <= kept_conf + rule.margin
    return hit


def kept_indices(rule: Rule, box: np.ndarray, conf: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows kept, in visiting order.

    Boxes are listed by grid cell, and the pairs of a cell compared a block at a time; the visit then
    only walks the conflicts. Where cells hold too many pairs, or boxes cover too many cells, boxes
    are visited one by one against the kept ones near them, which needs no list of pairs.
    """
    if not len(box):
        return np.zeros(0, np.int64)
    box = box.astype(np.float64)
    conf = np.where(np.isnan(conf), -np.inf, conf)
    if rule.ordered:
        box = np.column_stack([np.minimum(box[:, 0], box[:, 2]), np.minimum(box[:, 1], box[:, 3]), np.maximum(box[:, 0], box[:, 2]), np.maximum(box[:, 1], box[:, 3])])
    areas = _areas(rule, box)
    order = visiting_order(rule, box, conf, ids)
    low = np.minimum(box[:, :2], box[:, 2:]) - rule.tolerance
    high = np.maximum(box[:, :2], box[:, 2:]) + rule.tolerance
    side = max(1.0, float(np.median(high - low)) * 2)
    cells = np.floor(np.hstack([low, high]) / side)
    many = (cells[:, 2] - cells[:, 0] + 1) * (cells[:, 3] - cells[:, 1] + 1) > WIDE
    cells = np.where(many[:, None], 0, cells).astype(np.int64)
    if not many.any() and (edges := _edges(rule, box, conf, areas, order, cells)) is not None:
        alive = np.ones(len(box), bool)
        hi, lo = edges
        starts = np.flatnonzero(np.r_[True, hi[1:] != hi[:-1]]) if len(hi) else np.zeros(0, np.int64)
        for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(hi)], strict=False):
            if alive[hi[first]]:
                alive[lo[first:last]] = False
        return order[alive[order]]
    return _visit(rule, box, conf, areas, order, cells, many)


def _edges(rule: Rule, box: np.ndarray, conf: np.ndarray, areas: np.ndarray, order: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Conflicts as (earlier, later) rows, by the earlier's turn; None where there are too many pairs."""
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    width, height = cells[:, 2] - cells[:, 0] + 1, cells[:, 3] - cells[:, 1] + 1
    row = np.repeat(np.arange(len(box)), width * height)
    k = np.arange(len(row)) - np.repeat(np.cumsum(width * height) - width * height, width * height)
    cx, cy = cells[row, 0] + k % width[row], cells[row, 1] + k // width[row]
    turn = np.lexsort((rank[row], cy, cx))
    row, cx, cy = row[turn], cx[turn], cy[turn]
    new = np.r_[True, (cx[1:] != cx[:-1]) | (cy[1:] != cy[:-1])]
    end = np.append(np.flatnonzero(new)[1:], len(row))[np.cumsum(new) - 1]
    later = end - 1 - np.arange(len(row))  # entries of the same cell that come later
    total = np.cumsum(later)
    if total[-1] > PAIRS:
        return None
    found = []
    at = 0
    while at < len(row):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, side="right")))
        left = np.repeat(np.arange(at, stop), later[at:stop])
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(later[at:stop]) - later[at:stop], later[at:stop])
        a, b = row[left], row[right]
        # A pair that shares several cells counts in the first of them only.
        once = (cx[left] == np.maximum(cells[a, 0], cells[b, 0])) & (cy[left] == np.maximum(cells[a, 1], cells[b, 1]))
        a, b = a[once], b[once]
        hit = _conflicts(rule, box[b], conf[b], areas[b], box[a], conf[a], areas[a])
        found.append((a[hit], b[hit]))
        at = stop
    hi, lo = (np.concatenate(x) for x in zip(*found, strict=True))
    turn = np.argsort(rank[hi], kind="stable")
    return hi[turn], lo[turn]


def _visit(rule: Rule, box: np.ndarray, conf: np.ndarray, areas: np.ndarray, order: np.ndarray, cells: np.ndarray, many: np.ndarray) -> np.ndarray:
    by_cell: dict[tuple[int, int], list[int]] = {}
    wide: list[int] = []
    kept: list[int] = []
    for i in order.tolist():
        if many[i]:
            near = kept
        else:
            x1, y1, x2, y2 = cells[i].tolist()
            places = [(x, y) for x in range(x1, x2 + 1) for y in range(y1, y2 + 1)]
            near = list({k for p in places for k in by_cell.get(p, ())}) + wide
        if near:
            n = np.array(near)
            if _conflicts(rule, box[i], conf[i], areas[i], box[n], conf[n], areas[n]).any():
                continue
        kept.append(i)
        if many[i]:
            wide.append(i)
        else:
            for p in places:
                by_cell.setdefault(p, []).append(i)
    return np.array(kept, np.int64)


def _by_group(df: DataFrame, rule: Rule, keys: Sequence[str], id_col: str) -> DataFrame:
    def run(pdf):
        rows = kept_indices(rule, pdf[["x1", "y1", "x2", "y2"]].to_numpy(), pdf["conf"].to_numpy(dtype=float), pdf[id_col].to_numpy())
        return pdf.iloc[rows]

    return df.groupBy(*keys).applyInPandas(run, df.schema)


# --- pairs of conflicting boxes ----------------------------------------------------------------


def _order_key(rule: Rule, box: bx.Box, conf: Column, ident: Column) -> Column:
    """A struct that sorts ascending in visiting order."""
    if rule.by_area:
        return F.struct((-_area_of(rule, box)).alias("a"), (-conf).alias("s"), ident.alias("i"))
    return F.struct((-conf).alias("s"), (-ident).alias("i"))


def _score(conf: Column) -> Column:
    """The confidence as a double, a NaN as the lowest."""
    return F.when(F.isnan(conf.cast("double")), F.lit(float("-inf"))).otherwise(conf.cast("double"))


def _area_of(rule: Rule, box: bx.Box) -> Column:
    return bx.area_floored(box) if rule.ordered else bx.area_eps(box) if rule.by_area else bx.area(box)


def conflict(rule: Rule, kept: bx.Box, kept_conf: Column, box: bx.Box, conf: Column) -> Column:
    """Whether ``kept`` rules out ``box``, as an expression."""
    if rule.iou is not None:
        share = bx.iou_export(kept, box) if rule.ordered else bx.iou_merge(kept, box)
        return share >= F.lit(rule.iou) if rule.inclusive else share > F.lit(rule.iou)
    covered = bx.coverage_export(box, kept) if rule.ordered else bx.coverage_merge(box, kept)
    hit = bx.nearly_inside(box, kept, rule.tolerance) | (covered >= F.lit(rule.coverage))
    if rule.margin is not None:
        hit = hit & (conf <= kept_conf + F.lit(float(rule.margin)))
    return hit


def conflict_edges(df: DataFrame, rule: Rule, keys: Sequence[str], id_col: str) -> DataFrame:
    """``(<keys>, hi, lo, hi_x, hi_y, lo_x, lo_y, o1, o2, o3)``: pairs in which ``hi``, were it kept, would rule out the later ``lo``.

    Candidates come from grids of cells, each level's four times as wide as that of the level before,
    and an equi-join on keys, level and cell. A box has the level whose cells are as wide as itself or
    wider, so it meets four of them at most; there it is compared with the boxes of its own and of
    smaller levels, which are listed at all levels above theirs that some box has. So one very wide
    box costs a row for each other box and no more. A pair that shares several cells is made in the
    first of them only. Also given: the boxes' middles and ``lo``'s visiting order (o1, then o2, then o3).
    """
    box = bx.ordered(bx.Box.of()) if rule.ordered else bx.Box.of()
    tol = F.lit(float(rule.tolerance))
    outer = bx.ordered(bx.Box.of())
    flat = df.select(*keys, F.col(id_col).alias("id"), _score(F.col("conf")).alias("conf"), *box.columns(), (outer.x1 - tol).alias("_l"), (outer.y1 - tol).alias("_t"), (outer.x2 + tol).alias("_r"), (outer.y2 + tol).alias("_b"))
    flat = flat.withColumn("o", _order_key(rule, bx.Box.of(), F.col("conf"), F.col("id")))
    listed, side = grid_listed(flat, ("_l", "_t", "_r", "_b"))
    # As plain columns, since pairs compare these more than anything else.
    turns = ["o1", "o2", "o3"]
    listed = listed.withColumns(dict(zip(turns, (F.col("o.a") if rule.by_area else F.lit(0.0), F.col("o.s"), F.col("o.i")), strict=True))).drop("o")
    name = lambda p, d: d.select(*(F.col(c).alias(f"{p}{c}") for c in d.columns))
    a, b = name("a_", listed.filter("own")), name("b_", listed)
    x, y = ([F.col(f"{p}_{c}") for c in turns] for p in "ab")
    earlier = (x[0] < y[0]) | ((x[0] == y[0]) & ((x[1] < y[1]) | ((x[1] == y[1]) & (x[2] < y[2]))))
    same = [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys]
    first = (F.col("a_cx") == F.greatest("a_cl", "b_cl")) & (F.col("a_cy") == F.greatest("a_ct", "b_ct"))
    # Two boxes of one level meet as (a, b) and as (b, a).
    once = ~F.col("b_own") | earlier
    pairs = a.join(b, [*same, F.col("a_level") == F.col("b_level"), F.col("a_cx") == F.col("b_cx"), F.col("a_cy") == F.col("b_cy"), F.col("a_id") != F.col("b_id"), once, first])
    rules_out = lambda x, y: conflict(rule, bx.Box.of(f"{x}_"), F.col(f"{x}_conf"), bx.Box.of(f"{y}_"), F.col(f"{y}_conf"))
    pairs = pairs.filter(F.when(earlier, rules_out("a", "b")).otherwise(rules_out("b", "a")))
    hi = lambda c: F.when(earlier, c("a")).otherwise(c("b"))
    lo = lambda c: F.when(earlier, c("b")).otherwise(c("a"))
    middle = lambda n: lambda p: (F.col(f"{p}_{n}1") + F.col(f"{p}_{n}2")) / 2 / F.lit(side)
    named = {"hi": hi(lambda p: F.col(f"{p}_id")), "lo": lo(lambda p: F.col(f"{p}_id"))}
    named |= {"hi_x": hi(middle("x")), "hi_y": hi(middle("y")), "lo_x": lo(middle("x")), "lo_y": lo(middle("y"))}
    named |= {c: lo(lambda p, c=c: F.col(f"{p}_{c}")) for c in turns}
    return pairs.select(*(F.col(f"a_{k}").alias(k) for k in keys), *(c.alias(n) for n, c in named.items()))


def grid_listed(df: DataFrame, edges: Sequence[str], side: float | None = None, levels: list[int] | None = None) -> tuple[DataFrame, float]:
    """``df`` once for each level and cell of its boxes (columns ``edges``: left, top, right, bottom), and the side of level 0.

    Added: ``level``, ``own`` (whether it is the box's own level), ``cx, cy`` (the cell) and ``cl, ct``
    (the box's first cell). Level 0 holds boxes up to ``side`` (None: about the length that 99 in 100
    stay under); ``levels``: those to list boxes at (None: all that some box has).
    """
    left, top, right, bottom = map(F.col, edges)
    span = F.greatest(right - left, bottom - top)
    if side is None:
        usual, most = df.agg(F.percentile_approx(span, 0.99), F.max(span)).first()
        # Where no box is much wider than that, one level holds them all.
        side = max(1.0, float((most if most <= 2 * usual else usual) if usual else 1.0))
    own = F.greatest(F.ceil(F.log2(F.greatest(span, F.lit(1.0)) / side) / 2), F.lit(0)).cast("int")
    df = df.withColumn("_own", own)
    # Levels differ by a factor of four: no table of doubles has more than some hundreds.
    if levels is None:
        levels = sorted(r[0] for r in df.select("_own").distinct().collect())
    out = df.withColumn("level", F.explode(F.filter(F.array(*map(F.lit, levels)), lambda n: n >= F.col("_own"))) if levels else F.lit(0))
    cell = lambda c: F.floor(c / (F.lit(side) * F.pow(F.lit(4.0), F.col("level"))))
    out = out.withColumns({"own": F.col("level") == F.col("_own"), "cl": cell(left), "ct": cell(top), "cr": cell(right), "cb": cell(bottom)})
    out = out.withColumn("cx", F.explode(F.sequence("cl", "cr"))).withColumn("cy", F.explode(F.sequence("ct", "cb")))
    return out.drop("_own", "cr", "cb", *edges), side


def _settled_inside(pdf):
    """Boxes of one region that its conflicts decide, visited in order; a box of another region is open."""
    ids, inverse = np.unique(np.concatenate([pdf["lo"].to_numpy(), pdf["hi"].to_numpy()]), return_inverse=True)
    lo, hi = inverse[: len(pdf)], inverse[len(pdf) :]
    kept, gone, open_ = 1, 2, 0
    state = np.full(len(ids), open_, np.int8)
    # A box of this region that no conflict here can drop has none left anywhere.
    first = np.zeros(len(ids), bool)
    first[hi[pdf["inside"].to_numpy()]] = True
    first[lo] = False
    state[first] = kept
    order = np.lexsort(tuple(pdf[c].to_numpy() for c in ("o3", "o2", "o1")))
    lo, hi = lo[order], hi[order]
    starts = np.flatnonzero(np.r_[True, lo[1:] != lo[:-1]])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(lo)], strict=True):
        above = state[hi[a:b]]
        if (above == kept).any():
            state[lo[a]] = gone
        elif (above == gone).all():
            state[lo[a]] = kept
    some = np.flatnonzero(state != open_)
    return ids[some], state[some] == kept


def region(x: Column, y: Column, turn: int, size: float) -> Column:
    """The square of ``size`` a point lies in; squares move by half a side from turn to turn."""
    dx, dy = ((0, 0), (size / 2, size / 2), (size / 2, 0), (0, size / 2))[turn % 4]
    return F.struct(F.floor((x + dx) / size).alias("x"), F.floor((y + dy) / size).alias("y"))


def _without_copies(df: DataFrame, rule: Rule, keys: Sequence[str], id_col: str) -> DataFrame:
    """Of boxes with equal corners only the one visited first, so that a pile of copies makes no pairs.

    It rules the others out if it stays, and whatever rules it out does the same to them. Not so where
    a box does not rule out its own copy: where it has hardly any area, or the rule asks for more.
    """
    if (rule.margin or 0) < 0 or (rule.iou or 0) > 0.999:
        return df
    box = bx.ordered(bx.Box.of()) if rule.ordered else bx.Box.of()
    sound = bx.area(box) > 1e-3
    corners = ["x1", "y1", "x2", "y2"]
    flat = df.filter(sound)
    first = flat.groupBy(*keys, *corners).agg(F.min(_order_key(rule, box, _score(F.col("conf")), F.col(id_col))).alias("o"))
    first = first.select(*(F.col(c).alias(f"_{c}") for c in (*keys, *corners)), (F.col("o.i") if rule.by_area else -F.col("o.i")).alias("_first"))
    same = [*(flat[k].eqNullSafe(first[f"_{k}"]) for k in keys), *(flat[c] == first[f"_{c}"] for c in corners), flat[id_col] == first["_first"]]
    return flat.join(first, same, "left_semi").unionByName(df.filter(~sound))


def _by_graph(df: DataFrame, rule: Rule, keys: Sequence[str], id_col: str) -> DataFrame:
    """Rounds on the conflict graph; the result is that of the sequential visit.

    A round deals conflicts to regions of the plane by their later box. Each region, in one task,
    decides all boxes whose conflicts lead back to boxes decided there; regions with more than
    REGION_PAIRS conflicts are left to the second step, which keeps every box with no undecided
    conflict above it and drops those below. Regions move from round to round, so what crosses a
    border is inside soon. Each round is written to shared storage; only counts reach the driver.
    """
    df = write_through(_without_copies(df, rule, keys, id_col), "boxes")
    edges = write_through(conflict_edges(df, rule, keys, id_col), "conflicts")
    kind = df.schema[id_col].dataType
    on = lambda x, y, end: [*(x[k].eqNullSafe(y[k]) for k in keys), x[end] == y["node"]]
    decided = T.StructType([*(df.schema[k] for k in keys), T.StructField("node", kind), T.StructField("kept", T.BooleanType())])

    def inside(pdf):
        nodes, kept = _settled_inside(pdf)
        out = {k: pdf[k].iloc[0] for k in keys} | {"node": nodes, "kept": kept}
        return pd.DataFrame(out, columns=decided.names, index=range(len(nodes)))

    dropped = []
    step = 0
    while not edges.isEmpty():
        at = region(F.col("lo_x"), F.col("lo_y"), step, REGION)
        dealt = edges.withColumns({"_at": at, "inside": region(F.col("hi_x"), F.col("hi_y"), step, REGION) == at})
        crowded = dealt.groupBy(*keys, "_at").agg(F.count("*").alias("_n")).filter(F.col("_n") > REGION_PAIRS)
        if not crowded.isEmpty():
            # Fewer regions than conflicts / REGION_PAIRS.
            crowded = crowded.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_at").alias("_crowd"))
            dealt = dealt.join(crowded, [*(dealt[k].eqNullSafe(crowded[f"_{k}"]) for k in keys), dealt["_at"] == crowded["_crowd"]], "left_anti")
        found = write_through(dealt.groupBy(*keys, "_at").applyInPandas(inside, decided), "decided")
        rest = edges.join(found, on(edges, found, "lo"), "left_anti")
        # What is left stands below boxes kept, dropped or open; a box with nothing above it is kept too.
        above = found.select(*(F.col(k).alias(f"_{k}") for k in keys), "node", "kept")
        rest = rest.join(above, [*(rest[k].eqNullSafe(above[f"_{k}"]) for k in keys), rest["hi"] == above["node"]], "left").filter("kept IS NULL OR kept")
        rest = write_through(rest.select(*edges.columns, "kept"), "rest")
        below = rest.select(*keys, F.col("lo").alias("node")).distinct()
        heads = rest.filter("kept IS NULL").select(*keys, F.col("hi").alias("node")).distinct()
        heads = heads.join(below, [*(heads[k].eqNullSafe(below[k]) for k in keys), heads["node"] == below["node"]], "left_anti")
        under = rest.join(heads, on(rest, heads, "hi"), "left_semi").unionByName(rest.filter("kept"))
        gone = write_through(under.select(*keys, F.col("lo").alias("node")).distinct(), "dropped")
        dropped += [found.filter("NOT kept").drop("kept"), gone]
        rest = rest.filter("kept IS NULL").drop("kept")
        rest = rest.join(gone, on(rest, gone, "lo"), "left_anti")
        edges = write_through(rest.join(gone, on(rest, gone, "hi"), "left_anti"), "conflicts")
        step += 1
    if not dropped:
        return df
    every = dropped[0]
    for more in dropped[1:]:
        every = every.unionByName(more)
    return df.join(every, [*(df[k].eqNullSafe(every[k]) for k in keys), df[id_col] == every["node"]], "left_anti")


# --- expressions only --------------------------------------------------------------------------


def _by_fold(df: DataFrame, rule: Rule, keys: Sequence[str], id_col: str) -> DataFrame:
    """Each small group as one sorted array, folded into the array of kept boxes."""
    box = bx.ordered(bx.Box.of()) if rule.ordered else bx.Box.of()
    row = F.struct(_order_key(rule, box, _score(F.col("conf")), F.col(id_col)).alias("o"), *box.columns(), _score(F.col("conf")).alias("conf"), F.struct(*(F.col(c) for c in df.columns)).alias("row"))
    groups = df.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("boxes"))
    part = lambda s: bx.Box(s["x1"], s["y1"], s["x2"], s["y2"])
    start = F.filter("boxes", lambda _: F.lit(False))
    kept = F.aggregate("boxes", start, lambda acc, b: F.when(F.exists(acc, lambda k: conflict(rule, part(k), k["conf"], part(b), b["conf"])), acc).otherwise(F.concat(acc, F.array(b))))
    return groups.select(F.explode(kept).alias("k")).select("k.row.*")


def top_k(df: DataFrame, k: int = 300, keys: Sequence[str] = ("tile",), id_col: str = "det_id") -> DataFrame:
    """The ``k`` most confident rows of each group, ties to the smaller id."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("conf"), id_col))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")
