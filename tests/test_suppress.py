"""Each rule and strategy against a sequential model, on literal and random boxes."""

import numpy as np
import pytest

from tessella.operators import suppress as sp

BOXES = [(12, 8, 48, 52, 0.85), (28, 26, 62, 69, 0.75), (103, 97, 152, 149, 0.92), (106, 101, 146, 144, 0.66)]
RULES = [sp.nms(0.3), sp.nested(0.85, 3, 0), sp.nested(0.8, 2, 0.2), sp.cut_boxes(0.9, 3), sp.duplicates(0.5)]


def model(rule, rows):
    """Visit one by one; rows are (x1, y1, x2, y2, conf, id)."""

    def norm(b):
        return (min(b[0], b[2]), min(b[1], b[3]), max(b[0], b[2]), max(b[1], b[3])) if rule.ordered else b[:4]

    def area(b):
        b = norm(b)
        w, h = b[2] - b[0], b[3] - b[1]
        return max(w * h, 1e-9) if rule.ordered else max(w, 0) * max(h, 0) + (1e-9 if rule.by_area else 0)

    score = lambda b: -np.inf if np.isnan(b[4]) else b[4]
    order = sorted(rows, key=lambda b: (-area(b), -score(b), b[5]) if rule.by_area else (-score(b), -b[5]))
    kept = []
    for c in order:
        for k in kept:
            a, b = norm(k), norm(c)
            inter = max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
            if rule.iou is not None:
                union = area(k) + area(c) - inter
                iou = inter / (max(union, 1e-9) if rule.ordered else union + 1e-9)
                hit = iou >= rule.iou if rule.inclusive else iou > rule.iou
            else:
                t = rule.tolerance
                hit = (b[0] >= a[0] - t and b[1] >= a[1] - t and b[2] <= a[2] + t and b[3] <= a[3] + t) or inter / area(c) >= rule.coverage
                if rule.margin is not None:
                    hit = hit and score(c) <= score(k) + rule.margin
            if hit:
                break
        else:
            kept.append(c)
    return [k[5] for k in kept]


def frame(spark, rows, group=0):
    return spark.createDataFrame([("a", group, *map(float, r[:5]), i if len(r) < 6 else r[5]) for i, r in enumerate(rows)], "image_id string, class_id int, x1 double, y1 double, x2 double, y2 double, conf double, det_id long")


def test_known_order():
    b = np.array(BOXES)
    for rule in (sp.nms(0.3), sp.nested(0.8, 3, 0)):
        assert sp.kept_indices(rule, b[:, :4], b[:, 4], np.arange(4)).tolist() == [2, 0, 1]


@pytest.mark.parametrize("rows, kept", [([], []), (BOXES[:1], [0]), ([(7, 9, 41, 38, 0.25), (11, 12, 44, 43, 0.5)], [1]), ([(0, 0, 9, 9, 0.5), (21, 19, 33, 30, 0.375), (44, 2, 52, 11, 0.25)], [0, 1, 2])])
def test_small_cases(rows, kept):
    b = np.array(rows, float).reshape(-1, 5)
    assert sp.kept_indices(sp.nms(0.3), b[:, :4], b[:, 4], np.arange(len(b))).tolist() == kept


def test_threshold_itself():
    # Half of two equal squares overlaps: the union is three quarters, so the ratio is a third of them.
    b = np.array([[0, 0, 4, 2, 0.9], [0, 0, 4, 1, 0.8]], float)
    assert len(sp.kept_indices(sp.duplicates(0.5), b[:, :4], b[:, 4], np.arange(2))) == 1
    assert len(sp.kept_indices(sp.nms(0.5), b[:, :4], b[:, 4], np.arange(2))) == 2


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"{r.name}{r.coverage or r.iou}")
@pytest.mark.parametrize("limits", [(10**8, 10**5), (10**8, 7), (0, 1)])
def test_kernel_equals_model(rule, limits, monkeypatch):
    """In blocks, in tiny blocks and one by one; with and without very large boxes."""
    monkeypatch.setattr(sp, "PAIRS", limits[0])
    monkeypatch.setattr(sp, "BLOCK", limits[1])
    rng = np.random.default_rng(3)
    for n in (1, 7, 60, 250):
        xy = rng.integers(0, 120, (n, 2))
        wh = rng.integers(0, 40, (n, 2))
        if n > 100:
            wh[: n // 20] = 300
        box = np.hstack([xy, xy + wh]).astype(float)
        if rule.ordered:
            flip = rng.random(n) < 0.2
            box[flip] = box[flip][:, [2, 1, 0, 3]]
        conf = rng.integers(0, 6, n) / 5
        if not rule.by_area:
            conf[rng.random(n) < 0.05] = np.nan
        rows = [(*b, c, i) for i, (b, c) in enumerate(zip(box.tolist(), conf, strict=True))]
        assert sp.kept_indices(rule, box, conf, np.arange(n)).tolist() == model(rule, rows)


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"{r.name}{r.coverage or r.iou}")
def test_strategies_agree(spark, rule):
    rng = np.random.default_rng(4)
    xy = rng.integers(0, 60, (90, 2))
    box = np.hstack([xy, xy + rng.integers(1, 30, (90, 2))])
    rows = [(*b, c / 8) for b, c in zip(box.tolist(), rng.integers(0, 8, 90).tolist(), strict=True)]
    df = frame(spark, rows)
    want = sorted(model(rule, [(*r, i) for i, r in enumerate(rows)]))
    for strategy in ("pandas", "graph", "fold", "auto"):
        assert sorted(r.det_id for r in sp.suppress(df, rule, strategy=strategy).collect()) == want, strategy


def test_large_groups_go_by_the_graph(spark, monkeypatch):
    monkeypatch.setattr(sp, "GROUP_LIMIT", 3)
    df = frame(spark, BOXES).unionByName(frame(spark, [(0, 0, 5, 5, 0.5)], group=1))
    assert sorted((r.class_id, r.det_id) for r in sp.suppress(df, sp.nms(0.3)).collect()) == [(0, 0), (0, 1), (0, 2), (1, 0)]


def test_empty_and_null(spark):
    df = frame(spark, [(0, 0, 1, 1, 0.5)])
    assert sp.suppress(df.limit(0), sp.nms()).count() == 0
    nulls = spark.createDataFrame([("a", 0, None, 0.0, 1.0, 1.0, 0.5, 7)], df.schema)
    assert [r.det_id for r in sp.suppress(df.unionByName(nulls), sp.nms()).collect()] == [0]


@pytest.mark.parametrize("rule", [sp.nms(0.3), sp.nested(0.85, 3, 0)], ids=lambda r: r.name)
def test_graph_with_wide_boxes_and_nan(spark, rule):
    """One box of 10^9 pixels, some wide ones and unknown confidences; chains across many regions."""
    rng = np.random.default_rng(5)
    xy = rng.integers(0, 9000, (400, 2))
    box = np.hstack([xy, xy + rng.integers(20, 120, (400, 2))]).astype(float)
    box[:3] = [[-1e9, -1e9, 1e9, 1e9], [0, 0, 5000, 5000], [100, 100, 4900, 5100]]
    chain = np.array([[40.0 * k, 9500, 40.0 * k + 100, 9600] for k in range(200)])
    box = np.vstack([box, chain])
    conf = rng.integers(0, 6, 600) / 5
    conf[400:] = 1 - np.arange(200) / 1000
    conf[rng.random(600) < 0.03] = np.nan
    rows = [(*b, c) for b, c in zip(box.tolist(), conf.tolist(), strict=True)]
    want = sorted(model(rule, [(*r, i) for i, r in enumerate(rows)]))
    for strategy in ("pandas", "graph"):
        assert sorted(r.det_id for r in sp.suppress(frame(spark, rows), rule, strategy=strategy).collect()) == want, strategy


def test_crowded_regions_go_step_by_step(spark, monkeypatch):
    monkeypatch.setattr(sp, "REGION_PAIRS", 20)
    rng = np.random.default_rng(6)
    xy = rng.integers(0, 60, (90, 2))
    box = np.hstack([xy, xy + rng.integers(1, 30, (90, 2))])
    rows = [(*b, c / 8) for b, c in zip(box.tolist(), rng.integers(0, 8, 90).tolist(), strict=True)]
    want = sorted(model(sp.nms(0.3), [(*r, i) for i, r in enumerate(rows)]))
    assert sorted(r.det_id for r in sp.suppress(frame(spark, rows), sp.nms(0.3), strategy="graph").collect()) == want


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"{r.name}{r.coverage or r.iou}")
def test_piles_of_copies(spark, rule):
    """Thousands of equal boxes, some without area, are no pairs to the graph."""
    rng = np.random.default_rng(7)
    kinds = np.array([[0, 0, 20, 20], [1, 1, 21, 21], [5, 5, 5, 9], [0, 0, 30, 30], [100, 100, 120, 130]], float)
    rows = [(*kinds[k], c / 8) for k, c in zip(rng.integers(0, 5, 60).tolist(), rng.integers(0, 8, 60).tolist(), strict=True)]
    want = sorted(model(rule, [(*r, i) for i, r in enumerate(rows)]))
    assert sorted(r.det_id for r in sp.suppress(frame(spark, rows), rule, strategy="graph").collect()) == want


def test_a_large_pile(spark):
    from pyspark.sql import functions as F

    df = spark.range(100_000).select(F.lit("a").alias("image_id"), F.lit(0).alias("class_id"), *(F.lit(v).alias(n) for n, v in (("x1", 0.0), ("y1", 0.0), ("x2", 9.0), ("y2", 9.0))), (F.col("id") % 100 / 100).alias("conf"), F.col("id").alias("det_id"))
    assert [r.det_id for r in sp.suppress(df, sp.nms(0.3), strategy="graph").collect()] == [99_999]
