"""A pluggable scorer over tiles: one call per tile in each worker, errors kept as rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..functions.naming import parse_tile
from ..schema import SCORED

#: Makes a scorer, once per worker; the scorer turns a tile's bytes or pixels into rows
#: (x1, y1, x2, y2, conf, class_id) in tile pixels.
ScorerFactory = Callable[[], Callable[[object], list[tuple[float, float, float, float, float, int]]]]


def score_tiles(tiles: DataFrame, factory: ScorerFactory, stride: int, conf: float = 0.25, max_det: int = 300, tile: str = "tile", content: str = "content") -> DataFrame:
    """Boxes of every tile, in pixels of the whole image, with ``status``.

    Statuses: "ok" (a row per box, or one without a box), "bad_name", "failed_read" (null content)
    and "failed_infer" (the scorer raised). Only boxes of ``conf`` or more count, the ``max_det`` most
    confident of a tile.
    """
    import pandas as pd

    names = parse_tile(F.col(tile))
    named = tiles.select(F.col(tile).alias("tile"), names["tile_r"].alias("tile_r"), names["tile_c"].alias("tile_c"), F.col(content).alias("content"))

    def run(batches):
        scorer = factory()
        for pdf in batches:
            out = []
            for name, r, c, data in zip(pdf["tile"], pdf["tile_r"], pdf["tile_c"], pdf["content"], strict=True):
                empty = (None,) * 6
                if pd.isna(r) or pd.isna(c):
                    out.append((name, None, None, *empty, "bad_name"))
                elif data is None:
                    out.append((name, int(r), int(c), *empty, "failed_read"))
                else:
                    try:
                        found = [b for b in scorer(data) if b[4] >= conf]
                    except Exception:  # a tile that cannot be scored must not end the job
                        out.append((name, int(r), int(c), *empty, "failed_infer"))
                        continue
                    found.sort(key=lambda b: -b[4])
                    out += [(name, int(r), int(c), *map(float, b[:5]), int(b[5]), "ok") for b in found[:max_det]] or [(name, int(r), int(c), *empty, "ok")]
            made = pd.DataFrame(out, columns=SCORED.names)
            for c in ("tile_r", "tile_c", "class_id"):
                made[c] = made[c].astype("Int32")
            yield made

    scored = named.mapInPandas(run, SCORED)
    moved = bx.to_image(bx.Box.of(), F.col("tile_r"), F.col("tile_c"), stride)
    return scored.withColumns(dict(zip(("x1", "y1", "x2", "y2"), moved, strict=True)))
