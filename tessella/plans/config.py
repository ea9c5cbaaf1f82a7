"""A run's configuration: a table of settings with their rules, read from YAML."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from types import SimpleNamespace
from typing import Any

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class Setting:
    """One setting: its type, what it is if absent (REQUIRED: an error), and what holds for it."""

    kind: type
    default: Any
    holds: Callable[[Any], bool] = lambda _: True
    rule: str = ""


REQUIRED = object()
_share = (lambda v: 0 <= v <= 1, "from 0 to 1")
_amount = (lambda v: v >= 0, "not negative")

# The names of the settings, their defaults and their bounds.
SETTINGS: dict[str, dict[str, Setting]] = {
    "inputs": {"id": Setting(str, REQUIRED), "raster": Setting(str, REQUIRED), "masks_gpkg": Setting(str, REQUIRED), "masks_layer": Setting(str, "")},
    "bands": {"ms": Setting(list, ()), "rgb": Setting(list, ())},
    "tiling": {
        "use_ground_size": Setting(bool, False), "tile_size_m": Setting(float, 0.0, *_amount), "tile_size_px": Setting(int, 512, lambda v: v > 0 and v % 32 == 0, "a positive multiple of 32"),
        "stride_frac": Setting(float, 0.75, lambda v: 0 < v <= 1, "above 0 and at most 1"), "overlap_fraction": Setting(float, None, *_share),
    },
    "labels": {
        "min_area_fraction": Setting(float, 0.25, *_amount), "min_bbox_px": Setting(int, 4, *_amount), "class_name": Setting(str, "circle"), "object_class": Setting(str, "circle"), "class_id": Setting(int, 0),
        "min_width_m": Setting(float, 0.0, *_amount), "min_height_m": Setting(float, 0.0, *_amount), "buffer_m": Setting(float, 0.0, *_amount),
    },
    "split": {
        "train": Setting(float, 0.7, *_share), "val": Setting(float, 0.2, *_share), "test": Setting(float, 0.1, *_share), "strategy": Setting(str, "block"), "seed": Setting(int, 42),
        "block_tiles": Setting(int, 4, lambda v: v > 0, "above 0"),
    },
}


def _value(place: str, setting: Setting, given: dict[str, Any], name: str) -> Any:
    if given.get(name) is None:
        if setting.default is REQUIRED:
            raise ValueError(f"{place}.{name} is missing")
        return setting.default
    raw = given[name]
    if setting.kind is list:
        if not isinstance(raw, list) or not all(isinstance(x, int) for x in raw):
            raise ValueError(f"{place}.{name} must be a list of whole numbers")
        return list(raw)
    if isinstance(raw, bool) != (setting.kind is bool) or (setting.kind is str) != isinstance(raw, str):
        raise ValueError(f"{place}.{name} must be of type {setting.kind.__name__}")
    value = setting.kind(raw)
    if value != raw or not setting.holds(value):
        raise ValueError(f"{place}.{name} must be {setting.rule or setting.kind.__name__} (got {raw})")
    return value


def _section(place: str, given: Any, settings: dict[str, Setting]) -> SimpleNamespace:
    if given is not None and not isinstance(given, dict):
        raise ValueError(f"{place} must be a mapping")
    return SimpleNamespace(**{n: _value(place, s, given or {}, n) for n, s in settings.items()})


def _split(given: Any) -> SimpleNamespace:
    """Ratios may stand under ``ratios``, where an absent one is 0, or beside the other settings."""
    given = dict(given or {})
    ratios = given.pop("ratios", None)
    if ratios:
        if strange := set(ratios) - set(SPLITS):
            raise ValueError(f"split.ratios: no such split: {sorted(strange)}")
        given |= {n: ratios.get(n, 0.0) for n in SPLITS}
    split = _section("split", given, SETTINGS["split"])
    split.ratios = {n: getattr(split, n) for n in SPLITS}
    if abs(sum(split.ratios.values()) - 1) > 0.001:
        raise ValueError(f"the split's ratios add up to {sum(split.ratios.values()):.3f}, not to 1")
    return split


@dataclass
class PipelineConfig:
    """A checked configuration; sections hold their settings as attributes."""

    run_id: str
    inputs: list[SimpleNamespace]
    bands: SimpleNamespace
    tiling: SimpleNamespace
    labels: SimpleNamespace
    split: SimpleNamespace = field(default_factory=lambda: _split(None))

    def chosen(self, input_id: str | None) -> list[SimpleNamespace]:
        """All inputs, or the one named; an error if there is none of that name."""
        found = [i for i in self.inputs if not input_id or i.id == input_id]
        if not found:
            raise ValueError(f"no input with id {input_id}")
        return found


def validate_config(cfg: dict[str, Any]) -> PipelineConfig:
    """The configuration with all settings in place; a ValueError names the first that breaks its rule.

    Settings of other names are ignored.
    """
    if not isinstance(cfg, dict) or not isinstance(cfg.get("run_id"), str):
        raise ValueError("run_id must be a text")
    inputs = cfg.get("inputs")
    if not isinstance(inputs, list) or not inputs:
        raise ValueError("inputs must name one raster at least")
    sections = {n: _section(n, cfg.get(n), SETTINGS[n]) for n in ("bands", "tiling", "labels")}
    return PipelineConfig(cfg["run_id"], [_section(f"inputs[{k}]", x, SETTINGS["inputs"]) for k, x in enumerate(inputs)], **sections, split=_split(cfg.get("split")))


def load_config(path: str | Path, validate: bool = False) -> dict[str, Any] | PipelineConfig:
    """The YAML document, or with ``validate`` the checked configuration; a ValueError if it is no YAML."""
    import yaml

    with open(path, encoding="utf-8") as file:
        try:
            document = yaml.safe_load(file)
        except yaml.YAMLError as fault:
            raise ValueError(f"{path} is no YAML document") from fault
    return validate_config(document) if validate else document


def resolve_path(root: str | Path, p: str | Path) -> Path:
    """Absolute paths as they are, others under ``root`` without dots."""
    return Path(p) if os.path.isabs(p) else Path(os.path.abspath(os.path.join(root, p)))


def checked_tile_size(meta: dict[str, Any], default: int = 512) -> int:
    """A dataset's tile side, between 64 and 2048; ``default`` if it has none."""
    size = int(meta.get("tile_size", default))
    if not 64 <= size <= 2048:
        raise ValueError(f"tile_size {size} is not between 64 and 2048")
    return size


def model_size(weights: str) -> str:
    """What follows a model family's name and number in the name of its weights file: ``s`` of ``net11s.pt``."""
    return re.sub(r"^[a-z]+\d+", "", Path(weights).name.removesuffix(".pt"))
