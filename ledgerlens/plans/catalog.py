"""All registered queries (importing the family modules fills the registry)."""

from __future__ import annotations

import importlib

from .registry import REGISTRY, Entry

_FAMILIES = [
    "cat_compare",
    "cat_aggs",
    "cat_windows",
    "cat_scalars",
    "cat_joins",
    "cat_sources",
    "cat_stream",
]


def load() -> dict[str, Entry]:
    for m in _FAMILIES:
        importlib.import_module(f"{__package__}.{m}")
    return REGISTRY
