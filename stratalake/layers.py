"""Layer roots and the paths under them."""

from __future__ import annotations

from collections.abc import Mapping

BATCH_COLUMN = "DT_IMPORT"

Layers = Mapping[str, "str | Mapping[str, str]"]


def layer_path(layers: Layers, layer: str, path: str) -> str:
    """Join a dataset path to the root of ``layer``.

    A layer is given as its root, or as ``{"path": root}``.
    """
    if layer not in layers:
        raise ValueError(f"no such layer: {layer!r}, have {sorted(layers)}")
    entry = layers[layer]
    root = entry if isinstance(entry, str) else entry["path"]
    return root + path if root.endswith("/") else f"{root}/{path}"
