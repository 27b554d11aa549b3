"""Cutting lineage in the folder that all executors share: the library's own helpers."""

from ebbline.sources.shared import cut, drop, scratch, shared_folder

__all__ = ["cut", "drop", "scratch", "shared_folder"]
