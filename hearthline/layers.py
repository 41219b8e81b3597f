"""Where tables live: a root directory or a catalog, three layers, no fixed names in the operators."""

from __future__ import annotations

from dataclasses import dataclass

from hearthline.schemas import LAYER_TABLES


@dataclass(frozen=True)
class Layers:
    root: str | None = None
    catalog: str | None = None

    def __post_init__(self) -> None:
        if (self.root is None) == (self.catalog is None):
            raise ValueError("give either a root directory or a catalog")

    def name(self, table: str) -> str:
        """Path or three-part name of a table, whose layer follows from the declared schemas."""
        layer = next((layer for layer, tables in LAYER_TABLES.items() if table in tables), None)
        if layer is None:
            raise KeyError(f"unknown table {table!r}")
        return f"{self.root}/{layer}/{table}" if self.root else f"{self.catalog}.{layer}.{table}"
