"""Named queries over the driver tables; importing a module registers its queries."""

import importlib

from genespark.plans.registry import ORACLES, QUERIES

MODULES = ("presence", "families", "pangenome", "islands", "cooccurrence", "overlap", "sources", "graph", "annotate", "loci", "late", "more", "studies", "sketch", "chain")

for _name in MODULES:
    importlib.import_module(f"genespark.plans.{_name}")

__all__ = ["ORACLES", "QUERIES"]
