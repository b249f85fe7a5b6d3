"""All queries of this subpackage and their SQL."""

import importlib

from vcat.llm.registry import ORACLES, QUERIES

for _m in ("q_native", "q_text", "q_corpus"):
    importlib.import_module(f"vcat.llm.{_m}")

__all__ = ["ORACLES", "QUERIES"]
