"""Named queries over the driver's tables."""

import importlib

MODULES = ["q_hash", "q_flatten", "q_lifecycle", "q_redact", "q_manifests", "q_validate", "q_nested", "q_metadata", "q_harmonise", "q_sources"]


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
