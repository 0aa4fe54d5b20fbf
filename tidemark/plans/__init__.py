"""Named queries over the driver tables, each with its SQL equivalent where SQL can say it."""

from __future__ import annotations

import importlib

MODULES = ["indicators", "events", "shaping", "pit", "ranking", "forecast", "waves", "fusion", "levels", "summaries", "surface", "streams"]


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"tidemark.plans.{m}")
