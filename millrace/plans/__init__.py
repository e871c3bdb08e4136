"""Jobs: the operators bound to tables, each with its SQL check where there is one."""

from __future__ import annotations

import importlib

_MODULES = ("rooms", "rental", "census", "reviews", "vectors", "files", "checks", "search")


def all_jobs():
    """Every registered job by name."""
    for module in _MODULES:
        importlib.import_module(f"millrace.plans.{module}")
    from millrace.plans.registry import JOBS

    return JOBS
