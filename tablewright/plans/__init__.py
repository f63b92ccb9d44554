"""Registered queries; importing this package fills the registry."""

from importlib import import_module

from tablewright.plans.registry import QUERIES, SQL  # noqa: F401

MODULES = [
    "quality_queries",
    "cleaning_queries",
    "profile_queries",
    "matching_queries",
    "label_queries",
    "task_queries",
    "page_queries",
    "active_queries",
    "source_queries",
]
for _name in MODULES:
    import_module(f"{__name__}.{_name}")
