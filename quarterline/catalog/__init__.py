"""The query catalog: importing it registers every query."""

from importlib import import_module

_SECTIONS = [
    "flagship",
    "scalars",
    "filters",
    "selection",
    "reshaping",
    "windowing",
    "profiling",
    "evaluation",
    "slicing",
    "quality",
    "nested",
    "serving",
    "decisions",
    "storage",
    "modeling",
]

for _section in _SECTIONS:
    import_module(f"quarterline.catalog.{_section}")
