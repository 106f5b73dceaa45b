"""Column expressions; every one stays inside the JVM."""

from tessera.functions.keys import class_rank, natural_key, natural_order
from tessera.functions.text import (
    ascii_like,
    blank_to_null,
    canonical_class,
    clean,
    computed_once,
    iri,
    parse_authors,
    strip_namespace,
)
from tessera.functions.tools import normalise_tools, tool_set, tools_from_json, tools_like

__all__ = [
    "ascii_like",
    "blank_to_null",
    "canonical_class",
    "class_rank",
    "clean",
    "computed_once",
    "iri",
    "natural_key",
    "natural_order",
    "normalise_tools",
    "parse_authors",
    "strip_namespace",
    "tool_set",
    "tools_from_json",
    "tools_like",
]
