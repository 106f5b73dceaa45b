"""The tools of an activity, kept as an array column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import ascii_like, clean


def tools_from_json(c: str) -> Column:
    """JSON text of a tool field -> array; a scalar becomes a list of one."""
    text = F.col(c)
    listed = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    return F.coalesce(listed, F.when(text.isNotNull(), F.array(text)))


def normalise_tools(c: str) -> Column:
    """Trim the elements; a list that is empty, holds a null or only one blank is null as a whole."""
    tools = F.col(c)
    blank = (F.size(tools) == 1) & F.exists(tools, lambda tool: clean(tool) == "")
    missing = (F.size(tools) == 0) | F.exists(tools, lambda tool: tool.isNull()) | blank
    return F.when(~missing, F.transform(tools, clean))


def tool_set(c: str) -> Column:
    """Distinct tools in sorted order; null when there are none."""
    tools = F.array_sort(F.array_distinct(F.col(c)))
    return F.when(F.size(tools) > 0, tools)


def tools_like(c: str, partial: str) -> Column:
    """The elements that match; the others are dropped from the list."""
    return F.filter(F.col(c), lambda tool: ascii_like(tool, partial))
