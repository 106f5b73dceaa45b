"""Process data: validation of raw activities and the filters over stored ones.

Activities are a bag ``(source, class, refersTo, technique, institute, person, start, end, tool)``
with the tools nested as an array, so reading them takes no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import config
from tessera import functions as fn
from tessera.operators.objects import matching


def unpivot_activities(wide: DataFrame, key: str = config.ACTIVITY_KEY) -> DataFrame:
    """``(key, acquisition struct, processing struct, ...)`` -> one row per object and activity.

    Columns of the struct that a kind of activity lacks are null. Activities an object does not
    have at all give no row.
    """
    names = {c.lower(): c for c in wide.columns}
    extra = [c for c in wide.columns if c != key and c.lower() not in _lowered_classes()]
    present = [(kind, names[kind.lower()]) for kind in config.ACTIVITY_CLASSES if kind.lower() in names]
    if not present:
        raise ValueError("no activity columns")

    def as_activity(kind: str, column: str) -> Column:
        fields = {f.lower() for f in wide.schema[column].dataType.names}
        values = [
            (F.col(f"`{column}`.`{raw}`") if raw in fields else F.lit(None).cast(_type(model))).alias(model)
            for raw, model in config.ACTIVITY_FIELDS.items()
        ]
        activity = F.struct(F.lit(kind).alias("class"), *values)
        return F.when(F.col(f"`{column}`").isNotNull(), activity)

    kinds = F.array_compact(F.array(*[as_activity(kind, column) for kind, column in present]))
    long_form = wide.select(*extra, F.col(f"`{key}`").alias("refersTo"), F.explode(kinds).alias("a"))
    return long_form.select(*extra, "refersTo", "a.*").select(*extra, *config.ACTIVITY_COLUMNS)


def _lowered_classes() -> set[str]:
    return {kind.lower() for kind in config.ACTIVITY_CLASSES}


def _type(model: str) -> str:
    return "array<string>" if model == "tool" else "string"


def rename_fields(rows: DataFrame) -> DataFrame:
    """Field names used in files -> names of the model."""
    return rows.withColumnsRenamed(config.ACTIVITY_FIELDS)


def clean_activities(rows: DataFrame) -> DataFrame:
    """Trim the text columns, blank to null, normalise the tools. The class is taken as it is."""
    cells = [
        (fn.normalise_tools(c) if c == "tool" else fn.blank_to_null(c)).alias(c)
        for c in config.ACTIVITY_COLUMNS
    ]
    extra = [c for c in rows.columns if c not in config.ACTIVITY_COLUMNS]
    return rows.select(*extra, *cells)


def is_valid() -> Column:
    """Known class, an object, an institute, and a technique exactly on acquisitions."""
    technique_fits = (F.col("class") == config.TECHNIQUE_CLASS) == F.col("technique").isNotNull()
    return (
        F.col("class").isin(*config.ACTIVITY_CLASSES)
        & F.col("refersTo").isNotNull()
        & F.col("institute").isNotNull()
        & technique_fits
    )


def activities_from(rows: DataFrame) -> DataFrame:
    """Clean and keep what is valid; invalid rows are dropped, duplicates stay."""
    cleaned = clean_activities(rows)
    judged = fn.computed_once(cleaned, "class", "refersTo", "technique", "institute")
    return judged.select(*cleaned.columns).filter(is_valid())


# -- reading --------------------------------------------------------------------------------------


def all_activities(stored: DataFrame) -> DataFrame:
    """Activities with their distinct tools, null when there are none."""
    return stored.withColumn("tool", fn.tool_set("tool"))


def by_object(stored: DataFrame, objects) -> DataFrame:
    return all_activities(matching("refersTo", objects)(stored))


def by_institution(stored: DataFrame, partial: str) -> DataFrame:
    return all_activities(stored.filter(fn.ascii_like("institute", partial)))


def by_person(stored: DataFrame, partial: str) -> DataFrame:
    return all_activities(stored.filter(fn.ascii_like("person", partial)))


def using_tool(stored: DataFrame, partial: str) -> DataFrame:
    """Matches single tools, and returns only the tools that match."""
    matched = stored.withColumn("tool", fn.tools_like("tool", partial))
    return all_activities(matched.filter(F.size("tool") > 0))


def started_after(stored: DataFrame, date: str) -> DataFrame:
    """Started on the date or later; dates compare as text."""
    return all_activities(stored.filter(F.col("start") >= date))


def ended_before(stored: DataFrame, date: str) -> DataFrame:
    """Ended on the date or earlier."""
    return all_activities(stored.filter(F.col("end") <= date))


def _is_acquisition() -> Column:
    return F.col("class") == config.TECHNIQUE_CLASS


def acquisitions_by_technique(stored: DataFrame, partial: str) -> DataFrame:
    return all_activities(stored.filter(_is_acquisition() & fn.ascii_like("technique", partial)))


def acquired_between(start: str, end: str) -> Column:
    """Acquisitions that started on or after one date and ended on or before another."""
    return _is_acquisition() & (F.col("start") >= start) & (F.col("end") <= end)


def attribute(stored: DataFrame, name: str = "refersTo", condition: Column | None = None) -> DataFrame | None:
    """One column, as a bag, of the activities that meet the condition; None if unknown."""
    if name not in config.ACTIVITY_COLUMNS or name == "tool":
        return None
    rows = stored if condition is None else stored.filter(condition)
    return rows.select(name)
