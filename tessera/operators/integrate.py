"""Integration of sources: filling gaps, keeping first rows, building entities.

The rules, for the rows of one identifier over all sources, in order of author name (nulls last)
and then of source:

* a missing value is filled from the nearest later row that has one, never from an earlier row;
* of the rows with the same author (after filling) the first counts;
* that row must have title, owner and place, and an author with both id and name or with neither.

``resolve_objects`` and ``resolve_authors`` reach the same result without ordering any rows. All
rows a source has for an object share their attributes (conflicts are settled to the smallest
value), so it is enough to know, per source, the first and the last author name and whether there
are rows without a name. These are aggregates that combine on the map side, and no object, however
many authors or sources' rows it has, needs to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera import config
from tessera import functions as fn
from tessera.operators import ranges
from tessera.operators.objects import OBJECT_KEY, PERSON_KEY, Facts, matching, people_rows, span_names
from tessera.sources.folders import kept

REQUIRED = config.OBJECT.required()
ROW_ORDER = ["p_name", "source", "p_identifier"]


# -- objects --------------------------------------------------------------------------------------


def settle_conflicts(records: DataFrame) -> DataFrame:
    """One row per source and object; of conflicting values the smallest stands."""
    smallest = [F.min(c).alias(c) for c in config.OBJECT_VALUES]
    # Spark would infer this filter for only one of the two uses of the result, and then could not
    # share the shuffle between them.
    records = records.filter(F.col("identifier").isNotNull())
    return records.groupBy(*OBJECT_KEY).agg(*smallest)


def _authors_per_source(spans: DataFrame) -> DataFrame:
    return spans.filter(F.col("identifier").isNotNull()).groupBy(*OBJECT_KEY).agg(
        F.min("first_name").alias("first_name"),
        F.max("last_name").alias("last_name"),
        F.max("nameless").alias("nameless"),
    )


def _place(after_named: Column, name: Column, source: Column) -> Column:
    """Position of a row in the order of its object: rows without a name come after all others."""
    return F.struct(after_named.alias("unnamed"), name.alias("name"), source.alias("source"))


def resolve_objects(
    records: DataFrame, spans: DataFrame, within: DataFrame | None = None
) -> DataFrame:
    """Valid objects with their filled attributes, one row each.

    ``spans`` are the authors as ``Facts.name_spans`` gives them. ``within`` limits them to some objects, named by ``identifier`` or ``source, identifier``. It
    is applied after the first aggregation, when no object has more than a row per source.

    Also returns ``named`` (is there an author with a name) and ``valid_up_to``, the position of
    the last row whose required values can still be filled.

    An object with named authors starts at the first of them, so each value comes from the first
    row that has it. Without any, it starts at the first source that comes after the last source
    with a nameless author: in earlier ones the missing author id would be filled with that
    author's, which leaves the author half defined and the row invalid.
    """
    settled = _semi(settle_conflicts(records), within)
    per_source = settled.join(_authors_per_source(spans), OBJECT_KEY, "left")
    # One row per source in each window partition.
    same_object = Window.partitionBy("identifier")
    nameless = F.coalesce("nameless", F.lit(False))
    judged = per_source.select(
        "*",
        F.max(F.col("first_name").isNotNull()).over(same_object).alias("named"),
        F.max(F.when(nameless, F.col("source"))).over(same_object).alias("last_nameless"),
        _place(F.col("first_name").isNull(), F.col("first_name"), F.col("source")).alias("first"),
        _place(
            nameless | F.col("first_name").isNull(), F.col("last_name"), F.col("source")
        ).alias("last"),
    )
    counts = (
        F.col("named")
        | F.col("last_nameless").isNull()
        | (F.col("source") > F.col("last_nameless"))
    )
    filled = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.col("first"))).alias(c)
        for c in config.OBJECT_VALUES
    ]
    reach = [
        F.max(F.when(F.col(c).isNotNull(), F.col("last"))).alias(f"last_{c}") for c in REQUIRED
    ]
    objects = (
        judged.filter(counts)
        .groupBy("identifier")
        .agg(*filled, *reach, F.max("named").alias("named"))
        .dropna(subset=REQUIRED)
    )
    valid_up_to = F.least(*[F.col(f"last_{c}") for c in REQUIRED])
    return objects.select(
        *config.OBJECT_COLUMNS, "named", valid_up_to.alias("valid_up_to")
    )


def resolve_authors(spans: DataFrame) -> DataFrame:
    """The first row of every object and named author, with its position in the object."""
    name = F.col("first_name")
    position = _place(F.lit(False), name, F.col("source"))
    # Nameless authors are skipped by the aggregate, not by a filter, which would be pushed below
    # the join of the authors and make a second, different join of it.
    return (
        spans.filter(F.col("identifier").isNotNull())
        .groupBy("identifier", "p_identifier")
        .agg(F.min(F.when(name.isNotNull(), position)).alias("position"))
        .filter(F.col("position").isNotNull())
        .select("identifier", "p_identifier", F.col("position.name").alias("p_name"), "position")
    )


def _semi(rows: DataFrame, within: DataFrame | None) -> DataFrame:
    if within is None:
        return rows
    return rows.join(within, [c for c in OBJECT_KEY if c in within.columns], "left_semi")


def object_entities(facts: Facts, within: DataFrame | None = None) -> DataFrame:
    """Integrated objects without their authors, one row each."""
    return resolve_objects(facts.records, _spans(facts, within), within)


def _spans(facts: Facts, within: DataFrame | None) -> DataFrame:
    return Facts(lambda: facts.records, lambda: _semi(facts.authored, within), lambda: facts.person).name_spans()


def to_objects(facts: Facts, within: DataFrame | None = None) -> DataFrame:
    """Integrated objects in flat form: a row per object and author.

    An object without authors has one row with null author columns. Objects with very many
    authors stay spread over many rows and tasks; ``nest_authors`` turns the rows into lists.
    """
    spans = _spans(facts, within)
    return join_authors(resolve_objects(facts.records, spans, within), resolve_authors(spans))


def join_authors(objects: DataFrame, authors: DataFrame) -> DataFrame:
    """Objects of ``resolve_objects`` with those authors whose rows are valid.

    An object with named authors keeps at least the first of them, so the two branches together
    are a left join, but one of which either side can be split.
    """
    columns = [*config.OBJECT_COLUMNS, *config.AUTHOR_COLUMNS]
    named = objects.filter("named")
    valid = F.col("position") <= F.col("valid_up_to")
    with_authors = authors.join(named, "identifier", "inner").filter(valid).select(*columns)
    # ``valid_up_to`` always has a value here. Naming it keeps both branches on the same columns,
    # so that the aggregation below them is shuffled once.
    without = objects.filter(~F.col("named") & F.col("valid_up_to").isNotNull()).select(
        *config.OBJECT_COLUMNS,
        *[F.lit(None).cast("string").alias(c) for c in config.AUTHOR_COLUMNS],
    )
    return with_authors.unionByName(without)


def facts_of_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows as ``object_rows`` gives them -> (records, spans), to integrate any query result."""
    records = rows.select("source", *config.OBJECT_COLUMNS)
    authors = rows.filter(F.col("p_identifier").isNotNull())
    return records, span_names(authors, [*OBJECT_KEY, "p_identifier"])


def nest_authors(flat: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """One row per object and ``part`` with ``authors``, an array of ``(id, name)`` in order of name.

    A part holds ``list_rows`` authors, the last one of an object the rest: read in order of
    ``part``, the lists are the whole list. An object without authors has one empty part. Authors are numbered within
    stretches of an object's order, which then count on from each other, so no object has to fit a task.
    """
    columns = list(config.OBJECT_COLUMNS)
    by_name = [F.col(c).asc_nulls_last() for c in reversed(config.AUTHOR_COLUMNS)]
    rows = ranges.in_stretches(flat, "identifier", by_name)
    per_stretch = rows.groupBy("identifier", ranges.STRETCH).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("identifier", ranges.STRETCH).orderBy(*by_name))
    placed = ranges.beside(rows.withColumn("_place", place), ranges.rows_before(per_stretch, "identifier"), "identifier")
    number = F.coalesce("_before", F.lit(0)) + F.col("_place") - 1
    placed = placed.withColumn("part", F.floor(number / list_rows).cast("int"))
    author = F.struct(F.col("p_name").alias("name"), F.col("p_identifier").alias("id"))
    listed = F.array_sort(F.collect_list(F.when(F.col("p_identifier").isNotNull(), author)))
    authors = F.transform(listed, lambda a: F.struct(a["id"].alias("id"), a["name"].alias("name")))
    firsts = [F.first(c).alias(c) for c in config.OBJECT_VALUES]
    nested = placed.groupBy("identifier", "part").agg(*firsts, authors.alias("authors"))
    return nested.select(*columns, "authors", "part")


# -- people ---------------------------------------------------------------------------------------


def to_people(rows: DataFrame) -> DataFrame:
    """Integrated people: filling and keeping the first row in order of name leaves the smallest
    name each person has anywhere; people without any name are dropped."""
    named = rows.groupBy("identifier").agg(F.min("name").alias("name"))
    return named.filter(F.col("name").isNotNull())


def entity_by_id(facts: Facts, identifiers) -> DataFrame:
    """What an identifier stands for: an object if any source has one, otherwise a person.

    Object rows as in ``to_objects``; the row of a person has only author columns. An identifier
    known only through invalid rows has no row at all.
    """
    asked = matching("identifier", identifiers)
    described = Facts(lambda: asked(facts.records), lambda: asked(facts.authored), lambda: facts.person)
    people = to_people(asked(people_rows(facts)))
    people = people.join(described.records.select("identifier").distinct(), "identifier", "left_anti")
    no_value = [F.lit(None).cast("string").alias(c) for c in config.OBJECT_VALUES]
    objects = to_objects(described).withColumn("kind", F.lit(config.OBJECT.name))
    as_rows = people.select(
        "identifier",
        *no_value,
        F.col("identifier").alias("p_identifier"),
        F.col("name").alias("p_name"),
        F.lit(config.PERSON.name).alias("kind"),
    )
    return objects.unionByName(as_rows)


# -- activities -----------------------------------------------------------------------------------


def to_activities(activities: DataFrame, objects: DataFrame) -> DataFrame:
    """Activities with their object nested; those whose object is unknown or invalid are dropped.

    The object carries its own attributes only. Copying its author list into each of its
    activities would multiply the two; join ``to_objects`` on the identifier where they are needed.
    ``activities`` is the left side, so the activities of one very popular object can be split.
    """
    described = objects.select(
        F.col("identifier").alias("refersTo"),
        F.struct(*config.OBJECT_COLUMNS).alias("object"),
    )
    joined = activities.join(described, "refersTo", "inner")
    return joined.select(*config.ACTIVITY_COLUMNS, "object")


def order_activities(activities: DataFrame) -> DataFrame:
    """By object, then by precedence of the class.

    The rest of the row, and at last the task it comes from, only break ties, so that the equal
    activities of one object, however many, can be sorted by more than one task.
    """
    columns = activities.columns
    ties = [c for c in ("start", "end", "institute", "person", "technique", "tool") if c in columns]
    order = [*fn.natural_order("refersTo"), fn.class_rank("class").asc_nulls_last(), *ties, "_task"]
    placed = activities.withColumn("_task", F.spark_partition_id())
    return placed.orderBy(*order).select(*columns)


def order_objects(objects: DataFrame) -> DataFrame:
    """By identifier, then by author name; the rest of the row breaks ties."""
    order = fn.natural_order("identifier")
    rest = [*reversed(config.AUTHOR_COLUMNS), *config.OBJECT_VALUES]
    order += [F.col(c).asc_nulls_last() for c in rest if c in objects.columns]
    return objects.orderBy(*order)


def order_people(people: DataFrame) -> DataFrame:
    return people.orderBy(F.col("name").asc_nulls_last(), F.col("identifier"))


# -- the row-level steps --------------------------------------------------------------------------


#: Rows of an object up to which one task goes through them.
LONG = 1_000_000


def long_objects(facts: Facts, most: int = LONG) -> DataFrame | None:
    """Identifiers of the objects with more than so many records or rows, a row being a link with a name; None if there are none.

    Links and names are first looked at apart. Only objects that could be long if all their links had as many names as any, mostly
    none, are counted.
    """
    per_person = facts.person.groupBy(*PERSON_KEY).agg(F.count(F.lit(1)).alias("names"))
    widest = per_person.agg(F.max("names")).first()[0] or 1
    by_links = facts.linked.groupBy("identifier").agg((F.sum("links") * widest).alias("rows"))
    by_records = facts.records.groupBy("identifier").agg(F.count(F.lit(1)).alias("rows"))
    more = F.col("rows") > most
    could_be = kept(by_links.filter(more).select("identifier"), "could-be-long")
    if could_be.isEmpty():
        found = by_records.filter(more)
    else:
        links = facts.authored.join(could_be, "identifier", "left_semi").join(per_person, PERSON_KEY, "left")
        counted = links.groupBy("identifier").agg(F.sum(F.coalesce("names", F.lit(1))).alias("rows"))
        found = counted.filter(more).unionByName(by_records.filter(more))
    long = kept(found.select("identifier").distinct(), "long")
    return None if long.isEmpty() else long


def backfill(rows: DataFrame, key: str, order: list[str], columns: list[str], whole: bool = False, before: str = "") -> DataFrame:
    """Fill nulls from the nearest later row of the same key, later meaning ``order``, nulls last.

    Rows are filled within stretches of their key's order, and then from what later stretches offer. The rows of one key spread
    over tasks, whatever their number and their values, as long as they differ in ``order``. ``whole`` is for keys that each
    fit a task: they are filled at once, nothing is written, and rows that are dealt by the key already are not shuffled.
    With ``before`` columns of that prefix hold the order's values as they were.
    """
    if whole:
        return _fill(rows, [key], order, columns, before)
    if before:
        rows = rows.select("*", *[F.col(c).alias(f"{before}{c}") for c in order])
        order = [f"{before}{c}" for c in order]
    by_order = [F.col(c).asc_nulls_last() for c in order]
    spread = ranges.in_stretches(rows, key, by_order)
    place = F.struct(*[p for c in order for p in (F.col(c).isNull(), F.col(c))])
    offers = spread.groupBy(key, ranges.STRETCH).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns]
    )
    within = _fill(spread, [key, ranges.STRETCH], order, columns)
    return ranges.beside(within, ranges.from_later(offers, key, columns), key).select(
        *[
            F.coalesce(c, f"_next_{c}").alias(c) if c in columns else F.col(c)
            for c in rows.columns
        ]
    )


def _fill(rows: DataFrame, keys: list[str], order: list[str], columns: list[str], before: str = "") -> DataFrame:
    """Backward fill, written as a forward scan of the reversed order, which is linear."""
    reversed_order = [F.col(c).desc_nulls_first() for c in order]
    seen = (
        Window.partitionBy(*keys)
        .orderBy(*reversed_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = {c: F.last(c, ignorenulls=True).over(seen) for c in columns}
    # What the order was is named above the window, so that no copy of it is sorted.
    rows = rows.select("*", *[value.alias(f"_filled_{c}") for c, value in filled.items()])
    as_they_were = [F.col(c).alias(f"{before}{c}") for c in order if before]
    names = [c for c in rows.columns if not c.startswith("_filled_")]
    return rows.select(*[F.col(f"_filled_{c}").alias(c) if c in filled else F.col(c) for c in names], *as_they_were)


def keep_first(rows: DataFrame, keys: list[str], order: list[str], valid: Column) -> DataFrame:
    """The first row per key, if that very row is valid; null keys count as equal.

    An aggregate rather than a window, so that duplicates shrink before the shuffle.
    """
    row = F.struct(*rows.columns)
    place = F.struct(*[p for c in order for p in (F.col(c).isNull(), F.col(c))])
    first = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min_by(row, place).alias("row"))
    return first.select("row.*").filter(valid)


def is_valid_object() -> Column:
    """Title, owner and place are known, and the author is defined fully or not at all."""
    complete = [F.col(c).isNotNull() for c in REQUIRED]
    valid = F.col("p_identifier").isNull() == F.col("p_name").isNull()
    for known in complete:
        valid = valid & known
    return valid
