"""The registered queries: one per operator, over the whole tables under test.

Lists are returned as joined text, and results of more than one table as one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config
from tessera import functions as fn
from tessera.operators import activities as act
from tessera.operators import integrate as joint
from tessera.operators import objects as obj
from tessera.operators.objects import Facts
from tessera.plans import samples
from tessera.plans.mashup import Mashup, union_facts
from tessera.sources.activity_json import activities_from_documents
from tessera.sources.folders import shared_path
from tessera.sources.store import ObjectStore, ProcessStore

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _mashup(spark: SparkSession, sf: str) -> Mashup:
    return Mashup(samples.facts(spark, sf), samples.activities(spark, sf), ordered=False)


def _text(rows: DataFrame) -> DataFrame:
    """Tools as joined text, the nested object as columns."""
    if "tool" in rows.columns:
        rows = rows.withColumn("tool", F.array_join("tool", "|", "?"))
    if "object" in rows.columns:
        values = [F.col(f"object.{c}").alias(f"object_{c}") for c in config.OBJECT_VALUES]
        rows = rows.select(*[c for c in rows.columns if c != "object"], *values)
    return rows


def _bag(rows: DataFrame) -> DataFrame:
    """Equal rows and how many there are."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


# -- sources --------------------------------------------------------------------------------------


@query
def a2_activity_documents(spark, sf):
    """Activities written as JSON text and read back from it."""
    wide = samples.wide_activities(spark, sf)
    kinds = [c for c in wide.columns if c != "source"]
    documents = wide.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in kinds])).alias("text"))
    parsed = documents.select(F.from_json("text", "map<string,string>").alias("document"))
    return _text(_bag(activities_from_documents(parsed)))


@query
def a3_flatten_activities(spark, sf):
    return _bag(_text(samples.raw_activities(spark, sf)))


def _pushed(spark: SparkSession, *pushes: DataFrame) -> Facts:
    """Raw object rows pushed one after the other, each source into a store of its own, and read from there."""
    held = []
    for source in samples.OBJECT_SOURCES:
        store = ObjectStore(spark, shared_path(spark, f"objects-{source}"), buckets=16)
        for raw in pushes:
            store.push(raw.filter(F.col("source") == source))
        held.append(store.facts().map(lambda rows, source=source: rows.withColumn("source", F.lit(source))))
    return union_facts(held)


@query
def a4_metadata_push_set(spark, sf):
    """Pushing rows of which some are held already adds only what is new."""
    return _fact_rows(_pushed(spark, samples.raw_customers(spark, sf), samples.raw_objects(spark, sf)))


def _fact_rows(facts: Facts) -> DataFrame:
    """The three tables as one."""
    columns = ["source", *config.OBJECT_COLUMNS, *config.AUTHOR_COLUMNS]
    tables = {"record": facts.records, "authored": facts.authored, "person": facts.person}
    parts = []
    for kind, rows in tables.items():
        filled = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
        parts.append(rows.select(F.lit(kind).alias("kind"), *filled))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def a5_process_push_bag(spark, sf):
    """Pushing the same activities again doubles them; each source has a store of its own."""
    raw = samples.raw_activities(spark, sf)
    parts = []
    for source in samples.ACTIVITY_SOURCES:
        store = ProcessStore(spark, shared_path(spark, f"activities-{source}"))
        for _ in range(2):
            store.push(raw.filter(F.col("source") == source))
        parts.append(store.activities().withColumn("source", F.lit(source)))
    return _bag(_text(parts[0].unionByName(parts[1]).select("source", *config.ACTIVITY_COLUMNS)))


@query
def a10_triples(spark, sf):
    return obj.triples(samples.facts(spark, sf))


# -- projections and cleaning ---------------------------------------------------------------------


@query
def b1_trim(spark, sf):
    raw = samples.raw_objects(spark, sf)
    return raw.select("source", *[fn.clean(c).alias(c) for c in config.OBJECT.names()]).distinct()


@query
def b2_blank_to_null(spark, sf):
    rows = act.rename_fields(samples.raw_activities(spark, sf))
    columns = [c for c in config.ACTIVITY_COLUMNS if c != "tool"]
    return _bag(rows.select(*[fn.blank_to_null(c).alias(c) for c in columns]))


@query
def b3_class_canonical(spark, sf):
    raw = samples.raw_objects(spark, sf)
    return _bag(raw.select(F.col("class").alias("text"), fn.canonical_class(fn.clean("class")).alias("class")))


@query
def b4_required_keys(spark, sf):
    cleaned = obj.clean_objects(samples.raw_objects(spark, sf))
    return cleaned.groupBy("source", "identifier", "class").agg(F.count(F.lit(1)).alias("copies"))


@query
def b5_split_authors(spark, sf):
    cleaned = obj.clean_objects(samples.raw_objects(spark, sf))
    cells = cleaned.select("source", "identifier", F.explode(F.split("hasAuthor", "; ")).alias("cell"))
    return _bag(cells)


@query
def b6_parse_author(spark, sf):
    cleaned = obj.clean_objects(samples.raw_objects(spark, sf))
    return _bag(obj.split_authors(cleaned))


@query
def b7_iri(spark, sf):
    raw = samples.raw_objects(spark, sf).select("identifier", "hasAuthor").distinct()
    return raw.select(
        "identifier",
        "hasAuthor",
        fn.iri("CHO", "identifier").alias("object_iri"),
        fn.iri("Person", "hasAuthor").alias("author_iri"),
    )


@query
def b8_strip_namespace(spark, sf):
    records = samples.facts(spark, sf).records
    stored = records.select("identifier", F.concat(F.lit("loc:"), F.col("class")).alias("stored"))
    return stored.distinct().withColumn("class", fn.strip_namespace("stored", "loc:"))


@query
def b9_rename_fields(spark, sf):
    wide = samples.wide_activities(spark, sf)
    parts = []
    for kind in [c for c in wide.columns if c not in ("source", "object id")]:
        fields = wide.filter(F.col(kind).isNotNull()).select("`object id`", f"{kind}.*")
        renamed = act.rename_fields(fields).withColumnRenamed("object id", "refersTo")
        parts.append(renamed.withColumn("kind", F.lit(kind)))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return _bag(_text(united))


@query
def b10_tools(spark, sf):
    raw = samples.raw_activities(spark, sf)
    return _bag(
        raw.select(
            F.array_join("tool", "|", "?").alias("raw_tool"),
            F.array_join(fn.normalise_tools("tool"), "|").alias("tool"),
        )
    )


@query
def b11_valid_activities(spark, sf):
    return _bag(_text(samples.activities(spark, sf)))


@query
def b12_key_case(spark, sf):
    """Documents whose keys, those of fields too, are in upper case read like those in lower case."""
    wide = samples.wide_activities(spark, sf)
    cells = []
    for field in wide.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name == "source":
            continue
        if field.name != "object id":
            inner = [value[n].alias(n.upper()) for n in field.dataType.names]
            value = F.when(value.isNotNull(), F.struct(*inner))
        cells.append(value.alias(field.name.upper()))
    documents = wide.select(F.from_json(F.to_json(F.struct(*cells)), "map<string,string>").alias("document"))
    return _text(_bag(activities_from_documents(documents)))


@query
def b13_select_only(spark, sf):
    return _bag(obj.select_only(samples.facts(spark, sf), "title"))


@query
def b14_attribute(spark, sf):
    stored = samples.activities(spark, sf)
    return _bag(act.attribute(stored, "refersTo", F.col("technique").isNotNull()))


@query
def b15_id_join(spark, sf):
    """One id is asked for like a list of one."""
    stored = samples.activities(spark, sf)
    one = act.by_object(stored, 7)
    several = act.by_object(stored, ["7", "C8", "no such id"])
    return _bag(_text(one.unionByName(several)))


@query
def b16_accessors(spark, sf):
    rows = _mashup(spark, sf).getAllActivities()
    return rows.select("class", "institute", "person", "object.title", "object.owner")


# -- filters --------------------------------------------------------------------------------------


@query
def c1_by_identifier(spark, sf):
    facts = samples.facts(spark, sf).where(F.col("identifier").isin("1", "12", "C8", "S:1"))
    return obj.object_rows(facts)


@query
def c2_by_institution(spark, sf):
    return _bag(_text(act.by_institution(samples.activities(spark, sf), "uRNIT")))


@query
def c3_by_person(spark, sf):
    return _bag(_text(act.by_person(samples.activities(spark, sf), "CUSTOMER%_1")))


@query
def c4_tool_filter(spark, sf):
    return _bag(_text(act.using_tool(samples.activities(spark, sf), "ME")))


@query
def c5_started_after(spark, sf):
    return _bag(_text(act.started_after(samples.activities(spark, sf), "2024-01-15")))


@query
def c6_ended_before(spark, sf):
    return _bag(_text(act.ended_before(samples.activities(spark, sf), "2024-01-15")))


@query
def c7_acquisitions_by_technique(spark, sf):
    return _bag(_text(act.acquisitions_by_technique(samples.activities(spark, sf), "scan")))


@query
def c8_acquired_between(spark, sf):
    stored = samples.activities(spark, sf)
    return _bag(_text(stored.filter(act.acquired_between("2024-01-08", "2024-01-20"))))


@query
def c9_relation_paths(spark, sf):
    facts = samples.facts(spark, sf)
    paths = {
        "by author": ("CHO", ("hasAuthor", "identifier"), ["S:7", "M:Brand#3"]),
        "by author name": ("CHO", ("hasAuthor", "name"), ["Supplier#00000007", "Maker, SMALL"]),
        "by owner": ("CHO", "owner", "Brand#12"),
        "of object": ("Person", ("CHO", "hasAuthor", "identifier"), ["7", "C8"]),
        "of owner": ("Person", ("CHO", "hasAuthor", "owner"), "Brand#12"),
        "of class": ("Person", ("CHO", "hasAuthor", "class"), ["Model", "Herbarium"]),
        "by name": ("Person", "name", "Maker, SMALL"),
    }
    found = [
        obj.related_by(facts, path, value, entity).withColumn("path", F.lit(name))
        for name, (entity, path, value) in paths.items()
    ]
    united = found[0]
    for rows in found[1:]:
        united = united.unionByName(rows)
    return united


# -- joins ----------------------------------------------------------------------------------------


@query
def d1_subclasses(spark, sf):
    records = samples.facts(spark, sf).records
    return records.filter(F.col("class").isin(*config.OBJECT_CLASSES)).select(
        "source", "identifier", "class"
    ).distinct()


@query
def d2_object_values(spark, sf):
    return obj.object_values(samples.facts(spark, sf).records)


@query
def d3_object_rows(spark, sf):
    return obj.object_rows(samples.facts(spark, sf))


@query
def d4_activity_tools(spark, sf):
    rows = samples.activities(spark, sf).select(
        "source", "class", "refersTo", F.explode_outer("tool").alias("tool")
    )
    return _bag(rows)


@query
def d5_objects_by_author(spark, sf):
    facts = samples.facts(spark, sf)
    return obj.object_rows(obj.objects_authored_by(facts, ["S:7", "M:Brand#3"]))


@query
def d6_authors_of_object(spark, sf):
    return _bag(obj.authors_of(samples.facts(spark, sf), ["7", "12", "C8"]))


@query
def d7_activity_objects(spark, sf):
    found = act.all_activities(samples.activities(spark, sf))
    objects = joint.object_entities(samples.facts(spark, sf))
    return _text(joint.to_activities(found, objects))


@query
def d8_activities_by_author(spark, sf):
    return _text(_mashup(spark, sf).getActivitiesOnObjectsAuthoredBy("S:7"))


@query
def d9_objects_by_person(spark, sf):
    return _mashup(spark, sf).getObjectsHandledByResponsiblePerson("customer#00000001")


@query
def d10_objects_by_institution(spark, sf):
    return _mashup(spark, sf).getObjectsHandledByResponsibleInstitution("build")


@query
def d11_authors_acquired_between(spark, sf):
    return _mashup(spark, sf).getAuthorsOfObjectsAcquiredInTimeFrame("2024-01-08", "2024-01-12")


@query
def d12_entity_by_id(spark, sf):
    facts = samples.facts(spark, sf)
    return joint.entity_by_id(facts, ["3", "7", "C8", "S:7", "M:Brand#3", "N:3", "no such id"])


@query
def d13_objects_by_ids(spark, sf):
    """The ids come from a query, not from a list."""
    ids = samples.activities(spark, sf).filter(F.col("class") == "Acquisition").select("refersTo")
    return _mashup(spark, sf).getCulturalHeritageObjectsByIds(ids)


# -- aggregation, integration, order --------------------------------------------------------------


@query
def e1_tool_sets(spark, sf):
    return _bag(_text(act.all_activities(samples.activities(spark, sf))))


@query
def e2_nested_authors(spark, sf):
    return _nested(joint.to_objects(samples.facts(spark, sf)))


def _nested(objects: DataFrame) -> DataFrame:
    listed = F.transform("authors", lambda a: F.concat_ws("=", a["id"], a["name"]))
    return joint.nest_authors(objects).withColumn("authors", F.array_join(listed, "|"))


@query
def e3_distinct_keys(spark, sf):
    facts = samples.facts(spark, sf)
    classes = facts.records.select(F.lit("class").alias("kind"), F.col("class").alias("value"))
    handled = samples.activities(spark, sf).select(
        F.lit("refersTo").alias("kind"), F.col("refersTo").alias("value")
    )
    return classes.unionByName(handled).distinct()


def _filled_rows(facts: Facts, most: int = joint.LONG) -> list[DataFrame]:
    """Filled rows next to the values that order them: those of objects that fit a task, and those of others, if any."""

    def filled(rows: DataFrame, whole: bool) -> DataFrame:
        columns = [*config.OBJECT_VALUES, *config.AUTHOR_COLUMNS]
        return joint.backfill(rows, "identifier", joint.ROW_ORDER, columns, whole, "o_")

    long = joint.long_objects(facts, most)
    if long is None:
        return [filled(obj.object_rows(facts, settled=True, together=True), True)]
    short = filled(obj.object_rows(facts.without(long), settled=True, together=True), True)
    return [short, filled(obj.object_rows(facts.within(long), settled=True), False)]


def _united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query
def f1_backfill(spark, sf):
    return _united(_filled_rows(samples.facts(spark, sf)))


@query
def f2_keep_first(spark, sf):
    order = [f"o_{c}" for c in joint.ROW_ORDER]
    keys = ["identifier", "p_identifier"]
    parts = _filled_rows(samples.facts(spark, sf))
    return _united([joint.keep_first(rows, keys, order, joint.is_valid_object()) for rows in parts])


@query
def f2_keep_first_people(spark, sf):
    people = obj.people_rows(samples.people(spark, sf))
    return joint.keep_first(people, ["identifier"], ["name", "source"], F.col("name").isNotNull())


@query
def g1_natural_order(spark, sf):
    ids = samples.facts(spark, sf).records.select("identifier").distinct()
    key = fn.natural_key("identifier")
    keyed = ids.select("identifier", key["text"].alias("text"), key["width"].alias("width"))
    return keyed.orderBy(*fn.natural_order("identifier"))


@query
def g2_class_rank(spark, sf):
    rows = samples.raw_activities(spark, sf)
    return _bag(rows.select("class", fn.class_rank("class").alias("class_rank")))


@query
def g3_sorted_activities(spark, sf):
    found = act.all_activities(samples.activities(spark, sf))
    return _text(joint.order_activities(found)).select("refersTo", "class", "start", "end", "source")


@query
def g4_first_entity(spark, sf):
    """Of the people found, the first one in order."""
    people = obj.authors_of(samples.facts(spark, sf), ["7", "12"])
    return joint.order_people(joint.to_people(people)).limit(1)


@query
def h1_union_sources(spark, sf):
    """People of sources that are stored apart."""
    return _bag(obj.people_rows(_pushed(spark, samples.raw_objects(spark, sf))).select("identifier", "name"))


@query
def h2_union_facts(spark, sf):
    facts = samples.facts(spark, sf)
    return _fact_rows(facts.union(facts).distinct())


@query
def h3_union_ids(spark, sf):
    """Ids of objects that somebody authored in any source or that anybody handled."""
    authored = samples.facts(spark, sf).authored.select("identifier")
    handled = samples.activities(spark, sf).select(F.col("refersTo").alias("identifier"))
    return authored.unionByName(handled).distinct()


# -- entities and the mash-up ---------------------------------------------------------------------


@query
def l1_people(spark, sf):
    return joint.to_people(obj.people_rows(samples.people(spark, sf)))


@query
def l2_objects(spark, sf):
    return joint.to_objects(samples.facts(spark, sf))


@query
def l3_activities(spark, sf):
    found = act.all_activities(samples.activities(spark, sf))
    return _text(_mashup(spark, sf).toActivity(found))


@query
def m1_all_people(spark, sf):
    return Mashup(samples.people(spark, sf), samples.activities(spark, sf), ordered=False).getAllPeople()


@query
def m2_all_objects(spark, sf):
    return _nested(_mashup(spark, sf).getAllCulturalHeritageObjects())


@query
def m3_authors_of_object(spark, sf):
    return _mashup(spark, sf).getAuthorsOfCulturalHeritageObject("7")


@query
def m4_objects_authored_by(spark, sf):
    return _mashup(spark, sf).getCulturalHeritageObjectsAuthoredBy("S:7")


@query
def m5_all_activities(spark, sf):
    return _text(_mashup(spark, sf).getAllActivities())


@query
def m6_by_institution(spark, sf):
    return _text(_mashup(spark, sf).getActivitiesByResponsibleInstitution("mach"))


@query
def m7_by_person(spark, sf):
    return _text(_mashup(spark, sf).getActivitiesByResponsiblePerson("omer#00000001"))


@query
def m8_using_tool(spark, sf):
    return _text(_mashup(spark, sf).getActivitiesUsingTool("blend"))


@query
def m9_started_after(spark, sf):
    return _text(_mashup(spark, sf).getActivitiesStartedAfter("2024-01-20"))


@query
def m10_ended_before(spark, sf):
    return _text(_mashup(spark, sf).getActivitiesEndedBefore("2024-01-10"))


@query
def m11_by_technique(spark, sf):
    return _text(_mashup(spark, sf).getAcquisitionsByTechnique("photo"))


@query
def m12_objects_of_activities(spark, sf):
    """What the objects of activities hold, authors and all, an object once."""
    mashup = _mashup(spark, sf)
    return mashup.objectsOf(act.by_institution(mashup.activities(), "mach"))
