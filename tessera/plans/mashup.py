"""Questions to all registered sources at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config
from tessera import functions as fn
from tessera.operators import activities as act
from tessera.operators import integrate as joint
from tessera.operators import objects as obj
from tessera.operators.objects import Facts


def union_facts(parts: list[Facts]) -> Facts:
    return reduce(Facts.union, parts)


def _numbered(rows: DataFrame, source: int) -> DataFrame:
    return rows.withColumn("source", F.lit(source))


class Mashup:
    """Integrated entities over facts and activities that carry a ``source`` column.

    Every method returns one lazy DataFrame. Objects come in flat form, a row per object and
    author; ``nest`` turns them into rows with a list of authors. With ``ordered`` the results are
    sorted as listed entities would be; switch it off where the rows go into further queries.
    """

    def __init__(self, facts: Facts | None, activities: DataFrame | None, ordered: bool = True):
        self._facts = facts
        self._activities = activities
        self.ordered = ordered

    def facts(self) -> Facts:
        if self._facts is None:
            spark = SparkSession.active()
            empty = [
                _numbered(spark.createDataFrame([], schema), 0)
                for schema in (config.RECORD_SCHEMA, config.AUTHORED_SCHEMA, config.PERSON_SCHEMA)
            ]
            return Facts(*empty)
        return self._facts

    def activities(self) -> DataFrame:
        if self._activities is None:
            spark = SparkSession.active()
            return _numbered(spark.createDataFrame([], config.ACTIVITY_SCHEMA), 0)
        return self._activities

    # -- results ----------------------------------------------------------------------------------

    def _objects(self, objects: DataFrame) -> DataFrame:
        return joint.order_objects(objects) if self.ordered else objects

    def _people(self, people: DataFrame) -> DataFrame:
        return joint.order_people(people) if self.ordered else people

    def _with_objects(self, found: DataFrame, objects: DataFrame) -> DataFrame:
        result = joint.to_activities(found, objects)
        return joint.order_activities(result) if self.ordered else result

    def toPerson(self, rows: DataFrame) -> DataFrame:
        return self._people(joint.to_people(rows))

    def toCHO(self, rows: DataFrame) -> DataFrame:
        """Objects from rows of any query over single sources."""
        records, spans = joint.facts_of_rows(rows)
        resolved = joint.resolve_objects(records, spans)
        return self._objects(joint.join_authors(resolved, joint.resolve_authors(spans)))

    def toActivity(self, found: DataFrame) -> DataFrame:
        """Activities with their objects; the join leaves only the objects they refer to."""
        return self._with_objects(found, joint.object_entities(self.facts()))

    def objectsOf(self, activities: DataFrame) -> DataFrame:
        """The objects of activities once each, flat and with all their authors.

        This is what an activity's object holds besides its own attributes; as a result of its own
        it is as large as the objects, not as activities times authors.
        """
        ids = activities.select(F.col("refersTo").alias("identifier")).distinct()
        return self._objects(joint.to_objects(self.facts(), ids))

    @staticmethod
    def nest(objects: DataFrame) -> DataFrame:
        return joint.nest_authors(objects)

    # -- entities ---------------------------------------------------------------------------------

    def getEntityById(self, identifier: str) -> DataFrame:
        """The object, or else the person, with this id; no rows if there is no valid one."""
        return self._objects(joint.entity_by_id(self.facts(), identifier))

    def getCulturalHeritageObjectsByIds(self, identifiers) -> DataFrame:
        """Objects by id, given as one id, several, or a DataFrame of one column."""
        facts = self.facts()
        if isinstance(identifiers, DataFrame):
            ids = identifiers.toDF("identifier").distinct()
            return self._objects(joint.to_objects(facts, ids))
        wanted = F.col("identifier").isin(obj.as_list(identifiers))
        return self._objects(joint.to_objects(facts.where(wanted)))

    def getAllPeople(self) -> DataFrame:
        return self.toPerson(obj.people_rows(self.facts()))

    def getAllCulturalHeritageObjects(self) -> DataFrame:
        return self._objects(joint.to_objects(self.facts()))

    def getAuthorsOfCulturalHeritageObject(self, objectId) -> DataFrame:
        return self.toPerson(obj.people_behind(self.facts(), objectId))

    def getCulturalHeritageObjectsAuthoredBy(self, personId) -> DataFrame:
        """Seen only by the sources that know of the link, so with what those sources hold."""
        facts = self.facts()
        return self._objects(joint.to_objects(facts, obj.authored_by(facts, personId)))

    def getAllActivities(self) -> DataFrame:
        found = act.all_activities(self.activities())
        return self._with_objects(found, joint.object_entities(self.facts()))

    def getActivitiesByResponsibleInstitution(self, partialName: str) -> DataFrame:
        return self.toActivity(act.by_institution(self.activities(), partialName))

    def getActivitiesByResponsiblePerson(self, partialName: str) -> DataFrame:
        return self.toActivity(act.by_person(self.activities(), partialName))

    def getActivitiesUsingTool(self, partialName: str) -> DataFrame:
        return self.toActivity(act.using_tool(self.activities(), partialName))

    def getActivitiesStartedAfter(self, date: str) -> DataFrame:
        return self.toActivity(act.started_after(self.activities(), date))

    def getActivitiesEndedBefore(self, date: str) -> DataFrame:
        return self.toActivity(act.ended_before(self.activities(), date))

    def getAcquisitionsByTechnique(self, partialName: str) -> DataFrame:
        return self.toActivity(act.acquisitions_by_technique(self.activities(), partialName))

    # -- across both kinds of source --------------------------------------------------------------

    def _handled(self, condition: Column) -> DataFrame:
        """Ids of the objects of the activities that meet the condition."""
        return act.attribute(self.activities(), "refersTo", condition).distinct()

    def getActivitiesOnObjectsAuthoredBy(self, personId) -> DataFrame:
        """The objects keep only activities on them, so joining the two is the whole filter."""
        facts = self.facts()
        ids = obj.authored_by(facts, personId).select("identifier").distinct()
        found = act.all_activities(self.activities())
        return self._with_objects(found, joint.object_entities(facts, ids))

    def getObjectsHandledByResponsiblePerson(self, partialName: str) -> DataFrame:
        return self.getCulturalHeritageObjectsByIds(
            self._handled(fn.ascii_like("person", partialName))
        )

    def getObjectsHandledByResponsibleInstitution(self, partialName: str) -> DataFrame:
        return self.getCulturalHeritageObjectsByIds(
            self._handled(fn.ascii_like("institute", partialName))
        )

    def getAuthorsOfObjectsAcquiredInTimeFrame(self, start: str, end: str) -> DataFrame:
        """The objects themselves need not be valid."""
        ids = self._handled(act.acquired_between(start, end))
        return self.toPerson(obj.people_behind(self.facts(), ids))
