"""What the model consists of: attributes, classes, ranks and file layouts.

Everything here is declarative and is consumed by the ingest, integration and query jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Attribute:
    """One attribute of a described entity."""

    name: str
    predicate: str
    required: bool = False
    separator: str | None = None
    related: str | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    type: str
    attributes: tuple[Attribute, ...]

    def required(self) -> list[str]:
        return [a.name for a in self.attributes if a.required and a.name not in self.key()]

    def key(self) -> list[str]:
        return [name for name in ("identifier", "class") if name in self.names()]

    def names(self) -> list[str]:
        return [a.name for a in self.attributes]

    def __getitem__(self, name: str) -> Attribute:
        return next(a for a in self.attributes if a.name == name)


# Attribute order of an object file, predicates, entity types.
OBJECT = Entity(
    "CHO",
    "edm:PhysicalThing",
    (
        Attribute("identifier", "dc:identifier", required=True),
        Attribute("class", "rdf:type", required=True),
        Attribute("title", "dc:title", required=True),
        Attribute("date", "dc:date"),
        Attribute("hasAuthor", "dc:creator", separator="; ", related="Person"),
        Attribute("owner", "edm:currentLocation", required=True),
        Attribute("place", "dc:coverage", required=True),
    ),
)
PERSON = Entity(
    "Person",
    "edm:Agent",
    (
        Attribute("identifier", "dc:identifier", required=True),
        Attribute("name", "foaf:name", required=True),
    ),
)
NAMESPACE = "loc"

# The classes an object can have.
OBJECT_CLASSES = (
    "NauticalChart",
    "ManuscriptPlate",
    "ManuscriptVolume",
    "PrintedVolume",
    "PrintedMaterial",
    "Herbarium",
    "Specimen",
    "Painting",
    "Model",
    "Map",
)

# The activity classes, in their order of precedence.
ACTIVITY_CLASSES = ("Acquisition", "Processing", "Modelling", "Optimising", "Exporting")
TECHNIQUE_CLASS = "Acquisition"

# Activity fields as they are called in files, and in the model.
ACTIVITY_FIELDS = {
    "technique": "technique",
    "responsible institute": "institute",
    "responsible person": "person",
    "start date": "start",
    "end date": "end",
    "tool": "tool",
}
ACTIVITY_KEY = "object id"

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: an author cell is "Name (ID)"; the name may be missing.
AUTHOR_PATTERN = r"^(.*?)\s*?\(\s*(.+?)\s*\)\s*$"

# Attributes of an object that are single literals, in output order.
OBJECT_VALUES = ("class", "title", "owner", "place", "date")
OBJECT_COLUMNS = ("identifier", *OBJECT_VALUES)
AUTHOR_COLUMNS = ("p_identifier", "p_name")
ACTIVITY_COLUMNS = ("class", "refersTo", "technique", "institute", "person", "start", "end", "tool")


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


RAW_OBJECT_SCHEMA = T.StructType(_strings(*OBJECT.names()))
RECORD_SCHEMA = T.StructType(_strings(*OBJECT_COLUMNS))
AUTHORED_SCHEMA = T.StructType(_strings("identifier", "p_identifier"))
PERSON_SCHEMA = T.StructType(_strings("p_identifier", "p_name"))
ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField(name, T.ArrayType(T.StringType()) if name == "tool" else T.StringType())
        for name in ACTIVITY_COLUMNS
    ]
)
