"""The registered queries as SQL, worked out row by row with windows and outer joins.

The integration here fills and keeps rows in their order, as the rules are worded, where the Spark
jobs reach the same results by aggregates alone.
"""

from __future__ import annotations

_RAW_OBJECTS = """
raw_parts AS (
  SELECT
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS source,
    CAST(l_partkey AS VARCHAR) AS identifier,
    CASE
      WHEN l_returnflag = 'R' AND p_brand = 'Brand#7' THEN 'Nauticall chart'
      WHEN p_type = 'ECONOMY' THEN 'Nautical chart'
      WHEN p_type = 'LARGE' THEN ' manuscript plate '
      WHEN p_type = 'MEDIUM' THEN 'PRINTED   volume'
      WHEN p_type = 'PROMO' THEN 'herbarium'
      WHEN p_type = 'SMALL' THEN 'Printed Material'
      ELSE 'Map'
    END AS class,
    CASE
      WHEN p_type = 'SMALL' AND l_returnflag <> 'N' THEN '  '
      WHEN p_type = 'PROMO' AND l_returnflag = 'A' THEN NULL
      WHEN p_type = 'ECONOMY' AND l_returnflag <> 'A' THEN NULL
      WHEN p_type = 'LARGE' AND l_returnflag = 'N' THEN NULL
      WHEN p_brand = 'Brand#3' AND l_returnflag = 'R' AND l_linestatus = 'F' THEN p_name || ' bis'
      ELSE ' ' || p_name || chr(9)
    END AS title,
    CASE WHEN l_returnflag = 'N' THEN CAST(1500 + p_size AS VARCHAR) END AS date,
    CASE
      WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND s_acctbal > 9000 THEN 'unknown hand'
      WHEN l_returnflag = 'N' AND s_acctbal < 3000 THEN ' (S:' || l_suppkey || ')'
      WHEN l_returnflag = 'R' AND l_linestatus = 'O'
        THEN s_name || ' (S:' || l_suppkey || '); Maker, ' || p_type || ' ( M:' || p_brand || ' )'
      ELSE s_name || ' (S:' || l_suppkey || ')'
    END AS hasAuthor,
    CASE
      WHEN l_returnflag = 'N' AND p_size > 25 THEN NULL
      WHEN l_returnflag = 'R' AND p_size > 40 THEN ''
      WHEN l_returnflag = 'A' AND p_size <= 5 THEN NULL
      ELSE p_brand
    END AS owner,
    CASE WHEN l_returnflag = 'A' AND p_retailprice < 905 THEN NULL ELSE 'Hall ' || p_type END AS place
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
),
raw_customers AS (
  SELECT
    CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS source,
    'C' || o_custkey AS identifier,
    CASE WHEN c_nationkey < 12 THEN 'Model' ELSE 'painting ' END AS class,
    CASE WHEN o_orderstatus = 'O' AND c_mktsegment = 'BUILDING' THEN NULL ELSE c_name END AS title,
    CAST(NULL AS VARCHAR) AS date,
    CASE
      WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND c_acctbal < 5000
        THEN '(N:' || c_nationkey || ')'
      WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' AND c_acctbal < 1000
        THEN c_name || ' (self)'
    END AS hasAuthor,
    CASE WHEN o_orderstatus = 'P' AND c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS owner,
    CASE
      WHEN o_orderstatus = 'F' AND c_mktsegment = 'FURNITURE' THEN ' '
      ELSE 'Room ' || c_nationkey
    END AS place
  FROM orders JOIN customer ON o_custkey = c_custkey
),
raw AS MATERIALIZED (SELECT * FROM raw_parts UNION ALL SELECT * FROM raw_customers)
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(13)"


def _clean(c: str) -> str:
    return f"trim({c}, {_BLANKS})"


def _blank(c: str) -> str:
    return f"nullif({_clean(c)}, '')"


# Capitalise word by word and join; what is not a class afterwards is null.
_CLASS = f"""array_to_string(list_transform(
      string_split_regex({_clean('class')}, '\\s+'), lambda w: upper(w[1]) || lower(w[2:])), '')"""
# Fixed values.
_CLASSES = """('NauticalChart', 'ManuscriptPlate', 'ManuscriptVolume', 'PrintedVolume',
    'PrintedMaterial', 'Herbarium', 'Specimen', 'Painting', 'Model', 'Map')"""
# Fixed value.
_AUTHOR = "'^(.*?)\\s*?\\(\\s*(.+?)\\s*\\)\\s*$'"

_CLEANED = f"""{_RAW_OBJECTS},
cleaned AS MATERIALIZED (
  SELECT * FROM (
    SELECT source, {_blank('identifier')} AS identifier,
      CASE WHEN {_CLASS} IN {_CLASSES} THEN {_CLASS} END AS class,
      {_blank('title')} AS title, {_blank('date')} AS date, {_blank('hasAuthor')} AS hasAuthor,
      {_blank('owner')} AS owner, {_blank('place')} AS place
    FROM raw)
  WHERE identifier IS NOT NULL AND class IS NOT NULL
),
cells AS (
  SELECT source, identifier, unnest(string_split(hasAuthor, '; ')) AS cell FROM cleaned
),
authors AS (
  SELECT source, identifier,
    {_blank(f'regexp_extract(cell, {_AUTHOR}, 2)')} AS p_identifier,
    {_blank(f'regexp_extract(cell, {_AUTHOR}, 1)')} AS p_name
  FROM cells WHERE regexp_matches(cell, {_AUTHOR})
)
"""

_FACTS = f"""{_CLEANED},
records AS MATERIALIZED (SELECT DISTINCT source, identifier, class, title, owner, place, date FROM cleaned),
authored AS MATERIALIZED (SELECT DISTINCT source, identifier, p_identifier FROM authors),
person AS MATERIALIZED (SELECT DISTINCT source, p_identifier, p_name FROM authors),
links AS MATERIALIZED (
  SELECT a.source, a.identifier, a.p_identifier, p.p_name
  FROM authored a LEFT JOIN person p ON a.source = p.source AND a.p_identifier = p.p_identifier
)
"""


def _values(attribute: str) -> str:
    return (
        f"(SELECT DISTINCT source, identifier, {attribute} FROM records"
        f" WHERE {attribute} IS NOT NULL) AS v_{attribute} USING (source, identifier)"
    )


# One optional join per attribute, which multiplies the values a source has for an object.
_ROWS = f"""{_FACTS},
object_values AS (
  SELECT source, identifier, class, title, owner, place, date
  FROM (SELECT DISTINCT source, identifier, class FROM records) AS classes
  LEFT JOIN {_values('title')}
  LEFT JOIN {_values('owner')}
  LEFT JOIN {_values('place')}
  LEFT JOIN {_values('date')}
),
object_rows AS (
  SELECT v.source, v.identifier, v.class, v.title, v.owner, v.place, v.date,
    l.p_identifier, l.p_name
  FROM object_values v LEFT JOIN links l ON v.source = l.source AND v.identifier = l.identifier
)
"""


def _integrated(rows: str = "", facts: str = _FACTS) -> str:
    """Integration over those (source, identifier) pairs a condition on ``s`` selects."""
    return f"""{facts},
settled AS (
  SELECT source, identifier, min(class) AS class, min(title) AS title, min(owner) AS owner,
    min(place) AS place, min(date) AS date
  FROM records GROUP BY source, identifier
),
joined AS (
  SELECT s.source, s.identifier, s.class, s.title, s.owner, s.place, s.date, l.p_identifier, l.p_name
  FROM settled s LEFT JOIN links l ON s.source = l.source AND s.identifier = l.identifier
  {rows}
),
filled AS (
  SELECT source, identifier, p_name AS o_p_name, source AS o_source, p_identifier AS o_p_identifier,
    first_value(class IGNORE NULLS) OVER later AS class,
    first_value(title IGNORE NULLS) OVER later AS title,
    first_value(owner IGNORE NULLS) OVER later AS owner,
    first_value(place IGNORE NULLS) OVER later AS place,
    first_value(date IGNORE NULLS) OVER later AS date,
    first_value(p_identifier IGNORE NULLS) OVER later AS p_identifier,
    first_value(p_name IGNORE NULLS) OVER later AS p_name
  FROM joined
  WINDOW later AS (
    PARTITION BY identifier
    ORDER BY p_name NULLS LAST, source NULLS LAST, p_identifier NULLS LAST
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY identifier, p_identifier
    ORDER BY o_p_name NULLS LAST, o_source NULLS LAST, o_p_identifier NULLS LAST) AS copy
  FROM filled
),
kept AS (
  SELECT * EXCLUDE (copy) FROM numbered
  WHERE copy = 1 AND title IS NOT NULL AND owner IS NOT NULL AND place IS NOT NULL
    AND (p_identifier IS NULL) = (p_name IS NULL)
),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY identifier
    ORDER BY o_p_name NULLS LAST, o_source NULLS LAST, o_p_identifier NULLS LAST) AS pos
  FROM kept
),
entity AS (
  SELECT identifier, class, title, owner, place, date FROM placed WHERE pos = 1
),
flat AS (
  SELECT e.identifier, e.class, e.title, e.owner, e.place, e.date, k.p_identifier, k.p_name
  FROM entity e LEFT JOIN (SELECT * FROM kept WHERE p_identifier IS NOT NULL) k
    ON e.identifier = k.identifier
),
nested AS (
  SELECT identifier, any_value(class) AS class, any_value(title) AS title,
    any_value(owner) AS owner, any_value(place) AS place, any_value(date) AS date,
    coalesce(string_agg(p_identifier || '=' || p_name, '|' ORDER BY p_name, p_identifier)
      FILTER (WHERE p_identifier IS NOT NULL), '') AS authors,
    CAST(0 AS INTEGER) AS part
  FROM flat GROUP BY identifier
)
"""


_EVENTS = """
ev AS (
  SELECT event_id, event_type, k,
    CASE WHEN value < 35 THEN 1 ELSE 2 END AS source,
    CASE
      WHEN k >= 95 THEN 'X' || user_id
      WHEN event_type IN ('error', 'click') AND k < 40 THEN 'C' || user_id
      ELSE CAST(user_id AS VARCHAR)
    END AS refersTo,
    CASE WHEN value > 150 THEN ' ' ELSE ' ' || c_mktsegment || ' ' END AS institute,
    CASE WHEN value < 10 THEN '' ELSE c_name END AS person,
    CASE
      WHEN event_type = 'signup' AND k < 6 THEN ''
      WHEN event_type = 'signup' AND value < 30 THEN 'Photogrammetry'
      WHEN event_type = 'signup' THEN ' Laser scanning'
      WHEN k BETWEEN 50 AND 54 THEN 'Photogrammetry'
    END AS technique,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS "start",
    CASE WHEN k >= 10 THEN CAST(CAST(ts AS DATE) + CAST(k // 10 AS INTEGER) AS VARCHAR) ELSE '' END
      AS "end",
    CASE
      WHEN k < 25 THEN CAST([] AS VARCHAR[])
      WHEN k < 50 THEN ['Blender']
      WHEN k < 75 THEN ['Gimp ', 'Blender', 'Instant Meshes']
      WHEN k < 90 THEN ['Metashape', 'Metashape']
      ELSE ['3DF Zephyr', NULL]
    END AS tool
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
  LEFT JOIN customer ON user_id = c_custkey
),
raw_activity AS (
  SELECT source,
    CASE event_type WHEN 'signup' THEN 'Acquisition' WHEN 'view' THEN 'Processing'
      WHEN 'click' THEN 'Modelling' WHEN 'purchase' THEN 'Optimising' ELSE 'Exporting' END AS class,
    refersTo, technique, institute, person, "start", "end", tool
  FROM ev
  UNION ALL
  SELECT source, 'Exporting', refersTo, NULL, institute, person, "start", "end", tool
  FROM ev WHERE event_type = 'purchase' AND k >= 80
)
"""

_ACTIVITIES = f"""{_EVENTS},
activity AS (
  SELECT * FROM (
    SELECT source, class, {_blank('refersTo')} AS refersTo, {_blank('technique')} AS technique,
      {_blank('institute')} AS institute, {_blank('person')} AS person,
      {_blank('"start"')} AS "start", {_blank('"end"')} AS "end",
      CASE WHEN len(tool) > 0 AND len(list_filter(tool, lambda t: t IS NULL)) = 0
        THEN list_transform(tool, lambda t: {_clean('t')}) END AS tool
    FROM raw_activity)
  WHERE class IN ('Acquisition', 'Processing', 'Modelling', 'Optimising', 'Exporting')
    AND refersTo IS NOT NULL AND institute IS NOT NULL
    AND ((class = 'Acquisition' AND technique IS NOT NULL)
      OR (class <> 'Acquisition' AND technique IS NULL))
)
"""

_FIELDS = 'class, refersTo, technique, institute, person, "start", "end"'


def _joined(c: str = "tool") -> str:
    return f"array_to_string(list_transform({c}, lambda t: coalesce(t, '?')), '|')"


def _tool_set(c: str = "tool") -> str:
    return f"array_to_string(list_sort(list_distinct({c})), '|')"


def _bag(columns: str, rows: str) -> str:
    """Equal rows and how many there are."""
    return f"SELECT *, count(*) AS copies FROM (SELECT {columns} FROM {rows}) GROUP BY ALL"


def _listed(condition: str = "TRUE", tool: str = "tool") -> str:
    """Stored activities that meet a condition, with their tool sets."""
    return (
        f"WITH {_ACTIVITIES} "
        + _bag(f"source, {_FIELDS}, {_tool_set(tool)} AS tool", f"activity WHERE {condition}")
    )


def _like(c: str, partial: str) -> str:
    """Fold ASCII letters only. No character escapes another by default."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"translate({c}, '{upper}', '{lower}') LIKE '%{partial.lower()}%'"


def _described(condition: str = "TRUE", tool: str = "tool", objects: str = "") -> str:
    """Activities that meet a condition, with the attributes of their valid object."""
    values = ", ".join(f"e.{c} AS object_{c}" for c in ("class", "title", "owner", "place", "date"))
    fields = ", ".join(f"a.{c.strip()}" for c in _FIELDS.split(","))
    return (
        f"WITH {_integrated()}, {_ACTIVITIES}"
        f" SELECT {fields}, {_tool_set('a.' + tool if tool == 'tool' else tool)} AS tool, {values}"
        f" FROM activity a JOIN entity e ON a.refersTo = e.identifier WHERE {condition} {objects}"
    )


def _objects_of(condition: str) -> str:
    """Objects, with what all sources know of them, that were handled as a condition says."""
    chosen = f"WHERE s.identifier IN (SELECT refersTo FROM activity WHERE {condition})"
    return f"WITH {_ACTIVITIES}, {_integrated(chosen)} SELECT * FROM flat"


def _people(rows: str) -> str:
    return (
        f"SELECT identifier, min(name) AS name FROM ({rows}) GROUP BY identifier"
        " HAVING min(name) IS NOT NULL"
    )


def _authors_of(condition: str) -> str:
    return (
        "SELECT l.source, l.p_identifier AS identifier, l.p_name AS name"
        f" FROM links l WHERE {condition}"
    )


def _iri(entity: str, c: str) -> str:
    return f"'loc:{entity}-' || replace(url_encode({c}), '%20', '+')"


_EVERYBODY = "SELECT source, p_identifier AS identifier, p_name AS name FROM person"
_MATCHING_TOOLS = f"list_filter(a.tool, lambda t: {_like('t', 'blend')})"

_FACT_ROWS = """
  SELECT 'record' AS kind, *, NULL AS p_identifier, NULL AS p_name FROM records
  UNION ALL SELECT 'authored', source, identifier, NULL, NULL, NULL, NULL, NULL, p_identifier, NULL FROM authored
  UNION ALL SELECT 'person', source, NULL, NULL, NULL, NULL, NULL, NULL, p_identifier, p_name FROM person"""

ORACLES: dict[str, str] = {
    "a2_activity_documents": f"WITH {_EVENTS} "
    + _bag(f"{_FIELDS}, {_joined()} AS tool", "raw_activity"),
    "a3_flatten_activities": f"WITH {_EVENTS} "
    + _bag(f"source, {_FIELDS}, {_joined()} AS tool", "raw_activity"),
    "a4_metadata_push_set": f"WITH {_FACTS} {_FACT_ROWS}",
    "a5_process_push_bag": f"WITH {_ACTIVITIES} "
    + _bag(
        f"source, {_FIELDS}, {_joined()} AS tool",
        "(SELECT * FROM activity UNION ALL SELECT * FROM activity)",
    ),
    "a10_triples": f"""WITH {_FACTS}
      SELECT source, 'loc:' || class AS subject, 'rdfs:subClassOf' AS predicate,
        'edm:PhysicalThing' AS object FROM records
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'rdf:type', 'loc:' || class FROM records
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'dc:identifier', identifier FROM records
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'dc:title', title FROM records
        WHERE title IS NOT NULL
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'dc:date', date FROM records
        WHERE date IS NOT NULL
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'edm:currentLocation', owner FROM records
        WHERE owner IS NOT NULL
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'dc:coverage', place FROM records
        WHERE place IS NOT NULL
      UNION SELECT source, {_iri('CHO', 'identifier')}, 'dc:creator',
        {_iri('Person', 'p_identifier')} FROM authored
      UNION SELECT source, {_iri('Person', 'p_identifier')}, 'rdf:type', 'edm:Agent' FROM person
      UNION SELECT source, {_iri('Person', 'p_identifier')}, 'dc:identifier', p_identifier
        FROM person
      UNION SELECT source, {_iri('Person', 'p_identifier')}, 'foaf:name', coalesce(p_name, '')
        FROM person""",
    "b1_trim": f"""WITH {_RAW_OBJECTS}
      SELECT DISTINCT source, {_clean('identifier')} AS identifier, {_clean('class')} AS class,
        {_clean('title')} AS title, {_clean('date')} AS date, {_clean('owner')} AS owner,
        {_clean('place')} AS place, {_clean('hasAuthor')} AS hasAuthor FROM raw""",
    "b2_blank_to_null": f"WITH {_EVENTS} "
    + _bag(
        ", ".join(f"{_blank(c.strip())} AS {c.strip()}" for c in _FIELDS.split(",")),
        "raw_activity",
    ),
    "b3_class_canonical": f"WITH {_RAW_OBJECTS} "
    + _bag(f"class AS text, CASE WHEN {_CLASS} IN {_CLASSES} THEN {_CLASS} END AS class", "raw"),
    "b4_required_keys": f"WITH {_CLEANED} " + _bag("source, identifier, class", "cleaned"),
    "b5_split_authors": f"WITH {_CLEANED} " + _bag("source, identifier, cell", "cells"),
    "b6_parse_author": f"WITH {_CLEANED} "
    + _bag("source, identifier, p_identifier, p_name", "authors"),
    "b7_iri": f"""WITH {_RAW_OBJECTS}
      SELECT DISTINCT identifier, hasAuthor, {_iri('CHO', 'identifier')} AS object_iri,
        {_iri('Person', 'hasAuthor')} AS author_iri FROM raw""",
    "b8_strip_namespace": f"""WITH {_FACTS}
      SELECT DISTINCT identifier, 'loc:' || class AS stored, class FROM records""",
    "b9_rename_fields": f"WITH {_EVENTS} "
    + _bag(
        f'lower(class) AS kind, refersTo, technique, institute, person, {_joined()} AS tool, "start", "end"',
        "raw_activity",
    ),
    "b10_tools": f"WITH {_EVENTS} "
    + _bag(
        f"""{_joined()} AS raw_tool,
        CASE WHEN len(tool) > 0 AND len(list_filter(tool, lambda t: t IS NULL)) = 0
        THEN array_to_string(list_transform(tool, lambda t: {_clean('t')}), '|') END AS tool""",
        "raw_activity",
    ),
    "b11_valid_activities": f"WITH {_ACTIVITIES} "
    + _bag(f"source, {_FIELDS}, {_joined()} AS tool", "activity"),
    "b12_key_case": f"WITH {_EVENTS} "
    + _bag(f"{_FIELDS}, {_joined()} AS tool", "raw_activity"),
    "b13_select_only": f"WITH {_FACTS} "
    + _bag(
        "title",
        "(SELECT DISTINCT source, identifier, class FROM records) AS classes LEFT JOIN "
        + _values("title"),
    ),
    "b14_attribute": f"WITH {_ACTIVITIES} "
    + _bag("refersTo", "activity WHERE technique IS NOT NULL"),
    "b15_id_join": f"WITH {_ACTIVITIES} "
    + _bag(
        f"source, {_FIELDS}, {_tool_set()} AS tool",
        """(SELECT * FROM activity WHERE refersTo = '7'
        UNION ALL SELECT * FROM activity WHERE refersTo IN ('7', 'C8', 'no such id'))""",
    ),
    "b16_accessors": f"""WITH {_integrated()}, {_ACTIVITIES}
      SELECT a.class, a.institute, a.person, e.title, e.owner
      FROM activity a JOIN entity e ON a.refersTo = e.identifier""",
    "c1_by_identifier": f"WITH {_ROWS} SELECT * FROM object_rows"
    " WHERE identifier IN ('1', '12', 'C8', 'S:1')",
    "c2_by_institution": _listed(_like("institute", "uRNIT")),
    "c3_by_person": _listed(_like("person", "CUSTOMER%_1")),
    "c4_tool_filter": _listed(
        f"len(list_filter(tool, lambda t: {_like('t', 'ME')})) > 0",
        f"list_filter(tool, lambda t: {_like('t', 'ME')})",
    ),
    "c5_started_after": _listed("\"start\" >= '2024-01-15'"),
    "c6_ended_before": _listed("\"end\" <= '2024-01-15'"),
    "c7_acquisitions_by_technique": _listed(f"class = 'Acquisition' AND {_like('technique', 'scan')}"),
    "c8_acquired_between": f"WITH {_ACTIVITIES} "
    + _bag(
        f"source, {_FIELDS}, {_joined()} AS tool",
        """activity WHERE class = 'Acquisition' AND "start" >= '2024-01-08'
        AND "end" <= '2024-01-20'""",
    ),
    "c9_relation_paths": f"""WITH {_FACTS}
      SELECT DISTINCT source, identifier, 'by author' AS path FROM authored
        WHERE p_identifier IN ('S:7', 'M:Brand#3')
      UNION ALL SELECT DISTINCT source, identifier, 'by author name' FROM links
        WHERE p_name IN ('Supplier#00000007', 'Maker, SMALL')
      UNION ALL SELECT DISTINCT source, identifier, 'by owner' FROM records
        WHERE owner = 'Brand#12'
      UNION ALL SELECT DISTINCT source, p_identifier, 'of object' FROM authored
        WHERE identifier IN ('7', 'C8')
      UNION ALL SELECT DISTINCT source, p_identifier, 'of owner' FROM authored
        WHERE (source, identifier) IN (SELECT (source, identifier) FROM records WHERE owner = 'Brand#12')
      UNION ALL SELECT DISTINCT source, p_identifier, 'of class' FROM authored
        WHERE (source, identifier) IN
          (SELECT (source, identifier) FROM records WHERE class IN ('Model', 'Herbarium'))
      UNION ALL SELECT DISTINCT source, p_identifier, 'by name' FROM person
        WHERE p_name = 'Maker, SMALL'""",
    "d1_subclasses": f"WITH {_FACTS} SELECT DISTINCT source, identifier, class FROM records"
    f" WHERE class IN {_CLASSES}",
    "d2_object_values": f"WITH {_ROWS} SELECT * FROM object_values",
    "d3_object_rows": f"WITH {_ROWS} SELECT * FROM object_rows",
    "d4_activity_tools": f"WITH {_ACTIVITIES} "
    + _bag(
        "source, class, refersTo, tool",
        """(SELECT source, class, refersTo, unnest(tool) AS tool FROM activity
        UNION ALL SELECT source, class, refersTo, NULL FROM activity WHERE tool IS NULL)""",
    ),
    "d5_objects_by_author": f"""WITH {_ROWS}
      SELECT * FROM object_rows WHERE (source, identifier) IN (
        SELECT (source, identifier) FROM authored WHERE p_identifier IN ('S:7', 'M:Brand#3'))""",
    "d6_authors_of_object": f"WITH {_FACTS} "
    + _bag("*", "(" + _authors_of("l.identifier IN ('7', '12', 'C8')") + ")"),
    "d7_activity_objects": _described(),
    "d8_activities_by_author": _described(
        objects="AND a.refersTo IN (SELECT identifier FROM authored WHERE p_identifier = 'S:7')"
    ),
    "d9_objects_by_person": _objects_of(_like("person", "customer#00000001")),
    "d10_objects_by_institution": _objects_of(_like("institute", "build")),
    "d11_authors_acquired_between": f"WITH {_FACTS}, {_ACTIVITIES} "
    + _people(
        _authors_of(
            """l.identifier IN (SELECT refersTo FROM activity WHERE class = 'Acquisition'
            AND "start" >= '2024-01-08' AND "end" <= '2024-01-12')"""
        )
    ),
    "d12_entity_by_id": f"""WITH {_integrated()},
      asked AS (SELECT unnest(['3', '7', 'C8', 'S:7', 'M:Brand#3', 'N:3', 'no such id']) AS id),
      people AS ({_people(_EVERYBODY)})
      SELECT *, 'CHO' AS kind FROM flat WHERE identifier IN (SELECT id FROM asked)
      UNION ALL
      SELECT identifier, NULL, NULL, NULL, NULL, NULL, identifier, name, 'Person' FROM people
      WHERE identifier IN (SELECT id FROM asked)
        AND identifier NOT IN (SELECT identifier FROM records)""",
    "d13_objects_by_ids": _objects_of("class = 'Acquisition'"),
    "e1_tool_sets": _listed(),
    "e2_nested_authors": f"WITH {_integrated()} SELECT * FROM nested",
    "e3_distinct_keys": f"""WITH {_FACTS}, {_ACTIVITIES}
      SELECT 'class' AS kind, class AS value FROM records
      UNION SELECT 'refersTo', refersTo FROM activity""",
    "f1_backfill": f"WITH {_integrated()} SELECT * FROM filled",
    "f2_keep_first": f"WITH {_integrated()} SELECT * FROM kept",
    "f2_keep_first_people": f"""WITH {_FACTS}
      SELECT source, identifier, name FROM (
        SELECT *, row_number() OVER (
          PARTITION BY identifier ORDER BY name NULLS LAST, source) AS copy
        FROM ({_EVERYBODY}))
      WHERE copy = 1 AND name IS NOT NULL""",
    "g1_natural_order": f"""WITH {_FACTS}
      SELECT DISTINCT identifier,
        CAST(CASE WHEN regexp_full_match(identifier, '[0-9]+') THEN 0 ELSE 1 END AS INTEGER) AS text,
        CAST(CASE WHEN NOT regexp_full_match(identifier, '[0-9]+') THEN 0
          WHEN CAST(identifier AS BIGINT) = 0 THEN 0
          ELSE length(CAST(CAST(identifier AS BIGINT) AS VARCHAR)) END AS INTEGER) AS width
      FROM records
      ORDER BY text, CASE WHEN text = 0 THEN CAST(identifier AS BIGINT) END, identifier""",
    "g2_class_rank": f"WITH {_EVENTS} "
    + _bag(
        """class, CAST(CASE class WHEN 'Acquisition' THEN 1 WHEN 'Processing' THEN 2
        WHEN 'Modelling' THEN 3 WHEN 'Optimising' THEN 4 WHEN 'Exporting' THEN 5 END AS BIGINT)
        AS class_rank""",
        "raw_activity",
    ),
    "g3_sorted_activities": f"""WITH {_ACTIVITIES}
      SELECT refersTo, class, "start", "end", source FROM activity
      ORDER BY CASE WHEN regexp_full_match(refersTo, '[0-9]+') THEN 0 ELSE 1 END,
        CASE WHEN regexp_full_match(refersTo, '[0-9]+') THEN CAST(refersTo AS BIGINT) END,
        refersTo, list_position(
          ['Acquisition', 'Processing', 'Modelling', 'Optimising', 'Exporting'], class)""",
    "g4_first_entity": f"WITH {_FACTS} "
    + _people(_authors_of("l.identifier IN ('7', '12')"))
    + " ORDER BY name, identifier LIMIT 1",
    "h1_union_sources": f"WITH {_FACTS} " + _bag("identifier, name", f"({_EVERYBODY})"),
    "h2_union_facts": f"WITH {_FACTS} {_FACT_ROWS}",
    "h3_union_ids": f"""WITH {_FACTS}, {_ACTIVITIES}
      SELECT identifier FROM authored UNION SELECT refersTo FROM activity""",
    "l1_people": f"WITH {_FACTS} " + _people(_EVERYBODY),
    "l2_objects": f"WITH {_integrated()} SELECT * FROM flat",
    "l3_activities": _described(),
    "m1_all_people": f"WITH {_FACTS} " + _people(_EVERYBODY),
    "m2_all_objects": f"WITH {_integrated()} SELECT * FROM nested",
    "m3_authors_of_object": f"WITH {_FACTS} " + _people(_authors_of("l.identifier = '7'")),
    "m4_objects_authored_by": "WITH "
    + _integrated(
        """WHERE (s.source, s.identifier) IN (
        SELECT (source, identifier) FROM authored WHERE p_identifier = 'S:7')"""
    )
    + " SELECT * FROM flat",
    "m5_all_activities": _described(),
    "m6_by_institution": _described(_like("a.institute", "mach")),
    "m7_by_person": _described(_like("a.person", "omer#00000001")),
    "m8_using_tool": _described(f"len({_MATCHING_TOOLS}) > 0", _MATCHING_TOOLS),
    "m9_started_after": _described("a.\"start\" >= '2024-01-20'"),
    "m10_ended_before": _described("a.\"end\" <= '2024-01-10'"),
    "m12_objects_of_activities": _objects_of(_like("institute", "mach")),
    "m11_by_technique": _described(f"a.class = 'Acquisition' AND {_like('a.technique', 'photo')}"),
}
