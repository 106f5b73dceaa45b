"""Tables of one source, as Parquet below one folder.

An object store holds the sets ``records``, ``authored`` and ``person``; a process store holds the
bag ``activity``. What a push adds is a segment: folders of its own, which count once the store's log names them. So a push is
there as a whole or not at all, a reset as well, and of two pushes at once the later one builds on the earlier.

Segments of an object store are cut into buckets by a hash of the identifier, with a Bloom filter of its identifiers for each. A
push reads those buckets alone that may hold its facts. Files are sorted, so that a lookup by identifier skips row groups.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import config
from tessera.operators.activities import activities_from
from tessera.operators.objects import Facts, clean_objects, facts_of, linked_objects, new_facts, split_authors
from tessera.sources import filters
from tessera.sources.activity_json import read_activity_json
from tessera.sources.folders import drop, kept, kept_at, shared_path
from tessera.sources.log import CommitLog
from tessera.sources.object_csv import read_object_csv

_FACT_TABLES = {
    "person": config.PERSON_SCHEMA,
    "authored": config.AUTHORED_SCHEMA,
    "records": config.RECORD_SCHEMA,
}
#: The identifier that a table's rows are found by.
_KEYS = {"person": "p_identifier", "authored": "identifier", "records": "identifier"}


def kept_facts(raw: DataFrame) -> Facts:
    """The facts of raw object rows, each table written when it is first asked for.

    Views and integration read their facts several times over. On tables, each of these reads takes
    the columns and the row groups that it needs, whatever lies behind the raw rows. Those are read once for records and once
    for links and names, each time only the columns that it takes. The author cells between are dropped once all is made of them.
    """
    described = clean_objects(raw.select("source", *config.OBJECT_COLUMNS))
    by_authors = clean_objects(raw.select("source", "identifier", "class", "hasAuthor"))
    made: dict[str, DataFrame] = {}
    path = shared_path(raw, "authors")

    def of_authors(name: str, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if "authors" not in made:
            made["authors"] = kept_at(split_authors(by_authors), path)
        made[name] = kept(rows(made["authors"]), name)
        if {"authored", "person", "linked"} <= made.keys():
            drop(raw.sparkSession, path)
        return made[name]

    return Facts(
        lambda: kept(facts_of(described).records, "records"),
        lambda: of_authors("authored", lambda authors: facts_of(by_authors, authors).authored),
        lambda: of_authors("person", lambda authors: facts_of(by_authors, authors).person),
        # Cells of an object mostly lie together, more than links that were dealt out to be made distinct.
        lambda: of_authors("linked", linked_objects),
    )


class _Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = CommitLog(spark, self.path)

    def _segments(self) -> tuple[int, list[dict]]:
        version, state = self.log.read()
        return version, state["segments"] if state else []

    def _read(self, table: str, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}")
        return reader.parquet(*[f"{self.path}/{table}/{folder}" for folder in folders]).select(*schema.names)

    def _drop(self, folders: list[str]) -> None:
        """Remove folders that no version has named."""
        for folder in folders:
            drop(self.spark, f"{self.path}/{folder}")

    def reset(self) -> None:
        while not self.log.commit(self.log.read()[0] + 1, {"segments": []}):
            pass


class ObjectStore(_Store):
    """``buckets`` is how many a new segment is cut into; segments of another number stay readable."""

    #: Identifiers of a push in one bucket up to which filters are asked; more are taken to hit every one.
    ASKED = 100_000

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        super().__init__(spark, path)
        self.buckets = buckets

    def facts(self) -> Facts:
        _, segments = self._segments()

        def table(name: str) -> DataFrame:
            return self._read(name, [f"segment={s['name']}" for s in segments if s["keys"].get(name)], _FACT_TABLES[name])

        return Facts(lambda: table("records"), lambda: table("authored"), lambda: table("person"))

    def push_csv(self, path: str | list[str], multiline: bool = True) -> None:
        self.push(read_object_csv(self.spark, path, multiline))

    def push(self, raw: DataFrame) -> None:
        """Add the facts of raw object rows that the store does not hold yet, all or none of them."""
        # Read and cleaned once; what does not fit the memory goes to disk.
        cleaned = clean_objects(raw.withColumn("source", F.lit(0))).persist()
        try:
            found = facts_of(cleaned)
            self.add(Facts(*[getattr(found, n).select(*_FACT_TABLES[n].names) for n in ("records", "authored", "person")]))
        finally:
            cleaned.unpersist()

    def add(self, found: Facts) -> None:
        """Add distinct facts that the store does not hold yet."""
        while True:
            version, segments = self._segments()
            if any("stream" in s for s in segments):
                raise ValueError("this store is fed by a stream that remembers its facts")
            if self._append(version, segments, new_facts(found, self.held(found, segments)), {}):
                return

    def append(self, found: Facts, label: str, stream: str) -> None:
        """Add facts of which ``stream`` knows that they are new; what it added under the same label before is replaced."""
        while True:
            version, segments = self._segments()
            if any(s.get("stream") != stream for s in segments):
                raise ValueError("a stream that remembers its facts needs a store of its own")
            others = [s for s in segments if s["label"] != label]
            if self._append(version, others, found, {"label": label, "stream": stream}):
                return

    def _append(self, version: int, segments: list[dict], new: Facts, marks: dict) -> bool:
        """Write a segment and commit it on top of a version; whether that was the newest."""
        segment = {"name": uuid.uuid4().hex, "buckets": self.buckets, **marks}
        folders = [f"{table}/segment={segment['name']}" for table in (*_FACT_TABLES, "filters")]
        try:
            segment["keys"] = self._write(segment["name"], new)
            if not any(segment["keys"].values()) and not marks:
                self._drop(folders)
                return True
            if self._commit(version + 1, [*segments, segment]):
                return True
        except BaseException:
            self._drop(folders)
            raise
        self._drop(folders)
        return False

    def _commit(self, version: int, segments: list[dict]) -> bool:
        return self.log.commit(version, {"segments": segments})

    def _bucket(self, table: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(_KEYS[table]), F.lit(buckets)).cast("int")

    def _write(self, name: str, new: Facts) -> dict[str, dict[str, int]]:
        """Write a segment's tables and filters; how many identifiers each bucket of each table has."""
        keys = []
        for table, schema in _FACT_TABLES.items():
            rows = getattr(new, table).select(*schema.names, self._bucket(table, self.buckets).alias("bucket"))
            folder = f"{self.path}/{table}/segment={name}"
            # Small buckets share a task, and one that a single identifier makes large is split.
            dealt = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *schema.names)
            dealt.write.partitionBy("bucket").parquet(folder)
            written = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(folder)
            # A null identifier is a key as well, so no row goes without a bucket.
            keys.append(written.select(F.lit(table).alias("table"), "bucket", F.coalesce(F.col(_KEYS[table]), F.lit("")).alias("key")))
        all_keys = keys[0].unionByName(keys[1]).unionByName(keys[2]).distinct()
        counts: dict[str, dict[str, int]] = {table: {} for table in _FACT_TABLES}
        for r in all_keys.groupBy("table", "bucket").count().collect():
            counts[r["table"]][str(r["bucket"])] = r["count"]
        sizes = [(t, int(b), filters.words_for(n)) for t, by_bucket in counts.items() for b, n in by_bucket.items()]
        if sizes:
            frame = self.spark.createDataFrame(sizes, "table string, bucket int, words long")
            filters.built(all_keys, ["table", "bucket"], frame).write.parquet(f"{self.path}/filters/segment={name}")
        return counts

    def buckets_of(self, found: Facts, segments: list[dict]) -> dict[str, list[str]]:
        """The folders of each table that may hold any of the facts."""
        hits: dict[str, list[str]] = {table: [] for table in _FACT_TABLES}
        for buckets in {s["buckets"] for s in segments}:
            those = [s for s in segments if s["buckets"] == buckets]
            keys = [
                getattr(found, table).select(
                    F.lit(table).alias("table"), self._bucket(table, buckets).alias("bucket"),
                    F.coalesce(F.col(_KEYS[table]), F.lit("")).alias("key"),
                )
                for table in _FACT_TABLES
            ]
            keys = keys[0].unionByName(keys[1]).unionByName(keys[2]).distinct()
            asking = {(r["table"], r["bucket"]): r["count"] for r in keys.groupBy("table", "bucket").count().collect()}
            sizes = []
            for s in those:
                for table, by_bucket in s["keys"].items():
                    for bucket, n in by_bucket.items():
                        asked = asking.get((table, int(bucket)), 0)
                        if asked > self.ASKED:
                            hits[table].append(f"segment={s['name']}/bucket={bucket}")
                        elif asked:
                            sizes.append((s["name"], table, int(bucket), filters.words_for(n)))
            if sizes:
                frame = self.spark.createDataFrame(sizes, "segment string, table string, bucket int, words long")
                names = sorted({f"segment={segment}" for segment, *_ in sizes})
                stored = self._read("filters", names, _FILTERS)
                for r in filters.may_hold(keys, ["table", "bucket"], frame, stored).collect():
                    hits[r["table"]].append(f"segment={r['segment']}/bucket={r['bucket']}")
        return hits

    def held(self, found: Facts, segments: list[dict]) -> Facts:
        """Of what the store holds, the buckets that may hold any of the facts."""
        folders = self.buckets_of(found, segments)
        return Facts(*[self._read(n, folders[n], _FACT_TABLES[n]) for n in ("records", "authored", "person")])

    def compact(self) -> None:
        """Make one segment of all; to be called now and then, where many small pushes have made many."""
        while True:
            version, segments = self._segments()
            if len(segments) < 2 or any("stream" in s for s in segments):
                return
            held = self.facts()
            if self._append(version, [], held, {}):
                return


_FILTERS = T.StructType(
    [
        T.StructField("segment", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("word", T.LongType()),
        T.StructField("bits", T.LongType()),
    ]
)


class ProcessStore(_Store):
    def activities(self) -> DataFrame:
        _, segments = self._segments()
        return self._read("activity", [f"push={s['name']}" for s in segments], config.ACTIVITY_SCHEMA)

    def push_json(
        self, path: str | list[str], lines: bool = False, key: str = config.ACTIVITY_KEY
    ) -> None:
        self.push(read_activity_json(self.spark, path, lines, key))

    def push(self, rows: DataFrame, label: str | None = None) -> None:
        """Add the valid activities, also if equal ones are stored already.

        Each push is a folder of its own, written as one job and then committed. Pushing again under the same label
        replaces it, so a retried push counts once.
        """
        valid = activities_from(rows).select(*config.ACTIVITY_COLUMNS)
        segment = {"name": uuid.uuid4().hex, "label": label}
        # Equal activities are many where a source repeats itself, so they are not dealt by contents.
        valid.sortWithinPartitions("refersTo", "class", "start").write.parquet(f"{self.path}/activity/push={segment['name']}")
        while True:
            version, segments = self._segments()
            others = [s for s in segments if label is None or s["label"] != label]
            if self.log.commit(version + 1, {"segments": [*others, segment]}):
                return
