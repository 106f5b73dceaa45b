"""Activity files: objects with one nested document per activity.

``[{"object id": "1", "acquisition": {"responsible institute": ..., "tool": [...]}, ...}, ...]``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import config
from tessera import functions as fn
from tessera.sources.records import Effect, read_records

_DOCUMENT = "map<string,string>"


def read_activity_json(
    spark: SparkSession,
    path: str | list[str],
    lines: bool = False,
    key: str = config.ACTIVITY_KEY,
) -> DataFrame:
    """Raw activity rows, one per object and known activity.

    A file holds one JSON array, or one document, which counts as an array of one, or with ``lines`` one
    document per line. All are split between tasks, arrays by ``read_records``. A file that is not JSON fails the job.
    """
    if lines:
        text = spark.read.text(path).filter(F.trim("value") != "")
        documents = text.select(_strict("value", _DOCUMENT).alias("document"))
    else:
        documents = read_documents(spark, path).select(_strict("text", _DOCUMENT).alias("document"))
    return activities_from_documents(documents, key)


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The texts of the documents in files of one array, or of one document, each; nulls in an array are none."""
    records = read_records(spark, path, "}", _braces)
    listed = F.coalesce(F.col("sign") == "[", F.lit(False))
    between = F.regexp_extract("text", r"^([^{]*+)", 1)
    first, later = r"^\s*\[\s*(?:null\s*,\s*)*+$", r"^\s*,\s*(?:null\s*,\s*)*+$"
    sound = F.when(listed, F.when(F.col("leads"), between.rlike(first)).otherwise(between.rlike(later)) & ~F.col("final"))
    sound = sound.otherwise(F.col("leads") & ~between.rlike(r"\S"))
    # What follows the last document, or an array without any.
    rest = F.when(listed & F.col("leads"), F.col("text").rlike(r"^\s*\[\s*(?:null\s*(?:,\s*null\s*)*+)?+\]\s*$"))
    rest = rest.when(listed, F.col("text").rlike(r"^\s*(?:,\s*null\s*)*+\]\s*$")).otherwise(~F.col("text").rlike(r"\S"))
    wrong = F.raise_error(F.concat(F.lit("[MALFORMED_RECORD_IN_PARSING] not an array of JSON documents: "), F.col("file"))).cast("string")
    document = F.substring(F.col("text"), F.length(between) + 1, F.length("text"))
    checked = F.when(F.col("ended"), F.when(sound, document).otherwise(wrong)).otherwise(
        F.when(rest, F.lit(None).cast("string")).otherwise(wrong)
    )
    return records.select(checked.alias("text")).filter(F.col("text").isNotNull())


def _braces(piece: Column) -> Effect:
    """Strings and braces of a piece of JSON; the brace that ends it can't be escaped, nor can what follows."""
    plain = F.when(F.contains(piece, F.lit("\\")), F.regexp_replace(piece, r"(?s)\\.", "")).otherwise(piece)

    def count(text: Column, sign: str) -> Column:
        return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))

    def opened(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("{")), count(F.regexp_replace(text, r'"[^"]*+"?+', ""), "{")).otherwise(0)

    odd = count(plain, '"') % 2 == 1

    return Effect(
        from_out=odd,
        from_in=~odd,
        rise_out=opened(plain) - F.when(odd, 0).otherwise(1),
        rise_in=opened(F.regexp_replace(plain, r'^[^"]*+"?+', "")) - F.when(odd, 1).otherwise(0),
    )


def _strict(c: str, schema: str) -> Column:
    return F.from_json(c, schema, {"mode": "FAILFAST"})


def activities_from_documents(documents: DataFrame, key: str = config.ACTIVITY_KEY) -> DataFrame:
    """Documents, as maps from key to JSON text, -> raw activity rows.

    Keys match whatever their case; of keys that repeat, the last stands. Activities with an
    unknown name are left out here, which is where validation would drop them. A field that is
    not text is taken as its JSON text.
    """
    entries = documents.select(_last_per_key("document").alias("document"))
    kinds = F.array(
        *[
            F.struct(
                F.lit(kind).alias("class"),
                _value("document", kind.lower()).alias("body"),
            )
            for kind in config.ACTIVITY_CLASSES
        ]
    )
    bodies = F.filter(kinds, lambda k: k["body"].isNotNull())
    long_form = entries.select(
        _value("document", key.lower()).alias("refersTo"), F.explode(bodies).alias("activity")
    )
    parsed = long_form.select(
        "refersTo",
        "activity.class",
        F.from_json("activity.body", _DOCUMENT).alias("fields"),
    ).withColumn("fields", _last_per_key("fields"))
    values = {model: _value("fields", raw) for raw, model in config.ACTIVITY_FIELDS.items()}
    flat = parsed.select("class", "refersTo", *[v.alias(model) for model, v in values.items()])
    return flat.withColumn("tool", fn.tools_from_json("tool")).select(*config.ACTIVITY_COLUMNS)


def _last_per_key(c: str) -> Column:
    """Entries of a map with lower-case keys, last first, so that a lookup finds the last."""
    lowered = F.transform(
        F.map_entries(c), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    return F.reverse(lowered)


def _value(c: str, key: str) -> Column:
    """Value of the first entry with the key, null if there is none."""
    return F.get(F.filter(F.col(c), lambda e: e["key"] == key), 0)["value"]
