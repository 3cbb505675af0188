"""Drift-tolerant JSON parsing: schema inference (S2), rescue mode (S3), schema store.

Every line is parsed once into a VARIANT. Known fields are read from it with
``try_variant_get`` (so ``"123.45"`` still yields 123.45 for a double field);
keys outside the schema, and known keys whose JSON type is not the expected one,
are kept as a JSON object string in ``_rescued_data``. Malformed lines give a
NULL variant and are routed to the quarantine column ``_corrupt_record``.
Nothing is dropped and no row is lost.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.stores import CommitLog
from tidemark.session import path_exists

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"

# JSON value categories accepted for each Spark type (schema_of_variant names).
_NUMERIC = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT")


def _accepted_kinds(dt: T.DataType) -> tuple[str, ...]:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                       T.FloatType, T.DoubleType, T.DecimalType)):
        return _NUMERIC
    if isinstance(dt, T.BooleanType):
        return ("BOOLEAN",)
    if isinstance(dt, (T.StructType, T.MapType)):
        return ("OBJECT",)
    if isinstance(dt, T.ArrayType):
        return ("ARRAY",)
    if isinstance(dt, T.StringType):
        # any scalar reads losslessly as its text (as Spark's JSON reader does)
        return ("STRING", "BOOLEAN") + _NUMERIC
    # dates and timestamps arrive as JSON strings
    return ("STRING",)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _path(names: tuple[str, ...]) -> str:
    return "$" + "".join(f".{n}" if n.replace("_", "").isalnum() else f"['{n}']" for n in names)


def _at(v: Column, names: tuple[str, ...], kind: str = "variant") -> Column:
    return F.try_variant_get(v, _path(names), kind)


def _kind(v: Column, names: tuple[str, ...]) -> Column:
    """Leading word of the variant type at a path (VOID for JSON null, empty if absent)."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(_at(v, names)), r"^([A-Z]+)", 1), F.lit(""))


def _fields(schema: T.StructType, under: tuple[str, ...] = ()):
    """(path, type) of every field, the fields of nested structs behind their struct."""
    for f in schema.fields:
        names = (*under, f.name)
        yield names, f.dataType
        if isinstance(f.dataType, T.StructType):
            yield from _fields(f.dataType, names)


def _label(names: tuple[str, ...]) -> str:
    return ".".join(f"['{n}']" if "." in n else n for n in names)


def _lossy(v: Column, names: tuple[str, ...], dt: T.DataType, kind: Column) -> Column:
    """Whether the typed value does not hold all of the source value: another JSON type, a failed or
    overflowing cast, or a fraction cut off. (A number in a string still gives the typed value.)"""
    typed = _at(v, names, dt.simpleString())
    wrong = ~kind.isin(*_accepted_kinds(dt))
    if not isinstance(dt, T.StructType):
        wrong = wrong | typed.isNull()
        if isinstance(dt, (*_INTEGRAL, T.DecimalType)):
            wrong = wrong | F.coalesce(_at(v, names, "double") != typed.cast("double"), F.lit(False))
    return ~kind.isin("", "VOID") & wrong


def _typed(v: Column, kinds: dict, names: tuple[str, ...], dt: T.DataType) -> Column:
    if not isinstance(dt, T.StructType):
        return _at(v, names, dt.simpleString())
    inner = [_typed(v, kinds, (*names, f.name), f.dataType).alias(f.name) for f in dt.fields]
    return F.when(kinds[names] == "OBJECT", F.struct(*inner))


def rescue_parse(df: DataFrame, schema: T.StructType, value_col: str = "value",
                 keep_value: bool = False) -> DataFrame:
    """Parse a JSON-lines column with a fixed schema in rescue mode.

    Output columns: every schema field, ``_rescued_data`` (JSON object string or
    NULL) and ``_corrupt_record`` (the raw line when it is not valid JSON).
    Other input columns (e.g. file name) are carried through.

    ``_rescued_data`` holds, under dotted paths (a key with a dot in brackets), the unknown keys of the line and
    of its nested objects, and the source value of every known field whose typed value lost something.
    An unknown key holding JSON ``null`` carries no data and is not rescued.

    Cost per line: one JSON parse, one typed extraction and one type probe per
    schema field, one pass over the keys of every object in the schema.
    """
    carried = [c for c in df.columns if c != value_col]
    parsed = df.select(*carried, F.col(value_col), F.try_parse_json(F.col(value_col)).alias("__v"))
    vv = F.col("__v")
    paths = list(_fields(schema))
    probed = parsed.select(*carried, F.col(value_col), vv, *[_kind(vv, names).alias(f"__t{i}") for i, (names, _) in enumerate(paths)])
    kinds = {names: F.col(f"__t{i}") for i, (names, _) in enumerate(paths)}
    lost = F.array(*[F.when(_lossy(vv, names, dt, kinds[names]),
                            F.struct(F.lit(_label(names)).alias("key"), _at(vv, names).alias("value"))) for names, dt in paths])
    top = _at(vv, (), "map<string,variant>")

    def unknown(names: tuple[str, ...], inner: T.StructType) -> Column:
        known = F.array(*[F.lit(f.name) for f in inner.fields]).cast("array<string>")
        found = F.map_filter(F.coalesce(_at(vv, names, "map<string,variant>"), F.map_filter(top, lambda k, x: F.lit(False))),
                             lambda k, x: ~F.array_contains(known, k) & ~F.is_variant_null(x))
        prefix = F.lit(_label(names) + "." if names else "")
        return F.transform_keys(found, lambda k, x: F.concat(
            prefix, F.when(F.contains(k, F.lit(".")), F.concat(F.lit("['"), k, F.lit("']"))).otherwise(k)))

    objects = [((), schema), *[(n, dt) for n, dt in paths if isinstance(dt, T.StructType)]]
    rescued_map = F.map_concat(*[unknown(n, dt) for n, dt in objects], F.map_from_entries(F.array_compact(lost)))
    rescued = F.when(F.size(rescued_map) > 0, F.to_json(rescued_map))
    # a line that is not a JSON object (malformed, or a bare scalar / array) is quarantined whole
    not_object = vv.isNull() | top.isNull()
    return probed.select(
        *carried, *[_typed(vv, kinds, (f.name,), f.dataType).alias(f.name) for f in schema.fields], rescued.alias(RESCUED),
        F.when(not_object, F.col(value_col)).alias(CORRUPT),
        *([F.col(value_col)] if keep_value else []),
    )


def infer_schema(spark: SparkSession, path: str, sample_ratio: float = 1.0, pattern: str = "*") -> T.StructType:
    """One-off batch inference over JSON files (nested structs included).

    Inference reads the files once; at scale pass ``sample_ratio`` < 1.
    """
    return (spark.read.option("samplingRatio", sample_ratio).option("pathGlobFilter", pattern)
            .option("mode", "DROPMALFORMED").json(path).schema)


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    """Persist a schema as one JSON line beside the checkpoint (works on any Hadoop FS)."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1) \
        .write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """Read a stored schema back; None when nothing was stored yet."""
    if not path_exists(spark, location):
        return None
    row = spark.read.text(location).first()
    return T.StructType.fromJson(json.loads(row[0])) if row else None


def resolve_schema(spark: SparkSession, location: str, sample_path: str | None = None,
                   default: T.StructType | None = None, pattern: str = "*") -> T.StructType:
    """Stored schema if present; else infer from ``sample_path`` (or use ``default``) and store it."""
    stored = load_schema(spark, location)
    if stored is not None:
        return stored
    schema = default if default is not None else infer_schema(spark, sample_path, pattern=pattern)
    save_schema(spark, schema, location)
    return schema


# ---------------------------------------------------------------- schema that grows with the files

# how the types of JSON values are read: fractions as double, values of no or of several types as text
_READ_AS = (("OBJECT<", "STRUCT<"), (r"DECIMAL(\(\d+, ?\d+\))?", "DOUBLE"), (r"\b(VOID|VARIANT|FLOAT)\b", "STRING"))


def variant_type(described: str) -> T.DataType:
    """Spark type of what ``schema_of_variant_agg`` describes."""
    for pattern, by in _READ_AS:
        described = re.sub(pattern, by, described)
    return T.DataType.fromDDL(described)


def _fits(kept: T.DataType, found: T.DataType) -> bool:
    """Whether values of ``found`` are read into ``kept`` without loss."""
    if kept == found:
        return True
    if isinstance(kept, T.StringType):
        return not isinstance(found, (T.StructType, T.ArrayType, T.MapType))
    return isinstance(kept, T.DoubleType) and isinstance(found, (T.LongType, T.IntegerType))


def merge_schemas(kept: T.StructType, found: T.StructType, under: tuple[str, ...] = ()) -> tuple[T.StructType, list[dict]]:
    """``kept`` with the fields that only ``found`` has, at every level, and what was noticed.

    Known fields keep their type, as files written with it are there: a field found with a type that does not
    fit is noted as ``kept`` (its values are rescued, not lost), a new field as ``added``.
    """
    fields, notes = list(kept.fields), []
    at = {f.name: i for i, f in enumerate(fields)}
    for f in found.fields:
        label = _label((*under, f.name))
        if f.name not in at:
            fields.append(T.StructField(f.name, f.dataType, True))
            notes.append({"field": label, "change": "added", "kept": None, "found": f.dataType.simpleString()})
            continue
        have = fields[at[f.name]].dataType
        if isinstance(have, T.StructType) and isinstance(f.dataType, T.StructType):
            inner, more = merge_schemas(have, f.dataType, (*under, f.name))
            fields[at[f.name]] = T.StructField(f.name, inner, True)
            notes += more
        elif not _fits(have, f.dataType):
            notes.append({"field": label, "change": "kept", "kept": have.simpleString(), "found": f.dataType.simpleString()})
    return T.StructType(fields), notes


class SchemaStore:
    """The schema of a source of JSON lines, kept beside a stream's checkpoint and grown with the files.

    ``update`` looks at the files modified since the last one, each file's schema from one aggregate over its
    lines, and merges them into the stored schema in the files' order. Every version and what changed in which
    file is an entry of a commit log.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.log = spark, CommitLog(spark, location)

    def schema(self) -> T.StructType | None:
        last = self.log.last()
        return T.StructType.fromJson(json.loads(last["schema"])) if last else None

    def changes(self) -> DataFrame:
        """``version, file, field, change, kept, found`` of all versions."""
        rows = [(v, n["file"], n["field"], n["change"], n["kept"], n["found"]) for v in self.log.versions() for n in self.log.entry(v)["notes"]]
        return self.spark.createDataFrame(rows, "version int, file string, field string, change string, kept string, found string")

    def update(self, source_dir: str, pattern: str = "*") -> T.StructType:
        """Merge the new files in; returns the schema to read with."""
        last = self.log.last()
        lines = (self.spark.read.option("pathGlobFilter", pattern).text(source_dir)
                 .select("value", F.col("_metadata.file_path").alias("file"), F.unix_micros("_metadata.file_modification_time").alias("at")))
        if last:
            lines = lines.where(F.col("at") > last["newest"])
        v = F.try_parse_json("value")
        found = (lines.select("file", "at", v.alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
                 .groupBy("file").agg(F.schema_of_variant_agg("v").alias("described"), F.max("at").alias("at")).collect())
        schema = self.schema() or T.StructType([])
        notes, newest = [], last["newest"] if last else -1
        for r in sorted(found, key=lambda r: (r["at"], r["file"])):
            schema, more = merge_schemas(schema, variant_type(r["described"]))
            notes += [{"file": r["file"].rsplit("/", 1)[-1], **n} for n in more]
            newest = max(newest, r["at"])
        if last is None or newest > last["newest"]:
            self.log.publish(last["version"] + 1 if last else 0, schema=schema.json(), notes=notes, newest=newest)
        return schema
