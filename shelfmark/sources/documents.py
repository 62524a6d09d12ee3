"""JSON documents: catalogs, rule sets and record logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark.functions.text import trimmed
from shelfmark.schemas import CUSTOM_PRODUCT, ITEM, PRODUCT, RULES, SAVED_RECORD
from shelfmark.sources.files import exists
from shelfmark.sources.storage import empty


def read_catalog(spark: SparkSession, path: str, schema: StructType = PRODUCT) -> DataFrame:
    """A JSON array of products; ``seq`` is the position in the document."""
    products = spark.read.schema(schema).option("multiLine", True).json(path)
    # One JSON document is one task, so the generated ids count up along it.
    return products.withColumn("seq", F.monotonically_increasing_id())


def read_custom_products(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of products entered by hand; a missing file gives no row."""
    if not exists(spark, path):
        return _renamed(empty(spark, CUSTOM_PRODUCT).withColumn("seq", F.lit(0).cast("bigint")))
    return _renamed(read_catalog(spark, path, CUSTOM_PRODUCT))


def _renamed(custom: DataFrame) -> DataFrame:
    return custom.withColumnsRenamed({"createdBy": "created_by", "createdAt": "created_at"})


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule-set documents, one row each; a missing file gives no row."""
    if not exists(spark, path):
        return empty(spark, RULES)
    return spark.read.schema(RULES).option("multiLine", True).json(path)


# Column of a read record: the JSON of its items as they are, with all fields and values of any kind.
BODY = "body"


_VALUE = "_value"


def _with_value(lines: DataFrame, line: str) -> DataFrame:
    """Adds the JSON of each line that is not blank, NULL if it is none.

    As the outcome of an explode the JSON is parsed once a line: the optimizer would move a plain column into every
    field that is taken from it, and parse the line anew for each.
    """
    lines.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    value = F.explode_outer(F.array(F.try_parse_json(trimmed(line))))
    return lines.where(trimmed(line) != "").withColumn(_VALUE, value)


def _fields() -> list[Column]:
    """The fields of a record. Those of other kinds than they should be are NULL."""
    value = F.col(_VALUE)

    def item(each: Column) -> Column:
        # By way of text, so that 0.5 is no whole number rather than 0.
        fields = [F.try_variant_get(each, f"$.{f.name}", "string").try_cast(f.dataType).alias(f.name) for f in ITEM]
        return F.when(F.try_variant_get(each, "$", "string").isNotNull() | ~F.is_variant_null(each), F.struct(*fields))

    def field(name: str) -> Column:
        if name == "items":
            return F.transform(F.try_variant_get(value, "$.items", "array<variant>"), item)
        return F.try_variant_get(value, f"$.{name}", "string")

    body = F.to_json(F.try_variant_get(value, "$.items", "variant"))
    return [*[field(f.name).alias(f.name) for f in SAVED_RECORD], body.alias(BODY)]


def parse_records(lines: DataFrame, line: str) -> DataFrame:
    """Record lines held in a text column: ``record``, and ``is_malformed`` for lines that are no JSON.

    Blank lines are left out. Any JSON is a record, whatever fields it has; :data:`BODY` keeps its items as they
    are. If an object repeats a key, the last one counts; the session takes such JSON from now on.
    """
    parsed = _with_value(lines, line)
    record = F.when(F.col(_VALUE).isNotNull(), F.struct(*_fields()))
    return parsed.withColumns({"record": record, "is_malformed": F.col(_VALUE).isNull()}).drop(_VALUE)


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A JSON-lines record log, in one path or several, without blank and malformed lines; a missing file gives no row.

    Lines are read as text and judged whole, so the rows are the same whichever columns are asked for. Only the fields
    that are asked for are taken out of them.
    """
    path = [p for p in ([path] if isinstance(path, str) else path) if exists(spark, p)]
    if not path:
        return empty(spark, SAVED_RECORD).withColumn(BODY, F.lit(None).cast("string"))
    parsed = _with_value(spark.read.text(path), "value")
    return parsed.where(F.col(_VALUE).isNotNull()).select(*_fields())


def malformed_records(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a record log that :func:`read_records` leaves out as malformed."""
    parsed = parse_records(spark.read.text(path), "value")
    return parsed.where("is_malformed").select(F.col("value").alias("line"))


def append_records(records: DataFrame, path: str) -> None:
    """Append records as JSON lines; text outside ASCII stays as it is.

    Records that were read, and so have a :data:`BODY`, are written with it: free fields of items and odd values
    come back as they were.
    """
    if BODY not in records.columns:
        records.write.mode("append").json(path)
        return
    plain = F.to_json(F.struct(*[c for c in records.columns if c not in ("items", BODY)]))
    items = F.coalesce(F.concat(F.lit('"items":'), F.coalesce(BODY, F.to_json("items"))), F.lit(""))
    between = F.when((F.length(plain) > 2) & (F.length(items) > 0), ",").otherwise("")
    line = F.concat(F.regexp_replace(plain, r"\}$", ""), between, items, F.lit("}"))
    records.select(line.alias("value")).write.mode("append").text(path)
