"""Schemas of the tables and documents the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

TRIPLE_COLUMNS = ("company_guid", "column_name", "column_value")

TRIPLE = T.StructType(
    [
        T.StructField("company_guid", T.StringType(), True, {"comment": "Company the value belongs to"}),
        T.StructField("column_name", T.StringType(), True, {"comment": "Table.Column the value was seen in"}),
        T.StructField("column_value", T.StringType(), True, {"comment": "The value as it was seen"}),
    ]
)

DAY_TRIPLE = T.StructType([*TRIPLE.fields, T.StructField("ds", T.DateType(), True)])

PRODUCT = T.StructType(
    [T.StructField("barcode", T.StringType()), T.StructField("name", T.StringType())]
)

CUSTOM_PRODUCT = T.StructType(
    [
        *PRODUCT.fields,
        T.StructField("source", T.StringType()),
        T.StructField("createdBy", T.StringType()),
        T.StructField("createdAt", T.StringType()),
    ]
)

# The list of products entered by hand, as it is stored.
CUSTOM_LIST = T.StructType(
    [
        *PRODUCT.fields,
        T.StructField("source", T.StringType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("seq", T.LongType()),
    ]
)

_CHILD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
    ]
)

RULES = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("uncategorizedLabel", T.StringType()),
        T.StructField(
            "categories",
            T.ArrayType(T.StructType([*_CHILD.fields, T.StructField("children", T.ArrayType(_CHILD))])),
        ),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("barcode", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("qty", T.LongType()),
        T.StructField("addedAt", T.StringType()),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("person", T.StringType()),
        T.StructField("submittedAt", T.StringType()),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)

SAVED_RECORD = T.StructType([*RECORD.fields, T.StructField("savedAt", T.StringType())])
