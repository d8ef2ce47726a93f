"""Fixed schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


LONG, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
STRING, BOOL, TIME = T.StringType(), T.BooleanType(), T.TimestampNTZType()

#: One row per post: stories, comments and other kinds in one wide table.
ITEMS = _struct(
    id=LONG,
    type=STRING,
    by=STRING,
    time=TIME,
    text=STRING,
    title=STRING,
    url=STRING,
    score=LONG,
    descendants=LONG,
    parent=LONG,
    top_level_parent=LONG,
    dead=BOOL,
    deleted=BOOL,
    kids=T.ArrayType(LONG),
)

REWARD_PAIRS = _struct(
    chosen=LONG,
    rejected=LONG,
    chosen_rank=INT,
    rejected_rank=INT,
    top_level_parent=LONG,
    split=STRING,
)

PREDICTIONS = _struct(id=LONG, predictions=DOUBLE)

#: One generated title and its figures, inside a nested result document.
MODEL_RESULT = _struct(
    generated_title=STRING,
    score=DOUBLE,
    api_time=DOUBLE,
    total_time=DOUBLE,
    full_response=STRING,
    error=STRING,
)

NESTED_RESULTS = _struct(
    item_id=LONG,
    original_title=STRING,
    original_score=LONG,
    rm_score_original=DOUBLE,
    scraped_body=STRING,
    model_results=T.MapType(STRING, MODEL_RESULT),
)

#: Append-only log behind the keyed result table.
RESULT_LOG = _struct(
    arg_hash=STRING,
    result=STRING,
    evicted=BOOL,
    version=LONG,
    fn_id=STRING,
    hash_part=STRING,
)

#: A request to score a story under a title; the time is ISO text.
SCORE_REQUEST = T.StructType(
    [
        T.StructField("title", STRING, False),
        T.StructField("by", STRING, False),
        T.StructField("time", STRING, False),
        T.StructField("scraped_body", STRING, False),
        T.StructField("url", STRING, True),
    ]
)

CHAT_MESSAGE = _struct(role=STRING, content=STRING)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail early when a table lacks a column or holds it with another type."""
    found = {field.name: field.dataType for field in df.schema.fields}
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {found[field.name].simpleString() if field.name in found else 'nothing'}"
        for field in schema.fields
        if found.get(field.name) != field.dataType
    ]
    if wrong:
        raise TypeError("table does not match its schema: " + "; ".join(wrong))
    return df
