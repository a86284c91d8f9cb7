"""Landed API responses: unwrap envelopes, unite pages and entities, flatten records.

A landed response is one row with the response body as JSON text; records stay JSON
text until a mapping or ``flatten_records`` gives them columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeshelf.operators.mapping import _quoted

# Keys that may hold the records of a response, in order of preference.
RESPONSE_KEYS = ("data", "results", "routes", "features", "items")
PAGE_KEYS = ("data", "results", "routes", "features")

RECORD = "record"


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per landed response file: ``body`` and the file's name."""
    return spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(
        F.col("value").alias("body"), F.col("_metadata.file_name").alias("_source_file")
    )


def _is_list(body: Column) -> Column:
    return F.ltrim(body).startswith("[")


def split_broken(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Rows whose body is a JSON object or list, and the others (no JSON, a bare value, nothing).

    An error page that landed in place of a response is no record.
    """
    text = F.col(body)
    sound = F.coalesce(F.try_parse_json(text).isNotNull() & F.ltrim(text).rlike(r"^[\[{]"), F.lit(False))
    return df.where(sound), df.where(~sound)


def _with_candidates(df: DataFrame, body: str, keys: Sequence[str]) -> DataFrame:
    """Add ``__top`` (records of a top-level list) and ``__lists`` (a struct with the list
    under each key, null where there is none).

    Each body is parsed once: only the parse that fits its first character runs, since
    a parse that fails costs far more than one that succeeds.
    """
    text = F.col(body)
    fields = ", ".join(f"{_quoted(k)} array<string>" for k in keys)
    return df.withColumns({
        "__top": F.when(_is_list(text), F.from_json(text, "array<string>")),
        "__lists": F.when(~_is_list(text), F.from_json(text, fields)),
    })


def with_response_records(df: DataFrame, body: str = "body", keys: Sequence[str] = RESPONSE_KEYS) -> DataFrame:
    """Replace the body by ``__records``: a top-level list, the first key that holds a
    list, or else the whole object as one record."""
    found = [F.col("__lists").getField(k) for k in keys]
    records = F.coalesce(F.col("__top"), *found, F.array(F.col(body)))
    return _with_candidates(df, body, keys).withColumn("__records", records).drop(body, "__top", "__lists")


def with_page_records(df: DataFrame, body: str = "body", keys: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """The same for a page, but there the first key that is *present* decides: a null
    under it is an empty page, and any other value is one record."""
    nothing = F.array().cast("array<string>")
    chosen = F.array(F.col(body))
    for key in reversed(keys):
        held = F.col("__lists").getField(key)
        single = F.get_json_object(body, f"$.{key}")
        other = F.when(F.array_contains(F.json_object_keys(body), key), F.when(
            single.isNotNull(), F.array(single)).otherwise(nothing))
        chosen = F.coalesce(held, other, chosen)
    return (
        _with_candidates(df, body, keys)
        .withColumn("__records", F.coalesce(F.col("__top"), chosen))
        .drop(body, "__top", "__lists")
    )


def unwrap_responses(df: DataFrame, body: str = "body", keys: Sequence[str] = RESPONSE_KEYS) -> DataFrame:
    """One row per record of every response."""
    others = [_quoted(c) for c in df.columns if c != body]
    return _one_row_each(with_response_records(df, body, keys).select(*others, "__records"))


def _one_row_each(df: DataFrame) -> DataFrame:
    """Explode ``__records``; null records are left out.

    The outer form with a filter behind it: before a plain ``explode`` Spark puts a filter
    on the size of the list and evaluates the whole parse once more for it.
    """
    rows = df.withColumn(RECORD, F.explode_outer("__records")).drop("__records")
    return rows.where(F.col(RECORD).isNotNull())


def _may_be_empty(text: Column) -> Column:
    """False where a look at the text shows that it holds a record, without a parse: a page with none has an empty list or a null in it,
    or a text that reads like a list (between quotes, or written with escapes)."""
    marks = ["[]", "[ ", "[\t", "[\n", "[\r", "null", "\\", '"[', "'[", " ["]
    return reduce(lambda a, b: a | b, [text.contains(m) for m in marks])


def _with_empty(df: DataFrame, body: str, keys: Sequence[str]) -> DataFrame:
    """Replace the body by ``__empty``: whether the page has no records. Those are the top-level list, or what the first
    present key holds (a null is none, any other value is one record); else the page itself is one.

    The list is only counted, its records aren't parsed; each value that several conditions look at is taken from the body once."""
    text, others = F.col(body), [_quoted(c) for c in df.columns if c != body]
    looked = F.when(_may_be_empty(text) | _is_list(text), text).alias("__text")
    text = F.col("__text")
    held = first = None
    for key in reversed(keys):
        has, value = F.array_contains("__keys", key), F.get_json_object(text, f"$.{key}")
        held = F.when(has, value) if held is None else F.when(has, value).otherwise(held)
        first = F.when(has, True) if first is None else F.when(has, True).otherwise(first)
    listed = F.when(_is_list(text), text).when(_is_list(F.col("__held")), F.col("__held"))
    return (
        df.select(*others, looked)
        .withColumn("__keys", F.when(~_is_list(text), F.json_object_keys(text)))
        .withColumns({"__held": held, "__first": first})
        .withColumn("__empty", F.when(listed.isNotNull(), F.json_array_length(listed) == 0).otherwise(
            F.coalesce(F.col("__first") & F.col("__held").isNull(), F.lit(False))))
        .select(*others, "__empty")
    )


def unite_pages(
    pages: DataFrame,
    entity: Sequence[str] = (),
    page_no: str = "page_no",
    body: str = "body",
    max_pages: int | None = None,
    keys: Sequence[str] = PAGE_KEYS,
    end_at: str = "empty number",
) -> DataFrame:
    """Records of the pages of every entity, from 1 to ``max_pages`` (all, if not given), up to its first
    empty page.

    A body that landed twice under its number counts once (with the further columns that sort first as JSON);
    different bodies under one number all stand. A number is empty if all of its bodies are; with ``end_at="empty body"`` one
    empty body among them is enough to end the entity there.

    The first empty page comes from an aggregate over entities, page numbers and whether pages are empty; a null entity is an
    entity like any other. Records are parsed only after the pages behind it are cut off, and an
    entity with very many pages is never gathered in one task.
    """
    if end_at not in ("empty number", "empty body"):
        raise ValueError(f"unknown end {end_at!r}")
    inside = F.col(page_no) >= 1
    if max_pages is not None:
        inside = inside & (F.col(page_no) <= max_pages)
    wanted = pages.where(inside)
    place = [*entity, page_no]
    more = [c for c in wanted.columns if c not in (*place, body)]
    if more:
        further = F.struct(*map(_quoted, more))
        once = wanted.groupBy(*place, body).agg(F.min_by(further, F.to_json(further)).alias("__more"))
        once = once.select(*place, body, *[F.col("__more").getField(c).alias(c) for c in more]).select(*map(_quoted, wanted.columns))
    else:
        once = wanted.distinct()
    # a body that landed twice changes no end, so the pages aren't brought together by their bodies for this
    sizes = _with_empty(wanted.select(*place, body), body, keys)
    if end_at == "empty number":
        sizes = sizes.groupBy(*place).agg(F.every("__empty").alias("__empty"))
    ends = sizes.groupBy(*entity).agg(F.min(F.when(F.col("__empty"), F.col(page_no))).alias("__stop"))
    if entity:
        same = None
        ends = ends.withColumnsRenamed({e: f"__{e}" for e in entity})
        for e in entity:
            match = once[e].eqNullSafe(ends[f"__{e}"])
            same = match if same is None else same & match
        limited = once.join(ends, same)
    else:
        limited = once.withColumn("__stop", ends.scalar())
    kept = limited.where(F.col("__stop").isNull() | (F.col(page_no) < F.col("__stop"))).select(*map(_quoted, once.columns))
    return _one_row_each(with_page_records(kept, body, keys))


def missing_pages(
    pages: DataFrame, entity: Sequence[str] = (), page_no: str = "page_no", max_pages: int | None = None
) -> DataFrame:
    """Entities whose landed pages have a gap. A gap is a failed request, not the end of
    the data, so a load must not go on over it."""
    inside = F.col(page_no) >= 1
    if max_pages is not None:
        inside = inside & (F.col(page_no) <= max_pages)
    seen = pages.where(inside).groupBy(*entity).agg(
        F.max(page_no).alias("last_page"), F.count_distinct(page_no).alias("n_pages")
    )
    return seen.where(F.col("last_page") != F.col("n_pages"))


# ---- records to columns ---------------------------------------------------


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to top-level columns with dotted names; arrays stay as they are."""

    def leaves(prefix: Column | None, name: str, field: T.StructField) -> list[Column]:
        here = F.col(_quoted(field.name)) if prefix is None else prefix.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            return [c for f in field.dataType.fields for c in leaves(here, f"{name}.{f.name}", f)]
        return [here.alias(name)]

    return df.select(*[c for f in df.schema.fields for c in leaves(None, f.name, f)])


def _readable(kind: T.DataType) -> T.DataType:
    """A type of inferred JSON with text in place of what has no type of its own; names stay as they are."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|[A-Za-z_]\w*(?=<)")


def infer_record_schema(df: DataFrame, record: str = RECORD) -> T.StructType:
    """Type of the records, from one distributed pass over them."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(record)).alias("s")).first()["s"]
    if found is None or not found.startswith("OBJECT"):
        raise ValueError(f"the records are no JSON objects: {found}")
    # an object's type is a struct's, by another word; quoted names are stepped over
    ddl = _TYPE_WORD.sub(lambda m: "STRUCT" if m[0] == "OBJECT" else m[0], found)
    return _readable(_parsed_type(df.sparkSession, ddl))


def _parsed_type(spark: SparkSession, ddl: str) -> T.DataType:
    return spark.range(0).select(F.from_json(F.lit(None).cast("string"), f"v {ddl}").alias("j")).schema["j"].dataType["v"].dataType


def flatten_records(df: DataFrame, record: str = RECORD, schema: str | T.StructType | None = None) -> DataFrame:
    """Records with dotted columns. Without a schema it is inferred in an extra pass."""
    schema = schema or infer_record_schema(df, record)
    others = [F.col(_quoted(c)) for c in df.columns if c != record]
    return flatten(df.select(*others, F.from_json(record, schema).alias("__r")).select(*others, "__r.*"))
