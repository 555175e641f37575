"""Landed JSON: cubes, page collections, region trees and indicator documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from terraloom import schemas
from terraloom.functions.columns import split_levels, to_int, to_number, to_utc
from terraloom.session import cut_lineage, materialise

_CUBE = ("id array<string>, dimension map<string, struct<category: struct<"
         "index: array<string>, label: map<string, string>>>>, value array<string>")


def parse_cubes(df: DataFrame, text: str = "value") -> DataFrame:
    """Cube documents as ``dims, codes, labels, raw``; a malformed cube has no dimensions."""
    keep = [c for c in df.columns if c != text]
    doc = df.select(*keep, F.from_json(text, _CUBE).alias("d"))
    at = lambda k: F.try_element_at(F.col("d.dimension"), k)["category"]
    codes = F.transform("d.id", lambda k: at(k)["index"])
    whole = (F.col("d.value").isNotNull() & F.col("d.id").isNotNull()
             & ~F.exists(codes, lambda c: c.isNull()))
    return doc.select(
        *keep,
        F.when(whole, F.col("d.id")).otherwise(F.array().cast("array<string>")).alias("dims"),
        codes.alias("codes"),
        F.transform("d.id", lambda k: F.coalesce(
            at(k)["label"], F.create_map().cast("map<string,string>"))).alias("labels"),
        F.col("d.value").alias("raw"))


def scan_cube(spark: SparkSession, path: str) -> DataFrame:
    """Cube files, one document per file."""
    return parse_cubes(spark.read.text(path, wholetext=True))


_VALUES = r'(?<!\\)"value"\s*:\s*\['
_PLAIN_VALUE = r'^\s*(?:[^"]*|"(?:[^"\\]|\\.)*")\s*$'


def scan_cube_values(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Cube files of any size, one document per file, read by byte ranges.

    Returns the cubes (``path, dims, codes, labels, found``: the number of their values) and the
    values (``path, pos, text``). A file is cut at its commas, so Spark deals its byte ranges over
    tasks like those of a text file. The pieces are written once when the plan is built, and so are the
    small tables that join them, a row a file or a byte range, whose sizes are then known; the values are those from the
    key ``value`` to the first closing bracket, and a value's place is the number of values in the
    ranges before it plus its place in its own, so nothing is sorted. What a document holds besides
    its values (axes, labels) is one row. A malformed cube, or one without a list of values, has no
    dimensions. A file with several lists called ``value``, and a text value that holds a comma,
    raise an error; :func:`scan_cube` reads such documents whole.
    """
    pieces = materialise(spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece")), "cube-pieces")
    here = F.struct("start", "at")
    marks = pieces.filter(F.col("piece").rlike(_VALUES)).groupBy("path").agg(
        F.min(here).alias("opens"), F.sum(F.regexp_count("piece", F.lit(_VALUES))).alias("lists"))
    opened = pieces.filter(F.contains("piece", F.lit("]"))).join(marks, "path")
    after = F.when(here == F.col("opens"), F.regexp_replace("piece", f"^[\\s\\S]*?{_VALUES}", "")).otherwise(F.col("piece"))
    section = materialise(marks.join(
        opened.filter((here >= F.col("opens")) & F.contains(after, F.lit("]"))).groupBy("path").agg(F.min(here).alias("closes")),
        "path").withColumn("opens", F.when(F.col("lists") == 1, F.col("opens")).otherwise(
            F.raise_error(F.concat(F.lit("several lists of values in "), "path")))).drop("lists"), "cube-sections")
    placed = pieces.join(section, "path", "left").withColumns({
        "inside": F.coalesce((here >= F.col("opens")) & (here <= F.col("closes")), F.lit(False)),
        "first": here == F.col("opens"), "last": here == F.col("closes")})

    head = F.when(F.col("first"), F.regexp_extract("piece", f"^([\\s\\S]*?{_VALUES})", 1)).otherwise(F.lit(""))
    tail = F.when(F.col("last"), F.regexp_extract(after, r"(\][\s\S]*)$", 1)).otherwise(F.lit(""))
    text = F.when(F.col("inside"), F.concat(head, tail)).otherwise(F.col("piece"))
    rest = placed.filter(~F.col("inside") | F.col("first") | F.col("last")).groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("start", "at", F.col("inside").alias("inside"), text.alias("text")))).alias("texts"))
    # Pieces meet at a comma again, but for the two that the values stood between.
    document = F.aggregate("texts", F.struct(F.lit("").alias("doc"), F.lit(False).alias("open")), lambda acc, t: F.struct(
        F.concat(acc["doc"], F.when((acc["doc"] == "") | (acc["open"] & t["inside"]), F.lit("")).otherwise(F.lit(",")), t["text"]).alias("doc"),
        t["inside"].alias("open")))["doc"]
    parsed = materialise(parse_cubes(rest.select("path", document.alias("doc")), "doc").drop("raw"), "cube-axes")

    bare = F.when(F.col("last"), F.regexp_replace(after, r"\][\s\S]*$", "")).otherwise(after)
    inside = placed.filter("inside").select("path", "start", "at", "first", "last", bare.alias("text")).filter(
        ~(F.col("first") & F.col("last") & (F.trim(F.regexp_replace("text", r"\s", "")) == "")))
    ranges = inside.groupBy("path", "start").agg(F.min("at").alias("begins"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(ranges.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))), "cube-ranges")
    plain = F.regexp_replace("text", r"^\s+|\s+$", "")
    value = F.when(~F.col("text").rlike(_PLAIN_VALUE), F.raise_error(F.concat(F.lit("a text value with a comma in "), "path")).cast("string")).when(
        plain != "null", F.when(F.startswith(plain, F.lit('"')), F.from_json(F.concat(F.lit("["), plain, F.lit("]")), "array<string>")[0]).otherwise(plain))
    values = inside.join(offsets, ["path", "start"]).select("path", (F.col("offset") + F.col("at") - F.col("begins")).alias("pos"), value.alias("text"))
    counts = offsets.groupBy("path").agg(F.sum("n").alias("found"))
    return parsed.join(counts, "path", "left").withColumn("found", F.coalesce("found", F.lit(0))), values


def read_pages(spark: SparkSession, path: str, limit: int = 1000, schema: T.StructType | None = None,
               number: str = r"(\d+)[^/\d]*$") -> DataFrame:
    """Records of landed pages in page order, up to the first empty or short page.

    A page is a file that holds one JSON array and whose path has the page's number or offset
    where ``number`` says, by default as the last digits of its name. Numbers count from 0 or 1;
    offsets are multiples of ``limit`` from 0. Spark does not list files without content, so a
    missing number after the first page is an empty page. A text that is no JSON array, a number
    that two files share, and a missing (or empty) first page are errors and raise. Page sizes
    are one small row a page; they are checked when the plan is built. Records keep the text form
    they were landed in.
    """
    return read_page_streams(spark, path, None, limit, schema, number).drop("stream")


def read_page_streams(spark: SparkSession, path: str, stream: str | None, limit: int = 1000, schema: T.StructType | None = None,
                      number: str = r"(\d+)[^/\d]*$") -> DataFrame:
    """Records of many landed streams as ``stream, page, position`` and the record's columns, in one job.

    ``stream`` is a pattern whose group names a page's stream in its path; without one all pages are
    one stream. Each stream follows the rules of :func:`read_pages` by itself. The sizes of all pages
    are written once, and both the checks and the ends of the streams come from them by aggregates.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return page_streams(files, stream, limit, schema, number)


def page_streams(landed: DataFrame, stream: str | None, limit: int = 1000, schema: T.StructType | None = None,
                 number: str = r"(\d+)[^/\d]*$") -> DataFrame:
    """:func:`read_page_streams` of pages landed as rows ``path, value``.

    A folder takes a listing, an open file and a rename for every page; many small pages are better kept in one table.
    """
    record = schema or T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.RENT.fields])
    where = F.col("path")
    pages = landed.select(
        (F.regexp_extract(where, stream, 1) if stream else F.lit("")).alias("stream"),
        F.regexp_extract(where, number, 1).try_cast("long").alias("page"),
        F.when(F.col("value").rlike(r"^\s*\[[\s\S]*\]\s*$"), F.from_json("value", T.ArrayType(record), {"mode": "PERMISSIVE"})).alias("records"),
        F.try_parse_json(F.concat(F.lit('{"v":'), "value", F.lit("}"))).isNull().alias("malformed"))  # inside an object, a second text is an error
    sizes = materialise(pages.select("stream", "page", F.size("records").alias("n"), (F.col("malformed") | F.col("records").isNull()).alias("bad")), "page-sizes")
    streams = sizes.groupBy("stream").agg(
        F.min("page").alias("first"), F.every(F.col("page") % limit == 0).alias("offsets"), F.count_if("bad").alias("bad"),
        F.min(F.when(F.col("bad"), F.col("page"))).alias("worst"), F.count("page").alias("pages"), F.count_distinct("page").alias("numbers"),
        F.count_if(F.col("page").isNull()).alias("unnamed")).withColumn("step", F.when(F.col("offsets"), limit).otherwise(1))
    late = F.col("first") > F.when(F.col("step") > 1, 0).otherwise(1)
    wrong = streams.where((F.col("bad") > 0) | (F.col("pages") != F.col("numbers")) | (F.col("unnamed") > 0) | late).orderBy("stream").first()
    if wrong:
        of = f" of stream {wrong['stream']}" if stream else ""
        if wrong["bad"]:
            raise ValueError(f"{wrong['bad']} pages{of} hold no single JSON array, the first is page {wrong['worst']}")
        if wrong["pages"] != wrong["numbers"] or wrong["unnamed"]:
            raise ValueError(f"pages{of} without a number of their own")
        raise ValueError(f"the first page{of} is missing: numbers begin at {wrong['first']}")
    stepped = sizes.join(streams.select("stream", "step"), "stream")
    follows = stepped.select("stream", (F.col("page") - F.col("step")).alias("page"), F.lit(True).alias("follows"))
    ends = stepped.join(follows, ["stream", "page"], "left").filter(
        (F.col("n") < limit) | F.col("follows").isNull()).groupBy("stream").agg(F.min("page").alias("stop"))
    kept = pages.join(ends, "stream").filter(F.col("page") <= F.col("stop"))
    return kept.select("stream", "page", F.posexplode("records").alias("position", "r")).select("stream", "page", "position", "r.*")


def flatten_tree(df: DataFrame, col: str, scheme: str, root: str = "$.fitxes.v") -> DataFrame:
    """Distinct sorted ids of all nodes of one scheme, at any depth of JSON region trees.

    Children are a list or one object. Each level is one lateral explode over the level above and
    is computed once, materialised; the loop ends at the first level without nodes.
    """
    level = df.select(F.try_variant_get(F.try_parse_json(F.col(col)), root, "variant").alias("v"))
    found = None
    while True:
        nodes = cut_lineage(level.select(_children("v")).select(F.explode("nodes").alias("n")))
        here = nodes.filter(F.try_variant_get("n", "$.scheme", "string") == scheme).select(
            F.try_variant_get("n", "$.id", "string").alias("id"))
        found = here if found is None else found.unionByName(here)
        level = nodes.select(F.try_variant_get("n", "$.v", "variant").alias("v")).filter("v is not null")
        if nodes.isEmpty():
            return found.filter("id is not null").distinct().orderBy("id")


def _children(v: str) -> Column:
    """Array of child nodes from a list of them or a single one."""
    one = F.schema_of_variant(F.col(v)).startswith("OBJECT")
    listed = F.try_variant_get(v, "$", "array<variant>")
    return F.when(one, F.array(F.col(v))).otherwise(
        F.coalesce(listed, F.array().cast("array<variant>"))).alias("nodes")


def flatten_indicators(df: DataFrame, id_col: str = "municipality_id", col: str = "value") -> DataFrame:
    """Indicator rows of one JSON document per municipality, typed and in landing order.

    Entries with an ``error``, or without id or value, are left out. Names come from the
    document's column headers, which are a list or a single object.
    """
    field = lambda path: F.try_variant_get("doc", path, "variant")
    as_text = lambda path: F.to_json(field(path))
    headers = as_text("$.fitxes.cols.col")
    entries = as_text("$.fitxes.indicadors.i")
    maps = "array<map<string,string>>"
    doc = df.select(F.col(id_col).alias("municipality_id"), F.try_parse_json(F.col(col)).alias("doc"))
    parsed = doc.select(
        "municipality_id",
        F.from_json(F.when(F.startswith(headers, F.lit("{")), F.concat(F.lit("["), headers, F.lit("]")))
                    .otherwise(headers), maps).alias("heads"),
        F.from_json(F.when(F.startswith(entries, F.lit("[")), entries), maps).alias("entries"))

    def name(scheme: str) -> Column:
        key = lambda m, *names: F.coalesce(*[F.try_element_at(m, F.lit(n)) for n in names])
        named = F.filter("heads", lambda m: key(m, "@scheme", "scheme") == scheme)
        return key(F.try_element_at(named, F.lit(-1)), "#content", "content", "c")

    at = lambda k: F.try_element_at("e", F.lit(k))
    rows = (parsed.select("municipality_id", name("mun").alias("municipality_name"),
                          name("com").alias("comarca_name"), F.explode("entries").alias("e"))
            .filter(~F.map_contains_key("e", "error") & at("id").isNotNull() & at("v").isNotNull()))
    values = rows.select(
        "municipality_id", "municipality_name", "comarca_name",
        at("id").alias("indicator_id"), at("c").alias("indicator_name"),
        to_int(at("r")).cast("long").alias("reference_year"),
        *split_levels(at("v")), to_utc(at("updated")).alias("source_update_timestamp"))
    return values.withColumns({
        c: to_number(c) for c in ("municipality_value", "comarca_value", "catalunya_value")})
