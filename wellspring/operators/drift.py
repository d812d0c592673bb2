"""Schemas that drift between files: one consistent table and a report of changes.

Tagged-union inference: the parallel schemas of all files are fused per path and
every alternative JSON type of a path is retained.  Conflicts are split into
typed branches (``as_string``, ``as_number`` ...) beside a canonical conversion,
and every alternative that appears, goes, moves to another key or changes type
is reported per feed and file.
"""

from __future__ import annotations

import json
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.operators.graph import components
from wellspring.session import cut

TAGS = ("string", "boolean", "integer", "number", "array", "object")


def _tag(v) -> str | None:
    """The union's tag of a JSON value; null has none."""
    if v is None:
        return None
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "integer"
    if isinstance(v, float):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(v)]


def canonical(v, codes: dict[str, float] | None = None) -> str | None:
    """One text for equal content whatever its type: ``"04"``, 4 and 4.0; ``["a"]`` and ``"a"``; ``"true"`` and true.

    ``codes`` gives the numbers that stand for names (in lower case).
    """
    if isinstance(v, list) and len(v) == 1:
        v = v[0]
    if v is None or v == []:
        return None
    if isinstance(v, (list, dict)):
        return json.dumps(v, sort_keys=True, ensure_ascii=False)
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, str):
        text = v.strip()
        low = text.lower()
        if low in ("true", "false"):
            return low
        if codes and low in codes:
            return str(float(codes[low]))
        try:
            return str(float(text)) if text[:1] in "+-.0123456789" and text else text
        except ValueError:
            return text
    try:
        return str(float(v))
    except OverflowError:
        return str(v)


def _paths(key: str, v, nested: bool):
    """The value under its path; with ``nested`` also what objects (``a.b``) and arrays (``a[]``) hold."""
    stack = [(key, v)]
    while stack:
        path, value = stack.pop()
        yield path, value
        if nested and isinstance(value, dict):
            stack += [(f"{path}.{k}", x) for k, x in value.items()]
        elif nested and isinstance(value, list):
            stack += [(f"{path}[]", x) for x in value]


def _line(text: str | None) -> dict | None:
    """The JSON object of a line; None if it is unreadable or no object."""
    try:
        line = json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        return None
    return line if isinstance(line, dict) else None


ENTRY = "raw_id long, feed string, file_seq int, item string, field string, tag string, canon string, value string"


def read_entries(files: DataFrame, record: str, item_key: str, codes: dict[str, float] | None = None, nested: bool = False) -> DataFrame:
    """One row per field of every readable JSON object line; with ``nested`` one per path.

    ``item`` is the value of ``item_key``, which identifies what a line
    describes.  Unreadable lines, lines that are no object, null records and
    rows without feed or ``file_seq`` give no rows (:func:`count_lines` counts
    them); of a key repeated within a line the last value counts.  Integers of
    any size are read.  ``codes``: see :func:`canonical`.
    """
    rows = files.filter("feed is not null and file_seq is not null").select(F.col("raw_id").cast("long").alias("raw_id"), "feed", F.col("file_seq").cast("int").alias("file_seq"), F.col(record).alias("record")).filter("record is not null")

    def parse(batches):
        for b in batches:
            at, item, field, tag, canon, value = [], [], [], [], [], []
            for i, text in enumerate(b.column("record").to_pylist()):
                line = _line(text)
                if line is None:
                    continue
                name = line.get(item_key)
                name = None if name is None else str(name)
                for key in line:
                    for k, v in _paths(key, line[key], nested):
                        at.append(i), item.append(name), field.append(k), tag.append(_tag(v)), canon.append(canonical(v, codes))
                        value.append(None if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("raw_id", "feed", "file_seq")), *(pa.array(x, pa.string()) for x in (item, field, tag, canon, value))],
                names=["raw_id", "feed", "file_seq", "item", "field", "tag", "canon", "value"],
            )

    return rows.mapInArrow(parse, ENTRY)


def count_lines(files: DataFrame, record: str) -> DataFrame:
    """``feed, file_seq, n_lines, n_unreadable``: lines per file and those that give no rows (null, unreadable, no object)."""

    def judge(batches):
        for b in batches:
            bad = [_line(text) is None for text in b.column("record").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("feed"), b.column("file_seq"), pa.array(bad, pa.bool_())], names=["feed", "file_seq", "bad"])

    rows = files.select("feed", F.col("file_seq").cast("int").alias("file_seq"), F.col(record).alias("record"))
    return rows.mapInArrow(judge, "feed string, file_seq int, bad boolean").groupBy("feed", "file_seq").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("bad").alias("n_unreadable"))


def union_types(entries: DataFrame) -> DataFrame:
    """``feed, field, tag, n, first_file, last_file``: every alternative type of every path, with where it appears (null: no value)."""
    return entries.groupBy("feed", "field", "tag").agg(F.count(F.lit(1)).alias("n"), F.min("file_seq").alias("first_file"), F.max("file_seq").alias("last_file"))


def _likeness(a: str, b: str) -> Column:
    clean = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    return F.levenshtein(clean(a), clean(b))


def schema_changes(entries: DataFrame) -> DataFrame:
    """Every change between a file and the nearest earlier file of its feed.

    ``feed, file_seq, field, change, new_field, old_tag, new_tag`` with change
    one of added, removed, renamed, retyped.  A file delivered twice counts once.
    A field is in a file if a readable line has its key.  Renamed: a removed
    key's content, in canonical form, equals a new key's content on every item
    that both files describe and that has both values; without such items the
    two files' sets of values must mostly agree.  Of several possible partners
    the one with most agreeing items, then the most similar name, is taken, each
    key once.  Retyped: the tag of the non-null values (the most frequent one,
    then the first by name) differs from the last known tag, which a rename
    carries on and a removal ends.

    Lines are read once, into hashes of items and contents, and reduced to fields
    per file before any window; windows run over files of a feed and field only,
    never over lines.
    """
    hashed = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c)
    entries = cut(entries.select("feed", "file_seq", "field", "tag", hashed("item"), hashed("canon")))
    per_tag = entries.groupBy("feed", "file_seq", "field", "tag").agg(F.count(F.lit(1)).alias("n"))
    present = cut(
        per_tag.groupBy("feed", "file_seq", "field").agg(
            F.max_by("tag", F.when(F.col("tag").isNotNull(), F.struct("n", F.struct(F.translate("tag", "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba"))))).alias("tag")
        )
    )
    files = present.select("feed", "file_seq").distinct()
    order = Window.partitionBy("feed").orderBy("file_seq")
    files = files.withColumn("ix", F.row_number().over(order)).withColumn("next_seq", F.lead("file_seq").over(order))
    files = cut(files)
    here = present.join(files, ["feed", "file_seq"])
    by_field = Window.partitionBy("feed", "field").orderBy("ix")
    before, after = F.lag("ix").over(by_field), F.lead("ix").over(by_field)
    here = here.withColumn("opens", (F.coalesce(before, F.lit(-1)) != F.col("ix") - 1)).withColumn("closes", F.coalesce(after, F.lit(-1)) != F.col("ix") + 1)
    here = cut(here.withColumn("segment", F.sum(F.col("opens").cast("int")).over(by_field)))

    gone = here.filter("closes and next_seq is not null").select("feed", "ix", F.col("field").alias("old"), "segment", F.col("file_seq").alias("old_seq"), F.col("next_seq").alias("file_seq"))
    come = here.filter("opens and ix > 1").select("feed", (F.col("ix") - 1).alias("ix"), F.col("field").alias("new"), F.col("segment").alias("new_segment"))
    pairs = cut(gone.join(come, ["feed", "ix"]))

    # content of the candidate fields only, one row per item
    wanted = pairs.select("feed", F.col("old_seq").alias("file_seq"), F.col("old").alias("field")).union(pairs.select("feed", "file_seq", F.col("new").alias("field"))).distinct()
    left = right = cut(entries.filter("canon is not null").select("feed", "file_seq", "field", "item", "canon").join(wanted, ["feed", "file_seq", "field"], "left_semi"))
    one = lambda df, seq, name, c: df.groupBy("feed", F.col("file_seq").alias(seq), F.col("field").alias(name), "item").agg(F.max("canon").alias(c))
    a, b = one(left, "old_seq", "old", "x"), one(right, "file_seq", "new", "y")
    shared = pairs.join(a.filter("item is not null"), ["feed", "old_seq", "old"]).join(b.filter("item is not null"), ["feed", "file_seq", "new", "item"])
    shared = shared.groupBy("feed", "ix", "old", "new").agg(F.count(F.lit(1)).alias("both"), F.sum((F.col("x") == F.col("y")).cast("int")).alias("equal"))
    # without shared items: how far the two sets of values agree
    lonely = cut(pairs.select("feed", "ix", "old", "new", "old_seq", "file_seq").join(shared, ["feed", "ix", "old", "new"], "left_anti"))
    key = ["feed", "ix", "old", "new"]
    va = lonely.join(a.select("feed", "old_seq", "old", "x").distinct(), ["feed", "old_seq", "old"]).select(*key, F.col("x").alias("v"), F.lit(1).alias("left"), F.lit(0).alias("right"))
    vb = lonely.join(b.select("feed", "file_seq", "new", "y").distinct(), ["feed", "file_seq", "new"]).select(*key, F.col("y").alias("v"), F.lit(0).alias("left"), F.lit(1).alias("right"))
    met = va.unionByName(vb).groupBy(*key, "v").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    met = met.groupBy(*key).agg(F.sum("left").alias("n_left"), F.sum(F.col("left") * F.col("right")).alias("n_both"), F.count(F.lit(1)).alias("n_any"))
    lonely = met.filter((F.col("n_both") / F.col("n_any") >= 0.5) & (F.col("n_left") > 1)).select(*key, F.lit(0).alias("equal"))
    fits = shared.filter("both = equal").select("feed", "ix", "old", "new", F.col("equal").cast("int").alias("equal")).unionByName(lonely)
    rank = [F.col("equal").desc(), _likeness("old", "new"), F.col("old"), F.col("new")]
    open_fits, chosen = cut(fits), []
    while True:  # each pass settles at least one pair of every file; fields of one file are few
        best = open_fits.withColumn("a", F.row_number().over(Window.partitionBy("feed", "ix", "old").orderBy(*rank))).withColumn("b", F.row_number().over(Window.partitionBy("feed", "ix", "new").orderBy(*rank)))
        best = cut(best.filter("a = 1 and b = 1").select("feed", "ix", "old", "new"))
        if best.isEmpty():
            break
        chosen.append(best)
        open_fits = cut(open_fits.join(best.select("feed", "ix", "old"), ["feed", "ix", "old"], "left_anti").join(best.select("feed", "ix", "new"), ["feed", "ix", "new"], "left_anti"), looping=True)
    renames = reduce(DataFrame.unionByName, chosen) if chosen else fits.select("feed", "ix", "old", "new").limit(0)
    renames = cut(pairs.join(renames, ["feed", "ix", "old", "new"]))

    # last known tag within a stretch of files, then carried over renames
    stretch = Window.partitionBy("feed", "field", "segment").orderBy("ix")
    known = here.withColumn("prior", F.last("tag", ignorenulls=True).over(stretch.rowsBetween(Window.unboundedPreceding, -1)))
    ends = here.filter("tag is not null").groupBy("feed", "field", "segment").agg(F.max_by("tag", "ix").alias("last_tag"))
    link = renames.select("feed", F.col("new").alias("field"), F.col("new_segment").alias("segment"), F.col("old").alias("from_field"), F.col("segment").alias("from_segment"))
    carried = link.join(ends.select("feed", F.col("field").alias("from_field"), F.col("segment").alias("from_segment"), F.col("last_tag").alias("carry")), ["feed", "from_field", "from_segment"], "left")
    carried = cut(carried)
    while True:  # a renamed field without any value passes on what it was given
        up = carried.select("feed", F.col("field").alias("from_field"), F.col("segment").alias("from_segment"), F.col("carry").alias("up"), F.col("from_field").alias("up_field"), F.col("from_segment").alias("up_segment"))
        if carried.filter("carry is null").join(up, ["feed", "from_field", "from_segment"], "left_semi").isEmpty():
            break
        stepped = carried.join(up, ["feed", "from_field", "from_segment"], "left")
        empty = F.col("carry").isNull() & F.col("up_field").isNotNull()
        carried = cut(stepped.select("feed", "field", "segment", F.when(empty, F.col("up_field")).otherwise(F.col("from_field")).alias("from_field"), F.when(empty, F.col("up_segment")).otherwise(F.col("from_segment")).alias("from_segment"), F.coalesce("carry", "up").alias("carry")), looping=True)
    known = known.join(carried.select("feed", "field", "segment", "carry"), ["feed", "field", "segment"], "left")
    last = F.coalesce("prior", "carry")
    retyped = known.filter(F.col("tag").isNotNull() & (last != F.col("tag"))).select("feed", "file_seq", "ix", "field", last.alias("old_tag"), F.col("tag").alias("new_tag"))
    old_name = renames.select("feed", (F.col("ix") + 1).alias("ix"), F.col("new").alias("field"), "old")
    retyped = retyped.join(old_name, ["feed", "ix", "field"], "left").select("feed", "file_seq", F.coalesce("old", "field").alias("field"), F.lit("retyped").alias("change"), F.col("field").alias("new_field"), "old_tag", "new_tag")

    none = F.lit(None).cast("string")
    report = lambda df, field, change, new: df.select("feed", "file_seq", F.col(field).alias("field"), F.lit(change).alias("change"), new.alias("new_field"), none.alias("old_tag"), none.alias("new_tag"))
    removed = gone.join(renames.select("feed", "ix", "old"), ["feed", "ix", "old"], "left_anti")
    starts = here.filter("opens and ix > 1").select("feed", "file_seq", (F.col("ix") - 1).alias("ix"), F.col("field").alias("new"))
    added = starts.join(renames.select("feed", "ix", "new"), ["feed", "ix", "new"], "left_anti")
    return reduce(DataFrame.unionByName, [report(renames, "old", "renamed", F.col("new")), report(removed, "old", "removed", none), report(added, "new", "added", F.col("new")), retyped])


def consistent_names(entries: DataFrame, changes: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """``field, name``: one consistent name for every key, following the renames of ``changes`` in any direction.

    Keys in ``names`` keep their name there.  Other keys take the name of the
    listed keys that their renames lead to, if it is only one; else, together
    with the unlisted keys they are linked with, the one on most lines.  Keys that
    differ in case and signs only are linked like renames.
    """
    spark = entries.sparkSession
    listed = spark.createDataFrame([(old, new) for new, olds in names.items() for old in olds], "field string, listed string")
    fields = cut(entries.groupBy("field").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(listed), "field", "left"))
    renames = changes.filter("change = 'renamed'").select(F.lit("all").alias("grp"), F.col("field").alias("label_a"), F.col("new_field").alias("label_b"), F.lit(1.0).alias("similarity")).distinct()
    plain = fields.select("field", F.lower(F.regexp_replace("field", "[^A-Za-z0-9]", "")).alias("plain"))
    alike = plain.join(plain.groupBy("plain").agg(F.min("field").alias("first")), "plain").filter("field <> first")
    renames = renames.unionByName(alike.select(F.lit("all").alias("grp"), F.col("first").alias("label_a"), F.col("field").alias("label_b"), F.lit(1.0).alias("similarity")))
    nodes = fields.select(F.lit("all").alias("grp"), F.col("field").alias("label"))
    linked = fields.join(components(nodes, renames).select(F.col("label").alias("field"), "component"), "field")
    of_set = linked.groupBy("component").agg(F.count_distinct("listed").alias("k"), F.max("listed").alias("only"), F.max_by(F.when(F.col("listed").isNull(), F.col("field")), F.when(F.col("listed").isNull(), F.struct("n", "field"))).alias("most"))
    return cut(linked.join(of_set, "component").select("field", F.coalesce("listed", F.when(F.col("k") == 1, F.col("only")), "most").alias("name")))


def fuse(entries: DataFrame, names: dict[str, list[str]], known_names: DataFrame | None = None) -> DataFrame:
    """All lines as one table: one name and one canonical type per field.

    ``names`` lists for each consistent name the keys it had, ``known_names``
    (``field, name``) has the names of further keys.  Fields that are not in
    ``names``, and the further keys of a line with several keys of one name, are
    in the map ``other`` by name.  Every field comes as a struct: ``value`` (canonical text), the union's ``tag`` and the typed
    branches ``as_string``, ``as_boolean``, ``as_integer``, ``as_number``,
    ``as_array`` (null where another alternative holds).  One row per line.
    """
    branch = F.create_map(*[x for new, olds in names.items() for old in olds for x in (F.lit(old), F.lit(new))])
    listed = F.try_element_at(branch, F.col("field"))
    if known_names is None:
        known = entries.withColumn("name", F.coalesce(listed, F.col("field")))
    else:
        known = entries.join(F.broadcast(known_names), "field", "left").withColumn("name", F.coalesce(listed, F.col("name"), F.col("field")))
    cell = F.struct(
        F.col("canon").alias("value"), "tag",
        F.when(F.col("tag") == "string", F.col("value")).alias("as_string"),
        F.when(F.col("tag") == "boolean", F.col("value").try_cast("boolean")).alias("as_boolean"),
        F.when(F.col("tag") == "integer", F.col("value").try_cast("long")).alias("as_integer"),
        F.when(F.col("tag") == "number", F.col("value").try_cast("double")).alias("as_number"),
        F.when(F.col("tag") == "array", F.from_json("value", "array<string>")).alias("as_array"),
    )
    line = ["raw_id", "feed", "file_seq"]
    cells = known.withColumn("cell", cell).groupBy(*line, "name", "field").agg(F.max_by("cell", F.col("tag").isNotNull()).alias("cell"))
    inside = F.col("name").isin(list(names))
    order = [(~inside & (F.col("field") == F.col("name"))).desc(), F.col("cell.tag").isNotNull().desc(), F.col("field").desc()]
    cells = cells.withColumn("r", F.row_number().over(Window.partitionBy(*line, "name").orderBy(*order))).withColumn("main", inside & (F.col("r") == 1))
    rest = F.when(~F.col("main"), F.struct(F.when(F.col("r") == 1, F.col("name")).otherwise(F.col("field")).alias("key"), F.col("cell").alias("value")))
    return cells.groupBy(*line).agg(*[F.first(F.when(F.col("main") & (F.col("name") == n), F.col("cell")), ignorenulls=True).alias(n) for n in names], F.map_from_entries(F.collect_list(rest)).alias("other"))
