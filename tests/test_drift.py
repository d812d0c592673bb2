import json

from wellspring.operators.drift import canonical, consistent_names, count_lines, fuse, read_entries, schema_changes, union_types
from wellspring.plans.problems import CHANNEL_CODES

SCHEMA = "raw_id long, feed string, file_seq int, record string, field string"


def lines(files, feed="f"):
    out, n = [], 0
    for seq, rows in files:
        for r in rows:
            n += 1
            out.append((n, feed, seq, r if isinstance(r, str) or r is None else json.dumps(r), "clash"))
    return out


def changes(spark, rows):
    found = schema_changes(read_entries(spark.createDataFrame(rows, SCHEMA), "record", "img", CHANNEL_CODES))
    return sorted((r.file_seq, r.field, r.change) for r in found.select("file_seq", "field", "change").collect())


def test_every_kind_of_change(spark):
    files = [
        (1, [{"img": "a", "plate": "04", "ch": "Mito", "x": 1.5}, {"img": "b", "plate": "04", "ch": "ER", "x": None}, "{broken"]),
        (2, [{"img": "b", "plate_no": 4, "ch": "ER", "x": 2.5}, {"img": "c", "plate_no": 4, "ch": "Syto", "x": 3.0}]),
        (4, [{"img": "c", "plate_no": 4, "ch": 4, "note": "ok"}, {"img": "d", "plate_no": 5, "ch": 6, "note": None}]),
        (5, [{"img": "d", "plate_no": 5, "ch": 6, "x": "7"}]),
        (5, [{"img": "d", "plate_no": 5, "ch": 6, "x": "7"}]),
    ]
    assert changes(spark, lines(files)) == [
        (2, "plate", "renamed"), (2, "plate", "retyped"), (4, "ch", "retyped"), (4, "note", "added"), (4, "x", "removed"), (5, "note", "removed"), (5, "x", "added")]


def test_rename_keeps_and_removal_ends_the_known_type(spark):
    files = [
        (1, [{"img": "a", "k": "v", "n": 1}]),
        (2, [{"img": "a", "kk": "v", "n": None}]),  # renamed
        (3, [{"img": "a", "kk": None, "n": None}]),
        (4, [{"img": "a", "kk": True, "n": 1.0}]),  # both retyped against what was known
        (5, [{"img": "a"}]),
        (6, [{"img": "a", "kk": "s"}]),  # no retype: the removal ended it
    ]
    assert changes(spark, lines(files)) == [(2, "k", "renamed"), (4, "kk", "retyped"), (4, "n", "retyped"), (5, "kk", "removed"), (5, "n", "removed"), (6, "kk", "added")]


def test_chain_of_renames_without_values(spark):
    files = [(1, [{"img": "a", "p": 1}, {"img": "b", "p": 2}]), (2, [{"img": "b", "q": 2}]), (3, [{"img": "b", "r": 2}]), (4, [{"img": "b", "r": "2"}])]
    assert changes(spark, lines(files)) == [(2, "p", "renamed"), (3, "q", "renamed"), (4, "r", "retyped")]


def test_nothing_to_report(spark):
    assert changes(spark, []) == []
    assert changes(spark, [(1, "f", 1, None, "c"), (2, None, 1, "{}", "c"), (3, "f", None, "{}", "c"), (4, "f", 2, "[1]", "c")]) == []
    assert changes(spark, lines([(1, [{"img": "a", "k": 1}, {"img": "a", "k": 1}])])) == []


def test_canonical_content():
    assert canonical("04") == canonical(4) == canonical(4.0)
    assert canonical(["a.png"]) == canonical(" a.png ")
    assert canonical("Hoechst", CHANNEL_CODES) == canonical(6, CHANNEL_CODES) and canonical("Hoechst") == "Hoechst"
    assert canonical(True) != canonical(1)
    assert canonical(None) is None and canonical([]) is None and canonical(True) == canonical("true")


def test_fused_table_has_typed_branches(spark):
    rows = lines([(1, [{"img": "a", "plate": "04"}]), (2, [{"img": "b", "plate_no": 4}]), (3, [{"img": "c", "plate_no": [4]}])])
    out = {r.img.value: r.plate for r in fuse(read_entries(spark.createDataFrame(rows, SCHEMA), "record", "img"), {"img": ["img"], "plate": ["plate", "plate_no"]}).collect()}
    assert [out[k].tag for k in "abc"] == ["string", "integer", "array"]
    assert [out[k].value for k in "abc"] == ["4.0"] * 3
    assert out["a"].as_string == "04" and out["b"].as_integer == 4 and out["c"].as_array == ["4"]


def test_fused_table_keeps_every_field_under_its_consistent_name(spark):
    files = [
        (1, [{"img": "a", "plate": "04", "expo": 7}, {"img": "b", "plate": "05", "expo": 8}]),
        (2, [{"img": "a", "plate_id": 4, "exposure_ms": 7}, {"img": "b", "plate_id": 5, "exposure_ms": 8}]),
        (3, [{"img": "c", "plate_id": 6, "exposure_ms": 9, "plate": 1, "note": "x"}, {"img": "d", "plate_id": 7, "exposure_ms": 10, "note": None}]),
    ]
    entries = read_entries(spark.createDataFrame(lines(files), SCHEMA), "record", "img")
    names = {"img": ["img"], "plate": ["plate"]}
    out = {(r.file_seq, r.img.value): r for r in fuse(entries, names, consistent_names(entries, schema_changes(entries), names)).collect()}
    assert out[1, "a"].plate.value == out[2, "a"].plate.value == "4.0"
    assert out[1, "a"].other["exposure_ms"].value == out[2, "a"].other["exposure_ms"].value == "7.0"
    last = out[3, "c"]
    assert {last.plate.value, last.other["plate"].value} == {"6.0", "1.0"} and last.other["note"].value == "x"
    assert "note" in out[3, "d"].other and out[3, "d"].other["note"].tag is None


def test_types_of_nested_paths_and_unreadable_lines(spark):
    rows = lines([(1, [{"a": {"b": 1, "c": [1, "x"]}}, "{broken", "[1]", None]), (2, [{"a": {"b": "1"}, "d": []}])])
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.field, r.tag): (r.n, r.first_file, r.last_file) for r in union_types(read_entries(df, "record", "img", nested=True)).collect()}
    assert got == {
        ("a", "object"): (2, 1, 2), ("a.b", "integer"): (1, 1, 1), ("a.b", "string"): (1, 2, 2), ("a.c", "array"): (1, 1, 1), ("a.c[]", "integer"): (1, 1, 1), ("a.c[]", "string"): (1, 1, 1), ("d", "array"): (1, 2, 2)}
    assert {(r.file_seq, r.n_lines, r.n_unreadable) for r in count_lines(df, "record").collect()} == {(1, 4, 3), (2, 1, 0)}


def test_renames_without_common_items_follow_the_values(spark):
    """Files without a common image: keys with mostly equal sets of several values are one key renamed."""
    files = [(1, [{"img": f"a{i}", "lens": f"x{i % 3}", "k": 1} for i in range(6)]), (2, [{"img": f"b{i}", "objective": f"x{i % 3}", "m": 1} for i in range(6)])]
    assert changes(spark, lines(files)) == [(2, "k", "removed"), (2, "lens", "renamed"), (2, "m", "added")]
