import random

import pytest
from pyspark.sql import functions as F

from obsengine.operators.tablediff.columns import column_changes
from obsengine.operators.tablediff.compare import (
    TablesDiffer,
    assert_no_diff,
    diff_columns,
    diff_rows,
    diff_summary,
    unequal_summary,
)
from obsengine.operators.tablediff.context import (
    drop_blank_rows,
    near_or_edge,
    prune_columns,
    with_context,
    with_positions,
)
from obsengine.operators.tablediff.equality import Equality
from obsengine.operators.tablediff.keyless import KeylessRules, diff_keyless, pick_columns
from obsengine.operators.tablediff.merge import (
    diff3,
    merge3,
    three_way_patch,
    with_conflict_texts,
)
from obsengine.operators.tablediff.neighbours import link_neighbours
from obsengine.operators.tablediff.patch import apply_patch, schema_rows, with_schema_rows
from tests.conftest import rows

SCHEMA = "k int, v string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def actions(diff):
    return sorted((r.action, r.k) for r in diff.collect())


@pytest.mark.parametrize("unique", [True, False])
def test_actions(spark, unique):
    left = frame(spark, [(1, "a"), (2, "b"), (3, None), (4, None), (None, "n")])
    right = frame(spark, [(1, "a"), (2, "c"), (3, None), (4, "x"), (5, "e"), (None, "m")])
    diff = diff_rows(left, right, ["k"], keys_unique=unique)
    assert {(r.action, r.k, r.old_v, r.new_v) for r in diff.collect()} == {
        ("->", 2, "b", "c"),
        ("->", 4, None, "x"),
        ("+++", 5, None, "e"),
        ("->", None, "n", "m"),
    }


def actions_repr(diff):
    return sorted(repr((r.action, r.k)) for r in diff.collect())


def test_repeated_keys_stand_alone(spark):
    left = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (None, "x"), (None, "y"), (3, "s")])
    right = frame(spark, [(1, "a"), (2, "b"), (2, "c"), (None, "x"), (3, "t")])
    assert actions_repr(diff_rows(left, right, ["k"])) == sorted(
        map(
            repr,
            [("---", 1), ("---", 1), ("+++", 1), ("---", 2), ("+++", 2), ("+++", 2)]
            + [("---", None), ("---", None), ("+++", None), ("->", 3)],
        )
    )


def test_data_in_a_new_column(spark):
    left = frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    right = frame(spark, [(1, "a", "n"), (2, "b", ""), (3, "d", "n")], SCHEMA + ", extra string")
    assert actions(diff_rows(left, right, ["k"])) == [("+", 1), ("->", 3)]
    assert actions(diff_rows(left, right, ["k"], acts=["column"])) == [("+", 1)]
    assert actions(diff_rows(left, right, ["k"], ignore=["extra", "v"])) == []


def test_equality_options(spark):
    schema = "k int, v string, x double"
    left = frame(spark, [(1, " A", 1.0), (2, "b", 1.0), (3, "c", None), (4, "12", 1.0)], schema)
    right = frame(spark, [(1, "a ", 1.0), (2, "b", 1.005), (3, "c", 1.0), (4, "12.001", 1.0)], schema)
    assert [k for _, k in actions(diff_rows(left, right, ["k"]))] == [1, 2, 3, 4]
    loose = Equality(epsilon=0.01, ignore_whitespace=True, ignore_case=True)
    assert [k for _, k in actions(diff_rows(left, right, ["k"], equality=loose))] == [3]
    # The limit itself is a difference.
    exact = Equality(epsilon=0.5)
    a, b = frame(spark, [(1, "1")]), frame(spark, [(1, "1.5")])
    assert actions(diff_rows(a, b, ["k"], equality=exact)) == [("->", 1)]


def test_text_keys(spark):
    schema = "a string, b string, v int"
    left = frame(spark, [(None, "x", 1), ("null", "y", 1), ("A", "z", 1)], schema)
    right = frame(spark, [("", "x", 2), (None, "y", 1), ("a", "z", 1)], schema)
    diff = diff_rows(left, right, ["a", "b"], text_keys=True)
    assert {(r.action, r.old_b, r.new_b, ",".join(r.changed)) for r in diff.collect()} == {
        ("->", "x", "x", "a,v"),
        ("->", "y", "y", "a"),
        ("---", "z", None, ""),
        ("+++", None, "z", ""),
    }
    plain = Equality(ignore_case=True)
    linked = diff_rows(left, right, ["a", "b"], text_keys=True, equality=plain)
    assert {r.action for r in linked.collect()} == {"->"}


def test_types_that_differ_compare_as_text(spark):
    left, right = frame(spark, [(1, "5"), (2, "6")]), frame(spark, [(1, 5), (2, 7)], "k int, v int")
    assert actions(diff_rows(left, right, ["k"])) == [("->", 2)]


def test_column_changes(spark):
    left = spark.createDataFrame([], "a int, b int, c int, d int, e int")
    right = spark.createDataFrame([], "d int, a int, x int, c string, f int")
    found = {c.name: c.marker for c in column_changes(left, right, {"b": "f"})}
    assert found == {"d": ":", "a": "", "x": "+++", "c": ":", "f": "(b)", "e": "---"}


def test_summary_and_assertion(spark):
    left, right = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(1, "a"), (2, "c"), (3, "d")])
    summary = diff_summary(left, right, ["k"]).first().asDict()
    assert (summary["row_inserts"], summary["row_updates"], summary["row_deletes"]) == (1, 1, 0)
    assert (summary["row_count_initial"], summary["row_count_final"]) == (2, 3)
    assert summary["col_updates"] == 1 and summary["different"]
    same = diff_summary(left, left, ["k"]).first()
    assert not same.different
    assert_no_diff(left, left, ["k"])
    with pytest.raises(TablesDiffer):
        assert_no_diff(left, right, ["k"])


def equal_tables(rows):
    """Whether two lists of rows hold the same rows, in any order."""
    return sorted(map(repr, rows[0])) == sorted(map(repr, rows[1]))


def test_equal_tables_by_digests(spark):
    schema = "k int, v string, w string"
    rows = [(1, "a", None), (1, "a", None), (2, None, "b"), (None, "x", "y"), (None, "x", "y"), (3, "p", "q")]
    left = frame(spark, rows, schema)
    assert_no_diff(left, frame(spark, rows[::-1], schema).repartition(3), ["k"])
    other = {
        "once less": rows[1:], "once more": [*rows, rows[0]],
        "swapped cells": [*rows[:5], (3, "q", "p")], "cell and NULL swapped": [*rows[:2], (2, "b", None), *rows[3:]],
        "keys swapped": [(2, "a", None), (1, "a", None), (1, None, "b"), *rows[3:]],
        "NULL for a key": [*rows[:5], (None, "p", "q")], "empty": [],
    }
    for name, data in other.items():
        assert not equal_tables((rows, data)), name
        for a, b in ((left, frame(spark, data, schema)), (frame(spark, data, schema), left)):
            with pytest.raises(TablesDiffer):
                assert_no_diff(a, b, ["k"])


def test_only_unequal_keys_are_counted(spark):
    left = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "d")])
    right = frame(spark, [(1, "a"), (1, "a"), (2, "x"), (3, "c"), (5, "e")])
    found = unequal_summary(left, right, ["k"])
    assert (found["row_updates"], found["row_deletes"], found["row_inserts"]) == (1, 1, 1)
    assert (found["row_count_initial"], found["row_count_final"], found["col_updates"]) == (5, 5, 1)
    loose = Equality(ignore_case=True, epsilon=0.5)
    cased = frame(spark, [(1, "A"), (2, "1.2")]), frame(spark, [(1, "a"), (2, "1")])
    assert unequal_summary(*cased, ["k"], equality=loose) is None
    assert unequal_summary(*cased, ["k"]) is not None
    assert unequal_summary(left, left.withColumnRenamed("v", "w"), ["k"], renames={"v": "w"}) is not None
    assert unequal_summary(left, left.select("v", "k"), ["k"]) is not None
    assert unequal_summary(left.limit(0), left.limit(0), ["k"]) is None


def test_a_key_of_many_rows_is_dealt_out(spark):
    left = spark.range(20_000).selectExpr("cast(if(id < 15000, 0, id) as int) as k", "cast(id as string) as v")
    right = left.filter("v <> '15'")
    diff = diff_rows(left, right, ["k"])
    counts = {r.action: r["count"] for r in diff.groupBy("action").count().collect()}
    assert counts == {"---": 15_000, "+++": 14_999}
    text = diff._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 2 and text.count("FullOuter") == 1


def three(spark):
    parent = frame(spark, [(k, "1") for k in range(1, 8)])
    local = frame(spark, [(1, "2"), (2, "1"), (3, "2"), (4, "2"), (5, "1"), (7, "9"), (10, "l")])
    remote = frame(spark, [(1, "3"), (2, "3"), (3, "1"), (4, "2"), (6, "5"), (7, "1"), (10, "r")])
    return parent, local, remote


@pytest.mark.parametrize("unique", [True, False])
def test_diff3(spark, unique):
    got = {
        (r.k, r.action): (",".join(r.changed), ",".join(r.conflicts))
        for r in diff3(*three(spark), ["k"], keys_unique=unique).collect()
    }
    assert got == {
        (1, "!->"): ("v", "v"),  # 1, 2, 3
        (2, "->"): ("v", ""),  # 1, 1, 3
        (4, "->"): ("v", ""),  # both made the same change
        (5, "---"): ("", ""),  # removed by remote
        (6, "!->"): ("v", "v"),  # removed by local, changed by remote
        (10, "+++"): ("", ""),  # new on both sides: the remote row is an insert
    }


@pytest.mark.parametrize("unique", [True, False])
def test_merge3(spark, unique):
    merged = merge3(*three(spark), ["k"], keys_unique=unique)
    assert sorted((r.k, r.v, r.conflict_count) for r in merged.collect()) == [
        (1, "2", 1),
        (2, "3", 0),
        (3, "2", 0),
        (4, "2", 0),
        (7, "9", 0),
        (10, "l", 0),
        (10, "r", 0),
    ]
    texts = {r.k: r.v for r in with_conflict_texts(merged).collect()}
    assert texts["1"] == "((( 1 ))) 2 /// 3"


def test_three_way_patch_gives_the_merge(spark):
    rng = random.Random(4)
    schema = "k int, v string, x int"

    def version(keep):
        return [(k, rng.choice("abc"), rng.choice([1, 2, None])) for k in range(80) if rng.random() < keep]

    parent, local, remote = (frame(spark, version(k), schema) for k in (0.9, 0.8, 0.8))
    patch = three_way_patch(diff3(parent, local, remote, ["k"]), ["k"], ["v", "x"])
    patched = apply_patch(local, patch, ["k"])
    merged = merge3(parent, local, remote, ["k"]).drop("conflicts", "conflict_count")
    assert rows(patched) == rows(merged)


def test_merge3_columns(spark):
    parent = frame(spark, [(1, "a", "b")], "k int, x string, y string")
    local = frame(spark, [(1, "b", "new")], "k int, y string, mine string")
    remote = frame(spark, [(1, "a", "c", "far"), (2, "n", "m", "far")],
                   "k int, x string, y string, theirs string")
    merged = merge3(parent, local, remote, ["k"]).drop("conflicts", "conflict_count")
    assert merged.columns == ["k", "y", "mine", "theirs"]
    assert sorted(map(tuple, merged.collect())) == [(1, "c", "new", "far"), (2, "m", None, "far")]


def test_merge3_repeated_keys(spark):
    parent = frame(spark, [(1, "p"), (2, "p"), (2, "q")])
    local = frame(spark, [(1, "p"), (1, "z"), (2, "l")])
    remote = frame(spark, [(1, "r"), (2, "r")])
    got = sorted((r.k, r.v) for r in merge3(parent, local, remote, ["k"]).collect())
    assert got == [(1, "p"), (1, "z"), (2, "l"), (2, "r")]


def random_table(rng, n, extra=False):
    def cell():
        return rng.choice([None, "", "a", "b", "c"])

    return [
        (rng.choice([None, *range(n)]), cell(), rng.choice([None, 1.5, 2.5]), *([cell()] * extra))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_patch_of_a_difference_gives_the_other_table(spark, seed):
    rng = random.Random(seed)
    schema = "k int, v string, x double"
    left = frame(spark, random_table(rng, 60), schema)
    right = frame(spark, random_table(rng, 60), schema)
    diff = diff_rows(left, right, ["k"])
    assert rows(apply_patch(left, diff, ["k"])) == rows(right)


def test_patch_with_column_changes(spark):
    rng = random.Random(9)
    left = frame(spark, [(i, "v", 1.0) for i in range(5)], "k int, old string, gone double")
    right = frame(spark, [(i, rng.choice("vw"), "n") for i in range(2, 8)],
                  "k int, new string, extra string")
    renames = {"old": "new"}
    diff = diff_rows(left, right, ["k"], renames=renames)
    patched = apply_patch(left, diff, ["k"], column_changes(left, right, renames))
    assert set(patched.columns) == set(right.columns)
    assert rows(patched.select(*right.columns)) == rows(right)


def test_patch_carries_its_column_changes(spark, tmp_path):
    left = frame(spark, [(i, "v", 1.0) for i in range(5)], "k int, old string, gone double")
    right = frame(spark, [(i, "w", "n") for i in range(2, 8)], "k int, new string, extra string")
    changes = column_changes(left, right, {"old": "new"})
    diff = with_schema_rows(diff_rows(left, right, ["k"], renames={"old": "new"}), changes)
    diff.write.parquet(f"{tmp_path}/patch")
    stored = spark.read.parquet(f"{tmp_path}/patch")
    assert [(c.old, c.new) for c in schema_rows(stored)] == [(None, "extra"), ("gone", None), ("old", "new")]
    patched = apply_patch(left, stored, ["k"], None)
    assert rows(patched.select(*right.columns)) == rows(right)
    assert dict(patched.dtypes) == dict(right.dtypes)
    # Given column changes win over the schema rows, and without any change there are none.
    assert rows(apply_patch(left, stored, ["k"], changes).select(*right.columns)) == rows(right)
    same = diff_rows(left, left, ["k"])
    assert with_schema_rows(same, column_changes(left, left)) is same
    assert rows(apply_patch(left, same, ["k"], None)) == rows(left)


def test_patch_leaves_rows_that_changed_meanwhile(spark):
    left, right = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(1, "x")])
    diff = diff_rows(left, right, ["k"])
    later = frame(spark, [(1, "other"), (2, "b"), (3, "c")])
    assert rows(apply_patch(later, diff, ["k"])) == [(1, "other"), (3, "c")]


def test_positions_and_context(spark):
    n = 2000
    left = spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    changed = F.when(F.col("k").isin(0, 700, 701, 1999), "b").otherwise("a")
    right = left.select("k", changed.alias("v"))
    order = ["day", "k"]
    # A third of the rows share one order value.
    day = F.when(F.col("k") % 3 == 0, F.lit(-1)).otherwise(F.col("k"))
    diff = diff_rows(left, right, ["k"], keep_equal=True).withColumn("day", day)
    placed = with_positions(diff.repartition(13), order)
    want = sorted(range(n), key=lambda k: (-1 if k % 3 == 0 else k, k))
    assert [r.k for r in placed.orderBy("position").collect()] == want
    assert placed.agg(F.max("position")).first()[0] == n - 1
    near = {r.position for r in with_context(diff, order, 2).collect()}
    hit = {want.index(k) for k in (0, 700, 701, 1999)}
    assert near == {p + d for p in hit for d in range(-2, 3) if 0 <= p + d < n}


@pytest.mark.parametrize("around", [0, 1, 3])
@pytest.mark.parametrize("gap", [1, 5, 1000])
def test_context_over_ranges_of_any_size(spark, around, gap):
    """Gap 1 cuts at so many rows that ranges are shorter than the context."""
    rng = random.Random(around * 10 + gap)
    table = [
        (rng.choice(["", "", "", "", "->", "+++"]), rng.choice([None, 1.0, 2.0, 2.5]), k if k else None)
        for k in range(90)
    ]
    diff = frame(spark, table, "action string, day double, k long")
    want = sorted(table, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or 0))
    hit = [at for at, r in enumerate(want) if r[0]]
    near = {at for p in hit for at in range(p - around, p + around + 1) if 0 <= at < len(want)}
    got = with_context(diff, ["day", "k"], around, gap)
    assert sorted((r.position, r.action, r.day, r.k) for r in got.collect()) == sorted(
        ((at, *want[at]) for at in near), key=lambda r: r[0]
    )


def test_context_of_nothing(spark):
    diff = frame(spark, [], "action string, k long")
    assert with_context(diff, ["k"]).collect() == []
    with pytest.raises(ValueError):
        with_context(diff, ["k"], -1)


def test_context_writes_edges_only(spark):
    n = 60_000
    action = F.when(F.col("id") % 10_000 == 5, "->").otherwise("")
    diff = spark.range(n).select(action.alias("action"), F.xxhash64("id").alias("k"))
    kept = near_or_edge(diff, ["k"], 2)
    pieces = kept.select("_piece").distinct().count()
    assert 1 < pieces <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) + 1
    assert kept.count() <= 5 * 6 + 4 * pieces
    assert with_context(diff, ["k"], 2).count() <= 5 * 6
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(_piece" in text


def test_blank_rows(spark):
    df = frame(spark, [(1, "a"), (2, ""), (3, "b"), (4, ""), (5, None)])
    assert [r.k for r in drop_blank_rows(df, order_by="k").orderBy("k").collect()] == [1, 2, 3]
    assert drop_blank_rows(df.select("v")).count() == 2
    blank = frame(spark, [(1, ""), (2, None)])
    assert drop_blank_rows(blank, order_by="k").count() == 0


def test_keyless_links_unique_content(spark):
    schema = "a string, b int, c string"
    left = frame(spark, [(f"n{i}", i % 7, "s") for i in range(60)], schema)
    right = frame(spark, [(f"n{i}", i % 7, "t" if i == 5 else "s") for i in range(3, 63)], schema)
    got = [
        (r.action, r.old_a, r.new_a, ",".join(r.changed))
        for r in diff_keyless(left, right).collect()
    ]
    assert sorted(got, key=repr) == sorted(
        [("---", f"n{i}", None, "") for i in range(3)]
        + [("+++", None, f"n{i}", "") for i in range(60, 63)]
        + [("->", "n5", "n5", "c")],
        key=repr,
    )


def test_keyless_falls_back_to_more_columns(spark):
    schema = "a int, b int, v int"
    left = frame(spark, [(i % 20, i // 20, i) for i in range(400)], schema)
    right = frame(spark, [(i % 20, i // 20, i if i != 7 else -1) for i in range(400)], schema)
    got = [(r.action, r.old_v, r.new_v) for r in diff_keyless(left, right).collect()]
    # Row 7 has no partner by value; its two other cells together are unique.
    assert got == [("->", 7, -1)]


def test_keyless_column_choice(spark):
    names = "a b c d e f".split()
    data = [tuple(i % n for n in (2, 50, 40, 30, 20, 10)) for i in range(200)]
    df = frame(spark, data, ", ".join(f"{n} int" for n in names))
    assert pick_columns(df, df) == ["b", "c", "d", "e", "f"]


def test_patch_by_key_text_finds_the_old_spelling(spark):
    left = frame(spark, [("Bob", 1), ("Ann", 2), ("Zed", 3)], "name string, v int")
    right = frame(spark, [("BOB ", 9), ("ann", 2), ("New", 4)], "name string, v int")
    plain = Equality(ignore_whitespace=True, ignore_case=True)
    diff = diff_rows(left, right, ["name"], equality=plain, text_keys=True)
    patched = apply_patch(left, diff, ["name"])
    assert rows(patched) == [("Ann", 2), ("BOB ", 9), ("New", 4)]


@pytest.mark.parametrize("key", ["old", "new", "parent", "local", "remote", "parent_id", "_a"])
def test_any_key_name(spark, key):
    schema = f"{key} int, v string, w string"
    parent = frame(spark, [(1, "a", "x"), (2, "b", "x"), (3, "c", "x")], schema)
    local = frame(spark, [(1, "a", "y"), (2, "b", "x"), (3, "c", "x")], schema)
    remote = frame(spark, [(1, "z", "x"), (2, "q", "x"), (4, "d", "x")], schema)
    diff = diff_rows(parent, local, [key])
    assert [(r[key], r.action, r.changed) for r in diff.collect()] == [(1, "->", ["w"])]
    three_way = diff3(parent, local, remote, [key])
    patch = three_way_patch(three_way, [key], ["v", "w"])
    merged = merge3(parent, local, remote, [key]).drop("conflicts", "conflict_count")
    assert rows(apply_patch(local, patch, [key])) == rows(merged)
    assert rows(merged) == [(1, "z", "y"), (2, "q", "x"), (4, "d", "x")]


def test_clashing_names_are_an_error(spark):
    left = frame(spark, [(1, "a")], "old_v int, v string")
    with pytest.raises(ValueError, match="old_v"):
        diff_rows(left, left, ["old_v"])


def test_column_names_with_commas(spark):
    left = frame(spark, [(1, "x", "y")], "k int, `a,b` string, a string")
    right = frame(spark, [(1, "z", "y")], "k int, `a,b` string, a string")
    diff = diff_rows(left, right, ["k"])
    counts = diff_columns(diff, column_changes(left, right)).collect()
    assert {r.column_name: r.changed_cells for r in counts} == {"k": 0, "a,b": 1, "a": 0}
    assert diff_summary(left, right, ["k"]).first().col_updates == 1


def test_a_changed_type_is_a_difference(spark):
    left = frame(spark, [(1, 5)], "k int, v int")
    right = left.withColumn("v", F.col("v").cast("string"))
    summary = diff_summary(left, right, ["k"]).first()
    assert (summary.row_updates, summary.col_type_changes, summary.different) == (0, 1, True)
    with pytest.raises(TablesDiffer):
        assert_no_diff(left, right, ["k"])


def test_trailing_blank_rows_with_null_order(spark):
    found = drop_blank_rows(
        frame(spark, [(1, "a"), (None, ""), (2, ""), (3, "b"), (4, "")], "at int, t string"), "at"
    )
    assert rows(found) == sorted([(1, "a"), (None, ""), (2, ""), (3, "b")], key=repr)
    blank = frame(spark, [(1, ""), (None, "")], "at int, t string")
    assert drop_blank_rows(blank, "at").count() == 0
    first = frame(spark, [(None, "x"), (None, ""), (1, "")], "at int, t string")
    assert rows(drop_blank_rows(first, "at")) == sorted([(None, "x"), (None, "")], key=repr)


def test_keyless_matches_sets_in_turn(spark):
    """Against the rule written out: each set links what no earlier set linked."""
    rng = random.Random(2)
    names = ["a", "b", "c"]
    left = [(rng.randrange(60), rng.randrange(9), rng.randrange(40)) for _ in range(120)]
    right = [
        tuple(v if rng.random() > 0.1 else rng.randrange(60) for v in row)
        for row in left
        if rng.random() > 0.1
    ]
    links = {}
    for mask in range(1, 8):
        chosen = [i for i in range(3) if mask >> i & 1]
        texts = [[tuple(r[i] for i in chosen) for r in side] for side in (left, right)]
        tops = [max(side.count(t) for t in side) for side in texts]
        if max(tops) / (max(len(left), len(right)) + 21) >= 0.1:
            continue
        for i, text in enumerate(texts[0]):
            if texts[0].count(text) == 1 == texts[1].count(text):
                j = texts[1].index(text)
                if i not in links and j not in links.values():
                    links[i] = j
    wanted = sorted(
        [("---", left[i], None) for i in range(len(left)) if i not in links]
        + [("+++", None, r) for j, r in enumerate(right) if j not in links.values()]
        + [("->", left[i], right[j]) for i, j in links.items() if left[i] != right[j]],
        key=repr,
    )
    schema = "a int, b int, c int"
    diff = diff_keyless(frame(spark, left, schema), frame(spark, right, schema))

    def side(r, name):
        cells = tuple(r[f"{name}_{c}"] for c in names)
        return None if all(v is None for v in cells) else cells

    got = sorted([(r.action, side(r, "old"), side(r, "new")) for r in diff.collect()], key=repr)
    assert got == wanted


def test_keyless_runs_few_jobs(spark):
    schema = "a int, b int, v int"
    left = frame(spark, [(i % 20, i // 20, i) for i in range(400)], schema)
    right = frame(spark, [(i % 20, i // 20, i if i != 7 else -1) for i in range(400)], schema)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("keyless", "keyless")
    try:
        diff_keyless(left, right)
        assert len(tracker.getJobIdsForGroup("keyless")) <= 15
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pruned_columns_keep_their_neighbours(spark):
    left = frame(spark, [(1, "a", "b", "c", "d", "e")], "k int, p string, q string, r string, s string, t string")
    right = left.withColumn("r", F.lit("x"))
    diff = diff_rows(left, right, ["k"])
    changes = column_changes(left, right)

    def shown(around):
        columns = prune_columns(diff, ["k"], changes, around).columns
        return [c.removeprefix("new_") for c in columns if c.startswith("new_")]

    assert shown(0) == ["r"] and shown(1) == ["q", "r", "s"] and shown(9) == list("pqrst")



def walk(left, right, links, rows, start):
    """Links of equal rows at one distance from a linked pair, walking through ``rows``."""
    mates, new = dict(links), {}
    taken = set(mates.values())
    here = (start, start) if start is not None else None
    blocked = False
    for i in rows:
        if i in mates:
            here, blocked = (i, mates[i]), False
            continue
        if here is None:
            continue
        j = here[1] + (i - here[0])
        blocked = blocked or not 0 <= j < len(right) or j in taken or left[i] != right[j]
        # A linked row on the other side ends the stretch.
        if not blocked:
            new[i] = j
    return new


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_against_a_walk(spark, seed):
    rng = random.Random(seed)
    left = [rng.choice("aab") if rng.random() < 0.7 else f"u{i}" for i in range(90)]
    right = [t for t in left if rng.random() > 0.15]
    right = [t if rng.random() > 0.08 else "c" for t in right]
    links = {i: right.index(t) for i, t in enumerate(left) if left.count(t) == 1 == right.count(t)}
    down = walk(left, right, links, range(len(left)), None)
    after = links | down
    n, m = len(left) - 1, len(right) - 1
    flipped = {n - i: m - j for i, j in after.items()}
    up = walk(left[::-1], right[::-1], flipped, range(len(left)), -1)
    wanted = down | {n - i: m - j for i, j in up.items()}

    def side(texts):
        rows = [(1000 + i, hash(t) % 10**9, 7, i) for i, t in enumerate(texts)]
        rng.shuffle(rows)
        return frame(spark, rows, "_id long, a long, b long, line int")

    found = link_neighbours(
        side(left), side(right),
        frame(spark, [(1000 + i, 1000 + j) for i, j in links.items()], "left_id long, right_id long"),
        ["line"], block_rows=7,
    )
    got = {r.left_id - 1000: r.right_id - 1000 for r in found.collect()}
    assert wanted and down and got == wanted


def test_ordered_keyless_difference(spark):
    schema = "line int, v string, w int"
    left = frame(spark, [(1, "a", 1), (2, "x", 0), (3, "x", 0), (4, "x", 0), (5, "b", 2), (6, "x", 0)], schema)
    right = frame(spark, [(11, "a", 1), (12, "x", 0), (13, "x", 0), (15, "b", 2), (16, "x", 0)], schema)
    rules = KeylessRules(coarse_share=0.9)
    bare = left.drop("line"), right.drop("line")
    plain = diff_keyless(*bare, rules=rules).groupBy("action").count().collect()
    assert {r.action: r["count"] for r in plain} == {"---": 4, "+++": 3}
    ordered = diff_keyless(left, right, rules=rules, order=["line"])
    assert [(r.action, r.old_v) for r in ordered.collect()] == [("---", "x")]
    assert diff_keyless(left, left, rules=rules, order=["line"]).count() == 0
    assert diff_keyless(left, left.limit(0), rules=rules, order=["line"]).count() == 6
