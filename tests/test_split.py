import hashlib

import pytest

from gleanframe.operators.split import (demos, leakage_audit, prefix_subsets, rank_cuts, split_exact, split_fraction,
                                        split_grouped)

SEED = 42


def ordered(n):
    return sorted(range(n), key=lambda i: hashlib.md5(f"{SEED}:{i}".encode()).hexdigest())


def parts(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.split, set()).add(r.id)
    return out


@pytest.mark.parametrize("n,n_test,n_val", [(20, 3, 3), (20, 0, 3), (20, 3, 0), (6, 3, 3), (5000, 700, 1300)])
def test_exact_sizes_and_membership(spark, n, n_test, n_val):
    got = parts(split_exact(spark.range(n), "id", SEED, n_test, n_val))
    order = ordered(n)
    want = {"test": set(order[:n_test]), "val": set(order[n_test:n_test + n_val]),
            "train": set(order[n_test + n_val:])}
    assert got == {k: v for k, v in want.items() if v}


def test_nothing_held_out(spark):
    assert parts(split_exact(spark.range(9), "id", SEED, 0, 0)) == {"train": set(range(9))}


def test_too_few_rows_raise(spark):
    with pytest.raises(Exception, match="fewer than 6 rows"):
        split_exact(spark.range(5), "id", SEED, 3, 3).collect()


def test_same_split_on_any_partitioning(spark):
    one = parts(split_exact(spark.range(300).coalesce(1), "id", SEED, 30, 30))
    many = parts(split_exact(spark.range(300).repartition(13), "id", SEED, 30, 30))
    assert one == many


def test_another_seed_gives_another_split(spark):
    a = parts(split_exact(spark.range(300), "id", 1, 30, 30))
    b = parts(split_exact(spark.range(300), "id", 2, 30, 30))
    assert a != b


def test_rank_cuts_at_the_ends(spark):
    df = spark.range(1000).selectExpr("md5(cast(id AS string)) AS split_key")
    keys = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(1000))
    got = {r["rank"]: r.cut for r in rank_cuts(df, [1, 2, 500, 1000, 1001]).collect()}
    assert got == {1: keys[0], 2: keys[1], 500: keys[499], 1000: keys[999]}


def test_fractions(spark):
    got = parts(split_fraction(spark.range(20000), "id", SEED, {"test": 0.1, "val": 0.2}))
    assert sum(map(len, got.values())) == 20000
    assert abs(len(got["test"]) - 2000) < 200 and abs(len(got["val"]) - 4000) < 300
    assert parts(split_fraction(spark.range(5), "id", SEED, {})) == {"train": set(range(5))}
    with pytest.raises(ValueError):
        split_fraction(spark.range(5), "id", SEED, {"test": 0.6, "val": 0.6})


def test_prefixes_are_nested_and_exact(spark):
    order = ordered(14)
    got = {}
    for r in prefix_subsets(spark.range(14), "id", SEED, [5, 10, 14, 99, 0]).collect():
        got.setdefault(r.train_size, set()).add(r.id)
    assert got == {5: set(order[:5]), 10: set(order[:10]), 14: set(order), 99: set(order)}
    assert prefix_subsets(spark.range(14), "id", SEED, [0]).count() == 0


@pytest.mark.parametrize("n,want", [(3, 3), (0, 0), (99, 14)])
def test_demos_take_the_head_of_train(spark, n, want):
    got = {r["rank"]: r.id for r in demos(spark.range(14), "id", SEED, n).collect()}
    assert got == {i + 1: k for i, k in enumerate(ordered(14)[:want])}


def test_demos_come_from_train_only(spark):
    split = split_exact(spark.range(40), "id", SEED, 5, 5)
    first = demos(split.where("split = 'train'"), "id", SEED, 3).collect()
    assert [r.id for r in sorted(first, key=lambda r: r["rank"])] == ordered(40)[10:13]


def test_a_key_that_repeats_across_a_cut_raises(spark):
    repeated = spark.range(100).selectExpr("id % 4 AS id")
    with pytest.raises(Exception, match="split_grouped"):
        split_exact(repeated, "id", SEED, 10, 10).collect()


def texts(spark):
    """40 texts, each three times with other case and blanks, and one text 200 times."""
    return spark.range(320).selectExpr(
        "id", "CASE WHEN id < 200 THEN 'The  hot text' WHEN id % 3 = 0 THEN concat('Text ', (id - 200) div 3) "
              "ELSE concat(' text\\n', upper(cast((id - 200) div 3 AS string)), ' ') END AS text")


def test_groups_stay_whole(spark):
    docs = texts(spark)
    parted = split_grouped(docs, SEED, 30, 30)
    assert leakage_audit(parted).count() == 0
    sizes = {r.split: r["count"] for r in parted.groupBy("split").count().collect()}
    assert sizes == {"test": 30, "val": 30, "train": 260}          # the hot text is passed over


def test_leaks_are_found(spark):
    docs = texts(spark)
    found = leakage_audit(split_exact(docs, "id", SEED, 100, 100)).collect()
    want = {}
    for r in split_exact(docs, "id", SEED, 100, 100).collect():
        want.setdefault(" ".join(r.text.lower().split()), []).append(r.split)
    assert sorted((r.splits, r.n_rows) for r in found) == sorted(
        (",".join(sorted(set(s))), len(s)) for s in want.values() if len(set(s)) > 1)


def filled(sizes, n_test, n_val):
    """{group: split} by going through the groups one by one; sizes: {group: rows}."""
    order = sorted(sizes, key=lambda g: hashlib.md5(f"{SEED}:={g}".encode()).hexdigest())
    out = dict.fromkeys(sizes, "train")
    for part, left in (("test", n_test), ("val", n_val)):
        free = [g for g in order if out[g] == "train"]
        for g in free:
            if sizes[g] <= left:
                out[g], left = part, left - sizes[g]
        if left > 0:
            rest = [g for g in free if out[g] == "train"]
            out[min(rest, key=lambda g: (sizes[g], order.index(g)))] = part
    return out


@pytest.mark.parametrize("last_rows", [0, 7, 1_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_filled_in_order_by_size(spark, seed, last_rows):
    """Rounds of cuts and the last groups one by one give what going through all groups gives."""
    import random

    rng = random.Random(seed)
    sizes = {g: rng.choice([1, 1, 2, 3, 5, 8, 40, 90]) for g in range(60)}
    rows = spark.createDataFrame([(g * 1000 + i, g, "x") for g, n in sizes.items() for i in range(n)], "id long, owner long, n string")
    parted = split_grouped(rows, SEED, 97, 41, group_key="owner", last_rows=last_rows)
    assert parted.columns == ["id", "owner", "n", "split_key", "split"]
    got = {(r.owner, r.split) for r in parted.collect()}
    assert got == set(filled(sizes, 97, 41).items()) and parted.count() == sum(sizes.values())


def test_sizes_overshoot_only_when_no_group_fits(spark):
    rows = spark.range(100).selectExpr("id", "id div 10 AS owner")           # ten groups of ten
    counts = {r.split: r["count"] for r in split_grouped(rows, SEED, 25, 20, group_key="owner").groupBy("split").count().collect()}
    assert counts == {"test": 30, "val": 20, "train": 50}


def test_too_few_rows_raise(spark):
    rows = spark.range(10).selectExpr("id", "id AS owner")
    with pytest.raises(ValueError, match="too few rows"):
        split_grouped(rows, SEED, 8, 5, group_key="owner")
    assert split_grouped(rows, SEED, 0, 0, group_key="owner").where("split = 'train'").count() == 10


def test_a_missing_group_is_one_group(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, ""), (4, "a")], "id long, owner string")
    splits = {r.id: r.split for r in split_grouped(rows, SEED, 2, 0, group_key="owner").collect()}
    assert splits[1] == splits[2] and list(splits.values()).count("test") == 2


def test_a_grouped_split_digests_each_text_once_to_count(spark, sf_dir):
    """After the counts, one pass over the texts is left: it labels them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = split_grouped(docs, SEED, 30, 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial")[0].count("lower(text") == 1
