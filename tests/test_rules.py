import itertools

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from yieldlens.operators import rules as ru, values as va

ITEMS = ["a", "b", "c", "d"]


def table(spark, n=400):
    h = lambda k, m: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(m))
    return spark.range(n).select(
        F.when(h(1, 10) < 7, 1).otherwise(0).alias("a"),
        F.when(h(2, 10) < 6, "x").when(h(2, 10) < 9, "0").alias("b"),
        F.when(h(1, 10) < 5, "p").otherwise("q").alias("c"),
        F.lit("k").alias("d"),
        h(3, 3).cast("int").alias("Y"),
        F.lit(1).alias("op_rework_flag"),
    )


def brute(rows, min_support, max_length=3):
    """Counts by looking at every row for every candidate set."""
    baskets = [(frozenset(f"{c}={'nan' if r[c] is None else r[c]}" for c in ITEMS), r["Y"]) for r in rows]
    words = sorted(set().union(*[b for b, _ in baskets]))
    found = {}
    for y in (0, 1):
        mine = [b for b, label in baskets if label == y]
        for size in range(1, max_length + 1):
            for combo in itertools.combinations(words, size):
                n = sum(set(combo) <= b for b in mine)
                if mine and n / len(mine) >= min_support:
                    every = [label for b, label in baskets if set(combo) <= b]
                    found[y, combo] = (n, n / len(mine), every.count(1) / len(every))
    return found


@pytest.mark.parametrize("options", [{}, {"sets_per_row": 1}, {"sets_per_row": 1, "max_length": 4}, {"sets_per_row": 1, "broadcast_bytes": 0, "salts": 3}])
def test_itemsets_against_brute_force(spark, options):
    df = table(spark)
    found = {(r.Y, tuple(r["items"])): (r.n, r.support, r.NG_Ratio) for r in ru.frequent_itemsets(df, ITEMS, "Y", 0.3, **options).collect()}
    assert found == brute(df.collect(), 0.3, options.get("max_length", 3))


def test_itemsets_against_fpgrowth(spark):
    df = table(spark).where("Y = 1")
    baskets = va.encode_items(df, ITEMS, "items").select("items")
    grown = {tuple(sorted(r["items"])): r.freq for r in FPGrowth(minSupport=0.3, minConfidence=0.1).fit(baskets).freqItemsets.collect()}
    ours = {tuple(r["items"]): r.n for r in ru.frequent_itemsets(df, ITEMS, "Y", 0.3, 4).where("Y = 1").collect()}
    assert ours == grown


def expected_rules(rows, min_support, min_confidence, min_lift, largest=None):
    sets = brute(rows, min_support)
    out = {}
    for (y, items), (_, support, ng) in sets.items():
        if any(i.endswith("=0") for i in items):
            continue
        for k in range(1, len(items)):
            for base in itertools.combinations(items, k):
                add = tuple(i for i in items if i not in base)
                confidence = support / sets[y, base][1]
                lift = confidence / sets[y, add][1]
                if confidence >= min_confidence and lift >= min_lift and (largest is None or len(add) <= largest):
                    out[y, base, add] = (confidence, lift, ng)
    return out


def test_rules_against_brute_force(spark):
    df = table(spark)
    found = ru.association_rules(df, ITEMS, "Y", 0.2, 0.2, 1.000001).collect()
    expected = expected_rules(df.collect(), 0.2, 0.2, 1.000001)
    got = {(r.Y, tuple(r.item_base), tuple(r.item_add)): (r.Confidence, r.Lift, r.NG_Ratio) for r in found}
    assert got.keys() == expected.keys() and len(got) > 4
    for k, v in got.items():
        assert v == pytest.approx(expected[k])


def test_zero_rule(spark):
    rows = [(1, "0.5", "01", "z")] * 6 + [(0, "0", "01", "z")] * 6
    df = spark.createDataFrame(rows, "Y int, a string, b string, c string")
    kept = lambda how: ru.association_rules(df, ["a", "b", "c"], "Y", 0.5, 0.5, 1.0, zero_match=how).select("Y", "item_base").collect()
    assert {r.Y for r in kept(None)} == {0, 1}
    assert any("a=0.5" in r.item_base for r in kept("exact")) and not any("a=0" in r.item_base for r in kept("exact"))
    assert kept("substring") == []


def test_mine_rules_tables(spark):
    df = table(spark).select("a", "b", "c", "d", "op_rework_flag", "Y")  # the label in a later column
    mined = ru.mine_rules(df, "Y", min_support=0.2, min_confidence=0.2).collect()
    assert mined and not any("rework" in r.item_base + r.item_add for r in mined)
    assert [(r.Y, r.NG_Ratio) for r in mined] == sorted((r.Y, r.NG_Ratio) for r in mined)
    flat = ru.mine_rules_flat(df, "Y", min_support=0.2, min_confidence=0.2).collect()
    cut = ru.mine_rules_flat(df, "Y", min_support=0.2, min_confidence=0.2, max_group_rows=2, block_rows=3).collect()
    assert flat == cut and all(a.Y != b.Y or a.NG_Ratio != b.NG_Ratio for a, b in zip(flat, flat[1:]))
    for y in (0, 1):
        lengths = [r.X2 == "" for r in flat if r.Y == y]
        assert lengths == sorted(lengths)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "salts": 3, "sets_per_row": 1}])
def test_groups_are_mined_apart(spark, options):
    df = table(spark).withColumn("file", F.when(F.col("a") == 1, "one").otherwise("two")).drop("op_rework_flag")
    both = ru.mine_rules(df, "Y", by="file", min_support=0.2, min_confidence=0.2, **options)
    for name in ("one", "two"):
        alone = ru.mine_rules(df.where(F.col("file") == name).drop("file"), "Y", min_support=0.2, min_confidence=0.2)
        assert sorted(both.where(F.col("file") == name).drop("file").collect()) == sorted(alone.collect())


@pytest.mark.parametrize("options", [{}, {"broadcast_rules": 1, "salts": 3}])
def test_match_rules(spark, options):
    df = va.encode_items(table(spark), ITEMS, "items")
    rules = spark.createDataFrame([(1, ["d=k"]), (2, ["a=1", "c=p"]), (3, ["b=x", "d=k", "a=0"]), (4, ["no=such"])], "rule_id int, items array<string>")
    found = {r.rule_id: (r.all_count, r.ng_count, r.NG_Ratio) for r in ru.match_rules(rules, df, "items", "Y", **options).collect()}
    rows = [(set(r["items"]), r.Y) for r in df.collect()]
    for r in rules.collect():
        hit = [y for held, y in rows if set(r["items"]) <= held]
        assert found[r.rule_id] == (len(hit), hit.count(1), hit.count(1) / len(hit) if hit else None)
