import itertools
import random
from collections import Counter

import pytest

from lakewarden.operators import sync
from lakewarden.operators.sync import SyncConfig
from lakewarden.plans.sync import plan_sync
from tests.helpers import catalog_of, targets_of

CONFIG = SyncConfig("gold", ("dwh", "mart"), connection_id="c")


def table_row(schema, name, catalog="gold", table_type="MANAGED", table_format="DELTA", location="auto"):
    if location == "auto":
        location = f"abfss://lake@acct.dfs.core.windows.net/{schema}/{name}"
    return (catalog, schema, name, table_type, table_format, location)


def planned(spark, rows, names, config=CONFIG):
    result = plan_sync(catalog_of(spark, *rows), targets_of(spark, *names), config).collect()
    return Counter((row.target, row.operation, row.reason) for row in result)


def test_plan_routes_every_row(spark):
    rows = [
        table_row("dwh", "new"),
        table_row("dwh", "old"),
        table_row("dwh", "ext", table_type="EXTERNAL"),
        table_row("mart", "csv", table_format="CSV"),
        table_row("mart", "lost", location=None),
        table_row("mart", "odd", location="abfss://acct/x"),
        table_row("dwh", None),
        table_row("other", "unselected"),
        table_row("dwh", "elsewhere", catalog="silver"),
    ]
    names = ["uc_gold_dwh_old", "uc_gold_mart_gone", "uc_silver_dwh_x", "ucla_x", "uc_gold_other_y", "plain"]
    assert planned(spark, rows, names) == Counter(
        [
            ("uc_gold_dwh_new", "create", "new"),
            ("uc_gold_dwh_old", "skip", "exists"),
            ("uc_gold_dwh_ext", "skip", "type:EXTERNAL"),
            ("uc_gold_mart_csv", "skip", "format:CSV"),
            ("uc_gold_mart_lost", "skip", "location"),
            ("uc_gold_mart_odd", "skip", "location"),
            (None, "skip", "name"),
            ("uc_gold_mart_gone", "delete", "gone"),
        ]
    )


def test_registered_table_counts_as_present_whatever_its_format(spark):
    rows = [table_row("dwh", "t", table_format="CSV")]
    assert planned(spark, rows, ["uc_gold_dwh_t"]) == Counter([("uc_gold_dwh_t", "skip", "exists")])


def test_ambiguous_names_conflict_and_repeats_do_not(spark):
    config = SyncConfig("gold", ("a", "a_b"))
    rows = [table_row("a_b", "t"), table_row("a", "b_t"), table_row("a", "u"), table_row("a", "u")]
    assert planned(spark, rows, [], config) == Counter(
        {
            ("uc_gold_a_b_t", "conflict", "ambiguous name"): 2,
            ("uc_gold_a_u", "create", "new"): 2,
        }
    )


def test_folded_spellings_conflict(spark):
    config = SyncConfig("gold", ("dwh",), fold_case=True)
    rows = [table_row("dwh", "Sales"), table_row("dwh", "SALES"), table_row("dwh", "Other")]
    assert planned(spark, rows, ["uc_gold_dwh_other"], config) == Counter(
        {
            ("uc_gold_dwh_sales", "conflict", "ambiguous name"): 2,
            ("uc_gold_dwh_other", "skip", "exists"): 1,
        }
    )


def test_empty_sides(spark):
    assert planned(spark, [], ["uc_gold_dwh_x"]) == Counter([("uc_gold_dwh_x", "delete", "gone")])
    assert planned(spark, [table_row("dwh", "x")], []) == Counter([("uc_gold_dwh_x", "create", "new")])
    assert planned(spark, [], []) == Counter()


def test_payload_only_for_creates(spark):
    rows = [table_row("dwh", "new"), table_row("dwh", "ext", table_type="EXTERNAL")]
    result = plan_sync(catalog_of(spark, *rows), targets_of(spark), CONFIG).collect()
    assert {row.target: row.payload is not None for row in result} == {"uc_gold_dwh_new": True, "uc_gold_dwh_ext": False}


def test_semi_and_anti_keep_duplicates(spark):
    sources, targets = targets_of(spark, "a", "a", "b", "b"), targets_of(spark, "a", "a", "a", "c", "c")

    def bag(df):
        return Counter(row.target for row in df.collect())

    assert bag(sync.still_present(targets, sources)) == {"a": 3}
    assert bag(sync.to_delete(targets, sources)) == {"c": 2}
    assert bag(sync.to_create(sources, targets)) == {"b": 2}


def test_every_name_gets_exactly_one_operation(spark):
    rng = random.Random(3)
    pairs = list(itertools.product(["dwh", "mart"], [f"t{i}" for i in range(30)]))
    rows = [table_row(*pair) for pair in rng.sample(pairs, 35)]
    names = [f"uc_gold_{schema}_{name}" for schema, name in rng.sample(pairs, 25)]
    sources = sync.compose_targets(catalog_of(spark, *rows), CONFIG)
    result = {row.target: row.operation for row in sync.diff(sources, targets_of(spark, *names)).collect()}
    composed = {f"uc_gold_{row[1]}_{row[2]}" for row in rows}
    expected = {n: "skip" if n in names else "create" for n in composed} | {n: "delete" for n in set(names) - composed}
    assert result == expected
    assert sync.diff(sources, targets_of(spark, *names)).count() == len(expected)


def test_union_keeps_duplicates(spark):
    listing = catalog_of(spark, table_row("dwh", "x"))
    assert sync.union_listings([listing, listing, listing]).count() == 3


def test_owned_names(spark):
    config = SyncConfig("go.ld", ("d+w", "mart"))
    names = ["uc_go.ld_d+w_x", "uc_go.ld_mart_y_z"]
    names += ["uc_goxld_mart_x", "uc_go.ld_ddw_x", "uc_go.ld_martx_y", "x_uc_go.ld_mart_y"]
    owned = {row.target for row in sync.owned_targets(targets_of(spark, *names), config).collect()}
    assert owned == {"uc_go.ld_d+w_x", "uc_go.ld_mart_y_z"}
    folded = SyncConfig("Gold", ("DWH",), fold_case=True)
    rows = sync.owned_targets(targets_of(spark, "uc_gold_dwh_a", "UC_Gold_DWH_b"), folded).collect()
    assert {row.target for row in rows} == {"uc_gold_dwh_a", "uc_gold_dwh_b"}


def test_config_needs_a_schema():
    with pytest.raises(ValueError, match="schema"):
        SyncConfig("gold", ())
