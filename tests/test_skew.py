"""Registered queries on tables where one product holds a third of the lines and copies of one row a quarter."""

import shutil

import pytest

from tools.check_oracles import TABLES, compare, duck
from vitrine.catalog import oracles

NAMES = [
    "market_overview", "condition_distribution", "price_evolution", "price_variation", "brand_dimension",
    "dedup_latest", "observation_ranks", "latest_per_product", "idempotent_append", "append_outcome_counts",
    "incremental_upsert", "pages_until_empty", "top_price_moves", "dq_unique_key",
]


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        if name not in ("lineitem", "events"):
            shutil.copy(f"{small}/{name}.parquet", folder)
    con = duck(small)
    con.execute(f"""copy (
        select * replace (case when hash(l_orderkey, l_linenumber, l_suppkey) % 3 = 0 then 7 else l_partkey end as l_partkey)
        from lineitem
        union all
        select * exclude (i) replace (l_orderkey + 1000000 + i as l_orderkey) from
          (select * from lineitem order by all limit 1), range(2000) r(i)
        ) to '{folder}/lineitem.parquet' (row_group_size 2048)""")
    con.execute(f"""copy (
        select * replace (case when event_id % 3 = 0 then 5 else user_id end as user_id) from events)
        to '{folder}/events.parquet'""")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_results_stay_whole(spark, skewed, name):
    fine, text = compare(spark, duck(skewed), skewed, name, oracles()[name])
    assert fine, text
