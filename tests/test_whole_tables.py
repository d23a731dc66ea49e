"""Queries of whole tables: no row of theirs is left out by its id."""

import compare

from quern.plans import sql_queries


def test_whole_tables(spark):
    def table(name):
        return spark.read.parquet(f"{compare.SF_DIR}/{name}.parquet")

    def run(name):
        return sql_queries.QUERIES[name](spark, compare.SF_DIR)

    full = run("join_full")
    assert full.where("c_custkey is not null").count() == table("customer").count()
    assert full.where("s_suppkey is not null").count() == table("supplier").count()
    assert run("join_null_safe").count() == table("part").where("p_size <> 2").count()
    high = {r[0] for r in table("supplier").groupBy("s_nationkey").avg("s_acctbal").collect() if r[1] > 4500}
    assert {r["k"] for r in run("except").collect()} == {r["n_nationkey"] for r in table("nation").collect()} - high
