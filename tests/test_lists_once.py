"""Aggregates of a list work it out once a row, not once an element."""

import numpy as np
from pyspark.sql import functions as F

from quern.functions import call


def test_a_list_is_worked_out_once(spark):
    """A Python function can't run once more for each element (in a lambda): that would be an error."""
    made = F.udf(lambda x: None if x < 0 else [x, None, 3, 8, 3, 1] if x else [], "array<int>")
    lists = spark.createDataFrame([(1,), (0,), (-1,)], "x int").select("x", made("x").alias("l"))
    names = "mad entropy skewness kurtosis kurtosis_pop sem stddev_pop var_samp mode median histogram".split()
    found = lists.select("x", *[call(f"list_{n}", made("x")).alias(n) for n in names]).where("x = 1").first()
    assert (found["mad"], found["median"], found["mode"], found["histogram"]) == (2.0, 3.0, 1, {1: 2, 3: 2, 8: 1})
    assert np.isclose(found["entropy"], 1.5219280948873621) and np.isclose(found["stddev_pop"], np.std([1, 3, 8, 3, 1]))
    for n in names:
        assert lists.select(call(f"list_{n}", "l").alias("v")).where("v is not null and cast(v as string) not in ('{}', '0.0')").count() == 1, n
