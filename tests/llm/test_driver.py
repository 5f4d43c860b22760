"""What operators send to the driver: few jobs, and no object for each number."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowkin.llm import jaccard_tiles, pu_quality


@pytest.fixture
def many_partitions(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "41")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


@pytest.mark.usefixtures("many_partitions")
def test_marks_take_few_jobs(spark):
    """The jobs that mark the wanted documents don't grow with the partitions, and their sets all come."""
    texts = [(i, f"a{i} b{i} c{i} d{i}") for i in range(4000)]
    source = spark.createDataFrame(texts, "doc_id long, _t string")
    wanted = source.filter("doc_id % 3 = 0").select(F.col("doc_id").alias("rep"))
    spark.sparkContext.setJobGroup("marks", "marks")
    sets = jaccard_tiles._sets_of(source, wanted, 3)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("marks")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) < 10
    found = {r["node"] for r in sets.select("node").collect()}
    expected = {jaccard_tiles.node_of(s) for part in jaccard_tiles.element_sets([t for i, t in texts if i % 3 == 0], 3) for s in part}
    assert expected <= found and len(found) < len(expected) + 400


def test_features_come_as_numbers(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Some text, no. "), F.col("id"), F.lit("\nand a line.")).alias("_t"))
    ids = docs.select("doc_id", (F.col("doc_id") % 3 == 0).alias("good")).filter("doc_id % 2 = 0")
    tracemalloc.start()
    x, good = pu_quality._collected(docs, ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = np.concatenate(list(pu_quality.features([f"Some text, no. {i}\nand a line." for i in range(0, 3000, 2)])))
    order, expected_order = (a[np.lexsort(a.T[::-1])] for a in (np.column_stack([x, good]), np.column_stack([expected, np.arange(0, 3000, 2) % 3 == 0])))
    assert (order == expected_order).all()
    assert peak < 4 * x.nbytes
    none, flags = pu_quality._collected(docs, ids.filter("false"))
    assert none.shape == (0, pu_quality.WIDTH) and len(flags) == 0
