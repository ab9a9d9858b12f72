"""The fit of the quality rules: texts counted once, no job per round."""

from __future__ import annotations

from pyspark.sql import functions as F

from annoframe.llm import quality


def test_texts_are_counted_once_and_rounds_start_no_jobs(spark):
    text = F.when(F.col("id") % 3 == 0, F.expr("repeat('buy now ', 60)")).otherwise(
        F.expr("array_join(transform(sequence(1, 90), i -> concat('word', i * id, if(i % 9 = 0, '.', ''))), ' ')")
    )
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.range(60).select(F.col("id").alias("doc_id"), text.alias("text")).mapInArrow(seen, "doc_id bigint, text string")
    spark.sparkContext.setJobGroup("fit", "fit")
    rows = quality.report(docs).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit"))
    spark.sparkContext.setJobGroup("other", "other")
    assert {r.doc_id for r in rows if r.kept} == {i for i in range(60) if i % 3}
    assert read.value == 60 and jobs < 10
