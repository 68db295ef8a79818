"""The pipeline's stages, each on odd input, and the whole against its parts."""

from pyspark.sql import functions as F

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_odd_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "src0", 0), (-3, "x" * 200_000, "en", None, 1)],
                                base.schema)
    docs = base.union(odd).union(base.limit(3)).withColumn("n", F.lit(1))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_run_equals_its_stages(spark):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF).cache()
        seen.append(docs.count())
    got = P.run(spark, SF)
    pick = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(map(tuple, docs.select(*pick).collect()))
    assert seen[0] >= seen[1] >= seen[2]
