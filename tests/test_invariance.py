"""Results do not depend on the number of partitions."""

from innkeeper.plans import ingest

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_store_results_invariant_to_partitioning(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append((_rows(ingest.reviews_insert(spark, SF)), _rows(ingest.hotels_upsert(spark, SF)),
                            _rows(ingest.rejects(spark, SF))))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
