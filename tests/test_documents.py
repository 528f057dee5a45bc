"""A file for each job and the manifest that its commit publishes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from orderlens.sources import documents


def test_files_manifest_and_repeats(spark, tmp_path):
    documents.register(spark)
    folder = str(tmp_path / "out")
    rows = [(f"reports/sales/{i}_sales.json", json.dumps({"n": i, "text": "é" * i})) for i in range(25)]
    df = spark.createDataFrame(rows, "output_location string, document string").repartition(4)
    for _ in range(2):  # a run that is repeated writes the same files
        df.write.format("documents").option("folder", folder).mode("append").save()
        read = {r.output_location: (r.document, r.bytes) for r in documents.read_documents(spark, folder).collect()}
        assert read == {k: (v, len(v.encode())) for k, v in rows}
    assert json.load(open(f"{folder}/_manifest/complete"))["files"] == 25
    assert not [f for _, _, names in os.walk(folder) for f in names if f.endswith(".tmp")]


def test_a_failed_run_publishes_nothing(spark, tmp_path):
    documents.register(spark)
    folder = str(tmp_path / "out")
    bad = spark.createDataFrame([("reports/a/1_x.json", "{}"), ("../2_x.json", "{}")], "output_location string, document string").coalesce(1)
    with pytest.raises(Exception, match="must lie in the folder"):
        bad.write.format("documents").option("folder", folder).mode("append").save()
    with pytest.raises(Exception):
        documents.manifest(spark, folder).collect()
    with pytest.raises(Exception, match="missing"):
        bad.withColumn("document", F.lit(1)).drop("document").write.format("documents").option("folder", folder).mode("append").save()


def test_no_rows_still_publish(spark, tmp_path):
    documents.register(spark)
    folder = str(tmp_path / "out")
    spark.createDataFrame([], "output_location string, document string").write.format("documents").option("folder", folder).mode("append").save()
    assert json.load(open(f"{folder}/_manifest/complete")) == {"files": 0, "bytes": 0}
