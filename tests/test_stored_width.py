"""What is shuffled and written per row: no column twice, tables compressed well."""

import glob
import re

from pmflow.operators.merge import pick_per_key
from pmflow.plans import tables as tb


def test_ordering_columns_are_carried_once(spark):
    rows = [("a", 2, "x", None), ("a", 1, "y", 5), ("a", None, "z", 7), ("b", 3, None, 1), ("b", 3, None, 1), (None, 1, "q", 2)]
    df = spark.createDataFrame(rows, "k string, v int, w string, p int")
    for last, want in ((False, {("a", None, "z", 7), ("b", 3, None, 1), (None, 1, "q", 2)}),
                       (True, {("a", 2, "x", None), ("b", 3, None, 1), (None, 1, "q", 2)})):
        out = pick_per_key(df, ["k"], ["v", "w"], last=last)
        assert out.columns == df.columns and set(map(tuple, out.collect())) == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        fields = re.search(r"(?:min|max)\((?:named_)?struct\((.*?)\)", plan).group(1).split(", ")
        assert fields[::2] == ["o0", "o1", "p"], fields


def test_tables_are_written_with_their_codec(spark, tmp_path):
    df = spark.range(5).selectExpr("id AS k", "id * 2 AS v")
    tb.write_version(df, str(tmp_path), "t")
    tb.write_batch(df, f"{tmp_path}/b", 3)
    tb.append(df, f"{tmp_path}/a")
    tb.overwrite_partitions(df, f"{tmp_path}/o", ["k"])
    for sub in ("t", "b", "a", "o"):
        files = glob.glob(f"{tmp_path}/{sub}/**/*.parquet", recursive=True)
        assert files and all("_versions" in f or f.endswith(".zstd.parquet") for f in files), files
