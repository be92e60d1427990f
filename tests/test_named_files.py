"""Named texts as files: one a name, tasks that do not grow with the number of files, nothing but what the list holds."""

import glob
import os

from tessera.session import work_path
from tessera.sources import stores as st


def test_many_files_are_few_tasks_and_only_listed_ones_are_read(spark):
    path = work_path(spark, "named")
    given = [(f"n/{i}", f"text {i}\n") for i in range(200)] + [("q=1?%:é", "signs"), ("q=1?%:é", "twice"), ("empty", None)]
    df = spark.createDataFrame(given, "name string, text string")
    st.write_named_texts(df, "name", "text", path)
    root = path.removeprefix("file://")
    files = glob.glob(f"{root}/name=*/*.txt")
    assert len(files) == len(given) and len({os.path.dirname(f) for f in files}) == len(given)
    assert not glob.glob(f"{root}/name=*/.*.part")
    with open(f"{root}/name=n_7/part-left-over.txt", "w") as f:  # of an attempt that failed
        f.write("text 7\n\n")
    rows = st.read_named_texts(spark, path)
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    got = {(r["name"], r["value"]) for r in rows.collect()}
    assert got == {(r["name"], r["value"]) for r in st.named_texts(df, "name", "text").collect()} and len(got) == len(given)


def test_folders_are_those_of_a_partition(spark):
    names = ["a b", "x=1?y%z", "c:d*e", "[f]{g}^h", "tab\there", "é'\"#"]
    path = work_path(spark, "named")
    st.write_named_texts(spark.createDataFrame([(n, n) for n in names], "name string, text string"), "name", "text", path)
    rows = spark.read.schema("value string, name string").text(path, wholetext=True).collect()
    assert {(r["name"], r["value"]) for r in rows} == {(n, n + "\n") for n in names}
