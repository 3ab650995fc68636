"""What the plans look like: no Python in tasks, pruned scans, a bounded number of jobs."""

import re

from conftest import rows

from millrace import build_master, clean_files
from millrace.operators import fills, merge, profile
from millrace import session
from millrace.queries import QUERIES
from millrace.sources import assess
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def jobs(spark, run):
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    result = run()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return count, result


def test_no_python_and_no_products_in_any_plan(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, SF))
        for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, (name, word)


def test_scans_read_only_what_is_needed(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(profile.null_profile(lines, ["l_quantity", "l_tax"]))
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in text
    modes = plan(fills.exact_modes(lines, {"f": F.col("l_returnflag")}))
    assert "ReadSchema: struct<l_returnflag:string>" in modes


def test_right_hand_doubles_are_not_shuffled(spark):
    customer = spark.read.parquet(f"{SF}/customer.parquet").withColumnRenamed("c_custkey", "job_id")
    text = plan(merge.merge_frames([customer, customer.withColumn("more", F.lit(1))]))
    assert re.findall(r"ReadSchema: (struct<[^>]*>)", text)[1] == "struct<c_custkey:bigint>"


def test_jobs_do_not_grow_with_files_or_columns(spark, folder):
    def batch(files, columns):
        header = ",".join(["link"] + [f"c{i}" for i in range(columns)])
        body = "".join(
            f"u/{r}," + ",".join("" if (r + c) % 3 == 0 else str(r * c) for c in range(columns)) + "\n"
            for r in range(6))
        path = folder({f"f{i}.csv": f"{header}\n{body}" for i in range(files)}, f"in{files}-{columns}")
        return jobs(spark, lambda: clean_files(spark, path))

    small, one = batch(2, 3)
    more_files, many = batch(24, 3)
    more_columns, _ = batch(2, 12)
    assert more_files <= small + 2 and more_columns <= small + 2, (small, more_files, more_columns)
    few, _ = jobs(spark, lambda: build_master(one))
    same, master = jobs(spark, lambda: build_master(many))
    assert same <= few + 2
    # Twenty-four files, one of them owning all columns: two joins' worth of plan.
    assert plan(master.data).count("SortMergeJoin") <= 1
    assert len(rows(master.data.select("job_id").distinct())) == 6


def test_shuffles_start_large_enough(spark):
    conf = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.size_shuffles(spark, 10) == 8
    assert session.size_shuffles(spark, 128 * 500) == 500
    assert spark.conf.get(conf) == "500"
    assert session.size_shuffles(spark, 10) == 500
    spark.conf.set(conf, "64")  # the user's own choice stays
    assert session.size_shuffles(spark, 128 * 5000) == 64
    spark.conf.unset(conf)


def test_only_a_few_lines_per_file_are_shuffled_for_the_trial(spark, folder):
    lines = assess.scan_lines(spark, folder({"a.csv": "a,b\n" + "1,2,3\n" * 50}))
    named = lines.select(F.col("_path").alias("file_path"), "_block", F.col("_place").alias("_id"), "value")
    assert "WindowGroupLimit" in plan(assess.trial_issues(named))


def test_an_owner_reads_its_own_rows_of_the_cleaned_table(spark):
    from millrace import clean_table

    rows_ = spark.range(400_000).selectExpr(
        "concat('f', id % 8, '.csv') AS file", "concat('x/', id) AS link", *[f"CASE WHEN id % 8 = {i} THEN rand({i}) END AS v{i}" for i in range(8)])
    batch = clean_table(rows_, source="file")
    one = batch.data.filter("source_file = 'f3.csv'")
    assert "PushedFilters: [IsNotNull(source_file), EqualTo(source_file,f3.csv)]" in plan(one)
    # Rows of a file lie together in every file of the table.
    changes = batch.data.selectExpr("_metadata.file_path AS p", "_metadata.row_index AS i", "source_file AS s").selectExpr(
        "p", "s", "lag(s) OVER (PARTITION BY p ORDER BY i) AS before").filter("before IS NOT NULL AND s <> before").groupBy("p").count()
    assert all(r[1] <= 7 for r in rows(changes))


def test_date_columns_have_small_code(spark, capsys):
    """Free spellings of several columns are parsed in one stage whose code stays far below 64 KB."""
    from millrace.functions.dates import parse_dates

    text = F.format_string("%d/%d/24", (F.col("id") % 12 + 1).cast("int"), (F.col("id") % 28 + 1).cast("int"))
    cells = spark.range(100).select(*[text.alias(f"c{i}") for i in range(7)], F.lit(None).cast("string").alias("f"))
    parsed = cells.select(*[parse_dates(F.col(f"c{i}"), F.col("f"), ["yyyy-M-d", None]).alias(f"d{i}") for i in range(7)])
    parsed.explain("codegen")
    shown = capsys.readouterr().out
    assert len(shown) < 65_536 and all(int(n) < 8_000 for n in re.findall(r"maxMethodCodeSize:(\d+)", shown))
    assert str(parsed.first()[6]) == "2024-01-01 00:00:00"


def test_counters_of_one_header_are_side_by_side(spark):
    """Profiling multiplies no rows before they are aggregated."""
    from millrace.plans.clean import CleanOptions, decide
    from millrace.queries import exports
    from millrace.sources.staging import stage_frame

    staged = stage_frame(exports(spark, SF), "file", "row")
    lines = plan(decide(staged, CleanOptions())).splitlines()
    # Of the listing of a header's columns, or of what has been aggregated.
    for at, line in enumerate(lines):
        if "Generate" in line and "inline(cells" not in line:
            assert "Exchange" in "\n".join(lines[at:]).split("Scan", 1)[0]
