"""Command-line jobs: read, build cells, stage, publish, read back."""

from cellsmith.plans import cli, jobs
from cellsmith.session import scratch_path
from cellsmith.sinks import files as S
from cellsmith.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_cli_calls_and_contacts(spark):
    base = scratch_path(spark, "t-cli")
    fx.call_docs(spark, SF).write.parquet(f"{base}/docs")
    fx.contacts(spark, SF).write.parquet(f"{base}/contacts")
    out = cli.run(["calls", f"{base}/docs", f"{base}/calls", "--staging", f"{base}/stage"], spark)
    assert out["staging"].startswith(f"{base}/stage/bulkload/calls_")
    expect, _ = jobs.calls_to_cells(spark.read.parquet(f"{base}/docs"))
    assert rows(S.read_cells(spark, f"{base}/calls")) == rows(expect)
    assert spark.read.parquet(out["rejects"]).count() == 0

    cli.run(["contacts", f"{base}/contacts", f"{base}/contacts_t", "--staging", f"{base}/stage"], spark)
    assert rows(S.read_cells(spark, f"{base}/contacts_t")) == rows(
        jobs.contacts_to_cells(spark.read.parquet(f"{base}/contacts")))


def test_cli_wide_and_publish(spark):
    base = scratch_path(spark, "t-cli2")
    fx.contacts(spark, SF).write.parquet(f"{base}/contacts")
    cli.run(["wide", f"{base}/contacts", f"{base}/wide", "--recency", "ord"], spark)
    assert rows(S.read_rows(spark, f"{base}/wide", "rowkey", "ord")) == rows(
        jobs.contacts_latest(spark.read.parquet(f"{base}/contacts")))
    staging = S.write_sorted_cells(jobs.raw_docs_to_cells(fx.raw_docs(spark, SF)).dropDuplicates(
        ["rowkey", "family", "qualifier"]), f"{base}/stage")
    cli.run(["publish", staging, f"{base}/t"], spark)
    assert len(S.batches(spark, f"{base}/t")) == 1


def test_cli_reads_a_catalog_table(spark):
    base = scratch_path(spark, "t-cli3")
    fx.contacts(spark, SF).createOrReplaceTempView("cellsmith_contacts_t")
    cli.run(["contacts", "cellsmith_contacts_t", f"{base}/t", "--table", "--plain", "--staging", f"{base}/s"], spark)
    # of the contacts that share a key, the last row is published
    assert rows(S.read_cells(spark, f"{base}/t")) == rows(jobs.contacts_to_cells_latest(fx.contacts(spark, SF)))


def test_cli_writes_contact_rejects(spark):
    base = scratch_path(spark, "t-cli-rejects")
    spark.createDataFrame([(1, "123", "9", "a"), (2, None, "9", "b")],
                          "ord long, phoneNo string, tel string, name string").write.parquet(f"{base}/c")
    for more in (["contacts"], ["contacts", "--plain"], ["wide", "--recency", "ord"]):
        out = cli.run([more[0], f"{base}/c", f"{base}/{more[-1]}", "--staging", f"{base}/s{more[-1]}", *more[1:]], spark)
        assert [(r["ord"], r["reason"]) for r in spark.read.parquet(out["rejects"]).collect()] == [(2, "phone")]


def test_cli_files_option(spark):
    import glob

    base = scratch_path(spark, "t-cli-files")
    fx.contacts(spark, SF).write.parquet(f"{base}/contacts")
    cli.run(["contacts", f"{base}/contacts", f"{base}/t", "--staging", f"{base}/s", "--files", "3"], spark)
    batch = S.batches(spark, f"{base}/t")[0]
    files = glob.glob(f"{S.batch_path(f'{base}/t', batch)}/*.parquet".replace("file:", ""))
    assert len(files) == 3
    assert rows(S.read_cells(spark, f"{base}/t")) == rows(jobs.contacts_to_cells(spark.read.parquet(f"{base}/contacts")))
