import os

import pytest
from pyspark.sql import functions as F

from assay import session
from assay.operators.dedupe import dedupe_first
from assay.plans import silver
from assay.plans.medallion import build
from assay.sources import landing, tables
from assay.streaming import ingest

from .helpers import bronze, rows


def test_csv_round_trip_and_lineage(spark, tmp_path):
    df = bronze(spark, "customers", dict(first_name='A "quoted", name'),
                dict(customer_id="C2", source_bank=None, last_name="x\ty"))
    df = df.withColumn("_helper", F.lit(1))
    landing.export_source(df, str(tmp_path), "customers")
    back = landing.read_source(spark, str(tmp_path), "customers")
    assert back.columns == landing.landing_schema("customers").fieldNames()
    assert rows(back, "customer_id", "first_name", "last_name", "source_bank") == [
        ("C1", 'A "quoted", name', "Lee", None), ("C2", "Ann", "x\ty", None)]
    lined = landing.with_lineage(back).first()
    assert "/customers/" in lined["_source_file"] and lined["_ingested_at"] is not None


def test_json_shards_and_manifest(spark, tmp_path):
    df = bronze(spark, "card_transactions", *[dict(txn_id=f"T{i}") for i in range(40)])
    landing.export_source(df, str(tmp_path), "card_transactions", shards=4)
    landing.export_source(bronze(spark, "branches", {}), str(tmp_path), "branches", shards=1)
    (tmp_path / "accounts").mkdir()
    got = {r.source: r for r in landing.landing_manifest(
        spark, str(tmp_path), ["card_transactions", "branches", "accounts", "customers"]
    ).collect()}
    assert (got["customers"].files, got["customers"].landed) == (0, False)
    assert (got["card_transactions"].files, got["card_transactions"].row_count) == (4, 40)
    assert got["card_transactions"].smallest_file_rows >= 5
    assert got["card_transactions"].bytes > 0
    assert (got["accounts"].files, got["accounts"].landed) == (0, False)
    back = landing.read_source(spark, str(tmp_path), "card_transactions")
    assert dict(back.dtypes)["amount"] == "string" and back.first()["amount"] == "10.0"


@pytest.mark.parametrize("source", ["customers", "card_transactions"])
def test_stream_takes_new_files_only(spark, tmp_path, source):
    land, out, progress = (str(tmp_path / n) for n in ("land", "out", "progress"))
    key = landing.landing_schema(source).fieldNames()[0]
    run = lambda: ingest.source_to_bronze(spark, land, source, out, progress)
    landing.export_source(bronze(spark, source, {key: "1"}, {key: "2"}), land, source)
    assert rows(run(), key) == [("1",), ("2",)]
    assert run().count() == 2
    landing.export_source(bronze(spark, source, {key: "3"}), land, source)
    bronze_table = run()
    assert rows(bronze_table, key) == [("1",), ("2",), ("3",)]
    assert bronze_table.filter("_source_file IS NULL OR _ingested_at IS NULL").count() == 0
    assert bronze_table.select("_ingested_at").distinct().count() == 2


def test_stream_dedupe_across_runs(spark, tmp_path):
    land, out, progress = (str(tmp_path / n) for n in ("land", "out", "progress"))
    schema = landing.landing_schema("card_transactions")
    run = lambda: ingest.stream_dedupe(
        spark, f"{land}/card_transactions", schema, "txn_id", out, progress)
    landing.export_source(bronze(spark, "card_transactions", dict(txn_id="1"), dict(txn_id="1"),
                                 dict(txn_id="2")), land, "card_transactions")
    assert rows(run(), "txn_id") == [("1",), ("2",)]
    landing.export_source(bronze(spark, "card_transactions", dict(txn_id="2"), dict(txn_id="3")),
                          land, "card_transactions")
    assert rows(run(), "txn_id") == [("1",), ("2",), ("3",)]


def test_stream_dedupe_of_a_hot_key_over_many_files(spark, tmp_path):
    land, out, progress = (str(tmp_path / n) for n in ("land", "out", "progress"))
    rows_in = [dict(txn_id="hot" if i % 3 == 0 else f"T{i % 50}") for i in range(300)]
    landing.export_source(bronze(spark, "card_transactions", *rows_in), land,
                          "card_transactions", shards=6)
    for max_files in (2, None):
        once = ingest.stream_dedupe(
            spark, f"{land}/card_transactions", landing.landing_schema("card_transactions"),
            "txn_id", out, progress, max_files=max_files)
        assert rows(once, "txn_id") == sorted({(r["txn_id"],) for r in rows_in})


def sources(spark):
    return {
        "customers": bronze(spark, "customers", {}, dict(customer_id="C2", date_of_birth="")),
        "accounts": bronze(spark, "accounts", {}, dict(account_id="A2", balance="-1")),
        "branches": bronze(spark, "branches", {}),
        "customer_events": bronze(spark, "customer_events", {}),
        "card_transactions": bronze(spark, "card_transactions", {}, {},
                                    dict(txn_id="T2", amount=1e6)),
    }


def test_build_and_promote(spark):
    names = build(spark, sources(spark), "assay_test_src")
    assert set(tables.level_tables("medallion")) <= set(names)
    target = session.new_folder(spark, "assay_test_dst")
    tables.create_database(spark, "assay_test_dst", target)
    counts = dict(rows(tables.promote(
        spark, "assay_test_src", "assay_test_dst", tables.level_tables("medallion"))))
    assert counts["bronze_card_transactions"] == 3
    assert counts["silver_customers"] == counts["silver_customers_quarantine"] == 1
    assert counts["silver_accounts"] == counts["silver_accounts_quarantine"] == 1
    assert counts["silver_card_transactions"] == 1
    assert counts["gold_customer_360"] == counts["gold_transaction_facts"] == 1
    assert spark.table("assay_test_src.silver_txn_quarantine").count() == 1
    with pytest.raises(ValueError, match="gold_customers_scored"):
        tables.promote(spark, "assay_test_src", "assay_test_dst", tables.level_tables("scored"))
    with pytest.raises(ValueError):
        tables.level_tables("none")


def test_build_with_nothing_clean(spark):
    empty = {**sources(spark), "customers": bronze(spark, "customers", dict(date_of_birth=""))}
    build(spark, empty, "assay_test_empty")
    assert spark.table("assay_test_empty.silver_customers").count() == 0
    assert spark.table("assay_test_empty.silver_customers_quarantine").count() == 1
    assert spark.table("assay_test_empty.gold_customer_360").count() == 0


def test_shuffles_follow_the_input(spark, tmp_path, monkeypatch):
    spark.range(200000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    width = "spark.sql.shuffle.partitions"
    old = spark.conf.get(width)
    try:
        session.fit_shuffles(df)
        assert spark.conf.get(width) == old
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 1000)
        session.fit_shuffles(df)
        assert int(spark.conf.get(width)) > int(old)
        session.tune(spark)
        assert spark.conf.get(width) == old
        session.fit_shuffles(df)
        spark.conf.set(width, "13")
        session.tune(spark)
        assert spark.conf.get(width) == "13"
    finally:
        spark.conf.set(width, old)


def test_late_files_are_taken(spark, tmp_path):
    """A file whose time lies far behind the newest one's is neither passed over nor dropped."""
    land, out, progress, once, kept = (
        str(tmp_path / n) for n in ("land", "out", "progress", "once", "kept"))
    schema = landing.landing_schema("card_transactions")
    for key in ("1", "2"):
        landing.export_source(bronze(spark, "card_transactions", dict(txn_id=key)), land,
                              "card_transactions", shards=1)
        if key == "2":
            for file in (tmp_path / "land" / "card_transactions").glob("*.json"):
                if f'"{key}"' in file.read_text():
                    os.utime(file, (1e9, 1e9))
        bronze_table = ingest.source_to_bronze(spark, land, "card_transactions", out, progress)
        deduped = ingest.stream_dedupe(spark, f"{land}/card_transactions", schema, "txn_id",
                                       once, kept)
    assert rows(bronze_table, "txn_id") == rows(deduped, "txn_id") == [("1",), ("2",)]


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


BRANCH_HEADER = "branch_id,branch_name,branch_state,branch_region,opened_date"


def test_csv_columns_by_name(spark, tmp_path):
    land = tmp_path / "branches"
    write(land, "a.csv", f"{BRANCH_HEADER}\nB1,Main,TN,South,2001-01-01\n")
    write(land, "b 1%.csv", "branch_name,extra,branch_id,\nSide,9,B2,\n")
    write(land, "c.csv", "branch_name,branch_id\n")
    write(land, "d.csv", "")
    write(land, "e.csv", "\ufeff\"branch_id\",branch_name\r\nB3,\"One, two\"\r\n")
    got = landing.read_source(spark, str(tmp_path), "branches", lineage=True)
    assert rows(got, "branch_id", "branch_name", "branch_state") == [
        ("B1", "Main", "TN"), ("B2", "Side", None), ("B3", "One, two", None)]
    assert len(rows(got.select("_source_file").distinct())) == 3
    manifest = landing.landing_manifest(spark, str(tmp_path), ["branches"]).first()
    assert (manifest.files, manifest.row_count, manifest.smallest_file_rows) == (5, 3, 0)
    assert manifest.bytes == sum(f.stat().st_size for f in land.iterdir())
    streamed = ingest.source_to_bronze(spark, str(tmp_path), "branches", str(tmp_path / "o"),
                                       str(tmp_path / "p"))
    assert rows(streamed.drop("_ingested_at")) == rows(got.drop("_ingested_at"))
    write(land, "f.csv", "branch_id,branch_id\nB4,B4\n")
    with pytest.raises(ValueError, match="repeated_column.*f.csv"):
        landing.read_source(spark, str(tmp_path), "branches")


def test_headers_are_read_by_one_job(spark, tmp_path):
    land = tmp_path / "branches"
    names = BRANCH_HEADER.split(",")
    for i in range(200):
        own = names[::-1] if i % 2 else names
        line = dict(zip(names, (f"B{i}", "Main", "TN", "South", "2001-01-01")))
        write(land, f"{i}.csv", ",".join(own) + "\n" + ",".join(line[n] for n in own) + "\n" * 3)
    context = spark.sparkContext
    context.setJobGroup("headers", "headers")
    try:
        got = landing.read_source(spark, str(tmp_path), "branches")
        jobs = context.statusTracker().getJobIdsForGroup("headers")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 8  # listings of many files, and the stages of one aggregate
    assert rows(got, "branch_id", "opened_date") == sorted(
        (f"B{i}", "2001-01-01") for i in range(200))


def test_first_lines_stop_early(spark, tmp_path):
    write(tmp_path, "long.csv", "a,b\n" + "1,2\n" * 200_000)
    write(tmp_path, "blank.csv", "\nx\n")
    assert [r[1] for r in rows(landing.first_lines(spark, str(tmp_path)))] == ["", "a,b"]


def test_faulty_files_are_set_aside_and_the_stream_goes_on(spark, tmp_path):
    land, out, progress = tmp_path / "branches", str(tmp_path / "o"), str(tmp_path / "p")
    run = lambda: ingest.source_to_bronze(
        spark, str(tmp_path), "branches", out, progress, max_files=1)
    land.mkdir()
    assert run().count() == 0
    assert ingest.rejected_lines(spark, out).count() == 0
    write(land, "a.csv", f"{BRANCH_HEADER}\nB1,Main,TN,South,2001-01-01\n")
    write(land, "b.csv", "when,what\n1,2\n3,4\n")
    write(land, "c.csv", "branch_id,branch_id\nB9,B8\n")
    assert rows(run(), "branch_id") == [("B1",)]
    write(land, "d.csv", "branch_name,branch_id\nSide,B2\n")
    assert rows(run(), "branch_id", "branch_name") == [("B1", "Main"), ("B2", "Side")]
    bad = ingest.rejected_lines(spark, out)
    assert rows(bad, "reason", "line") == [
        ("no_declared_column", "1,2"), ("no_declared_column", "3,4"),
        ("no_declared_column", "when,what"), ("repeated_column", "B9,B8"),
        ("repeated_column", "branch_id,branch_id")]


def test_a_batch_that_is_run_again_leaves_each_row_once(spark, tmp_path, monkeypatch):
    land, out, progress = tmp_path / "branches", str(tmp_path / "o"), str(tmp_path / "p")
    run = lambda: ingest.source_to_bronze(spark, str(tmp_path), "branches", out, progress)
    write(land, "a.csv", f"{BRANCH_HEADER}\nB1,Main,TN,South,2001-01-01\n")
    run()
    write(land, "b.csv", "branch_id\nB2\n")
    write(land, "c.csv", "other\n1\n")
    plain, calls = ingest.batch_folder, []

    def fail(spark, folder, *rest):
        calls.append(folder)
        if folder.endswith("_rejected"):
            raise RuntimeError("lost")
        return plain(spark, folder, *rest)

    monkeypatch.setattr(ingest, "batch_folder", fail)
    with pytest.raises(Exception, match="lost"):
        run()
    assert len(calls) == 2  # the rows were written before the run ended
    monkeypatch.setattr(ingest, "batch_folder", plain)
    assert rows(run(), "branch_id") == [("B1",), ("B2",)]
    assert ingest.rejected_lines(spark, out).count() == 2
    # Another checkpoint takes all files anew, beside and not over what is there.
    ingest.source_to_bronze(spark, str(tmp_path), "branches", out, str(tmp_path / "p2"))
    assert rows(run(), "branch_id") == [("B1",), ("B1",), ("B2",), ("B2",)]


def test_first_by_time_whenever_it_comes(spark, tmp_path):
    land, progress = str(tmp_path / "land"), str(tmp_path / "p")
    schema = landing.landing_schema("card_transactions")
    spark.sql("DROP TABLE IF EXISTS assay_test_firsts")
    run = lambda **more: ingest.stream_first(
        spark, f"{land}/card_transactions", schema, "txn_id", "txn_ts", "assay_test_firsts",
        str(tmp_path / "t"), progress, buckets=4, **more)
    deliveries = [
        [dict(txn_id="T1", txn_ts="2026-03-01"), dict(txn_id="T2", txn_ts="2026-03-01"),
         *[dict(txn_id="hot", txn_ts=f"2026-02-{d:02d}") for d in range(10, 28)]],
        [dict(txn_id="T1", txn_ts="2026-01-01", amount="7"), dict(txn_id="T3", txn_ts=None),
         dict(txn_id="hot", txn_ts="2026-01-05")],
        [dict(txn_id="T1", txn_ts="2026-01-01", amount="5"),
         dict(txn_id="T2", txn_ts="2027-01-01"), dict(txn_id=None, txn_ts="2026-01-01")]]
    taken = []
    for delivery in deliveries:
        taken += delivery
        landing.export_source(bronze(spark, "card_transactions", *delivery), land,
                              "card_transactions", shards=2)
        got = run(max_files=1)
        whole = bronze(spark, "card_transactions", *taken)
        others = [c for c in schema.names if c not in ("txn_id", "txn_ts")]
        assert rows(got) == rows(dedupe_first(whole, ["txn_id"], "txn_ts", others))
    # The table is compared bucket by bucket: no row of it moves.
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    before = rows(got)
    table = ingest.compact_first(spark, schema, "txn_id", "txn_ts", "assay_test_firsts",
                                 str(tmp_path / "t2"), buckets=4)
    assert rows(table) == before and rows(run()) == before
    spark.sql("DROP TABLE assay_test_firsts")


def test_unreadable_lines_are_kept(spark, tmp_path):
    write(tmp_path / "card_transactions", "a.json", "\n".join([
        '{"txn_id":"T1","account_id":"A1","amount":5.5,"txn_ts":"2026-01-01"}',
        '{"txn_id":"T2","amo', '{"txn_id":"T3","amo', '{"txn_id":"T4","amount":"12.5"}',
        '{"txn_id":"T5","amount":"much"}', '{"amount":1}', '{"amount":1}']))
    judged = silver.judge_transactions(
        landing.read_source(spark, str(tmp_path), "card_transactions"))
    assert rows(silver.clean_transactions(judged), "txn_id", "amount") == [
        ("T1", 5.5), ("T4", 12.5)]
    assert rows(silver.transactions_quarantine(judged), "txn_id", "raw_text",
                "quarantine_reason") == sorted([
        (None, '{"txn_id":"T2","amo', "missing_txn_id"),
        (None, '{"txn_id":"T3","amo', "missing_txn_id"), ("T5", "much", "unparseable_amount"),
        (None, None, "missing_txn_id"), (None, None, "missing_txn_id")], key=repr)


def test_build_twice(spark, tmp_path):
    for location in (None, str(tmp_path / "lake")):
        name = f"assay_test_twice_{location is None}".lower()
        for _ in range(2):
            names = build(spark, sources(spark), name, location=location)
        counts = dict(rows(tables.table_counts({n: spark.table(f"{name}.{n}") for n in names})))
        assert counts["silver_accounts"] == counts["silver_txn_quarantine"] == 1
    judged = list((tmp_path / "lake" / "silver_accounts").glob("judged-*"))
    assert len(judged) == 1


def test_write_table_replaces_schema(spark):
    tables.create_database(spark, "assay_test_w", session.new_folder(spark, "assay_test_w"))
    tables.write_table(spark.range(3), "assay_test_w.t")
    again = tables.write_table(spark.range(2).selectExpr("id AS a", "'x' AS b"),
                               "assay_test_w.t")
    assert again.columns == ["a", "b"] and again.count() == 2


def test_stage_round_trip(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    staged = session.stage(df, "staged")
    assert rows(staged) == rows(df) and staged.schema == df.schema
    assert all(session.work_root(spark) in f for f in staged.inputFiles())


def test_stream_dedupe_state_keeps_no_paths(spark, tmp_path):
    progress = str(tmp_path / "progress")
    landing.export_source(bronze(spark, "card_transactions", {}), str(tmp_path / "land"),
                          "card_transactions")
    ingest.stream_dedupe(
        spark, str(tmp_path / "land" / "card_transactions"),
        landing.landing_schema("card_transactions"), "txn_id", str(tmp_path / "out"), progress)
    kept = [dict(spark.read.format("statestore").option("operatorId", n).load(progress)
                 .select("key.*").dtypes) for n in (0, 1)]
    assert sorted(kept, key=len) == [{"txn_id": "string"}, {"txn_id": "string", "_files": "int"}]


def test_buckets_of_first_rows_follow_the_shuffle_width(spark, tmp_path):
    landing.export_source(bronze(spark, "card_transactions", *[
        dict(txn_id=f"T{i}") for i in range(40)]), str(tmp_path / "land"), "card_transactions")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.sql("DROP TABLE IF EXISTS assay_test_width")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        got = ingest.stream_first(
            spark, str(tmp_path / "land" / "card_transactions"),
            landing.landing_schema("card_transactions"), "txn_id", "txn_ts", "assay_test_width",
            str(tmp_path / "t"), str(tmp_path / "p"))
        told = {r.col_name: r.data_type for r in spark.sql(
            "DESCRIBE FORMATTED assay_test_width").collect()}
        assert told["Num Buckets"] == "13" and got.count() == 40
        # Each task of the batch wrote into one bucket.
        assert len(list((tmp_path / "t").glob("*.parquet"))) <= 13
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("DROP TABLE IF EXISTS assay_test_width")


def test_tables_are_written_with_zstd(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False)], "n int, good boolean")
    database = tables.create_database(spark, "assay_test_zstd", str(tmp_path / "db"))
    tables.write_table(df, "assay_test_zstd.plain")
    tables.write_split(df, "assay_test_zstd.parts", str(tmp_path / "parts"), F.col("good"), ["n"])
    files = [*(tmp_path / "db").rglob("*.parquet"), *(tmp_path / "parts").rglob("*.parquet")]
    assert database and files and all(f.name.endswith(".zstd.parquet") for f in files)
