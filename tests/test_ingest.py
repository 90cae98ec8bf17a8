import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ratelens.functions.parsing import parse_date, parse_number, parse_timestamp
from ratelens.operators import ingest
from ratelens.plans import sync as sync_module
from ratelens.plans.sync import read_history, sync
from ratelens.sources.stored import YEAR, read_filings, read_stored, replace_years


def parsed(spark, texts, function):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(function(F.col("t"))).collect()]


def test_numbers(spark):
    given = ["0.15", "15.5", "", None, "invalid", " 0.25 ", "10", "1_000", "nan", "1e-2", "-.5", "+3."]
    assert parsed(spark, given, parse_number) == [0.15, 15.5, None, None, None, 0.25, 10.0, None, None, 0.01, -0.5, 3.0]


def test_dates(spark):
    given = ["2024-01-15", "2024-12-31", "", None, "invalid", "2024-02-30", "01/15/2024", "2024/01/15", "March 5, 2024",
             "2024-05-15T10:30:00.000Z", " 2024-01-15 ", "Smarch 5, 2024"]
    day = date(2024, 1, 15)
    assert parsed(spark, given, parse_date) == [
        day, date(2024, 12, 31), None, None, None, None, day, day, date(2024, 3, 5), date(2024, 5, 15), day, None,
    ]


def test_timestamps(spark):
    given = ["2024-05-15T10:30:00.000Z", "2024-05-15T10:30:00+02:00", "2024-05-15", "x", ""]
    assert parsed(spark, given, parse_timestamp) == [
        datetime(2024, 5, 15, 10, 30), datetime(2024, 5, 15, 8, 30), None, None, None,
    ]


def record(id, page=1, modified="2024-05-15T10:30:00.000Z", **fields):
    base = {
        "Parent Company": "Harbour Mutual",
        "Filing Company": "Harbour Auto",
        "Impacted State": "CA",
        "Product Line": "Auto",
        "Rate Change Type": "increase",
        "Overall Rate Change Number": "0.15",
        "Effective Date": "2024-06-01",
        "Last Modified": modified,
    }
    return (id, page, json.dumps({**base, **fields}))


@pytest.fixture
def records(spark):
    return lambda *rows: spark.createDataFrame(list(rows), "id string, page bigint, fields string")


def test_record_to_filing(records):
    row = ingest.raw_to_filings(records(record("f-17", Name="because"))).first()
    assert (row.Record_ID, row.Company, row.Subsidiary, row.State) == ("f-17", "Harbour Mutual", "Harbour Auto", "CA")
    assert float(row.Premium_Change_Number) == 0.15 and row.Effective_Date == date(2024, 6, 1)
    assert row.Stated_Reasons == "because" and row.Population == "" and row.Impact_Score is None
    assert row.Airtable_Last_Modified == datetime(2024, 5, 15, 10, 30)


def test_record_from_a_map_and_second_date_field(spark):
    rows = [("a", 1, {"Effective Date": "bad", "Effective Date Requested": "2024-07-01", "Parent Company": "X"})]
    df = spark.createDataFrame(rows, "id string, page bigint, fields map<string,string>")
    row = ingest.raw_to_filings(df).first()
    assert row.Company == "X" and row.Effective_Date == date(2024, 7, 1)


def test_error_count_keeps_records(records):
    df = records(
        record("a", **{"Overall Rate Change Number": "invalid"}),
        record("b", **{"Overall Rate Change Number": "", "Effective Date": "soon", "Impact Score": "?"}),
        record("c"),
    )
    assert tuple(ingest.parse_error_count(df).first()) == (1, 3, 2)


def test_values_that_do_not_fit_and_unreadable_records_count(records):
    df = records(
        record("a", **{"Overall Rate Change Number": "12345678"}),
        record("b", **{"Policyholders Affected Number": "9999999999"}),
        record("c", **{"Policyholders Affected Number": "12.9"}),
        record("d", **{"Impact Score": "1e12"}),
        record("e", **{"Effective Date Requested": "garbage"}),
        ("f", 1, '{"Parent Company": "cut o'),
        ("g", 1, None),
        record("h", **{"Policyholders Affected Number": "12.0"}),
    )
    assert tuple(ingest.parse_error_count(df).first()) == (1, 8, 7)
    stored = {r.Record_ID: r for r in ingest.raw_to_filings(df).collect()}
    assert sorted(stored) == ["a", "b", "c", "d", "e", "h"]
    assert stored["c"].Policyholders_Affected_Number is None and stored["h"].Policyholders_Affected_Number == 12
    assert sorted(r.id for r in ingest.unreadable_records(df).collect()) == ["f", "g"]


def files_of(base):
    """Data files of the table by year."""
    found = {}
    for f in (base / "filings").glob("effective_year=*/*.parquet"):
        found.setdefault(int(f.parent.name.split("=")[1]), set()).add(f.name)
    return found


def test_only_touched_years_are_rewritten_and_read(spark, records, tmp_path):
    base = str(tmp_path / "db")
    dates = {"a": "2021-03-01", "b": "2022-03-01", "c": "2023-03-01", "d": ""}
    sync(spark, records(*[record(i, **{"Effective Date": d}) for i, d in dates.items()]), base, now=datetime(2024, 5, 16))
    before = files_of(tmp_path / "db")
    assert set(before) == {0, 2021, 2022, 2023}
    moved = record("b", modified="2024-05-20T00:00:00.000Z", **{"Effective Date": "2023-06-01"})
    result = sync(spark, records(moved), base, now=datetime(2024, 5, 21))
    assert (result["records_updated"], result["total_records"]) == (1, 4)
    after = files_of(tmp_path / "db")
    assert set(after) == {0, 2021, 2023}  # the year that lost its only row has no folder any more
    assert after[0] == before[0] and after[2021] == before[2021] and not after[2023] & before[2023]
    some = read_filings(spark, f"{base}/filings", date(2023, 1, 1), date(2023, 12, 31))
    assert sorted(r.Record_ID for r in some.collect()) == ["b", "c"]
    assert "PartitionFilters: [isnotnull(effective_year" in some._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_left_behind(spark, records, tmp_path):
    base = str(tmp_path / "db")
    for day in range(1, 4):
        sync(spark, records(record("a", modified=f"2024-06-{day:02d}T00:00:00.000Z")), base, now=datetime(2024, 6, day, 1))
    assert len(list((tmp_path / "db" / "filings").glob("effective_year=*"))) == 1
    assert not list((tmp_path / "db" / "work").glob("*")) and len(list((tmp_path / "db" / "batches").glob("sync=*"))) == 3
    assert read_filings(spark, f"{base}/filings").count() == 1 and read_history(spark, base).count() == 3


def test_a_merge_that_broke_off_is_finished(spark, records, tmp_path, monkeypatch):
    base = str(tmp_path / "db")
    sync(spark, records(record("a"), record("b")), base, now=datetime(2024, 6, 1))
    with monkeypatch.context() as broken:
        broken.setattr(sync_module, "_put_in_place", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sync(spark, records(record("a", modified="2024-06-02T00:00:00.000Z", **{"Parent Company": "Late"})), base, now=datetime(2024, 6, 2))
    assert {r.Company for r in read_filings(spark, f"{base}/filings").collect()} == {"Harbour Mutual"}
    assert [r.status for r in read_history(spark, base).orderBy("sync_id").collect()] == ["completed", "merged"]
    result = sync(spark, records(record("c", modified="2024-06-03T00:00:00.000Z")), base, now=datetime(2024, 6, 3))
    assert result["sync_mode"] == "incremental" and result["total_records"] == 3
    assert {r.Record_ID: r.Company for r in read_filings(spark, f"{base}/filings").collect()}["a"] == "Late"
    history = read_history(spark, base).orderBy("sync_id").collect()
    assert [(r.status, r.records_updated) for r in history] == [("completed", 0), ("completed", 1), ("completed", 0)]


def test_records_are_parsed_once_and_unreadable_ones_kept(spark, records, tmp_path):
    base = str(tmp_path / "db")
    result = sync(spark, records(record("a"), ("f", 1, '{"Parent Company": "cut o'), ("g", 1, None)), base, now=datetime(2024, 6, 1))
    assert (result["records_processed"], result["parsing_errors"], result["total_records"]) == (1, 2, 1)
    landed = spark.read.parquet(f"{base}/batches/sync=1").filter("unreadable").orderBy("Record_ID").collect()
    assert [(r.Record_ID, r.raw) for r in landed] == [("f", '{"Parent Company": "cut o'), ("g", None)]


def target(spark, *rows):
    return spark.createDataFrame(
        list(rows), "Record_ID string, Company string, Airtable_Last_Modified timestamp_ntz, Subsidiary string"
    )


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "Record_ID string, Company string, Airtable_Last_Modified timestamp_ntz")


def test_newer_wins(spark):
    t0, t1, t2 = (datetime(2024, 1, d) for d in (1, 2, 3))
    old = target(spark, ("a", "A", t1, "s"), ("b", "B", t1, "s"), ("c", "C", None, "s"), ("d", "D", t1, "s"), ("e", "E", t1, "s"))
    new = batch(spark, ("a", "A2", t2), ("b", "B2", t0), ("c", "C2", t0), ("d", "D2", t1), ("x", "X", None))
    once = ingest.upsert(old, new)
    got = {r.Record_ID: (r.Company, r.Subsidiary) for r in once.collect()}
    assert got == {
        "a": ("A2", "s"), "b": ("B", "s"), "c": ("C2", "s"), "d": ("D", "s"), "e": ("E", "s"), "x": ("X", None),
    }
    assert sorted(map(tuple, ingest.upsert(once, new).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    counts = ingest.upsert_change_counts(old, new).first()
    assert tuple(counts) == (5, 1, 2, 2, 6)
    assert tuple(ingest.upsert_change_counts(once, new).first()) == (5, 0, 0, 5, 6)


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    t = datetime(2024, 1, 1)
    target(spark, *[(f"r{i}", "A", t, "s") for i in range(100)]).write.parquet(str(tmp_path / "t"))
    batch(spark, ("r1", "B", t)).write.parquet(str(tmp_path / "b"))
    merged = ingest.upsert(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "b")))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_sync_modes(spark):
    schema = "sync_id bigint, started_at timestamp_ntz, completed_at timestamp_ntz, status string"
    done = spark.createDataFrame([(1, datetime(2024, 1, 1), datetime(2024, 1, 2), "completed")], schema)
    assert tuple(ingest.sync_mode_resolve(done).first()) == ("incremental", datetime(2024, 1, 2))
    assert tuple(ingest.sync_mode_resolve(done.limit(0)).first()) == ("full", None)
    assert tuple(ingest.sync_mode_resolve(done, datetime(1900, 1, 1)).first()) == ("full", None)
    assert tuple(ingest.sync_mode_resolve(done, datetime(2024, 5, 1)).first()) == ("manual", datetime(2024, 5, 1))


def test_five_minutes_of_overlap(spark):
    last = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(m, last - timedelta(minutes=m)) for m in (-1, 4, 5, 6)], "m int, t timestamp_ntz")
    assert [r.m for r in ingest.incremental_filter(df, last, "t").orderBy("m").collect()] == [-1, 4]


@pytest.mark.parametrize("pages", [(1, 1), (1, 2)])
def test_repeated_id_fails_and_writes_nothing(spark, records, tmp_path, pages):
    base = str(tmp_path / "db")
    sync(spark, records(record("a")), base, now=datetime(2024, 6, 1))
    before = files_of(tmp_path / "db")
    copies = [record("dup", page, modified="2024-06-01T12:00:00.000Z") for page in pages]
    result = sync(spark, records(*copies), base, now=datetime(2024, 6, 2))
    assert not result["success"] and "dup" in result["error_message"]
    assert files_of(tmp_path / "db") == before
    history = read_history(spark, base).orderBy("sync_id").collect()
    assert [h.status for h in history] == ["completed", "failed"]


def test_sync_runs(spark, records, tmp_path):
    base = str(tmp_path / "db")
    first = sync(spark, records(record("a"), record("b")), base, now=datetime(2024, 5, 16))
    assert (first["sync_mode"], first["records_inserted"], first["total_records"]) == ("full", 2, 2)
    later = [
        record("a", modified="2024-05-20T00:00:00.000Z", **{"Parent Company": "Changed"}),
        record("b"),
        record("c", modified="2024-05-20T00:00:00.000Z", **{"Impact Score": "oops"}),
    ]
    second = sync(spark, records(*later), base, now=datetime(2024, 5, 21))
    assert (second["sync_mode"], second["records_processed"]) == ("incremental", 2)
    assert (second["records_inserted"], second["records_updated"], second["parsing_errors"]) == (1, 1, 1)
    stored = {r.Record_ID: r.Company for r in read_filings(spark, f"{base}/filings").collect()}
    assert stored == {"a": "Changed", "b": "Harbour Mutual", "c": "Harbour Mutual"}
    before = files_of(tmp_path / "db")
    again = sync(spark, records(*later), base, now=datetime(2024, 5, 22), since=datetime(2024, 5, 1))
    assert (again["sync_mode"], again["records_inserted"], again["records_updated"], again["records_skipped"]) == ("manual", 0, 0, 3)
    assert files_of(tmp_path / "db") == before


def test_old_layout(spark):
    rows = [("a", "12.5%"), ("b", "n/a"), ("c", None), ("d", " 3 % ")]
    got = ingest.schema_conform(spark.createDataFrame(rows, "Record_ID string, Previous_Increase_Percentage string"))
    assert len(got.columns) == 24 and dict(got.dtypes)["Premium_Change_Number"] == "decimal(10,4)"
    values = {r.Record_ID: r.Previous_Increase_Number for r in got.collect()}
    assert float(values["a"]) == 0.125 and values["b"] is None and values["c"] is None and float(values["d"]) == 0.03


def test_profiles(spark):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate([None, "", "5", "7", "0.5", "x", "2024-01-02"])], "id string, v string")
    kinds = {r.value_type: (r.records, r.examples) for r in ingest.field_value_profile(df, "v").collect()}
    assert kinds["integer"] == (2, "5 | 7") and set(kinds) == {"null", "empty", "integer", "decimal", "text", "date"}
    found = ingest.diagnose_rate_change(df, "v").first()
    assert found.valid_count == 3 and [i.raw for i in found.issues] == ["x", "2024-01-02"]
    assert tuple(ingest.validate_numeric_fields(df, ["v"]).first()) == ("v", 3, 2, 2)


def test_first_sync_joins_with_nothing(spark, records, tmp_path):
    batch = ingest.raw_to_filings(records(record("a"), record("b")))
    actions = ingest.with_actions(read_stored(spark, str(tmp_path / "none")), batch, YEAR)
    assert [(r.action, r[YEAR]) for r in actions.collect()] == [("inserted", None)] * 2
    assert "Join" not in actions._jdf.queryExecution().optimizedPlan().toString()


def test_replaced_years_keep_the_order_they_were_laid_in(spark, tmp_path):
    rows = [(f"r{i}", "Ohio", date(year, 1, 1), year) for year in (2022, 2023) for i in (3, 1, 2)]
    new = spark.createDataFrame(rows, f"Record_ID string, State string, Effective_Date date, {YEAR} int").coalesce(1)
    new.write.partitionBy(YEAR).parquet(str(tmp_path / "rows"))
    for _ in range(2):  # doing it again gives the same
        replace_years(read_stored(spark, str(tmp_path / "rows")), str(tmp_path / "filings"), [2022, 2023])
    stored = read_stored(spark, str(tmp_path / "filings"))
    assert stored.count() == 6
    for year in (2022, 2023):  # sorting again would spill large years to disk
        assert [r.Record_ID for r in stored.filter(f"{YEAR} = {year}").collect()] == ["r3", "r1", "r2"]


def test_whole_numbers_up_to_the_limits_of_their_column(records):
    given = {"2147483647": 2147483647, "2147483648": None, "-2147483648": -2147483648, "-2147483649": None, "1e300": None, "5.5": None, "1e3": 1000}
    rows = records(*[record(text, **{"Policyholders Affected Number": text}) for text in given])
    typed = ingest.typed_records(rows)
    assert {r.Record_ID: r.Policyholders_Affected_Number for r in typed.collect()} == given
    assert {r.Record_ID for r in typed.filter("broken").collect()} == {text for text, number in given.items() if number is None}


def test_numbers_and_dates_are_read_by_compiled_code(records):
    plan = ingest.raw_to_filings(records(record("a")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == 1  # the times; a lambda is worked off node by node for each value


def test_years_are_replaced_by_one_write_however_many_they_are(spark, tmp_path):
    jobs = []
    for n in (2, 12):
        base = tmp_path / str(n)
        rows = [(f"r{i}", "Ohio", date(2000 + year, 1, 1), 2000 + year) for year in range(n) for i in (3, 1, 2)]
        new = spark.createDataFrame(rows, f"Record_ID string, State string, Effective_Date date, {YEAR} int").coalesce(1)
        new.write.partitionBy(YEAR).parquet(str(base / "rows"))
        spark.sparkContext.setJobGroup(f"years {n}", "")
        replace_years(read_stored(spark, str(base / "rows")), str(base / "filings"), [2000 + year for year in range(n)])
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"years {n}")))
        spark.sparkContext._jsc.clearJobGroup()
        stored = read_stored(spark, str(base / "filings"))
        assert sorted(map(tuple, stored.select("Record_ID", YEAR).collect())) == sorted((r[0], r[3]) for r in rows)
    assert jobs[0] == jobs[1]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_what_a_sync_writes_and_joins(spark, records, tmp_path, monkeypatch):
    base, plans, packed = str(tmp_path / "db"), [], sync_module.packed

    def seen(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return packed(rows)

    monkeypatch.setattr(sync_module, "packed", seen)
    sync(spark, records(record("a"), record("b")), base, now=datetime(2024, 5, 16))
    assert len(plans) == 2  # the batch, the rows; all are new, so the changes are the batch
    plans.clear()
    sync(spark, records(record("c", modified="2024-05-20T00:00:00.000Z")), base, now=datetime(2024, 5, 21))
    assert len(plans) == 3 and "Join" not in plans[-1]  # nothing was updated, so nothing gives way
    plans.clear()
    sync(spark, records(record("a", modified="2024-05-22T00:00:00.000Z")), base, now=datetime(2024, 5, 23))
    assert len(plans) == 3 and "Join LeftAnti" in plans[-1]
    assert read_filings(spark, f"{base}/filings").count() == 3


def test_missing_ids_repeat_too(spark):
    with pytest.raises(ingest.DuplicateRecordError, match="None"):
        ingest.require_unique_ids(spark.createDataFrame([("a",), (None,), (None,)], "Record_ID string"))
    assert ingest.require_unique_ids(spark.createDataFrame([("a",), (None,)], "Record_ID string")).count() == 2
    assert ingest.require_unique_ids(spark.createDataFrame([], "Record_ID string")).count() == 0
