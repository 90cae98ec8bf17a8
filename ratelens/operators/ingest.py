"""From raw source records to the stored table: typed parsing, guards, newer-wins merge, sync history."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.numeric import dec, mean_of, rounded
from ratelens.functions.parsing import is_unparsed, number_text, parse_date, parse_number, parse_timestamp, value_class
from ratelens.functions.ranking import top_per_group
from ratelens.sources import schemas
from ratelens.sources.schemas import conform

# Source field -> column and kind.
FIELD_MAP = [
    ("Parent Company", "Company", "text"),
    ("Filing Company", "Subsidiary", "text"),
    ("Impacted State", "State", "text"),
    ("Product Line", "Product_Line", "text"),
    ("Rate Change Type", "Rate_Change_Type", "text"),
    ("Overall Rate Change Number", "Premium_Change_Number", "number"),
    ("Overall Rate Change", "Premium_Change_Amount_Text", "text"),
    ("Effective Date", "Effective_Date", "date"),
    ("Previous Increase Date", "Previous_Increase_Date", "date"),
    ("Previous Increase Number", "Previous_Increase_Number", "number"),
    ("Policyholders Affected Number", "Policyholders_Affected_Number", "number"),
    ("Policyholders Affected Text", "Policyholders_Affected_Text", "text"),
    ("Total Written Premium Number", "Total_Written_Premium_Number", "number"),
    ("Total Written Premium Text", "Total_Written_Premium_Text", "text"),
    ("SERFF Tracking Number", "SERFF_Tracking_Number", "text"),
    ("Specific Coverages", "Specific_Coverages", "text"),
    ("Filing Method", "Filing_Method", "text"),
    ("Current Status", "Current_Status", "text"),
    ("Date Submitted", "Date_Submitted", "date"),
    ("Disposition Date", "Disposition_Date", "date"),
    ("Name", "Stated_Reasons", "text"),
    ("Population", "Population", "text"),
    ("Impact Score", "Impact_Score", "number"),
    ("Renewals Date", "Renewals_Date", "date"),
    ("Last Modified", "Airtable_Last_Modified", "time"),
]
EFFECTIVE_FIELDS = ["Effective Date", "Effective Date Requested", "Effective Date (New)"]
TYPES = {
    f.name: f.dataType for f in [*schemas.FILINGS.fields, *schemas.FILING_EXTRAS.fields]
}


CORRUPT = "_unreadable_text"
#: Numbers whose column holds whole numbers only; a fraction does not fit.
WHOLE = [c for _, c, kind in FIELD_MAP if kind == "number" and isinstance(TYPES[c], T.IntegralType)]


class DuplicateRecordError(Exception):
    """A fetched batch holds a record id more than once."""


def filings_scan(filings: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Projection and filter of the stored table; both reach the parquet reader."""
    kept = filings if where is None else filings.filter(where)
    return kept.select(*columns)


# --- parsing ----------------------------------------------------------------------------------------


def _field(name: str) -> Column:
    return F.col(f"fields.`{name}`")


def _with_fields(records: DataFrame, *, texts: bool = True) -> DataFrame:
    """``fields`` as a struct of the known source fields, from a JSON object or a map of texts, and ``unreadable``.

    A record whose JSON cannot be read, or is missing, is unreadable; all its fields are NULL. Without ``texts`` only
    the fields of the other kinds are kept.
    """
    names = dict.fromkeys([*(source for source, _, kind in FIELD_MAP if texts or kind != "text"), *EFFECTIVE_FIELDS])
    if dict(records.dtypes)["fields"] == "string":
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        parsed = F.from_json("fields", schema, {"columnNameOfCorruptRecord": CORRUPT})
        # as the output of a generator, so that a filter on the fields doesn't parse the text a second time
        others = [F.col(c) for c in records.columns if c != "fields"]
        read = records.select(*others, F.col("fields").alias("given"), F.explode(F.array(parsed)).alias("fields"))
        unreadable = F.col("fields").isNull() | F.col(f"fields.{CORRUPT}").isNotNull()
        return read.withColumn("unreadable", unreadable).withColumn("raw", F.when(F.col("unreadable"), F.col("given"))).drop("given")
    named = F.struct(*[F.try_element_at(F.col("fields"), F.lit(n)).alias(n) for n in names])
    missing = F.col("fields").isNull()
    return records.withColumns({"unreadable": missing, "raw": F.lit(None).cast("string"), "fields": named})


def _sources(kind: str) -> list[str]:
    return [source for source, _, k in FIELD_MAP if k == kind]


#: Numbers stay texts until their column is known: a decimal is cast from its digits, not by way of a double.
READERS = {"number": number_text, "date": parse_date, "time": parse_timestamp}


def _texts(kind: str) -> list[str]:
    """Source fields of a kind; the other spellings of the effective date come after the dates."""
    return _sources(kind) + (EFFECTIVE_FIELDS[1:] if kind == "date" else [])


def _given(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def _read(kind: str):
    return lambda text: F.when(_given(text), READERS[kind](text))


def _with_parsed(records: DataFrame, *, texts: bool = True) -> DataFrame:
    """Adds raw values and parsed values of the number, date and time fields, as one array per kind.

    Numbers and dates are spelled out per place, and so are compiled. The lambda over the times is not, which keeps this step out of
    whole-stage code: there all fields would make one method, too large for the JVM to compile.
    """
    read = _with_fields(records, texts=texts).withColumns({f"raw_{kind}s": F.array(*[_field(f) for f in _texts(kind)]) for kind in READERS})
    spelled = {f"{kind}s": F.array(*[_read(kind)(_field(f)) for f in _texts(kind)]) for kind in ("number", "date")}
    return read.withColumns({**spelled, "times": F.transform("raw_times", _read("time"))})


#: The whole numbers from the first limit to before the second one fit a column. Others are left out by a comparison, as
#: a failed cast costs an exception per value.
LIMITS = {T.IntegerType(): (-(2.0**31), 2.0**31), T.LongType(): (-(2.0**63), 2.0**63)}


def _stored(column: str, value: Column) -> Column:
    """A number, or another parsed value, as its column holds it; NULL where it does not fit."""
    if column not in WHOLE:
        return value.try_cast(TYPES[column])
    number = value.try_cast("double")
    least, end = LIMITS[TYPES[column]]
    return F.when((number == F.floor(number)) & (number >= least) & (number < end), number.try_cast(TYPES[column]))


def _value(source: str, column: str, kind: str) -> Column:
    if kind == "text":
        return F.coalesce(_field(source), F.lit("")).try_cast(TYPES[column])
    values = F.col(f"{kind}s")
    value = values[_texts(kind).index(source)]
    if source == "Effective Date":
        value = F.coalesce(value, *[values[_texts(kind).index(f)] for f in EFFECTIVE_FIELDS[1:]])
    return _stored(column, value)


def typed_records(records: DataFrame, *, texts: bool = True) -> DataFrame:
    """Raw records ``(id, page, fields)`` as typed columns, with ``page``, ``broken``, ``unreadable`` and ``raw``; the text is parsed once.

    Unknown text is empty, values that cannot be read or held are NULL, and so is everything in a record whose JSON cannot be read;
    ``raw`` has its text. Text columns come only with ``texts``; no other column depends on them.
    """
    extra = ["page"] if "page" in records.columns else []
    wanted = [field for field in FIELD_MAP if texts or field[2] != "text"]
    columns = [_value(*field).alias(field[1]) for field in wanted]
    typed = _with_parsed(records, texts=texts).select(
        F.col("id").alias("Record_ID"), *columns, *extra, "unreadable", "raw", *[c for kind in READERS for c in (f"raw_{kind}s", f"{kind}s")]
    )
    # spelled out per place: lambdas over pairs of arrays are not compiled
    held = {kind: [F.col(f"{kind}s")[i] for i in range(len(_texts(kind)))] for kind in ("date", "time")}
    held["number"] = [F.col(column) for _, column, kind in FIELD_MAP if kind == "number"]
    lost = [F.coalesce(_given(F.col(f"raw_{kind}s")[i]) & value.isNull(), F.lit(False)) for kind in held for i, value in enumerate(held[kind])]
    broken = reduce(or_, lost, F.col("unreadable"))
    return typed.select("Record_ID", *[column for _, column, _ in wanted], *extra, broken.alias("broken"), "unreadable", "raw")


def raw_to_filings(records: DataFrame) -> DataFrame:
    """Raw records ``(id, fields)`` as typed filings, see ``typed_records``.

    Records whose JSON cannot be read give no filing; ``unreadable_records`` has them.
    """
    return typed_records(records).filter(~F.col("unreadable")).select("Record_ID", *[column for _, column, _ in FIELD_MAP])


def unreadable_records(records: DataFrame) -> DataFrame:
    """The records whose JSON cannot be read, as they came."""
    others = [c for c in records.columns if c != "fields"]
    return _with_fields(records).filter("unreadable").select(*others, F.col("raw").alias("fields"))


def parse_numbers(records: DataFrame, column: str) -> DataFrame:
    return records.select("id", F.col(column).alias("raw"), parse_number(F.col(column)).alias("parsed"))


def parse_dates(records: DataFrame, column: str) -> DataFrame:
    return records.select("id", F.col(column).alias("raw"), parse_date(F.col(column)).alias("parsed"))


def parse_timestamps(records: DataFrame, column: str) -> DataFrame:
    return records.select("id", F.col(column).alias("raw"), parse_timestamp(F.col(column)).alias("parsed"))


def parse_error_count(records: DataFrame) -> DataFrame:
    """Per page the records of which something given could not be read or does not fit its column."""
    return typed_records(records, texts=False).groupBy("page").agg(F.count(F.lit(1)).alias("records"), F.count_if("broken").alias("parsing_errors"))


# --- which records to fetch ---------------------------------------------------------------------------


def last_successful_sync(history: DataFrame) -> DataFrame:
    """Newest completed sync; one row of NULLs if there is none."""
    done = history.filter((F.col("status") == "completed") & F.col("completed_at").isNotNull())
    key = F.struct("completed_at", "sync_id")
    return done.agg(
        F.max_by("sync_id", key).alias("sync_id"), F.max("completed_at").alias("completed_at")
    )


def sync_mode_resolve(history: DataFrame, since: datetime | None = None) -> DataFrame:
    """Manual if a time is given (1900-01-01 means full), incremental after a completed sync, else full."""
    if since is not None:
        mode = "full" if since <= datetime(1900, 1, 1) else "manual"
        start = None if mode == "full" else since
        return history.sparkSession.range(1).select(
            F.lit(mode).alias("sync_mode"), F.lit(start).cast("timestamp_ntz").alias("since")
        )
    last = last_successful_sync(history)
    return last.select(
        F.when(F.col("completed_at").isNull(), "full").otherwise("incremental").alias("sync_mode"),
        F.col("completed_at").alias("since"),
    )


def is_recent(modified: Column, last_sync: datetime | Column) -> Column:
    """Changed since the last sync, with five minutes of overlap for clock skew."""
    last = F.lit(last_sync).cast("timestamp_ntz") if isinstance(last_sync, datetime) else last_sync
    return modified > last - F.expr("INTERVAL '5' MINUTES")


def incremental_filter(records: DataFrame, last_sync: datetime | Column, column: str) -> DataFrame:
    """Records changed since the last sync, see ``is_recent``."""
    return records.filter(is_recent(F.col(column), last_sync))


# --- duplicate guard ----------------------------------------------------------------------------------


def duplicate_ids(batch: DataFrame, column: str = "Record_ID") -> DataFrame:
    """Ids that occur more than once, on one page or across pages."""
    return batch.groupBy(column).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_unique_ids(batch: DataFrame, column: str = "Record_ID") -> DataFrame:
    """The batch itself; raises before anything is written if an id repeats.

    Eight-byte hashes of the ids are counted first; only where one repeats, the ids themselves are compared.
    """
    hashes = batch.groupBy(F.xxhash64(column).alias("hash")).agg(F.count(F.lit(1)).alias("copies"))
    if (hashes.agg(F.max("copies")).first()[0] or 0) < 2:
        return batch
    repeated = duplicate_ids(batch, column).limit(5).collect()
    if repeated:
        raise DuplicateRecordError("repeated record ids: " + ", ".join(str(r[0]) for r in repeated))
    return batch


# --- newer-wins merge ---------------------------------------------------------------------------------

MODIFIED = "Airtable_Last_Modified"


def _is_newer(new: Column, old: Column) -> Column:
    return F.coalesce(new > old, new.isNotNull() & old.isNull())


def _known(target: DataFrame, batch: DataFrame, *columns: str) -> DataFrame:
    """Ids, times and ``columns`` of the target rows that the batch touches; at most as many rows as the batch."""
    return target.select("Record_ID", F.col(MODIFIED).alias("stored_modified"), *columns).join(
        batch.select("Record_ID"), "Record_ID", "left_semi"
    )


def upsert(target: DataFrame, batch: DataFrame) -> DataFrame:
    """New snapshot: unknown ids are added, known ids replaced only by a newer copy.

    The target keeps its place on the left of a left join, so a batch small enough to broadcast is
    merged without shuffling the target; a large one is joined by a sort-merge join on the unique id.
    """
    carried = [c for c in batch.columns if c in target.columns and c != "Record_ID"]
    incoming = batch.select("Record_ID", F.struct(*carried).alias("incoming"))
    newer = F.coalesce(_is_newer(F.col(f"incoming.{MODIFIED}"), F.col(MODIFIED)), F.lit(False))
    merged = target.join(incoming, "Record_ID", "left").select(
        *[
            F.when(newer & F.col("incoming").isNotNull(), F.col(f"incoming.{c}")).otherwise(F.col(c)).alias(c)
            if c in carried
            else F.col(c)
            for c in target.columns
        ]
    )
    added = batch.join(_known(target, batch), "Record_ID", "left_anti")
    return merged.unionByName(conform(added, target.schema))


def with_actions(target: DataFrame, batch: DataFrame, *columns: str) -> DataFrame:
    """The batch with ``action``, what the merge does with a row (inserted, updated or skipped), and ``columns`` of the target's row."""
    known = _known(target, batch, *columns).withColumn("found", F.lit(True))
    newer = _is_newer(F.col(MODIFIED), F.col("stored_modified"))
    action = F.when(F.col("found").isNull(), "inserted").when(newer, "updated").otherwise("skipped")
    return batch.join(known, "Record_ID", "left").withColumn("action", action).drop("found", "stored_modified")


def upsert_actions(target: DataFrame, batch: DataFrame) -> DataFrame:
    """What the merge does with each batch row: inserted, updated or skipped."""
    return with_actions(target, batch).select("Record_ID", "action")


def upsert_change_counts(target: DataFrame, batch: DataFrame) -> DataFrame:
    counts = upsert_actions(target, batch).agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(F.col("action") == "inserted").alias("records_inserted"),
        F.count_if(F.col("action") == "updated").alias("records_updated"),
        F.count_if(F.col("action") == "skipped").alias("records_skipped"),
    )
    stored = target.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("total_records", F.col("records_inserted") + stored)


# --- sync history -------------------------------------------------------------------------------------


def sync_status(history: DataFrame, filings: DataFrame) -> DataFrame:
    """Latest sync and how many filings carry a modification time."""
    key = F.struct("started_at", "sync_id")
    last = history.agg(
        F.max_by(F.struct("sync_id", "started_at", "completed_at", "sync_mode", "status", "records_processed"), key).alias("last")
    )
    totals = filings.agg(F.struct(F.count(F.lit(1)).alias("total"), F.count(MODIFIED).alias("stamped")))
    return last.select("last.*", totals.scalar().alias("t")).select(
        "sync_id",
        "started_at",
        "completed_at",
        "sync_mode",
        "status",
        "records_processed",
        F.col("t.total").alias("total_filings"),
        F.col("t.stamped").alias("with_timestamps"),
        rounded(mean_of(F.col("t.stamped"), F.col("t.total")) * 100, 1).alias("with_timestamps_pct"),
    )


def sync_history_recent(history: DataFrame, *, k: int = 10) -> DataFrame:
    return (
        history.orderBy(F.desc("started_at"), F.desc("sync_id"))
        .limit(k)
        .select(
            "sync_id",
            "started_at",
            "sync_mode",
            "status",
            F.coalesce("records_processed", F.lit(0)).alias("records_processed"),
        )
    )


def sync_mode_backfill(history: DataFrame) -> DataFrame:
    mode = F.when(F.col("sync_id") == 1, "full").otherwise("incremental")
    return history.withColumn(
        "sync_mode", F.when(F.col("sync_mode") == "unknown", mode).otherwise(F.col("sync_mode"))
    )


def schema_conform(old: DataFrame) -> DataFrame:
    """Old layout to the current one; the previous increase is read from its percentage text."""
    text = F.regexp_replace(F.trim(F.col("Previous_Increase_Percentage")), r"\s*%$", "")
    fraction = (parse_number(text).try_cast("decimal(18,6)") * dec("0.01")).cast("decimal(10,4)")
    return conform(old.withColumn("Previous_Increase_Number", fraction))


# --- diagnosis ----------------------------------------------------------------------------------------


def field_value_profile(records: DataFrame, column: str, *, k: int = 3) -> DataFrame:
    """Kinds of values of a raw field: how many, the smallest and largest, and the first ``k`` distinct ones."""
    values = (
        records.groupBy(value_class(F.col(column)).alias("value_type"), F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = values.groupBy("value_type").agg(
        F.sum("n").alias("records"), F.min("value").alias("min_value"), F.max("value").alias("max_value")
    )
    first = top_per_group(values, ["value_type"], [F.asc_nulls_last("value")], k)
    examples = (
        first.groupBy("value_type")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("list"))
        .select("value_type", F.array_join("list.value", " | ").alias("examples"))
    )
    return totals.join(examples, "value_type")


def diagnose_rate_change(records: DataFrame, column: str, *, sample_size: int = 10) -> DataFrame:
    """A sample of the records in id order: how many values are readable, and the ones that are not."""
    sample = records.select("id", F.col(column).alias("raw")).orderBy("id").limit(sample_size)
    parsed = parse_number(F.col("raw"))
    bad = F.when(is_unparsed(F.col("raw"), parsed), F.struct("id", "raw"))
    return sample.agg(
        F.count(parsed).alias("valid_count"), F.sort_array(F.collect_list(bad)).alias("issues")
    )


def validate_numeric_fields(records: DataFrame, columns: list[str]) -> DataFrame:
    """Valid, invalid and empty values of each numeric field, all fields in one pass."""
    long = records.select(*columns).unpivot([], columns, "field", "raw")
    parsed = parse_number(F.col("raw"))
    return long.groupBy("field").agg(
        F.count(parsed).alias("valid"),
        F.count_if(is_unparsed(F.col("raw"), parsed)).alias("invalid"),
        F.count_if(F.coalesce(F.col("raw") == "", F.lit(True))).alias("empty"),
    )


def updated_since(filings: DataFrame, moment: datetime) -> DataFrame:
    after = F.col("Updated_At") > F.lit(moment).cast("timestamp_ntz")
    return filings.agg(F.count(F.lit(1)).alias("total"), F.count_if(after).alias("updated"))


def timestamp_coverage(filings: DataFrame) -> DataFrame:
    return filings.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(MODIFIED).alias("with_timestamp"),
        F.count_if(F.col(MODIFIED).isNull()).alias("without_timestamp"),
    )
