"""Views over the given star-schema tables that stand in for the production tables.

``ratelens/oracle/views.py`` holds the same definitions as SQL text; keep both in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.states import STATE_ABBREVIATIONS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filing per line item: the supplier is the carrier, the customer's nation the state.

    Orders get their state first, so that the small side (orders x customer) is shuffled on the customer key
    and the line items only on the order key. No join is hinted: the given dimension tables grow
    with the data, so the size measured at run time decides which of them are broadcast.
    """
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "n_name")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
            " CAST(l_suppkey AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING)) AS Record_ID",
            "s_name AS Company",
            "p_brand AS Subsidiary",
            "n_name AS State",
            "p_type AS Product_Line",
            "CAST((CAST(round(l_discount*100) AS INT)-4)*3*0.01 AS DECIMAL(10,4)) AS Premium_Change_Number",
            "CAST(l_shipdate AS DATE) AS Effective_Date",
            "CASE WHEN l_linenumber=7 THEN NULL ELSE CAST(l_quantity AS INT)*100 END AS Policyholders_Affected_Number",
            "CAST(l_extendedprice AS DECIMAL(15,2)) AS Total_Written_Premium_Number",
            "CASE WHEN l_linenumber=6 THEN NULL ELSE CAST(l_quantity AS DECIMAL(10,2)) END AS Impact_Score",
        )
    )


def extended(base: DataFrame) -> DataFrame:
    """``filings`` with the remaining production columns that the operators read."""
    return base.selectExpr(
        "*",
        "CASE WHEN Premium_Change_Number > 0 THEN 'increase' WHEN Premium_Change_Number < 0 THEN 'decrease'"
        " ELSE 'no change' END AS Rate_Change_Type",
        "concat('SERFF-', Record_ID) AS SERFF_Tracking_Number",
        "date_sub(Effective_Date, 365) AS Previous_Increase_Date",
        "CAST(Premium_Change_Number * 0.5 AS DECIMAL(10,4)) AS Previous_Increase_Number",
        "date_add(Effective_Date, 30) AS Renewals_Date",
        "CAST(Effective_Date AS TIMESTAMP_NTZ) AS Airtable_Last_Modified",
        "CAST(date_add(Effective_Date, 1) AS TIMESTAMP_NTZ) AS Updated_At",
    )


def filings_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extended(filings(spark, sf_dir))


def filings_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filings`` with one state missing from 2001 on."""
    return filings(spark, sf_dir).filter(
        ~((F.col("State") == "NATION_7") & (F.col("Effective_Date") >= F.lit("2001-01-01").cast("date")))
    )


def filings_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filings`` in which every third line of an order was filed a second time under another id."""
    base = filings(spark, sf_dir)
    copies = base.filter(F.split_part("Record_ID", F.lit("-"), F.lit(2)) == "3").withColumn(
        "Record_ID", F.concat("Record_ID", F.lit("-copy"))
    )
    return base.unionByName(copies)


def filings_unnamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filings`` in which some parent companies were not given."""
    line = F.split_part("Record_ID", F.lit("-"), F.lit(2))
    company = (
        F.when(line == "3", F.lit("Not specified in document"))
        .when(line == "4", F.lit(""))
        .when(line == "5", F.lit(None).cast("string"))
        .otherwise(F.col("Company"))
    )
    subsidiary = F.when(line == "4", F.lit(None).cast("string")).otherwise(F.col("Subsidiary"))
    return filings(spark, sf_dir).withColumn("Company", company).withColumn("Subsidiary", subsidiary)


def old_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filings`` in the old layout: two-digit rates and the previous increase as percentage text."""
    return filings(spark, sf_dir).selectExpr(
        "Record_ID",
        "Company",
        "State",
        "CAST(Premium_Change_Number AS DECIMAL(10,2)) AS Premium_Change_Number",
        "Effective_Date",
        "CASE split_part(Record_ID, '-', 2) WHEN '1' THEN '' WHEN '2' THEN 'n/a'"
        " ELSE concat(CAST(CAST(Premium_Change_Number * 50 AS DECIMAL(10,1)) AS STRING), '%') END"
        " AS Previous_Increase_Percentage",
    )


RAW_COLUMNS = [
    "Record_ID AS id",
    "CAST(FLOOR(CAST(split_part(Record_ID, '-', 1) AS BIGINT) / 100) AS BIGINT) AS page",
    "Company AS parent_company",
    "Subsidiary AS filing_company",
    "State AS impacted_state",
    "Product_Line AS product_line",
    "CASE split_part(Record_ID, '-', 2) WHEN '1' THEN '' WHEN '2' THEN 'invalid'"
    " WHEN '3' THEN concat(' ', CAST(Premium_Change_Number AS STRING), ' ') WHEN '6' THEN '12345678'"
    " ELSE CAST(Premium_Change_Number AS STRING) END AS rate_change_raw",
    "CASE split_part(Record_ID, '-', 2) WHEN '4' THEN '' WHEN '5' THEN 'invalid'"
    " ELSE CAST(Effective_Date AS STRING) END AS effective_date_raw",
    "concat(CAST(Effective_Date AS STRING), 'T10:30:00.000Z') AS last_modified_raw",
    "CASE split_part(Record_ID, '-', 2) WHEN '5' THEN '1_000' WHEN '6' THEN 'about 500' WHEN '7' THEN '9999999999'"
    " WHEN '4' THEN '12.9'"
    " ELSE CAST(Policyholders_Affected_Number AS STRING) END AS policyholders_raw",
    "CASE split_part(Record_ID, '-', 2) WHEN '7' THEN '1e14' ELSE CAST(Total_Written_Premium_Number AS STRING) END"
    " AS premium_raw",
]


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records as text, with empty, bad and padded values."""
    return filings(spark, sf_dir).selectExpr(*RAW_COLUMNS)


def raw_field_maps(records: DataFrame) -> DataFrame:
    """The same records in the shape the source sends: an id and a JSON object of named fields, some cut off half-way."""
    named = {
        "Parent Company": "parent_company",
        "Filing Company": "filing_company",
        "Impacted State": "impacted_state",
        "Product Line": "product_line",
        "Overall Rate Change Number": "rate_change_raw",
        "Effective Date": "effective_date_raw",
        "Policyholders Affected Number": "policyholders_raw",
        "Total Written Premium Number": "premium_raw",
        "Last Modified": "last_modified_raw",
    }
    fields = F.to_json(F.struct(*[F.col(c).alias(name) for name, c in named.items()]))
    cut_off = (F.col("page") % 10 == 3) & (F.split_part("id", F.lit("-"), F.lit(2)) == "2")
    fields = F.when(cut_off, F.substring(fields, 1, 40)).otherwise(fields)
    return records.select("id", "page", fields.alias("fields"))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages of record ids in which an id can come back on a later page."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING)) AS id",
        "CAST(FLOOR(l_partkey / 20) AS BIGINT) AS page",
    )


def date_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective dates in the spellings that the source uses, with empty and bad values."""
    return filings(spark, sf_dir).selectExpr(
        "Record_ID AS id",
        "CASE split_part(Record_ID, '-', 2)"
        " WHEN '1' THEN date_format(Effective_Date, 'MM/dd/yyyy')"
        " WHEN '2' THEN concat(CAST(Effective_Date AS STRING), 'T10:30:00.000Z')"
        " WHEN '3' THEN concat(' ', CAST(Effective_Date AS STRING), ' ')"
        " WHEN '4' THEN '' WHEN '5' THEN 'invalid'"
        " ELSE CAST(Effective_Date AS STRING) END AS raw",
    )


def sync_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored snapshot that a sync is merged into."""
    return filings_ext(spark, sf_dir).filter(F.col("Effective_Date") < F.lit("2001-01-01").cast("date"))


def sync_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched rows: new ids and newer and older copies of known ones."""
    recent = filings_ext(spark, sf_dir).filter(F.col("Effective_Date") >= F.lit("2000-12-01").cast("date"))
    newer = F.split_part("Record_ID", F.lit("-"), F.lit(2)).isin("2", "4", "6")
    day = F.expr("INTERVAL '1' DAY")
    return recent.select(
        "Record_ID",
        "Company",
        "State",
        (F.col("Premium_Change_Number") * 2).cast("decimal(10,4)").alias("Premium_Change_Number"),
        "Effective_Date",
        F.when(newer, F.col("Airtable_Last_Modified") + day)
        .otherwise(F.col("Airtable_Last_Modified") - day)
        .alias("Airtable_Last_Modified"),
    )


def sync_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS sync_id",
        "ts AS started_at",
        "CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE ts + INTERVAL '90' SECOND END AS completed_at",
        "CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(FLOOR(value * 10) AS BIGINT) END AS records_processed",
        "CAST(event_id % 4 AS BIGINT) AS parsing_errors",
        "CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'completed' END AS status",
        "CASE WHEN event_id % 10 = 0 THEN 'full' WHEN event_id % 10 = 1 THEN 'unknown' ELSE 'incremental' END"
        " AS sync_mode",
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged reports of all months, the month as digits, name or short name; one edition in seven was not logged."""
    # the month of an aggregate, not of the key: conditions on what is made of it then stay above, with a row per month
    by_month = filings(spark, sf_dir).groupBy("State", F.trunc("Effective_Date", "month").alias("key"))
    months = by_month.agg(F.trunc(F.min("Effective_Date"), "month").alias("ym")).drop("key")
    number = "CAST(split_part(State, '_', 2) AS INT)"
    logged = months.filter(f"(year(ym) * 12 + month(ym) + 3 * {number}) % 7 <> 0")
    return logged.selectExpr(
        "concat('rep-', State, '-', CAST(ym AS STRING)) AS report_id",
        "concat(State, ' ', date_format(ym, 'MMMM yyyy')) AS Name",
        "State",
        f"CASE {number} % 3 WHEN 0 THEN date_format(ym, 'MM') WHEN 1 THEN date_format(ym, 'MMMM')"
        " ELSE date_format(ym, 'MMM') END AS Month",
        "CAST(year(ym) AS STRING) AS Year",
        "CASE month(ym) % 3 WHEN 0 THEN 'Generated' WHEN 1 THEN 'Approved' ELSE 'Sent' END AS Status",
    )


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State is a comma-separated multi-select; 'NATION_1' is a prefix of 'NATION_10' on purpose."""
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        "concat('sub-', CAST(c_custkey AS STRING)) AS subscriber_id",
        "CASE WHEN c_custkey % 10 = 0 AND n_name <> 'NATION_1' THEN concat(n_name, ',NATION_1') ELSE n_name END"
        " AS State",
        "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'bad-address'"
        " ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS Email",
        "c_acctbal > 0 AS Active",
        "c_custkey % 50 = 0 AS Test",
    )


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in the mail log: only active subscribers were written to, so other events are unknown."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    active = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select("c_custkey")
    return users.join(active, F.col("user_id") == F.col("c_custkey"), "left_semi").selectExpr(
        "concat('msg-', CAST(user_id AS STRING)) AS message_id",
        "concat('sub-', CAST(user_id AS STRING)) AS subscriber_id",
    )


EVENT_COLUMNS = [
    "event_id",
    "ts",
    "CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('msg-', CAST(user_id AS STRING)) END AS message_id",
    "CASE event_type WHEN 'signup' THEN 'Delivery' WHEN 'view' THEN 'Open' WHEN 'click' THEN 'Open'"
    " WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'Bounce' ELSE 'SpamComplaint' END"
    " ELSE CASE WHEN event_id % 5 = 0 THEN 'Unsubscribe' ELSE 'Click' END END AS record_type",
    "CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'HardBounce' END AS bounce_type",
    "CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN concat('mailbox ', CAST(user_id AS STRING)) END"
    " AS description",
]


def email_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*EVENT_COLUMNS)


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents with their state in lower case; one in nine has no address."""
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        "concat('agent-', CAST(s_suppkey AS STRING)) AS agent_id",
        "s_name AS name",
        "lower(n_name) AS state",
        "CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE concat('a', CAST(s_suppkey AS STRING), '@example.com') END"
        " AS email",
    )


def carrier_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company names in the run-together spellings that the cleaning rules are for."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "CASE s_suppkey % 10"
        " WHEN 0 THEN concat('State Farm MutualAutomobileInsuranceCompany ', s_suppkey)"
        " WHEN 1 THEN concat('Progressive PropertyandCasualtyInsuranceCompany ', s_suppkey)"
        " WHEN 2 THEN concat('Allstate Fire and Casualty ', s_suppkey)"
        " WHEN 3 THEN concat('Geico ', s_suppkey)"
        " WHEN 4 THEN concat('Farmers InsuranceCompany ', s_suppkey)"
        " WHEN 5 THEN concat('Liberty Mutual Fire and Marine ', s_suppkey)"
        " WHEN 6 THEN concat('Property and Home InsuranceCompany of Region ', s_suppkey)"
        " WHEN 7 THEN concat('Auto', s_suppkey)"
        " WHEN 8 THEN concat(' acme mutual ', s_suppkey)"
        " ELSE s_name END AS Company"
    )


def state_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State names as people type them: full, lower case, padded, abbreviated or unknown."""
    names = F.array(*[F.lit(name) for name in [*STATE_ABBREVIATIONS, "PUERTO RICO"]])
    customers = table(spark, sf_dir, "customer")
    name = F.element_at(names, (F.col("c_custkey") % (len(STATE_ABBREVIATIONS) + 1) + 1).cast("int"))
    spelled = (
        F.when(F.col("c_custkey") % 4 == 0, F.lower(name))
        .when(F.col("c_custkey") % 4 == 1, F.concat(F.lit(" "), F.initcap(F.lower(name)), F.lit(" ")))
        .when(F.col("c_custkey") % 4 == 2, F.substring(name, 1, 2))
        .otherwise(name)
    )
    return customers.select(spelled.alias("state_text"))


def month_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order months spelled as full name, short name, number or something else."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'MMMM')"
        " WHEN 1 THEN date_format(o_orderdate, 'MMM')"
        " WHEN 2 THEN date_format(o_orderdate, 'MM') ELSE 'soon' END AS month_text"
    )


def unsubscribe_requests(spark: SparkSession, sf_dir: str, secret: str) -> DataFrame:
    """Link clicks: a good token, a wrong one or none."""
    return table(spark, sf_dir, "customer").select(
        F.expr("concat('sub-', CAST(c_custkey AS STRING))").alias("subscriber_id"),
        F.when(
            F.col("c_custkey") % 3 == 0,
            F.md5(F.concat(F.expr("concat('sub-', CAST(c_custkey AS STRING))"), F.lit(f"-{secret}"))),
        )
        .when(F.col("c_custkey") % 3 == 1, F.md5(F.expr("concat('sub-', CAST(c_custkey AS STRING))")))
        .alias("token"),
    )


def source_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records before normalisation: some ids empty, names padded, states in lower case, odd enum values."""
    return filings(spark, sf_dir).selectExpr(
        "CASE split_part(Record_ID, '-', 2) WHEN '6' THEN '' WHEN '5' THEN NULL ELSE Record_ID END AS filing_id",
        "concat('  ', Company, ' ') AS company_name",
        "lower(State) AS state",
        "CASE split_part(Record_ID, '-', 2) WHEN '1' THEN 'auto' WHEN '2' THEN 'home' WHEN '3' THEN 'boat' END"
        " AS filing_type",
        "CASE split_part(Record_ID, '-', 2) WHEN '1' THEN 'approved' WHEN '4' THEN 'lost' END AS status",
        "Effective_Date AS effective_date",
        "CASE WHEN split_part(Record_ID, '-', 2) = '2' THEN NULL ELSE CAST(Effective_Date AS TIMESTAMP_NTZ) END"
        " AS last_updated",
        "CAST(Premium_Change_Number * 100 AS DOUBLE) AS rate_change_percent",
    )
