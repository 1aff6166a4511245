"""Every operator of the library run over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.functions.rules import Rule, dated_after_year, is_difference, matches_from_start, positive_when, present
from histlake.operators import checks
from histlake.operators.dedupe import last_per_key, rejects
from histlake.operators.facts import (
    lookup_or_unknown,
    replace_by_key,
    with_unknown_member,
)
from histlake.operators.history import asof_link, scd2_build
from histlake.operators.numbering import number_rows
from histlake.operators.quality import apply_rules, latest_quality, score
from histlake.plans import serving
from histlake.plans.state import build_corrections, build_facts, build_versions, rebuild
from histlake.plans.warehouse import Warehouse
from histlake.schema import (
    AUDITED,
    BASE_COLUMNS,
    CANONICAL_COLUMNS,
    DIM_TAXPAYER,
    KEY,
    MEASURES,
    NEW,
    PERIOD,
    column_names,
)
from histlake.session import configure, cut_lineage, shared_folder
from histlake.sources.batches import align, batch_dates, list_batches, read_batch, read_log, select_batches
from histlake.sources.employers import count_issues, parse_employers, read_json_array, read_json_records
from histlake.streaming.folder import load_new_files

from .derive import employer_records, event_log, returns_log, table

Query = Callable[[SparkSession, str], DataFrame]

COMPUTED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
VERSION_COLUMNS = [c for c in column_names(DIM_TAXPAYER) if c[-4:] != "_seq" and c != "taxpayer_sk"]
FACT_COLUMNS = [
    KEY,
    PERIOD,
    "version",
    "employer_id",
    "filing_date",
    "batch_date",
    "record_type",
    *MEASURES,
    "is_corrected",
]
AUDIT_COLUMNS = [KEY, PERIOD, "corrected_at", *[f"old_{m}" for m in AUDITED]]
DATES = {"valid_from", "valid_to", "filing_date", "batch_date", "corrected_at", "next_from"}


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates print the same everywhere; date objects of two engines may not."""
    return df.select(*[F.col(c).cast("string").alias(c) if c in DATES else F.col(c) for c in df.columns])


# ---- sources ----------------------------------------------------------------


def schema_align(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables with different columns in one canonical form, unioned."""
    canonical = ["party_id", "name", "nation", "segment", "record_type"]
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS party_id", "c_name AS name", "c_nationkey AS nation",
        "c_mktsegment AS segment", "c_acctbal AS balance",
    )
    supplier = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS party_id", "s_name AS name", "s_nationkey AS nation"
    )
    parts = [align(df, canonical, {"record_type": NEW}).rows for df in (customer, supplier)]
    return parts[0].unionByName(parts[1])


def work_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/histlake-work/{uuid.uuid4().hex}"


def write_batches(spark: SparkSession, sf: str, folder: str, months: int, since: int = 1, until: int | None = None) -> None:
    """The derived log as CSV, one folder of part files per batch, or only the batches
    with the numbers `since` to `until`.

    The first batch has the 19 base columns only; the others have all 21 in reverse
    order and one more, so that reading by position would mix up columns.

    The log is derived once into a work table split by batch, so that each batch file
    reads its own split only, not the whole log again.
    """
    staged = f"{work_folder(spark)}/log"
    returns_log(spark, sf, months).write.partitionBy("batch_seq").parquet(staged)
    log = spark.read.parquet(staged)
    seqs = sorted(r.batch_seq for r in log.select("batch_seq").distinct().collect())
    for seq in (s for s in seqs if since <= s <= (until or s)):
        columns = BASE_COLUMNS if seq == 1 else [*reversed(CANONICAL_COLUMNS), "batch"]
        rows = spark.read.parquet(f"{staged}/batch_seq={seq}").orderBy("row_pos").select(*columns)
        rows.write.csv(
            f"{folder}/individual_tax_returns_day{seq}.csv",
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )


def csv_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Write the derived batches as CSV, discover them and read them by header."""
    folder = work_folder(spark)
    write_batches(spark, sf, folder, 6)
    files = select_batches(list_batches(spark, folder))
    return read_log(spark, files).select("batch", "batch_seq", *CANONICAL_COLUMNS)


def batch_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    log = returns_log(spark, sf)
    sizes = log.groupBy("batch").agg(F.count(F.lit(1)).alias("num_rows"))
    return batch_dates(log).join(sizes, "batch").select("batch", "batch_seq", "batch_date", "num_rows")


def mixed_dates(log: DataFrame) -> DataFrame:
    """The log with batch dates missing on some rows and written otherwise on others."""
    return log.withColumn(
        "batch_date",
        F.expr("CASE WHEN row_pos % 3 = 0 THEN NULL WHEN row_pos % 3 = 1 THEN"
               " date_format(CAST(batch_date AS DATE), 'dd/MM/yyyy') ELSE batch_date END"),
    )


def batch_catalogue_mixed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Date of each batch: that of the first row in file order that has one."""
    return batch_dates(mixed_dates(returns_log(spark, sf)))


def csv_headers(spark: SparkSession, sf: str) -> DataFrame:
    """A batch whose header repeats one name and has another in two spellings."""
    folder = f"{work_folder(spark)}/individual_tax_returns_day1.csv"
    line = F.concat_ws(
        ",",
        F.concat(F.lit("T"), F.col("c_custkey")), F.concat(F.lit("other"), F.col("c_custkey")),
        F.concat(F.lit("S"), F.col("c_custkey")), F.col("c_name"), F.lit("again"), F.lit("more"),
    )
    # A separator that doesn't occur keeps the writer from quoting header and lines.
    table(spark, sf, "customer").select(
        line.alias("taxpayer_id,NRIC,nric,full_name,full_name,surprise")
    ).write.csv(folder, header=True, sep="\u0001")
    return read_batch(spark, folder).rows.select(KEY, "nric", "full_name", "record_type")


def employer_file(spark: SparkSession, sf: str) -> DataFrame:
    """Employer records written as JSON arrays of at most a hundred, and read back."""
    folder = work_folder(spark)
    records = employer_records(spark, sf).select(F.expr("pos DIV 100 AS part"), "pos", F.to_json("record").alias("text"))
    arrays = records.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("r"))
    document = F.concat(F.lit("["), F.array_join("r.text", ", "), F.lit("]"))
    arrays.select("part", document.alias("value")).write.partitionBy("part").text(folder)
    return parse_employers(read_json_array(spark, folder))


def employer_json_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Employer records as JSON Lines, of which a tenth is cut off and a tenth in brackets."""
    folder = work_folder(spark)
    lines = employer_records(spark, sf).select("pos", F.to_json("record").alias("text"))
    broken = F.when(F.col("pos") % 10 == 3, F.expr("left(text, length(text) - 5)")).when(
        F.col("pos") % 10 == 7, F.concat(F.lit("["), "text", F.lit("]"))
    )
    lines.select(F.coalesce(broken, "text").alias("value")).write.text(folder)
    return read_json_records(spark, folder)


def employer_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the lines that can be read; identifiers made from positions are left out."""
    return parse_employers(employer_json_lines(spark, sf)[0]).drop("employer_id")


def employer_lines_refused(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that can't be read, by reason, each still told by its content."""
    name = F.regexp_extract("line", '"company_name":"([^"]*)"', 1)
    return employer_json_lines(spark, sf)[1].select("reason", name.alias("company_name"))


def one_batch_score(spark: SparkSession, sf: str) -> DataFrame:
    """Score of the one batch a run was asked for."""
    return score(apply_rules(returns_log(spark, sf).where(F.col("batch") == "day3")))


def employers(spark: SparkSession, sf: str) -> DataFrame:
    return parse_employers(employer_records(spark, sf))


def employer_issue_count(spark: SparkSession, sf: str) -> DataFrame:
    return count_issues(employers(spark, sf))


def employer_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return with_unknown_member(employers(spark, sf))


def event_props(spark: SparkSession, sf: str) -> DataFrame:
    """A JSON text column read as variants."""
    return table(spark, sf, "events").select(
        "event_id",
        F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"),
    )


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rejects(returns_log(spark, sf), "row_pos").select("batch", "row_pos", "reason")


# ---- quality ----------------------------------------------------------------


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return apply_rules(returns_log(spark, sf))


def dq_row_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = validated(spark, sf)
    return df.select("row_pos", *[c for c in df.columns if c.startswith("dq_")])


def dq_custom_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Own rules on other tables: six rules in three domains over order lines."""

    def tax_sum() -> Column:
        return F.col("l_tax") == F.lit(0.08) - F.col("l_discount")

    rules = [
        Rule("flag_present", "completeness", lambda: present("flag")),
        Rule("priority_format", "validity", lambda: matches_from_start("o_orderpriority", r"[1-3]-[A-Z]+$")),
        Rule("shipped_later", "validity", lambda: dated_after_year("shipped", "ordered")),
        Rule("tax_sum", "accuracy", tax_sum),
        Rule("price_difference", "accuracy", lambda: is_difference("net", "gross", "rebate")),
        Rule("taxed_if_returned", "accuracy", lambda: positive_when("tax", "flag", "R")),
    ]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    lines = (
        table(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax", "l_discount",
            "o_orderpriority",
            F.nullif("l_returnflag", F.lit("N")).alias("flag"),
            F.col("l_quantity").cast("string").alias("gross"),
            (F.col("l_linenumber") % 2).cast("string").alias("rebate"),
            (F.col("l_quantity") - 1).cast("string").alias("net"),
            F.col("l_tax").cast("string").alias("tax"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
            F.year("o_orderdate").cast("string").alias("ordered"),
        )
    )
    df = apply_rules(lines, rules)
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        *[c for c in df.columns if c.startswith("dq_")],
    )


def score_absent_domain(spark: SparkSession, sf: str) -> DataFrame:
    """Domains without a flag column have no score."""
    return score(validated(spark, sf).drop("dq_validity_pass"), ["completeness", "validity", "timeliness"])


def dq_domain_score(spark: SparkSession, sf: str) -> DataFrame:
    return score(validated(spark, sf))


def dq_score_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    return score(validated(spark, sf), by=["batch"])


def dq_latest_per_domain(spark: SparkSession, sf: str) -> DataFrame:
    """Each batch scored one day after the one before; the newest score per domain."""
    metrics = score(validated(spark, sf), by=["batch", "batch_seq"]).withColumn(
        "computed_at", F.expr("date_add(DATE'2024-01-01', batch_seq)")
    )
    return latest_quality(metrics).withColumn("computed_at", F.col("computed_at").cast("string"))


def dq_metric_listing(spark: SparkSession, sf: str) -> DataFrame:
    return serving.metric_listing(dq_score_by_batch(spark, sf))


# ---- history ----------------------------------------------------------------


def versions(spark: SparkSession, sf: str) -> DataFrame:
    return build_versions(returns_log(spark, sf))


def scd2_versions(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(versions(spark, sf).select("version", *VERSION_COLUMNS))


def scd2_mixed_batch(spark: SparkSession, sf: str) -> DataFrame:
    """History from batches of two years, in which many a taxpayer has both a correction
    and an update."""
    return dates_as_text(build_versions(returns_log(spark, sf, 24)).select("version", *VERSION_COLUMNS))


def scd2_event_history(spark: SparkSession, sf: str) -> DataFrame:
    """Type of each user's last event of the day, as history."""
    history = scd2_build(
        event_log(spark, sf).withColumn("record_type", F.lit("update")),
        key="user_id",
        tracked=["event_type"],
        identity=[],
        starts=F.col("d"),
        batch_date=F.col("d"),
    )
    return dates_as_text(
        history.select("user_id", "event_type", "valid_from", "valid_to", "is_current")
    )


def event_versions(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_build(
        event_log(spark, sf),
        key="user_id",
        tracked=["attr"],
        identity=[],
        starts=F.col("d"),
        batch_date=F.col("d"),
    )


def scd2_event_corrections(spark: SparkSession, sf: str) -> DataFrame:
    history = event_versions(spark, sf)
    return dates_as_text(
        history.select("user_id", "version", "attr", "valid_from", "valid_to", "is_current")
    )


def asof_event_link(spark: SparkSession, sf: str) -> DataFrame:
    """Every event linked to the version valid three days earlier, else the current."""
    events = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.date_sub(F.col("ts").cast("date"), 3).alias("day"),
        F.lit(2**31 - 1).alias("seen"),
    )
    linked = asof_link(
        events,
        event_versions(spark, sf),
        "day",
        "seen",
        "user_id",
        "version",
        "as_of",
        many_per_key=True,
    )
    return linked.select("event_id", "user_id", "version", "as_of")


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return number_rows(table(spark, sf, "customer").select("c_custkey"), ["c_custkey"], "sk", 1000)


# ---- facts ------------------------------------------------------------------


def facts(spark: SparkSession, sf: str) -> DataFrame:
    log = returns_log(spark, sf)
    return build_facts(log, build_versions(log), employers(spark, sf))


def fact_returns(spark: SparkSession, sf: str) -> DataFrame:
    linked = facts(spark, sf).withColumn("version", F.col("taxpayer_sk").cast("int"))
    return dates_as_text(linked.select(*FACT_COLUMNS))


def unknown_member_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines by supplier, with suppliers in debt counted as unknown.

    Lines are summed per supplier key first; the lookup then sees one row per key.
    """
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("supplier")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"),
    )
    members = table(spark, sf, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").cast("string").alias("supplier")
    )
    keyed = lines.withColumn("supplier", F.col("supplier").cast("string"))
    return (
        lookup_or_unknown(keyed, members, "supplier")
        .groupBy("supplier")
        .agg(F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"))
    )


def line_item_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines replace the other lines of the same key."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf, "lineitem").select(
        *keys, "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    order = ["l_partkey", "l_suppkey", "l_quantity"]
    target = last_per_key(lines.where("l_returnflag <> 'R'"), keys, order)
    batch = last_per_key(lines.where("l_returnflag = 'R'"), keys, order)
    return replace_by_key(target, batch, keys)


def correction_audit(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(build_corrections(returns_log(spark, sf)).select(*AUDIT_COLUMNS))


# ---- serving ----------------------------------------------------------------


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Versions with their number as key within the taxpayer."""
    return versions(spark, sf).withColumn("taxpayer_sk", F.col("version").cast("bigint"))


def summary_by(by: str, limit: int = 50, offset: int = 0) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        # Versions serve both the links and the groups, so they are written out once.
        log = returns_log(spark, sf)
        dim = cut_lineage(dimension(spark, sf))
        linked = build_facts(log, dim, employers(spark, sf))
        return serving.summary(linked, dim, by, limit, offset, [KEY, "taxpayer_sk"])

    return run


def summary_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    totals = serving.grouped_totals(
        table(spark, sf, "orders"),
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"),
        F.col("o_custkey") == F.col("c_custkey"),
        ["o_custkey"],
        "c_mktsegment",
        price,
        price,
    ).select("group_value", F.col("n").alias("num_orders"), F.col("total").cast("double").alias("total"))
    return serving.page(totals, [F.col("total").desc_nulls_last(), F.col("group_value")], 3, 1)


def profiles_of_customers(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "customer").select(
        F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias(KEY)
    )
    return serving.profiles(versions(spark, sf), ids)


def profile_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return serving.profile(versions(spark, sf), "T7")


def returns_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(serving.returns_of(facts(spark, sf), "T7"))


def history_of_one(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(serving.history_of(dimension(spark, sf), "T7"))


def fact_sample(spark: SparkSession, sf: str) -> DataFrame:
    return serving.fact_sample(facts(spark, sf))


def audit_listing(spark: SparkSession, sf: str) -> DataFrame:
    return serving.audit_listing(build_corrections(returns_log(spark, sf)))


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return serving.table_counts({t: table(spark, sf, t) for t in TABLE_NAMES})


def warehouse_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the five tables after a one-pass build with surrogate keys."""
    log = returns_log(spark, sf)
    state = rebuild(log, employers(spark, sf))
    return serving.table_counts(
        {
            "dim_taxpayer": state.versions,
            "dim_employer": state.employers,
            "fact_tax_returns": state.facts,
            "agg_data_quality_metrics": score(apply_rules(log), by=["batch"]),
            "fact_corrections": state.corrections,
        }
    )


# ---- checks -----------------------------------------------------------------


def check_several_current(spark: SparkSession, sf: str) -> DataFrame:
    return checks.several_current(versions(spark, sf))


def check_version_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(checks.gaps_between_versions(versions(spark, sf)))


def check_several_current_seeded(spark: SparkSession, sf: str) -> DataFrame:
    """First versions made current again beside the current ones."""
    return checks.several_current(versions(spark, sf).withColumn("is_current", F.expr("is_current OR version = 1")))


def check_version_gaps_seeded(spark: SparkSession, sf: str) -> DataFrame:
    """Every other version ends a day late."""
    late = versions(spark, sf).withColumn("valid_to", F.expr("date_add(valid_to, IF(version % 2 = 1 AND NOT is_current, 1, 0))"))
    return dates_as_text(checks.gaps_between_versions(late))


def check_fact_grain(spark: SparkSession, sf: str) -> DataFrame:
    return checks.repeated_grain(facts(spark, sf))


def check_line_item_grain(spark: SparkSession, sf: str) -> DataFrame:
    return checks.repeated_grain(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_dangling_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines whose part is not a large one or whose supplier is in debt."""
    return checks.dangling_links(
        table(spark, sf, "lineitem").selectExpr("l_partkey AS part", "l_suppkey AS supplier"),
        table(spark, sf, "part").where("p_size > 10").selectExpr("p_partkey AS part"),
        table(spark, sf, "supplier").where("s_acctbal > 0").selectExpr("s_suppkey AS supplier"),
        "part",
        "supplier",
    )


def check_unknown_links(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unknown_links(facts(spark, sf))


def check_content_difference(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    columns = ["o_custkey", "o_orderstatus"]
    return checks.content_difference(
        orders.where("o_orderpriority <> '5-LOW'").select(*columns),
        orders.where("o_orderpriority <> '1-URGENT'").select(*columns),
    )


def check_content_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a copy in which few rows changed, were lost or came twice; only
    parts whose sums of hashes differ are compared row by row."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    changed = orders.where("o_orderkey % 997 <> 0").withColumn("o_orderstatus", F.expr("IF(o_orderkey % 1009 = 1, NULL, o_orderstatus)"))
    return checks.content_difference_by_sums(orders, changed.unionByName(orders.where("o_orderkey % 2003 = 2")), 64)


def check_touched_keys(spark: SparkSession, sf: str) -> DataFrame:
    """All checks over the taxpayers of one batch, with faults planted among all: first versions
    made current again, ends a day late, employers lost."""
    dim = versions(spark, sf).withColumns(
        {"is_current": F.expr("is_current OR version = 1"), "valid_to": F.expr("date_add(valid_to, IF(version % 2 = 1 AND NOT is_current, 1, 0))"), "taxpayer_sk": F.col("version")}
    )
    members = with_unknown_member(employers(spark, sf)).where("employer_id NOT LIKE '%7'")
    touched = returns_log(spark, sf).where("batch = 'day9'")
    return checks.violations(checks.on_keys(dim, touched, [KEY]), checks.on_keys(facts(spark, sf), touched, [KEY]), members, order="version")


# ---- stored warehouse -------------------------------------------------------


def linked_facts(warehouse: Warehouse) -> DataFrame:
    """Stored facts with the version number in place of the surrogate key. Keys grow
    in order of opening, so the number is the rank of the key within the taxpayer."""
    dim = warehouse.table("dim_taxpayer").select(KEY, "taxpayer_sk")
    ranked = dim.groupBy(KEY).agg(F.array_sort(F.collect_list("taxpayer_sk")).alias("_sks"))
    facts = warehouse.table("fact_tax_returns").join(ranked, KEY, "left")
    linked = facts.withColumn("version", F.array_position("_sks", F.col("taxpayer_sk")).cast("int"))
    return dates_as_text(linked.select(*FACT_COLUMNS))


def warehouse_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """One-pass build into stored tables, then read back."""
    warehouse = Warehouse(spark, work_folder(spark))
    warehouse.rebuild(returns_log(spark, sf), employers(spark, sf), COMPUTED_AT)
    return linked_facts(warehouse)


def rebuilt(spark: SparkSession, sf: str) -> Warehouse:
    warehouse = Warehouse(spark, work_folder(spark), buckets=4)
    warehouse.rebuild(returns_log(spark, sf), employers(spark, sf), COMPUTED_AT)
    return warehouse


def stored_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(rebuilt(spark, sf).table("dim_taxpayer").select(*VERSION_COLUMNS))


def stored_corrections(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(rebuilt(spark, sf).table("fact_corrections").select("correction_id", *AUDIT_COLUMNS))


def stored_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return serving.metric_listing(rebuilt(spark, sf).table("agg_data_quality_metrics"))


def stored_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Current scores where all batches were scored at one time."""
    return rebuilt(spark, sf).quality().select("domain", "score", "passing_count", "total_count", "batch")


def stored_overall_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Scores over all batches from stored counts, without reading any batch."""
    return rebuilt(spark, sf).overall_quality()


def stored_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return rebuilt(spark, sf).rejected().select("batch", "reason", *CANONICAL_COLUMNS)


def replay_changes_nothing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each stored table that differ after a batch was loaded again."""
    warehouse = rebuilt(spark, sf)
    before = warehouse.tables()
    batch = returns_log(spark, sf).where("batch = 'day9'").select(*CANONICAL_COLUMNS, "row_pos")
    warehouse.load_batch(batch, "day9", COMPUTED_AT)
    after = warehouse.tables()
    return serving.table_counts({n: checks.content_difference(before[n], after[n]) for n in before})


def folder_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Batches picked up from a folder by a stream and loaded one after another."""
    folder = work_folder(spark)
    write_batches(spark, sf, f"{folder}/in", 24)
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    warehouse.load_employers(employers(spark, sf))
    query = load_new_files(warehouse, f"{folder}/in", f"{folder}/progress", computed_at=COMPUTED_AT)
    query.awaitTermination()
    return linked_facts(warehouse)


def streamed(spark: SparkSession, sf: str) -> Warehouse:
    """Two runs of a stream: the first finds one batch, the second all others, which it
    merges in one step."""
    folder = work_folder(spark)
    warehouse = Warehouse(spark, f"{folder}/warehouse", buckets=4)
    warehouse.load_employers(employers(spark, sf))
    for since, until in ((1, 1), (2, None)):
        write_batches(spark, sf, f"{folder}/in", 6, since, until)
        query = load_new_files(warehouse, f"{folder}/in", f"{folder}/progress", computed_at=COMPUTED_AT)
        query.awaitTermination()
    return warehouse


def folder_stream_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(streamed(spark, sf).table("dim_taxpayer").select(*VERSION_COLUMNS))


def folder_stream_corrections(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(streamed(spark, sf).table("fact_corrections").select("correction_id", *AUDIT_COLUMNS))


def folder_stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return serving.metric_listing(streamed(spark, sf).table("agg_data_quality_metrics"))


def folder_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return streamed(spark, sf).rejected().select("batch", "reason", *CANONICAL_COLUMNS)


def running_summary(by: str) -> Query:
    """Summary from the totals that the loads of a stream kept up to date."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return streamed(spark, sf).summary(by)

    return run


def configured(query: Query) -> Query:
    """The query in a session with the library's settings."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return query(configure(spark), sf)

    return run


def queries() -> dict[str, Query]:
    return {name: configured(query) for name, query in _all().items()}


def _all() -> dict[str, Query]:
    return {
        "schema_align": schema_align,
        "csv_batches": csv_batches,
        "batch_catalogue": batch_catalogue,
        "batch_catalogue_mixed_dates": batch_catalogue_mixed_dates,
        "csv_headers": csv_headers,
        "employer_file": employer_file,
        "employer_lines": employer_lines,
        "employer_lines_refused": employer_lines_refused,
        "one_batch_score": one_batch_score,
        "employer_records": employers,
        "employer_issue_count": employer_issue_count,
        "employer_dimension": employer_dimension,
        "event_props": event_props,
        "rejected_rows": rejected_rows,
        "dq_row_flags": dq_row_flags,
        "dq_custom_rules": dq_custom_rules,
        "dq_domain_score": dq_domain_score,
        "score_absent_domain": score_absent_domain,
        "dq_score_by_batch": dq_score_by_batch,
        "dq_latest_per_domain": dq_latest_per_domain,
        "dq_metric_listing": dq_metric_listing,
        "scd2_versions": scd2_versions,
        "scd2_mixed_batch": scd2_mixed_batch,
        "scd2_event_history": scd2_event_history,
        "scd2_event_corrections": scd2_event_corrections,
        "asof_event_link": asof_event_link,
        "surrogate_keys": surrogate_keys,
        "fact_returns": fact_returns,
        "unknown_member_totals": unknown_member_totals,
        "line_item_upsert": line_item_upsert,
        "correction_audit": correction_audit,
        "summary_by_occupation": summary_by("occupation"),
        "summary_by_residential_status": summary_by("residential_status"),
        "summary_by_housing_type": summary_by("housing_type", 2, 1),
        "summary_by_segment": summary_by_segment,
        "profiles_of_customers": profiles_of_customers,
        "profile_of_one": profile_of_one,
        "returns_of_one": returns_of_one,
        "history_of_one": history_of_one,
        "fact_sample": fact_sample,
        "audit_listing": audit_listing,
        "table_counts": table_counts,
        "warehouse_counts": warehouse_counts,
        "check_several_current": check_several_current,
        "check_version_gaps": check_version_gaps,
        "check_several_current_seeded": check_several_current_seeded,
        "check_version_gaps_seeded": check_version_gaps_seeded,
        "check_fact_grain": check_fact_grain,
        "check_line_item_grain": check_line_item_grain,
        "check_dangling_suppliers": check_dangling_suppliers,
        "check_unknown_links": check_unknown_links,
        "check_content_difference": check_content_difference,
        "check_content_sums": check_content_sums,
        "check_touched_keys": check_touched_keys,
        "warehouse_rebuild": warehouse_rebuild,
        "stored_dimension": stored_dimension,
        "stored_corrections": stored_corrections,
        "stored_metrics": stored_metrics,
        "stored_quality": stored_quality,
        "stored_overall_quality": stored_overall_quality,
        "stored_rejects": stored_rejects,
        "replay_changes_nothing": replay_changes_nothing,
        "folder_stream": folder_stream,
        "folder_stream_dimension": folder_stream_dimension,
        "folder_stream_corrections": folder_stream_corrections,
        "folder_stream_metrics": folder_stream_metrics,
        "folder_stream_rejects": folder_stream_rejects,
        "running_summary_by_occupation": running_summary("occupation"),
    }
