"""Quality suites over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.operators import quality as q
from propensa.plans import suites
from propensa.queries.crm import joined_table
from propensa.queries.twins import with_tables
from propensa.session import scratch_path
from propensa.sources import standins
from propensa.sources.tables import read_table

# A narrower list than the stand-in codes, so that the detail queries have rows to show.
DETAIL_CHECKS = [
    q.in_set("country_code", suites.SUBSCRIBER_COUNTRIES),
    q.between("member_rating", 1, 4),
    q.matches("user_email", r"^[a-z.0-9]+@[a-z]+\.com$"),
]


def dq_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.validate(standins.subscribers(spark, sf_dir), "subscribers", suites.subscribers_suite())


def dq_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.validate(standins.tags(spark, sf_dir), "tags", suites.tags_suite())


def dq_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.validate(standins.transactions(spark, sf_dir), "transactions", suites.transactions_suite())


def dq_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.validate(suites.as_written(joined_table(spark, sf_dir)), "joined", suites.joined_suite())


def dq_business_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.validate(suites.with_domain(joined_table(spark, sf_dir)), "business_rules", suites.business_suite())


def dq_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = (
        dq_subscribers(spark, sf_dir)
        .unionByName(dq_tags(spark, sf_dir))
        .unionByName(dq_transactions(spark, sf_dir))
    )
    return q.verdicts(results)


def dq_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subscriber, tag) pairs that occur more than once among the events."""
    return q.repeated_rows(standins.event_tags(spark, sf_dir), ["mailchimp_id", "tag"])


def dq_results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the raw suites written as JSON and read back under their schema."""
    results = (
        dq_subscribers(spark, sf_dir)
        .unionByName(dq_tags(spark, sf_dir))
        .unionByName(dq_transactions(spark, sf_dir))
    )
    path = scratch_path(spark, "results")
    q.write_results(results, path)
    return read_table(spark, path, "json", results.schema)


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results with the most frequent unexpected values of each check, as text."""
    results = q.validate(standins.subscribers(spark, sf_dir), "subscribers", DETAIL_CHECKS, q.SUMMARY)
    return results.withColumn("partial_unexpected", F.array_join("partial_unexpected", ";"))


def dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q.failing_rows(standins.subscribers(spark, sf_dir), DETAIL_CHECKS)
    return rows.withColumn("failed_checks", F.concat_ws(";", "failed_checks"))


QUERIES = {
    "dq_subscribers": dq_subscribers,
    "dq_tags": dq_tags,
    "dq_transactions": dq_transactions,
    "dq_joined": dq_joined,
    "dq_business_rules": dq_business_rules,
    "dq_verdicts": dq_verdicts,
    "dq_results_json": dq_results_json,
    "dq_duplicate_rows": dq_duplicate_rows,
    "dq_unexpected_values": lambda s, d: q.unexpected_values(standins.subscribers(s, d), DETAIL_CHECKS),
    "dq_summary": dq_summary,
    "dq_failing_rows": dq_failing_rows,
}


def _set(values: list) -> str:
    return "(" + ", ".join(repr(v) for v in values if v is not None) + ")"


def _bad(check: q.Check) -> str:
    """Condition that a row breaks a row check."""
    column, args = check.column, check.args
    text = f"cast({column} as varchar)"
    if check.kind == "not_null":
        return f"{column} is null"
    if check.kind == "matches":
        broken = f"not regexp_matches({text}, '{args['pattern']}')"
    elif check.kind == "in_set":
        broken = f"{column} not in {_set(args['values'])}"
    elif check.kind == "between":
        broken = f"{column} not between {args['low']} and {args['high']}"
    else:
        shape = f"regexp_matches({text}, '{q.DATE_PATTERN}')"
        broken = f"(not {shape} or try_strptime({text}, '%Y-%m-%d') is null)"
    return f"({column} is not null and {broken})"


def _row(position: int, suite: str, check: q.Check, table: str, columns: list[tuple[str, str]]) -> str:
    """One result row, selected from one pass over the table."""
    column = check.column
    none = "null::bigint"
    observed, elements, missing, unexpected = "null::double", none, none, none
    source, args = table, check.args
    if check.kind in q.ROW_KINDS:
        unexpected = f"count(*) filter (where {_bad(check)})"
        success = f"{unexpected} = 0"
    elif check.kind == "row_count":
        observed, success = "count(*)::double", f"count(*) between {args['low']} and {args['high']}"
    elif check.kind == "column_count":
        observed, success = f"{len(columns)}::double", str(len(columns) == args["count"]).lower()
    elif check.kind == "column_order":
        success = str([c for c, _ in columns] == args["names"]).lower()
    elif check.kind == "type_is":
        success = str(dict(columns)[column] == args["dtype"]).lower()
    elif check.kind == "unique":
        source = f"(select *, count(*) over (partition by {column}) as copies from {table})"
        unexpected = f"count(*) filter (where {column} is not null and copies > 1)"
        success = f"{unexpected} = 0"
    elif check.kind == "share_at_most":
        source = f"(select *, count(*) over (partition by {column}) as copies from {table})"
        share = f"max(copies) filter (where {column} is not null) / count({column})::double"
        observed, success = share, f"{share} <= {args['share']}"
    else:
        measure = f"{'min' if check.kind == 'min_between' else 'avg'}({column})"
        observed, success = f"{measure}::double", f"{measure} between {args['low']} and {args['high']}"
    origin = "" if check.kind in q.SCHEMA_KINDS else f"from {source}"
    if column is not None and check.kind != "type_is":
        elements, missing = "count(*)", f"count(*) - count({column})"
    percent = "null::double"
    if unexpected != none:
        percent = f"100 * coalesce({unexpected} / nullif(count({column}), 0)::double, 0)"
    name = f"'{column}'" if column else "null::varchar"
    return f"""select '{suite}' as suite, {position} as position, '{check.name}' as "check", {name} as "column",
        {success} as success, {observed} as observed, {elements} as element_count,
        {missing} as missing_count, {unexpected} as unexpected_count, {percent} as unexpected_percent {origin}"""


SUBSCRIBERS = [
    ("mailchimp_id", "bigint"), ("user_full_name", "string"), ("user_email", "string"),
    ("member_rating", "int"), ("optin_time", "string"), ("country_code", "string"),
]
TAGS = [("mailchimp_id", "bigint"), ("tag", "string")]
TRANSACTIONS = [
    ("transaction_id", "bigint"), ("purchased_at", "string"), ("user_full_name", "string"),
    ("user_email", "string"), ("charge_country", "string"), ("product_id", "int"),
]
JOINED = [*SUBSCRIBERS, ("tag_count", "bigint"), ("made_purchase", "int")]


def _suite(suite: str, checks: list[q.Check], table: str, columns: list[tuple[str, str]]) -> str:
    return " union all ".join(_row(i, suite, c, table, columns) for i, c in enumerate(checks))


_CRM = [
    _suite("subscribers", suites.subscribers_suite(), "subscribers", SUBSCRIBERS),
    _suite("tags", suites.tags_suite(), "tags", TAGS),
    _suite("transactions", suites.transactions_suite(), "transactions", TRANSACTIONS),
]

_UNEXPECTED = with_tables("subscribers") + ", bad as (" + " union all ".join(
    f"""select '{c.name}' as "check", cast({c.column} as varchar) as value from subscribers where {_bad(c)}"""
    for c in DETAIL_CHECKS
) + f"""),
    top_values as (
        select "check", value, n_rows, rank from (
            select "check", value, count(*) as n_rows,
                   cast(row_number() over (partition by "check" order by count(*) desc, value) as int) as rank
            from bad group by 1, 2)
        where rank <= {q.SAMPLE_SIZE})
"""

SQL = {
    "dq_subscribers": with_tables("subscribers") + _CRM[0],
    "dq_tags": with_tables("tags") + _CRM[1],
    "dq_transactions": with_tables("transactions") + _CRM[2],
    "dq_joined": with_tables("joined")
    + ", written as (select * replace (strftime(optin_time, '%Y-%m-%d') as optin_time) from joined) "
    + _suite("joined", suites.joined_suite(), "written", JOINED),
    "dq_business_rules": with_tables("joined")
    + ", domains as (select *, string_split(user_email, '@')[2] as email_domain from joined) "
    + _suite("business_rules", suites.business_suite(), "domains", JOINED),
    "dq_verdicts": with_tables("subscribers", "tags", "transactions")
    + ", results as (" + " union all ".join(_CRM) + """)
        select coalesce(suite, 'overall') as suite, bool_and(success) as success, count(*) as checks,
               count(*) filter (where not success) as failed,
               100 * count(*) filter (where success) / count(*)::double as success_percent
        from results group by rollup (suite)""",
    "dq_results_json": with_tables("subscribers", "tags", "transactions") + " union all ".join(_CRM),
    "dq_duplicate_rows": with_tables("event_tags") + """
        select mailchimp_id, tag, count(*) as n_rows from event_tags
        where mailchimp_id is not null and tag is not null group by 1, 2 having count(*) > 1""",
    "dq_unexpected_values": _UNEXPECTED + "select * from top_values",
    "dq_summary": _UNEXPECTED + ", results as ("
    + _suite("subscribers", DETAIL_CHECKS, "subscribers", SUBSCRIBERS) + """),
        samples as (
            select "check", string_agg(value, ';' order by rank) as partial_unexpected from top_values group by 1)
        select results.*, partial_unexpected from results left join samples using ("check")""",
    "dq_failing_rows": with_tables("subscribers") + """
        select * from (select *, concat_ws(';', """ + ", ".join(
        f"case when {_bad(c)} then '{c.name}' end" for c in DETAIL_CHECKS
    ) + ") as failed_checks from subscribers) where failed_checks <> ''",
}
