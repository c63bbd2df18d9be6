"""Conversion by segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensa.operators import summaries as sm
from propensa.queries.crm import joined_table
from propensa.queries.twins import with_tables

MIN_SALES = 5
DIGITS = 6


def tag_count_quantiles(spark, sf_dir):
    found = sm.group_quantiles(joined_table(spark, sf_dir), "made_purchase", "tag_count")
    return found.withColumn("value", F.round("value", DIGITS))


QUERIES = {
    "country_pareto": lambda s, d: sm.pareto(joined_table(s, d), "country_code", min_sales=MIN_SALES),
    "rating_pareto": lambda s, d: sm.pareto(joined_table(s, d), "member_rating"),
    "monthly_conversion": lambda s, d: sm.monthly_conversion(joined_table(s, d)),
    "domain_performance": lambda s, d: sm.domain_performance(joined_table(s, d)),
    "top_domains": lambda s, d: sm.top_domains(joined_table(s, d)),
    "tag_count_quantiles": tag_count_quantiles,
    "conversion_rate": lambda s, d: sm.conversion_rate(joined_table(s, d)),
    "target_distribution": lambda s, d: sm.target_distribution(joined_table(s, d)),
}


def _pareto(column: str, having: str = "") -> str:
    return with_tables("joined") + f"""
        select {column}, sales, sales / n as prop_in_group,
               sales / total as prop_overall, cum / total as prop_cumsum
        from (select *, cast(sum(sales) over () as double) as total,
                     cast(sum(sales) over (order by sales desc, {column}
                          rows between unbounded preceding and current row) as double) as cum
              from (select {column}, cast(sum(made_purchase) as bigint) as sales, count(*) as n
                    from joined where {column} is not null group by 1))
        {having}"""


def _rate(expression: str, name: str, tail: str = "") -> str:
    return with_tables("joined") + f"""
        select {expression} as {name}, count(made_purchase) as count,
               cast(sum(made_purchase) as bigint) as sum, avg(made_purchase) as mean
        from joined where {expression} is not null group by 1 {tail}"""


DOMAIN = "string_split(user_email, '@')[2]"

SQL = {
    "country_pareto": _pareto("country_code", f"where sales > {MIN_SALES}"),
    "rating_pareto": _pareto("member_rating"),
    "monthly_conversion": _rate("cast(month(optin_time) as int)", "optin_month"),
    "domain_performance": _rate(DOMAIN, "email_domain", "order by count desc, email_domain"),
    "top_domains": _rate(DOMAIN, "email_domain", "order by count desc, email_domain limit 5"),
    "tag_count_quantiles": with_tables("joined") + " union all ".join(
        f"""select made_purchase, {q}::double as quantile,
                   round(quantile_cont(tag_count::double, {q}), {DIGITS}) as value
            from joined group by 1""" for q in (0.10, 0.50, 0.90)
    ),
    "conversion_rate": with_tables("joined") + "select avg(made_purchase) as conversion_rate from joined",
    "target_distribution": with_tables("joined") + """
        select made_purchase, count(*) as count, count(*) / sum(count(*)) over ()::double as proportion
        from joined group by 1""",
}
