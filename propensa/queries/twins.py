"""SQL twins of the shared tables, as common table expressions."""

from __future__ import annotations

from propensa.functions.features import COUNTRIES_KEPT, FREE_MAIL_DOMAINS, OTHER_COUNTRY
from propensa.operators.columns import MISSING
from propensa.sources.standins import CHARGE_COUNTRIES, COUNTRIES, DOMAINS, ACCOUNT_ORDERS

# The event types of the test tables; each makes ten tags.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
TAGS = [f"{kind}-{n:02d}" for kind in EVENT_TYPES for n in range(10)]
TAG_COLUMNS = ["tag_" + tag.replace("-", "_") for tag in TAGS]


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _set(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


DATE_COLUMNS = """
    cast(floor((epoch_us(optin_time) - epoch_us(max(optin_time) over ())) / 86400000000.0) as int) as optin_days,
    cast(month(optin_time) as int) as optin_month,
    cast(isodow(optin_time) - 1 as int) as optin_day_of_week,
    cast(dayofyear(optin_time) as int) as optin_day_of_year,
    cast(quarter(optin_time) as int) as optin_quarter,
    cast(isodow(optin_time) in (6, 7) as int) as optin_is_weekend"""

EMAIL_COLUMNS = f"""
    string_split(user_email, '@')[2] as email_provider,
    cast(coalesce(string_split(user_email, '@')[2] in {_set(FREE_MAIL_DOMAINS)}, false) as int) as is_free_email"""

COUNTRY_COLUMN = (
    f"case when country_code in {_set(COUNTRIES_KEPT)} then country_code else '{OTHER_COUNTRY}' end as country_code"
)

FILLED_TAGS = ", ".join(f"coalesce({c}, 0) as {c}" for c in TAG_COLUMNS)

# Each table names the ones it reads.
TABLES: dict[str, tuple[list[str], str]] = {
    "subscribers": ([], f"""
        select c_custkey as mailchimp_id, c_name as user_full_name,
               concat(lower(replace(c_name, '#', '.')), '@', ({_list(DOMAINS)})[c_custkey % 7 + 1]) as user_email,
               cast(least(5, 1 + floor((c_acctbal + 1000) / 2200)) as int) as member_rating,
               cast(date '2015-01-01' + cast(c_custkey * 37 % 1461 as int) as varchar) as optin_time,
               ({_list(COUNTRIES)})[c_nationkey + 1] as country_code
        from customer"""),
    "event_tags": ([], """
        select user_id as mailchimp_id,
               concat(event_type, '-',
                      lpad(cast(cast(json_extract_string(props, '$.k') as int) % 10 as varchar), 2, '0')) as tag
        from events"""),
    "tags": (["event_tags"], "select distinct mailchimp_id, tag from event_tags"),
    "transactions": ([], f"""
        select o_orderkey as transaction_id,
               cast(cast(o_orderdate as date) as varchar) as purchased_at,
               concat('Customer#', lpad(cast(o_custkey as varchar), 9, '0')) as user_full_name,
               case when o_orderkey % {ACCOUNT_ORDERS} = 0
                    then concat('customer.', lpad(cast(o_custkey as varchar), 9, '0'), '@', ({_list(DOMAINS)})[o_custkey % 7 + 1])
                    else concat('guest.', o_orderkey, '@', ({_list(DOMAINS)})[o_orderkey % 7 + 1]) end as user_email,
               case when o_custkey % 8 = 7 then null
                    else ({_list(CHARGE_COUNTRIES)})[o_custkey % 8 + 1] end as charge_country,
               cast(1 + o_orderkey % 100 as int) as product_id
        from orders"""),
    "joined": (["subscribers", "tags", "transactions"], """
        select s.mailchimp_id, s.user_full_name, s.user_email, s.member_rating,
               cast(s.optin_time as timestamp) as optin_time, s.country_code,
               coalesce(t.tag_count, 0) as tag_count,
               cast(s.user_email in (select user_email from transactions) as int) as made_purchase
        from subscribers s
        left join (select mailchimp_id, count(tag) as tag_count from tags group by 1) t using (mailchimp_id)"""),
    "wide_tags": (["tags"], "select mailchimp_id, " + ", ".join(
        f"max(cast(tag = '{tag}' as int)) as {name}" for tag, name in zip(TAGS, TAG_COLUMNS)
    ) + " from tags group by 1"),
    "leads_raw": (["joined", "wide_tags"], "select j.*, w.* exclude (mailchimp_id) "
                  "from joined j left join wide_tags w using (mailchimp_id)"),
    "dated": (["joined"], f"select *, {DATE_COLUMNS} from joined"),
    "engineered": (["leads_raw"], f"""
        select mailchimp_id, user_full_name, user_email, member_rating, optin_time, {COUNTRY_COLUMN},
               tag_count, made_purchase, {FILLED_TAGS},
               optin_days, optin_month, optin_day_of_week, optin_day_of_year, optin_quarter, optin_is_weekend,
               {EMAIL_COLUMNS},
               tag_count / (abs(optin_days) + 1) as tag_count_by_optin_day
        from (select *, {DATE_COLUMNS} from leads_raw)"""),
    "matrix": (["engineered"], f"""
        select * exclude (mailchimp_id, user_full_name, user_email, optin_time, email_provider)
               replace (cast(dense_rank() over (order by country_code) - 1 as int) as country_code,
                        coalesce(tag_count_by_optin_day, {MISSING}) as tag_count_by_optin_day)
        from engineered"""),
    "scored": (["joined"], """
        select mailchimp_id, label, cast(score > 0.5 as int) as prediction, score
        from (select mailchimp_id, made_purchase as label,
                     (mailchimp_id * 7919 % 1009 + 300 * made_purchase) / 1309.0::double as score
              from joined)"""),
    "steps": (["scored"], """
        select score, pos, neg,
               sum(pos) over down as tp, sum(neg) over down as fp,
               sum(pos) over () as all_pos, sum(neg) over () as all_neg,
               lead(pos) over (order by score desc) as next_pos, lead(neg) over (order by score desc) as next_neg
        from (select score, sum(label) as pos, sum(1 - label) as neg from scored group by score)
        window down as (order by score desc rows between unbounded preceding and current row)"""),
}


def with_tables(*names: str) -> str:
    """``WITH`` clause that defines the named tables and all they read."""
    order: list[str] = []

    def visit(name: str) -> None:
        for source in TABLES[name][0]:
            visit(source)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "with " + ",\n".join(f"{name} as ({TABLES[name][1]})" for name in order) + "\n"
