"""Row-level features as SQL expressions.

The expressions are kept as SQL text so that one definition serves both the
DataFrame steps (through ``F.expr``) and the saved scoring model, whose
``SQLTransformer`` stages hold text.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

# Mail providers counted as free, and countries kept by name.
FREE_MAIL_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com"]
COUNTRIES_KEPT = [
    "us", "in", "au", "uk", "br", "ca", "de", "fr", "es", "mx",
    "nl", "sg", "dk", "pl", "my", "ae", "co", "id", "ng", "jp", "be",
]
OTHER_COUNTRY = "other"

MICROS_PER_DAY = 86_400_000_000


def sql_text(value: str) -> str:
    """SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_list(values: Sequence[str]) -> str:
    return ", ".join(sql_text(v) for v in values)


def timestamp_sql(moment: datetime) -> str:
    """SQL time literal of a naive date and time."""
    return f"timestamp '{moment.isoformat(sep=' ')}'"


def days_from(time: str, reference: str) -> str:
    """Elapsed whole 24-hour days from ``reference``, floored (negative before it).

    Exact integer arithmetic: calendar-day differences would ignore the clock time.
    """
    elapsed = f"(unix_micros({time}) - unix_micros({reference}))"
    return f"cast(({elapsed} - pmod({elapsed}, {MICROS_PER_DAY})) div {MICROS_PER_DAY} as int)"


def date_features(time: str = "optin_time", reference: str = "reference_date") -> dict[str, str]:
    return {
        "optin_days": days_from(time, reference),
        "optin_month": f"month({time})",
        "optin_day_of_week": f"weekday({time})",
        "optin_day_of_year": f"dayofyear({time})",
        "optin_quarter": f"quarter({time})",
        "optin_is_weekend": f"cast(weekday({time}) in (5, 6) as int)",
    }


def email_domain(email: str = "user_email") -> str:
    """Text after the first ``@`` (up to a second one), null when there is none."""
    return f"get(split({email}, '@'), 1)"


def email_features(email: str = "user_email", free: Sequence[str] = FREE_MAIL_DOMAINS) -> dict[str, str]:
    domain = email_domain(email)
    return {
        "email_provider": domain,
        "is_free_email": f"cast(coalesce({domain} in ({sql_list(free)}), false) as int)",
    }


def tag_rate(tag_count: str = "tag_count", days: str = "optin_days") -> str:
    """Tags per day since opt-in, counting the first day as one."""
    return f"{tag_count} / (abs({days}) + 1)"


def standard_country(
    country: str = "country_code", kept: Sequence[str] = COUNTRIES_KEPT, other: str = OTHER_COUNTRY
) -> str:
    """Listed countries keep their code; all others, and null, become ``other``."""
    return f"case when {country} in ({sql_list(kept)}) then {country} else {sql_text(other)} end"
