"""Column names made from data values."""

from __future__ import annotations

import re
import unicodedata

TAG_PREFIX = "tag_"


def clean_name(text: str) -> str:
    """Lower-case identifier: separators become single underscores, quotes and accents go."""
    lowered = text.lower().replace("\xa0", "_")
    spaced = re.sub(r"[ /:,?()\.-]", "_", lowered)
    unquoted = re.sub(r"['’]", "", spaced)
    plain = "".join(c for c in unicodedata.normalize("NFD", unquoted) if not unicodedata.combining(c))
    return re.sub(r"_+", "_", plain)


def tag_columns(vocabulary: list[str], taken: list[str]) -> dict[str, str]:
    """Map each tag to its column name; raise when names collide with each other or with ``taken``."""
    names = {tag: TAG_PREFIX + clean_name(tag) for tag in vocabulary}
    seen: dict[str, str] = {}
    for tag, name in names.items():
        if name in seen:
            raise ValueError(f"tags {seen[name]!r} and {tag!r} both become column {name!r}")
        if name in taken:
            raise ValueError(f"tag {tag!r} becomes column {name!r}, which already exists")
        seen[name] = tag
    return names
