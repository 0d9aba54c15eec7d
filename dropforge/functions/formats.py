"""Date-format tokens, and the Spark pattern and anchored expression they stand for."""

from __future__ import annotations

import re

# Format token, Spark datetime pattern, digits it stands for. Longer tokens come first.
TOKENS = (
    ("YYYY", "yyyy", r"\d{4}"),
    ("YY", "yy", r"\d{2}"),
    ("MM", "MM", r"\d{2}"),
    ("DD", "dd", r"\d{2}"),
    ("HH24", "HH", r"\d{2}"),
    ("MI", "mm", r"\d{2}"),
    ("SS", "ss", r"\d{2}"),
)

_ANY_TOKEN = re.compile("|".join(token for token, _, _ in TOKENS))


def spark_pattern(fmt: str) -> str:
    pattern = {token: spark for token, spark, _ in TOKENS}
    return _ANY_TOKEN.sub(lambda m: pattern[m.group()], fmt)


def digit_regex(fmt: str) -> str:
    """Anchored expression; text between tokens is used as it stands."""
    digits = {token: regex for token, _, regex in TOKENS}
    return "^" + _ANY_TOKEN.sub(lambda m: digits[m.group()], fmt) + "$"
