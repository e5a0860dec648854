"""How request arguments turn into limits and offsets."""

import re

# Page sizes.
TELEMETRY_DEFAULT, TELEMETRY_MAX = 100, 1000
ALERTS_DEFAULT, ALERTS_MAX = 50, 500
OFFSET_DEFAULT, OFFSET_MAX = 0, 1_000_000


def _integer(raw) -> int | None:
    text = "" if raw is None else str(raw)
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    number = int(text)
    return number if -(2**63) <= number < 2**63 else None


def telemetry_limit(raw=None) -> int:
    """1 to 1000; anything else means the default, not the nearest bound."""
    number = _integer(raw)
    return number if number is not None and 1 <= number <= TELEMETRY_MAX else TELEMETRY_DEFAULT


def page_argument(raw, default: int, most: int) -> int:
    """Zero is allowed, large numbers are clamped, negative or unreadable ones mean the default."""
    number = _integer(raw)
    return default if number is None or number < 0 else min(number, most)
