"""Key helpers (F6-F8): salted wide-column row keys, id text, column lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.dates import MILLIS_PER_DAY, day_start_millis

# Fixed values of the salted row key: salt = (day_ms / 100000) % 10, then the
# day start in ms, then a free suffix.
SALT_DIVISOR = 100_000
SALT_MODULUS = 10


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def salt_of(day_ms) -> Column:
    return F.pmod(F.floor(_col(day_ms) / F.lit(SALT_DIVISOR)), F.lit(SALT_MODULUS)).cast("string")


def salted_row_key(ts, suffix) -> Column:
    """``salt || day_start_ms || suffix`` for the day containing ``ts``."""
    day_ms = day_start_millis(ts)
    return F.concat(salt_of(day_ms), day_ms.cast("string"), id_text(suffix))


def salted_prefix(day_ms: int) -> str:
    """Row-key prefix of one day, computed for a literal day start."""
    return f"{(day_ms // SALT_DIVISOR) % SALT_MODULUS}{day_ms}"


def day_prefixes(start_ms: int, stop_ms: int) -> list[tuple[str, str]]:
    """Per-day [start, stop) row-key ranges covering [start_ms, stop_ms).

    The salt leads the key, so one start/stop pair across days is not a time
    range; one range per day is.  The list has one entry per day of the
    requested window, so its size is bounded by the window, not the data.
    """
    first = start_ms - start_ms % MILLIS_PER_DAY
    out = []
    day = first
    while day < stop_ms:
        lo = max(start_ms, day)
        hi = min(stop_ms, day + MILLIS_PER_DAY)
        prefix_salt = salted_prefix(day)[0]
        out.append((f"{prefix_salt}{lo}", f"{prefix_salt}{hi}"))
        day += MILLIS_PER_DAY
    return out


def id_text(c) -> Column:
    """id to string."""
    return _col(c).cast("string")


def item_key(order_id, line_no, goods_id, sku_id) -> Column:
    """Item id of the test tables: order, line, part and supplier keys."""
    return F.concat_ws("-", *(id_text(c) for c in (order_id, line_no, goods_id, sku_id)))


def parse_column_list(spec: str | None) -> list[str]:
    """Comma list of names; blanks skipped, names trimmed."""
    if spec is None or not spec.strip():
        return []
    return [p.strip() for p in spec.strip().split(",") if p.strip()]


def parse_column_defaults(spec: str | None) -> dict[str, str | None]:
    """``name[:default]`` list; a missing or blank default is null.

    Mirrors Java ``split(":")``: trailing empty pieces vanish, so ``a:`` has
    no default.  Later duplicates overwrite earlier ones.
    """
    if spec is None or not spec.strip():
        return {}
    out: dict[str, str | None] = {}
    pieces = spec.strip().split(",")
    while pieces and pieces[-1] == "":
        pieces.pop()
    for piece in pieces:
        parts = piece.strip().split(":")
        while len(parts) > 1 and parts[-1] == "":
            parts.pop()
        name = parts[0].strip()
        out[name] = parts[1].strip() if len(parts) > 1 else None
    return out
