"""String expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_first(c, pattern: str, replacement: str) -> Column:
    """Replace only the first match of a regular expression (Spark's ``regexp_replace`` replaces
    all).  A lazy prefix anchored at the start keeps everything before the first match; the pattern stands
    in a group of its own, so an alternation stays inside it."""
    rep = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(_c(c), F.lit(f"^((?s:.*?))(?:{pattern})"), F.lit(f"$1{rep}"))


def parse_duration(c) -> Column:
    """``[Xh][Ym]Zs`` text → seconds (double); a number without a unit counts as seconds; other text → null."""
    c = _c(c)

    def part(unit):
        v = F.regexp_extract(c, rf"(\d+(?:\.\d+)?){unit}", 1)
        return F.when(v == "", F.lit(0.0)).otherwise(v.cast("double"))

    ok = c.rlike(r"^\s*(\d+(\.\d+)?h)?\s*(\d+(\.\d+)?m)?\s*(\d+(\.\d+)?s?)?\s*$") & c.rlike(r"\d")
    bare = F.regexp_extract(c, r"(\d+(?:\.\d+)?)\s*$", 1)
    return F.when(ok, part("h") * 3600 + part("m") * 60 + F.when(bare == "", part("s")).otherwise(bare.try_cast("double")))


def format_duration(c) -> Column:
    """Seconds → ``1h2m3s``; zero units left out, ``0s`` for zero.  The whole number of seconds is
    rounded half to even (``bround``) before it is split, so 59.6 gives ``1m`` and never ``60s``."""
    total = F.bround(_c(c).cast("double"), 0).cast("long")
    h = F.floor(total / 3600)
    m = F.floor((total % 3600) / 60)
    s = total % 60
    txt = F.concat(F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))).otherwise(F.lit("")),
                   F.when(m > 0, F.concat(m.cast("string"), F.lit("m"))).otherwise(F.lit("")),
                   F.when(s > 0, F.concat(s.cast("string"), F.lit("s"))).otherwise(F.lit("")))
    return F.when(total == 0, F.lit("0s")).otherwise(txt)


# Fixed value: a markup tag is a bracket whose first character is a lowercase letter, ``/``, ``#`` or ``@``:
# ``[bold]``, ``[/bold]``, ``[/]``, ``[#ff0000]``, ``[link=…]``.
MARKUP_TAG = r"\[[a-z/#@][^\[\]]*\]"


def strip_markup(c) -> Column:
    """X11: remove markup tags from a cell or header."""
    return F.regexp_replace(_c(c), MARKUP_TAG, "")


def strip_markup_names(df: DataFrame) -> DataFrame:
    """X11 for the headers of a table."""
    return df.toDF(*[re.sub(MARKUP_TAG, "", c) for c in df.columns])


def weight_from_name(c, default: float = 1.0) -> Column:
    """Weight ``_w<digits>_`` / ``_W<digits>_`` in a file name (the last match wins), else ``default``."""
    c = _c(c)
    last = F.regexp_extract(c, r".*_[wW](\d+)_", 1)
    return F.when(last == "", F.lit(float(default))).otherwise(last.cast("double"))
