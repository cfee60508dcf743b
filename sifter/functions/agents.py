"""User-agent attributes and rotation weights as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Browser families tested in order (more specific first), each
# with the pattern that captures its major version; operating systems likewise.
BROWSERS = (
    ("Edge", r"Edg(?:e|A|iOS)?/(\d+)"),
    ("Opera", r"OPR/(\d+)"),
    ("Firefox Mobile", r"Mobile.*Firefox/(\d+)"),
    ("Firefox", r"Firefox/(\d+)"),
    ("Chrome Mobile", r"Chrome/(\d+)[\d.]* Mobile"),
    ("Chrome", r"Chrome/(\d+)"),
    ("Mobile Safari", r"Version/(\d+)[\d.]* Mobile.*Safari"),
    ("Safari", r"Version/(\d+)[\d.]* Safari"),
)
SYSTEMS = (
    ("Windows", r"Windows NT"),
    ("Android", r"Android"),
    ("iOS", r"iPhone|iPad"),
    ("Mac OS X", r"Mac OS X"),
    ("Ubuntu", r"Ubuntu"),
    ("Linux", r"Linux"),
)
# Weight terms of the rotator.
BASE_WEIGHT = 1000
CHROME_BONUS = 100
FIREFOX_EDGE_BONUS = 50
VERSION_FACTOR = 10
WINDOWS_BONUS = 150
MAC_BONUS = 100
LINUX_PENALTY = 50
ANDROID_PENALTY = 100


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def browser(ua) -> Column:
    expr = F.lit("Other")
    for name, pat in reversed(BROWSERS):
        expr = F.when(_c(ua).rlike(pat), F.lit(name)).otherwise(expr)
    return expr


def browser_major(ua) -> Column:
    """Major version of the detected browser; null when absent."""
    expr = F.lit(None).cast("int")
    for _, pat in reversed(BROWSERS):
        expr = F.when(_c(ua).rlike(pat), F.regexp_extract(_c(ua), pat, 1).try_cast("int")).otherwise(expr)
    return expr


def os_family(ua) -> Column:
    expr = F.lit("Other")
    for name, pat in reversed(SYSTEMS):
        expr = F.when(_c(ua).rlike(pat), F.lit(name)).otherwise(expr)
    return expr


def attributes(ua) -> Column:
    return F.struct(_c(ua).alias("string"), browser(ua).alias("browser"),
                    browser_major(ua).alias("browser_version"), os_family(ua).alias("os"))


def weight(browser_col, major_col, os_col, seconds_since_use, strict: bool = False) -> Column:
    """Rotation weight. ``strict=False`` reproduces the rotator as written,
    where two ``x == a or "b"`` tests are always true (+50 for every browser,
    -50 for every OS); ``strict=True`` applies them only to the named values."""
    b, v, o = _c(browser_col), _c(major_col), _c(os_col)
    w = F.lit(float(BASE_WEIGHT)) + F.coalesce(_c(seconds_since_use).cast("double"), F.lit(0.0))
    w = w + F.when(b == "Chrome", CHROME_BONUS).otherwise(0)
    w = w + (F.when(b.isin("Firefox", "Edge"), FIREFOX_EDGE_BONUS).otherwise(0) if strict else F.lit(FIREFOX_EDGE_BONUS))
    w = w + F.when(v.isNotNull() & (v != 0), v * VERSION_FACTOR).otherwise(0)
    w = w + F.when(o == "Windows", WINDOWS_BONUS).otherwise(0)
    w = w + F.when(o == "Mac OS X", MAC_BONUS).otherwise(0)
    w = w - (F.when(o.isin("Linux", "Ubuntu"), LINUX_PENALTY).otherwise(0) if strict else F.lit(LINUX_PENALTY))
    w = w - F.when(o == "Android", ANDROID_PENALTY).otherwise(0)
    return w
