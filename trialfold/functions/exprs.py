"""Reusable column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
UNAVAILABLE = "unavailable"
# Default metrics-collector filter: `name=value` pairs.
DEFAULT_FILTER = r"([\w|-]+)\s*=\s*([+-]?\d*(\.\d+)?([Ee][+-]?\d+)?)"
# Go zero time, printed back for rows without a timestamp.
ZERO_TIME = "0001-01-01T00:00:00Z"

# A float lexeme, decimal or hexadecimal, as a 64-bit float parse accepts it
# (NaN excluded, see quirk Q4: Spark's own cast would also take '1d' and ' 1').
FLOAT_RE = (r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
            r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+)$")
INFINITE_RE = r"^[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?$"
# Strict RFC3339 with optional fraction and mandatory zone.
RFC3339_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"

# Sort key used for rows without a timestamp (they sort first).
NO_TIME_KEY = -(2**62)


def num(c: Column | str) -> Column:
    """Guarded float parse: NULL unless the text is a float.  A named
    infinity is a number; finite digits beyond the range of 64 bits aren't."""
    c = F.col(c) if isinstance(c, str) else c
    x = c.try_cast("double")
    finite = F.abs(x) < F.lit(float("inf"))
    return F.when(c.rlike(FLOAT_RE), F.when(finite, x)).when(c.rlike(INFINITE_RE), x)


def rfc3339_parts(tok: Column) -> tuple[Column, Column]:
    """Parse an RFC3339(Nano) token -> (timestamp truncated to µs, nanos of
    second).  NULLs when the token is not strict RFC3339."""
    ok = tok.rlike(RFC3339_RE)
    base = F.substring(tok, 1, 19)
    zone = F.regexp_extract(tok, r"(Z|[+-]\d{2}:\d{2})$", 1)
    frac = F.regexp_extract(tok, r"\.(\d+)", 1)
    nanos = F.when(frac == "", F.lit(0)).otherwise(
        F.substring(F.rpad(frac, 9, "0"), 1, 9).cast("int"))
    # the strict regex already vetted the shape; a plain cast parses it
    whole = F.concat(base, F.when(zone == "Z", F.lit("+00:00")).otherwise(zone)).try_cast("timestamp")
    ts = F.timestamp_micros(F.unix_micros(whole) + F.floor(nanos / 1000))
    return F.when(ok, ts), F.when(ok & whole.isNotNull(), nanos)


def time_key(ts: Column, nanos: Column | None = None) -> Column:
    """Long ordering key (nanoseconds since epoch, NULL time first)."""
    k = F.unix_micros(ts) * 1000
    if nanos is not None:
        k = k + F.coalesce(nanos, F.lit(0)) % 1000
    return F.coalesce(k, F.lit(NO_TIME_KEY))


def ts_text(ts: Column) -> Column:
    """Timestamp flattened to text for reports (µs precision, UTC)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def md5_uniform(*parts: Column) -> Column:
    """Deterministic uniform draw in [0, 1): first 32 bits of md5 of the
    parts joined by '|'.  Same in any partitioning and in any SQL engine."""
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def md5_long(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan (file sizes for scans)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - non-JVM backends
        return 1 << 62


def small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only behind a size check; above it the planner (and
    AQE at runtime) chooses a shuffle join."""
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df
