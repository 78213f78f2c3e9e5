"""Scalar column functions (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def round3(x) -> Column:
    """A double rounded to 3 decimals by its exact binary value, ties to the even digit: ``float(f"{v:.3f}")``.

    The value is mantissa / 2^shift with a whole mantissa under 2^53, so 1000 * mantissa fits a long and its
    quotient and remainder by 2^shift decide. From 2^43 on, three decimals tell no two doubles apart; under
    2^-11 nothing is left.
    """
    def rounded(a: Column) -> Column:
        # 2^shift has shift <= 63: quotient and remainder by its half, which fits a long
        def by_half(s: Column) -> Column:
            return _let(F.call_function("div", s["thousand"], s["half"]), lambda q: F.struct(
                F.call_function("shiftright", q, F.lit(1)).alias("whole"), (q.bitwiseAND(F.lit(1)) == 1).alias("upper"),
                (s["thousand"] > q * s["half"]).alias("rest")))

        def quotient(h: Column) -> Column:
            up = h["upper"] & (h["rest"] | (h["whole"].bitwiseAND(F.lit(1)) == 1))
            return (h["whole"] + F.when(up, 1).otherwise(0)).cast("double") / F.lit(1000.0)

        def parts(shift: Column) -> Column:
            return F.struct(((a * F.pow(F.lit(2.0), shift)).cast("bigint") * F.lit(1000)).alias("thousand"),
                            F.call_function("shiftleft", F.lit(1).cast("bigint"), (shift - 1).cast("int")).alias("half"))

        guess = F.lit(52) - F.floor(F.log2(a)).cast("int")  # off by one at most; factors are exact powers of two
        shift = _let(guess, lambda g: _let(a * F.pow(F.lit(2.0), g), lambda m: g + F.when(m >= 2.0 ** 53, -1).when(m < 2.0 ** 52, 1).otherwise(0)))
        return _let(_let(_let(shift, parts), by_half), quotient)

    def signed(v: Column) -> Column:
        a = F.abs(v)
        inside = (a >= F.lit(2.0 ** -11)) & (a < F.lit(2.0 ** 43))
        size = F.when(inside, _let(F.when(inside, a).otherwise(F.lit(1.0)), rounded)).when(a < 1, F.lit(0.0)).otherwise(a)
        return F.when(v < 0, -size).otherwise(size)
    return _let(_c(x).cast("double"), signed)


def frac(key, salt: str = "") -> Column:
    """Repeatable uniform number in [0, 1) from a key: first 8 hex digits of md5."""
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_32)


def uniform(a: float, b: float, key, salt: str = "") -> Column:
    """Repeatable uniform number in [a, b], rounded to 3 decimals."""
    return F.round(F.lit(float(a)) + F.lit(float(b - a)) * frac(key, salt), 3)


def uniform_int(a: int, b: int, key, salt: str = "") -> Column:
    """Repeatable integer in [a, b] (both ends included)."""
    return (F.lit(int(a)) + F.floor(frac(key, salt) * F.lit(int(b - a + 1)))).cast("bigint")


def location_eq_ci(a, b) -> Column:
    """Case-insensitive equality of two locations."""
    return F.lower(_c(a)) == F.lower(_c(b))


def location_differs(a, b) -> Column:
    """Case-sensitive, null-safe inequality (two nulls are equal)."""
    return ~_c(a).eqNullSafe(_c(b))


def ntz_as_utc(ts) -> Column:
    """A TIMESTAMP_NTZ wall time read as UTC, whatever the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, _c(ts)))


def epoch_seconds(ts, ntz: bool = True) -> Column:
    """Epoch seconds (floored) of a timestamp; a TIMESTAMP_NTZ is read as UTC wall time."""
    return F.unix_seconds(ntz_as_utc(ts) if ntz else _c(ts))


def seconds_of_day_gap(a, b) -> Column:
    """``(a - b).seconds`` of two timestamps: the remainder within a day, never negative."""
    micros = F.unix_micros(_c(a).cast("timestamp")) - F.unix_micros(_c(b).cast("timestamp"))
    return F.pmod(F.floor(micros / F.lit(1_000_000)), F.lit(86400)).cast("bigint")


def add_seconds(ts, secs) -> Column:
    return _c(ts).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(secs).cast("decimal(18,6)"))


def add_millis(ts, millis) -> Column:
    return F.timestamp_micros(F.unix_micros(_c(ts).cast("timestamp")) + _c(millis).cast("bigint") * F.lit(1000))


def surrogate_id(prefix: str, key, salt: str = "id") -> Column:
    """Prefixed id: prefix + key + 8 repeatable alphanumerics from md5(key)."""
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(salt)))
    return F.concat(F.lit(prefix), _c(key).cast("string"), F.substring(digest, 1, 8))
