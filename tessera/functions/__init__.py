"""Column-expression helpers (all JVM-side, codegen friendly).

Deterministic noise replaces per-row random draws: the same
``(salt, key...)`` always gives the same integer, so reruns, task retries
after a lost executor, and the DuckDB oracle all agree.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Integer hash modulo the Mersenne prime 2^31 - 1. Each key enters through a
# salt-specific multiply-add plus its own square (nonlinear in the key), and the
# state is squared once at the end. Every intermediate stays below 2^62, so there
# is no overflow (Spark's ANSI mode would raise) and any SQL engine with 64-bit
# integers computes the same value - pure arithmetic inside whole-stage codegen
# (an md5 per draw costs ~20x more). The state is referenced once per round, so
# the expression grows linearly with the number of keys.
HASH_P = 2147483647
HASH_ADD = 12345


def salt_seed(salt: str) -> int:
    """Per-salt starting state (fixed at plan time)."""
    return int(hashlib.md5(salt.encode()).hexdigest()[:8], 16) % HASH_P


def salt_mul(salt: str) -> int:
    """Per-salt multiplier in [2^20, 2^30)."""
    return (1 << 20) + int(hashlib.md5(("m:" + salt).encode()).hexdigest()[:8], 16) % ((1 << 30) - (1 << 20))


def noise(salt: str, *keys: ColumnOrName) -> Column:
    """Uniform draw in [0, 2**31 - 1) from integer keys.

    DuckDB twin: ``tessera.oracle.adapter_sql.noise`` (same arithmetic)."""
    p, a = F.lit(HASH_P), salt_mul(salt)
    h = F.lit(salt_seed(salt)).cast("long")
    for k in keys:
        kk = F.pmod(_col(k).cast("long"), p)
        # h*a < 2^61 and kk*kk < 2^62: the sum stays below 2^63
        h = F.pmod(h * a + kk * kk + kk + HASH_ADD, p)
    h = F.pmod(h * a + HASH_ADD, p)
    return F.pmod(h * h + a, p)


def noises(salts: list[str], *keys: ColumnOrName) -> list[Column]:
    """``noise`` of the same keys for many salts, in their order.

    ``keys`` are key terms (``noise_term``), a column each, so that they are
    computed once. Two rounds are taken as one (h*a^2 + k1*a + k2), which is the
    same number modulo the prime: with fewer operations, a dozen draws fit into
    a generated method that the JVM still compiles."""
    p = F.lit(HASH_P).cast("long")

    def one(salt: str) -> Column:
        a, h = salt_mul(salt), salt_seed(salt)
        square, terms = a * a % HASH_P, [_col(k) for k in keys]
        if len(terms) % 2 == 0:  # an odd number of rounds, the last one included
            h = (terms.pop(0) + F.lit(h * a % HASH_P)) % p
        terms.append(F.lit(HASH_ADD).cast("long"))
        for k1, k2 in zip(terms[::2], terms[1::2]):
            # h*a^2 < 2^62 and k1*a < 2^61: the sum stays below 2^63
            before = F.lit(h * square % HASH_P) if isinstance(h, int) else h * F.lit(square).cast("long")
            h = (k1 * F.lit(a).cast("long") + before + k2) % p
        return (h * h + F.lit(a).cast("long")) % p

    return [one(s) for s in salts]


def noise_term(key: ColumnOrName) -> Column:
    """What an integer key adds in its round of ``noise``, below the prime."""
    kk = F.pmod(_col(key).cast("long"), F.lit(HASH_P))
    return (kk * kk + kk + HASH_ADD) % F.lit(HASH_P).cast("long")


def draw(salt: str, n: int, *keys: ColumnOrName) -> Column:
    """Integer draw in ``0..n-1``."""
    return F.pmod(noise(salt, *keys), F.lit(n))


def date_key(d: ColumnOrName) -> Column:
    """INT YYYYMMDD key of a date."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def pad(c: ColumnOrName, n: int) -> Column:
    """The value as text, zero-padded on the left to at least ``n`` characters.
    Longer values stay whole (plain ``lpad`` would cut them)."""
    s = _col(c).cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(n)), F.lit("0"))


def year_month_key(d: ColumnOrName) -> Column:
    d = _col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def shift(d: ColumnOrName, years: int) -> Column:
    """DATEADD(YEAR, n, d): Feb 29 maps to Feb 28/29 like add_months."""
    return F.add_months(_col(d).cast("date"), 12 * years)


def year_diff(a: ColumnOrName, b: ColumnOrName) -> Column:
    """DATEDIFF(YEAR, a, b) counts year boundaries, not whole years."""
    return F.year(_col(b)) - F.year(_col(a))


def us_week(d: ColumnOrName) -> Column:
    """DATEPART(WEEK): Jan 1 is in week 1, weeks start on Sunday."""
    d = _col(d)
    jan1_dow = F.dayofweek(F.trunc(d, "year"))  # 1 = Sunday
    return F.ceil((F.dayofyear(d) + jan1_dow - 1) / 7).cast("int")


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (ANSI mode raises on /0)."""
    num, den = _col(num).cast("double"), _col(den).cast("double")
    return F.when(den != 0, num / den)


def ratio(num: ColumnOrName, den: ColumnOrName, digits: int, precision: int = 19, scale: int = 0, den_scale: int = 0) -> Column:
    """num / den rounded half away from zero to ``digits`` decimals, exactly, as
    DECIMAL(precision, digits); NULL when den is 0 or NULL.

    ``scale`` and ``den_scale`` are the decimals of num and den. Both become
    integers a and b, and (2|a| + |b|) div (2|b|) is the rounded quotient, so a
    tie is a tie in every engine (a division of DOUBLEs rounds a binary
    fraction). |num| up to 10^18 units of its last decimal; the rounded
    quotient must fit 64 bits."""
    more = max(scale - digits, den_scale, 0)

    def whole(c: Column, has: int, up: int) -> Column:
        return (c.cast(f"decimal({22 + has},{has})") * F.lit(Decimal(10 ** up))).cast("decimal(34,0)")

    a, b = whole(_col(num), scale, digits + more), whole(_col(den), den_scale, more)
    half_up = F.call_function("div", F.abs(a) * 2 + F.abs(b), F.nullif(F.abs(b) * 2, F.lit(0).cast("decimal(36,0)")))
    signed = F.when((a < 0) != (b < 0), -half_up).otherwise(half_up)
    return (signed.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal({precision},{digits})")


def pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """Rounded percentage, 100 * num / den."""
    return F.round(safe_div(_col(num).cast("double") * 100.0, den), digits)


def r(c: ColumnOrName, digits: int = 4) -> Column:
    """Round to ``digits`` as DOUBLE (report outputs compare at this precision)."""
    return F.round(_col(c).cast("double"), digits)


def money(c: ColumnOrName) -> Column:
    return _col(c).cast("decimal(19,4)")
