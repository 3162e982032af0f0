"""Display expressions for reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley import constants as C


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def decimals(c, places) -> Column:
    """Fixed number of decimals without grouping; a dash when missing or not finite.

    What is rounded is the exact binary value, so 1.005 (a little less than it looks) gives 1.00; a true
    half is rounded away from zero. The fraction is cut into two parts whose products are exact.
    """
    c = _col(c).cast("double")
    finite = c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    size, cut = F.abs(c), F.lit(float(1 << 26))
    whole = F.floor(size).cast("double")
    part = size - whole
    high = F.floor(part * cut).cast("double") / cut
    scale = F.lit(float(10 ** places))
    top = high * scale
    rest = (top - F.floor(top)) + (part - high) * scale
    units = F.floor(top) + F.when(rest >= 1.5, 2).when(rest >= 0.5, 1).otherwise(0)
    carry = F.when(units >= 10 ** places, 1).otherwise(0)
    digits = F.format_string(f"%d.%0{places}d", whole.cast("long") + carry, units - carry * 10 ** places)
    sign = F.when((c < 0) & digits.rlike("[1-9]"), "-").otherwise("")
    shown = F.when(size < float(1 << 53), F.concat(sign, digits)).otherwise(F.format_string(f"%.{places}f", c))
    return F.when(finite, shown).otherwise(F.lit(C.DISPLAY_DASH))


def ratio(c) -> Column:
    """Two decimals and a times sign; a dash when missing."""
    shown = decimals(c, 2)
    return F.when(shown == C.DISPLAY_DASH, shown).otherwise(F.concat(shown, F.lit("×")))


def in_utc(ts) -> Column:
    """A timestamp moved so that it reads as UTC in whatever zone the session shows it."""
    return F.to_utc_timestamp(_col(ts), F.current_timezone())


def utc_minute(ts) -> Column:
    return F.date_format(in_utc(ts), "yyyy-MM-dd HH:mm 'UTC'")


def iso_timestamp(ts) -> Column:
    return F.date_format(in_utc(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def alert_sentence(terms) -> Column:
    """One sentence naming the first three terms."""
    terms = F.filter(_col(terms), lambda t: t.isNotNull() & (t != C.DISPLAY_DASH))
    opening, closing = C.ALERT_SUBJECT_WITH_TERMS
    named = F.concat(F.lit(opening), F.array_join(F.slice(terms, 1, 3), ", "), F.lit(closing))
    subject = F.when(F.size(terms) > 0, named).otherwise(F.lit(C.ALERT_SUBJECT_PLAIN))
    return F.concat(subject, F.lit(C.ALERT_PREDICATE))


def domain_label(code) -> Column:
    """Display name of a domain code, looked up without regard to case; the code when unknown."""
    code = _col(code)
    pairs = [F.lit(x) for pair in C.DOMAIN_LABELS.items() for x in pair]
    shown = F.create_map(*pairs)[F.lower(F.coalesce(code, F.lit("")))]
    return F.coalesce(shown, code, F.lit(C.DISPLAY_DASH))
