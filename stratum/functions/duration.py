"""Episode duration text -> minutes, as one native CASE expression.

Branches are tried in order and the first match wins (LIKE is case-sensitive):

  1. '... min per ep' without an 'hr ... min' part -> number before ' min'
  2. 'H hr M min ...'                               -> H * 60 + M
  3. '... min ...'                                  -> number before ' min'
     (seconds after the minutes are dropped: '2 min 30 sec' -> 2)
  4. '... sec ...'                                  -> number before ' sec' / 60
  5. '... hr ...'                                   -> number before ' hr' * 60
  6. anything else (including 'Unknown', '' and NULL) -> NULL

``strict=True`` uses ANSI casts, so text such as '1 hr 30 sec' (branch 4 gets
'1 hr 30') raises like the reference's cast does; ``strict=False`` uses
``try_cast`` and yields NULL there.  Result type: float.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: the LIKE patterns of the five
# branches in order, and the markers the numbers are cut at.
MIN_PER_EP = "% min per ep%"
HR_MIN = "%hr%min%"
ANY_MIN = "% min%"
ANY_SEC = "%sec%"
ANY_HR = "%hr%"
MIN_MARK, SEC_MARK, HR_MARK, HR_SPACE = " min", " sec", " hr", "hr "
# ---------------------------------------------------------------------------


def _to(c: Column, typ: str, strict: bool) -> Column:
    return c.cast(typ) if strict else c.try_cast(typ)


def duration_minutes(duration: Column | str, strict: bool = True) -> Column:
    d = F.col(duration) if isinstance(duration, str) else duration
    before_min = F.split_part(d, F.lit(MIN_MARK), F.lit(1))
    before_sec = F.split_part(d, F.lit(SEC_MARK), F.lit(1))
    before_hr = F.split_part(d, F.lit(HR_MARK), F.lit(1))
    # 'H hr M min': hours are the text before ' hr'; minutes sit between 'hr '
    # and ' min'.
    p_hr_sp = F.locate(HR_MARK, d)
    p_hr = F.locate(HR_SPACE, d)
    p_min = F.locate(MIN_MARK, d)
    hours = F.substr(d, F.lit(1), p_hr_sp - 1)
    mins = F.trim(F.substr(d, p_hr + len(HR_SPACE), p_min - p_hr - len(HR_SPACE)))
    hr_min = d.like(HR_MIN)
    return (
        F.when(d.like(MIN_PER_EP) & ~hr_min, _to(before_min, "int", strict))
        .when(hr_min, _to(hours, "int", strict) * 60 + _to(mins, "int", strict))
        .when(d.like(ANY_MIN), _to(before_min, "int", strict))
        .when(d.like(ANY_SEC), _to(before_sec, "float", strict) / F.lit(60.0))
        .when(d.like(ANY_HR), _to(before_hr, "int", strict) * 60)
        .otherwise(F.lit(None))
        .cast("float")
    )
