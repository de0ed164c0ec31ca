"""Text expressions for alerts: clipping, driver phrases, number formats, summaries.

All are Spark SQL expressions (no Python UDF), so they run inside whole-stage
code generation next to the projection that uses them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions import constants as K
from tidewatch.functions.exprs import col_, fixed_decimals

_STRIP_RE = rf"^{K.WHITESPACE_CLASS}+|{K.WHITESPACE_CLASS}+$"


def strip_ws(c) -> Column:
    """Remove leading and trailing Unicode whitespace (not only spaces, unlike ``trim``)."""
    return F.regexp_replace(col_(c), _STRIP_RE, "")


def clip_text(c, limit: int = K.MAX_FIELD_LEN) -> Column:
    """CR/LF → space, strip surrounding (Unicode) whitespace, keep ``limit`` characters."""
    one_line = F.regexp_replace(F.regexp_replace(col_(c), "\r", " "), "\n", " ")
    return F.substring(strip_ws(one_line), 1, limit)


def clip_list(c, limit_items: int = K.MAX_LIST_ITEMS) -> Column:
    """First ``limit_items`` entries, each text entry clipped."""
    return F.transform(F.slice(col_(c), 1, limit_items), lambda x: clip_text(x))


def clip_map(c, limit_items: int = K.MAX_LIST_ITEMS) -> Column:
    """First ``limit_items`` entries of a map, text values clipped."""
    entries = F.slice(F.map_entries(col_(c)), 1, limit_items)
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"].alias("key"),
                                                                      clip_text(e["value"]).alias("value"))))


def driver_phrases(c, max_items: int = K.MAX_DRIVERS) -> Column:
    """Driver codes → phrases (lower/trim, known code map, else ``_`` → space), first 5."""
    phrase_map = F.create_map(*[x for k, v in K.DRIVER_PHRASES.items() for x in (F.lit(k), F.lit(v))])

    def norm(d):
        key = F.lower(strip_ws(d))
        return F.coalesce(phrase_map[key], F.regexp_replace(key, "_", " "))

    return F.transform(F.slice(col_(c), 1, max_items), norm)


def fmt_score(c) -> Column:
    """Three decimals, ``n/a`` when missing."""
    return F.coalesce(fixed_decimals(c, 3), F.lit("n/a"))


def fmt_pct(c) -> Column:
    """Percent with one decimal, ``n/a`` when missing."""
    return F.coalesce(F.concat(fixed_decimals(col_(c).cast("double") * 100.0, 1), F.lit("%")), F.lit("n/a"))


def summary_text(dept, week, risk, threshold, warning, headcount, leavers, attrition, drivers, notes) -> Column:
    """The multi-line advisory summary; optional lines are NULL and skipped by concat_ws."""
    h, r, (on, off), c, w = K.SUMMARY_HEADER, K.SUMMARY_RISK, K.SUMMARY_STATUS, K.SUMMARY_CONTEXT, K.SUMMARY_DRIVERS
    header = F.concat(F.lit(h[0]), F.coalesce(col_(dept), F.lit("unknown")), F.lit(h[1]), F.coalesce(col_(week), F.lit("n/a")), F.lit(h[2]))
    status = F.when(F.coalesce(col_(warning), F.lit(False)), F.lit(on)).otherwise(F.lit(off))
    risk_line = F.concat(F.lit(r[0]), fmt_score(risk), F.lit(r[1]), fmt_score(threshold), F.lit(r[2]), status, F.lit(r[3]))
    parts = F.array_compact(F.array(
        F.concat(F.lit(c[1]), col_(headcount).cast("string")),
        F.concat(F.lit(c[2]), col_(leavers).cast("string")),
        F.when(col_(attrition).isNotNull(), F.concat(F.lit(c[3]), fmt_pct(attrition)))))
    ctx = F.when(F.size(parts) > 0, F.concat(F.lit(c[0]), F.array_join(parts, ", "), F.lit(".")))
    d = driver_phrases(F.coalesce(col_(drivers), F.array().cast("array<string>")))
    n = F.size(d)
    drv = (F.when(n == 1, F.concat(F.lit(w[0]), F.element_at(d, 1), F.lit(".")))
           .when(n > 1, F.concat(F.lit(w[1]), F.array_join(F.slice(d, 1, n - 1), ", "), F.lit(w[2]), F.element_at(d, -1), F.lit("."))))
    note = F.when(F.coalesce(F.length(col_(notes)), F.lit(0)) > 0, F.concat(F.lit(K.SUMMARY_NOTE), col_(notes)))
    return F.concat_ws("\n", header, risk_line, ctx, drv, note, F.lit(K.SUMMARY_ADVISORY))


def non_blank_lines(text) -> Column:
    """The summary split into lines, blank lines dropped."""
    return F.filter(F.split(col_(text), "\n"), lambda x: F.length(strip_ws(x)) > 0)
