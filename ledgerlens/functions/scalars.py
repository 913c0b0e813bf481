"""Scalar column expressions (H3-H20), built-in functions only."""

from __future__ import annotations

import functools
import html
import html.entities
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labels import _col, collapse_blanks, literal_map

# ---------------------------------------------------------------------------
# H3 one-cell text
# ---------------------------------------------------------------------------


def to_cell(c, max_len: int = 280, sep: str = "; ") -> Column:
    """Flatten a string or array-of-strings value to one cell; cut to ``max_len`` with an ellipsis.

    Null becomes ''. A cut keeps ``max_len - 1`` characters, strips trailing blanks, appends '…'.
    """
    c = _col(c)
    return _cut(F.coalesce(c.cast("string"), F.lit("")), max_len)


def array_to_cell(c, max_len: int = 280, sep: str = "; ", item_len: int = 80) -> Column:
    """List value -> one cell: each element cut to ``item_len`` (80 for scalars, 100 for nested
    values in the reference rule), joined with '; ', the whole cut to ``max_len``."""
    c = _col(c)
    joined = F.array_join(F.transform(c, lambda x: _cut(F.coalesce(x.cast("string"), F.lit("")), item_len)), sep)
    return _cut(F.coalesce(joined, F.lit("")), max_len)


def map_to_cell(c, max_len: int = 280, sep: str = "; ", item_len: int = 60) -> Column:
    """Object value -> 'Key: value; ...' with humanized keys and values cut to ``item_len``."""
    from .labels import humanize

    c = _col(c)
    parts = F.transform(
        F.map_entries(c),
        lambda e: F.concat(humanize(e["key"]), F.lit(": "), _cut(F.coalesce(e["value"].cast("string"), F.lit("")), item_len)),
    )
    return _cut(F.coalesce(F.array_join(parts, sep), F.lit("")), max_len)


def _cut(s: Column, max_len: int) -> Column:
    return F.when(
        F.char_length(s) > max_len,
        F.concat(F.regexp_replace(F.substring(s, 1, max_len - 1), r"\s+$", ""), F.lit("…")),
    ).otherwise(s)


# ---------------------------------------------------------------------------
# H4 HTML clean-up
# ---------------------------------------------------------------------------

_ENTITY = "&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


@functools.cache
def _entity_table() -> str:
    """Named entities of HTML 5 by their first letter, as JSON text, from the standard library."""
    table: dict[str, dict[str, str]] = {}
    for name, text in html.entities.html5.items():
        if name.endswith(";"):
            table.setdefault(name[0], {})[name[:-1]] = text
    return json.dumps(table)


@functools.cache
def _windows_codes() -> str:
    """Numeric entities 128-159 stand for Windows-1252 characters; as JSON text."""
    return json.dumps({str(i): html.unescape(f"&#{i};") for i in range(128, 160)})


def _entity_text(e: Column) -> Column:
    """The text of one entity's inside ('amp', '#8217', '#x2019'); an unknown name stays as written.

    The tables are one string literal each, which the optimizer folds into a constant map: no entry is
    an expression of the plan, and a look-up reads the names of one first letter."""
    digits = F.regexp_extract(e, "^#[xX]?([0-9A-Fa-f]+)$", 1)
    code = F.when(e.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    bad = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    windows = F.try_element_at(F.from_json(F.lit(_windows_codes()), "map<string,string>"), code.cast("string"))
    numeric = F.when(bad, F.lit("\ufffd")).when(code.between(128, 159), windows).otherwise(char)
    names = F.try_element_at(F.from_json(F.lit(_entity_table()), "map<string,map<string,string>>"), F.substring(e, 1, 1))
    named = F.coalesce(F.try_element_at(names, e), F.concat(F.lit("&"), e, F.lit(";")))
    return F.when(e.startswith("#"), numeric).otherwise(named)


def unescape(c) -> Column:
    """Numeric and named HTML entities decoded in one pass (what an entity yields is not read again)."""
    c = _col(c)
    between = F.split(c, _ENTITY, -1)
    texts = F.transform(F.regexp_extract_all(c, F.lit(_ENTITY), 1), _entity_text)
    joined = F.array_join(F.zip_with(between, texts, lambda b, t: F.concat(b, F.coalesce(t, F.lit("")))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def clean_html(c) -> Column:
    """Decode entities and collapse blanks, no-break spaces included (H4)."""
    return collapse_blanks(unescape(c))


# ---------------------------------------------------------------------------
# H5 id extraction
# ---------------------------------------------------------------------------


def extract_ids(c, pattern: str = r"(\d{6,7})", group: int = 1) -> Column:
    """All ids matching ``pattern`` in a text, as array<string> (H5)."""
    return F.regexp_extract_all(_col(c), F.lit(pattern), group)


# ---------------------------------------------------------------------------
# H6 amount text -> number, H7 unit conversion
# ---------------------------------------------------------------------------

# Multipliers of amount suffixes into the canonical unit of their currency
# (rupee amounts in crore, dollar amounts in million).
INR_SUFFIX = {
    "": 1.0, "lakh": 0.01, "cr": 1.0, "crore": 1.0, "lakh cr": 1e5, "lakh crore": 1e5, "mn": 0.1, "million": 0.1, "bn": 100.0,
    "billion": 100.0, "tn": 1e5, "trillion": 1e5,
}
USD_SUFFIX = {
    "": 1.0, "mn": 1.0, "million": 1.0, "bn": 1000.0, "billion": 1000.0, "tn": 1e6, "trillion": 1e6, "lakh": 0.1, "cr": 10.0,
    "crore": 10.0, "lakh cr": 1e6, "lakh crore": 1e6,
}
_AMOUNT_RE = (
    r"(?iU)^\s*([-+\u2212]?)\s*(Rs\.?|\u20b9|INR|\$|USD)?\s*([-+\u2212]?)\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*([a-z]+(?:\s+[a-z]+)?|%)?\.?\s*$"
)


def parse_amount(c) -> Column:
    """Amount text -> struct(value double, unit string) (H6).

    'Rs 1,45,980cr' -> (145980, 'INR_cr'); '₹1.97 Lakh Crore' -> (197000, 'INR_cr');
    '$776.0bn' -> (776000, 'USD_mn'); '+21.2%' -> (21.2, 'pct'). Case does not matter, one sign
    may stand before or after the currency, and the whole text must be an amount: two signs, an unknown
    suffix or further words give nulls. Without a currency a rupee or dollar suffix tells it.
    """
    c = _col(c)
    # one match for all groups; a text that is no amount stays whole and has no parts
    found = F.split(F.regexp_replace(F.replace(c, F.lit("\x01"), F.lit("?")), _AMOUNT_RE, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")
    return F.transform(F.array(found), _amount)[0]


def _amount(parts: Column) -> Column:
    """Value and unit of an amount's sign, currency, sign, number and suffix; nulls if those are not five parts."""
    five = F.size(parts) == 5
    part = lambda i: F.get(parts, i - 1)
    cur, suf = F.lower(part(2)), collapse_blanks(F.lower(part(5)))
    base = F.when(five, F.replace(part(4), F.lit(",")).try_cast("double"))
    rupees = cur.isin("rs", "rs.", "\u20b9", "inr") | ((cur == "") & suf.isin("lakh", "cr", "crore", "lakh cr", "lakh crore"))
    dollars = cur.isin("$", "usd") | ((cur == "") & suf.isin("mn", "million", "bn", "billion", "tn", "trillion"))
    mult = (
        F.when(suf == "%", F.lit(1.0))
        .when(rupees, F.try_element_at(literal_map(INR_SUFFIX), suf))
        .when(dollars, F.try_element_at(literal_map(USD_SUFFIX), suf))
        .when(suf == "", F.lit(1.0))
    )
    minus = part(1).isin("-", "\u2212") | part(3).isin("-", "\u2212")
    two_signs = (part(1) != "") & (part(3) != "")
    value = F.when(five & ~two_signs, F.when(minus, -base).otherwise(base) * mult)
    unit = F.when(suf == "%", F.lit("pct")).when(dollars, F.lit("USD_mn")).when(rupees, F.lit("INR_cr"))
    # a value's nullness is the unit's: each is computed once
    return F.transform(F.array(value), lambda v: F.struct(v.alias("value"), F.when(v.isNotNull(), unit).cast("string").alias("unit")))[0]


# Conversion factors into the base unit of each dimension
# (area -> acres, counts -> units, rupees -> crore).
ACRES_PER_HECTARE = 2.47105
UNIT_FACTORS = {
    "acre": 1.0,
    "ha": ACRES_PER_HECTARE,
    "sq_km": ACRES_PER_HECTARE * 100.0,
    "sq_m": ACRES_PER_HECTARE / 10000.0,
    "unit": 1.0,
    "thousand": 1e3,
    "million": 1e6,
    "billion": 1e9,
    "crore": 1.0,
    "lakh": 0.01,
    "lakh_crore": 1e5,
}


def to_unit(value, from_unit, to_unit_name: str) -> Column:
    """Convert ``value`` given in ``from_unit`` (column) into ``to_unit_name`` (H7).

    Units of one dimension share a base; an unknown unit gives null.
    """
    fac = literal_map(UNIT_FACTORS)
    return _col(value) * F.try_element_at(fac, _col(from_unit)) / F.lit(UNIT_FACTORS[to_unit_name])


# ---------------------------------------------------------------------------
# H8 fiscal calendar, H9 date parsing, H10 rounding
# ---------------------------------------------------------------------------


def fiscal_year(d, start_month: int = 4) -> Column:
    """Start year of the fiscal year (April-March by default) (H8)."""
    return F.year(F.add_months(F.to_date(_col(d)), -(start_month - 1)))


def fiscal_quarter(d, start_month: int = 4) -> Column:
    return F.quarter(F.add_months(F.to_date(_col(d)), -(start_month - 1)))


def fiscal_label(d, start_month: int = 4) -> Column:
    """'FY2020-21' style label."""
    fy = fiscal_year(d, start_month)
    return F.format_string("FY%d-%02d", fy, (fy + 1) % 100)


def parse_date(c, formats: Sequence[str] = ("yyyy-MM-dd", "d MMM yyyy", "d MMMM yyyy", "dd/MM/yyyy")) -> Column:
    """First format that parses wins; unparsable -> null (H9). Month names match in any case."""
    c = F.initcap(F.lower(F.trim(_col(c))))
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def rnd(c, n: int) -> Column:
    """Half-even rounding."""
    return F.bround(_col(c), n)


# ---------------------------------------------------------------------------
# H11 log-clip, H12 bands, H13 rule verdicts, H14 status classes
# ---------------------------------------------------------------------------


def log_clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """log10 of a positive value, clipped to [lo, hi]; non-positive -> null."""
    c = _col(c)
    v = F.when(c > 0, F.log10(c))
    if lo is not None:
        v = F.greatest(v, F.lit(lo))
    if hi is not None:
        v = F.least(v, F.lit(hi))
    return v


def band(c, cuts: Sequence[tuple[float, str]], default: str, inclusive: bool = True) -> Column:
    """Threshold band: first (cut, label) with value >= cut (or > cut) wins, in the given order."""
    c = _col(c)
    out = None
    for cut, label in cuts:
        cond = c >= cut if inclusive else c > cut
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.when(c.isNotNull(), F.lit(default))
    # a missing value (not published) gets no band, not the lowest one
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(F.lit(default)))


def status_class(c, patterns: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """Status text -> class by the first matching regex (case-insensitive)."""
    c = F.lower(_col(c))
    out = None
    for pat, label in patterns:
        cond = c.rlike(pat)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def cite_url(template: str, *cols) -> Column:
    """URL / citation from a printf template."""
    return F.format_string(template, *[_col(c) for c in cols])


# ---------------------------------------------------------------------------
# H16 nested access, H17 spread, H19 shape, H20 alternate keys
# ---------------------------------------------------------------------------


def melt_map(df: DataFrame, map_col: str, key_name: str = "key", value_name: str = "value") -> DataFrame:
    """Year-keyed map -> long rows."""
    others = [c for c in df.columns if c != map_col]
    return df.select(*others, F.explode_outer(map_col).alias(key_name, value_name))


def json_shape(c) -> Column:
    """'object_list' | 'scalar_list' | 'list' | 'object' | 'scalar' | 'null' of a JSON text.

    A list of objects or a list of scalars must be non-empty; a scalar list may mix types and
    contain nulls; an empty list or a list mixing objects, lists and scalars is 'list'.
    Invalid JSON counts as 'null'. The first non-blank character picks one parser, so each text
    is parsed once."""
    c = _col(c)
    head = F.substring(F.ltrim(c), 1, 1)
    # the kinds that a list holds, as sorted letters: o(bject), l(ist), s(calar)
    kinds = F.transform(
        F.from_json(c, "array<variant>"),
        lambda e: F.coalesce(F.try_element_at(literal_map({"OBJ": "o", "ARR": "l"}), F.substring(F.schema_of_variant(e), 1, 3)), F.lit("s")),
    )
    code = F.array_join(F.array_sort(F.array_distinct(kinds)), "")
    shapes = {"o": "object_list", "s": "scalar_list", "": "list", "l": "list", "lo": "list", "ls": "list", "los": "list", "os": "list"}
    as_list = F.coalesce(F.try_element_at(literal_map(shapes), code), F.lit("null"))
    as_other = F.coalesce(
        F.when(F.schema_of_variant(F.try_parse_json(c)) != "VOID", F.when(head == "{", F.lit("object")).otherwise(F.lit("scalar"))), F.lit("null"))
    return F.when(head == "[", as_list).otherwise(as_other)


def coalesce_keys(json_col, paths: Sequence[str]) -> Column:
    """First present JSON path among alternates, as text."""
    return F.coalesce(*[F.get_json_object(_col(json_col), p) for p in paths])


def safe_ratio(n, d) -> Column:
    """n / d, null when n is null or d is null or zero (B8). A tiny share stays a number."""
    return F.try_divide(_col(n), F.nullif(_col(d), F.lit(0)))


def pct(n, d) -> Column:
    return safe_ratio(n, d) * 100.0


# Demand-supply verdict cut points (pending value, stock in acres), inferred from
# published rows; they are parameters of ``supply_verdict``.
VERDICT_BACKLOG_HIGH = 50_000.0
VERDICT_READY_STOCK = 10_000.0
VERDICT_RICH_STOCK = 20_000.0


def supply_verdict(
    demand,
    stock,
    backlog_high: float = VERDICT_BACKLOG_HIGH,
    ready_stock: float = VERDICT_READY_STOCK,
    rich_stock: float = VERDICT_RICH_STOCK,
) -> Column:
    """Demand-supply verdict (H12): a large backlog is READY if the stock is enough, else
    CONSTRAINED; a large stock is LAND-RICH, or UNDER-UTILISED when the backlog is negative;
    everything else is 'balanced/low'."""
    d, s = _col(demand), _col(stock)
    return (
        F.when(d > backlog_high, F.when(s >= ready_stock, F.lit("READY")).otherwise(F.lit("CONSTRAINED")))
        .when(s > rich_stock, F.when(d < 0, F.lit("UNDER-UTILISED")).otherwise(F.lit("LAND-RICH")))
        .otherwise(F.lit("balanced/low"))
    )
