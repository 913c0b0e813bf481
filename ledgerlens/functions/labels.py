"""Label canonicalisation and label-derived text.

All functions return Column expressions: they run inside whole-stage codegen, no Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(m: Mapping[str, object]) -> Column:
    """A small, code-level lookup as a map literal (no join, no shuffle)."""
    if not m:
        return F.create_map().cast("map<string,string>")
    items = []
    for k, v in m.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# Unicode blanks too: a no-break space is a blank
BLANKS = r"(?U)\s+"


def collapse_blanks(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), BLANKS, " "))


def capital(w) -> Column:
    """First letter upper case, all others lower case (a blank inside starts no new word)."""
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2147483647)))


def title_words(c) -> Column:
    """Title case per blank-separated word; the word 'and' stays lower case."""
    words = F.split(c, " ")
    return F.array_join(
        F.transform(words, lambda w: F.when(F.lower(w) == "and", F.lit("and")).otherwise(capital(w))),
        " ",
    )


def canon_key(c) -> Column:
    """Trim, collapse blanks, strip dots at both ends, '&' -> 'and' (before alias lookup)."""
    k = collapse_blanks(c)
    k = F.regexp_replace(k, r"^\.+|\.+$", "")
    k = F.regexp_replace(k, r"(?U)\s*&\s*", " and ")
    return collapse_blanks(k)


def canon_label(c, aliases: Mapping[str, str] | None = None) -> Column:
    """Canonical place/sector label (B1).

    ``aliases`` maps a lower-case spelling (after blank and '&' clean-up) to the canonical label;
    everything else is title-cased with a lower-case 'and'. Null stays null.
    """
    k = canon_key(c)
    titled = title_words(k)
    if aliases:
        return F.coalesce(F.try_element_at(literal_map(aliases), F.lower(k)), titled)
    return titled


def canon_label_by_table(df: DataFrame, c: str, aliases: DataFrame, out: str) -> DataFrame:
    """``canon_label`` with the aliases kept as a table (spelling, label) of any size (B1).

    Spellings are compared lower-case after the clean-up; of repeated ones the smallest label counts. The
    table is broadcast only after its rows and bytes are counted; without a match the label is title-cased."""
    from ..operators.joins import bounded

    table = aliases.groupBy(F.lower(canon_key("spelling")).alias("__spelling")).agg(F.min("label").alias("__label"))
    j = df.withColumn("__key", F.lower(canon_key(c))).join(bounded(table), F.col("__key") == F.col("__spelling"), "left")
    return j.withColumn(out, F.coalesce("__label", title_words(canon_key(c)))).drop("__key", "__spelling", "__label")


# Default acronym spellings used by ``humanize`` (lower-case word -> display form).
DEFAULT_ACRONYMS = {
    "fdi": "FDI", "pli": "PLI", "hs": "HS", "ibef": "IBEF", "icra": "ICRA",
    "gnep": "GNEP", "rbi": "RBI", "mclr": "MCLR", "eblr": "EBLR", "walr": "WALR",
    "usd": "USD", "cbam": "CBAM", "dpiit": "DPIIT", "pib": "PIB", "niti": "NITI",
    "aayog": "Aayog", "ceta": "CETA", "sez": "SEZ", "iem": "IEM", "sia": "SIA",
    "gdp": "GDP", "cpi": "CPI", "wpi": "WPI",
}


def humanize(c, acronyms: Mapping[str, str] | None = None) -> Column:
    """snake/kebab key -> title text (H1).

    '-' counts as '_'; every '_'-separated word is looked up in ``acronyms`` (lower case), else
    capitalised. Empty words are kept, so '__' gives two blanks, as a plain split-and-join does.
    """
    amap = literal_map(DEFAULT_ACRONYMS if acronyms is None else {k.lower(): v for k, v in acronyms.items()})
    words = F.split(F.replace(_col(c).cast("string"), F.lit("-"), F.lit("_")), "_")
    return F.array_join(
        F.transform(words, lambda w: F.coalesce(F.try_element_at(amap, F.lower(w)), capital(w))), " "
    )


def title_from_stem(c, acronyms: Mapping[str, str] | None = None) -> Column:
    """File stem -> title: '-' as '_', a trailing '_YYYY_MM_DD' date stamp dropped, then humanized (H2)."""
    stem = F.replace(_col(c).cast("string"), F.lit("-"), F.lit("_"))
    stem = F.regexp_replace(stem, r"_\d{4}_\d{2}_\d{2}$", "")
    return humanize(stem, acronyms)


def slug(c) -> Column:
    """Lower-case, non-alphanumerics to single '-', trimmed of '-' (H18)."""
    s = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-")
    return F.regexp_replace(s, "^-+|-+$", "")
