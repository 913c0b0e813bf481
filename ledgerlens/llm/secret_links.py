"""Secret scan with multipart credential linking (DataFrame functions only).

Strong parts are reported wherever they stand: assignments of passwords and tokens, access
identifiers, long hexadecimal runs. Weak parts (short or unnamed secrets, user names and client
identifiers, endpoints) are candidates: an interval join on the document and on scope-wide bins of
positions finds the parts of other roles whose scope overlaps theirs, and a weak part is reported
only with its complement: a secret with an identifier or an endpoint, an identifier with a secret,
an endpoint with both. Parts of one kind do not overlap, so a bin holds at most a few hundred and
the join stays proportional to the parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize

from ._spans import finding, located, same_rows, text_hash

SCOPE = 240  # characters between parts of one credential at most

# kind: (pattern, role, strong, least length, group whose length counts)
KINDS = {
    "assign": ("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", "secret", True, 8, 2),
    # matches shorter than the least length are dropped; where all starts inside a run of the same
    # characters fail with it, the pattern says the length itself: same matches, fewer of them to drop
    "access": ("AKIA[A-Z0-9]{12,}", "id", True, 16, 0),
    "hex": ("[0-9a-f]{32,}", "secret", True, 32, 0),
    "weak_secret": ("(?i)(?<![a-z0-9])(?:pwd|pass|passphrase|password|passwd|auth|bearer|signature|private_?key|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]{4,}"
                    "|(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])", "secret", False, 1, 0),
    "weak_id": ("(?i)(?<![a-z0-9])(?:user|username|login|account|client_?id|access_?key_?id|tenant)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9@._-]{3,}"
                "|(?<![A-Za-z0-9])ASIA[A-Z0-9]{12,}", "id", False, 1, 0),
    "endpoint": ("(?i)(?<![a-z0-9])(?:https?|s3|ftp|jdbc:[a-z]{2,20}|mongodb|redis|amqp|postgres|mysql)://[^\\s\"'<>]{3,}"
                 "|(?<![0-9.])[0-9]{1,3}(?:\\.[0-9]{1,3}){3}(?::[0-9]{2,5})?(?![0-9.])", "endpoint", False, 1, 0),
}
_NAMED = ("(?i)(?:password|passwd|secret|token|api_?key|pwd|pass|passphrase|auth|bearer|signature|private_?key|user|username|login|account|client_?id|access_?key_?id|tenant)"
          "[\"']?\\x20*[:=]")
_RUN = "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32}"


def _gate(text: Column) -> Column:
    """Whether a text can hold a strong part, or a weak identifier or secret (an endpoint alone is never reported).

    The cheap tests come first: a regex with many alternatives only sees texts with a colon or an equals sign."""
    has = lambda x: F.contains(text, F.lit(x))
    return has("AKIA") | has("ASIA") | ((has(":") | has("=")) & text.rlike(_NAMED)) | text.rlike(_RUN)


def secret_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, text_hash, kind, start, end) of each reported part, once for equal rows."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), text.alias("t")).where(_gate(F.col("t"))).dropDuplicates(["id", "h"])
    keys = ["id", "h"]
    found = rows.select(*keys, F.explode(F.array(*(finding(F.lit(k), F.col("t"), F.lit(p), g) for k, (p, _, _, _, g) in KINDS.items()))).alias("f"))
    spans = located(found, keys, "f")
    fact = lambda i: F.coalesce(*(F.when(F.col("kind") == k, F.lit(v[i])) for k, v in KINDS.items()))
    parts = materialize(spans.withColumn("role", fact(1)).withColumn("strong", fact(2)).where(F.length("value") >= fact(3)).drop("value"))
    bins = parts.withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor(F.col("end") / scope))))
    strong, weak = bins.where("strong"), bins.where("NOT strong")
    # a weak part inside a strong one of its role is that strong part; of another role it stands beside it
    inner = strong.select(*(F.col(k).alias(f"s_{k}") for k in keys), F.col("bin").alias("s_bin"), F.col("role").alias("s_role"), F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    on = same_rows(keys + ["bin"], ["s_id", "s_h", "s_bin"])
    weak = weak.join(inner, on & (F.col("role") == F.col("s_role")) & (F.col("s_start") <= F.col("start")) & (F.col("end") <= F.col("s_end")), "left_anti")
    others = bins.select(*(F.col(k).alias(f"o_{k}") for k in keys), F.col("bin").alias("o_bin"), F.col("role").alias("o_role"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    near = (F.col("role") != F.col("o_role")) & (F.col("o_start") - F.col("end") <= scope) & (F.col("start") - F.col("o_end") <= scope)
    met = weak.join(others, same_rows(keys + ["bin"], ["o_id", "o_h", "o_bin"]) & near).groupBy(*keys, "kind", "start", "end", "role").agg(
        F.bool_or(F.col("o_role") == "id").alias("ids"), F.bool_or(F.col("o_role") == "secret").alias("secrets"))
    linked = met.where((F.col("role") == "secret") | ((F.col("role") == "id") & F.col("secrets")) | ((F.col("role") == "endpoint") & F.col("ids") & F.col("secrets")))
    return parts.where("strong").select(*keys, "kind", "start", "end").unionByName(linked.select(*keys, "kind", "start", "end"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_spans, spans) for each row of ``docs``.

    Spans are ``kind:start:end`` in code points, by start and then kind, comma-joined. A null or empty
    text has none. Very long texts are searched whole, their parts joined by bins of the scope. Repeated
    rows get the same spans each; ids may repeat or be null. Other columns are not read. No rows give
    an empty table.
    """
    order = list(KINDS)
    parts = secret_parts(docs, id_col, text_col, scope)
    span = F.struct("start", F.coalesce(*(F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(order))).alias("k"), F.concat_ws(":", "kind", "start", "end").alias("s"))
    count = lambda k: F.count_if(F.col("kind") == k)
    by_row = parts.groupBy("id", "h").agg(*(count(k).alias(f"n_{k}") for k in order[:3]), F.sort_array(F.collect_list(span)).alias("all"))
    joined = lambda a: F.array_join(F.transform(a, lambda x: x["s"]), ",")
    by_row = by_row.select("id", "h", *(f"n_{k}" for k in order[:3]), joined(F.filter("all", lambda x: x["k"] < 3)).alias("base"), joined(F.col("all")).alias("spans"))
    rows = docs.select(F.col(id_col).alias("d_id"), text_hash(F.col(text_col)).alias("d_h"))
    return rows.join(by_row, same_rows(["d_id", "d_h"], ["id", "h"]), "left").select(
        F.col("d_id").alias(id_col), *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in order[:3]),
        F.coalesce("base", F.lit("")).alias("base_spans"), F.coalesce("spans", F.lit("")).alias("spans"))
