"""Generic JSON walk (J1, H16): any JSON text -> long table of nodes, or of table cells.

The walk is level by level with built-in JSON functions inside each row: an object is read as
``map<string,string>`` (keys keep their order, which a variant does not, and nested values stay JSON
text), an array likewise. Only the open containers of the last level are read again; the nodes done
stay as they are and are sorted by their positions at the end. No group is formed: the only shuffle
deals the documents out before the walk if the scan leaves them uneven (``session.spread``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import humanize
from ..functions.scalars import to_cell
from ..session import spread
from .filters import drop_reserved

RESERVED_KEYS = ("purpose", "retrieved", "method")
MARKER = "… (truncated)"
_NODE = "array<struct<pos_path:array<int>,path:string,depth:int,key:string,raw:string,kind:string>>"


def _node(pos_path, path, depth, key, raw, kind) -> Column:
    return F.struct(pos_path.alias("pos_path"), path.alias("path"), depth.alias("depth"), key.alias("key"), raw.alias("raw"), kind.alias("kind"))


def _kind(v: Column) -> Column:
    """Kind of a variant value; a missing one is null. A string is a scalar whatever it looks like."""
    s = F.schema_of_variant(v)
    return F.coalesce(F.when(s.startswith("OBJECT"), F.lit("object")).when(s.startswith("ARRAY"), F.lit("array")).when(s != "VOID", F.lit("scalar")), F.lit("null"))


def _bound(c: Column, use) -> Column:
    """``use(c)`` with ``c`` computed once, however often it is used, and neither it nor the result copied."""
    return F.aggregate(F.array(F.lit(0)), c, lambda a, _: a, use)


def _container(n: Column) -> Column:
    return (n["kind"] == "object") | (n["kind"] == "array")


def _nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _typed(raw: Column, found: Column, variants: Column, value, make) -> Column:
    """``make(x, i, kind)`` for each x of ``found``, the members or items of ``raw`` read as texts; ``value(x)`` is x's text.

    Text without a further bracket holds no container. Else a value's text tells a scalar or null from a
    container; of text that looks like a container (it may be a string that does) the variant tells. Null
    if there is such text and ``variants``, the same members or items as variants, cannot be read."""
    plain = lambda x: F.nvl2(value(x), F.lit("scalar"), F.lit("null"))
    scalars = F.transform(found, lambda x, i: make(x, i, plain(x)))
    mixed = lambda vs: F.transform(found, lambda x, i: make(x, i, F.when(_nested(value(x)), _kind(value(F.get(vs, i)))).otherwise(plain(x))))
    unread = F.when(~F.exists(found, lambda x: _nested(value(x))), scalars)
    return F.when((F.locate("{", raw, 2) == 0) & (F.locate("[", raw, 2) == 0), scalars).otherwise(_bound(variants, lambda vs: F.when(vs.isNotNull(), mixed(vs)).otherwise(unread)))


def _members(raw: Column, kind: str = "string") -> Column:
    return F.map_entries(F.from_json(raw, f"map<string,{kind}>"))


def _items(raw: Column, make) -> Column:
    """``make(item's text, i, kind)`` for each item of an array."""
    return _typed(raw, F.from_json(raw, "array<string>"), F.from_json(raw, "array<variant>"), lambda x: x, make)


def json_depth(c: Column) -> Column:
    """How deep a JSON text's containers are nested (strings do not count)."""
    marks = F.regexp_replace(c, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\[\]{}"]++|"', "")
    # a run of opening marks before each closing one: deepest where a run ends
    step = lambda a, run: F.struct((a["now"] + F.length(run) - 1).alias("now"), F.greatest(a["most"], a["now"] + F.length(run)).alias("most"))
    return F.coalesce(F.aggregate(F.split(marks, r"[\]}]"), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda a: a["most"]), F.lit(0))


def _walked(df: DataFrame, id_col: str, json_col: str, max_depth: int | None, reserved: tuple[str, ...]) -> DataFrame:
    """(id, nodes) with all nodes of each document level by level, the root first; their positions sort in pre-order.

    Each row carries its nodes; a level reads the open containers of the last one only and adds their
    children. A row takes as many levels as its own depth, which is found once."""
    raw = F.col(json_col)
    kind = F.when(F.ltrim(raw).startswith("{"), F.lit("object")).when(F.ltrim(raw).startswith("["), F.lit("array")).otherwise(F.lit("scalar"))
    root = F.array(_node(F.array().cast("array<int>"), F.lit("$"), F.lit(0), F.lit(None).cast("string"), raw, kind)).cast(_NODE)

    def children(n, level):
        def members(kind):
            found = _members(n["raw"], kind)
            return F.when(level == 0, drop_reserved(found, reserved)).otherwise(found) if reserved else found

        def child(i, path, key, text, kind):
            return _node(F.array_append(n["pos_path"], i), F.concat(n["path"], *path), level + 1, key, text, kind)

        member = lambda e, i, kind: child(i, (F.lit("."), e["key"]), e["key"], e["value"], kind)
        item = lambda x, i, kind: child(i, (F.lit("["), i.cast("string"), F.lit("]")), F.lit(None).cast("string"), x, kind)
        return F.when(F.ltrim(n["raw"]).startswith("{"), _typed(n["raw"], members("string"), members("variant"), lambda e: e["value"], member)).otherwise(_items(n["raw"], item))

    def step(nodes, level):
        # text that is no JSON has no children
        kids = F.transform(F.filter(nodes, lambda n: (n["depth"] == level) & _container(n)), lambda n: F.coalesce(children(n, level), F.array().cast(_NODE)))
        return F.concat(nodes, F.flatten(kids))

    df = spread(df.select(id_col, json_col))
    depth = json_depth(raw) if max_depth is None else F.least(json_depth(raw), F.lit(max_depth))
    # bound: a lambda's body is computed for each element
    levels = _bound(depth, lambda d: F.filter(F.sequence(F.lit(0), d), lambda x: x < d))
    return df.select(F.col(id_col).alias("id"), F.aggregate(levels, root, step).alias("nodes"))


def json_tree(
    df: DataFrame,
    id_col: str,
    json_col: str,
    max_depth: int | None = None,
    max_chars: int | None = None,
    reserved: tuple[str, ...] = RESERVED_KEYS,
    item_chars: int = 220,
) -> DataFrame:
    """Nodes of each JSON document in walk order.

    Columns: id, pos_path (array<int>, sorts in pre-order), path, depth, key, kind, text.
    ``text`` is 'Key: value' for a scalar under an object, 'Key' for a container, the value for
    an array element, cut to ``item_chars``. The walk goes as deep as each document or to ``max_depth``. With ``max_chars`` it stops once the running text
    length of a document has reached the budget; a document cut that way ends with a node of kind
    'marker'. Top-level keys in ``reserved`` (document metadata) are not walked at all (B10).
    """

    def with_text(n):
        value = F.when(~_container(n) | n["key"].isNull(), F.coalesce(n["raw"], F.lit("null")))
        text = F.concat_ws(": ", humanize(n["key"]), value)
        return F.struct(n["pos_path"].alias("pos_path"), n["path"].alias("path"), n["depth"].alias("depth"), n["key"].alias("key"), n["kind"].alias("kind"), _bound(text, lambda t: to_cell(t, item_chars)).alias("text"))

    cur = _walked(df, id_col, json_col, max_depth, reserved)
    cur = cur.select("id", F.transform(F.sort_array(F.filter("nodes", lambda n: n["depth"] > 0)), with_text).alias("nodes"))
    if max_chars is not None:
        count = F.aggregate(
            "nodes",
            F.struct(F.lit(0).cast("long").alias("s"), F.lit(0).alias("k")),
            lambda acc, n: F.struct((acc["s"] + F.char_length(n["text"])).alias("s"), (acc["k"] + F.when(acc["s"] < max_chars, 1).otherwise(0)).alias("k")),
        )
        cur = cur.select("id", "nodes", count.alias("c"))
        marker = F.array(F.struct(F.array(F.lit(2147483647)).alias("pos_path"), F.lit("$").alias("path"), F.lit(1).alias("depth"), F.lit(None).cast("string").alias("key"), F.lit("marker").alias("kind"), F.lit(MARKER).alias("text")))
        kept = F.slice("nodes", F.lit(1), F.col("c.k"))
        cur = cur.select("id", F.when(F.col("c.s") >= max_chars, F.concat(kept, marker)).otherwise(F.col("nodes")).alias("nodes"))
    # outer: a plain inline would push a filter on the array's size below, walking every document twice
    return cur.select("id", F.inline_outer("nodes")).where("path IS NOT NULL")


def json_tables(df: DataFrame, id_col: str, json_col: str, cell_chars: int = 280, reserved: tuple[str, ...] = RESERVED_KEYS) -> DataFrame:
    """Every list of objects as a table (H16): id, path, row_no, col_no, column, cell.

    The columns are the union of the objects' keys in first-seen order, with humanized names; a key
    that an object lacks gives an empty cell; a nested value gives its JSON text, cut."""
    arrays = F.filter("nodes", lambda n: (n["kind"] == "array") & n["raw"].rlike(r"^\s*\[\s*\{"))  # others do not begin with an object
    item = lambda x, i, kind: F.struct(x.alias("raw"), kind.alias("kind"))
    found = F.transform(arrays, lambda n: F.struct(n["path"].alias("path"), _items(n["raw"], item).alias("items")))
    lists = F.filter(found, lambda t: (F.size(t["items"]) > 0) & F.forall(t["items"], lambda e: e["kind"] == "object"))
    # a table in its row: the objects' members and the columns in first-seen order
    members = lambda e: _members(e["raw"])
    tables = _walked(df, id_col, json_col, None, reserved).select("id", F.explode_outer(F.transform(lists, lambda t: F.struct(t["path"].alias("path"), F.transform(t["items"], members).alias("objects")))).alias("t")).where("t IS NOT NULL")
    tables = tables.select("id", "t.path", "t.objects", F.array_distinct(F.flatten(F.transform("t.objects", lambda o: F.transform(o, lambda m: m["key"])))).alias("columns"))
    rows = tables.select("id", "path", "columns", F.posexplode_outer("objects").alias("row_no", "object"))
    cells = rows.select("id", "path", "row_no", "object", F.posexplode_outer("columns").alias("col_no", "key")).where("col_no IS NOT NULL")
    value = F.try_element_at(F.filter("object", lambda m: m["key"] == F.col("key")), F.lit(-1))["value"]  # of a repeated key the last value
    return cells.select("id", "path", "row_no", "col_no", humanize(F.col("key")).alias("column"), to_cell(value, cell_chars).alias("cell"))
