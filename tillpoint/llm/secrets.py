r"""Secret scan with multipart credential linking.

Strong parts are reported wherever they stand: assigned secrets, access identifiers and long hex runs
(the base kinds).  Weak parts prove nothing alone: an endpoint (``https://host...`` or host:port), a
short assigned value, a bare token of mixed characters, all of any length.  A weak part is reported only if
complementary parts stand in its scope, i.e. within ``scope`` code points of it:

* a bare token or short value needs an access identifier or an endpoint;
* an endpoint needs an access identifier, an assigned secret, or a short value.

A bare token is a run of 20 or more characters, of any length, that holds digits, small letters and
capitals.  It may stand right behind an equals sign (``aws_secret_access_key=...``); a run right
before one with a value behind is a name, no token.

The link is an interval join: a weak part is filed under all cells of ``scope`` code points that it
touches, any part under all cells that its scope touches; the two sides meet on (document, cell) and
are compared by distance.  Parts of one kind do not overlap and have a least length, so a cell holds a bounded number of
them, however long the document; no join key is hot.

Positions come from column expressions alone: the text is split around the matches of a kind, and a
running sum of piece and match lengths gives their places, in time linear in their number.

Edge cases: a null text is an empty one; rows that share an id are scanned each on its own; a part that
a base span covers is not reported again; documents without a part have zero counts and empty lists;
an empty table gives no row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import doc_text
from tillpoint.operators.persist import materialize


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_any_case, ("password", "passwd", "secret", "token")),
                   f"{_any_case('api')}_?{_any_case('key')}"])
_VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?({_VALUE}+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
# The method's own kinds.
ENDPOINT = (r"(?:https?|wss?|ftp|jdbc:[a-z]+|s3|redis|mongodb|postgres(?:ql)?|mysql|amqp)://"
            r"[A-Za-z0-9_@:.-]{4,}"
            r"|(?<![A-Za-z0-9.-])(?![a-z0-9.-]*\.\.)[a-z0-9-][a-z0-9.-]*\.[a-z0-9-]+:[0-9]{2,5}(?![0-9])")
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])"
_MIXED = ("[0-9]", "[a-z]", "[A-Z]")  # what a run must hold to be a token
KINDS = ("assign", "access", "hex", "endpoint", "short", "token")  # as listed in spans
BASE = ("assign", "access", "hex")
PATTERNS = {"assign": (ASSIGN, 2), "access": (ACCESS, 0), "hex": (HEX, 0),
            "endpoint": (ENDPOINT, 0), "token": (TOKEN, 0)}
_GATES = {  # a cheap necessary condition for each expression
    "assign": f"(?:{_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?{_VALUE}",
    "access": ACCESS, "hex": HEX, "endpoint": r"://[A-Za-z0-9_@:.-]|[a-z0-9]:[0-9][0-9]",
    "token": "[A-Za-z0-9+/_-]{20}"}


def _matches(text: Column, pattern: str, group: int, holds: tuple[str, ...] = ()) -> Column:
    """Array of (gap, size, inner): text before a match, its length, that of ``group``.

    ``inner`` is null if ``group`` lacks one of ``holds``.  The last entry is the text behind the
    last match and has neither size nor inner.
    """
    def lengths(a, name, holds=()):
        def size(m):
            length = F.length(m).cast("long")
            return F.when(reduce(and_, [m.rlike(h) for h in holds]), length) if holds else length

        return F.transform(a, size).alias(name)

    return F.arrays_zip(
        lengths(F.split(text, pattern, -1), "gap"),
        lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "size"),
        lengths(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), "inner", holds))


def parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rid, doc_id) of every row, and its parts: rid, kind, start, end, inner."""
    text = F.col("text")
    scanned = doc_text(docs)
    for kind, (pattern, group) in PATTERNS.items():
        scanned = scanned.withColumn(kind, F.when(text.rlike(_GATES[kind]),
                                                  _matches(text, pattern, group,
                                                           _MIXED if kind == "token" else ())))
    rows = materialize(scanned.withColumn("rid", F.monotonically_increasing_id()).drop("text"),
                       "secret-rows")
    each = (rows.filter(F.coalesce(*PATTERNS).isNotNull())
            .select("rid", F.explode(F.create_map(*[x for k in PATTERNS for x in (
                F.lit(k), F.col(k))])).alias("kind", "found"))
            .select("rid", "kind", F.posexplode("found").alias("i", "m"))
            .select("rid", "kind", "i", "m.gap", "m.size", "m.inner"))
    so_far = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(
        Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    placed = (each.withColumn("end", so_far).filter(F.col("inner").isNotNull())
              .select("rid", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "inner"))
    return rows.select("rid", "doc_id"), placed


def linked(weak: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """Interval join of weak parts with the parts around them: one row per weak part.

    Columns: rid, kind, start, end, near (distinct kinds within scope), covered.
    """
    w = weak.select("rid", "kind", "start", "end", F.explode(F.sequence(
        F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("cell"))
    o = others.select(
        F.col("rid").alias("o_rid"), F.col("kind").alias("o_kind"), F.col("start").alias("o_start"),
        F.col("end").alias("o_end"),
        F.explode(F.sequence(F.floor((F.col("start") - scope) / scope),
                             F.floor((F.col("end") + scope) / scope))).alias("o_cell"))
    gap = F.greatest(F.col("o_start") - F.col("end"), F.col("start") - F.col("o_end"))
    same = (F.col("o_kind") == F.col("kind")) & (F.col("o_start") == F.col("start"))
    met = w.join(o, (F.col("rid") == F.col("o_rid")) & (F.col("cell") == F.col("o_cell"))
                 & (gap <= scope) & ~same)
    covers = ((F.col("o_start") <= F.col("start")) & (F.col("o_end") >= F.col("end"))
              & F.col("o_kind").isin(*BASE))
    return met.groupBy("rid", "kind", "start", "end").agg(
        F.collect_set("o_kind").alias("near"), F.max(covers).alias("covered"))


def find_secrets(docs: DataFrame, min_value: int = 12, min_short: int = 6,
                 scope: int = 512) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    rows, found = parts(docs)
    found = materialize(
        found.withColumn("kind", F.when((F.col("kind") == "assign") & (F.col("inner") < min_value),
                                        "short").otherwise(F.col("kind")))
        .filter((F.col("kind") != "short") | (F.col("inner") >= min_short)).drop("inner"),
        "secret-parts")
    base = found.filter(F.col("kind").isin(*BASE))
    weak = found.filter(~F.col("kind").isin(*BASE))
    needs = F.when(F.col("kind") == "endpoint", F.array(*map(F.lit, ("access", "assign", "short")))
                   ).otherwise(F.array(*map(F.lit, ("access", "endpoint"))))
    strong = (linked(weak, found, scope).filter(~F.col("covered"))
              .filter(F.arrays_overlap("near", needs)).select("rid", "kind", "start", "end"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = base.unionByName(strong).select("rid", "kind", F.struct(
        "start", order.alias("order"), "end", "kind").alias("s"))
    count = lambda k: F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}")
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    by_row = (spans.groupBy("rid").agg(*[count(k) for k in BASE],
                                       F.sort_array(F.collect_list("s")).alias("all"))
              .select("rid", *[f"n_{k}" for k in BASE], joined("all").alias("spans"),
                      joined(F.filter("all", lambda s: s["kind"].isin(*BASE))).alias("base"),
                      F.size(F.filter("all", lambda s: ~s["kind"].isin(*BASE))).alias("n_linked")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.join(by_row, "rid", "left").select(
        "doc_id", *[zero(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_linked"))
