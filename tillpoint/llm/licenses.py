r"""License scan by ordered signature rules.

1. A gate expression every rule implies picks the texts that can hold a signature; only these are
   brought to words (lower case, one blank between).
2. Keyword prefilter: a rule is tried on a text, once, only if the text holds one of the
   rule's keywords.  The keywords held give the rules' numbers, and texts meet the rules by an
   equi-join on the number; the rules are a fixed list.
3. Matches are marked in the text, whose words then give the word intervals of the detections.
4. A detection is suppressed if an interval of a class with higher priority contains it, or one
   of its own class that is longer or, for the same interval, comes earlier in the list.  The sweep
   is a running maximum of interval ends along a document, one for each class.

The base phrases form the first class, so nothing suppresses them.

Edge cases: a null text is an empty one; rows that share an id are scanned each on its own; documents
without a signature have null positions, empty labels and score 0; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillpoint.llm.common import doc_text
from tillpoint.llm.license_rules import CLASSES, rules
from tillpoint.operators.persist import materialize

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # capitals are letters before they are lowered
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Every rule holds one of these, in some spelling.
GATE = (rf"(?i)licen[sc]e|gpl|spdx|wtfpl|cddl|cecill|beerware|cc(?:0|{GAP}by)|copyleft|permission"
        rf"|redistribut|reserved|creative{GAP}commons|public{GAP}domain|terms{GAP}as{GAP}perl"
        rf"|bsd{GAP}[234]{GAP}clause|zero{GAP}clause|proprietary|commercial|research{GAP}|eupl"
        rf"|mulan|open{GAP}source{GAP}agreement|unauthorized|waived|as{GAP}is{GAP}without"
        rf"|advertising{GAP}materials|altered{GAP}source|the{GAP}fuck|mozilla{GAP}org"
        rf"|eclipse{GAP}org|opendatacommons|sil{GAP}org|creativecommons"
        rf"|(?:released|distributed|available){GAP}under"
        rf"|(?:mpl|epl|gfdl|sspl|busl|odbl|pddl|lppl)(?:{GAP})?(?:v(?:er(?:sion)?)?)?(?:{GAP})?[0-9]")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def detections(words: DataFrame) -> DataFrame:
    """(rid, label, kind, rule, start, end) of all matches in ``words(rid, norm)``.

    ``norm``: the words with one blank between and around.  Word intervals, end exclusive.
    """
    spark = words.sparkSession
    known = rules()
    listed = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(k).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.kind).alias("kind"),
        F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("p"))
        for k, r in enumerate(known)])))
    by_keyword = {}
    for k, r in enumerate(known):
        for word in r.keywords:
            by_keyword.setdefault(f" {word} " if word[-1] != "*" else f" {word[:-1]}", []).append(k)
    keywords = F.array(*map(F.lit, sorted(by_keyword)))
    numbers = F.create_map(*[x for word, ks in by_keyword.items()
                             for x in (F.lit(word), F.array(*map(F.lit, ks)))])
    held = F.filter(keywords, lambda k: F.contains(F.col("norm"), k))
    named = words.select("rid", "norm", F.explode(F.array_distinct(F.flatten(
        F.transform(held, lambda k: F.element_at(numbers, k))))).alias("rule"))
    tried = (named.join(F.broadcast(listed), "rule")  # a few hundred rules, a constant
             .filter(F.expr("norm rlike p"))
             .withColumn("marked", F.split(F.trim(F.expr(
                 r"regexp_replace(norm, p, '\u0001$0\u0002')")), " ")))

    def at(mark: str, begin: bool):
        test = (lambda w: w.startswith(mark)) if begin else (lambda w: w.endswith(mark))
        return F.filter(F.transform("marked", lambda w, i: F.when(test(w), i)),
                        lambda i: i.isNotNull())

    return (tried.select("rid", "label", "kind", "rule", F.explode(F.arrays_zip(
        at("\x01", True).alias("first"), at("\x02", False).alias("last"))).alias("at"))
        .select("rid", "label", "kind", "rule", F.col("at.first").cast("long").alias("start"),
                (F.col("at.last") + 1).cast("long").alias("end")))


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections that no interval of higher standing contains."""
    level = F.element_at(F.create_map(*[x for k, (p, _) in CLASSES.items()
                                        for x in (F.lit(k), F.lit(p))]), F.col("kind"))
    found = found.withColumn("level", level)
    along = Window.partitionBy("rid").orderBy("start")
    upto = along.rangeBetween(Window.unboundedPreceding, 0)
    before = (Window.partitionBy("rid", "level").orderBy("start", F.desc("end"), "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    for p in sorted({p for p, _ in CLASSES.values()})[:-1]:
        found = found.withColumn(f"end_{p}", F.max(F.when(F.col("level") == p, F.col("end")))
                                 .over(upto))
    inside = F.coalesce(F.max("end").over(before) >= F.col("end"), F.lit(False))
    for p in sorted({p for p, _ in CLASSES.values()})[:-1]:
        inside = inside | F.coalesce((F.col("level") > p) & (F.col(f"end_{p}") >= F.col("end")),
                                     F.lit(False))
    return (found.withColumn("inside", inside).filter(~F.col("inside") | (F.col("kind") == "base"))
            .select("rid", "label", "kind", "rule", "start", "end"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, n_found."""
    text = F.col("text")
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, " ")),
                    F.lit(" "))
    rows = materialize(
        doc_text(docs).select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
                              F.when(text.rlike(GATE), norm).alias("norm"))
        .withColumn("rid", F.monotonically_increasing_id()), "license-rows")
    found = materialize(detections(rows.filter("norm is not null").select("rid", "norm")),
                        "license-found")
    base = F.col("kind") == "base"
    sure = F.element_at(F.create_map(*[x for k, (_, c) in CLASSES.items()
                                       for x in (F.lit(k), F.lit(c))]), F.col("kind"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_row = unsuppressed(found).groupBy("rid").agg(
        F.sum(base.cast("long")).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        listed(F.when(base, F.col("label"))).alias("base_labels"), listed("label").alias("labels"),
        F.max(sure).alias("score"), F.count(F.lit(1)).alias("n_found"))
    empty = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return rows.select("rid", "doc_id", "n_words").join(by_row, "rid", "left").select(
        "doc_id", "n_words", empty("n_base", 0), "first_word", "last_word", empty("base_labels", ""),
        empty("labels", ""), empty("score", 0.0), empty("n_found", 0))
