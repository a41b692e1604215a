"""Texts that were cut off before their end.

Near-copies are found by min-hash bands over prefixes and aligned; a copy whose alignment ends early was cut. The other
texts are scored by how they close: whether the closing word is one that ends sentences in this corpus (terminality),
whether texts that close in such a shape are usually whole, whether a bracket, quotation or markup is left open, whether
the length is one at which the source's unfinished texts pile up, and whether the translation beside it is closed. All
texts are looked at as a whole, and all statistics are counted over all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusloom.llm.endings import BY_KIND, BY_MARK, CAPITAL, END_COLUMNS, USE_COLUMNS, end_measures
from locusloom.llm.nearcopies import cut_copies
from locusloom.session import saved

#: Below this share of sentence-final uses a word does not end a text; above the second, it is usual at an end.
NEVER_FINAL, OFTEN_FINAL = 0.001, 0.02
#: A source leaves closing marks out if at least this share of its texts ends without one at a likely end.
MESSAGE_SHARE = 0.1
#: Of well-paired texts that close in a shape, at most such a share has a closed translation if the shape is that of a
#: whole text; beside a translation that closes in such a shape itself, the second share does. Below the third share a
#: closed translation speaks for a cut only if it is surely the text's own.
HEADING, HEADING_BESIDE, HEADING_SURE = 0.2, 0.5, 0.1
#: A source leaves closing marks out if at least this share of its texts ends without one at a likely end.
MESSAGE_SHARE = 0.1
#: Of well-paired texts that close in a shape, at most such a share has a closed translation if the shape is that of a
#: whole text; beside a translation that closes in such a shape itself, the second share does.
HEADING, HEADING_BESIDE = 0.25, 0.5
#: Least align_score with which a pair's other side counts as its translation.
ALIGNED, WELL_ALIGNED = 0.6, 0.8
#: A field limit: so many different unfinished texts of one size at least, such a share of the source's texts, and so
#: many times the usual number at the sizes around it; such a share of them must end with a word that ends no text.
PILE, PILE_SHARE, EXCESS, AROUND, PILE_RARE = 5, 0.02, 8, 15, 0.3
#: A limit of texts shortened with an ellipsis: the least share of it they have, the different texts there at least,
#: and the share of them that has ``SHORTENED_TOP`` of it.
SHORTENED, SHORTENED_LEAST, SHORTENED_TOP, SHORTENED_SHARE = 0.95, 3, 0.98, 0.2


def _headings(unclosed: DataFrame) -> DataFrame:
    """``shape`` and ``beside_closed``: of unclosed texts with a well-paired translation, the share whose translation is closed.

    The translation of a cut text is closed as a rule, that of headings and other texts that are whole without a mark
    hardly ever. One pair of each kind is added to the counts, so that few pairs show nothing.
    """
    paired = unclosed.where((F.col("fit") >= ALIGNED) & F.col("other_closed").isNotNull() & ~F.col("elliptic") & ~F.col("left_open"))
    return paired.groupBy("shape").agg(((F.count_if("other_closed") + 1) / (F.count(F.lit(1)) + 2)).alias("beside_closed"))


def _field_limits(ends: DataFrame, texts: DataFrame, size: str, name: str) -> DataFrame:
    """Sizes at which a source's unfinished texts pile up, as a list per source; copies count once."""
    near = Window.partitionBy("src").orderBy(F.col(size)).rangeBetween(-AROUND, AROUND)
    once = ends.where("not heading").groupBy("src", size, "key").agg(F.min("terminality").alias("terminality"))
    counted = once.groupBy("src", size).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("terminality") < NEVER_FINAL).alias("rare"))
    others = (F.sum("n").over(near) - F.col("n")) / (2 * AROUND)
    piles = counted.withColumn("others", others).join(texts, "src")
    enough = (F.col("n") >= F.greatest(F.lit(PILE), F.lit(PILE_SHARE) * F.col("texts"))) & (F.col("n") >= EXCESS * F.col("others"))
    piles = piles.where(enough & (F.col("rare") >= PILE_RARE * F.col("n")))
    return piles.groupBy("src").agg(F.collect_list(size).alias(name))


def _elliptic_limits(elliptic: DataFrame) -> DataFrame:
    """Limits to which a source shortens texts with an ellipsis, as a list per source; copies count once.

    A text is shortened at the limit or a word before it, so a limit is a size down to ``SHORTENED`` of which many more
    texts lie than in the bands of that width below and above it, some of them right below the size itself. They must
    also be many more than the source's other texts with an ellipsis would leave there, unless they are many by
    themselves. Other limits and texts longer or shorter do not matter.
    """
    sizes = elliptic.groupBy("src", "chars").agg(F.count_distinct("key").alias("n")).withColumn("lg", F.ln("chars"))
    width, top = -math.log(SHORTENED) + 1e-9, -math.log(SHORTENED_TOP) + 1e-9
    within = lambda below, above: F.expr(f"sum(n) over (partition by src order by lg range between {below!r}D preceding and {above!r}D following)")
    bands = sizes.withColumns({"here": within(width, 0.0), "below": within(2 * width, 0.0), "above": within(0.0, width), "close": within(top, 0.0), "every": F.expr("sum(n) over (partition by src)")})
    sides = (F.col("below") - F.col("here") + F.col("above") - F.col("n")) / 2
    usual = (1 - SHORTENED) * (F.col("every") - F.col("here"))
    enough = (F.col("here") >= SHORTENED_LEAST) & (F.col("here") >= EXCESS * sides) & ((F.col("here") >= EXCESS * usual) | (F.col("here") >= EXCESS))
    return bands.where(enough & (F.col("close") >= SHORTENED_SHARE * F.col("here"))).groupBy("src").agg(F.collect_list("chars").alias("shortened"))


def _at(limits: str, size: str, below: int, above: int) -> Column:
    return F.coalesce(F.exists(F.col(limits), lambda x: F.col(size).between(x - below, x + above)), F.lit(False))


def truncated_texts(
    docs: DataFrame, doc_id: str, text: str, source: str, other: str | None = None, other_score: str | None = None
) -> DataFrame:
    """``doc_id``, ``source``, ``is_cut``, ``evidence`` and ``terminality`` of every row with a text.

    ``evidence`` names what decided: ``copy``, ``left_open``, ``limit``, ``closing_word``, ``translation`` or
    ``unclosed`` for texts that were cut, else null. ``other`` is the translation of the text, if there is one, and
    ``other_score`` how well both fit. Null, empty and blank texts, and texts of symbols alone, give no row. A text that
    ends behind a complete sentence is never cut, nor is a heading that is whole without a mark. A null source is a
    source of its own. Exact copies share one search for near-copies. Other columns of ``docs`` do not matter.

    The measures of the text ends, without the texts, those of the unclosed ones and the distinct texts are written to
    the shared checkpoint folder, as several steps read them.
    """
    blank = F.lit(None).cast("string")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"),
        (F.col(other) if other else blank).alias("other"), (F.col(other_score) if other_score else F.lit(None)).cast("double").alias("fit"),
    )
    asked = rows.select("doc_id", "source", F.unhex(F.md5("text")).alias("key"), F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), "fit", "text", "other")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema[:-2])
    measured = ", ".join(f"{n} {t}" for n, t in (END_COLUMNS | USE_COLUMNS).items())
    measures = saved(asked.mapInArrow(end_measures, f"{kept}, {measured}").where("has_end or used_word is not null"), "text-ends")
    ends = measures.where("has_end").drop(*USE_COLUMNS).withColumn("src", F.coalesce("source", F.lit("")))

    # how often each closing word ends a sentence in the corpus, on either side
    uses = measures.where("used_word is not null").groupBy(F.col("used_word").alias("word")).agg(F.sum("used_ends").alias("ends"), F.sum("used_goes_on").alias("goes_on"))
    terminal = uses.select("word", F.try_divide(F.col("ends"), F.col("ends") + F.col("goes_on")).alias("terminality"))
    unclosed = ends.where("not closed")
    words = terminal.join(unclosed.select("word").distinct(), "word", "left_semi")
    shapes = _headings(unclosed)
    beside = shapes.where(F.col("beside_closed") <= HEADING).select(F.col("shape").alias("other_shape"), F.lit(True).alias("other_heading"))
    alike = F.coalesce(F.col("other_heading") & ~F.col("other_closed"), F.lit(False))
    capital = F.floor(F.col("shape") / BY_KIND) % (BY_MARK // BY_KIND) == CAPITAL
    heading = (F.col("beside_closed") <= HEADING) | (alike & ((F.col("beside_closed") <= HEADING_BESIDE) | capital))
    scored = saved(
        unclosed.join(words, "word", "left").join(shapes, "shape", "left").join(beside, "other_shape", "left")
        .withColumns({"terminality": F.coalesce("terminality", F.lit(0.0)), "heading": F.coalesce(heading, F.lit(False))}),
        "unclosed-texts",
    )

    # what each source does at the end of its texts
    habits = ends.groupBy("src").agg(F.count(F.lit(1)).alias("texts"))
    likely_end = ~F.col("elliptic") & ~F.col("left_open") & ~F.col("heading") & (F.col("terminality") >= OFTEN_FINAL)
    leaves_out = scored.where(likely_end & ~F.coalesce("other_marked", F.lit(False))).groupBy("src").agg(F.count(F.lit(1)).alias("unmarked"))
    shortened = _elliptic_limits(ends.where("elliptic"))
    char_limits = _field_limits(scored, habits, "chars", "char_limits")
    unexplained = scored.join(char_limits, "src", "left").where(~_at("char_limits", "chars", 0, 0))
    byte_limits = _field_limits(unexplained, habits, "bytes", "byte_limits")
    sources = (
        habits.join(leaves_out, "src", "left")
        .join(shortened, "src", "left")
        .join(char_limits, "src", "left")
        .join(byte_limits, "src", "left")
        .select(
            "src", (F.coalesce("unmarked", F.lit(0)) / (F.col("texts") + 10) >= MESSAGE_SHARE).alias("messages"),
            "shortened", "char_limits", "byte_limits",
        )
    )

    texts = saved(rows.where("text is not null").select(F.unhex(F.md5("text")).alias("key"), "text").distinct(), "texts")
    copies = cut_copies(texts).withColumn("copy", F.lit(True))

    limit = _at("char_limits", "chars", 0, 0) | _at("byte_limits", "bytes", 3, 2)
    translated = F.coalesce(F.col("other_marked") & (F.col("fit") >= ALIGNED), F.lit(False))
    surely = F.coalesce(F.col("other_closed") & (F.col("fit") >= WELL_ALIGNED), F.lit(False))
    paired = F.coalesce(F.col("other_closed") & (F.col("fit") >= (ALIGNED + WELL_ALIGNED) / 2), F.lit(False))
    rare = F.col("terminality") < NEVER_FINAL
    evidence = (
        F.when(F.col("copy"), "copy")
        .when(F.col("elliptic") & F.coalesce(F.exists("shortened", lambda x: F.col("chars").between(SHORTENED * x, x)), F.lit(False)), "limit")
        .when(F.col("elliptic"), F.when(rare & ~F.coalesce("other_elliptic", F.lit(False)), "closing_word"))
        .when(F.col("left_open"), "left_open")
        .when(limit, "limit")
        .when(F.col("heading"), F.when(surely | (paired & (F.col("beside_closed") > HEADING_SURE)), "translation"))
        .when(rare, "closing_word")
        .when(F.col("messages"), F.when(translated, "translation"))
        .otherwise("unclosed")
    )
    judged = scored.join(copies, "key", "left").join(sources, "src", "left").select("doc_id", "source", evidence.alias("evidence"), "terminality")
    none = ends.where("closed").select("doc_id", "source", F.lit(None).cast("string").alias("evidence"), F.lit(None).cast("double").alias("terminality"))
    return judged.unionByName(none).select("doc_id", "source", F.col("evidence").isNotNull().alias("is_cut"), "evidence", "terminality")
