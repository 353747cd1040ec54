"""Line deduplication within one edit, by a deletion-neighbourhood join.

A line goes if an earlier line (by id, then line number; judged on the input) is equal or within one edit (a character
inserted, deleted or replaced).  Two such lines agree outside one segment, so the neighbourhood is needed only inside
segments whose surroundings another line shares:

1. distinct lines keep their first place; every line is cut at the segment bounds for its own length and for one less,
   and the hash of what lies outside a segment is its context; contexts that differing lines share (found exactly, by one narrow aggregate) become a bitmap;
2. lines with a shared context (few) are kept with their text; for each such segment they emit the hashed variants:
   the segment with each of its characters deleted, and the segment itself;
3. equal variants meet: a character deleted at the same place on both sides is a replacement, a deletion that equals
   another line's whole segment is an insertion.  Only the earliest line of each variant counts, so no pairs are
   listed.  The edit distance of each line and the earlier line it met is then verified on their texts.

Native DataFrame functions throughout.  The bitmap has a fixed size (see ``bitmap``); if it fills, more lines emit
variants, and the result is the same.  Lines without a word (blank ones) stay; all others take part from one character on.
A caller who wants to spare short lines sets ``min_chars`` (one-edit search) and ``equal_chars`` (equality).

Edge cases: null text has one empty line, as an empty text; a null id comes before all others; rows that are equal in id
and text count as one document and keep the same lines; rows of equal id and different texts are ordered by a hash;
extra columns pass through, and one named like a result column is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm import bitmap
from panelcast.llm.common import WORD, boxed, table
from panelcast.llm.registry import query
from panelcast.session import materialize

MIN_CHARS = 1
#: A line of n characters has max(2, sqrt(n) / SEGMENT_ROOT) segments: hashing what lies around them stays near linear.
SEGMENT_ROOT = 16
FILTER_BITS = 1 << 26
RESULT = ("n_lines", "n_removed", "kept_text")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _segments(lines: DataFrame) -> DataFrame:
    """``lines`` with a row per segment for the line's length and for one less as base: ``longer`` (0 or 1), ``head``
    and ``tail`` (characters before and behind the segment) and ``context`` (hash of base, segment, head and tail)."""
    sized = lines.withColumn("size", F.char_length("line"))
    based = sized.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).withColumn("base", F.col("size") - F.col("longer"))
    parts = based.withColumn("parts", F.greatest(F.lit(2), F.ceil(F.sqrt("base") / SEGMENT_ROOT).cast("int")))
    cut = parts.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("s"))
    cut = cut.withColumn("head", F.expr("cast(cast(base as long) * s div parts as int)"))
    cut = cut.withColumn("tail", F.expr("cast(base - cast(base as long) * (s + 1) div parts as int)"))
    context = F.xxhash64("base", "s", F.substr("line", F.lit(1), F.col("head")), F.substr("line", F.col("size") - F.col("tail") + 1))
    return cut.withColumn("context", context).drop("parts", "s", "base")


def _occurrences(docs: DataFrame, min_chars: int, equal_chars: int) -> DataFrame:
    """Every line that can go: two hashes that identify its text, its place, and the text."""
    x = docs.select("_id", "_doc", F.posexplode(_lines(F.col("_text"))).alias("no", "line"))
    return x.filter((F.char_length("line") >= min(min_chars, equal_chars)) & F.col("line").rlike(WORD)).select(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"),
        F.struct("_id", "_doc", "no").alias("place"), "line")


def _near(occurrences: DataFrame, firsts: DataFrame, filter_bits: int) -> DataFrame:
    """Lines (h1, h2, place of the first occurrence) within one edit of an earlier line."""
    contexts = _segments(occurrences.select("h1", "h2", "line")).select("context", "h1", "h2")
    ends = [f(c).alias(f"{n}_{c}") for c in ("h1", "h2") for n, f in (("a", F.min), ("b", F.max))]
    shared = contexts.groupBy("context").agg(*ends).filter("a_h1 != b_h1 OR a_h2 != b_h2")
    words = materialize(bitmap.pack(shared.select(bitmap.position(F.col("context"), filter_bits).alias("pos")), "pos"), "line-contexts")

    hit = bitmap.with_hit(_segments(occurrences), words, bitmap.position(F.col("context"), filter_bits), "_hit").filter("_hit")
    first = firsts.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("place").alias("first"))
    hot = hit.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")) & (F.col("place") == F.col("first")))
    middle = F.substr("line", F.col("head") + 1, F.col("size") - F.col("tail") - F.col("head"))
    hot = materialize(hot.select("h1", "h2", "place", "line", F.struct("context", "longer", middle.alias("middle")).alias("x")), "line-candidates")

    middle, longer = F.col("x.middle"), F.col("x.longer")
    size = F.char_length(middle)
    deleted = lambda p: F.concat(F.substr(middle, F.lit(1), p), F.substr(middle, p + 2))
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    # replacements: both lines have the base length; insertions: one has it, the other is longer by one
    variants = F.when(longer == 0, F.concat(
        F.transform(places, lambda p: F.struct(F.xxhash64(F.col("x.context"), p, deleted(p)).alias("key"), F.lit(0).alias("kind"))),
        F.array(F.struct(F.xxhash64(F.col("x.context"), F.lit(-1), middle).alias("key"), F.lit(1).alias("kind"))))
    ).otherwise(F.transform(places, lambda p: F.struct(F.xxhash64(F.col("x.context"), F.lit(-1), deleted(p)).alias("key"), F.lit(2).alias("kind"))))
    rows = hot.select(F.struct("place", "h1", "h2").alias("me"), F.explode(variants).alias("v")).select("me", "v.key", "v.kind")
    # a variant's group holds lines that differ in one character at one place: small by nature
    group = Window.partitionBy("key")
    least = lambda kind: F.min(F.when(F.col("kind") == kind, F.col("me"))).over(group)
    met = rows.select("me", "kind", least(0).alias("m0"), least(1).alias("m1"), least(2).alias("m2"))
    other = F.when(F.col("kind") == 0, F.col("m0")).when(F.col("kind") == 1, F.col("m2")).otherwise(F.col("m1"))
    pairs = met.select("me", other.alias("other")).filter(F.col("other.place") < F.col("me.place")).distinct()
    texts = hot.groupBy("h1", "h2").agg(F.first("line").alias("line"))
    one = texts.select(F.struct("h1", "h2").alias("ka"), F.col("line").alias("la"))
    two = texts.select(F.struct("h1", "h2").alias("kb"), F.col("line").alias("lb"))
    checked = (pairs.join(one, F.struct("me.h1", "me.h2") == F.col("ka")).join(two, F.struct("other.h1", "other.h2") == F.col("kb"))
               .filter(F.levenshtein("la", "lb", 1) == 1))
    return checked.select("me.h1", "me.h2", "me.place").distinct()


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               filter_bits: int = FILTER_BITS, equal_chars: int | None = None) -> DataFrame:
    """``df`` plus ``n_lines, n_removed, kept_text`` (the lines that stay, joined by newlines)."""
    keys = [F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_doc")]
    docs = df.select(boxed(df, *RESULT), *keys, F.col(text_col).alias("_text"))
    occurrences = _occurrences(docs, min_chars, min_chars if equal_chars is None else equal_chars)
    firsts = materialize(occurrences.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n")), "line-firsts")
    near = _near(occurrences.filter(F.char_length("line") >= min_chars), firsts, filter_bits)
    repeated = firsts.filter("n > 1").select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("place").alias("first"))
    later = (occurrences.select("h1", "h2", "place").join(repeated, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")))
             .filter(F.col("place") > F.col("first")).select("place"))
    gone = later.union(near.select("place")).groupBy(F.col("place._id").alias("_gid"), F.col("place._doc").alias("_gdoc")).agg(
        F.collect_set("place.no").alias("_gone"))
    gone = materialize(gone, "line-removed")
    # rows that keep all their lines (a bitmap rules most of them out) don't shuffle their texts
    words = materialize(bitmap.pack(gone.select(bitmap.position(F.col("_gdoc"), filter_bits).alias("pos")), "pos"), "line-changed")
    marked = bitmap.with_hit(docs, words, bitmap.position(F.col("_doc"), filter_bits), "_hit")
    same = marked.filter(~F.col("_hit")).select("row", F.size(_lines(F.col("_text"))).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"),
                                                F.coalesce("_text", F.lit("")).alias("kept_text"))
    joined = marked.filter("_hit").join(gone, F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_doc") == F.col("_gdoc")), "left")
    joined = joined.select("row", _lines(F.col("_text")).alias("_all"), F.coalesce("_gone", F.array().cast("array<int>")).alias("_gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_gone"))
    changed = joined.select("row", F.size("_all").cast("long").alias("n_lines"), F.size("_gone").cast("long").alias("n_removed"),
                            F.array_join(F.transform(left, lambda i: F.get(F.col("_all"), i)), "\n").alias("kept_text"))
    return same.unionByName(changed).select("row.*", *RESULT)


@query("op6_line_dedup")
def op6_line_dedup(spark, sf_dir):
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
