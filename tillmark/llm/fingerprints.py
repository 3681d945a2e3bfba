"""Document fingerprints by I-Match with several randomised lexicon subsets.

A lexicon holds the terms whose inverse document frequency lies in a band: neither the
rare ones, which any edit changes, nor the common ones, which tell documents apart badly.
A fingerprint hashes the sorted distinct terms that a document has in each of several
random subsets of the lexicon. Dense subsets tell near copies apart; thin ones, of which a
document has about one term, survive larger edits, so the share of equal hashes follows the
share of common terms.

All of it is DataFrame functions. Distinct terms of all texts meet the lexicon in a join; a
lexicon term brings along, in one number, how deep in each draw's subsets it lies. At most ``distinct terms of
an average document / LOW`` terms have a document frequency of ``LOW`` of all documents or
more, whatever their number, so Spark can broadcast the lexicon by its measured size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmark.sources.scratch import stored

#: The band: terms in this share of all documents.
LOW, HIGH = 0.01, 0.10
#: Random draws of subsets, at most 7; of each, subsets of a half, a quarter, ... of the lexicon, at most 15.
DRAWS, LEVELS = 6, 8
WHITE = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """The distinct lower-case words of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), WHITE)), "")


#: Bits that the depth of a term in one draw takes in the number of all its depths.
DEPTH = 4


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(term, code, depths): the terms whose document frequency lies in the band, a hash of each, and of each draw how
    many of its subsets, from the largest, it is in. A draw's subsets lie in one another."""
    per_doc = docs.select(F.explode(terms(F.col("text"))).alias("term"))
    counted = per_doc.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    in_band = (F.col("df") >= max(1.0, n * low)) & (F.col("df") <= max(2.0, n * high))
    drawn = counted.where(in_band).select("term", F.xxhash64("term").alias("code"), *[F.xxhash64("term", F.lit(draw)).alias(f"d{draw}") for draw in range(DRAWS)])
    depths = [
        F.when(F.col(f"d{draw}").bitwiseAND(F.lit((2 << level) - 1)) == 0, F.lit(1 << DEPTH * draw)).otherwise(F.lit(0))
        for draw in range(DRAWS) for level in range(LEVELS)
    ]
    return drawn.select("term", "code", reduce(lambda a, b: a + b, depths).cast("int").alias("depths"))


def subset_hashes(known: Column) -> Column:
    """A hash of the sorted terms (code, depths) in each subset, null where there is none."""
    def folded(subset: Column) -> Column:
        start = F.xxhash64(subset["number"])
        inside = lambda x: x["depths"].bitwiseAND(subset["draw"]) >= subset["least"]
        return F.nullif(F.aggregate(known, start, lambda hash_, x: F.when(inside(x), F.xxhash64(hash_, x["code"])).otherwise(hash_)), start)

    subsets = [(draw * LEVELS + level, ((1 << DEPTH) - 1) << DEPTH * draw, (level + 1) << DEPTH * draw) for draw in range(DRAWS) for level in range(LEVELS)]
    return F.transform(F.array(*[F.struct(F.lit(number).alias("number"), F.lit(draw).alias("draw"), F.lit(least).alias("least")) for number, draw, least in subsets]), folded)


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("-"))), ".")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the subsets where either text has terms, 0 to 1."""
    both = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(F.coalesce(x == y, F.lit(False)).cast("int")))
    used, same = F.size(F.array_compact(both)), F.aggregate(F.array_compact(both), F.lit(0), lambda n, x: n + x)
    return F.when(F.size(a) != F.size(b), F.lit(0.0)).when(used == 0, F.lit(1.0)).otherwise(same / used)


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with ``next_<column>`` of the row that follows by doc_id, the first after the last.

    Rows of one id follow each other by text, null ids come last. Rows fall into ranges
    of ids cut at quantiles; the first rows of a range go along to the range before, so
    each row meets its successor inside one range and only one shuffle is needed. The
    driver sees one quantile and one smallest id per range.
    """
    spark = rows.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first().cuts or []
    cuts = sorted(set(cuts))
    bounds = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    place = F.coalesce(F.size(F.filter(bounds, lambda cut: cut <= F.col("doc_id"))), F.lit(len(cuts) + 1))
    place = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(place)
    firsts = rows.select("doc_id", place.alias("place")).groupBy("place").agg(F.min("doc_id").alias("id")).orderBy("place").collect()
    before = [firsts[i - 1].place for i in range(len(firsts))]
    goes_to = F.array(place)
    ids = [first.id for first in firsts if first.id is not None]
    to = [previous for first, previous in zip(firsts, before) if first.id is not None]
    null_to = next((previous for first, previous in zip(firsts, before) if first.id is None), None)
    if ids:
        at = F.array_position(F.lit(ids), F.col("doc_id"))
        goes_to = F.when(at > 0, F.array(place, F.element_at(F.lit(to), F.greatest(at, F.lit(1)).cast("int")))).otherwise(goes_to)
    if null_to is not None:
        goes_to = F.when(F.col("doc_id").isNull(), F.array(place, F.lit(null_to))).otherwise(goes_to)
    dealt = rows.select("*", F.posexplode(goes_to).alias("guest", "place"))
    order = Window.partitionBy("place").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    led = dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return led.where("guest = 0").drop("guest", "place")


def hashed(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(row, kind, about, hashes) of texts (row, kind, text, about); ``words`` is the lexicon.

    A text without terms of the lexicon gets one hash of all its terms instead. What is
    known about a text rides along with its terms as an entry without a term, so that each
    text is read once.
    """
    every = terms(F.col("text"))
    entries = texts.select("row", "kind", every.alias("terms"), F.struct("about", F.xxhash64(F.array_sort(every), F.lit(-1)).alias("everything")).alias("about"))
    plain = F.transform("terms", lambda term: F.struct(term.alias("term"), F.lit(None).cast(entries.schema["about"].dataType).alias("about")))
    own = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.col("about").alias("about")))
    long = entries.select("row", "kind", F.inline(F.concat(own, plain)))
    met = long.join(words, "term", "left").where("about IS NOT NULL OR code IS NOT NULL")
    # Two lists of numbers in the same order, of 8 and 4 bytes, take less than half the bytes of one list of pairs.
    listed = met.groupBy("row", "kind").agg(F.first("about", ignorenulls=True).alias("about"), F.collect_list("code").alias("code"), F.collect_list("depths").alias("depths"))
    grouped = listed.select("row", "kind", "about", F.sort_array(F.arrays_zip("code", "depths")).alias("known"))
    hashes = F.when(F.size("known") > 0, subset_hashes(F.col("known"))).otherwise(F.array("about.everything"))
    return grouped.select("row", "kind", F.col("about.about").alias("about"), hashes.alias("hashes"))


def fingerprints(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text ends in the first code points of the next document instead of its own
    last half. Null texts count as empty; an empty text has the hash of no terms. Ids may
    repeat or be null (see :func:`with_next`). An empty table gives no rows; other columns
    of ``docs`` are not read.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = stored(lexicon(texts, low, high), "lexicon")
    # The number of a row stays the same whenever the files are read again.
    led = with_next(texts.withColumn("row", F.monotonically_increasing_id()), ["text", "row"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = led.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    )
    facts = F.struct("doc_id", "n_chars", "next_row", F.unhex(F.sha2("edited", 256)).alias("edited_sha256"))
    none = F.lit(None).cast("struct<doc_id:bigint,n_chars:bigint,next_row:bigint,edited_sha256:binary>")
    both = edited.select("row", F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("text"), facts.alias("about")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"), none.alias("about")),
    )))
    found = stored(hashed(both, words), "fingerprints")
    own = found.where("kind = 0").select("row", "about.*", "hashes")
    other = found.where("kind = 1").select("row", F.col("hashes").alias("edited_hashes"))
    after = found.where("kind = 0").select(F.col("row").alias("next_row"), F.col("hashes").alias("next_hashes"))
    return own.join(other, "row").join(after, "next_row").select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        as_text(F.col("hashes")).alias("fingerprint"), as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
