"""Order MinHash fingerprints, by built-in functions only.

A text is cut into tokens, and each k-mer of tokens is numbered by its occurrence, so that
repeated k-mers are different elements. One hash function deals the elements over bins; the
smallest two of a bin are kept in text order and hashed as a tuple. Equal tuples need equal
k-mers in equal order, so likeness falls with edit distance and not only with the sets.

Defined cases: null text is empty; a text without tokens has an empty fingerprint, like
another empty one (1.0) and unlike any other (0.0); a text of fewer than k tokens is one
k-mer; equal texts have equal fingerprints; a null id sorts lowest; rows with equal ids follow
each other by text; a single row follows itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.llm.common import text_rows, written
from lendmill.llm.ranks import placed

K, BINS = 3, 32
#: Visible characters of a token at most: longer words (and scripts without spaces) are cut.
TOKEN = "[^\\x20\\x09-\\x0D]{1,12}"
POSITION_BITS = 26
#: Ids that share a window for finding the next document.
NEIGHBOURS = 256


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, bins: int = BINS) -> DataFrame:
    """Add a fingerprint: a hexadecimal hash per bin, or dashes for an empty bin."""
    kept = df.columns
    position = (1 << POSITION_BITS) - 1

    def pack(high: Column, index: Column) -> Column:
        return F.shiftleft(high, POSITION_BITS).bitwiseOR(index.cast("long").bitwiseAND(position))

    marks = df.withColumn("__t", F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w)))
    kmers = marks.withColumn(
        "__k",
        F.when(F.size("__t") == 0, F.array().cast("array<bigint>"))
        .when(F.size("__t") < k, F.array(F.xxhash64("__t")))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size("__t") - k), lambda i: F.xxhash64(*[F.col("__t")[i + j] for j in range(k)]))),
    ).drop("__t")
    # Where a k-mer repeats: sorted by k-mer and position, an occurrence's number is its
    # distance from the start of its run.
    high = (1 << (63 - POSITION_BITS)) - 1
    runs = kmers.withColumn(
        "__s",
        F.when(
            F.size(F.array_distinct("__k")) < F.size("__k"),
            F.sort_array(F.transform("__k", lambda h, i: pack(h.bitwiseAND(high), i))),
        ),
    ).withColumn(
        "__r",
        F.filter(
            F.transform("__s", lambda x, i: F.when((i == 0) | (F.shiftright(x, POSITION_BITS) != F.shiftright(F.col("__s")[i - 1], POSITION_BITS)), i)),
            lambda i: i.isNotNull(),
        ),
    ).withColumn(
        "__o",
        F.flatten(F.transform("__r", lambda s, j: F.sequence(F.lit(0), F.when(j + 1 < F.size("__r"), F.col("__r")[j + 1]).otherwise(F.size("__s")) - s - 1))),
    )

    def element(h: Column, occurrence: Column, at: Column) -> Column:
        mixed = F.xxhash64(h, occurrence)
        return pack(mixed.bitwiseAND((1 << (63 - POSITION_BITS)) - 1), at)

    # The top bits of the packed hash are the bin, so sorting brings each bin's smallest first.
    elements = runs.withColumn(
        "__e",
        F.sort_array(
            F.when(
                F.col("__s").isNull(), F.transform("__k", lambda h, i: element(h.bitwiseAND(high), F.lit(0), i))
            ).otherwise(
                F.zip_with("__s", "__o", lambda x, o: element(F.shiftright(x, POSITION_BITS), o, x.bitwiseAND(position)))
            )
        ),
    ).drop("__k", "__s", "__r", "__o")
    shift = 63 - (bins - 1).bit_length()

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, shift).cast("int")

    firsts = elements.withColumn(
        "__f",
        F.filter(
            F.transform("__e", lambda x, i: F.when((i == 0) | (bin_of(x) != bin_of(F.col("__e")[i - 1])), i)), lambda i: i.isNotNull()
        ),
    )

    def tuple_hash(i: Column) -> Column:
        a, b = F.col("__e")[i], F.get("__e", i + 1)
        pair = b.isNotNull() & (bin_of(a) == bin_of(b))
        ha, hb = F.shiftright(a, POSITION_BITS), F.shiftright(b, POSITION_BITS)
        forward = a.bitwiseAND(position) < b.bitwiseAND(position)
        value = F.when(~pair, F.xxhash64(ha)).when(forward, F.xxhash64(ha, hb)).otherwise(F.xxhash64(hb, ha))
        return F.substring(F.hex(value.bitwiseAND(0xFFFFFFFF) + F.lit(1 << 32)), 2, 8)

    filled = firsts.withColumn(
        "__m", F.map_from_arrays(F.transform("__f", lambda i: bin_of(F.col("__e")[i])), F.transform("__f", tuple_hash))
    )
    # The map is named twice, so that it stays a column and is not built anew for each bin.
    return filled.select(
        *kept, F.when(F.size("__m") == 0, F.lit("--------" * bins)).otherwise(F.array_join(F.transform(F.array(*[F.lit(b) for b in range(bins)]), lambda b: F.coalesce(F.col("__m")[b], F.lit("--------"))), "")).alias(name)
    )


def likeness(a: str, b: str) -> Column:
    """The share of text in common, from the share p of equal bins among those filled on
    either side: both elements of a tuple are shared with probability p, one with sqrt(p), and
    a set overlap J means a common share of 2 J / (1 + J)."""
    empty = F.lit("--------")
    cells = F.zip_with(
        F.regexp_extract_all(a, F.lit(".{8}"), F.lit(0)), F.regexp_extract_all(b, F.lit(".{8}"), F.lit(0)),
        lambda x, y: F.when((x == empty) & (y == empty), F.lit(None)).otherwise(F.when(x == y, F.lit(1.0)).otherwise(F.lit(0.0))),
    )
    # Sum and number of the cells that count, in one pass; from them the estimate.
    state = F.struct(F.lit(0.0).alias("equal"), F.lit(0.0).alias("filled"))
    return F.aggregate(
        cells, state, lambda s, x: F.struct((s["equal"] + F.coalesce(x, F.lit(0.0))).alias("equal"), (s["filled"] + F.when(x.isNull(), 0.0).otherwise(1.0)).alias("filled")),
        lambda s: F.when(s["filled"] == 0, F.lit(1.0)).otherwise(2 * F.sqrt(s["equal"] / s["filled"]) / (1 + F.sqrt(s["equal"] / s["filled"]))),
    )


def followed(docs: DataFrame) -> DataFrame:
    """Rows whose window holds, for every document, the one that follows it in descending id:
    documents by buckets of ids, each with a guest, the highest row of the bucket below (the
    lowest bucket has the highest of all). Columns: bucket, place, guest, doc_id, text."""
    rows = text_rows(docs).withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 62)))).withColumn("bucket", F.floor(F.col("place") / NEIGHBOURS))
    tops = rows.groupBy("bucket").agg(F.max(F.struct("place", "text")).alias("top"))
    # The next bucket that has rows, by its place among all buckets.
    buckets = placed(rows.select("bucket").distinct().withColumn("all", F.lit(0)), ["all"], ["bucket"], "buckets").select("bucket", "pos", "n")
    above = buckets.select(F.pmod(F.col("pos") - 1, F.col("n")).alias("pos"), F.col("bucket").alias("next"))
    guests = tops.join(buckets, "bucket").join(above, "pos").select(
        F.col("next").alias("bucket"), F.lit(None).cast("long").alias("place"), F.lit(True).alias("guest"), F.lit(None).cast("long").alias("doc_id"), F.col("top.text").alias("text")
    )
    everyone = rows.select("bucket", "place", F.lit(False).alias("guest"), "doc_id", "text").unionByName(written(guests, "guests"))
    # Dealt here, so that the fingerprint is one step above the union and not one in each branch
    # (a plan that takes minutes to optimize), and the windows find their rows in place.
    return everyone.repartition("bucket")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited form, whose last third is replaced by the
    beginning of the next document's text, with their likenesses."""
    printed = with_fingerprint(followed(docs), "text", "fingerprint")
    order = W.partitionBy("bucket").orderBy(F.col("guest").desc(), "place", "text")
    pairs = printed.withColumn("__next", F.lag(F.struct("text", "fingerprint")).over(order)).filter(~F.col("guest"))
    cut = F.length("text") - F.floor(F.length("text") / 3)
    edited = pairs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "fingerprint", F.col("__next.fingerprint").alias("__next_print"),
        F.concat(F.substr("text", F.lit(1), cut.cast("int")), F.substr(F.col("__next.text"), F.lit(1), F.floor(F.length("text") / 3).cast("int"))).alias("edited"),
    )
    both = with_fingerprint(edited, "edited", "edited_fingerprint")
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "__next_print").alias("near_next"),
    )
