"""Order MinHash fingerprints of texts, and their likeness, in DataFrame functions alone.

A text's k-mers are its runs of `K` words; equal k-mers are told apart by numbering
their occurrences in text order. A hash of k-mer and number deals them out to `BINS`
bins and orders them within a bin; of each bin the `MINIMA` smallest are taken, put
back in text order, and hashed as a tuple. So a bin agrees in two texts if both have
the same smallest k-mers in the same order, which follows their edit distance and
not just the sets of their words. Bins replace as many separate hash functions: each
k-mer is hashed once.

Likeness is the MINIMA-th root of the share of bins that agree, of those that are
not empty in both texts: a tuple agrees about as often as so many k-mers do.

Arrays are bound by a lambda's variable where they are used more than once, so that
Spark works them out once a row.

Edge cases: a NULL text is an empty one; texts without words have an empty
fingerprint, alike to each other (1) and to no other (0). A text of fewer than K
words is one k-mer. A NULL id comes last; rows with equal ids, or none, come in order
of a hash of their texts, then of the texts, so that many of them need not be in one
task (only rows equal in both are). The only row of a table is its own next one. An empty table gives an empty
result. Other columns are never looked at. Positions are exact for texts of up to
2^24 words, beyond that they wrap, equally for equal texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of

K = 3
MINIMA = 2
BINS = 64
BLANKS = r"[\x20\x09-\x0D]+"
PLACE_BITS = 24
_PLACE = (1 << PLACE_BITS) - 1
# Blocks of the order by id, per shuffle partition, so that hashing evens them out.
BLOCKS = 4
TIE_BITS = 31


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def packed(hash_: Column, place: Column) -> Column:
    """A hash's upper bits, and a place in the lower ones."""
    return hash_.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long").bitwiseAND(F.lit(_PLACE)))


def hash_of(item: Column) -> Column:
    return F.shiftright(item, PLACE_BITS)


def place_of(item: Column) -> Column:
    return item.bitwiseAND(F.lit(_PLACE))


def bin_of(item: Column, bins: int) -> Column:
    """Bins are ranges of hashes, so sorted items are sorted by bin."""
    return F.shiftright(item, 64 - (bins - 1).bit_length())


def kmers(words: Column, k: int = K) -> Column:
    """Hash and place of every k-mer, sorted by hash, then place."""
    count = F.greatest(F.size(words) - (k - 1), F.least(F.size(words), F.lit(1)))
    runs = F.transform(
        F.slice(words, 1, count),
        lambda word, i: packed(F.xxhash64(word, *(F.get(words, i + j) for j in range(1, k))), i),
    )
    return F.sort_array(runs)


def numbered_occurrences(items: Column) -> Column:
    """Sorted k-mers, each hashed anew with the number of its occurrence, and sorted again."""
    n = F.size(items)
    starts = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (hash_of(F.get(items, i)) != hash_of(F.get(items, i - 1))),
    )
    labelled = let(
        starts,
        lambda starts: F.flatten(
            F.transform(
                starts,
                lambda start, run: F.transform(
                    F.slice(items, start + 1, F.coalesce(F.get(starts, run + 1), n) - start),
                    lambda item, number: packed(F.xxhash64(hash_of(item), number), place_of(item)),
                ),
            )
        ),
    )
    return F.sort_array(labelled)


def sketch(items: Column, bins: int = BINS, minima: int = MINIMA) -> Column:
    """An entry for every bin that is not empty: the bin in the upper bits, below it the hash."""
    firsts = F.filter(
        F.sequence(F.lit(0), F.size(items) - 1),
        lambda i: (i == 0) | (bin_of(F.get(items, i), bins) != bin_of(F.get(items, i - 1), bins)),
    )
    bits = (bins - 1).bit_length()

    def entry(first: Column) -> Column:
        which = bin_of(F.get(items, first), bins)
        least = F.filter(F.slice(items, first + 1, minima), lambda item: bin_of(item, bins) == which)
        in_order = F.sort_array(
            F.transform(least, lambda item: F.struct(place_of(item).alias("p"), hash_of(item).alias("h")))
        )
        hash_ = F.xxhash64(F.transform(in_order, lambda item: item["h"]))
        return F.shiftleft(which, 64 - bits).bitwiseOR(F.shiftrightunsigned(hash_, bits))

    return F.transform(firsts, entry)


def fingerprint(text: Column) -> Column:
    """The entries of a text's fingerprint."""
    return let(
        F.array_remove(F.split(text, BLANKS), ""),
        lambda words: F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(
            let(kmers(words), lambda items: let(numbered_occurrences(items), lambda i: sketch(i)))
        ),
    )


def as_text(entries: Column) -> Column:
    """Entries in hex digits, joined by blanks."""
    return F.array_join(F.transform(entries, F.hex), " ")


def likeness(a: Column, b: Column, bins: int = BINS, minima: int = MINIMA) -> Column:
    """Likeness of two fingerprints, from 0 to 1."""
    filled = F.size(
        F.array_union(
            F.transform(a, lambda e: bin_of(e, bins)), F.transform(b, lambda e: bin_of(e, bins))
        )
    )
    share = F.size(F.array_intersect(a, b)) / filled
    return F.when(filled == 0, 1.0).otherwise(F.pow(share, F.lit(1.0 / minima)))


def tie_of(text: Column) -> Column:
    """What orders rows of one id before their texts do: 31 bits of the text's hash."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - TIE_BITS)


def blocks_by_id(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows with `block`: quantiles of the ids, numbered as the ids fall, NULL last.

    An id that holds several quantiles, or NULL, is cut further by `tie_of`, into as
    many slices. The cuts lie in an array of arrays, so that few of them are looked at
    per row.
    """
    marks = [i / blocks for i in range(1, blocks)] or [0.5]
    found, total, known = rows.agg(
        F.percentile_approx("doc_id", marks, 10 * blocks), F.count(F.lit(1)), F.count("doc_id")
    ).first()
    times = Counter(found or [0])
    cuts = sorted(times, reverse=True)
    wide = max(1, round(len(cuts) ** 0.5))
    parts = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]
    id_ = F.col("doc_id")
    above = lambda values: F.size(F.filter(values, lambda cut: cut > id_))
    part = above(F.lit([p[0] for p in parts]).cast("array<bigint>")) - 1
    fine = above(F.get(F.array(*(F.lit(p).cast("array<bigint>") for p in parts)), part))
    number = F.when(part < 0, 0).otherwise(part * wide + fine)
    number = F.when(id_.isNull(), len(cuts) + 1).otherwise(number).cast("long")
    slices = F.lit(0)
    if hot := {id_: n + 1 for id_, n in times.items() if n > 1}:
        counts = F.create_map(*(F.lit(x).cast("long") for pair in hot.items() for x in pair))
        slices = F.coalesce(F.try_element_at(counts, id_), F.lit(0))
    nulls = -(-(total - known) * blocks // max(total, 1))
    if nulls > 1:
        slices = F.when(id_.isNull(), F.lit(nulls)).otherwise(slices)
    if hot or nulls > 1:
        # An id of several quantiles is the least of its block: its slices come last there.
        slice_ = F.floor(tie_of(F.col("text")) * slices / F.lit(1 << TIE_BITS)) + 1
        number = number * (blocks + 2) + F.when(slices > 0, slice_).otherwise(0)
    return rows.withColumn("block", number)


def with_next(documents: DataFrame) -> DataFrame:
    """`doc_id`, `text`, `entries`, and `next_text` and `next_entries` of the row that follows.

    The order is by falling id, NULL last, then by a hash of the text, then by the text;
    the first row follows the last. A window runs within each block of ids, which also
    gets a copy of the next block's first row, so every text is shuffled once, and no
    task sees the whole.
    """
    spark = documents.sparkSession
    blocks = BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = blocks_by_id(documents.select("doc_id", text_of().alias("text")), blocks)
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head"))  # a row a block
    ring = Window.orderBy("block")
    links = heads.select(
        F.col("block").alias("at"),
        "head",
        F.coalesce(F.lag("block").over(ring), F.max("block").over(Window.partitionBy())).alias("previous"),
    )
    same = (F.col("block") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("head"))
    first = F.min(F.struct(tie_of(F.col("text")).alias("tie"), "text")).alias("first")
    copies = (
        rows.join(F.broadcast(links), same)
        .groupBy("previous", "doc_id")
        .agg(first)
        .select("doc_id", "first.text", F.col("previous").alias("block"), F.lit(True).alias("copy"))
    )
    dealt = rows.withColumn("copy", F.lit(False)).unionByName(copies).repartition("block")
    printed = dealt.withColumn("entries", fingerprint(F.col("text")))
    order = Window.partitionBy("block").orderBy(
        "copy", F.col("doc_id").desc_nulls_last(), tie_of(F.col("text")), "text"
    )
    ahead = [F.lead(name).over(order).alias(f"next_{name}") for name in ("text", "entries")]
    return printed.select("*", *ahead).filter("NOT copy").drop("block", "copy")


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next one's are.

    The edited text has the last half of the code points replaced by as many of the
    start of the next document's text, or by all of it.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half),
        F.substring("next_text", F.lit(1), half),
    )
    rows = with_next(documents).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "entries",
        "next_entries",
        edited.alias("edited"),
    )
    rows = rows.select("*", fingerprint(F.col("edited")).alias("edited_entries"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("entries")).alias("fingerprint"),
        as_text(F.col("edited_entries")).alias("edited_fingerprint"),
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        likeness(F.col("entries"), F.col("next_entries")).alias("near_next"),
    )
