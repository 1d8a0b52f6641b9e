"""Document fingerprints: order MinHash over words and over code points.

A text is a sequence of pieces: its first ``LEAD`` code points one by one, then its words, cut every
``PIECE`` code points.  So texts without white space and very short texts have several k-mers too, by the same
rule as all others.  A k-mer (``K`` pieces that end at a piece; nothing stands before the first) gets an
occurrence number, so that a repeated k-mer counts as different elements.
One hash per element deals the elements into ``BINS`` bins and ranks them there
(one-permutation hashing).  Each bin selects its ``L`` minimal elements, puts
them back into text order, and hashes the tuple of their k-mers: a bin matches
only if both texts agree on its k-mers and on their order, which follows
edit distance rather than set overlap.  Likeness is the share of equal bins
among those filled in either text.  A text of 4 code points, the shortest that an edit of
its last quarter changes, still shares two of the six k-mers with its edited form.

Everything is array expressions inside one projection: no user function, and
k-mers are never shuffled.  An element is one number, 36 bits of its k-mer's hash above 28 bits of its position
(an array of numbers that Spark can hold has fewer than 2^28).  Occurrence numbers come from runs of equal hashes in the
sorted numbers, so the work is O(n log n) in the text length.

``fingerprint_edits`` also fingerprints each text with its last quarter replaced
by the beginning of the next document.  The order of ids is found on ids alone
(range partitions and one row per partition); texts move by doc_id for each of
the two joins, and between them only the beginnings.

Defined results: a null text counts as empty; an empty text has an empty
fingerprint, like 1 to another such and 0 to the rest; of rows that share a
doc_id, each is a document, and the id before takes the smallest of their
texts for its tail and the smallest of their fingerprints for near_next; a row
with null doc_id has an empty text as its next document and is nobody's next; an only document is its own next; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinspark.llm.common import bind, documents, stage

K = 2
L = 2
BINS = 32
LEAD, PIECE = 8, 8
_PLACE = 28  # lower bits of an element: its position; the others are its k-mer's hash
_SHIFT = 59  # the upper five bits of a hash are its bin


def _bin(r: Column) -> Column:
    return F.shiftrightunsigned(r, _SHIFT).cast("int")


def _tuples(c: Column, size: int) -> Column:
    """(bin, hash of its k-mers in text order) of chosen (bin, position, k-mer), sorted."""
    heads = F.filter(
        F.transform(c, lambda x, i: F.struct(x["bin"].alias("bin"), i.alias("i"))),
        lambda y: F.coalesce(F.get(c, y["i"] - 1)["bin"] != y["bin"], F.lit(True)),
    )

    def value(y: Column) -> Column:
        own = [F.when(F.get(c, y["i"] + j)["bin"] == y["bin"], F.get(c, y["i"] + j)["h"]) for j in range(size)]
        return F.struct(y["bin"].alias("bin"), F.xxhash64(*own).alias("value"))

    return F.transform(heads, value)


def pieces(text: Column) -> Column:
    """The first code points of a text one by one, then its words in parts of at most ``PIECE`` code points."""
    lead = F.transform(F.sequence(F.lit(1), F.least(F.length(text), F.lit(LEAD))), lambda i: F.substring(text, i, F.lit(1)))
    return F.concat(lead, F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0)))


def _elements(text: Column, k: int) -> Column:
    """Sorted (k-mer's hash, position) in one number for each piece: the k-mer that ends there."""

    def hashes(w: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            h = F.xxhash64(*[F.get(w, i - j) for j in range(k - 1, 0, -1)], x)
            return F.shiftleft(h, _PLACE).bitwiseOR(i.cast("bigint"))

        return F.transform(w, one)

    return F.sort_array(bind(pieces(text), hashes))


def sketch(text: Column, k: int = K, size: int = L) -> Column:
    """array<struct<bin, value>> of the filled bins, by bin."""

    def kmer(x: Column) -> Column:
        return F.shiftrightunsigned(x, _PLACE)

    def number(s: Column) -> Column:  # hash of (k-mer, occurrence number) for each of s
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (kmer(F.get(s, i - 1)) != kmer(F.get(s, i)))
        )

        def runs(first: Column) -> Column:
            def count(start: Column, j: Column) -> Column:
                return F.sequence(F.lit(0), F.coalesce(F.get(first, j + 1), F.size(s)) - start - 1)

            return F.zip_with(s, F.flatten(F.transform(first, count)), lambda x, o: F.xxhash64(kmer(x), o))

        return bind(starts, runs)

    def select(s: Column) -> Column:
        def choose(r: Column) -> Column:
            def rank(x: Column) -> Column:
                return F.shiftrightunsigned(F.shiftleft(x, 64 - _SHIFT), 64 - _SHIFT)

            def least(at: Column) -> Column:  # of the elements at these places of s; per bin the `size` least, in text order
                ranked = F.sort_array(
                    F.transform(
                        at,
                        lambda i: F.struct(
                            _bin(F.get(r, i)).alias("bin"),
                            rank(F.get(r, i)).alias("rank"),
                            F.get(s, i).bitwiseAND(F.lit((1 << _PLACE) - 1)).alias("p"),
                            kmer(F.get(s, i)).alias("h"),
                        ),
                    )
                )
                first = bind(
                    ranked,
                    lambda c: F.filter(
                        c, lambda x, i: F.coalesce(F.get(c, i - size)["bin"] != x["bin"], F.lit(True))
                    ),
                )
                return F.sort_array(F.transform(first, lambda x: F.struct(x["bin"], x["p"], x["h"])))

            # the least are among the elements of low rank, of which a long text needs a small share; looked at again if not
            n, every = F.size(s), F.sequence(F.lit(0), F.size(s) - 1)
            low = ((F.lit(1 << _SHIFT) / n) * (16 * BINS)).cast("bigint")
            few = F.filter(every, lambda i: rank(F.get(r, i)) < low)
            found = bind(
                F.when(n > 16 * BINS, least(few)),
                lambda c: F.when(F.size(c) == size * BINS, c).otherwise(least(every)),
            )
            return bind(found, lambda c: _tuples(c, size))

        return bind(number(s), choose)

    none = F.array().cast("array<struct<bin:int,value:bigint>>")
    return F.when(F.length(text) > 0, bind(_elements(text, k), select)).otherwise(none)


def as_text(s: Column) -> Column:
    """The sketch as a string: two hex digits of the bin and eight of its value, per filled bin."""
    return F.array_join(
        F.transform(
            s,
            lambda x: F.concat(
                F.lpad(F.lower(F.hex(x["bin"])), 2, "0"),
                F.lpad(F.lower(F.hex(F.shiftrightunsigned(x["value"], 32))), 8, "0"),
            ),
        ),
        "",
    )


_WIDTH = 10  # characters of a bin in as_text


def likeness(a: Column, b: Column) -> Column:
    """Equal bins among the bins filled in fingerprints a or b (1 if neither has any)."""

    def bins(s: Column, width: int) -> Column:
        at = F.sequence(F.lit(0), F.length(s) - 1, F.lit(_WIDTH))
        none = F.array().cast("array<string>")
        return F.when(F.length(s) == 0, none).otherwise(F.transform(at, lambda i: F.substring(s, i + 1, F.lit(width))))

    same = F.size(F.array_intersect(bins(a, _WIDTH), bins(b, _WIDTH)))
    filled = F.size(F.array_union(bins(a, 2), bins(b, 2)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(same / filled)


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) for distinct ids: the next larger one, the smallest after the largest.

    Ids are range-partitioned; within a partition it is a window, and between
    partitions a window over one row per partition.
    """
    part = F.spark_partition_id().alias("part")
    ranged = stage(ids.where("doc_id IS NOT NULL").distinct().repartitionByRange("doc_id").select("doc_id", part), "id-order")
    own = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    firsts = ranged.groupBy("part").agg(F.min("doc_id").alias("first"))
    over = Window.orderBy("part")  # one row per partition
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select("part", F.coalesce(F.lead("first").over(over), F.min("first").over(whole)).alias("following"))
    paired = ranged.select("doc_id", "part", own.alias("next_id")).join(following, "part")
    return paired.select("doc_id", F.coalesce("next_id", "following").alias("next_id"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # a column taken as it is, without an alias, leaves the two joins below the same exchange
    same = id_col == "doc_id" and dict(docs.dtypes)[id_col] == "bigint"
    plain = docs.select(F.col(id_col) if same else F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    placed = plain.where("doc_id IS NOT NULL")  # joined twice below; nothing but the scan is under the exchanges
    longest = placed.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    order = stage(next_ids(longest.select("doc_id")).join(longest, "doc_id"), "next-ids")
    wanted = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before"), F.expr("n div 4").alias("most"))
    begun = placed.join(wanted.hint("merge"), "doc_id")
    starts = begun.select(F.col("before").alias("doc_id"), F.expr("left(text, cast(most as int))").alias("start"))
    starts = starts.groupBy("doc_id").agg(F.min("start").alias("start"))
    joined = placed.join(starts.hint("merge"), "doc_id").select("doc_id", "text", "start")
    alone = plain.where("doc_id IS NULL").select("doc_id", "text", F.lit("").alias("start"))
    both = joined.unionByName(alone).select("*", F.length("text").alias("n"))
    edited = F.expr("concat(left(text, n - n div 4), left(start, cast(n div 4 as int)))")
    both = both.select("doc_id", "n", "text", edited.alias("edited"))
    prints = both.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(sketch(F.col("text"))).alias("fingerprint"),
        as_text(sketch(F.col("edited"))).alias("edited_fingerprint"),
    )
    prints = stage(prints, "fingerprints")
    one = prints.groupBy("doc_id").agg(F.min("fingerprint").alias("next"))
    following = one.withColumnRenamed("doc_id", "next_id")
    following = order.select("doc_id", "next_id").join(following, "next_id").drop("next_id")
    return prints.join(following, "doc_id", "left").select(
        *prints.columns,
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.coalesce("next", F.lit(""))).alias("near_next"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))
