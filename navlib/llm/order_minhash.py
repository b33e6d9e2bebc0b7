"""Order MinHash fingerprints, in DataFrame functions only.

A text's k-mers are runs of ``K_WORDS`` words (a shorter text is one k-mer);
each occurrence counts, numbered among its likes, so that repeats matter.
From the numbered k-mers of each of ``BUCKETS`` hash classes (one permutation,
split by its leading bits) the ``PICKS`` smallest hashes are taken and put back
in text order; a hash of that tuple is one entry of the fingerprint.  A class
with one k-mer takes the first of the next class that has some (round
again from the last to the first), so that every entry of a text with two k-mers carries order.  Two texts
agree in an entry if they have the same rare k-mers there in the same order,
which is what edit distance keeps and plain MinHash can't see.

Everything happens within the row: k-mer hashes carry their place in the low
bits, so one sort of a plain array of longs groups the likes in text order,
and a second one orders the numbered hashes by class.

Defined cases: null and empty texts have the fingerprint of no entries, and
are fully alike; entries that neither text has don't count; texts with the
same words have the same fingerprint; places above 2^28 words wrap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navlib.functions.ranking import global_row_number
from navlib.llm._frames import pick, stored

K_WORDS = 5
BUCKETS = 64
PICKS = 2

_BITS = 28
_PLACE = (1 << _BITS) - 1


def _at(array: Column, i: Column) -> Column:
    return F.get(array, i)


def fingerprint(df: DataFrame, text: str, name: str, k: int = K_WORDS) -> DataFrame:
    """``df`` with the fingerprint of column ``text``: an entry (class * 2^32 + tuple hash) for each class that has k-mers."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")
    words = df.select(*keep, words.alias("_w")).withColumn("_n", F.greatest(F.size("_w") - (k - 1), F.least(F.size("_w"), F.lit(1))))
    # k-mers as (hash, place), sorted: likes stand together in text order
    kmer = lambda i: F.xxhash64(*[_at(F.col("_w"), i + j) for j in range(k)])
    mers = F.transform(
        F.slice(F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0))), F.lit(1), F.col("_n")),
        lambda i: kmer(i).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.bitwiseAND(F.lit(_PLACE)).cast("bigint")),
    )
    mers = words.select(*keep, F.sort_array(mers).alias("_m"))
    # number of each occurrence: its index less the index where its likes begin, a running maximum by doubling steps
    head = F.transform(
        "_m", lambda m, i: F.when((i > 0) & (F.shiftright(m, _BITS) == F.shiftright(_at(F.col("_m"), i - 1), _BITS)), 0).otherwise(i)
    )
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size("_m") + 1)).cast("int"))
    widen = lambda heads, t: F.transform(
        heads, lambda h, i: F.greatest(h, F.coalesce(_at(heads, i - F.call_function("shiftleft", F.lit(1), t)), F.lit(0)))
    )
    hashes = F.transform("_m", lambda m: F.shiftright(m, _BITS))
    some = F.size(F.array_distinct(hashes)) < F.size("_m")
    begins = F.when(some, F.aggregate(steps, head, widen))
    numbered = mers.select(*keep, "_m", begins.alias("_b"))
    order = F.transform(
        "_m",
        lambda m, i: F.xxhash64(F.shiftright(m, _BITS), F.when(F.col("_b").isNull(), 0).otherwise(i - _at(F.col("_b"), i)))
        .bitwiseAND(F.lit(~_PLACE))
        .bitwiseOR(m.bitwiseAND(F.lit(_PLACE))),
    )
    ordered = numbered.select(*keep, F.sort_array(order).alias("_o"))
    bits = 64 - (BUCKETS.bit_length() - 1)
    bucket = lambda x: F.shiftrightunsigned(x, bits)
    # the first PICKS of each class, then each class's picks by place
    first = F.filter("_o", lambda x, i: (i < PICKS) | (bucket(x) != bucket(_at(F.col("_o"), i - PICKS))))
    picked = ordered.select(*keep, first.alias("_p"))

    # each class's picks, at most two, as a tuple in text order; one alone with the first of the next class
    size = F.size("_p")
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
        lambda i: (i < size) & ((i == 0) | (bucket(_at(F.col("_p"), i)) != bucket(_at(F.col("_p"), i - 1)))),
    )

    def tuple_hash(i: Column) -> Column:
        x, y = _at(F.col("_p"), i), _at(F.col("_p"), (i + 1) % size)
        a, b = F.shiftright(x, _BITS), F.shiftright(y, _BITS)
        in_order = x.bitwiseAND(F.lit(_PLACE)) < y.bitwiseAND(F.lit(_PLACE))
        return F.when(size == 1, F.hash(a)).when(in_order, F.hash(a, b)).otherwise(F.hash(b, a))

    entry = F.transform(
        starts,
        lambda i: F.shiftleft(bucket(_at(F.col("_p"), i)), 32).bitwiseOR(tuple_hash(i).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))),
    )
    return picked.select(*keep, entry.alias(name))


def as_string(entries: Column) -> Column:
    """A fingerprint as hexadecimal text: class and hash of each entry."""
    return F.array_join(F.transform(F.array_sort(entries), lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the classes of either fingerprint in which both have the same entry."""
    classes = lambda x: F.transform(x, lambda e: F.shiftright(e, 32))
    either = F.size(F.array_union(classes(a), classes(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint string) of each document."""
    rows = fingerprint(pick(docs, doc_id="doc_id", text="text"), "text", "f")
    return rows.select("doc_id", as_string(F.col("f")).alias("fingerprint"))


def _neighbours(keys: DataFrame) -> DataFrame:
    """(id, hash, half, before_id, before_hash, before_half): each text with the one whose edit takes from it.

    Texts stand by descending id, nulls last, then by hash; the first follows
    the last.  Only ids and lengths travel: a distributed sort numbers them.
    """
    ranked = global_row_number(keys, [F.col("id").desc_nulls_last(), F.col("hash")], "rank")
    rows = keys.count()
    before = ranked.select(
        (F.col("rank") % rows + 1).alias("rank"),
        F.col("id").alias("before_id"),
        F.col("hash").alias("before_hash"),
        F.col("half").alias("before_half"),
    )
    return stored(ranked.join(before, "rank").drop("rank"))


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document, of its edited text and their likeness.

    The edited text has the last half (rounded down) of the code points
    replaced by the first as many, or all, of the next document's by
    descending doc_id.  Rows that share a doc_id stand by a hash of their
    text; repeated rows have the same next document, that of the last of them.
    """
    rows = pick(docs, id="doc_id", text="text").select(F.col("id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    keys = stored(rows.groupBy("id", "hash").agg(F.max(half).alias("half"), F.count(F.lit(1)).alias("copies")))
    links = _neighbours(keys.select("id", "hash", "half"))
    prints = fingerprint(rows, "text", "f")
    same = lambda a, b: a["id"].eqNullSafe(b["i"]) & (a["hash"] == b["h"])
    # both sides need the same columns here, so that Spark shuffles the texts once and reads them twice
    linked = links.withColumnsRenamed({"id": "i", "hash": "h"})
    known = prints.join(linked, same(prints, linked))
    given = known.select(
        F.col("before_id").alias("i"),
        F.col("before_hash").alias("h"),
        F.substring("text", F.lit(1), F.col("before_half")).alias("head"),
        F.col("f").alias("next"),
    )
    if keys.where("copies > 1").limit(1).count():
        given = given.groupBy("i", "h").agg(F.first("head").alias("head"), F.first("next").alias("next"))
    own = known.select("id", "hash", "text", "f", "half")
    joined = own.join(given, same(own, given)).select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("half")), "head").alias("edited"),
        "f",
        "next",
    )
    return fingerprint(joined, "edited", "g").select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("f")).alias("fingerprint"),
        as_string(F.col("g")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g")).alias("near_edited"),
        likeness(F.col("f"), F.col("next")).alias("near_next"),
    )
