"""Threshold-scaled document fingerprints: every shingle hash below a fixed fraction of all hashes.

How many hashes a fingerprint keeps follows the text's length, so fingerprints of very unequal texts
can be compared: what share of one lies in the other estimates containment without bias. The
fingerprint of texts put together (shingles across the seam aside) is the union of theirs. All
expressions are Spark's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 5
#: One hash in so many is kept. Documents are as short as one shingle, of which any fraction loses all or
#: nothing, so texts are compared by all of theirs; thin long texts, or what is put together of many.
SCALE = 1
_SPACES = r"[\x20\x09-\x0D]+"
#: Rows per range of neighbours, and the most ranges (one row of each passes through one task).
GROUP, MOST_GROUPS = 1000, 200_000
#: So many sampled rows per range make their sizes even.
SAMPLED = 8


def sketch(text: Column, width: int = WIDTH, scale: int = SCALE) -> Column:
    """The fingerprint: distinct kept hashes in order, as an array of longs.

    Shingles are ``width`` consecutive words (runs of non-space characters, unchanged); a text of
    fewer words, but not none, is one shingle. Null or empty text gives an empty array.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), _SPACES), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _kept(hashes, width, (1 << 63) - (1 << 64) // scale)


def _kept(hashes: Column, width: int, bound: int) -> Column:
    # The array is bound by a one-element transform, so it is computed once for all shingles.
    def shingles(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(
            F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[h[i + k] for k in range(width)])
        )
        few = F.when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(n >= width, many).otherwise(few)

    whole = F.transform(F.array(hashes), shingles)[0]
    return F.array_sort(F.array_distinct(F.filter(whole, lambda x: x >= F.lit(bound))))


def merge(a: Column, b: Column) -> Column:
    """The fingerprint of both sets of shingles."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Which share of a's shingles b has (estimate). An empty fingerprint lies in any."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column, alike: Column | bool = True) -> Column:
    """Jaccard similarity (estimate), 0 to 1; of two empty fingerprints 1 if their texts are ``alike``, else 0.

    Without thinning only texts without words have empty ones, and these are alike.
    """
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    same = alike if isinstance(alike, Column) else F.lit(alike)
    return F.when(either > 0, both / either).otherwise(same.cast("double"))


def _alike(a: Column, b: Column) -> Column:
    """Whether texts with empty fingerprints are alike: equal, or without words."""
    wordless = [~F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")) for x in (a, b)]
    return (a == b) | (wordless[0] & wordless[1])


def to_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _ranges(source: DataFrame) -> Column:
    """The number of the range a row lies in, by id and then digest of the text: ranges of about GROUP rows
    each, whatever the ids are.

    Their bounds are every SAMPLED-th of the rows that a hash of id and text picks. A row's range is
    found by the bounds' bounds first, so the work for a row grows with the root of their number.
    """
    n = source.count()
    groups = max(1, min(MOST_GROUPS, n // GROUP))
    key = F.struct(F.col("id"), F.md5("text").alias("digest"))
    if groups == 1:
        return F.lit(0).alias("part")
    of = 1 << 40
    picked = F.pmod(F.xxhash64(key["id"], key["digest"]), F.lit(of)) < min(of, of * SAMPLED * groups // n)
    bounds = (
        source.where(picked).select(key.alias("key")).distinct().agg(F.sort_array(F.collect_list("key")).alias("b"))
        .selectExpr(f"filter(b, (x, i) -> i % {SAMPLED} = {SAMPLED - 1}) AS b")
        .selectExpr("b", "greatest(1, CAST(ceil(sqrt(size(b))) AS int)) AS s")
        .selectExpr("s", "filter(b, (x, i) -> i % s = 0) AS heads", "b")
        .selectExpr("s", "heads", "transform(heads, (x, i) -> slice(b, i * s + 1, s)) AS lists")
    )
    as_json = F.to_json(F.struct("heads", "lists"))
    kind = bounds.select("heads", "lists").schema
    step, told = bounds.select("s", as_json).first()
    # The planner reads the text once, so the tasks get the arrays.
    known = F.from_json(F.lit(told), kind)
    heads, lists = known["heads"], known["lists"]
    head = F.size(F.filter(heads, lambda x: x <= key))
    # A one-element transform binds the number of heads, so it is counted once.
    part = F.transform(F.array(head), lambda h: F.when(h == 0, 0).otherwise((h - 1) * step + F.size(F.filter(F.get(lists, h - 1), lambda x: x <= key))))
    # Never null, so that joins by it filter nothing and one shuffle of the texts serves them all.
    return F.coalesce(part[0], F.lit(0)).alias("part")


def _neighbours(source: DataFrame) -> DataFrame:
    """(id, text, next_text): each document beside its next one in descending order of id, after the last
    the first.

    There is a range for each thousand rows, 200,000 at most; one narrow row of each passes through
    one task. Of equal ids the order is by digest of the text; null ids come last.
    """
    part = _ranges(source)
    inside = Window.partitionBy("part").orderBy(F.col("id").desc_nulls_last(), F.md5("text").desc())
    chained = source.select("*", part).withColumn("next_text", F.lead("text").over(inside))
    firsts = source.groupBy(part).agg(F.max(F.struct("id", F.md5("text").alias("digest"), "text")).alias("first"))
    down = Window.orderBy(F.col("part").desc())
    below = F.coalesce(F.lead("part").over(down), F.max("part").over(down))
    linked = source.groupBy(part).agg(F.count("*")).select("part", below.alias("below"))
    nexts = firsts.select(F.col("part").alias("below"), F.col("first.text").alias("first_text"))
    ends = chained.where("next_text IS NULL").join(linked.join(nexts, "below"), "part")
    return chained.where("next_text IS NOT NULL").select("id", "text", "next_text").unionByName(
        ends.select("id", "text", F.col("first_text").alias("next_text"))
    )


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """One row per document: (<id>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next).

    The edited text has the last third (rounded down, in code points) replaced by as many first code
    points of the next document, or all if it has fewer. A single document is its own next one.
    Null text is empty. Repeated rows follow each other. Ids are integers. Other columns are not looked
    at. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    both = _neighbours(source)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    changed = both.withColumns({"n_chars": n.cast("long"), "edited": edited})
    # Texts are shuffled bare: fingerprints are larger, and made where they are needed.
    done = changed.withColumns({f"{x}_print": sketch(F.col(x), width, scale) for x in ("text", "next_text", "edited")})
    return done.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        to_text(F.col("text_print")).alias("fingerprint"),
        to_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("text_print"), F.col("edited_print"), _alike(F.col("text"), F.col("edited"))).alias("near_edited"),
        likeness(F.col("text_print"), F.col("next_text_print"), _alike(F.col("text"), F.col("next_text"))).alias("near_next"),
    )
