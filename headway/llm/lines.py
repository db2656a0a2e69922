"""Near-duplicate lines by an exact set-similarity join, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.llm.shared import dropped, written

#: Words of a shingle, and the similarity at which a line repeats an earlier one.
WIDTH, PERCENT = 5, 75
#: Counts from which the rarity of a shingle is read; a fixed number, whatever the input.
BUCKETS = 1 << 14
#: Level (four to a doubling) from which a bucket's shingles are taken to be shared, and dealt out over many tasks.
HOT, SALTS = 80, 1024

_PLACE = ("key", "line")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _words(lines: DataFrame) -> DataFrame:
    """Lines (key, line, text) with the hashes of their words.

    White space is made spaces first, as a split at one plain sign needs no regular expression.
    """
    text = F.lower("text")
    for sign in "\t\n\v\f\r":
        text = F.replace(text, F.lit(sign), F.lit(" "))
    words = F.array_remove(F.split(text, " "), "")
    return lines.select(*_PLACE, F.transform(words, lambda w: F.xxhash64(w)).alias("words"))


def _run(at: Column) -> Column:
    return F.xxhash64(*[F.get("words", at + j) for j in range(WIDTH)])


def _bucket(shingle: Column) -> Column:
    return F.shiftrightunsigned(shingle, 64 - BUCKETS.bit_length() + 1).cast("int")


def _with_shingles(lines: DataFrame, rarity: Column) -> DataFrame:
    """Lines (key, line, text) with their set of shingle codes, in the order of rarity.

    A code holds the level of the shingle's rarity and 56 bits of its hash, so the natural order
    of the codes is the order by rarity.  No filter may stand on the set: Spark would push it below
    and work the words out once per use.  For the same reason arrays are exploded with
    ``posexplode_outer`` and nulls dropped behind it.
    """
    hashes = _words(lines)
    n = F.size("words")
    runs = F.transform(F.sequence(F.lit(0), n - WIDTH), _run)
    shingles = F.when(n >= WIDTH, runs).when(n > 0, F.array(F.xxhash64("words"))).otherwise(F.array().cast("array<bigint>"))
    level = lambda x: F.coalesce(F.get(rarity, _bucket(x)), F.lit(0).cast("bigint"))
    coded = F.transform(F.array_distinct(shingles), lambda x: level(x) + F.shiftrightunsigned(x, 8))
    return hashes.select(*_PLACE, F.sort_array(coded).alias("set"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as ``row``, with doc_id, text and a ``key`` that orders the documents.

    The key is the doc_id; where that is null or shared, a negative hash of id and text.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.col("row")[id_col].cast("bigint").alias("doc_id"), F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")).alias("text")
    )
    shared = rows.groupBy(F.col("doc_id").alias("shared_id")).agg(F.count("*").alias("n")).where("n > 1 or shared_id is null")
    shared = written(shared.select("shared_id", F.lit(True).alias("shared")), "shared_ids")
    if shared.isEmpty():
        return rows.withColumn("key", F.col("doc_id"))
    hashed = -1 - F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    joined = rows.join(shared, F.col("doc_id").eqNullSafe(F.col("shared_id")), "left")
    return joined.select("row", "doc_id", "text", F.when(F.col("shared"), hashed).otherwise(F.col("doc_id")).alias("key"))


def _rarity(lines: DataFrame) -> Column:
    """Level of how often shingles of a bucket occur: a bounded table, held as one literal.

    A level stands in the highest byte, as it does in a code.  Shingles are counted as often as they stand in a line, in rows, for which Spark makes code.
    """
    n, at = F.size("words"), F.col("at")
    runs = _words(lines).select("words", F.posexplode_outer("words").alias("at", "word")).where((at == 0) | (at <= n - WIDTH))
    bucket = _bucket(F.when(n >= WIDTH, _run(at)).otherwise(F.xxhash64("words")))
    counts = runs.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    levels = dict(counts.select("bucket", F.least(F.floor(F.log2("n") * 4), F.lit(127)).alias("level")).collect())
    return F.expr(f"array({','.join(f'{levels.get(i, 0) << 56}L' for i in range(BUCKETS))})")


def _prefix_size(n: Column) -> Column:
    """Shingles from the rarest on of which a similar line must share one."""
    return n - F.ceil(n * PERCENT / 100).cast("int") + 1


def _may_match() -> Column:
    """Whether two lines of a bucket, the other with a leading ``y_``, may be similar by their sizes and places.

    The sizes must be near, and what lies behind the shared shingle must suffice for the overlap
    that the threshold asks for.
    """
    sized = F.least("n", "y_n") * 100 >= F.greatest("n", "y_n") * PERCENT
    reach = F.least("at", "y_at") + F.least(F.col("n") - F.col("at"), F.col("y_n") - F.col("y_at"))
    return (F.col("shingle") == F.col("y_shingle")) & sized & (reach * (100 + PERCENT) >= (F.col("n") + F.col("y_n")) * PERCENT)


def _candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of places that share a prefix shingle, the right one earlier, and may be similar.

    ``right`` has the columns of ``left`` but a leading ``y_``.  A bit that only one of two sets has
    stands for a shingle that only that set has, so the bits bound what the sets share.  All this
    is asked within the join: most pairs of a bucket are told apart there and never become rows.
    """
    earlier = F.struct("y_key", "y_line") < F.struct("key", "line")
    apart = sum(F.bit_count(F.col(f"b{j}").bitwiseXOR(F.col(f"y_b{j}"))) for j in range(4))
    size = F.col("n") + F.col("y_n")
    near = (size - apart) * (100 + PERCENT) >= size * 2 * PERCENT
    return left.join(right, earlier & _may_match() & near).select("key", "line", "y_key", "y_line").distinct()


def _with_bits(sets: DataFrame) -> DataFrame:
    """Four words of bits per set, one bit set for each of its shingles."""
    word = lambda j: F.aggregate(
        F.filter("set", lambda x: F.pmod(F.shiftright(x, 6), F.lit(4)) == j),
        F.lit(0).cast("bigint"),
        lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(x, F.lit(64)).cast("int"))),
    )
    return sets.select(*_PLACE, *[word(j).alias(f"b{j}") for j in range(4)])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Places whose whole set is similar enough to that of the earlier place of a pair."""
    # Written, so that the shuffle files of the pairs are gone when the sets come.
    near = written(pairs, "line_pairs")
    own = sets.select("key", "line", F.col("set").alias("x"))
    other = sets.select(F.col("key").alias("y_key"), F.col("line").alias("y_line"), F.col("set").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = near.join(own, list(_PLACE)).join(other, ["y_key", "y_line"]).select("key", "line", "x", "y", both.alias("both"))
    similar = joined.where(F.col("both") * 100 >= (F.size("x") + F.size("y") - F.col("both")) * PERCENT).select(*_PLACE).distinct()
    similar = written(similar, "near_lines")
    dropped(near)
    return similar


def _other(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"y_{c}") for c in df.columns])


def repeated_lines(docs: DataFrame) -> DataFrame:
    """Places (key, line) of lines that repeat an earlier one, for documents (key, text).

    1. Shingles are counted in hash buckets, which gives their order by rarity.
    2. Each line's prefix, the rarest quarter of its shingles, and hashes of its set are written.
       Only shingles that two prefixes share are kept; the rest of the join sees few lines.
    3. Lines with equal sets become one class; all but its first line are repeats.
    4. A class is held against the first of those it shares a shingle with, and where that one
       isn't similar, against every earlier one, after the length, positional and bit filters and
       on the whole sets.
    """
    split = docs.select("key", F.posexplode(_lines(F.col("text"))).alias("line", "text"))
    rarity = _rarity(split)
    n = F.size("set")
    heads = _with_shingles(split, rarity).select(
        *_PLACE, n.alias("n"), F.xxhash64("set").alias("h1"), F.xxhash64(F.lit(1), "set").alias("h2"), F.slice("set", F.lit(1), _prefix_size(n)).alias("prefix")
    )
    all_heads = written(heads, "line_heads")
    heads = all_heads.where("n > 0")
    prefix = heads.select(*_PLACE, "n", F.posexplode_outer("prefix").alias("at", "shingle"))
    # What is too frequent to gather is known from the counts: it is shared, and goes to many tasks.
    hot = F.shiftright("shingle", 56) >= HOT
    salt = F.when(hot, F.pmod(F.xxhash64(*_PLACE), F.lit(SALTS))).otherwise(F.lit(0))
    met = F.count("*").over(Window.partitionBy("shingle", "salt"))
    shared = prefix.withColumn("salt", salt).withColumn("lines", met).where(hot | (F.col("lines") > 1))
    shared = written(shared.select("shingle", *_PLACE, "n", "at"), "shared_shingles")

    # The first line of each class is found by its place: a join by the set would bring a class together.
    first = written(heads.groupBy("h1", "h2").agg(F.min(F.struct(*_PLACE)).alias("first")).select("first.*"), "first_lines")
    copies = written(heads.select(*_PLACE).join(first, list(_PLACE), "left_anti"), "line_copies")
    dropped(all_heads)
    own = written(shared.distinct().join(first, list(_PLACE), "left_semi"), "class_shingles")
    dropped(shared, first)
    # A line that no other one may match stays out, so most that share a shingle by chance cost no more.
    other = _may_match() & ((F.col("key") != F.col("y_key")) | (F.col("line") != F.col("y_line")))
    bucket = written(own.join(_other(own), other, "left_semi"), "line_buckets")
    dropped(own)

    def sets_of(places: DataFrame) -> DataFrame:
        """The whole sets of some lines, from their texts."""
        needed = places.groupBy("key").agg(F.collect_set("line").alias("lines"))
        # The same plan at every size: the places grow with the documents, so they are not broadcast.
        texts = docs.join(needed.hint("merge"), "key")
        some = texts.select("key", F.col("lines"), F.posexplode(_lines(F.col("text"))).alias("line", "text")).where(F.array_contains("lines", F.col("line")))
        return _with_shingles(some, rarity)

    classes = written(sets_of(bucket).dropDuplicates(list(_PLACE)), "line_sets")
    # The bits stand in every row of a line, so that a bucket tells its pairs apart by itself.
    marked = written(bucket.join(_with_bits(classes), list(_PLACE)), "line_bits")
    dropped(bucket)
    lead = marked.groupBy("shingle").agg(F.min(F.struct(*[c for c in marked.columns if c != "shingle"])).alias("y"), F.count("*").alias("lines"))
    lead = lead.where("lines > 1").select("shingle", "y.*")
    near = _verified(_candidates(marked, _other(lead)), classes)
    apart = marked.join(near, list(_PLACE), "left_anti")
    more = _verified(_candidates(apart, _other(marked)), classes)
    found = written(copies.unionAll(near).unionAll(more).distinct(), "repeated_lines")
    dropped(copies, marked, classes, near, more)
    return found


def _removed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents with their key, and the sorted numbers of the lines to remove by key."""
    with_key = keyed(docs, id_col, text_col)
    places = repeated_lines(with_key.select("key", "text"))
    return with_key, places.groupBy("key").agg(F.sort_array(F.collect_set("line")).alias("removed_lines"))


def line_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_lines, n_removed and removed_lines (numbers from 0).

    A line is removed if an earlier one has a similar set of shingles: 100 * common >= 75 * all.
    Earlier is a smaller doc_id, or the same document and a smaller number.  A shingle is five
    consecutive words in lower case, parted by ASCII white space; a line of fewer words is
    one shingle.  Lines without words stay.  Null text is the empty text with one empty line.
    Rows without doc_id, and rows that share one, come before all others in the order of a hash of
    id and text; rows alike in both are one document.  Other columns are ignored.
    """
    with_key, removed = _removed(docs, id_col, text_col)
    counted = with_key.select("doc_id", "key", F.size(_lines(F.col("text"))).cast("bigint").alias("n_lines"))
    none = F.array().cast("array<int>")
    return counted.join(removed, "key", "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("removed_lines"), F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("removed_lines", none).alias("removed_lines")
    )


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that ``line_repeats`` names cut from their texts; all rows stay."""
    with_key, removed = _removed(docs, id_col, text_col)
    joined = with_key.drop("text", "doc_id").join(removed, "key", "left")
    text = F.col("row")[text_col]
    kept = F.array_join(F.filter(_lines(text), lambda x, i: ~F.array_contains("removed_lines", i)), "\n")
    cut = F.when(F.col("removed_lines").isNull(), text).otherwise(kept)
    return joined.select(*[cut.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
