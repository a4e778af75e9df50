"""Benchmark passages in documents: a prefix-filtered set join over item-sized windows.

A window of an item occurs in a document only if all its shingles do, so one of them, its rarest over
all documents, is a sufficient prefix: documents are joined on it, the place of the window follows from
the place of the shingle, windows that would begin before or end beyond the document are out, and the
words at the place are compared with the window's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.text import alphanumeric_words, is_small, small_side
from plumbline.session import materialise

WINDOW_WORDS = 13
#: A document is contaminated when at least one in so many of its words is hit.
ONE_IN = 20
SHINGLE_WORDS = 2

ROW = ["id", "text_hash"]


def item_windows(items: DataFrame, window_words: int) -> DataFrame:
    """(item, words, n) of every window of (id, text) items; a shorter item is one window."""
    words = items.select(F.col("id").alias("item"), alphanumeric_words("text").alias("all_words"))
    n = F.least(F.lit(window_words), F.size("all_words"))
    starts = F.sequence(F.lit(1), F.size("all_words") - n + 1)
    return words.where(F.size("all_words") > 0).select(
        "item", "all_words", n.alias("n"), F.explode(starts).alias("start")
    ).select("item", F.slice("all_words", F.col("start"), F.col("n")).alias("words"), "n").distinct()


def _shingle(words: str, place: Column, size: int) -> Column:
    """Hash of ``size`` words from a place (from 0); null where they would end beyond."""
    parts = [F.get(words, place + k) for k in range(size)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(size), *parts))


def _words(documents: DataFrame) -> DataFrame:
    return documents.select("id", F.xxhash64("text").alias("text_hash"), alphanumeric_words("text").alias("words"))


def _places(documents: DataFrame, sizes: list[int]) -> DataFrame:
    """(id, text_hash, words, place, shingle) of every shingle of the given sizes."""
    placed = _words(documents).select(*ROW, "words", F.posexplode_outer("words").alias("place", "word"))
    if len(sizes) == 1:
        return placed.withColumn("shingle", _shingle("words", F.col("place"), sizes[0]))
    each = F.array(*[_shingle("words", F.col("place"), size) for size in sizes])
    return placed.withColumn("shingle", F.explode(each))


def _candidates(documents: DataFrame, sizes: list[int], prefixes: DataFrame) -> DataFrame:
    """(id, text_hash, start, n, window): what stands where a prefix (shingle, ahead, n) puts a window.

    Prefixes that are too many to broadcast are joined with places alone: a document's words are not
    shuffled with each of them, but meet the starts found in it once, where these are cut out.
    """
    start = F.col("place") - F.col("ahead")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    places = _places(documents, sizes).withColumn("n_words", F.size("words"))
    if is_small(prefixes):
        starts = places.join(F.broadcast(prefixes), "shingle").where(inside).withColumn("start", start)
    else:
        found = places.select(*ROW, "place", "shingle", "n_words").join(prefixes, "shingle").where(inside)
        found = found.groupBy(*ROW).agg(F.collect_set(F.struct(start.alias("start"), "n")).alias("starts"))
        found = found.withColumnsRenamed({"id": "own_id", "text_hash": "own_hash"})
        same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
        starts = _words(documents).join(found, same).select(*ROW, "words", F.inline("starts"))
    window = F.concat_ws(" ", F.slice("words", F.col("start") + 1, F.col("n")))
    return starts.select(*ROW, "start", "n", window.alias("window"))


def occurrences(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, text_hash, start, n, window) where a window (text, n, words) occurs in a document."""
    size = F.least(F.col("n"), F.lit(SHINGLE_WORDS))
    sizes = [row[0] for row in windows.select(size).distinct().collect()]  # one or two numbers
    if not sizes:
        empty = documents.limit(0).select("id", F.xxhash64("text").alias("text_hash"))
        return empty.selectExpr("*", "0 AS start", "0 AS n", "'' AS window")

    def at_size(k: int) -> DataFrame:
        own = windows.where(size == k)
        places = F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("place")
        return own.select("window", "words", "n", places).select(
            "window", "n", "place", _shingle("words", F.col("place"), k).alias("shingle")
        )

    shingles = at_size(sizes[0])
    for k in sizes[1:]:
        shingles = shingles.union(at_size(k))
    shingles = materialise(shingles, "shingles")

    known = small_side(shingles.select("shingle").distinct())
    frequency = _places(documents, sizes).join(known, "shingle").groupBy("shingle").agg(
        F.count("*").alias("frequency")
    )
    frequency = materialise(frequency, "frequency")
    # A window with a shingle that no document has joins to nothing here and is out.
    ranked = shingles.join(frequency, "shingle", "left").fillna(0, ["frequency"])
    rarest = ranked.groupBy("window", "n").agg(
        F.min(F.struct("frequency", "place", "shingle")).alias("rarest")
    ).where("rarest.frequency > 0")
    prefixes = materialise(
        rarest.select("rarest.shingle", F.col("rarest.place").alias("ahead"), "n").distinct(), "prefixes"
    )

    candidates = _candidates(documents, sizes, prefixes)
    return candidates.join(small_side(windows.select("window", "n")), ["window", "n"]).select(
        *ROW, "start", "n", "window"
    )


def contamination(
    documents: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", window_words: int = WINDOW_WORDS,
    one_in: int = ONE_IN,
) -> DataFrame:
    """Of each row of documents: its id, n_words, n_hit, n_items, items (sorted as text), contaminated.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. A window is ``window_words``
    consecutive words of an item, or all of a shorter one. A word inside any occurrence of a window is
    hit. A document is contaminated when at least one in ``one_in`` of its words is hit. Null and empty
    texts have no words and are never contaminated; items without words have no windows. Items without
    an id hit words but are not counted or listed; repeated items count once. Repeated documents come
    back as often as they occur, each with its own result; rows that share an id but not the text are
    judged alone. No items: nothing is hit. Other columns are not read.
    """
    documents = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    items = items.select(F.col(item_column).alias("id"), F.col(item_text_column).cast("string").alias("text"))
    own = item_windows(items, window_words)
    own = materialise(own.withColumn("window", F.concat_ws(" ", "words")), "item-windows")
    found = materialise(occurrences(documents, own.select("window", "n", "words").distinct()), "occurrences")

    so_far = Window.partitionBy(*ROW).orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    fresh = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(so_far), F.col("start")))
    hit = found.select(*ROW, "start", "n").distinct().select(
        *ROW, F.greatest(fresh, F.lit(0)).alias("fresh")
    ).groupBy(*ROW).agg(F.sum("fresh").alias("n_hit"))

    listed = found.select(*ROW, "window").distinct().join(
        small_side(own.where("item IS NOT NULL").select("window", F.col("item").cast("string"))), "window"
    ).select(*ROW, "item").distinct().groupBy(*ROW).agg(F.sort_array(F.collect_list("item")).alias("items"))

    rows = documents.select(
        "id", F.xxhash64("text").alias("text_hash"),
        F.size(alphanumeric_words("text")).cast("long").alias("n_words"),
    )
    for side in (hit, listed):
        side = side.select(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"), side.columns[-1])
        same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash"))
        rows = rows.join(side, same, "left").drop("own_id", "own_hash")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("id").alias(id_column), "n_words", n_hit.alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"), items_found.alias("items"),
        ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
