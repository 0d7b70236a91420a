"""Benchmark decontamination with SimHash over windows as long as the items.

A benchmark item is in a document where a window of as many words is similar to it: the weighted
Jaccard similarity of their five-word shingles, each weighted by its number of occurrences, is at
least ``SIMILAR``. The steps, all of them DataFrame functions:

* Shingles are hashed in 64 bits. The items' distinct hashes go to every task, in waves of at most
  ``BROADCAST_ROWS``, and the documents' shingles that are among them are kept with their place:
  for ordinary documents that is next to nothing. The documents themselves are not stored; those
  with windows are read again.
* The first of an item's best windows begins with the text or ends at a shared shingle, as the
  window before it would share no less otherwise. So windows are only laid with their end at a
  shared shingle, wherever the item's parts stand, and only where they have as many shared places
  as the least similarity asks for. No window above it is left out.
* Each window and item gets a SimHash: in each of 256 places, the bit that outweighs among the
  shingles. A window and an item it shares places with meet through a multi-index: fingerprints
  are cut into ``RADIUS`` + 1 blocks, any two within ``RADIUS`` bits agree in a block, so equal
  blocks give all pairs within the radius. At similarity 0.8 about 37 of 256 bits differ, with a
  deviation below 6; the radius is six deviations beyond, and what it loses is below one in 10^8.
  (With 64 bits and 17 of them as the radius it was up to 6 in 1000.) Unrelated pairs differ in
  128 bits, so the radius drops them.
* The pairs left are verified by the exact similarity.

Words are runs of letters and digits in any script, lower-cased. Null or empty text: no words, no
hits. Items of fewer than five words: have no shingle and are never found. Null ids of documents:
their hits are told together under the null id. Repeated rows, repeated items: the best hit of each
pair of ids counts. Ties: the first window. Empty tables: no rows. Other columns are not read.
A row is known by its id and a 128-bit hash of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import free_name, texts
from fieldbook.session import materialise, scratch_path

SHINGLE, SIMILAR = 5, 0.8
#: Fingerprints have so many numbers of 64 bits, and may differ in so many bits.
NUMBERS, RADIUS = 4, 72
#: Tables of more rows are not broadcast.
BROADCAST_ROWS = 1_000_000
WORDS = r"[\p{L}\p{N}]+"
LOW_BITS = (1 << 32) + 1  # bit 0 and bit 32
ROW = ["r1", "r2"]


def shingle_hashes(text: Column) -> Column:
    """Hashes of a text's shingles in order; empty for fewer words than a shingle has."""
    words = F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)), lambda w: F.xxhash64(w))

    def rolled(held: Column) -> Column:
        last = F.size(held) - SHINGLE
        made = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(held, i + k) for k in range(SHINGLE)]))
        return F.when(last >= 0, made).otherwise(F.array().cast("array<long>"))

    # Bound as a lambda's argument, so that the words are cut once.
    return F.coalesce(F.transform(F.array(words), rolled)[0], F.array().cast("array<long>"))


def simhashed(rows: DataFrame, key: list[str], numbers: int = NUMBERS) -> DataFrame:
    """key and fingerprint (an array of ``numbers`` longs), from rows (key, h, weight). Two counters
    of 32 bits fit in one sum, so there are 32 sums for 64 places: i and i + 32."""
    rows = rows.select(*key, "weight", *[(F.xxhash64("h", F.lit(j)) if j else F.col("h")).alias(f"h{j}") for j in range(numbers)])
    pairs = [
        F.sum(F.shiftrightunsigned(f"h{j}", i).bitwiseAND(F.lit(LOW_BITS)) * F.col("weight")).alias(f"s{j}_{i}")
        for j in range(numbers) for i in range(32)
    ]
    sums = rows.groupBy(*key).agg(F.sum("weight").alias("total"), *pairs)
    half, made = F.col("total") / 2, []
    for j in range(numbers):
        bits = F.lit(0).cast("long")
        for i in range(32):
            for place, count in ((i, F.col(f"s{j}_{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"s{j}_{i}", 32))):
                bits = bits.bitwiseOR(F.when(count > half, F.lit(1 << place if place < 63 else -(1 << 63))).otherwise(F.lit(0)))
        made.append(bits.cast("long"))
    return sums.select(*key, F.array(*made).alias("fingerprint"))


def blocks(fingerprint: Column, numbers: int = NUMBERS) -> Column:
    """The RADIUS + 1 blocks of a fingerprint or more, none across two of its numbers: a whole number
    of the block's number and value."""
    per = -(-(RADIUS + 1) // numbers)
    base, more = divmod(64, per)
    out = []
    for j in range(numbers):
        at = 0
        for k in range(per):
            width = base + (k < more)
            value = F.shiftrightunsigned(fingerprint[j], at).bitwiseAND(F.lit((1 << width) - 1))
            out.append((F.lit((j * per + k) << 16) + value).cast("int"))
            at += width
    return F.explode(F.array(*out))


def apart(a: Column, b: Column, numbers: int = NUMBERS) -> Column:
    """The number of bits in which two fingerprints differ."""
    return sum((F.bit_count(a[j].bitwiseXOR(b[j])) for j in range(numbers)), F.lit(0))


def _bounded(table: DataFrame) -> DataFrame:
    """With a broadcast hint if it is small; the table must be stored."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _candidates(laid: DataFrame, window_marks: DataFrame, item_marks: DataFrame) -> DataFrame:
    """The pairs of ``laid`` (pair, row, size, start, item) within the radius, through the blocks."""
    window = [*ROW, "size", "start"]
    marked = materialise(laid.join(window_marks, window), "pair-marks")
    left = marked.select("pair", "item", blocks(F.col("fingerprint")).alias("b"))
    right = item_marks.select("item", blocks(F.col("fingerprint")).alias("b"))
    met = left.join(right, ["item", "b"]).select("pair").distinct()
    other = item_marks.withColumnRenamed("fingerprint", "other")
    near = marked.join(met, "pair").join(other, "item").where(apart(F.col("fingerprint"), F.col("other")) <= RADIUS)
    return near.select(*window, "item")


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word and n_words of each document's best window for each
    item that it holds."""
    spark = docs.sparkSession
    known = items.select(F.col("item_id").cast("long").alias("item_id"), shingle_hashes(F.col("text").cast("string")).alias("hashes"))
    known = materialise(known.withColumn("item", F.monotonically_increasing_id()), "items")
    listed = known.select("item", "item_id", F.size("hashes").alias("size"), F.explode("hashes").alias("h"))
    weighed = materialise(listed.groupBy("item", "item_id", "size", "h").agg(F.count("*").alias("weight")), "item-shingles")
    wanted = materialise(weighed.select("h").distinct(), "item-hashes")

    rows = texts(docs).select(
        "doc_id", "text", F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "text").alias("r1"),
        F.xxhash64("text", F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()).alias("r2"),
    )
    # The shingles of the documents that are an item's, with their places.
    hashed = rows.select("doc_id", *ROW, shingle_hashes(F.col("text")).alias("hashes"))
    # The outer form, as the other one adds a filter that makes the shingles twice.
    spread = hashed.select("doc_id", *ROW, F.size("hashes").alias("n"), F.posexplode_outer("hashes").alias("pos", "h"))
    # Hashes are dealt evenly, so half the bound as the mean keeps every wave below it.
    waves = -(-wanted.count() // max(1, BROADCAST_ROWS // 2))
    path = scratch_path(spark, "places")
    spread.select("doc_id", *ROW, "n", "pos", "h").limit(0).write.parquet(path)
    for wave in range(waves):
        some = wanted.where(F.pmod("h", F.lit(waves)) == wave) if waves > 1 else wanted
        spread.join(F.broadcast(some), "h").select("doc_id", *ROW, "n", "pos", "h").write.mode("append").parquet(path)
    met = spark.read.schema(spread.schema).parquet(path)

    places = met.join(weighed.select("item", "size", "h"), "h").groupBy(*ROW, "n", "item", "size").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    # What a similar window and item share at least, and the windows that end at a shared shingle and
    # have as many shared places.
    least = F.ceil((F.least("n", "size") + F.col("size")) * (SIMILAR / (1 + SIMILAR)) - 1e-6).cast("int")
    ends = F.filter("at", lambda p, i: F.get("at", i - F.col("least") + 1) > p - F.col("size"))
    starts = F.array_distinct(F.transform(ends, lambda p: F.greatest(p - F.col("size") + 1, F.lit(0))))
    laid = materialise(places.withColumn("least", least).select(*ROW, "item", "size", F.explode(starts).alias("start")).withColumn("pair", F.monotonically_increasing_id()), "window-starts")
    lengths = materialise(laid.select(*ROW, "size", "start").distinct(), "window-places")
    again = rows.join(_bounded(materialise(lengths.select(*ROW).distinct(), "rows")), ROW, "left_semi").dropDuplicates(ROW)
    held = again.select("doc_id", *ROW, shingle_hashes(F.col("text")).alias("hashes")).join(_bounded(lengths), ROW)
    # A window with the same shingles as the one before it cannot be the first of the best.
    same = F.coalesce(F.get("hashes", F.col("start") - 1) == F.get("hashes", F.col("start") + F.col("size") - 1), F.lit(False))
    windows = materialise(held.where(~same).select("doc_id", *ROW, "size", "start", F.slice("hashes", F.col("start") + 1, F.col("size")).alias("hashes")), "windows")

    window = [*ROW, "size", "start"]
    inside = windows.select(*window, F.explode("hashes").alias("h")).groupBy(*window, "h").agg(F.count("*").alias("weight"))
    pairs = _candidates(laid, simhashed(inside, window), simhashed(weighed, ["item"]))

    # Exact similarity: shared weight over all weight.
    shared = pairs.join(inside, window).join(weighed.withColumnRenamed("weight", "item_weight"), ["item", "size", "h"])
    common = shared.groupBy(*window, "item", "item_id").agg(F.sum(F.least("weight", "item_weight")).alias("common"))
    whole = windows.select("doc_id", *window, F.size("hashes").alias("length"))
    scored = common.join(whole, window).withColumn("similarity", F.col("common") / (F.col("length") + F.col("size") - F.col("common")))
    best = scored.where(F.col("similarity") >= SIMILAR).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", -F.col("start"), (F.col("length") + SHINGLE - 1).alias("n_words"))).alias("b"))
    return best.select("doc_id", "item_id", "b.similarity", (-F.col("b.col2")).cast("long").alias("first_word"), F.col("b.n_words").cast("long").alias("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns. An id stands for one document:
    its rows stay or go together. Rows without an id stay."""
    name = free_name(docs, "found")
    found = hits(docs, items).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, docs["doc_id"] == found[name], "left_anti")


#: The same hits by looking at every window of every document that shares a shingle with the item.
SQL = """
WITH word AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
d AS (
    SELECT r, doc_id, len(w) - 4 AS n, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM word)),
item_word AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark),
i AS (
    SELECT item, item_id, any_value(len(w) - 4) AS size, array_to_string(w[i:i + 4], ' ') AS s, count(*) AS weight
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS i FROM item_word) GROUP BY item, item_id, s),
met AS (
    SELECT r, item, any_value(size) AS size, any_value(n) AS n FROM d JOIN i USING (s) GROUP BY r, item
    HAVING count(*) >= 0.8 * any_value(least(n, size))),
place AS (
    SELECT r, item, size, least(n, size) AS length, unnest(range(0, greatest(n - size, 0) + 1)) AS start FROM met),
inside AS (
    SELECT r, item, start, s, any_value(p.size) AS size, any_value(length) AS length, count(*) AS weight, any_value(doc_id) AS doc_id
    FROM place p JOIN d USING (r) WHERE pos >= start AND pos < start + p.size GROUP BY r, item, start, s),
scored AS (
    SELECT doc_id, item_id, r, start, any_value(length) AS length, sum(least(inside.weight, i.weight)) AS common, any_value(i.size) AS size
    FROM inside JOIN i USING (item, s) GROUP BY doc_id, item_id, r, item, start),
best AS (
    SELECT doc_id, item_id, common / (length + size - common) AS similarity, start AS first_word, length + 4 AS n_words FROM scored)
SELECT doc_id, item_id, similarity, first_word, n_words::BIGINT AS n_words FROM best WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, first_word, n_words DESC) = 1
"""
