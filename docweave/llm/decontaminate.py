"""Operator 10, benchmark decontamination (DataFrame functions only).

Texts become lower-case words (runs of letters and digits) and hashes of 5-word shingles;
a shingle's weight is how often it occurs.  An item with W shingles is compared with
windows of W shingles of a document (the whole document if it is shorter); the
document is contaminated if some window's weighted Jaccard similarity,
sum of smaller over sum of larger weights, is at least 0.8.

1. Sieve, without loss: a similar window has at least 80 (W + W') / 180 positions whose
   shingle the item has too, so a document needs that many, and of all windows only those
   that start at such a position (or end with the document) can be best, because
   moving a window's start over other positions never loses a common shingle.
2. The remaining windows and the items get a 64-bit SimHash of their weighted shingles.  Eight
   8-bit blocks are indexed with up to two errors each, which finds every pair of fingerprints
   within a distance of 23 (pigeonhole: only a farther pair can have three errors in every block).
   At similarity 0.8 9.7 bits differ on average and more than 23 in fewer than one pair of 10,000; of
   unrelated pairs 1.6 % lie within the radius.
3. Pairs within the radius are verified by the exact weighted similarity.

The items' shingles are broadcast only if counted and at most ``BROADCAST_ROWS``; otherwise
the join shuffles.  Lists of documents grow with the corpus and are never broadcast.

Defined results: texts with fewer than five words are one shingle, the whole sequence, so
they match only equal ones; null and empty texts and items match nothing; rows that repeat
an id are judged by their own text; null ids are judged as well; without items or
documents the result has no hit; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import saved

SHINGLE = 5
PERCENT = 80
BLOCKS, BLOCK_BITS, BLOCK_ERRORS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_ERRORS + 1) - 1
BROADCAST_ROWS = 2_000_000


def shingles(text: Column) -> Column:
    """Shingle hashes in text order.  The words are bound to a lambda variable, so they are split once."""
    words = F.array_remove(F.split(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "), " "), "")
    return F.transform(F.array(words), lambda w: F.when(
        F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(
            *[F.get(w, i + j) for j in range(SHINGLE)]))).when(
        F.size(w) > 0, F.array(F.xxhash64(F.lit("short"), F.array_join(w, " ")))).otherwise(F.array().cast("array<long>")))[0]


def needed(size: str, own: str) -> Column:
    """Least common weight for the threshold, given the two sides' weights."""
    return F.expr(f"ceil({PERCENT} * ({size} + {own}) / {100 + PERCENT})")


def fingerprints(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash per key of rows (keys, h, weight): bit b is set if the weights with bit b outweigh the others."""
    sums = [F.sum(F.when(F.expr(f"shiftright(h, {b}) & 1L") == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"b{b}")
            for b in range(64)]
    bits = [F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(64)]
    return weighted.groupBy(*keys).agg(*sums).select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("print"))


def blocks(prints: DataFrame, errors: int) -> DataFrame:
    """One row per block and admissible block value."""
    masks = [m for m in range(1 << BLOCK_BITS) if bin(m).count("1") <= errors]
    assert len(masks) == sum(comb(BLOCK_BITS, e) for e in range(errors + 1))
    out = prints.withColumn("block", F.explode(F.array(*[F.lit(b) for b in range(BLOCKS)])))
    value = F.expr(f"shiftright(print, {BLOCK_BITS} * block) & {(1 << BLOCK_BITS) - 1}L")
    if errors:
        out = out.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        value = value.bitwiseXOR(F.col("mask"))
    return out.withColumn("value", value).drop("mask")


def first_block(block: str) -> Column:
    """The first block of the pair's fingerprints within the errors is this one, so a pair is met once."""
    low = (1 << BLOCK_BITS) - 1
    cases = " ".join(f"WHEN bit_count(shiftrightunsigned(x.print ^ y.print, {BLOCK_BITS * b}) & {low}L) <= {BLOCK_ERRORS} THEN {b}"
                     for b in range(BLOCKS))
    return F.expr(f"(CASE {cases} END) = {block}")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start): the best window of each document and item
    that reaches the threshold; ``start`` counts words."""
    items = saved(benchmark.select(benchmark[item_col].cast("long").alias("item_id"), shingles(benchmark[item_text]).alias("hs"))
                  .withColumn("size", F.size("hs")).filter("size > 0"))
    item_rows = saved(items.select("item_id", "size", F.explode("hs").alias("h"))
                      .groupBy("item_id", "size", "h").agg(F.count("*").alias("weight")))
    small = item_rows.count() <= BROADCAST_ROWS
    lookup = F.broadcast(item_rows) if small else item_rows
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_hash"),
                         docs[text_col].alias("text"))
    key = ["doc_id", "text_hash"]
    hashed = source.select(*key, shingles(F.col("text")).alias("hs"))
    # 1. Sieve.
    hits = (hashed.select(*key, F.size("hs").alias("own_all"), F.posexplode("hs").alias("pos", "h"))
            .join(lookup.select("item_id", "size", "h"), "h"))
    counted = (hits.groupBy(*key, "own_all", "item_id", "size").agg(F.collect_set("pos").alias("places"))
               .withColumn("own", F.least("size", "own_all"))
               .filter(F.size("places") >= needed("size", "own")))
    windows = saved(counted
                    .select(*key, "item_id", "size", "own", "places", F.explode(F.array_distinct(F.transform(
                        "places", lambda p: F.least(p, F.col("own_all") - F.col("own"))))).alias("start"))
                    .filter(F.size(F.filter("places", lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("own"))))
                            >= needed("size", "own"))
                    .select(*key, "start", "own", "size").distinct())
    # 2. Fingerprints of the windows and the multi-index join.
    listed = windows.groupBy(*key).agg(F.collect_set(F.struct("start", "own", "size")).alias("windows"))
    wanted = listed.select(F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash"), "windows").hint("merge")
    found = (source.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")))
             .dropDuplicates(key)
             .select(*key, "windows", shingles(F.col("text")).alias("hs"))
             .select(*key, "hs", F.explode("windows").alias("w"))
             .select(*key, "w.*", F.explode(F.slice("hs", F.col("w.start") + 1, F.col("w.own"))).alias("h")))
    place = [*key, "start", "own", "size"]
    weighted = saved(found.groupBy(*place, "h").agg(F.count("*").alias("weight")))
    x = blocks(fingerprints(weighted, place), 0).alias("x")
    y = blocks(fingerprints(item_rows, ["item_id", "size"]), BLOCK_ERRORS).alias("y")
    near = (x.join(y, (F.col("x.size") == F.col("y.size")) & (F.col("x.block") == F.col("y.block"))
                   & (F.col("x.value") == F.col("y.value")) & first_block("x.block")
                   & (F.expr("bit_count(x.print ^ y.print)") <= RADIUS))
            .select(*[F.col(f"x.{c}").alias(c) for c in place], F.col("y.item_id").alias("item_id")))
    # 3. Exact weighted similarity.
    w, p, t = weighted.alias("w"), near.alias("p"), item_rows.alias("t")
    common = (p.join(w, F.col("p.doc_id").eqNullSafe(F.col("w.doc_id"))
                     & (F.col("p.text_hash") == F.col("w.text_hash")) & (F.col("p.start") == F.col("w.start"))
                     & (F.col("p.own") == F.col("w.own")) & (F.col("p.size") == F.col("w.size")))
              .join(t, (F.col("p.item_id") == F.col("t.item_id")) & (F.col("w.h") == F.col("t.h")))
              .groupBy(*[F.col(f"p.{c}").alias(c) for c in place], F.col("p.item_id").alias("item_id"))
              .agg(F.sum(F.least("w.weight", "t.weight")).alias("common")))
    scored = (common.withColumn("similarity", F.col("common") / (F.col("own") + F.col("size") - F.col("common")))
              .filter(F.col("common") * 100 >= (F.col("own") + F.col("size") - F.col("common")) * PERCENT))
    best = scored.groupBy(*key, "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    return best.select(*key, "item_id", "best.similarity", (-F.col("best.back")).alias("start"))


def report(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_id and similarity of the best match."""
    hits = saved(contaminated(docs, benchmark, **columns))
    best = hits.groupBy(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash")).agg(
        F.count("*").alias("n_items"), F.max(F.struct("similarity", (-F.col("item_id")).alias("minus"))).alias("best")).hint("merge")
    rows = docs.select(docs[columns.get("id_col", "doc_id")].cast("long").alias("doc_id"),
                       F.xxhash64(docs[columns.get("text_col", "text")]).alias("text_hash"))
    joined = rows.join(best, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")), "left")
    return joined.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"),
                         F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                         (-F.col("best.minus")).alias("item_id"), F.col("best.similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    hits = saved(contaminated(docs, benchmark)).select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash")).distinct().hint("merge")
    return docs.alias("d").join(hits.alias("x"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("x.h_id")) & (
        F.xxhash64("d.text") == F.col("x.h_hash")), "left_anti")


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Every window that holds a common shingle, compared directly.
ORACLE = f"""
WITH RECURSIVE base AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
items AS (SELECT item_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT doc_id, CASE WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
       WHEN len(w) > 0 THEN ['# ' || array_to_string(w, ' ')] ELSE [] END AS s FROM base),
its AS (SELECT item_id, CASE WHEN len(w) >= {SHINGLE} THEN list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))
       WHEN len(w) > 0 THEN ['# ' || array_to_string(w, ' ')] ELSE [] END AS s FROM items),
dp AS (SELECT doc_id, len(s) AS n, unnest(s) AS h, generate_subscripts(s, 1) - 1 AS p FROM ds),
ip AS (SELECT item_id, m, h, count(*) AS c FROM (SELECT item_id, len(s) AS m, unnest(s) AS h FROM its) GROUP BY ALL),
hit AS (SELECT doc_id, n, p, h, item_id, m, c, least(n, m) AS o FROM dp JOIN ip USING (h)),
st AS (SELECT DISTINCT doc_id, item_id, n, m, o, unnest(range(greatest(0, p - o + 1), least(p, n - o) + 1)) AS s FROM hit),
cw AS (SELECT st.doc_id, st.item_id, st.m, st.o, st.s, hit.h, least(count(*), any_value(c)) AS k
       FROM st JOIN hit ON st.doc_id = hit.doc_id AND st.item_id = hit.item_id AND hit.p >= st.s AND hit.p < st.s + st.o GROUP BY ALL),
sim AS (SELECT doc_id, item_id, s, sum(k) / (m + o - sum(k)) AS similarity FROM cw GROUP BY doc_id, item_id, s, m, o HAVING sum(k) * 100 >= (m + o - sum(k)) * {PERCENT}),
bi AS (SELECT doc_id, item_id, max(similarity) AS similarity FROM sim GROUP BY ALL),
bd AS (SELECT doc_id, count(*) AS n_items, max(similarity) AS top FROM bi GROUP BY doc_id)
SELECT documents.doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
       (SELECT min(item_id) FROM bi WHERE bi.doc_id = documents.doc_id AND bi.similarity = bd.top) AS item_id, top AS similarity
FROM documents LEFT JOIN bd USING (doc_id)
"""
