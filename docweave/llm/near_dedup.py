"""Operator 6, near-duplicate classes by MinHash and a multi-index Hamming join.

1. One map computes per text its set of k-word shingles (64-bit hashes), an
   order-free 128-bit digest of the set, and a signature of 24 MinHash values of 16 bits.
   Texts with equal sets are linked at once; one representative (smallest id) goes on.
2. Signatures are cut into 8 chunks of 3 values.  Two signatures that differ in at most
   15 values differ in at most one value of some chunk (pigeonhole), so they share that
   chunk with one value masked: 24 keys per signature find every such pair.  At Jaccard
   0.8 a pair differs in 4.8 values on average and shares no key with a chance of 1e-6.
3. Groups of near copies are not expanded into pairs.  First every member
   is compared with a centre, the key's most popular member.  Only keys whose members are not
   all linked to one centre go on.
4. Of their members, texts that cannot have a partner are dropped: a shingle that no other
   remaining text has lies in no intersection, so if fewer than 80 % of the shingles are shared,
   no link is possible.  Heavily edited copies and texts that share only a common passage go here.
   Then the members meet the centres with the highest share of shared shingles, that is, those
   closest to what the group has in common; the links so far are joined into components.
5. The remaining cross-component pairs are compared, each once (under its first common
   key) and only if the prefix filter admits them (two sets that overlap enough share one of
   their rarest shingles), and components are formed again.

Links are always confirmed on the full shingle sets.  Nothing is capped: a key's members
are joined by an equality join that adaptive execution may split.

Defined results: null and empty texts have no shingles and are linked with nothing; a text with
fewer than k words is one shingle, its whole sequence; rows with a null id get a null
component and stay; rows that repeat an id form one node; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import CHUNK_BYTES, U64, chunks, distinct_rows, mix, shingle_hashes, text_arrays, word_hashes
from .graph import components
from .work import id_and_text, saved

VALUES, WIDTH = 24, 3  # signature values, values per chunk
VALUE_BITS, LANE_BITS = 20, 21  # a chunk is one long of three lanes; a lane's top bit stays free
MOST_DIFFERENT = 2 * (VALUES // WIDTH) - 1  # below two errors in every chunk
LANES = [f"s{i}" for i in range(VALUES // WIDTH)]
SEEDS = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 3, 1 << 64) for i in range(VALUES)], dtype=U64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    words, first = word_hashes(raw, offsets)
    return distinct_rows(*shingle_hashes(words, first, k))


def signatures(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x 8) chunks of three 20-bit MinHash values, and (rows x 2) digests of the sets; zero for empty sets."""
    rows = len(first) - 1
    lanes, digest = np.zeros((rows, len(LANES)), dtype=U64), np.zeros((rows, 2), dtype=U64)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        at = first[:-1][some]
        for i, seed in enumerate(SEEDS):
            value = mix(np.minimum.reduceat(mix(sets * seed), at)) >> U64(64 - VALUE_BITS)
            lanes[some, i // WIDTH] |= value << U64(LANE_BITS * (i % WIDTH))
        digest[some, 0] = np.add.reduceat(mix(sets + U64(1)), at)
        digest[some, 1] = np.add.reduceat(mix(sets ^ U64(0x5851F42D4C957F2D)), at)
    return lanes, digest


def sketch(texts: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            for i, j in chunks(off, CHUNK_BYTES):
                sets, first = shingle_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], k)
                lanes, digest = signatures(sets, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first)), *[pa.array(digest[:, c].view(np.int64)) for c in (0, 1)],
                     *[pa.array(np.ascontiguousarray(lanes[:, c]).view(np.int64)) for c in range(len(LANES))]],
                    names=["doc_id", "n_shingles", "d0", "d1", *LANES])

    return texts.mapInArrow(run, "doc_id long, n_shingles long, d0 long, d1 long, " + ", ".join(f"{x} long" for x in LANES))


def index_keys(reps: DataFrame) -> DataFrame:
    """24 rows per signature: key, slot (chunk * 3 + masked choice), and the signature's row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = U64((1 << VALUE_BITS) - 1)
        for batch in batches:
            for slot in range(VALUES):
                chunk, choice = divmod(slot, WIDTH)
                lanes = batch.column(2 + chunk).to_numpy().view(U64)
                a, b = list(combinations(range(WIDTH), WIDTH - 1))[choice]
                first, second = ((lanes >> U64(LANE_BITS * x)) & one for x in (a, b))
                key = mix((first << U64(VALUE_BITS)) + second + U64(slot + 1 << 2 * VALUE_BITS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(key), slot, np.int32)), batch.column(0)],
                    names=["key", "slot", "node"])

    return reps.select("node", "n", *LANES).mapInArrow(run, "key long, slot int, node long")


def lanes_mask(bit: int) -> int:
    return sum(bit << LANE_BITS * i for i in range(WIDTH))


def differing(chunk: int) -> str:
    """SQL: number of differing values in a chunk of the signatures x and y.

    Adding all ones to a lane carries into its free top bit exactly if the lane is not zero."""
    full, top = lanes_mask((1 << VALUE_BITS) - 1), lanes_mask(1 << VALUE_BITS)
    return f"bit_count(((x.s{chunk} ^ y.s{chunk}) + {full}L) & {top}L)"


def distance() -> Column:
    return F.expr(" + ".join(differing(c) for c in range(len(LANES))))


def first_common_key(slot: str) -> Column:
    """The pair's first common key is the one of ``slot``, so a pair is met once.  A chunk with one
    differing value is shared under the one key that masks it, an equal chunk under all three."""
    cases = " ".join(f"WHEN {differing(c)} = 0 THEN {slot} = {WIDTH * c} WHEN {differing(c)} = 1 THEN {slot} DIV {WIDTH} = {c}"
                     for c in range(len(LANES)))
    return F.expr(f"CASE {cases} ELSE false END")


def linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have Jaccard >= percent / 100."""
    side = lambda name: texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw_a, off_a = text_arrays(batch.column(2))
            raw_b, off_b = text_arrays(batch.column(3))
            for i, j in chunks(off_a + off_b, CHUNK_BYTES):
                a, at_a = shingle_sets(raw_a[off_a[i]:off_a[j]], off_a[i:j + 1] - off_a[i], k)
                b, at_b = shingle_sets(raw_b[off_b[i]:off_b[j]], off_b[i:j + 1] - off_b[i], k)
                both = np.fromiter((len(np.intersect1d(a[at_a[r]:at_a[r + 1]], b[at_b[r]:at_b[r + 1]], assume_unique=True))
                                    for r in range(j - i)), dtype=np.int64, count=j - i)
                union = np.diff(at_a) + np.diff(at_b) - both
                good = pa.array((100 * both >= percent * union) & (union > 0))
                yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, j - i).filter(good) for c in (0, 1)], names=["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def shingle_rows(texts: DataFrame, k: int) -> DataFrame:
    """One row (h, node) per distinct shingle of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            nodes = batch.column(0).to_numpy()
            for i, j in chunks(off, CHUNK_BYTES):
                sets, first = shingle_sets(raw[off[i]:off[j]], off[i:j + 1] - off[i], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.view(np.int64)), pa.array(np.repeat(nodes[i:j], np.diff(first)))], names=["h", "node"])

    return texts.select("node", "text").mapInArrow(run, "h long, node long")


def unique_shingles(texts: DataFrame, k: int) -> DataFrame:
    """(node, n_unique): shingles that no other of the texts has."""
    return (shingle_rows(texts, k).groupBy("h").agg(F.count("*").alias("df"), F.min("node").alias("node"))
            .filter("df = 1").groupBy("node").agg(F.count("*").alias("n_unique")))


def rarest_first(texts: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, rare): a text's rarest shingles among the texts, as many as a partner of any size could lack, plus one.

    31 bits of each hash are kept: the prefix filter may then pass a pair too many, never one too few."""
    rows = saved(shingle_rows(texts, k))
    ranked = (rows.join(rows.groupBy("h").agg(F.count("*").alias("df")), "h")
              .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("all")))
    return ranked.join(nodes.select("node", "n"), "node").select(
        "node", F.expr(f"transform(slice(all, 1, int(n - ceil({percent} * n / 100) + 1)), s -> int(s.h & 2147483647))").alias("rare"))


def common_prefix(percent: int) -> Column:
    """Prefix filter: sets that overlap in at least m shingles share one of the rarest n - m + 1 of each."""
    needed = f"ceil({percent} * (x.n + y.n) / {100 + percent})"
    return F.expr(f"arrays_overlap(slice(x.rare, 1, int(x.n - {needed} + 1)), slice(y.rare, 1, int(y.n - {needed} + 1)))")


def mixed_keys(members: DataFrame) -> DataFrame:
    """The members of keys whose members lie in more than one component."""
    keys = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    return members.join(keys, "key", "left_semi")


def similar_size(percent: int) -> Column:
    return F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")


def only(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of the nodes.  The list grows with the corpus, so it is never broadcast."""
    return texts.join(nodes.select("node").hint("merge"), "node", "left_semi")


def placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, slot, node, component); a node that is not in ``found`` is its own component."""
    own = found.withColumnRenamed("component", "own")
    return members.join(own, "node", "left").select("key", "slot", "node", F.coalesce("own", "node").alias("component"))


def star_pairs(members: DataFrame, nodes: DataFrame, score: str, percent: int) -> DataFrame:
    """Pairs (node, centre): every key has one centre, its member of the highest ``score``; a node
    meets the closest and the highest of the centres of its keys that lie in other components."""
    scored = members.join(nodes.select("node", score), "node")
    centres = (scored.groupBy("key").agg(F.max(F.struct(score, (-F.col("node")).alias("minus"), "component")).alias("top"))
               .select("key", F.col(f"top.{score}").alias("height"), (-F.col("top.minus")).alias("centre"), F.col("top.component").alias("far")))
    star = members.join(centres, "key").filter("component <> far").select("node", "centre", "height").distinct()
    x, y = nodes.alias("x"), nodes.alias("y")
    differ = distance()
    best = (star.join(x, F.col("x.node") == star["node"]).join(y, F.col("y.node") == star["centre"]).filter(similar_size(percent))
            .groupBy(star["node"].alias("a"))
            .agg(F.min(F.struct(differ.alias("d"), star["centre"].alias("b"))).alias("near"),
                 F.max(F.struct("height", (-star["centre"]).alias("minus"))).alias("high")))
    return best.select("a", F.explode(F.array_distinct(F.array(F.col("near.b"), -F.col("high.minus")))).alias("b"))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    texts = id_and_text(docs, id_col, text_col)
    rows = saved(sketch(texts, k))
    group = ["n_shingles", "d0", "d1"]
    reps = saved(rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*group)
                 .agg(F.min("doc_id").alias("node"), *[F.max(x).alias(x) for x in LANES])
                 .withColumnRenamed("n_shingles", "n"))
    keys = index_keys(reps)
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = saved(keys.join(sizes, "key"))
    popular = members.groupBy("node").agg(F.sum("size").alias("weight"))
    signed = saved(popular.join(reps.select("node", "n", *LANES), "node"))
    active = saved(only(texts.withColumnRenamed("doc_id", "node"), signed))

    edges = saved(linked(star_pairs(members.withColumn("component", F.col("node")), signed, "weight", percent), active, k, percent))
    nearby = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    left = saved(mixed_keys(placed(members, nearby)))
    nodes = left.select("node").distinct()
    shares = saved(nodes.join(unique_shingles(only(active, nodes), k), "node", "left")
                   .join(signed.select("node", "n", *LANES), "node")
                   .withColumn("shared", F.col("n") - F.coalesce("n_unique", F.lit(0)))
                   .withColumn("share", F.col("shared") / F.col("n"))
                   .filter(F.col("shared") * 100 >= F.col("n") * percent))
    left = saved(mixed_keys(left.join(shares.select("node"), "node", "left_semi")))
    edges = saved(edges.unionAll(linked(star_pairs(left, shares, "share", percent), active, k, percent)))
    found = saved(components(edges))
    left = saved(mixed_keys(placed(left, found)))

    nodes = left.select("node").distinct()
    rich = saved(left.join(shares, "node").join(rarest_first(only(active, nodes), shares, k, percent), "node"))
    x, y = rich.alias("x"), rich.alias("y")
    most = F.expr("least(x.shared, y.shared)")
    pairs = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
                    & (F.col("x.component") != F.col("y.component")) & first_common_key("x.slot") & similar_size(percent)
                    & (most * 100 >= (F.expr("x.n + y.n") - most) * percent) & (distance() <= MOST_DIFFERENT) & common_prefix(percent))
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"),
                     F.col("x.component").alias("ca"), F.col("y.component").alias("cb")))
    pairs = saved(pairs)
    more = linked(pairs.select("a", "b"), active, k, percent).join(pairs, ["a", "b"]).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = saved(components(more)).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    # A component that no pair joined keeps its name; one that is a single text is not in ``found``.
    found = (reps.select("node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
             .join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component")))

    classes = reps.select(F.col("n").alias("n_shingles"), "d0", "d1", "node").join(found, "node").select(
        *group, F.col("component").alias("component_id"))
    return (rows.select("doc_id", *group).join(classes, group, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """The rows that stay, with all their columns."""
    dropped = near_classes(docs, id_col, text_col, k, percent).filter("NOT kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    return docs.alias("d").join(saved(dropped).alias("x").hint("merge"), F.col(f"d.`{id_col}`").cast("long") == F.col("x.dropped_id"), "left_anti")


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
