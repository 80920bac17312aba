"""Repository files (S7-S10, H13): README pick, file filter, budgeted corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions import text as T


def _basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def skip_file(path="path", ignore: tuple[str, ...] = ()) -> Column:
    """Ignored prefix/suffix, any path part starting with .git, or a binary extension."""
    p = F.lower(T.col(path))
    name = _basename(p)
    out = F.exists(F.split(p, "/"), lambda part: part.startswith(".git"))
    ext = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    out = out | (ext.isin(*D.BINARY_FILE_EXTENSIONS) & (ext != name))
    for x in ignore:
        out = out | name.endswith(x) | p.startswith(x)
    return out


def readme_pick(files: DataFrame) -> DataFrame:
    """Per repository the README: first non-blank preferred root name,
    else the first non-blank ``readme*`` file outside ``.git`` (path order).

    A hash aggregate with ``min`` over (rank, path): partial per task, so a
    repository with a huge file count does not land whole in one task.
    """
    p = F.col("path")
    rank = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(D.README_PREFERRED_NAMES))):
        rank = F.when(p == name, F.lit(i)).otherwise(rank)
    fallback = (F.lower(_basename(p)).startswith("readme")
                & ~F.exists(F.split(p, "/"), lambda part: part == ".git"))
    rank = F.coalesce(rank, F.when(fallback, F.lit(len(D.README_PREFERRED_NAMES))))
    cands = files.filter(rank.isNotNull() & (T.strip_ws("text") != "")).withColumn("_rank", rank)
    best = cands.groupBy("repo").agg(F.min(F.struct("_rank", "path", "file_id")).alias("_b")).select(
        "repo", F.col("_b.path").alias("readme_path"), F.col("_b.file_id").alias("file_id"))
    return best.join(files.select("file_id", F.col("text").alias("readme")), "file_id").select("repo", "readme_path", "readme")


def repository_records(readmes: DataFrame, link: str = "link") -> DataFrame:
    """title = last path segment, tags ['readme', name], content = README.

    A repository whose ``readme`` is null becomes an error row (``error_reason``)."""
    name = F.regexp_extract(F.regexp_replace(F.col(link), "/+$", ""), r"([^/]*)$", 1)
    return readmes.select(
        "*", name.alias("title"), F.col("readme").alias("content"),
        F.slice(F.array(F.lit("readme"), F.lower(name)), 1, D.MAX_TAGS).alias("seed_tags"),
        F.when(F.col("readme").isNull(), F.concat(F.lit("Repository '"), F.col(link), F.lit(
            "' does not contain a readable README file."))).alias("error_reason"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.lit("github").alias("platform"), F.lit("github").alias("source"),
        F.create_map(F.lit("readme_path"), F.col("readme_path"),
                     F.lit("ingestion_mode"), F.lit("readme_only")).alias("raw_metadata"))


def repository_corpus(files: DataFrame, max_files: int = D.REPO_MAX_FILES,
                      max_file_chars: int = D.REPO_MAX_FILE_CHARS,
                      max_total_chars: int = D.REPO_MAX_TOTAL_CHARS,
                      skip_bytes: int = D.REPO_SKIP_FILE_BYTES, ignore: tuple[str, ...] = ()) -> DataFrame:
    """S9 + S10: budgeted corpus text per repository and its ``trimmed`` flag.

    Files (``file_id`` is unique) in path order; too large -> skipped (trimmed); blank ->
    skipped; cut to ``max_file_chars`` + marker (trimmed); a file that would pass the
    total is skipped (trimmed) and the walk goes on; it stops at ``max_files`` or the total.
    The walk folds over (path, id, length) only; texts join back by id.  Its array is bounded:
    of files that count the same length only the first ``max_files`` by path can be taken (once a
    length does not fit, no later file of that length does), the others only set ``trimmed``.
    A repository without a taken file gets the placeholder text.
    """
    readable = files.filter(~skip_file("path", ignore) & (T.strip_ws("text") != ""))
    cut = F.length("text") > max_file_chars
    n = F.length("path") + F.least(F.length("text"), F.lit(max_file_chars)) + F.when(cut, len(D.TRUNCATION_MARKER)).otherwise(0)
    sized = readable.select("repo", "path", "file_id", (F.col("size_bytes") > skip_bytes).alias("big"),
                            cut.alias("cut"), n.cast("long").alias("n"))
    same = Window.partitionBy("repo", "n").orderBy("path", "file_id")
    walk = sized.filter(~F.col("big")).withColumn("place", F.row_number().over(same)).filter(F.col("place") <= max_files)
    counts = sized.groupBy("repo").agg(F.max("big").alias("any_big"), F.count_if(~F.col("big")).alias("usable"))
    arrays = walk.groupBy("repo").agg(F.sort_array(F.collect_list(F.struct("path", "file_id", "cut", "n"))).alias("files"))
    init = F.struct(F.array().cast("array<struct<path: string, file_id: long>>").alias("kept"), F.lit(0).cast("long").alias("total"),
                    F.lit(False).alias("trimmed"), F.lit(False).alias("stop"))

    def step(acc, x):
        fits = acc["total"] + x["n"] <= max_total_chars
        taken = F.concat(acc["kept"], F.array(F.struct(x["path"].alias("path"), x["file_id"].alias("file_id"))))
        full = fits & ((F.size(acc["kept"]) + 1 >= max_files) | (acc["total"] + x["n"] >= max_total_chars))
        after = F.struct(F.when(fits, taken).otherwise(acc["kept"]).alias("kept"),
                         F.when(fits, acc["total"] + x["n"]).otherwise(acc["total"]).alias("total"),
                         (acc["trimmed"] | x["cut"] | ~fits | full).alias("trimmed"), full.alias("stop"))
        return F.when(acc["stop"], acc).otherwise(after)

    folded = (arrays.select("repo", F.aggregate("files", init, step).alias("s"), F.size("files").alias("walked")).join(counts, "repo", "right")
              .select("repo", "s.kept", (F.coalesce("s.trimmed", F.lit(False)) | F.col("any_big")
                                         | (F.col("usable") > F.coalesce("walked", F.lit(0)))).alias("trimmed")))
    kept = folded.select(F.col("repo").alias("r"), F.posexplode("kept").alias("k", "f")).select("r", "k", F.col("f.file_id").alias("file_id"))
    body = F.when(cut, F.concat(F.substring("text", 1, max_file_chars), F.lit(D.TRUNCATION_MARKER))).otherwise(F.col("text"))
    blocks = kept.join(readable, "file_id").select("repo", "k", F.concat(F.lit("FILE: "), F.col("path"), F.lit("\n"), body).alias("b"))
    corpus = blocks.groupBy("repo").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "b"))), lambda x: x["b"]), "\n\n").alias("corpus"),
        F.count(F.lit(1)).alias("files"))
    return (files.select("repo").distinct().join(folded.select("repo", "trimmed"), "repo", "left").join(corpus, "repo", "left")
            .select("repo", F.coalesce("trimmed", F.lit(False)).alias("trimmed"),
                    F.coalesce("corpus", F.lit("FILE: README\n" + D.EMPTY_REPOSITORY)).alias("corpus"),
                    F.coalesce("files", F.lit(1).cast("long")).alias("files")))
