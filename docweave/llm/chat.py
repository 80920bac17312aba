"""Operator 8, chat formatting with typed content parts (DataFrame functions only).

A turn's content is an array of parts (kind, text, ref, units).  The visitor
``visit`` flattens it in order: text is escaped; image, audio and document parts become
numbered placeholders ``<|image_1|>`` (numbered within the turn), and each is
recorded as an attachment with its reference and the tokens it will expand to.  Turns
become ``<|turn|>ROLE<|text|>BODY<|end|>`` and a newline, one conversation one string;
the loss mask is the list of (start, length) of the assistant bodies.

Escaping: a control string inside a text (of this template or of other common
ones) gets a backslash after its first character; one that already has
backslashes there gets one more.  Removing one backslash undoes it exactly.

A conversation is one output row, so its turns meet in one task; that is the unit asked
for, and nothing else is gathered.  Defined results: null role and text are empty; turns
are ordered by turn (null first), then role, then text, so ties and repeated rows
have one result; null conversation ids form one conversation; an unknown part kind is
treated as a document; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, TURN, TEXT, END = "<|begin|>\n", "<|turn|>", "<|text|>", "<|end|>\n"
#: What follows the first character in the control strings of common templates.
CONTROL = r"(\||/?s>|</?SYS>>|/?INST\])"
#: Tokens that one unit of an attachment expands to (image tile, second of audio, document page).
RATES = {"image": 256, "audio": 25, "document": 512}
PART = "array<struct<kind: string, text: string, ref: string, units: int>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def kind_of(part: Column) -> Column:
    return F.when(part["kind"].isin("text", *RATES), part["kind"]).otherwise("document")


def visit(parts: Column) -> Column:
    """Body of a turn: escaped texts and numbered placeholders, in order."""
    return F.array_join(F.transform(parts, lambda p, i: F.when(
        p["kind"] == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(F.lit("<|"), kind_of(p), F.lit("_"), (i + 1).cast("string"), F.lit("|>")))), "")


def attachments(parts: Column) -> Column:
    """(placeholder number, kind, ref, expanded tokens) of the parts that are not text."""
    rate = F.create_map(*[x for k, v in RATES.items() for x in (F.lit(k), F.lit(v))])
    numbered = F.transform(parts, lambda p, i: F.struct(
        (i + 1).alias("number"), kind_of(p).alias("kind"), p["ref"].alias("ref"),
        (F.coalesce(p["units"], F.lit(1)) * rate[kind_of(p)]).alias("tokens")))
    return F.filter(numbered, lambda a: a["kind"] != "text")


def format_conversations(turns: DataFrame, parts_col: str | None = None) -> DataFrame:
    """conv_id, formatted, n_turns, loss (array of start, length), attachments, attachment_tokens.

    Turns have conv_id, turn, role and text, or content parts in ``parts_col``."""
    parts = turns[parts_col].cast(PART) if parts_col else F.array(F.struct(
        F.lit("text").alias("kind"), turns["text"].cast("string").alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))
    plain = turns.select(turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"),
                         F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
                         F.coalesce(parts, F.array().cast(PART)).alias("parts"))
    visited = plain.select("conv_id", "turn", "role", visit(F.col("parts")).alias("body"), attachments(F.col("parts")).alias("att"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = (visited
              .withColumn("head", head)
              .withColumn("place", F.row_number().over(by_turn))
              .withColumn("end", len(BEGIN) + F.sum(F.char_length("head") + F.char_length("body") + len(END)).over(
                  by_turn.rowsBetween(Window.unboundedPreceding, 0))))
    span = F.struct((F.col("end") - len(END) - F.char_length("body")).alias("start"), F.char_length("body").alias("length"))
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "place", F.concat("head", "body", F.lit(END)).alias("string"), (F.col("role") == "assistant").alias("learned"),
        span.alias("span"), "att"))).alias("turns"))
    atts = F.flatten(F.transform("turns", lambda t: F.transform(t["att"], lambda a: a.withField("turn", t["place"]))))
    return grouped.select(
        "conv_id", F.concat(F.lit(BEGIN), F.array_join(F.transform("turns", lambda t: t["string"]), "")).alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        F.transform(F.filter("turns", lambda t: t["learned"]), lambda t: t["span"]).alias("loss"),
        atts.alias("attachments"),
        F.aggregate(atts, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("attachment_tokens"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""
    pieces = F.split(formatted, r"<\|turn\|>")
    pieces = F.slice(pieces, 2, F.size(pieces))
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, TEXT, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text")))


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, all read back from ``formatted`` and ``loss``."""
    turns = read_back(F.col("formatted"))
    listed = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(
        F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return (formatted.select("conv_id", "formatted", F.size(turns).cast("long").alias("n_turns"),
                             listed.alias("listed"), learned.alias("learned"))
            .select("conv_id", "n_turns", F.sha2("listed", 256).alias("turns_sha256"),
                    F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars")))


def op8_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return digest(format_conversations(turns.unionByName(extra)))


_ESC = r"""regexp_replace({0}, '([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])', '\1\\\2\3', 'g')"""
ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST({len(BEGIN)} + sum({len(TURN) + len(TEXT) + len(END)} + length({_ESC.format('role')}) + length({_ESC.format('text')})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
