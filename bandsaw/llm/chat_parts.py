r"""Chat messages of typed parts as one text per conversation, with a loss mask and references to attachments.

A message is a role and an array of parts (``PART``): text, image, audio or document. The
visitor (``visited``) turns each part into a piece, by its kind: a text follows ``<|text|>``,
an attachment becomes a placeholder such as ``<|image:2|>``, numbered through the conversation.
A turn is ``<|turn|>``, the role, its pieces in order, ``<|end|>`` and a line feed.

Every control string begins with ``<|``. Inside texts and roles ``<|`` is written ``<\|``; where
backslashes stand between ``<`` and ``|`` one more is written, so that one fewer gives the text back
and texts without these signs stay as they are.

Places of turns come from running sums over a conversation's rows, which Spark sorts and spills;
a row is only put together with others to make the text of its own conversation.
All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ref: where the attachment is; width, height: of an image, in pixels; seconds: of audio; pages: of a document.
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"

OPEN, TURN, TEXT, END = "<|", "<|turn|>", "<|text|>", "<|end|>\n"
LEARNED_ROLE = "assistant"

# What a placeholder stands for in the model's input: tokens per image patch, second and page.
PATCH = 28
SECOND_TOKENS = 25
PAGE_TOKENS = 256


def escaped(text: Column) -> Column:
    """``text`` without a control string; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def expanded(part: Column) -> Column:
    """How many tokens stand for an attachment in the model's input; an unknown size or kind counts as none."""
    patches = lambda side: F.ceil(F.greatest(side, F.lit(0)) / PATCH)
    count = (
        F.when(part.kind == "image", patches(part.width) * patches(part.height))
        .when(part.kind == "audio", F.ceil(F.greatest(part.seconds, F.lit(0.0)) * SECOND_TOKENS))
        .when(part.kind == "document", F.greatest(part.pages, F.lit(0)) * PAGE_TOKENS)
    )
    return F.coalesce(count.cast("bigint"), F.lit(0).cast("bigint"))


def _kind(part: Column) -> Column:
    return F.when(part.kind.isin("text", "image", "audio", "document"), part.kind).otherwise(F.lit("attachment"))


def visited(parts: Column, first: Column) -> Column:
    """Pieces of a message in order: (place, kind, piece, length, ref, tokens, number); ``first`` numbers its first attachment."""
    placed = F.transform(F.filter(parts, lambda p: p.isNotNull()), lambda p, i: F.struct(i.alias("place"), _kind(p).alias("kind"), p.alias("part")))
    nothing = F.lit(None)

    def text(p: Column) -> Column:
        piece = F.concat(F.lit(TEXT), escaped(p.part.text))
        return F.struct(
            p.place.alias("place"), p.kind.alias("kind"), piece.alias("piece"), F.length(piece).cast("bigint").alias("length"),
            nothing.cast("string").alias("ref"), F.lit(0).cast("bigint").alias("tokens"), nothing.cast("bigint").alias("number"),
        )

    def attachment(p: Column, i: Column) -> Column:
        piece = F.concat(F.lit(OPEN), p.kind, F.lit(":"), (first + i).cast("string"), F.lit("|>"))
        return F.struct(
            p.place.alias("place"), p.kind.alias("kind"), piece.alias("piece"), F.length(piece).cast("bigint").alias("length"),
            p.part.ref.alias("ref"), expanded(p.part).alias("tokens"), (first + i).cast("bigint").alias("number"),
        )

    texts = F.transform(F.filter(placed, lambda p: p.kind == "text"), text)
    attachments = F.transform(F.filter(placed, lambda p: p.kind != "text"), attachment)
    return F.array_sort(F.concat(texts, attachments))


def text_part(text: Column) -> Column:
    """The parts of a message that is one text."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        )
    )


def formatted(messages: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """Conversations from rows (conv_id, turn, role, parts).

    Returns (conv_id, formatted, turns, attachments, expanded_tokens): ``turns`` holds per turn its
    place ``begin`` and ``length`` in ``formatted`` and the spans ``mask`` that the loss covers (texts of
    the ``learned`` role without markers), all in code points from 0; ``attachments`` holds (turn, number,
    kind, ref, tokens) in order, with ``turn`` counted from 0, and ``expanded_tokens`` their sum.

    Rows go by ``turn``, nulls first; of equal turns by role, then by their parts. Rows that
    repeat are turns of their own. A null role is empty and never learned; null parts are left out, null parts
    arrays and empty ones give a turn without pieces; a null text is empty. A part of any other kind is an attachment
    that counts no tokens. Rows without ``conv_id`` are one conversation. An empty table gives none.
    A conversation becomes one text, which must stay below Spark's two gigabytes a value. Other columns are not read.
    """
    own = [F.col(c).alias(a) for c, a in (("conv_id", "conv_id"), ("turn", "turn"), ("role", "role"))]
    parts = F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>"))
    rows = messages.select(*own, parts.alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    n_attachments = F.size(F.filter("parts", lambda p: p.isNotNull() & (_kind(p) != "text"))).cast("bigint")
    rows = rows.withColumn("place", F.row_number().over(order) - 1).withColumn("first", F.coalesce(F.sum(n_attachments).over(before), F.lit(0).cast("bigint")))
    head = F.concat(F.lit(TURN), escaped(F.col("role")))
    rows = rows.withColumn("pieces", visited(F.col("parts"), F.col("first"))).withColumn("head", head)
    rows = rows.select("conv_id", "place", "role", "head", "pieces", F.concat("head", F.array_join("pieces.piece", ""), F.lit(END)).alias("piece"))
    rows = rows.withColumn("length", F.length("piece").cast("bigint"))
    by_place = Window.partitionBy("conv_id").orderBy("place")
    begin = F.coalesce(F.sum("length").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    rows = rows.withColumn("begin", begin)
    lengths = F.col("pieces.length")

    def span(p: Column, i: Column) -> Column:
        at = F.col("begin") + F.length("head") + F.aggregate(F.slice(lengths, 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.struct(p.kind.alias("kind"), (at + len(TEXT)).alias("begin"), (at + p.length).alias("end"))

    spans = F.filter(F.transform("pieces", span), lambda s: s.kind == "text")
    mask = F.when(F.col("role") == learned, F.transform(spans, lambda s: F.struct(s.begin.alias("begin"), s.end.alias("end"))))
    references = F.transform(
        F.filter("pieces", lambda p: p.kind != "text"),
        lambda p: F.struct(F.col("place").alias("turn"), p.number.alias("number"), p.kind.alias("kind"), p.ref.alias("ref"), p.tokens.alias("tokens")),
    )
    no_span = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    turn = F.struct("place", "begin", "length", F.coalesce(mask, no_span).alias("mask"), "piece", references.alias("references"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("held"))
    attachments = F.flatten("held.references")
    return whole.select(
        "conv_id",
        F.array_join("held.piece", "").alias("formatted"),
        F.transform("held", lambda t: F.struct(t.begin.alias("begin"), t.length.alias("length"), t.mask.alias("mask"))).alias("turns"),
        attachments.alias("attachments"),
        F.aggregate(F.transform(attachments, lambda a: a.tokens), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("expanded_tokens"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """``conversations`` of ``formatted`` with ``said``: per turn (role, text, pieces, learned), read from the text and the mask.

    ``text`` joins the turn's text parts; ``pieces`` are its parts in order as (kind, content): the text, or
    the number of the attachment; ``learned`` is the text under the mask.
    """
    turns = F.slice(F.split("formatted", r"<\|turn\|>"), 2, F.size("turns"))

    def turn(raw: Column, at: Column) -> Column:
        marks = F.split(raw, r"<\|")
        inner = F.transform(F.slice(marks, 2, F.size(marks) - 2), _piece)
        whole = F.concat(F.lit(TURN), raw)
        learned = F.transform(at.mask, lambda s: F.substring(whole, (s.begin - at.begin + 1).cast("int"), (s.end - s.begin).cast("int")))
        return F.struct(
            unescaped(F.element_at(marks, 1)).alias("role"),
            F.array_join(F.transform(F.filter(inner, lambda p: p.kind == "text"), lambda p: p.content), "").alias("text"),
            inner.alias("pieces"),
            F.array_join(F.transform(learned, unescaped), "").alias("learned"),
        )

    return conversations.withColumn("said", F.zip_with(turns, "turns", turn))


def _piece(mark: Column) -> Column:
    """(kind, content) of what stands between two control strings: ``text|>…`` or ``image:2|>``."""
    name = F.substring_index(mark, "|>", 1)
    is_text = name == "text"
    content = F.when(is_text, unescaped(F.substring(mark, F.lit(len("text|>") + 1), F.length(mark)))).otherwise(F.substring_index(name, ":", -1))
    return F.struct(F.substring_index(name, ":", 1).alias("kind"), content.alias("content"))


def digested(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``formatted``: counts and digests of what is read back."""
    said = F.transform("said", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    loss = F.array_join("said.learned", "")
    return read_back(conversations).select(
        "conv_id",
        F.size("said").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "expanded_tokens",
    )


# The conversation that every run adds: texts that look like control strings of other templates.
PLANTED_ID = -7
PLANTED = r"\### Assistant: </turn> ok"


def with_planted(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of the table's rows and the planted conversation."""
    mine = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", text_part(F.col("text")).alias("parts"))
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(LEARNED_ROLE))
    planted = rows.sparkSession.range(2).select(F.lit(PLANTED_ID).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), text_part(F.lit(PLANTED)).alias("parts"))
    return mine.unionByName(planted)


SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role = 'assistant' AS learned FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', false
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', true),
e AS (
  SELECT *, regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') AS role_out, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS text_out FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (learned), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (learned), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>' || role_out || '<|text|>' || text_out || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS expanded_tokens
FROM e GROUP BY conv_id
"""
