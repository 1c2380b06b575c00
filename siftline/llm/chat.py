"""Chat formatting with typed content parts.

A visitor walks the parts of each message (text, image, audio, document) and flattens them into one string: text is
escaped, any other part becomes a placeholder, and what it stands for is recorded as an attachment (ordinal, turn, kind,
reference, place, expanded token count). All of it is native: one shuffle brings the turns of a conversation together,
as its formatted text is one value; everything else is projection.

Template of a turn: ``<|turn|>role<|body|>text<|end|>``. A control string inside a role or text gets one backslash
after its first character (one more, if it has some already), so none can be read as a control string and reading back
takes exactly one backslash away: the mapping is one to one.

Edge cases: null text or parts are empty, a null role is the empty role; turns are ordered by turn (nulls first), then
role and text, and repeated rows are repeated turns; rows with a null conversation id form one conversation of their
own; unknown kinds of parts are an error when ``strict``, else documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import table

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: What is escaped inside texts: our own markers, and the markers of other common templates.
_CONTROL = r"([<\[])(\\*)((?:\|[a-z_]+\||/?s)>|/?INST\]|/?SYS\])"
_ESCAPED = r"([<\[])\\(\\*)((?:\|[a-z_]+\||/?s)>|/?INST\]|/?SYS\])"

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def expanded_tokens(part: Column, patch: int = 14, merge: int = 2, per_second: int = 25, per_page: int = 576) -> Column:
    """Tokens that stand in for a part: image patches after merging, audio frames, pages of a document."""
    side = patch * merge
    image = F.ceil(F.coalesce(part["width"], F.lit(0)) / side) * F.ceil(F.coalesce(part["height"], F.lit(0)) / side)
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * per_second)
    document = F.coalesce(part["pages"], F.lit(0)) * per_page
    return F.when(part["kind"] == "image", image).when(part["kind"] == "audio", audio).otherwise(document).cast("long")


def visit(part: Column, strict: bool = False) -> Column:
    """What a part looks like in the body."""
    other = F.raise_error(F.concat(F.lit("unknown kind of part: "), F.coalesce(part["kind"], F.lit("null")))).cast("string") if strict else F.lit(PLACEHOLDERS["document"])
    out = F.when(part["kind"] == "text", escape(F.coalesce(part["text"], F.lit(""))))
    for kind, mark in PLACEHOLDERS.items():
        out = out.when(part["kind"] == kind, F.lit(mark))
    return out.otherwise(other)


def _joined(parts: Column) -> Column:
    """Neighbouring text parts as one, so that no control string can form where one ends and the next begins."""

    def add(done, part):
        last = F.get(done, F.size(done) - 1)
        both = last.withField("text", F.concat(F.coalesce(last["text"], F.lit("")), F.coalesce(part["text"], F.lit(""))))
        meet = (F.size(done) > 0) & last["kind"].eqNullSafe("text") & part["kind"].eqNullSafe("text")
        return F.when(meet, F.array_append(F.slice(done, F.lit(1), F.size(done) - 1), both)).otherwise(F.array_append(done, part))

    return F.aggregate(parts, F.array().cast("array<" + PART + ">"), add)


def text_part(text: Column) -> Column:
    """A message's content as a single text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages")))


def format_chat(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",), strict: bool = False) -> DataFrame:
    """One row per conversation: ``conv``, formatted, loss_spans array<struct<start,length>> (0-based, code points of
    text parts of ``loss_roles``), attachments array<struct<ordinal,turn_no,kind,ref,start,tokens>>, n_tokens_expanded.
    """
    kind = "array<" + PART + ">"
    rows = messages.select(F.col(conv).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), _joined(F.filter(F.coalesce(F.col(parts).cast(kind), F.array().cast(kind)), lambda p: p.isNotNull())).alias("p"))
    rows = rows.withColumns({"o": F.transform("p", lambda p: visit(p, strict)), "head": F.concat(F.lit(TURN), escape(F.col("r")), F.lit(BODY))})
    rows = rows.withColumns({"body": F.array_join("o", ""), "at": F.transform(F.sequence(F.lit(0), F.size("o")), lambda i: F.length("head") + F.length(F.array_join(F.slice("o", F.lit(1), i), "")))})
    rows = rows.withColumn("s", F.concat("head", "body", F.lit(END)))
    # where each turn begins; the window spills, and the grouping below needs no other shuffle
    earlier = Window.partitionBy("c").orderBy("t", "r", "body")
    rows = rows.withColumns({"no": F.row_number().over(earlier) - 1, "begin": F.sum(F.length("s")).over(earlier.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.length("s")})
    pieces = F.transform("p", lambda p, i: F.struct(F.col("r").alias("role"), F.col("no").alias("turn_no"), p["kind"].alias("kind"), p["ref"].alias("ref"), (F.col("begin") + F.get("at", i)).alias("start"), F.length(F.get("o", i)).cast("long").alias("length"), expanded_tokens(p).alias("tokens")))
    rows = rows.select("c", F.struct("no", "s", pieces.alias("pieces")).alias("m"))
    rows = rows.groupBy("c").agg(F.sort_array(F.collect_list("m")).alias("m"))
    rows = rows.withColumns({"formatted": F.array_join(F.transform("m", lambda m: m["s"]), ""), "flat": F.flatten(F.transform("m", lambda m: m["pieces"]))})
    loss = F.filter("flat", lambda x: (x["kind"] == "text") & x["role"].isin(*loss_roles))
    files = F.filter("flat", lambda x: ~x["kind"].eqNullSafe("text"))
    attachments = F.transform(files, lambda x, i: F.struct(i.alias("ordinal"), x["turn_no"], x["kind"], x["ref"], x["start"], x["tokens"]))
    return rows.select(
        F.col("c").alias(conv), "formatted",
        F.transform(loss, lambda x: F.struct(x["start"], x["length"])).alias("loss_spans"),
        attachments.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda s, x: s + x["tokens"]).alias("n_tokens_expanded"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>> read back from a formatted conversation; placeholders stay in the text."""
    raw = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)
    return F.transform(raw, lambda s: F.struct(unescape(F.regexp_extract(s, r"(?s)\A(.*?)<\|body\|>", 1)).alias("role"), unescape(F.regexp_extract(s, r"(?s)<\|body\|>(.*)<\|end\|>\z", 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(spans, lambda x: unescape(F.substring(formatted, (x["start"] + 1).cast("int"), x["length"].cast("int")))), "")


def op2_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    out = format_chat(rows.unionByName(extra).withColumn("parts", text_part(F.col("text"))))
    out = out.withColumns({"turns": read_turns(F.col("formatted")), "loss": read_loss(F.col("formatted"), F.col("loss_spans"))})
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def oracle() -> str:
    control = r"([<\[])(\\*)((?:\|[a-z_]+\||/?s)>|/?INST\]|/?SYS\])"
    escaped = f"regexp_replace({{}}, '{control}', '\\1\\\\\\2\\3', 'g')"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({escaped.format('role')}) + length({escaped.format('text')}) + {len(TURN + BODY + END)})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""
