"""Chat formatting with typed content parts (DataFrame functions only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The template's control strings.
TURN, END = "<|turn|>", "<|end|>"
#: Strings that mean something to chat templates: in a text, their first character is escaped.
CONTROL_LT, CONTROL_SQ = r"<(?=\||/?s>)", r"\[(?=/?INST\])"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(c: Column) -> Column:
    """Reversible: ``&`` always becomes an entity, so that entities in the output are ours alone."""
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;"))
    c = F.regexp_replace(c, CONTROL_LT, "&lt;")
    return F.regexp_replace(c, CONTROL_SQ, "&lsqb;")


def escape_role(c: Column) -> Column:
    """A role also ends at a line break, which is escaped too."""
    return F.replace(escape(c), F.lit("\n"), F.lit("&nl;"))


def unescape(c: Column) -> Column:
    for entity, plain in (("&nl;", "\n"), ("&lsqb;", "["), ("&lt;", "<"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


@dataclass(frozen=True)
class TokenCosts:
    """What an attachment's placeholder expands to."""

    image_tile: int = 14
    audio_per_second: float = 12.5
    document_page: int = 256


class PartVisitor:
    """Visits a content part by its type and flattens it: (escaped text or placeholder, expanded token count).

    Text costs no attachment tokens; an image costs its tiles, audio its seconds, a document its
    pages, each 1 at least; a part of unknown type becomes a placeholder ``<|type|>`` of one token. Null fields count as 0 or
    empty, a null part as an empty text.
    """

    def __init__(self, costs: TokenCosts = TokenCosts()):
        self.costs = costs

    def kind(self, p: Column) -> Column:
        return F.lower(F.coalesce(p["type"], F.lit("text")))

    def flatten(self, p: Column) -> Column:
        return F.when(self.kind(p) == "text", escape(p["text"])).otherwise(
            F.concat(F.lit("<|"), F.regexp_replace(self.kind(p), "[^a-z0-9_]", "_"), F.lit("|>"))
        )

    def tokens(self, p: Column) -> Column:
        def of(c: Column) -> Column:
            return F.greatest(F.lit(1), F.ceil(F.coalesce(c, F.lit(0)))).cast("long")

        t = self.costs
        tiles = F.ceil(p["width"] / t.image_tile) * F.ceil(p["height"] / t.image_tile)
        return (
            F.when(self.kind(p) == "text", F.lit(0).cast("long"))
            .when(self.kind(p) == "image", of(tiles))
            .when(self.kind(p) == "audio", of(p["seconds"] * t.audio_per_second))
            .when(self.kind(p) == "document", of(p["pages"] * t.document_page))
            .otherwise(F.lit(1).cast("long"))
        )

    def attachment(self, p: Column) -> Column:
        return F.struct(self.kind(p).alias("type"), p["ref"].alias("ref"), self.tokens(p).alias("tokens"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one typed part."""
    fields = {"type": F.lit("text"), "text": text}
    types = dict(x.split(":") for x in PART[7:-1].split(","))
    return F.array(F.struct(*[fields.get(k, F.lit(None)).cast(t).alias(k) for k, t in types.items()]))


def format_chat(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts_col: str | None = None,
    loss_roles: tuple[str, ...] = ("assistant",),
    visitor: PartVisitor | None = None,
) -> DataFrame:
    """One formatted string a conversation: ``<|turn|>role\\ncontent<|end|>`` for each turn, in turn order.

    ``parts_col`` names an array of typed parts (``PART``); else ``text_col`` is a single text part. Returns
    ``conv_col``, ``formatted`` string, ``loss_spans`` array of (start, length) in UTF-8 bytes of ``formatted``
    under which the loss counts, ``attachments`` array of (turn_no, part_no, type, ref, tokens) in order of their placeholders and
    ``attachment_tokens`` long.

    Rows of a conversation meet in one sort by (turn, role, text); nulls come first and ties of all three
    are equal rows, each a turn of its own. A null role or text is an empty one. A null conversation id is
    a conversation. Other columns are not returned; an empty table gives no rows.
    """
    v = visitor or PartVisitor()
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>")) if parts_col else text_parts(F.col(text_col))
    rows = df.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        parts.alias("parts"),
    )
    flat = rows.select(
        "conv",
        "turn",
        "role",
        F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("parts", v.flatten), "").alias("body"),
        F.filter(
            F.transform("parts", lambda p, i: F.struct(i.alias("part_no"), v.attachment(p).alias("a"))),
            lambda x: x["a"]["type"] != "text",
        ).alias("found"),
    )
    by_turn = Window.partitionBy("conv").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("head") + F.octet_length("body") + len(END)
    placed = flat.select(
        "*",
        F.coalesce(F.sum(size.cast("long")).over(by_turn), F.lit(0)).alias("at"),
        F.count(F.lit(1)).over(by_turn).alias("turn_no"),
    )
    turn = F.struct(
        "turn_no",
        F.concat("head", "body", F.lit(END)).alias("text"),
        (F.col("at") + F.octet_length("head")).alias("start"),
        F.octet_length("body").cast("long").alias("length"),
        F.col("role").isin(*loss_roles).alias("loss"),
        "found",
    )
    conv = placed.groupBy("conv").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    refs = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                t["found"],
                lambda x: F.struct(t["turn_no"].alias("turn_no"), x["part_no"].alias("part_no"), x["a"]["type"].alias("type"), x["a"]["ref"].alias("ref"), x["a"]["tokens"].alias("tokens")),
            ),
        )
    )
    out = conv.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        refs.alias("attachments"),
    )
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The (role, content) of each turn of a formatted string, unescaped; placeholders stay as they are."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        content = x.substr(F.char_length(role) + 2, F.char_length(x) - F.char_length(role) - 1 - len(END))
        return F.struct(unescape(role).alias("role"), unescape(content).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    raw = formatted.cast("binary")
    texts = F.transform(
        spans, lambda s: F.decode(F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")
    )
    return unescape(F.array_join(texts, ""))
