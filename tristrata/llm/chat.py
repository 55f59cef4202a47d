r"""Chat formatting that a deterministic parser reads back.

A turn is ``[INST] role [/INST]text</s>``; a conversation is its turns in order. The grammar is
regular: ``</s>`` ends a turn, the first `` [/INST]`` of a turn ends its role. A turn is rendered as
it is, parsed again and compared with its source. Where the two differ, and where a role or text
holds a control string (or an escaped one) that happens to parse, the turn conflicts: it is escaped
and compared again. Escaping puts one more ``\`` behind the first
character of every control string, escaped ones included; the parser takes one away. So the escape
can be undone whatever the text says, and texts without control strings stay as they are.
"""

from pyspark.sql import Column, DataFrame, functions as F

OPEN, MIDDLE, CLOSE = "[INST] ", " [/INST]", "</s>"
# A control string whose first character is followed by any number of escape signs.
CONTROL = r"(<)(\\*)(/s>)|(\[)(\\*)(/?INST\])"
ESCAPED = r"(<)\\(\\*)(/s>)|(\[)\\(\\*)(/?INST\])"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$4\\$2$5$3$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$4$2$5$3$6")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text); null if it is malformed."""
    pieces = F.split(formatted, CLOSE)
    turns = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, MIDDLE)
        role = piece.substr(F.lit(len(OPEN) + 1), at - 1 - len(OPEN))
        text = piece.substr(at + len(MIDDLE), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    whole = F.forall(turns, lambda p: p.startswith(OPEN) & (F.instr(p, MIDDLE) > len(OPEN)))
    return F.when(whole & (F.get(pieces, F.size(pieces) - 1) == ""), F.transform(turns, turn))


def format_conversations(
    rows: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``formatted``, ``segments``, ``n_turns``, ``n_escaped``, ``identical``.

    ``segments`` cuts ``formatted`` into (text, loss); loss marks the rendered texts of assistant
    turns. ``identical`` says that parsing ``formatted`` gave the source turns back. Null roles and
    texts count as empty. Turns are in order of turn (null first), ties of role and text; repeated
    rows are turns of their own; rows with a null id form one conversation. A conversation is one
    string, so it has to fit into a row. Other columns are not read.
    """
    source = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    turn = F.struct("role", "text")

    def same(role: str, text: str) -> Column:
        return F.coalesce(parse(render(F.col(role), F.col(text))) == F.array(turn), F.lit(False))

    free = ~F.col("role").rlike(CONTROL) & ~F.col("text").rlike(CONTROL)
    tried = source.withColumn("_plain", free & same("role", "text"))
    chosen = tried.withColumn("_role", F.when(F.col("_plain"), F.col("role")).otherwise(escape(F.col("role")))).withColumn(
        "_text", F.when(F.col("_plain"), F.col("text")).otherwise(escape(F.col("text")))
    )
    item = F.struct("turn", "role", "text", "_role", "_text", "_plain")
    gathered = chosen.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("turns"))

    def cut(t: Column) -> Column:
        head = F.concat(F.lit(OPEN), t["_role"], F.lit(MIDDLE))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(t["_text"].alias("text"), (t["role"] == LOSS_ROLE).alias("loss")),
            F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
        )

    joined = gathered.select(
        "conv_id", F.flatten(F.transform("turns", cut)).alias("segments"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_source"),
        F.size(F.filter("turns", lambda t: ~t["_plain"])).alias("n_escaped"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    return joined.select(
        "conv_id", "formatted", "segments", F.size("_source").cast("long").alias("n_turns"), "n_escaped",
        F.coalesce(parse(F.col("formatted")) == F.col("_source"), F.lit(False)).alias("identical"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted text says: its turns, and the texts under the loss mask."""
    turns = F.transform(
        parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    whole = formatted.select(
        "conv_id", F.size(parse(F.col("formatted"))).cast("long").alias("n_turns"),
        F.array_join(turns, "").alias("_turns"), F.array_join(masked, "").alias("_loss"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_escaped", "identical",
    )
    return whole.select(
        "conv_id", "n_turns", F.sha2("_turns", 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars", F.col("n_escaped").cast("long").alias("n_escaped"), "identical",
    )
