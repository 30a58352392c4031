"""Chat formatting by schema fingerprints, with DataFrame functions only.

Records are JSON texts of several layouts: prompt and completion, instruction
with input and output, lists of messages under different names, single rows of
a turn. The nested field paths that a record has, out of those any layout
names, are sorted and hashed; this fingerprint selects the layout, a declarative
list of where each turn's role and text are found. Records with a fingerprint
of no layout, and texts that are not JSON, give no turn (``unmatched`` lists them).

Canonical turns are rendered as

    <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>

one after another. Control strings of this and of other usual templates inside
roles and texts are escaped by one backslash after their first character, and
strings that already look escaped get one more, so that undoing it restores
every text exactly. ``loss_runs`` is the loss mask in run lengths: per turn the
code points to skip, to train on and to skip again; together they cover the
formatted text. Assistant texts are trained on.

Defined cases: null roles and texts are empty; turns of a conversation are
ordered by turn number (null first), then by role and text; repeated rows
are repeated turns; a null conversation id is a conversation of its own; an
empty table gives no rows. Extra columns are not read. A record too large to
parse (a variant holds up to 128 MiB) fits no layout; ``from_rows`` takes such a
row's role and text from its columns, so no turn is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Openers of control strings: <|...|>, <s>, </s>, <<SYS>>, <</SYS>>, [INST], [/INST]; any number of backslashes between.
_PLAIN = r"([<\[])(\\*)(\||/?s>|</?SYS>>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|</?SYS>>|/?INST\])"
TRAINED = "assistant"


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns: a list of messages, or one (role, path) per turn.

    ``paths`` are the field paths that make the fingerprint; [0] stands for the elements of a list.
    """

    paths: tuple[str, ...]
    messages: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, str], ...] = ()
    #: Whether speakers are renamed by ROLES.
    renamed: bool = False


LAYOUTS = (
    Layout(("$.conv_id", "$.role", "$.text", "$.turn"), role="$.role", text="$.text"),
    Layout(("$.messages", "$.messages[0].content", "$.messages[0].role"), messages="$.messages", role="role", text="content"),
    Layout(("$.conversations", "$.conversations[0].from", "$.conversations[0].value"),
           messages="$.conversations", role="from", text="value", renamed=True),
    Layout(("$.completion", "$.prompt"), turns=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout(("$.prompt", "$.response"), turns=(("user", "$.prompt"), ("assistant", "$.response"))),
    Layout(("$.instruction", "$.output"), turns=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout(("$.input", "$.instruction", "$.output"), turns=(("user", "$.instruction\n\n$.input"), ("assistant", "$.output"))),
    Layout(("$.data.answer", "$.data.question"), turns=(("user", "$.data.question"), ("assistant", "$.data.answer"))),
)
#: Names that the renamed layouts use for the same speakers.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the sorted field paths that a variant has, out of those that layouts name."""
    known = sorted({p for layout in layouts for p in layout.paths})
    found = F.filter(F.array(*[F.when(F.try_variant_get(record, p, "variant").isNotNull(), F.lit(p)) for p in known]),
                     lambda p: p.isNotNull())
    return F.sha2(F.array_join(found, "\n"), 256)


def _name(layout: Layout) -> Column:
    return F.sha2(F.lit("\n".join(sorted(layout.paths))), 256)


def _text(record: Column, path: str) -> Column:
    parts = [F.coalesce(F.try_variant_get(record, p, "string"), F.lit("")) for p in path.split("\n\n")]
    return parts[0] if len(parts) == 1 else F.concat_ws("\n\n", *[F.when(p != "", p) for p in parts])


def _turns(record: Column, layout: Layout) -> Column:
    """array<struct<role, text>> of a record with this layout."""
    if layout.messages:
        items = F.coalesce(F.try_variant_get(record, layout.messages, "array<variant>"), F.array().cast("array<variant>"))
        return F.transform(items, lambda m: F.struct(
            _role(F.coalesce(F.try_variant_get(m, f"$.{layout.role}", "string"), F.lit("")), layout).alias("role"),
            F.coalesce(F.try_variant_get(m, f"$.{layout.text}", "string"), F.lit("")).alias("text")))
    if layout.turns:
        return F.array(*[F.struct(F.lit(role).alias("role"), _text(record, path).alias("text")) for role, path in layout.turns])
    return F.array(F.struct(_text(record, layout.role).alias("role"), _text(record, layout.text).alias("text")))


def canonical(records: DataFrame, json_col: str, keep: list[Column], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The ``keep`` columns with fingerprint, ``known`` (a layout has it) and turns: array<struct<role, text>>."""
    parsed = records.select(*keep, F.try_parse_json(json_col).alias("__record"))
    marked = parsed.withColumn("fingerprint", fingerprint(F.col("__record"), layouts))
    choose = None
    for layout in layouts:
        here = F.col("fingerprint") == _name(layout)
        turns = _turns(F.col("__record"), layout)
        choose = F.when(here, turns) if choose is None else choose.when(here, turns)
    return marked.withColumn("turns", choose).withColumn("known", F.col("turns").isNotNull()).drop("__record")


def _role(role: Column, layout: Layout) -> Column:
    out = role
    for name, canonical_name in ROLES.items() if layout.renamed else ():
        out = F.when(role == name, F.lit(canonical_name)).otherwise(out)
    return out


def unmatched(records: DataFrame, json_col: str, keep: list[Column], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records that no layout fits, with their fingerprints."""
    return canonical(records, json_col, keep, layouts).filter("NOT known").drop("turns", "known")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def render(conversations: DataFrame, turns_col: str = "turns") -> DataFrame:
    """Replace turns by formatted and loss_runs: array<struct<skip, train, rest>>, one run per turn."""
    parts = F.transform(turns_col, lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == TRAINED).alias("trained")))
    cut = conversations.withColumn("__parts", parts)
    text = F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    size = lambda p: F.length(p["body"])
    runs = F.transform("__parts", lambda p: F.struct(
        F.length(p["head"]).alias("skip"), F.when(p["trained"], size(p)).otherwise(0).alias("train"),
        (F.when(p["trained"], 0).otherwise(size(p)) + len(END)).alias("rest")))
    return cut.withColumn("formatted", text).withColumn("loss_runs", runs).drop("__parts", turns_col)


def read_back(formatted: DataFrame) -> DataFrame:
    """Replace formatted by turns (unescaped) and loss_text, the text under the mask, parsed from the output alone."""
    # Every turn ends with END, which no escaped text holds.
    closed = F.expr(f"slice(split(formatted, '{_quoted(END)}', -1), 1, size(split(formatted, '{_quoted(END)}', -1)) - 1)")
    halves = F.transform(closed, lambda s: F.split(F.substring(s, len(START) + 1, 2**31 - 1), _quoted(SEP, sql=False), 2))
    parsed = formatted.withColumn("__halves", halves)
    turns = F.transform("__halves", lambda h: F.struct(unescape(h[0]).alias("role"), unescape(h[1]).alias("text")))
    # A run skips a turn's head, then trains on `train` code points of what follows.
    masked = F.zip_with("__halves", "loss_runs", lambda h, r: F.substring(
        F.concat(F.lit(START), h[0], F.lit(SEP), h[1], F.lit(END)), r["skip"] + 1, r["train"]))
    return (parsed.withColumn("turns", turns)
            .withColumn("loss_text", F.array_join(F.transform(masked, unescape), "")).drop("__halves"))


def _quoted(token: str, sql: bool = True) -> str:
    return token.replace("|", r"\\|" if sql else r"\|")


def from_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv_id, turns) of a table with one turn per row: each row is a record of the row layout.

    A row whose record no layout fits keeps the role and text of its columns.
    """
    record = F.to_json(F.struct(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                                F.col(text_col).alias("text")), {"ignoreNullFields": "false"})
    own = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in (("role", role_col), ("text", text_col))])
    rows = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), own.alias("own"), record.alias("record"))
    turns = (canonical(rows, "record", [F.col("conv_id"), F.col("turn"), F.col("own")], layouts)
             .withColumn("turns", F.coalesce("turns", F.array("own"))))
    turn = turns.select("conv_id", F.explode("turns").alias("t"), "turn")
    return (turn.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "t"))).alias("at"))
            .select("conv_id", F.col("at.t").alias("turns")))
