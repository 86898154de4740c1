"""Chat formatting by a finite-state machine over roles.

A ``Template`` declares, for each role, the marks around a turn, whether its
text bears loss, and which roles may follow which (state 'start' first, '' the
states in which a conversation may end).  Turns become segments (conv_id, seq,
role, text, loss): mark, text, mark.  Only the text of a loss role has
``loss``; marks never do.  A control string inside a text is escaped (a
backslash before it, and before each backslash), so the formatted text can be
read back exactly: an unescaped control string is always a mark.

Rows of a conversation are sorted inside Spark and passed through the machine
one by one; the state is one role, whatever a conversation's length, so a
conversation that holds a third of all rows needs no memory (its turns are
sequential, so it stays in one task).

Defined results: null text is empty; a null or unknown role is marked by name
(null as '') and breaks the order; equal turns are ordered by role, then text;
repeated rows are turns of their own; a conversation whose order the machine
rejects is formatted all the same, with ``valid`` false; null conv_ids form one
conversation; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.common import read, small_batches, stored, width


@dataclass(frozen=True)
class Template:
    """Marks and rules; ``marks``: role -> (before, behind, loss)."""
    marks: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>", False),
        "user": ("[INST]", "[/INST]", False),
        "assistant": ("<s>", "</s>", True),
    })
    #: Marks of any other role: its name stands between the first two.
    other: tuple = ("[ROLE]", "[/ROLE]", "[/TURN]")
    #: state -> roles that may come next; '' means the conversation may end.
    order: dict = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", ""),
    })

    def controls(self) -> list[str]:
        own = {m for b, e, _ in self.marks.values() for m in (b, e)} | set(self.other)
        return sorted(own, key=lambda x: (-len(x), x))

    def escaper(self):
        find = re.compile("(" + "|".join([r"\\", *map(re.escape, self.controls())]) + ")")
        return lambda text: find.sub(r"\\\1", text)

    def reader(self):
        """Splits formatted text into ('mark', m) and ('text', unescaped)."""
        controls = "|".join(map(re.escape, self.controls()))
        find = re.compile(rf"\\(\\|{controls})|({controls})", re.S)

        def tokens(text: str):
            at, plain = 0, []
            for m in find.finditer(text):
                plain.append(text[at:m.start()])
                at = m.end()
                if m.group(1) is not None:
                    plain.append(m.group(1))
                    continue
                if any(plain):
                    yield "text", "".join(plain)
                plain = []
                yield "mark", m.group(2)
            plain.append(text[at:])
            if any(plain):
                yield "text", "".join(plain)
        return tokens


def _formatter(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape = template.escaper()
        conv, state, seq, good = object(), "start", 0, True
        for b in batches:
            rows: list[tuple] = []
            for c, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                if c != conv:
                    conv, state, seq, good = c, "start", 0, True
                role = role or ""
                good = good and role in template.order.get(state, ()) and role != ""
                state = role
                text = escape(text or "")
                if role in template.marks:
                    before, behind, loss = template.marks[role]
                    parts = [(before, False), (text, loss), (behind, False)]
                else:
                    a, z, behind = template.other
                    parts = [(a, False), (escape(role), False), (z, False), (text, False),
                             (behind, False)]
                ends = good and "" in template.order.get(state, ())
                for part, loss in parts:
                    rows.append((c, seq, role, part, loss, good, ends))
                    seq += 1
            cols = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(cols, _SEGMENT.types)], _SEGMENT.names)
    return run


_SEGMENT = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("role", pa.string()),
                      ("text", pa.string()), ("loss", pa.bool_()), ("valid", pa.bool_()),
                      ("may_end", pa.bool_())])


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> segments (conv_id, seq, role,
    text, loss, valid, may_end).  ``valid``: the machine accepted all turns so
    far; ``may_end``: and the conversation may end behind this one."""
    spark = turns.sparkSession
    small_batches(spark)
    return (turns.select(F.col("conv_id").cast("long"), F.col("role").cast("string"),
                         F.col("text").cast("string"), "turn")
            .repartition(width(spark), "conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_formatter(template), "conv_id long, seq long, role string, text string, "
                                              "loss boolean, valid boolean, may_end boolean"))


def _reading(template: Template):
    """Segments in order -> one row a conversation, from the formatted text
    and the loss mask alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = template.reader()
        opens = {b: (role, e) for role, (b, e, _) in template.marks.items()}
        a, z, behind = template.other

        class Conv:
            def __init__(self, conv_id):
                self.id, self.turns, self.chars = conv_id, 0, 0
                self.all, self.loss, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0
                self.until = self.named = None
                self.ends = False

            def say(self, text):
                self.all.update(text.encode("utf-8", "surrogatepass"))

            def mark(self, m):
                if self.until is None:
                    self.turns += 1
                    if m == a:
                        self.until, self.named = z, ""
                    else:
                        role, self.until = opens[m]
                        self.say(role + "\n")
                elif m != self.until:
                    raise ValueError(f"conversation {self.id}: {m} where {self.until} is due")
                elif m == z and self.named is not None:
                    self.say(self.named + "\n")
                    self.until, self.named = behind, None
                else:
                    self.say("\n")
                    self.until = None

            def text(self, t, loss):
                if self.until is None:
                    raise ValueError(f"conversation {self.id}: text outside a turn")
                if self.named is not None:
                    self.named += t
                    return
                self.say(t)
                if loss:
                    self.loss.update(t.encode("utf-8", "surrogatepass"))
                    self.loss_chars += len(t)

            def row(self):
                if self.until is not None:
                    raise ValueError(f"conversation {self.id}: {self.until} is missing")
                return (self.id, self.turns, self.all.hexdigest(), self.loss_chars,
                        self.loss.hexdigest(), self.chars, self.ends)

        conv = None
        for b in batches:
            rows = []
            for c, part, loss, ends in zip(*(b.column(i).to_pylist() for i in range(4))):
                if conv is None or c != conv.id:
                    if conv is not None:
                        rows.append(conv.row())
                    conv = Conv(c)
                conv.chars += len(part)
                conv.ends = ends
                for kind, t in tokens(part):
                    conv.mark(t) if kind == "mark" else conv.text(t, loss)
            if rows:
                yield _digest_rows(rows)
        if conv is not None:
            yield _digest_rows([conv.row()])
    return run


def _digest_rows(rows) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*rows), types)],
        ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
         "valid"])


def read_chats(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, parsed back from its segments."""
    spark = segments.sparkSession
    return (segments.select("conv_id", "text", "loss", "may_end", "seq")
            .repartition(width(spark), "conv_id").sortWithinPartitions("conv_id", "seq")
            .select("conv_id", "text", "loss", "may_end")
            .mapInArrow(_reading(template), "conv_id long, n_turns long, turns_sha256 string, "
                                            "loss_chars long, loss_sha256 string, "
                                            "formatted_chars long, valid boolean"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = (read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
             .unionByName(probe))
    return read_chats(stored(format_chats(turns), "chats"))


#: DuckDB twin of the query, marks as of the default template.
CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(regexp_replace(text,
           '(\\|<</SYS>>|\[/INST\]|\[/ROLE\]|\[/TURN\]|<<SYS>>|\[INST\]|\[ROLE\]|</s>|<s>)',
           '\\\1', 'g'))
         + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
           ELSE 20 + length(role) END AS chars,
         lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prev,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(CASE prev WHEN 'start' THEN role IN ('system', 'user')
                WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
                WHEN 'assistant' THEN role = 'user' ELSE false END)
         AND bool_or(back = 1 AND role = 'assistant') AS valid
FROM f GROUP BY conv_id
"""
