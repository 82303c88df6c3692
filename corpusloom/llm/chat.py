"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a declarative template.

`segments` turns each row (a turn) into its segments with built-in functions; `read_back` streams the formatted turns
of each conversation in order through a parser and the machine. A conversation is never collected: rows are sorted
within a partition and digests are updated turn by turn, so a conversation of any length needs the memory of one
batch. Escaping and formatting, the work that grows with the text, happen before the shuffle on every partition.

Defined cases: null text counts as empty, a null role as the role without a name; rows with a null conversation id are
one conversation; turns of equal number are ordered by role, then text (repeated rows stay repeated turns). Roles that the
template does not name get a header with the encoded name and make the conversation invalid, as do turns out of order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import bounded_batches, table


@dataclass(frozen=True)
class Template:
    """Headers by role, the mark that ends a turn, roles whose text bears loss, and the machine's transitions."""

    headers: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: str = "### @"
    end: str = " </turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    #: State -> role -> next state. Conversations begin in "start" and are whole in a state of `final`.
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    final: tuple[str, ...] = ("answered",)

    @property
    def controls(self) -> list[str]:
        """What texts may not show unescaped."""
        return [*(h.rstrip() for h in self.headers.values()), self.other, self.end.strip()]


CHAT = Template()


def escaped(text, template: Template = CHAT):
    """A backslash before each backslash and each control string of a text column."""
    pattern = "|".join([r"\\", *(re.escape(c).replace(r"\ ", " ") for c in sorted(template.controls, key=len, reverse=True))])
    return F.regexp_replace(text, f"({pattern})", r"\\$1")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def segments(df: DataFrame, template: Template = CHAT, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per row: conv_id, turn, role, raw (the text) and segments, an array of (text, loss) whose texts make the turn's format."""
    name, body = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    head = F.concat(F.lit(template.other), F.url_encode(name), F.lit(": "))
    for known, h in template.headers.items():
        head = F.when(name == known, F.lit(h)).otherwise(head)
    segment = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    return df.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), name.alias("role"), body.alias("raw"),
        F.array(segment(head, F.lit(False)), segment(escaped(body, template), name.isin(*template.loss)), segment(F.lit(template.end), F.lit(False))).alias("segments"),
    )


class Machine:
    """Runs a template's transitions over roles."""

    def __init__(self, template: Template):
        self.template, self.state, self.error, self.n = template, "start", "", 0

    def step(self, role: str) -> None:
        self.n += 1
        to = self.template.moves.get(self.state, {}).get(role)
        if to is None and not self.error:
            self.error = f"turn {self.n}: {role or 'no role'} after {self.state}"
        self.state = to or self.state

    def verdict(self) -> str:
        return self.error or ("" if self.state in self.template.final else f"ends in {self.state}")


def parsed(text: str, template: Template = CHAT) -> Iterator[tuple[str, str, bool]]:
    """Role, unescaped text and loss flag of each turn of a formatted text."""
    names = {h: r for r, h in template.headers.items()}
    token = re.compile("|".join([r"\\.", *(f"(?:{re.escape(h)})" for h in names), re.escape(template.other) + "[^:]*: ", re.escape(template.end)]), re.S)
    role, begun = None, 0
    for m in token.finditer(text):
        t = m.group()
        if t[0] == "\\":
            continue
        if t == template.end:
            if role is None:
                raise ValueError("a turn ends that did not begin")
            yield role, unescaped(text[begun : m.start()]), role in template.loss
            role = None
        elif role is None:
            role, begun = names.get(t, unquote_plus(t[len(template.other) : -2])), m.end()
        else:
            raise ValueError("a turn begins inside another")


RESULTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, problem string"


class _State:
    def __init__(self, ident: object, template: Template):
        self.ident, self.template = ident, template
        self.turns, self.loss, self.machine = hashlib.sha256(), hashlib.sha256(), Machine(template)
        self.n = self.loss_chars = self.chars = 0

    def read(self, text: str) -> None:
        self.chars += len(text)
        for role, body, loss in parsed(text, self.template):
            self.n += 1
            self.machine.step(role)
            self.turns.update(f"{role}\n{body}\n".encode())
            if loss:
                self.loss_chars += len(body)
                self.loss.update(body.encode())

    def row(self) -> dict:
        problem = self.machine.verdict()
        return {"conv_id": self.ident, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars, "valid": not problem, "problem": problem}


def read_back(segs: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per conversation, read from its formatted turns in order."""
    bounded_batches(segs.sparkSession)
    schema = T._parse_datatype_string(RESULTS)
    kinds = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("problem", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _State | None = None
        for batch in batches:
            done: list[dict] = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                to = at
                while to < len(ids) and ids[to] == ids[at]:
                    to += 1
                if state is None or state.ident != ids[at]:
                    if state is not None:
                        done.append(state.row())
                    state = _State(ids[at], template)
                state.read("".join(texts[at:to]))
                at = to
            if done:
                yield pa.RecordBatch.from_pylist(done, kinds)
        if state is not None:
            yield pa.RecordBatch.from_pylist([state.row()], kinds)

    turns = segs.select("conv_id", "turn", "role", "raw", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "raw").select("conv_id", "formatted").mapInArrow(run, schema)


#: A conversation that says the template's own control strings.
PROBE = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(segments(rows.unionByName(probe))).drop("problem")


ORACLE_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
), f AS (
  SELECT *, length('### : ') + length(role) + length(regexp_replace(text, '(\\|### System:|### User:|### Assistant:|### @|</turn>)', '\\\1', 'g')) + length(' </turn>') + 1 AS n FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(role, ' ' ORDER BY turn, role, text), '(system )?user assistant( user assistant)*') AS valid
FROM f GROUP BY conv_id
"""
