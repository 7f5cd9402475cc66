"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns stream through the machine in (conversation, turn) order, so memory does not depend on how long a conversation
is. Each turn becomes text segments with a loss flag; control strings inside texts are escaped and can be restored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import small_batches, text_or_empty


@dataclass(frozen=True)
class Template:
    """What stands around each role's text, which texts are learned, and which role may follow which.

    ``other`` marks a role without marks of its own: ``{role}`` in it is the escaped role. ``after`` maps a state (the
    last role, or ``start``) to the roles that may come next; ``accept`` lists the states a conversation may end in.
    """

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<s><<SYS>>\n", "\n<</SYS>>\n"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": ("[OUT] ", " </s>\n"),
        }
    )
    other: tuple[str, str] = ("[ROLE:{role}] ", " [/ROLE]\n")
    loss: frozenset[str] = frozenset({"assistant"})
    after: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "start": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    accept: frozenset[str] = frozenset({"assistant"})

    def controls(self) -> list[str]:
        """Strings that may not occur inside a text; with the escape sign's own string they guide the escaping."""
        pairs = [*self.marks.values(), tuple(x.split("{role}")[0] for x in self.other)]
        found = {mark.strip() for pair in pairs for mark in pair} | {"<s>", "</s>"}
        return sorted(found, key=lambda x: (-len(x), x))


DEFAULT = Template()
SIGN = "\\"


def escaper(template: Template):
    """Return (escape, restore): the sign is doubled, the first character of a control string becomes sign + code."""
    inside = re.compile("|".join([re.escape(SIGN), *(re.escape(x) for x in template.controls())]))
    signs = re.compile(re.escape(SIGN) + r"(?:u([0-9a-f]{6})|" + re.escape(SIGN) + ")")

    def escape(text: str) -> str:
        text = inside.sub(lambda m: SIGN * 2 if m[0] == SIGN else f"{SIGN}u{ord(m[0][0]):06x}{m[0][1:]}", text)
        while (again := inside.search(re.sub(re.escape(SIGN) + r"(?:u[0-9a-f]{6}|" + re.escape(SIGN) + ")", lambda m: "\0" * len(m[0]), text))) is not None:
            # A control string may come together again behind the part that was just escaped.
            text = f"{text[:again.start()]}{SIGN}u{ord(text[again.start()]):06x}{text[again.start() + 1:]}"
        return text

    def restore(text: str) -> str:
        return signs.sub(lambda m: chr(int(m[1], 16)) if m[1] else SIGN, text)

    return escape, restore


SEGMENTS = "conv_id long, turn_no long, segment int, text string, loss boolean, valid boolean"


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _out(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def _emit(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 2048) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _out(held, names, types)
            held = []
    if held:
        yield _out(held, names, types)


def format_segments(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """conversations (conv_id, turn, role, text) to segments: conv_id, turn_no, segment, text, loss, valid.

    turn_no numbers the turns of a conversation from 0 in (turn, role, text) order, null turns first; segments 0, 1, 2
    of a turn are its opening mark, its escaped text and its closing mark, and their texts in order are the formatted
    conversation. valid tells whether the machine accepted the turns up to this one; the rows of a refused conversation
    are formatted all the same. Null texts and null roles count as empty strings, a null conv_id is a conversation of
    its own, repeated rows are turns, other columns are ignored, an empty table gives an empty result.
    """
    small_batches(turns.sparkSession)
    marks, other, loss, after = template.marks, template.other, template.loss, template.after
    names, types = ["conv_id", "turn_no", "segment", "text", "loss", "valid"], [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escape, _ = escaper(template)

        def segments():
            current, state, ok, number = object(), "start", True, 0
            for conv, _, role, text in _rows(batches):
                if conv != current:
                    current, state, ok, number = conv, "start", True, 0
                ok = ok and role in after.get(state, ())
                state = role
                pair = marks.get(role) or tuple(x.replace("{role}", escape(role).replace("]", f"{SIGN}u{ord(']'):06x}")) for x in other)
                for k, (part, learn) in enumerate(((pair[0], False), (escape(text), role in loss), (pair[1], False))):
                    yield conv, number, k, part, learn, ok
                number += 1

        yield from _emit(segments(), names, types)

    return (
        turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_or_empty(F.col("role")).alias("role"), text_or_empty(F.col("text")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, SEGMENTS)
    )


def read_back(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Parse formatted conversations again: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid.

    ``segments`` must come in order within their partitions, as ``format_segments`` leaves them; others are an error. Roles
    and texts are taken from the running text by its marks, not from the segments' numbers; the loss flags say what is
    learned. A conversation may be of any length, a turn is held whole.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    turn = "|".join(f"(?:{re.escape(a)}(?P<{role}>.*?){re.escape(b)})" for role, (a, b) in template.marks.items())
    (before, behind), end = template.other[0].split("{role}"), template.other[1]
    pattern = re.compile(f"{turn}|(?:{re.escape(before)}(?P<_role>.*?){re.escape(behind)}(?P<_text>.*?){re.escape(end)})", re.DOTALL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, restore = escaper(template)

        def conversations():
            current, open_ = None, False
            for conv, turn_no, segment, text, learn, ok in _rows(batches):
                if open_ and conv == current:
                    if (turn_no, segment) <= at:
                        raise ValueError(f"conversation {conv}: turn {turn_no}, segment {segment} comes after {at}")
                elif (turn_no, segment) != (0, 0):
                    raise ValueError(f"conversation {conv} begins with turn {turn_no}, segment {segment}")
                at = turn_no, segment
                if not open_ or conv != current:
                    if open_:
                        yield finish()
                    current, open_, held = conv, True, ""
                    turns, learned, n_turns, n_loss, n_all, valid, state = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, True, "start"

                    def finish():
                        if held:
                            raise ValueError(f"conversation {current}: unread text {held[:40]!r}")
                        return current, n_turns, turns.hexdigest(), n_loss, learned.hexdigest(), n_all, valid and state in template.accept

                n_all += len(text)
                valid = valid and ok
                if learn:
                    plain = restore(text)
                    n_loss += len(plain)
                    learned.update(plain.encode())
                held += text
                if segment != 2:
                    continue
                while m := pattern.match(held):
                    role = m.lastgroup if m.lastgroup != "_text" else restore(m["_role"])
                    plain = restore(m[m.lastgroup])
                    turns.update(f"{role}\n{plain}\n".encode())
                    n_turns, held, state = n_turns + 1, held[m.end() :], role
            if open_:
                yield finish()

        yield from _emit(conversations(), names, types)

    return segments.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def oracle_sql(template: Template = DEFAULT) -> str:
    """DuckDB SQL for the digests, with the added conversation -1. Lengths follow from the marks and from how often
    control strings occur; it is exact as long as these do not overlap in a text."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    controls = "|".join(re.escape(x) for x in template.controls())
    marks = " ".join(f"when {quoted(role)} then {len(a) + len(b)}" for role, (a, b) in template.marks.items())
    escaped = lambda c: f"length({c}) + 7 * len(regexp_extract_all({c}, {quoted(controls)})) + length({c}) - length(replace({c}, chr(92), ''))"
    other = f"{len(template.other[0]) - len('{role}') + len(template.other[1])} + {escaped('role')} + 7 * (length(role) - length(replace(role, ']', '')))"
    follows = " or ".join(f"(coalesce(before, 'start') = {quoted(state)} and role in ({', '.join(map(quoted, sorted(roles)))}))" for state, roles in template.after.items())
    loss = ", ".join(map(quoted, sorted(template.loss)))
    accept = ", ".join(map(quoted, sorted(template.accept)))
    return f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o as (select *, row_number() over w as n, lag(role) over w as before, lead(role) over w as behind from t window w as (partition by conv_id order by turn nulls first, role, text)),
f as (select *, case role {marks} else {other} end + {escaped('text')} as chars, ({follows}) and (behind is not null or role in ({accept})) as ok, role in ({loss}) as learned from o)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256, coalesce(cast(sum(length(text)) filter (learned) as bigint), 0) as loss_chars,
 sha256(coalesce(string_agg(text, '' order by n) filter (learned), '')) as loss_sha256, cast(sum(chars) as bigint) as formatted_chars, bool_and(ok) as valid from f group by 1
"""
