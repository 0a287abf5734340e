"""Repair of conversation structure: a forward Viterbi pass over four grammar states.

A sound conversation has role initials ``(s?(ua)+)?``. Every turn is kept, given another role, or deleted, and turns
may be inserted between them; the pass finds the edits of least cost, and of those the least audit string. A
conversation's turns pass through one task in order, as its digest is that of one ordered text, but they stream: a
state's path is remembered only as far back as the paths of the four states differ, and turns on which they agree
leave at once. So a conversation of any length needs little memory, and no group is ever collected.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import bounded, released, table

#: Costs of the edits, and of a truncated turn that stays. Fixed values.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn of this initial leads.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that may be inserted or given in a state, and where it leads.
WANTED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Two inserts lead from any state to any that inserts reach; a third would only come back.
MOST_INSERTS = 2
#: Letters that paths may have before their common beginning is looked for.
_SLACK = 16
_SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ("conv_id", "turn", "role", "text")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with planted faults by the crc32 of ``conv_id:turn``, modulo 20.

    0 drops the row (it stays here with ``gone`` true, so that its conversation is known), 1 empties its text, 2
    removes ``[.!?]``, 3 repeats it, 4 makes it the user's. Nulls in role, text and that key count as one space.
    """
    blank = F.lit(" ")
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), blank) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")])
    kind = F.col("_kind")
    out = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_kind"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = out.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"), kind.alias("_kind"))
    return out.withColumn("_copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_kind", "_copy")


def _faults() -> Column:
    """The first fault of a turn: b(lank), d(uplicate), t(runcated) or none. ``_seen`` counts its equals so far."""
    last = F.right(F.rtrim(F.col("text"), F.lit(_SPACE)), F.lit(1))
    return F.when(last == "", "b").when(F.col("_seen") > 1, "d").when(~last.isin(".", "!", "?"), "t").otherwise("")


def ordered(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """Rows of conversations in order, each conversation within one partition: by turn (nulls first), then role and
    text, so that ties have one order. Adds ``fault``. Both sorts spill; one exchange serves them."""
    absent = F.col(gone) if gone else F.lit(False)
    rows = rows.select(*COLUMNS[:2], F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), absent.alias("gone"))
    equals = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")
    rows = rows.repartition("conv_id").withColumn("_seen", F.row_number().over(equals)).withColumn("fault", _faults())
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text", "_seen").drop("_seen")


class Repair:
    """One conversation. ``take`` is called for each turn in order, ``end`` once; ``emit(edit, role, text, turn)``
    is called for each edit in order, as soon as no later turn can change it."""

    def __init__(self, emit: Callable[[str, str, str | None, int | None], None]) -> None:
        self.emit = emit
        self.paths = self._closed({START: (0, "")})
        self.held: list[tuple[str, str, int | None]] = []
        self.state = START
        self.audit: list[str] = []

    @staticmethod
    def _closed(paths: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
        for _ in range(MOST_INSERTS):
            for state, (cost, path) in list(paths.items()):
                to, new = WANTED[state][1], (cost + INSERT, path + "I")
                if to not in paths or new < paths[to]:
                    paths[to] = new
        return paths

    def take(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial, extra = role[:1], TRUNCATED if fault == "t" else 0
        out: dict[int, tuple[int, str]] = {}
        for state, (cost, path) in self.paths.items():
            ways = [(state, (cost + DELETE, path + "D"))]
            if fault not in ("b", "d"):
                if (state, initial) in NEXT:
                    ways.append((NEXT[state, initial], (cost + extra, path + "K")))
                ways.append((WANTED[state][1], (cost + extra + REROLE, path + "R")))
            for to, new in ways:
                if to not in out or new < out[to]:
                    out[to] = new
        self.paths = paths = self._closed(out)
        self.held.append((role, text, turn))
        # Whatever follows, the way over ASSISTANT costs less: it lacks only a system turn, which deleting makes up for.
        least = paths[ASSISTANT][0]
        if START in paths and least + DELETE < paths[START][0]:
            del paths[START]
        if SYSTEM in paths and least < paths[SYSTEM][0]:
            del paths[SYSTEM]
        if len(paths[ASSISTANT][1]) > _SLACK:
            self._settle(os.path.commonprefix([p for _, p in paths.values()]))

    def _settle(self, letters: str) -> None:
        if not letters:
            return
        used = 0
        for letter in letters:
            role, text, turn = ("", "", None) if letter == "I" else self.held[used]
            used += letter != "I"
            if letter == "D":
                self.emit(letter, role, text, turn)
                continue
            if letter == "K":
                self.state = NEXT[self.state, role[:1]]
            else:
                role, self.state = WANTED[self.state]
            self.emit(letter, role, text, turn)
        del self.held[:used]
        self.audit.append(letters)
        self.paths = {s: (c, p[len(letters) :]) for s, (c, p) in self.paths.items()}

    def end(self) -> tuple[int, str]:
        """Cost and audit. Sound conversations end after an assistant's turn, or hold none."""
        cost, path = min(self.paths[s] for s in (START, ASSISTANT) if s in self.paths)
        self.paths = {}
        self._settle(path)
        return cost, "".join(self.audit)


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conversation, its rows in order) of a sorted partition; rows must be read before the next conversation."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    following = next(rows, None)

    while following is not None:
        conv = following[0]

        def own() -> Iterator[tuple]:
            nonlocal following
            while following is not None and following[0] == conv:
                yield following
                following = next(rows, None)

        turns = own()
        yield conv, turns
        for _ in turns:
            pass


def _sized(rows: Iterator[tuple], types: list[pa.DataType], names: list[str], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size."""
    held: list[tuple] = []
    size = 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(v) for v in r if isinstance(v, str))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of all conversations in order: conv_id, place (from 0), edit (K, R, D or I), role, text, turn.

    ``rows`` has conv_id, turn, role, text; further columns are not looked at. Rows with edit D are those taken out;
    the others are the repaired conversation. Inserted turns have empty texts and no turn. Null roles and texts count
    as one space, null turns come first, rows without conv_id are one conversation. Equal rows are told apart by
    being repeats, so all but one are deleted. An empty table gives an empty one.
    """
    bounded(rows.sparkSession)
    kinds = dict(rows.select("conv_id", "turn").dtypes)
    schema = f"conv_id {kinds['conv_id']}, place bigint, edit string, role string, text string, turn {kinds['turn']}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        own, turns = first.schema.field("conv_id").type, first.schema.field("turn").type

        def edits() -> Iterator[tuple]:
            for conv, of_it in _by_conversation(_chained(first, batches)):
                out: list[tuple] = []
                repair, place = Repair(lambda *edit, out=out: out.append(edit)), 0
                for _, turn, role, text, gone, fault in of_it:
                    if not gone:
                        repair.take(turn, role, text, fault)
                    for edit, r, t, at in out:
                        yield conv, place, edit, r, t, at
                        place += 1
                    out.clear()
                repair.end()
                for edit, r, t, at in out:
                    yield conv, place, edit, r, t, at
                    place += 1

        yield from _sized(edits(), [own, pa.int64(), pa.string(), pa.string(), pa.string(), turns], ["conv_id", "place", "edit", "role", "text", "turn"])

    return ordered(rows).mapInArrow(released(run), schema)


def _chained(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


LEGAL = ("su", "ua", "au")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summary(rows: DataFrame, gone: str | None = None) -> DataFrame:
    """One row a conversation: conv_id, gaps, counts of faults, illegal neighbours, cost, audit, repaired_sha256.

    ``rows`` as for ``repaired``; the column ``gone`` names marks rows that only stand for their conversation. One without
    other rows has zeros, an empty audit and the digest of the empty text. Turns are whole numbers.
    """
    bounded(rows.sparkSession)
    kind = dict(rows.select("conv_id").dtypes)["conv_id"]
    schema = f"conv_id {kind}, {', '.join(f'{c} bigint' for c in _COUNTS)}, audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return

        def rows_out() -> Iterator[tuple]:
            for conv, of_it in _by_conversation(_chained(first, batches)):
                digest, any_kept = hashlib.sha256(), False

                def emit(edit: str, role: str, text: str | None, turn: int | None) -> None:
                    nonlocal any_kept
                    if edit != "D":
                        digest.update(f"{chr(10) if any_kept else ''}{role}:{text}".encode())
                        any_kept = True

                repair = Repair(emit)
                faults = {"b": 0, "d": 0, "t": 0, "": 0}
                illegal = distinct = 0
                low = high = before = None
                for _, turn, role, text, gone, fault in of_it:
                    if gone:
                        continue
                    faults[fault] += 1
                    illegal += before is not None and before + role[:1] not in LEGAL
                    before = role[:1]
                    if turn is not None:
                        low = turn if low is None else low
                        distinct += turn != high
                        high = turn
                    repair.take(turn, role, text, fault)
                cost, audit = repair.end()
                gaps = high - low + 1 - distinct if distinct else 0
                yield conv, gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, digest.hexdigest()

        yield from _sized(rows_out(), [first.schema.field("conv_id").type, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()], ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    return ordered(rows, gone).mapInArrow(released(run), schema)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and repairs of all conversations, after planted damage."""
    return summary(damaged(table(spark, sf_dir, "conversations").select(*COLUMNS)), gone="gone")


def _oracle() -> str:
    """The same by recursion over the places of each conversation. A path is its cost in twelve digits, then its audit."""
    add = lambda x, cost, letter: f"lpad((substr({x}, 1, 12)::bigint + {cost})::varchar, 12, '0') || substr({x}, 13) || '{letter}'"
    least = lambda *ways: f"list_min([{', '.join(ways)}])"
    stays = "fault not in ('b', 'd')"
    extra = "(fault = 't')::int"
    kept = lambda x, initial: f"case when {stays} and initial = '{initial}' then {add(x, extra, 'K')} end"
    given = lambda x: f"case when {stays} then {add(x, f'{REROLE} + {extra}', 'R')} end"
    gone = lambda x: add(x, DELETE, "D")
    closed = lambda a, b, u, s: (
        f"select conv_id, pos, {a} as a, {b} as b, {least(u, add(a, INSERT, 'I'), add(b, INSERT, 'I'), add(s, INSERT, 'I'))} as u, "
        f"{least(s, add(u, INSERT, 'I'), add(a, 2 * INSERT, 'II'), add(b, 2 * INSERT, 'II'))} as s"
    )
    to_user = ", ".join(f(x) for x in ("p.a", "p.b", "p.s") for f in (lambda x: kept(x, "u"), given))
    return f"""
with recursive crc as (select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
raw as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 as kind from conversations, crc),
hurt as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
  case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text from raw, range(case when kind = 3 then 2 else 1 end) where kind <> 0),
placed as (select *, left(role, 1) as initial, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
  right(regexp_replace(text, '[\\x20\\x09-\\x0D]+$', ''), 1) as last from hurt),
turns as (select conv_id, pos, turn, role, text, initial, case when last = '' then 'b' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'd' when last not in ('.', '!', '?') then 't' else '' end as fault,
  lag(initial) over (partition by conv_id order by pos) as before from placed),
convs as (select distinct conv_id from conversations),
path as (select conv_id, 0::bigint as pos, lpad('', 12, '0') as a, null::varchar as b, lpad('{INSERT}', 12, '0') || 'I' as u, lpad('{2 * INSERT}', 12, '0') || 'II' as s from convs
  union all ({closed("a", "b", "u", "s")} from (select t.conv_id, t.pos, {gone("p.a")} as a, {least(gone("p.b"), kept("p.a", "s"))} as b,
    {least(gone("p.u"), to_user)} as u, {least(gone("p.s"), kept("p.u", "a"), given("p.u"))} as s
    from path p join turns t on t.conv_id is not distinct from p.conv_id and t.pos = p.pos + 1))),
ended as (select conv_id, least(a, s) as best from path qualify row_number() over (partition by conv_id order by pos desc) = 1),
letters as (select conv_id, best, unnest(string_split(substr(best, 13), '')) as letter, generate_subscripts(string_split(substr(best, 13), ''), 1) as i from ended where length(best) > 12),
steps as (select *, sum((letter <> 'I')::int) over (partition by conv_id order by i) as pos, sum((letter <> 'D')::int) over (partition by conv_id order by i) as e from letters),
shown as (select s.conv_id, s.i, s.e, s.letter, t.role, case when s.letter = 'I' then '' else t.text end as text,
  max((s.e = 1 and s.letter = 'K' and t.initial = 's')::int) over (partition by s.conv_id) as sys
  from steps s left join turns t on t.conv_id is not distinct from s.conv_id and t.pos = s.pos where s.letter <> 'D'),
hashed as (select conv_id, sha256(string_agg((case when letter = 'K' then role when (e - sys) % 2 = 1 then 'user' else 'assistant' end) || ':' || text, chr(10) order by i)) as h from shown group by conv_id),
counts as (select conv_id, case when count(turn) > 0 then max(turn) - min(turn) + 1 - count(distinct turn) else 0 end::bigint as gaps, count(*) filter (fault = 'b') as blank,
  count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (before || initial not in ('su', 'ua', 'au')) as illegal from turns group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  substr(best, 1, 12)::bigint as cost, substr(best, 13) as audit, coalesce(h, sha256('')) as repaired_sha256
from ended e left join counts c on c.conv_id is not distinct from e.conv_id left join hashed x on x.conv_id is not distinct from e.conv_id"""


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES = {"op12_conversation_repair": _oracle()}
