"""Chat formatting: schema fingerprints select declarative mappings into canonical turns, which a template marks up.

A record's fingerprint is the hash of its nested field paths, kept to those that some mapping names; array elements are
``[]``. A mapping says which paths a layout has and where its turns come from, so that a new layout is one more entry.

The template writes a turn as ``begin role middle text end``. In roles and texts, the escape character is doubled, and the
first character of every control string is followed by one escape character: no control string can then appear in them.
Reading back, a doubled escape character is one of it, and a single one is nothing.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Mapping:
    """A layout. ``turns``: (role, path) pairs taken in order, ``each``: (array path, role field, text field), or, where a
    record is one turn, ``one``: (conversation, order, role and text paths)."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    one: tuple[str, str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def fingerprints(self) -> Iterator[str]:
        for n in range(len(self.optional) + 1):
            for some in itertools.combinations(self.optional, n):
                yield fingerprint([*self.required, *some])


#: Names that other layouts use for the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content"), roles=ROLES),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), each=("conversations", "from", "value"), roles=ROLES),
    Mapping("turns", ("turns[].role", "turns[].text"), each=("turns", "role", "text"), roles=ROLES),
    Mapping("instruction", ("instruction", "output"), ("input", "system"), (("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("prompt", ("prompt", "response"), ("system",), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("completion", ("prompt", "completion"), ("system",), (("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Mapping("question", ("question", "answer"), ("context",), (("system", "context"), ("user", "question"), ("assistant", "answer"))),
    Mapping("rows", ("conv_id", "turn", "role", "text"), one=("conv_id", "turn", "role", "text"), roles=ROLES),
)


@dataclass(frozen=True)
class Template:
    """Control strings. ``also``: control strings of other templates that texts must not carry either."""

    begin: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    also: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    escape: str = "\\"
    learned: tuple[str, ...] = ("assistant",)

    def _inside(self) -> str:
        """Matches between the first and the second character of a control string."""
        controls = (self.begin, self.middle, self.end, *self.also)
        return "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in controls)

    def escaped(self, text: Column) -> Column:
        doubled = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        return F.regexp_replace(doubled, self._inside(), re.sub(r"([\\$])", r"\\\1", self.escape))

    def unescaped(self, text: Column) -> Column:
        e = re.escape(self.escape)
        return F.regexp_replace(text, f"{e}({e}?)", "$1")


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def registry(mappings=MAPPINGS) -> tuple[dict[str, Mapping], set[str]]:
    """Mappings by fingerprint, and all the paths that mappings name."""
    by = {}
    for m in mappings:
        for f in m.fingerprints():
            if by.setdefault(f, m) is not m:
                raise ValueError(f"layouts {by[f].name} and {m.name} have the same paths")
    return by, {p for m in mappings for p in (*m.required, *m.optional)}


def paths_of(value, at: str = "") -> Iterator[str]:
    """The nested field paths of a parsed JSON value."""
    if isinstance(value, dict):
        for k, v in value.items():
            yield from paths_of(v, f"{at}.{k}" if at else k)
    elif isinstance(value, list):
        for v in value:
            yield from paths_of(v, f"{at}[]")
    else:
        yield at


def paths_of_schema(kind: T.DataType, at: str = "") -> Iterator[str]:
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from paths_of_schema(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from paths_of_schema(kind.elementType, f"{at}[]")
    else:
        yield at


def mapping_of(kind: T.StructType, mappings=MAPPINGS) -> Mapping:
    """The mapping whose fingerprint the field paths of a table have.

    A table may have columns that no layout asks for, even ones that another layout names: of the layouts whose required paths are
    all there, those with most of them come first, and the fingerprint of the paths that one names must be one of its own.
    """
    there = set(paths_of_schema(kind))
    fitting = [m for m in mappings if set(m.required) <= there]
    for m in sorted(fitting, key=lambda m: (-len(m.required), mappings.index(m))):
        if fingerprint(there & {*m.required, *m.optional}) in set(m.fingerprints()):
            return m
    raise ValueError(f"no layout has the paths {sorted(there)}")


def turns_of_table(records: DataFrame, id_col: str | None = None, mappings=MAPPINGS, rename: bool = True) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a table in any known layout, as its mapping declares them.

    The mapping is found by the fingerprint of the table's nested field paths. Where a record is one turn, its own columns say which
    conversation and place it has; otherwise a record is a conversation, named by ``id_col``. Roles get their canonical names, or
    with ``rename`` false keep the table's. A null optional text and a null array element are no turn; a null or empty array gives
    no turns; other nulls stay null. Repeated rows stay repeated, an empty table gives no turns, and columns that the mapping does not name are ignored.
    """
    m = mapping_of(records.schema, mappings)

    def canonical(role: Column) -> Column:
        names = F.create_map(*[F.lit(x) for pair in m.roles.items() for x in pair]) if m.roles and rename else None
        return role if names is None else F.coalesce(names[role], role)

    if m.one:
        key, order, role, text = (F.col(c) for c in m.one)
        return records.select(key.alias("conv_id"), order.alias("turn"), canonical(role).alias("role"), text.alias("text"))
    if id_col is None:
        raise ValueError("id_col names the conversations")
    if m.each:
        path, role, text = m.each
        said = F.transform(path, lambda x, i: F.when(x.isNotNull(), F.struct(i.cast("long").alias("turn"), canonical(x[role]).alias("role"), x[text].alias("text"))))
    else:
        there = set(paths_of_schema(records.schema))
        own = [(role, path) for role, path in m.turns if path in there]
        said = F.array(*[
            F.when(F.col(path).isNotNull(), F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), F.col(path).cast("string").alias("text")))
            for i, (role, path) in enumerate(own)
        ])
    return records.select(F.col(id_col).alias("conv_id"), F.explode(F.array_compact(said)).alias("said")).select("conv_id", "said.*")


def turns_of_json(records: DataFrame, id_col: str, json_col: str, mappings=MAPPINGS) -> DataFrame:
    """Turns (conv_id, turn, role, text, layout) of JSON records in any known layout.

    Records that are no JSON object or have no known fingerprint give one row with layout null and no turn, so that none is
    lost silently. Null or missing optional texts give no turn; null texts of an array's elements are empty. Texts that
    are not strings are written as JSON. An empty array gives one row with its layout ``empty`` and no turn. An array element that
    is no object is a turn with a null role, whose text is its JSON. An empty table gives no rows; other columns are ignored.
    """
    kind = records.schema[id_col].dataType.simpleString()
    schema = f"conv_id {kind}, turn long, role string, text string, layout string"

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, known = registry(mappings)
        for batch in batches:
            rows: list[tuple] = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(key, *turn) for turn in _turns(raw, by, known)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "turn", "role", "text", "layout"])

    return records.select(F.col(id_col).alias("id"), F.col(json_col).alias("json")).mapInArrow(convert, schema)


def _turns(raw: str | None, by: dict[str, Mapping], known: set[str]) -> list[tuple]:
    try:
        record = json.loads(raw or "")
    except ValueError:
        record = None
    if not isinstance(record, dict):
        return [(None, None, None, None)]
    found = {p for p in paths_of(record) if p in known}
    mapping = by.get(fingerprint(found))
    if mapping is None:
        empty = [m.name for m in by.values() if m.each and record.get(m.each[0]) == []]
        return [(None, None, None, "empty" if empty else None)]

    def written(v) -> str:
        return v if isinstance(v, str) else "" if v is None else json.dumps(v, ensure_ascii=False, sort_keys=True)

    if mapping.each:
        items, role, text = (record[mapping.each[0]], *mapping.each[1:])
        said = [(written(x.get(role)), written(x.get(text))) if isinstance(x, dict) else (None, written(x)) for x in items]
        said = [(mapping.roles.get(r, r), t) for r, t in said]
    elif mapping.turns:
        said = [(role, written(record[path])) for role, path in mapping.turns if record.get(path) is not None]
    else:
        role = written(record.get(mapping.one[2]))
        said = [(mapping.roles.get(role, role), written(record.get(mapping.one[3])))]
    return [(i, r, t, mapping.name) for i, (r, t) in enumerate(said)]


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Formatted parts, one per canonical turn (conv_id, turn, role, text): conv_id, turn, part, loss_from, loss_chars.

    A conversation's text is its parts in the order of (turn, part), nulls first; it is never gathered in one row, so a
    conversation may have any number of turns. The loss mask of a part covers ``loss_chars`` code points from
    ``loss_from`` (0-based): the escaped text of a learned role, else nothing. Null roles and texts are empty. Turns that
    tie are ordered by what they say; repeated rows stay repeated. No rows give no parts. Other columns are ignored, whatever
    their names.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said, head = template.escaped(text), F.concat(F.lit(template.begin), template.escaped(role), F.lit(template.middle))
    learned = role.isin(*template.learned)
    return turns.select("conv_id", "turn", said.alias("_said"), head.alias("_head"), learned.alias("_learned")).select(
        "conv_id",
        "turn",
        F.concat("_head", "_said", F.lit(template.end)).alias("part"),
        F.when(F.col("_learned"), F.length("_head")).otherwise(0).alias("loss_from"),
        F.when(F.col("_learned"), F.length("_said")).otherwise(0).alias("loss_chars"),
    )


def read_parts(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """What formatted parts say: conv_id, turn, role, text, masked (unescaped text under the mask, or null), part_chars."""
    b, m, e = (re.escape(x) for x in (template.begin, template.middle, template.end))
    whole = f"(?s)^{b}(.*?){m}(.*){e}$"
    under = F.substring(F.col("part"), F.col("loss_from") + 1, F.col("loss_chars"))
    return parts.select(
        "conv_id",
        "turn",
        template.unescaped(F.regexp_extract("part", whole, 1)).alias("role"),
        template.unescaped(F.regexp_extract("part", whole, 2)).alias("text"),
        F.when(F.col("loss_from") > 0, template.unescaped(under)).alias("masked"),
        F.length("part").alias("part_chars"),
    )


def conversation_digests(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, read back from its parts: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns of a conversation pass a running digest in order, so memory does not grow with a conversation.
    """
    read = read_parts(parts, template).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = parts.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        done: list[tuple] = []
        now = None  # [conv_id, turns, digest, loss chars, loss digest, chars]
        key_type = None

        def close() -> None:
            done.append((now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]))

        def rows() -> pa.RecordBatch:
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            key_type = batch.schema.field(0).type
            for key, role, text, masked, chars in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                if now is None or now[0] != key:
                    if now is not None:
                        close()
                    now = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                if masked is not None:
                    now[3] += len(masked)
                    now[4].update(masked.encode())
                now[5] += chars
            if done:
                yield rows()
                done = []
        if now is not None:
            close()
            yield rows()

    return read.mapInArrow(digest, schema)
