"""Chat formatting: schema fingerprints select declarative mappings; native expressions only.

A record is one JSON object of any layout.  Its nested field paths, scalar types
left out, are hashed; the hash selects a mapping that says where turns, roles and
texts stand.  Turns are written between markers.  In texts and roles a backslash
is doubled and one is put after the first character of every control string, so
no text contains a marker and the change can be undone.  The loss mask is the
ranges of code points of assistant texts.

Defined cases: null roles and texts count as empty; null, malformed and unknown
records have layout null and no turns; ties of a turn number go by role, then
text; repeated rows are repeated turns; extra columns are kept by
`format_records` unless their names clash, then they give way.  One conversation
is one row, as its digest needs all of it in order.  Records built from rows are
parsed for their field paths as any others; for those of over 20 million characters
they carry their paths, as Spark parses no JSON of over 128 MiB, nor any text of over
20 million characters; other records of that length that it cannot parse raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, MASKED = "<|im_start|>", "<|im_end|>", "assistant"
#: Control strings of public chat templates.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURNS = "array<struct<role:string,text:string>>"
#: Characters of a record that try_parse_json reads whatever its fields are, and the option that lets from_json read longer texts.
PARSED, LONG_TEXTS = 20_000_000, {"maxStringLen": str(2**31 - 1)}


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout stand: a list with role and text fields, or fields of one turn each."""

    name: str
    shape: str
    turns: str = ""
    role: str = ""
    text: str = ""
    roles: dict = field(default_factory=dict)
    single: tuple = ()

    def read(self, record: Column) -> Column:
        if self.single:
            read = F.from_json(record, ", ".join(f"`{f}` string" for _, f in self.single), LONG_TEXTS)
            return F.array(*(F.struct(F.lit(r).alias("role"), read[f].alias("text")) for r, f in self.single)).cast(TURNS)
        read = F.from_json(record, f"`{self.turns}` array<struct<`{self.role}`:string,`{self.text}`:string>>", LONG_TEXTS)[self.turns]

        def role(t: Column) -> Column:
            out = t[self.role]
            for old, new in self.roles.items():
                out = F.when(t[self.role] == old, new).otherwise(out)
            return out

        return F.transform(read, lambda t: F.struct(role(t).alias("role"), t[self.text].alias("text"))).cast(TURNS)


MAPPINGS = (
    Mapping("messages", "OBJECT<messages:ARRAY<OBJECT<content,role>>>", "messages", "role", "content"),
    Mapping("conversations", "OBJECT<conversations:ARRAY<OBJECT<from,value>>>", "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    Mapping("prompt", "OBJECT<completion,prompt>", single=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", "OBJECT<input,instruction,output>", single=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction without input", "OBJECT<instruction,output>", single=(("user", "instruction"), ("assistant", "output"))),
)


def shape(record: Column) -> Column:
    """Nested field paths of a JSON text, without scalar types."""
    schema = F.schema_of_variant(F.try_parse_json(record))
    schema = F.regexp_replace(schema, r": (?!OBJECT|ARRAY)[A-Z_]+(\([0-9, ]*\))?", "")
    return F.regexp_replace(schema, r"([:,]) ", "$1")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(shape(record))


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        text = F.replace(text, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def format_records(records: DataFrame, record: str = "record", paths: str | None = None) -> DataFrame:
    """Adds layout, formatted and loss_spans (start, end in code points of formatted).

    Each record's own field paths tell its layout.  `paths` names a column of known field paths, written as by `shape`;
    they hold only where a record is too long to be parsed.
    """
    known = fingerprint(F.col(record))
    if paths is not None:
        known = F.xxhash64(F.when(F.length(record) > PARSED, F.col(paths)).otherwise(shape(F.col(record))))
    # in a column, so that a record is parsed once for all mappings
    records, columns = records.withColumn("_known", known), records.columns
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in MAPPINGS:
        hit = F.col("_known") == F.xxhash64(F.lit(m.shape))
        layout, turns = F.when(hit, m.name).otherwise(layout), F.when(hit, m.read(F.col(record))).otherwise(turns)
    kept = [c for c in columns if c == record or c.lower() not in ("layout", "formatted", "loss_spans", "_turns", "_known")]
    lost = shape(F.col(record)).isNull() & (F.length(record) > PARSED) if paths is None else F.col(record).isNotNull()
    none = F.when(lost, F.raise_error(F.lit("chat record too long to parse, or of no known layout")).cast(TURNS)).otherwise(F.array().cast(TURNS))
    out = records.select(*kept, layout.alias("layout"), F.coalesce(turns, none).alias("_turns"))
    written = F.transform("_turns", lambda t: F.struct(F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("text"), (F.coalesce(t["role"], F.lit("")) == MASKED).alias("masked")))
    out = out.withColumn("_turns", written)
    spans = F.aggregate(
        "_turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["text"]) + len(END) + 1).alias("at"),
            F.when(t["masked"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(t["head"])).alias("start"), (s["at"] + F.length(t["head"]) + F.length(t["text"])).alias("end"))))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    text = F.array_join(F.transform("_turns", lambda t: F.concat(t["head"], t["text"], F.lit(END + "\n"))), "")
    return out.withColumns({"formatted": text, "loss_spans": spans}).drop("_turns")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text (array of role, text), unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")
    pattern = r"(?s)^<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*)$"
    return F.transform(parts, lambda p: F.struct(unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record, paths): conversations kept as rows by turn, each in the smallest layout that holds it."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    roles, text = F.col("turns.role"), lambda i: F.get(F.col("turns.text"), F.lit(i))
    pair = F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion")))
    three = F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output")))
    many = F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages")))
    array = lambda *names: F.array(*map(F.lit, names))
    shapes = {m.name: F.lit(m.shape) for m in MAPPINGS}

    def by_roles(two: Column, all_three: Column, others: Column) -> Column:
        return F.when(roles == array("user", "assistant"), two).when(roles == array("system", "user", "assistant"), all_three).otherwise(others)

    return turns.select("conv_id", by_roles(pair, three, many).alias("record"), by_roles(shapes["prompt"], shapes["instruction"], shapes["messages"]).alias("paths"))
