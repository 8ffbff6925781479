"""Chat formatting: records of any known layout become canonical turns, then one text with a loss mask.

A record is JSON.  The paths of its fields, types left out, are hashed to a fingerprint, and
the fingerprint selects a mapping from a table of layouts.  A record of no known
layout stays in the result with a null ``layout`` and no turns, so that its fingerprint can be looked up and a layout added.

A record may hold its texts itself, or numbers of texts that stand beside it: JSON readers refuse very long strings, and the shape of a record
needs none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import sha256_hex


@dataclass(frozen=True)
class Layout:
    """A layout is known by examples, one for each set of fields that it can have.

    ``turns``: path of the list of turns, and in it the names of role and text.
    ``fields``: else, the role of each top-level field, in the order of the turns.
    """

    name: str
    examples: tuple[str, ...]
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


LAYOUTS = (
    Layout("messages", ('{"messages": [{"role": "", "content": ""}]}', '{"messages": []}'), ("$.messages", "role", "content")),
    Layout("from_value", ('{"conversations": [{"from": "", "value": ""}]}', '{"conversations": []}'), ("$.conversations", "from", "value"), roles={"human": "user", "gpt": "assistant"}),
    Layout("prompt_completion", ('{"prompt": "", "completion": ""}',), fields=(("prompt", "user"), ("completion", "assistant"))),
    Layout("system_prompt_response", ('{"system": "", "prompt": "", "response": ""}',), fields=(("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Layout("instruction_output", ('{"instruction": "", "output": ""}',), fields=(("instruction", "user"), ("output", "assistant"))),
)

START, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that chat templates read as control marks; plain text as users know them.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_MARK = "␛"


def escape(text: Column, also: tuple[str, ...] = ()) -> Column:
    """Break every control string by a mark after its first character; the mark itself is doubled up so that this can be undone."""
    out = F.replace(text, F.lit(_MARK), F.lit(f"{_MARK}0"))
    for x in CONTROLS:
        out = F.replace(out, F.lit(x), F.lit(f"{x[0]}{_MARK}1{x[1:]}"))
    for k, x in enumerate(also):
        out = F.replace(out, F.lit(x), F.lit(f"{_MARK}{k + 2}"))
    return out


def unescape(text: Column, also: tuple[str, ...] = ()) -> Column:
    out = F.replace(text, F.lit(f"{_MARK}1"), F.lit(""))
    for k, x in enumerate(also):
        out = F.replace(out, F.lit(f"{_MARK}{k + 2}"), F.lit(x))
    return F.replace(out, F.lit(f"{_MARK}0"), F.lit(_MARK))


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a parsed record: its schema with the scalar types left out."""
    scalar = r"(?<=: |ARRAY<)(?:STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\([^)]*\)|VARIANT|BINARY|DATE|TIMESTAMP(?:_NTZ)?|UUID)(?=[,>]|$)"
    return F.sha2(F.regexp_replace(F.schema_of_variant(record), scalar, "?"), 256)


def _listed(record: Column, layout: Layout, turn) -> Column:
    """Turns of a layout that lists them."""
    path, role, text = layout.turns

    def one(t: Column) -> Column:
        name = t[role]
        return turn(F.coalesce(*[F.when(name == a, F.lit(b)) for a, b in layout.roles.items()], name), t[text])

    return F.transform(F.variant_get(record, path, f"array<struct<`{role}`: string, `{text}`: string>>"), one)


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """Add fingerprint, layout and turns (role, text) to rows with a JSON text ``record``, or a struct of such a text, ``json``, and its ``texts``.

    With ``texts``, the texts in the JSON are places in that list, from 0, and the texts are of any length.
    Null texts and roles become empty.  A record that is null, no JSON or of no known layout has null layout and no turns; so has one with
    a string of over 20 million characters or of over 128 MiB in all, which the JSON reader refuses.  With ``texts`` these are errors: such records are made by
    a program and hold no text.
    """
    apart = isinstance(records.schema[record].dataType, T.StructType)
    json = F.col(f"{record}.json") if apart else F.col(record)
    df = records.withColumn("_v", F.try_parse_json(json)).withColumn("fingerprint", fingerprint(F.col("_v")))
    told = (lambda text: F.get(F.col(f"{record}.texts"), text.cast("int"))) if apart else (lambda text: text)
    turn = lambda role, text: F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(told(text), F.lit("")).alias("text"))
    name, turns = F.lit(None).cast("string"), F.array().cast("array<struct<role:string,text:string>>")
    for x in LAYOUTS:
        known = F.col("fingerprint").isin(*[fingerprint(F.parse_json(F.lit(e))) for e in x.examples])
        if x.turns:
            made = _listed(F.col("_v"), x, turn)
        else:
            made = F.array(*[turn(F.lit(role), F.variant_get(F.col("_v"), f"$.{f}", "string")) for f, role in x.fields])
        name, turns = F.when(known, F.lit(x.name)).otherwise(name), F.when(known, made).otherwise(turns)
    if apart:
        name = F.coalesce(name, F.raise_error(F.concat(F.lit("record of no known layout: "), F.left(F.coalesce(json, F.lit("null")), F.lit(200)))).cast("string"))
    return df.withColumns({"layout": name, "turns": turns}).drop("_v")


def formatted(df: DataFrame, trained: str = "assistant") -> DataFrame:
    """Add formatted (text) and loss (spans) to rows with turns.

    Each turn is ``<|im_start|>role``, a line feed, the escaped text and ``<|im_end|>`` with a line
    feed.  A span is (turn, turn_start, start, end) in code points, end exclusive, over the
    escaped text of a turn whose role is ``trained``.  A line feed in a role is escaped too.
    """
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), escape(t["role"], ("\n",)), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == trained).alias("loss")))
    df = df.withColumn("_p", pieces).withColumn("formatted", F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
    sizes = F.transform("_p", lambda p: F.struct(F.length(p["head"]).cast("long").alias("head"), F.length(p["body"]).cast("long").alias("body"), p["loss"].alias("loss")))
    none = F.array().cast("array<struct<turn:int,turn_start:bigint,start:bigint,end:bigint>>")
    zero = F.struct(F.lit(0).alias("turn"), F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + p["head"]
        end = start + p["body"]
        span = F.struct(s["turn"].alias("turn"), s["at"].alias("turn_start"), start.alias("start"), end.alias("end"))
        return F.struct((s["turn"] + 1).alias("turn"), (end + len(END)).alias("at"), F.when(p["loss"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    return df.withColumn("_n", sizes).withColumn("loss", F.aggregate("_n", zero, step, lambda s: s["spans"])).drop("_p", "_n")


def read_back(df: DataFrame) -> DataFrame:
    """Add turns_read (role, text) and loss_read (text), from formatted and loss alone."""
    df = df.withColumn("_t", F.filter(F.split("formatted", rf"\Q{END}\E", -1), lambda x: x != ""))
    role_end = lambda x: F.instr(x, "\n")
    turns = F.transform("_t", lambda x: F.struct(unescape(F.substr(x, F.lit(len(START) + 1), role_end(x) - len(START) - 1), ("\n",)).alias("role"), unescape(F.substr(x, role_end(x) + 1)).alias("text")))
    under = F.transform("loss", lambda s: unescape(F.substr(F.element_at("_t", s["turn"] + 1), (s["start"] - s["turn_start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return df.withColumns({"turns_read": turns, "loss_read": F.array_join(under, "")}).drop("_t")


def turn_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): one record for each conversation of rows conv_id, turn, role, text: its JSON, and its texts beside it.

    Its layout follows from its roles: prompt and completion, system, prompt and response, or
    messages; where a text would stand in the JSON is its place in the texts.  Rows stand by turn, null first, then role and text; null texts and roles are empty; rows with a null conv_id are one conversation.
    Texts may be of any length; a conversation is one row from here on, as its digest is.  Other columns take no part.
    """
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    df = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("m")).withColumn("_roles", F.col("m.role"))
    place = lambda k: F.lit(str(k))
    pair = F.to_json(F.struct(place(0).alias("prompt"), place(1).alias("completion")))
    three = F.to_json(F.struct(place(0).alias("system"), place(1).alias("prompt"), place(2).alias("response")))
    any_ = F.to_json(F.struct(F.transform("_roles", lambda r, k: F.struct(r.alias("role"), k.cast("string").alias("content"))).alias("messages")))
    roles = lambda *x: F.col("_roles") == F.array(*map(F.lit, x))
    record = F.when(roles("user", "assistant"), pair).when(roles("system", "user", "assistant"), three).otherwise(any_)
    return df.select("conv_id", F.struct(record.alias("json"), F.col("m.content").alias("texts")).alias("record"))


def digests(df: DataFrame) -> DataFrame:
    """Counts and digests of what was read back."""
    turns = F.array_join(F.transform("turns_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return df.select(
        "conv_id", "layout", F.size("turns_read").cast("long").alias("n_turns"), sha256_hex(turns).alias("turns_sha256"),
        F.length("loss_read").cast("long").alias("loss_chars"), sha256_hex(F.col("loss_read")).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escape_sql(x: str) -> str:
    out = f"replace({x}, '{_MARK}', '{_MARK}0')"
    for c in CONTROLS:
        out = f"replace({out}, '{c}', '{c[0]}{_MARK}1{c[1:]}')"
    return out


CHAT_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), g AS (
  SELECT conv_id, count(*) AS n_turns, list(role ORDER BY turn NULLS FIRST, role, text) AS roles,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum({len(START) + 1 + len(END)} + length({_escape_sql("role")}) + length(role) - length(replace(role, chr(10), '')) + length({_escape_sql("text")})) AS formatted
  FROM c GROUP BY conv_id
)
SELECT conv_id, CASE WHEN roles = ['user', 'assistant'] THEN 'prompt_completion' WHEN roles = ['system', 'user', 'assistant'] THEN 'system_prompt_response' ELSE 'messages' END AS layout,
  n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars
FROM g
"""
