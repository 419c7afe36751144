"""Process lists kept as text: from Python-style text to arrays of structs and back.

Reading is a few regexp passes at most per list, then one ``from_json``. The quote-aware patterns use possessive
quantifiers only, so their cost is linear in the text and they do not recurse on long lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hostvane import schemas
from hostvane.functions import scalars

_QUOTED = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+\""""
_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}

# The attribute types that agents write as named tuples, and Python's words for JSON's.
NAMED_TUPLES = ("pmem", "pcputimes")
_WORDS = {"None": "null", "True": "true", "False": "false"}


def _bare_word(text: Column, word: str, replacement: str) -> Column:
    """Replace a word outside quoted strings. The pass runs only on texts that hold the word at all."""
    first = word[0]
    skip = rf"(?:[^'\"{first}]++|{_QUOTED}|{first}(?!{word[1:]}\b))*+"
    return scalars.bind(
        text,
        lambda t: F.when(
            t.contains(word), F.regexp_replace(t, rf"\G({skip}){word}\b", f"$1{replacement}")
        ).otherwise(t),
    )


def _hex_escapes(text: Column) -> Column:
    r"""``\xNN`` exists in Python text but not in JSON; an escaped backslash before an x is left alone."""
    return scalars.bind(
        text,
        lambda t: F.when(
            t.contains("\\x"), F.regexp_replace(t, r"(?<!\\)((?:\\\\)*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
        ).otherwise(t),
    )


def literal_to_json(text: Column, safe: bool = True) -> Column:
    """Python literals to JSON words.

    ``safe`` changes only bare words; quotes stay, the parser accepts both kinds. Otherwise every occurrence is
    replaced, quotes first, also inside values (kept for results that must equal the older rule).
    """
    if safe:
        for word, replacement in _WORDS.items():
            text = _bare_word(text, word, replacement)
        return _hex_escapes(text)
    text = F.replace(text, F.lit("'"), F.lit('"'))
    for word, replacement in _WORDS.items():
        text = F.replace(text, F.lit(word), F.lit(replacement))
    return text


def quote_named_tuples(text: Column, names: Sequence[str] = NAMED_TUPLES) -> Column:
    """``name(a=1, b=2)`` outside quotes becomes a quoted string, so the list parses as JSON.

    Looking for the given names only lets the pattern skip plain text by single characters, four times as fast as
    testing every word.
    """
    firsts, either = "".join(sorted({name[0] for name in names})), "|".join(names)
    skip = rf"(?:[^'\"{firsts}]++|{_QUOTED}|(?!(?:{either})\()[{firsts}])*+"
    return F.regexp_replace(text, rf"\G({skip})((?:{either})\([^()]*+\))", "$1'$2'")


def parse_list(text: Column, schema: str = schemas.SIMULATED_PROCESS, safe: bool = True) -> Column:
    """Text to an array of structs; malformed text is NULL. Pass a smaller schema to read fewer fields."""
    return F.from_json(literal_to_json(text, safe), schema, _JSON_OPTIONS)


def parse_open_list(text: Column) -> Column:
    """Text of either encoding to an array of VARIANT, one per process, which keeps fields that no schema names.

    Named tuples stay texts. Malformed text is NULL. ``processes.open_rows`` types the fields that are known.
    """
    return F.from_json(literal_to_json(quote_named_tuples(text)), "array<variant>", _JSON_OPTIONS)


def _tuple_field(text: Column, field: str, dtype: str) -> Column:
    return F.regexp_extract(text, rf"\b{field}=([0-9.eE+-]+)", 1).try_cast(dtype)


def parse_agent_list(text: Column) -> Column:
    """Agent text, whose memory_info and cpu_times are named tuples, to the full process record."""
    raw = F.from_json(
        literal_to_json(quote_named_tuples(text)), schemas.AGENT_PROCESS_RAW, _JSON_OPTIONS
    )
    plain = ["pid", "name", "username", "status", "create_time", "cpu_percent"]

    def record(p: Column) -> Column:
        memory = F.struct(
            _tuple_field(p["memory_info"], "rss", "bigint").alias("rss"),
            _tuple_field(p["memory_info"], "vms", "bigint").alias("vms"),
        )
        times = F.struct(
            _tuple_field(p["cpu_times"], "user", "double").alias("user"),
            _tuple_field(p["cpu_times"], "system", "double").alias("system"),
        )
        return F.struct(
            *[p[c].alias(c) for c in plain],
            memory.alias("memory_info"),
            *[p[c].alias(c) for c in ["num_threads", "exe", "cmdline"]],
            times.alias("cpu_times"),
            p["memory_percent"].alias("memory_percent"),
        )

    return F.transform(raw, record)


def list_to_text(processes: Column) -> Column:
    """Array of structs to JSON text, which ``parse_list`` reads back."""
    return F.to_json(processes)


def list_size(processes: Column) -> Column:
    """Number of processes; NULL for a list that could not be read."""
    return F.when(processes.isNotNull(), F.size(processes))
