"""Secret scan by one combined deterministic automaton (operator 6).

All rules' regexes are compiled, by subset construction and minimisation,
into one transition table that sees each byte of a text once.  Where a rule
accepts for long enough, that rule's own regex settles the spans in that text: leftmost
matches that do not overlap, longest first, without those whose secret is
too short.  A text where a rule never accepts so long has no match of it that counts.

Results: a null text has no spans; spans count code points, the end is
exclusive; equal spans of different kinds are all given, by start and then
kind in the rules' order; repeated rows and further columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimspark.llm.arrowtext import text_slices, utf8_bytes, with_columns
from claimspark.llm.automaton import Automaton, compiled, scan


@dataclass(frozen=True)
class Rule:
    """``lead`` + one or more of ``body`` + ``tail``; a match counts if lead and body, or with ``of_body`` its body, have
    ``least`` letters."""

    kind: str
    lead: str
    body: str
    least: int
    of_body: bool = False
    ignore_case: bool = False
    tail: str = ""

    @property
    def match(self) -> re.Pattern:
        flags = re.ASCII | (re.IGNORECASE if self.ignore_case else 0)
        return re.compile(f"({self.lead}({self.body}+)){self.tail}", flags)

    @property
    def least_body(self) -> int:
        """Body letters of the shortest match that counts."""
        return max(1, self.least - (0 if self.of_body else len(self.lead)))

    @property
    def automaton_regex(self) -> str:
        """The rule up to ``PROBE`` body letters, from where the automaton accepts at every letter of the body."""
        return f"{self.lead}{self.body}{{{min(PROBE, self.least_body)},}}".replace("(?:", "(")


#: Body letters that the automaton itself counts; the rest of a length shows in how long it keeps accepting.
PROBE = 6

#: A private key in PEM form: its header, lines of base64 and, where it is there, its end; line ends may be escaped.
_GAP = r"(?:[\x20\x09\x0D\x0A]|\\n)"
_BASE64 = "[A-Za-z0-9+/=]"
_KEY_HEAD = (rf"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----{_GAP}*"
             rf"(?:(?:Proc-Type|DEK-Info): [A-Za-z0-9,-]+{_GAP}+)*")
_KEY_REST = rf"(?:{_GAP}+{_BASE64}{{16,}})*(?:(?:{_GAP}+{_BASE64}+)?{_GAP}*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?"

#: The base rules, then the added ones (fixed patterns of well-known credentials).
RULES = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]", 6,
         of_body=True, ignore_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", 20),
    Rule("hex", "", "[0-9a-f]", 24),
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36, of_body=True),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10, of_body=True),
    Rule("private_key", _KEY_HEAD, _BASE64, 16, of_body=True, tail=_KEY_REST),
)
BASE_KINDS = ("assign", "access", "hex")


def combined(rules: Sequence[Rule] = RULES) -> Automaton:
    return compiled([(r.automaton_regex, r.ignore_case) for r in rules])


def spans_of(rule: Rule, text: str) -> Iterator[tuple[int, int]]:
    for m in rule.match.finditer(text):
        if len(m.group(2 if rule.of_body else 1)) >= rule.least:
            yield m.span()


def batch_spans(texts: pa.Array, automaton: Automaton, rules: Sequence[Rule]) -> list[list[tuple[str, int, int]]]:
    data, offsets = utf8_bytes(texts)
    row, end, bits = scan(automaton, data, offsets)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    for k, rule in enumerate(rules):
        of_rule = np.flatnonzero(bits >> k & 1)
        r, e = row[of_rule], end[of_rule]
        first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (e[1:] != e[:-1] + 1)))) if len(r) else r
        steps = np.diff(np.concatenate((first, [len(r)])))
        long = steps >= rule.least_body - min(PROBE, rule.least_body) + 1
        for i in np.unique(r[first[long]]).tolist():
            found[i] += [(start, k, stop) for start, stop in spans_of(rule, texts[i].as_py())]
    return [[(rules[k].kind, start, stop) for start, k, stop in sorted(x)] for x in found]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find(df: DataFrame, text_col: str = "text", spans_col: str = "spans", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``spans_col``: array of (kind, start, end) in every text."""
    automaton = combined(rules)
    fields = [f for f in df.schema.fields if f.name != spans_col]
    schema = T.StructType([*fields, T.StructField(spans_col, SPANS)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                spans = batch_spans(part.column(text_col), automaton, rules)
                made = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans],
                                arrow.field(spans_col).type)
                yield with_columns(part, arrow, **{spans_col: made})

    return df.mapInArrow(run, schema)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``.

    Spans are in order of their starts; a span that begins inside what is
    already covered only lengthens it.
    """
    begun = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda a, s: F.struct(
        F.when(s["start"] >= a["at"], F.concat(
            a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark)))
        .otherwise(a["out"]).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")))
    whole = F.transform(F.array(begun), lambda a: F.concat(
        a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))[0]
    return F.when(F.size(spans) > 0, whole).otherwise(text)
