"""Adjuster-note extraction: prompt, batched calls, response parsing.

Prompt rendering and parsing are built-in expressions.  The model call is
the one place with Python on rows: ``extract_responses`` runs an injected
callable over Arrow batches with ``mapInPandas``; no client or network
access is bundled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimspark.functions.expressions import strip
from claimspark.sources.commits import CommitLog

# ---------------------------------------------------------------------------
# The extraction prompt around the note text, and the allowed
# value of each field of the model's JSON answer.
# ---------------------------------------------------------------------------
PROMPT_HEAD = """
Extract structured fields from this insurance
adjuster note. Return ONLY valid JSON, no
other text, in this exact shape:

{
  "incident_category": one of ["collision",
      "weather", "theft", "vandalism",
      "fire", "animal_strike", "road_hazard"],
  "at_fault_party": one of ["insured",
      "other_party", "unknown", "not_applicable"],
  "injury_mentioned": true or false,
  "severity_hint": one of ["minor", "moderate",
      "severe", "total_loss"]
}

Note: """
PROMPT_TAIL = "\n"
INCIDENT_CATEGORIES = ("collision", "weather", "theft", "vandalism", "fire", "animal_strike", "road_hazard")
AT_FAULT_PARTIES = ("insured", "other_party", "unknown", "not_applicable")
SEVERITY_HINTS = ("minor", "moderate", "severe", "total_loss")

ENUM_FIELDS = {
    "incident_category": INCIDENT_CATEGORIES,
    "at_fault_party": AT_FAULT_PARTIES,
    "severity_hint": SEVERITY_HINTS,
}
STATUSES = ("ok", "incomplete", "invalid_value", "parse_failed", "call_failed")


def render_prompt(note_text: Column) -> Column:
    """The prompt for one note (N1): fixed head, the whole note, fixed tail.

    A NULL note renders as the text 'nan', as string formatting of a
    missing pandas value does.
    """
    return F.concat(F.lit(PROMPT_HEAD), F.coalesce(note_text.cast("string"), F.lit("nan")), F.lit(PROMPT_TAIL))


def parse_response(raw: Column) -> Column:
    """Parse one model answer into a struct.

    Fields: the three enum texts, ``injury_mentioned`` (a JSON boolean
    only), ``status`` and ``raw_response`` (kept unless ``ok``).  Status:
    ``parse_failed`` when the stripped text is not exactly one JSON object
    (a list, NULL, or an object followed by more text too); ``invalid_value`` when a present field has a value outside its
    set or a non-boolean injury flag; ``incomplete`` when a field is
    missing; else ``ok``.  Enum values are returned as given either way.
    """
    r = strip(raw)
    # One JSON object and nothing after it: Spark's JSON functions read the
    # first value and ignore trailing text, so the text is also required to
    # be exactly one element when wrapped in brackets.  A single valid value
    # whose text starts with '{' is an object, so no second parse is needed.
    single_value = F.json_array_length(F.concat(F.lit("["), r, F.lit("]"))) == 1
    is_object = F.coalesce(single_value, F.lit(False)) & r.startswith("{")
    text = F.from_json(r, "incident_category STRING, at_fault_party STRING, injury_mentioned STRING, "
                          "severity_hint STRING")
    injury = F.from_json(r, "injury_mentioned BOOLEAN")["injury_mentioned"]
    bad = [text[f].isNotNull() & ~text[f].isin(*allowed) for f, allowed in ENUM_FIELDS.items()]
    bad.append(text["injury_mentioned"].isNotNull() & injury.isNull())
    missing = [text[f].isNull() for f in (*ENUM_FIELDS, "injury_mentioned")]
    status = (
        F.when(~is_object | raw.isNull(), "parse_failed")
        .when(_any(bad), "invalid_value")
        .when(_any(missing), "incomplete")
        .otherwise("ok")
    )
    ok = is_object & raw.isNotNull()
    return F.struct(
        *[F.when(ok, text[f]).alias(f) for f in ENUM_FIELDS],
        F.when(ok, injury).alias("injury_mentioned"),
        status.alias("status"),
        F.when(status != "ok", raw).alias("raw_response"),
    )


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def parse_responses(df: DataFrame, raw_col: str = "raw_response", keep: tuple[str, ...] = ()) -> DataFrame:
    """``parse_response`` over a column, flattened next to ``keep`` columns."""
    return df.select(*keep, parse_response(F.col(raw_col)).alias("_p")).select(*keep, "_p.*")


ModelCall = Callable[[list[str]], list[str]]


def _batch_caller(call: ModelCall, id_col: str, batch_size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), batch_size):
                part = pdf.iloc[lo:lo + batch_size]
                prompts = part["prompt"].tolist()
                answers, errors = [None] * len(prompts), [None] * len(prompts)
                try:
                    got = list(call(prompts))
                    if len(got) != len(prompts):
                        raise ValueError(f"call returned {len(got)} answers for {len(prompts)} prompts")
                    answers = got
                except Exception:  # noqa: BLE001 - isolate the failing rows (N3)
                    for i, p in enumerate(prompts):
                        try:
                            answers[i] = call([p])[0]
                        except Exception as e:  # noqa: BLE001
                            errors[i] = str(e)
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "raw_response": answers, "error": errors})
    return run


def extract_responses(
    notes: DataFrame,
    call: ModelCall,
    id_col: str = "claim_id",
    text_col: str = "note_text",
    batch_size: int = 32,
    partitions: int | None = None,
) -> DataFrame:
    """Call the model for every note in Arrow batches.

    ``call`` maps a list of prompts to a list of answers and must be
    picklable; it runs on executors.  ``partitions`` bounds the number of
    concurrent callers (a shuffle to that many tasks).  A failing batch is
    retried row by row so one bad note only marks its own row: ``error``
    holds the message and ``raw_response`` is NULL.
    """
    prompts = notes.select(F.col(id_col), render_prompt(F.col(text_col)).alias("prompt"))
    if partitions:
        prompts = prompts.repartition(partitions)
    id_type = notes.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {id_type}, raw_response string, error string"
    return prompts.mapInPandas(_batch_caller(call, id_col, batch_size), schema)


def process_notes(notes: DataFrame, call: ModelCall, id_col: str = "claim_id", text_col: str = "note_text",
                  **kw) -> DataFrame:
    """N4 end to end: one row per note with parsed fields, status and error."""
    answers = extract_responses(notes, call, id_col, text_col, **kw)
    parsed = parse_responses(answers, keep=(id_col, "error"))
    return parsed.withColumn("status", F.when(F.col("error").isNotNull(), "call_failed").otherwise(F.col("status")))


class AnswerStore:
    """Answers kept by the hash of their prompt, so an extraction can be broken off and resumed.

    Each distinct prompt is asked once, however many notes share it.  A run
    asks only prompts without an answer (an anti-join with the store), and a
    prompt that fails is asked ``attempts`` times in all, over all runs.
    Every attempt is a part of its own, published by a commit record when it
    is complete: a run that breaks loses at most the attempt it was in.
    """

    SCHEMA = "prompt_hash string, raw_response string, error string, attempt int"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, CommitLog(spark, root)

    def _parts(self) -> list[str]:
        record = self.log.latest()
        return record["parts"] if record else []

    def read(self) -> DataFrame:
        """The last attempt at every prompt: prompt_hash, raw_response, error, attempt."""
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).parquet(*[self.log.part_path(p) for p in parts])
        return rows.groupBy("prompt_hash").agg(F.max(F.struct("attempt", "raw_response", "error")).alias("last")).select(
            "prompt_hash", "last.raw_response", "last.error", "last.attempt")

    def ask(self, notes: DataFrame, call: ModelCall, text_col: str = "note_text", *, attempts: int = 2, batch_size: int = 32,
            partitions: int | None = None) -> int:
        """Ask what is missing for these notes; returns the number of prompts asked, counting each attempt."""
        prompts = notes.select(render_prompt(F.col(text_col)).alias("prompt")) \
            .groupBy(F.sha2("prompt", 256).alias("prompt_hash")).agg(F.first("prompt").alias("prompt"))
        asked = 0
        for _ in range(attempts):
            tried = self.read()
            done = tried.where(F.col("error").isNull() | (F.col("attempt") >= attempts)).select("prompt_hash")
            due = prompts.join(done, "prompt_hash", "left_anti")
            if partitions:
                due = due.repartition(partitions)
            answers = due.mapInPandas(_batch_caller(call, "prompt_hash", batch_size), "prompt_hash string, raw_response string, error string")
            before = tried.select("prompt_hash", "attempt")
            answers = answers.join(before, "prompt_hash", "left").select(
                "prompt_hash", "raw_response", "error", (F.coalesce("attempt", F.lit(0)) + 1).cast("int").alias("attempt"))
            part, obs = self.log.new_part(), Observation()
            answers.observe(obs, F.count(F.lit(1)).alias("n"), F.count("error").alias("failed")).write.parquet(self.log.part_path(part))
            if not obs.get["n"]:
                break
            asked += obs.get["n"]
            self.log.publish({"parts": [*self._parts(), part]})
            if not obs.get["failed"]:
                break
        return asked

    def process(self, notes: DataFrame, call: ModelCall, id_col: str = "claim_id", text_col: str = "note_text", **kw) -> DataFrame:
        """``process_notes`` by way of the store: one row per note, with the number of attempts its prompt took."""
        self.ask(notes, call, text_col, **kw)
        hashed = notes.select(id_col, F.sha2(render_prompt(F.col(text_col)), 256).alias("prompt_hash"))
        parsed = parse_responses(hashed.join(self.read(), "prompt_hash", "left"), keep=(id_col, "error", "attempt"))
        return parsed.withColumn("status", F.when(F.col("error").isNotNull(), "call_failed").otherwise(F.col("status")))
