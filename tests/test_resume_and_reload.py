"""Keys that survive reloads, and extractions that resume."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators import dims
from claimspark.operators.keymap import KeyMap
from claimspark.operators.keys import Asc
from claimspark.operators.notes import AnswerStore

NATURAL = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])


def load(spark, *keys):
    return spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(keys)], "a string, b int, x int")


def test_keys_stay_through_lost_and_new_rows(spark, tmp_path):
    keys = KeyMap(spark, str(tmp_path / "k"), NATURAL, "k")
    first = load(spark, ("b", 1), ("a", 2), (None, None), ("a", 2), ("c", None))
    one = {(r["a"], r["b"]): r["k"] for r in keys.attach(first).collect()}
    assert one == {(None, None): 1, ("a", 2): 2, ("b", 1): 3, ("c", None): 4}
    second = load(spark, ("0", 0), ("b", 1), ("d", 4))
    two = {(r["a"], r["b"]): r["k"] for r in keys.attach(second).collect()}
    assert two == {("0", 0): 5, ("b", 1): 3, ("d", 4): 6}
    # A load without new keys publishes nothing; lost keys come back with their numbers.
    at = keys.log.latest()["number"]
    assert keys.extend(first) == 0 and keys.log.latest()["number"] == at
    assert {(r["a"], r["b"]): r["k"] for r in keys.attach(first).collect()} == one
    assert keys.read().count() == 6 and keys.attach(first).count() == 5


def test_a_broken_load_numbers_the_same_keys_again(spark, tmp_path, monkeypatch):
    keys = KeyMap(spark, str(tmp_path / "k"), NATURAL, "k")
    keys.extend(load(spark, ("a", 1)))
    with monkeypatch.context() as m:
        m.setattr(keys.log, "publish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            keys.extend(load(spark, ("b", 1), ("c", 1)))
    assert keys.read().count() == 1
    assert keys.extend(load(spark, ("b", 1), ("c", 1))) == 2
    assert {r["a"]: r["k"] for r in keys.read().collect()} == {"a": 1, "b": 2, "c": 3}


def test_dimensions_keep_their_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "m", "x", 2000), (2, None, "x", 2001), (3, "z", "y", None)],
                               "claim_id long, auto_make string, auto_model string, auto_year int")
    keys = KeyMap(spark, str(tmp_path / "v"), df.drop("claim_id").schema, "vehicle_key")
    one = {tuple(r)[1:]: r[0] for r in dims.build_dim_vehicle(df.where("claim_id > 1"), keys).collect()}
    two = {tuple(r)[1:]: r[0] for r in dims.build_dim_vehicle(df, keys).collect()}
    assert len(two) == 3 and all(two[k] == v for k, v in one.items()) and two["m", "x", 2000] == 3
    assert Asc("x").name == "x"


def answers(fails=()):
    def call(prompts):
        out = []
        for p in prompts:
            note = p.partition("Note: ")[2][:-1]
            if note in fails:
                raise ValueError("no")
            out.append('{"incident_category": "theft", "at_fault_party": "unknown", "injury_mentioned": true, "severity_hint": "minor"}')
        return out
    return call


def test_a_rerun_asks_only_what_is_missing(spark, tmp_path):
    notes = spark.createDataFrame([(i, f"note {i % 5}" if i else None) for i in range(40)], "claim_id long, note_text string")
    store = AnswerStore(spark, str(tmp_path / "s"))
    assert store.ask(notes.where("claim_id < 3"), answers()) == 3
    assert store.ask(notes, answers()) == 3  # of the six distinct prompts three are new
    at = store.log.latest()["number"]
    done = store.process(notes, answers(fails={f"note {i}" for i in range(5)}))
    assert done.count() == 40 and {r["status"] for r in done.collect()} == {"ok"}
    assert store.log.latest()["number"] == at  # no call was made


def test_failing_prompts_are_asked_a_bounded_number_of_times(spark, tmp_path):
    notes = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "bad"), (4, "worse")], "claim_id long, note_text string")
    store = AnswerStore(spark, str(tmp_path / "s"))
    assert store.ask(notes, answers(fails={"bad", "worse"}), attempts=2) == 5
    assert store.ask(notes, answers(), attempts=2) == 0
    # A higher bound gives the failing ones another try.
    found = {r["claim_id"]: (r["status"], r["attempt"]) for r in store.process(notes, answers(fails={"worse"}), attempts=3).collect()}
    assert found == {1: ("ok", 1), 2: ("ok", 3), 3: ("ok", 3), 4: ("call_failed", 3)}


def test_a_run_that_breaks_keeps_earlier_attempts(spark, tmp_path, monkeypatch):
    notes = spark.createDataFrame([(1, "a"), (2, "b")], "claim_id long, note_text string")
    store = AnswerStore(spark, str(tmp_path / "s"))
    store.ask(notes.where(F.col("claim_id") == 1), answers())
    with monkeypatch.context() as m:
        m.setattr(store.log, "publish", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.ask(notes, answers())
    assert [r["attempt"] for r in store.read().collect()] == [1]
    assert store.ask(notes, answers()) == 1
