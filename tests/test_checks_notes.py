import json

import pytest

from claimspark.operators import checks as V
from claimspark.operators import notes as N


def test_unique_and_not_null_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None), (2, 3)], "k int, v int")
    u = V.unique(df, ["k"], "t").first()
    assert (u.failures, u.passed) == (0, True)        # repeated NULL keys are no uniqueness failure
    nn = {r.target: r.failures for r in V.not_null(df, ["k", "v"], "t").collect()}
    assert nn == {"t.k": 2, "t.v": 1}
    dup = V.unique(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).first()
    assert dup.failures == 2 and not dup.passed


def test_relationships_and_run_checks(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,)], "pk int")
    orphans = V.relationships(fact, "fk", dim, "pk", "f").first()
    assert orphans.failures == 1
    ok = V.run_checks([V.relationships(fact.where("fk = 1"), "fk", dim, "pk")])
    assert ok.first().passed
    with pytest.raises(V.CheckFailed, match="relationships"):
        V.run_checks([orphans and V.relationships(fact, "fk", dim, "pk")])


EDGE_ANSWERS = {
    1: ('{"incident_category": "theft", "at_fault_party": "insured", "injury_mentioned": true, '
        '"severity_hint": "minor"}', "ok"),
    2: ("not json", "parse_failed"),
    3: ("[1, 2]", "parse_failed"),
    4: ('{"incident_category": "theft", "at_fault_party": "insured", "injury_mentioned": "yes", '
        '"severity_hint": "minor"}', "invalid_value"),
    5: ('{"incident_category": "meteor", "at_fault_party": "insured", "injury_mentioned": false, '
        '"severity_hint": "minor"}', "invalid_value"),
    6: ('{"incident_category": "fire", "injury_mentioned": false}', "incomplete"),
    7: ('  {"incident_category": "fire", "at_fault_party": "unknown", "injury_mentioned": false, '
        '"severity_hint": "severe"}\n', "ok"),
    8: (None, "parse_failed"),
    9: ('{"incident_category": "fire", "at_fault_party": "unknown", "injury_mentioned": false, '
        '"severity_hint": "severe"} trailing', "parse_failed"),
    10: ('{"incident_category": "fire"} {"severity_hint": "minor"}', "parse_failed"),
    11: ("42", "parse_failed"),
}


def test_parse_response_edges(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in EDGE_ANSWERS.items()], "id int, raw_response string")
    got = {r.id: r for r in N.parse_responses(df, keep=("id",)).collect()}
    for k, (_, status) in EDGE_ANSWERS.items():
        assert got[k].status == status, k
    assert got[1].injury_mentioned is True and got[1].raw_response is None
    assert got[5].incident_category == "meteor"           # returned as given, flagged invalid
    assert got[2].raw_response == "not json" and got[2].incident_category is None
    assert got[7].severity_hint == "severe"


def test_prompt_keeps_whole_note(spark):
    text = "x" * 50_000
    df = spark.createDataFrame([(1, text), (2, None)], "claim_id int, note_text string")
    out = {r.claim_id: r.p for r in df.select("claim_id", N.render_prompt(df.note_text).alias("p")).collect()}
    assert out[1] == N.PROMPT_HEAD + text + N.PROMPT_TAIL
    assert out[2].endswith("Note: nan\n")


def stub_model(prompts):
    out = []
    for p in prompts:
        note = p[len(N.PROMPT_HEAD):-len(N.PROMPT_TAIL)]
        if "boom" in note:
            raise RuntimeError("model unavailable")
        out.append(json.dumps({"incident_category": "collision" if "car" in note else "weather",
                               "at_fault_party": "unknown", "injury_mentioned": "hurt" in note,
                               "severity_hint": "minor"}))
    return out


def test_process_notes_isolates_failures(spark):
    notes = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["car hit pole", "hail storm", "boom", "car and hurt driver", "rain"])], "claim_id int, note_text string")
    got = {r.claim_id: r for r in N.process_notes(notes, stub_model, batch_size=2, partitions=2).collect()}
    assert len(got) == 5
    assert got[0].incident_category == "collision" and got[0].status == "ok"
    assert got[3].injury_mentioned is True
    assert got[2].status == "call_failed" and "unavailable" in got[2].error
    assert got[1].status == "ok" and got[1].error is None   # same batch as nothing failing


def test_audit_counts_nulls_without_the_values(spark):
    df = spark.createDataFrame([(1, 10, None), (1, 11, "a"), (None, 12, "b"), (2, None, "c")], "k int, v int, w string")
    out = V.audit(df, "t", unique=[["k"]], not_null=["k", "v", "w"])
    assert {(r.check, r.target): r.failures for r in out.collect()} == {
        ("unique", "t.k"): 2, ("not_null", "t.k"): 1, ("not_null", "t.v"): 1, ("not_null", "t.w"): 1}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(v" not in plan and "isnotnull(v" in plan
    assert V.audit(df.limit(0), "t", not_null=["v"]).first().failures == 0


def test_flat_mart_of_the_star_is_not_copied_before_numbering(spark, monkeypatch):
    from claimspark.operators import facts, keys
    from claimspark.plans import catalog
    from tests.conftest import SF_SMALL

    names, given = [], []
    real_written, real_key = keys._written, facts.dense_key
    monkeypatch.setattr(keys, "_written", lambda df, name: (names.append(name), real_written(df, name))[1])
    monkeypatch.setattr(facts, "dense_key", lambda df, *a, **k: (given.append(df.columns), real_key(df, *a, **k))[1])
    catalog.star_for(spark, SF_SMALL).claims
    flat = catalog.q_flat(spark, SF_SMALL)
    assert names == ["ranges"] and "collision_type" not in given[0]
    assert flat.columns == list(facts.FLAT_COLUMNS)
