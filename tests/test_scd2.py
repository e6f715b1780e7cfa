import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimspark.operators import scd2 as H

TRACKED = ("zip_code", "relationship", "occupation")
SCHEMA = ("policyholder_id string, seq int, age int, sex string, education_level string, occupation string, "
          "hobbies string, relationship string, zip_code string, snapshot_date date")


def loop_model(rows, mode):
    """Plain loop over snapshots in arrival order: the semantics to match."""
    def norm(v):
        if mode == "strict":
            return None if v is None else str(v).strip()
        return "" if v is None else str(v)
    current, history = {}, []
    for r in sorted(rows, key=lambda r: (r["snapshot_date"], r["seq"])):
        vals = tuple(norm(r[t]) for t in TRACKED)
        k = r["policyholder_id"]
        if k in current and current[k][1] == vals:
            continue
        if k in current:
            history[current[k][0]]["valid_to"] = r["snapshot_date"]
        history.append(dict(r, valid_from=r["snapshot_date"], valid_to=None))
        current[k] = (len(history) - 1, vals)
    return sorted(((h["policyholder_id"], h["valid_from"], h["valid_to"], h["occupation"], h["age"]) for h in history),
                  key=repr)


def random_rows(rng, n_keys=6, n_dates=5):
    values = [None, "", "a", " a", "b", "a\t"]
    rows, seq = [], 0
    for d in range(n_dates):
        date = dt.date(2024, 1, 1) + dt.timedelta(days=30 * d)
        for k in range(n_keys):
            if rng.random() < 0.25:
                continue                       # key vanishes from this snapshot
            for _ in range(2 if rng.random() < 0.1 else 1):   # sometimes twice on one date
                seq += 1
                rows.append(dict(policyholder_id=str(k), seq=seq, age=rng.randint(20, 60), sex=None,
                                 education_level=None, occupation=rng.choice(values), hobbies=None,
                                 relationship=rng.choice(values[:3]), zip_code=rng.choice(["1", "1", "2"]),
                                 snapshot_date=date))
    return rows


def to_df(spark, rows):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SCHEMA)


@pytest.mark.parametrize("mode", ["strict", "null_as_empty"])
def test_history_matches_loop_model(spark, mode):
    rng = random.Random(7 if mode == "strict" else 11)
    for _ in range(6):
        rows = random_rows(rng)
        hist = H.build_history(to_df(spark, rows), mode=mode, seq_col="seq")
        got = sorted(((r.policyholder_id, r.valid_from, r.valid_to, r.occupation, r.age) for r in hist.collect()),
                     key=repr)
        assert got == loop_model(rows, mode)


def test_history_invariants(spark):
    rows = random_rows(random.Random(3), n_keys=10, n_dates=6)
    hist = H.build_history(to_df(spark, rows), seq_col="seq")
    assert H.multiple_current(hist).count() == 0
    keys = [r.policyholder_key for r in hist.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    by_key = {}
    for r in hist.collect():
        by_key.setdefault(r.policyholder_id, []).append((r.valid_from, r.valid_to))
    for spans in by_key.values():
        spans.sort(key=lambda s: (s[0], s[1] is None, s[1] or s[0]))
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 == f2                    # no gap, no overlap
        assert spans[-1][1] is None


def test_modes_differ_on_null_and_space(spark):
    rows = [dict(policyholder_id="1", seq=1, age=1, sex=None, education_level=None, occupation=None, hobbies=None,
                 relationship="x", zip_code="1", snapshot_date=dt.date(2024, 1, 1)),
            dict(policyholder_id="1", seq=2, age=1, sex=None, education_level=None, occupation="", hobbies=None,
                 relationship="x ", zip_code="1", snapshot_date=dt.date(2024, 2, 1))]
    assert H.build_history(to_df(spark, rows), mode="strict").count() == 2          # NULL != ''
    assert H.build_history(to_df(spark, rows), mode="null_as_empty").count() == 2   # 'x' != 'x '
    rows[1]["relationship"] = "x"
    assert H.build_history(to_df(spark, rows), mode="null_as_empty").count() == 1


def test_untracked_frozen_and_a_b_a(spark):
    base = dict(seq=0, sex=None, education_level=None, hobbies=None, relationship="r", zip_code="z",
                policyholder_id="9")
    rows = [dict(base, seq=i, age=30 + i, occupation=o, snapshot_date=dt.date(2024, i, 1))
            for i, o in enumerate(["A", "A", "B", "A"], 1)]
    hist = H.build_history(to_df(spark, rows)).orderBy("valid_from").collect()
    assert [(r.occupation, r.age, r.valid_to) for r in hist] == [
        ("A", 31, dt.date(2024, 3, 1)), ("B", 33, dt.date(2024, 4, 1)), ("A", 34, None)]


@pytest.mark.parametrize("mode", ["strict", "null_as_empty"])
def test_incremental_fold_equals_batch(spark, mode):
    rows = [r for r in random_rows(random.Random(5), n_keys=8, n_dates=5)]
    seen, unique_rows = set(), []
    for r in rows:                                 # one row per key and date
        if (r["policyholder_id"], r["snapshot_date"]) not in seen:
            seen.add((r["policyholder_id"], r["snapshot_date"]))
            unique_rows.append(r)
    df = to_df(spark, unique_rows).drop("seq")
    dates = sorted({r["snapshot_date"] for r in unique_rows})
    first = H.build_history(df.where(F.col("snapshot_date") == dates[0]), mode=mode)
    folded = first
    for d in dates[1:]:
        folded = H.apply_snapshot(folded, df.where(F.col("snapshot_date") == F.lit(d)), mode=mode)
    batch = H.build_history(df, mode=mode)
    assert sorted((tuple(r) for r in folded.collect()), key=repr) == sorted((tuple(r) for r in batch.collect()), key=repr)


def test_apply_rejects_duplicate_keys_and_reopens_closed(spark):
    day = lambda m: dt.date(2024, m, 1)
    r0 = dict(policyholder_id="1", seq=1, age=1, sex=None, education_level=None, occupation="a", hobbies=None,
              relationship="r", zip_code="z", snapshot_date=day(1))
    dim = H.build_history(to_df(spark, [r0]))
    dup = to_df(spark, [dict(r0, snapshot_date=day(2)), dict(r0, snapshot_date=day(2), seq=2)]).drop("seq")
    with pytest.raises(ValueError, match="repeats natural key"):
        H.apply_snapshot(dim, dup)
    # A key whose only version is closed gets a new open version.
    closed = dim.withColumn("valid_to", F.lit(day(2))).withColumn("is_current", F.lit(False))
    out = H.apply_snapshot(closed, to_df(spark, [dict(r0, snapshot_date=day(3))]).drop("seq")).collect()
    assert sorted((r.policyholder_key, r.valid_from, r.is_current) for r in out) == [(1, day(1), False), (2, day(3), True)]


def test_version_reports(spark):
    rows = [dict(policyholder_id=k, seq=i, age=1, sex=None, education_level=None, occupation=o, hobbies=None,
                 relationship="r", zip_code="z", snapshot_date=dt.date(2024, i, 1))
            for i, (k, o) in enumerate([("1", "a"), ("1", "b"), ("2", "a"), ("1", "c")], 1)]
    hist = H.build_history(to_df(spark, rows))
    assert {tuple(r) for r in H.version_counts(hist).collect()} == {("1", 3), ("2", 1)}
    assert {tuple(r) for r in H.version_distribution(hist).collect()} == {(3, 1), (1, 1)}
    broken = hist.withColumn("is_current", F.lit(True))
    assert [tuple(r) for r in H.multiple_current(broken).collect()] == [("1", 3)]


def test_history_store_appends_closed_rows_and_matches_batch(spark, tmp_path):
    rows = []
    for r in random_rows(random.Random(9), n_keys=8, n_dates=5):
        if all((r["policyholder_id"], r["snapshot_date"]) != (x["policyholder_id"], x["snapshot_date"]) for x in rows):
            rows.append(r)
    df = to_df(spark, rows).drop("seq")
    dates = sorted({r["snapshot_date"] for r in rows})
    store = H.HistoryStore(spark, str(tmp_path / "hist"))
    v = store.create(H.build_history(df.where(F.col("snapshot_date") == dates[0]), mode="null_as_empty"))
    v1 = store.apply(v, df.where(F.col("snapshot_date") == dates[1]))
    closed_v1 = sorted(tuple(r) for r in store.read(v1).where(~F.col("is_current")).collect())
    v = store.apply_all(v1, df.where(F.col("snapshot_date") > dates[1]))
    batch = H.build_history(df, mode="null_as_empty")
    assert sorted((tuple(r) for r in store.read(v).collect()), key=repr) == \
        sorted((tuple(r) for r in batch.collect()), key=repr)
    # closed rows of an older version are never rewritten and stay readable
    assert sorted(tuple(r) for r in store.read(v1).where(~F.col("is_current")).collect()) == closed_v1
    # re-running an apply overwrites its own version only
    assert store.apply(v1, df.where(F.col("snapshot_date") == dates[2])) == v1 + 1
    assert store.read(v1).count() == H.build_history(df.where(F.col("snapshot_date") <= dates[1]),
                                                     mode="null_as_empty").count()
    plan = store.current(v)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "is_current" in plan


def pending_history(spark, seed, n_dates=6):
    rows = []
    for r in random_rows(random.Random(seed), n_keys=8, n_dates=n_dates):
        if all((r["policyholder_id"], r["snapshot_date"]) != (x["policyholder_id"], x["snapshot_date"]) for x in rows):
            rows.append(r)
    df = to_df(spark, rows).drop("seq")
    return df, sorted({r["snapshot_date"] for r in rows})


@pytest.mark.parametrize("mode", ["strict", "null_as_empty"])
def test_one_pass_equals_the_fold(spark, mode):
    df, dates = pending_history(spark, 21)
    dim = H.build_history(df.where(F.col("snapshot_date") == dates[0]), mode=mode).checkpoint()
    later = df.where(F.col("snapshot_date") > dates[0])
    folded = dim
    for d in dates[1:]:
        folded = H.apply_snapshot(folded, later.where(F.col("snapshot_date") == d), mode=mode).checkpoint()
    one = H.apply_snapshots(dim.where("is_current"), later, mode=mode)
    expected = sorted(map(tuple, folded.collect()), key=repr)
    assert len(dates) > 3 and sorted(map(tuple, one.collect()), key=repr) == expected
    assert expected == sorted(map(tuple, H.build_history(df, mode=mode).collect()), key=repr)


def test_jobs_do_not_grow_with_the_dates(spark, tmp_path):
    def jobs(n_dates, group):
        df, dates = pending_history(spark, 4, n_dates)
        store = H.HistoryStore(spark, str(tmp_path / group))
        store.create(H.build_history(df.where(F.col("snapshot_date") == dates[0]), mode="null_as_empty"))
        spark.sparkContext.setJobGroup(group, group)
        try:
            store.apply(None, df.where(F.col("snapshot_date") > dates[0]))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(3, "few") == jobs(9, "many")


def test_a_key_twice_on_one_date_publishes_nothing(spark, tmp_path):
    df, dates = pending_history(spark, 5)
    store = H.HistoryStore(spark, str(tmp_path / "h"))
    store.create(H.build_history(df.where(F.col("snapshot_date") == dates[0]), mode="null_as_empty"))
    later = df.where(F.col("snapshot_date") > dates[0])
    with pytest.raises(ValueError, match="repeats natural key"):
        store.apply(None, later.unionByName(later.limit(1)))
    assert store.latest() == 0


def test_a_run_broken_before_publishing_leaves_readers_on_the_old_version(spark, tmp_path, monkeypatch):
    df, dates = pending_history(spark, 6)
    store = H.HistoryStore(spark, str(tmp_path / "h"))
    store.create(H.build_history(df.where(F.col("snapshot_date") == dates[0]), mode="null_as_empty"))
    before = sorted(map(tuple, store.read().collect()), key=repr)
    later = df.where(F.col("snapshot_date") > dates[0])

    def broken(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store.log, "publish", broken)
        with pytest.raises(OSError):
            store.apply(None, later)
    parts = [p.name for p in (tmp_path / "h" / "data").iterdir()]
    assert len(parts) == 2 and store.latest() == 0
    reader = H.HistoryStore(spark, str(tmp_path / "h"))
    assert sorted(map(tuple, reader.read().collect()), key=repr) == before
    assert store.apply(None, later) == 1
    assert sorted(map(tuple, reader.read().collect()), key=repr) == \
        sorted(map(tuple, H.build_history(df, mode="null_as_empty").collect()), key=repr)
    # The broken run's part goes when it is old enough, the superseded current slice with its version.
    assert reader.expire(keep=5) == []
    gone = reader.expire(keep=1, orphan_age=0)
    assert len(gone) == 2 and sum(g.endswith("is_current=true") for g in gone) == 1
    assert sorted(map(tuple, reader.read().collect()), key=repr) == \
        sorted(map(tuple, H.build_history(df, mode="null_as_empty").collect()), key=repr)
    with pytest.raises(ValueError, match="no version"):
        reader.read(0)


def test_two_writers_cannot_publish_on_the_same_record(spark, tmp_path):
    from claimspark.sources.commits import CommitConflict, CommitLog

    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.latest() is None
    assert log.publish({"x": 1}) == 0
    assert log.publish({"x": 2}, after=0) == 1
    with pytest.raises(CommitConflict):
        log.publish({"x": 3}, after=0)
    assert [r["x"] for r in log.records()] == [1, 2]


def test_a_hot_key_and_keys_of_every_kind_in_one_pass(spark, tmp_path):
    day = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    rows = [dict(policyholder_id="hot", seq=1, age=1, sex=None, education_level=None, occupation="ab"[i // 3 % 2], hobbies=None,
                 relationship="r", zip_code=None if i % 2 else "", snapshot_date=d) for i, d in enumerate(day)]
    rows += [dict(rows[0], policyholder_id=str(i), snapshot_date=day[i % 40]) for i in range(60)]
    df = to_df(spark, rows).drop("seq")
    store = H.HistoryStore(spark, str(tmp_path / "h"))
    store.create(H.build_history(df.where(F.lit(False)), mode="null_as_empty"))
    assert store.read().count() == 0
    store.apply(None, df)
    batch = H.build_history(df, mode="null_as_empty")
    assert sorted(map(tuple, store.read().collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)
