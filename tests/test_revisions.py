import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from conftest import submissions, utc
from hourly_star.operators.revisions import collapse, fold, revised, revision_log, single, submitted_once
from hourly_star.operators.upsert import counters, merge_actions, upserted

HOUR = datetime(2026, 9, 19, 10)
T0 = datetime(2026, 9, 20)


def at(i):
    return T0 + timedelta(minutes=i)


def rows_of(values, start=0, code="pm10"):
    return [("giza", code, HOUR, v, "ug/m3", start + i, at(start + i))
            for i, v in enumerate(values)]


def simulate(rows, table=None):
    """One upsert after another; returns the table and the action of each row."""
    table, log = dict(table or {}), []
    for loc, code, hour, value, unit, rid, ts in sorted(rows, key=lambda r: r[5]):
        value = None if value is None else Decimal(str(value)).quantize(Decimal("0.001"))
        key, held = (loc, code, hour), table.get((loc, code, hour))
        if held is None:
            table[key] = (value, unit, rid, ts, ts)
        elif held[:2] != (value, unit):
            table[key] = (value, unit, rid, held[3], ts)
        log.append((rid, key, "I" if held is None else "N" if held[:2] == (value, unit) else "U"))
    return table, log


def as_table(df):
    return {row[:3]: row[3:] for row in utc(df)}


def random_rows(seed, n=400, first=0):
    rnd = random.Random(seed)
    out = []
    for i in range(first, first + n):
        # A third of all submissions go to one reading.
        hot = rnd.random() < 0.34
        key = ("giza", "pm10", HOUR) if hot else (
            rnd.choice("ab"), rnd.choice(["pm10", "ozone"]), HOUR + timedelta(hours=rnd.randrange(9)))
        out.append((*key, rnd.choice([None, 1.5, 2.5]), rnd.choice(["ug/m3", "ug/m3", "mg/m3"]),
                    i, at(i)))
    return out


@pytest.mark.parametrize("segment", [1, 2, 7, 64, 1 << 18, None])
def test_fold_equals_upserts_in_turn(spark, segment):
    rows = random_rows(1)
    assert as_table(fold(submissions(spark, rows), segment)) == simulate(rows)[0]


@pytest.mark.parametrize("segment", [1, 5, 1 << 18])
def test_log_equals_upserts_in_turn(spark, segment):
    first, second = random_rows(2, 150), random_rows(3, 250, first=150)
    table, _ = simulate(first)
    expected = sorted((rid, key, action) for rid, key, action in simulate(second, table)[1])
    log = revision_log(submissions(spark, second), fold(submissions(spark, first)), segment)
    got = sorted((r[3], r[:3], r[7]) for r in utc(log))
    assert got == expected


@pytest.mark.parametrize("segment", [3, 1 << 18, None])
def test_fold_over_a_table_equals_fold_of_everything(spark, segment):
    first, second = random_rows(4, 150), random_rows(5, 250, first=150)
    table, batch = fold(submissions(spark, first)), submissions(spark, second)
    both = as_table(fold(submissions(spark, first + second)))
    assert as_table(upserted(table, batch, segment)) == both
    again = upserted(upserted(table, batch), batch.withColumn("value", batch["value"]))
    assert set(as_table(again)) == set(both)


def test_counters_equal_upserts_in_turn(spark):
    first, second = random_rows(6, 100), random_rows(7, 300, first=100)
    table, _ = simulate(first)
    log = [a for _, _, a in simulate(second, table)[1]]
    got = counters(merge_actions(fold(submissions(spark, first)), submissions(spark, second), 4))
    assert got.first().asDict() == {
        "submitted": 300, "inserted": log.count("I"), "changed": log.count("U"),
        "unchanged": log.count("N"), "repeated": 0}


def test_a_reading_twice_in_one_response_is_counted(spark):
    rows = [*rows_of([1]), *rows_of([2])]
    target = fold(submissions(spark, rows_of([1], code="ozone")))
    assert counters(merge_actions(target, submissions(spark, rows))).first().repeated == 1


@pytest.mark.parametrize("segment", [1, 2, 1 << 18, None])
def test_there_and_back_is_a_change(spark, segment):
    got = as_table(fold(submissions(spark, rows_of([1, 2, 1])), segment))
    assert got[("giza", "pm10", HOUR)] == (Decimal("1.000"), "ug/m3", 2, at(0), at(2))


def test_repeats_do_not_move_the_load_time(spark):
    got = as_table(fold(submissions(spark, rows_of([None, None, 4, 4, 4]))))
    assert got[("giza", "pm10", HOUR)] == (Decimal("4.000"), "ug/m3", 2, at(0), at(2))


def test_a_table_row_that_comes_back_in_one_batch(spark):
    table = fold(submissions(spark, rows_of([1])))
    actions = merge_actions(table, submissions(spark, rows_of([2, 1], start=1)))
    row = actions.first()
    assert (row.action, row.n_updates, row.source_response_id) == ("U", 2, 2)


def test_unchanged_keeps_lineage(spark):
    table = fold(submissions(spark, rows_of([1])))
    row = merge_actions(table, submissions(spark, rows_of([1], start=9))).first()
    assert (row.action, row.n_updates, row.source_response_id) == ("N", 0, 0)


def test_unit_change_alone_is_a_change(spark):
    rows = rows_of([1, 1])
    rows[1] = (*rows[1][:4], "mg/m3", *rows[1][5:])
    got = as_table(fold(submissions(spark, rows)))
    assert got[("giza", "pm10", HOUR)][1:3] == ("mg/m3", 1)


def test_revised(spark):
    rows = rows_of([1, 2]) + rows_of([1, 1], code="ozone")
    assert [r.pollutant_code for r in revised(fold(submissions(spark, rows))).collect()] == ["pm10"]


def test_few_responses_need_one_shuffle(spark, capsys):
    from hourly_star.operators.revisions import SEGMENT, segment_for

    rows = submissions(spark, rows_of([1, 2]))
    assert segment_for(SEGMENT) is None and segment_for(SEGMENT + 1) == SEGMENT
    for segment, shuffles in ((None, 1), (SEGMENT, 2)):
        fold(rows, segment).explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == shuffles


def test_a_batch_without_repetitions_is_not_collapsed(spark):
    hours = [datetime(2026, 9, 1, h) for h in (0, 1, 23)] + [datetime(2026, 9, 2)]
    rows = [(place, code, hour, value, "ug/m3", response, T0)
            for response, place in enumerate(("giza", "luxor"), 1)
            for code, value in (("ozone", 1.5), ("pm10", None)) for hour in hours]
    batch = submissions(spark, rows)
    assert submitted_once(batch)
    assert single(batch).schema.names == collapse(batch).schema.names
    assert sorted(utc(single(batch)), key=repr) == sorted(utc(collapse(batch)), key=repr)
    assert "Window" not in single(batch)._jdf.queryExecution().optimizedPlan().toString()
    for again in (7, 1):  # by another response, by the same one
        assert not submitted_once(submissions(spark, [*rows, (*rows[0][:5], again, T0)]))
    assert submitted_once(batch.limit(0))
