import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import CODES, NOW, UNITS, body, responses, utc
from hourly_star.operators.parse import (
    UpstreamDataError, dropped_forecast, parse_responses, readings, refuse, rejected,
)
from hourly_star.schemas import UNIT_SPELLINGS

FOUR, FIVE = "2027-03-08T04:00", "2027-03-08T05:00"


def parsed(spark, *bodies, units=UNITS, **kw):
    return parse_responses(responses(spark, *bodies, **kw), CODES, units)


def reasons(spark, *bodies, units=UNITS):
    """The reason of each body, None for those accepted; one job for all."""
    found = {r.response_id: r.guard_error for r in rejected(parsed(spark, *bodies, units=units)).collect()}
    return [found.get(i + 1) for i in range(len(bodies))]


def changed(**top):
    return json.dumps({**json.loads(body()), **top}, ensure_ascii=False)


def drawn(seed):
    """Documents of random hours around the landing time, with what they mean."""
    rng = random.Random(seed)
    documents, meaning = [], []
    for number in range(1, 13):
        start = NOW.replace(minute=0) - timedelta(hours=rng.randint(0, 60))
        hours = [start + timedelta(hours=i) for i in range(rng.randint(1, 90))]
        arrays = {code: [None if rng.random() < .2 else round(rng.uniform(0, 400), 3) for _ in hours]
                  for code in CODES}
        documents.append(body([f"{h:%Y-%m-%dT%H:%M}" for h in hours], **arrays))
        for code, values in arrays.items():
            meaning += [(number, code, h, None if v is None else Decimal(str(v)))
                        for h, v in zip(hours, values) if h <= NOW]
    return documents, meaning


@pytest.mark.parametrize("seed", [1, 2])
def test_cells_are_hours_up_to_landing_by_code(spark, seed):
    documents, meaning = drawn(seed)
    p = parsed(spark, *documents, location="reykjavik")
    got = utc(readings(p).select("response_id", "pollutant_code", "measured_at_utc", "value"))
    as_text = lambda rows: sorted(
        (i, c, h, None if v is None else f"{v:.3f}") for i, c, h, v in rows)
    assert sorted(as_text(got), key=repr) == sorted(as_text(meaning), key=repr)
    assert {(r.location_code, r.unit) for r in readings(p).collect()} == {("reykjavik", "ug/m3")}
    cells = sum(len(json.loads(d)["hourly"]["time"]) for d in documents) * len(CODES)
    counts = dropped_forecast(p).agg(F.sum("submitted"), F.sum("dropped_future")).first()
    assert (counts[0], counts[1]) == (len(meaning), cells - len(meaning))
    assert rejected(p).isEmpty()


def test_landing_time_itself_is_no_forecast(spark):
    on_time = responses(spark, body([FIVE], [3.25]), at=datetime(2027, 3, 8, 5))
    assert readings(parse_responses(on_time, CODES, UNITS)).count() == len(CODES)
    too_early = responses(spark, body([FIVE], [3.25]), at=datetime(2027, 3, 8, 4, 59))
    assert readings(parse_responses(too_early, CODES, UNITS)).isEmpty()


def test_units(spark):
    assert {ord(s[0]) for s in UNIT_SPELLINGS} == {0x3BC, 0xB5, ord("u")}
    known = [body(units=dict.fromkeys(CODES, unit)) for unit in UNIT_SPELLINGS]
    assert reasons(spark, *known) == [None] * len(known)
    odd = [body(units={**UNITS, "ozone": unit}) for unit in ("ng/m3", "ppm", " ", "UG/M3", "ug m-3", None)]
    assert reasons(spark, *odd) == ["unknown_unit:ozone"] * len(odd)
    assert reasons(spark, body(), units={**UNITS, "pm10": "ng/m3"}) == ["unexpected_unit:pm10"]
    assert reasons(spark, body(), units={}) == [None]


GUARDS = [
    (body(offset=-1800), "utc_offset"), (body(offset=None), "utc_offset"), (body(offset=0.0), None),
    ("{}", "utc_offset"),
    (body([], []), "no_time_axis"), (changed(hourly=None), "no_time_axis"), (body(drop=["time"]), "no_time_axis"),
    (body(drop=["pm10"]), "missing:pm10"), (body(nitrogen_dioxide=None), "missing:nitrogen_dioxide"),
    (body([FOUR, FIVE], [2.5]), "length:pm2_5"), (body(ozone=[None] * 4), "length:ozone"),
    (changed(hourly_units=None), "unknown_unit:pm2_5"),
    ("", "malformed"), ("[1, 2]", "malformed"), (body()[:-2], "malformed"), ("null", "malformed"),
    (body(ozone=["high", 1.0, 2.0]), "malformed"), (body(ozone={"a": 1}), "malformed"),
    (body().replace("21.75", "NaN"), "malformed"), (changed(hourly_units=7), "malformed"),
    (body([FOUR, "yesterday", FIVE]), "malformed_time"), (body([FOUR, None, FIVE]), "malformed_time"),
    (body(["2027-3-8T04:00"], [1.0]), "malformed_time"),
    (body([FIVE, FOUR, FIVE]), "duplicate_time"),
    (body(["2027-03-08T04:10", FIVE], [1.0, 2.0]), "on_hour:measured_at_utc"),
    (body(pm10=[None, 1e7, 2.0]), "overflow:pm10"), (body(pm10=[None, 9999999.9994, 2.0]), None),
    (body(pm10=[None, -0.0005, 2.0]), "nonnegative:value"), (body(pm10=[-0.0004, 0.0, 2.0]), None),
    (body(pm10=[None, 0.0, -4.0]), None),  # an hour to come is not loaded, so not judged
]


def test_guards(spark):
    assert reasons(spark, *[text for text, _ in GUARDS]) == [reason for _, reason in GUARDS]


def test_the_first_guard_names_the_reason(spark):
    assert reasons(spark, body([], [], offset=90, drop=["ozone"]), body(drop=["pm10"], pm2_5=[0.5])) == [
        "utc_offset", "length:pm2_5"]


def test_hours_to_come_may_repeat(spark):
    evening = "2027-03-08T22:00"
    assert reasons(spark, body([FOUR, evening, evening])) == [None]


def test_others_are_read_when_some_are_refused(spark):
    p = parsed(spark, body(offset=5), body(), "x", body())
    assert {r.response_id for r in readings(p).collect()} == {2, 4}
    with pytest.raises(UpstreamDataError, match="1: utc_offset, 3: malformed"):
        refuse(rejected(p))


def test_values_round_half_up(spark):
    p = parsed(spark, body(ozone=[2.0005, 0.0004, 1.0]))
    assert {r.value for r in readings(p).collect() if r.pollutant_code == "ozone"} == {
        Decimal("2.001"), Decimal("0.000")}


def test_document_is_decoded_once(spark, capsys):
    readings(parsed(spark, body(), at=NOW)).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json(") == 1


def test_raw_rows_that_break_a_rule_are_refused(spark):
    rows = responses(spark, *[body()] * 4).withColumns({
        "http_status": F.element_at(F.array(*map(F.lit, (200, 503, 700, 200))), F.col("response_id").cast("int")),
        "window_start": F.lit("2027-03-08").cast("date"),
        "window_end": F.when(F.col("response_id") == 4, F.lit("2027-03-07")).otherwise(F.lit("2027-03-08")).cast("date")})
    found = {r.response_id: r.guard_error for r in rejected(parse_responses(rows, CODES, UNITS)).collect()}
    assert found == {2: "http_error", 3: "within:http_status", 4: "ordered:window_start,window_end"}
