"""Bronze decoding: Python-cast fidelity, malformed rows, both file formats."""

import json
import math
import os
import re

import pytest
from pyspark.sql import functions as F

from contrail import schema as S
from contrail.operators.quality import is_clean, log_reasons
from contrail.sources import decode_states, envelope_states, land_snapshots, read_states

GOOD = ["abc123", "FL1  ", "Xland", 1700000000, 1700000100, -180, 90, 1000.5, True, 250.0, 90, -5,
        [1, 2], 1100, "7700", False, 0]


def _line(row):
    return json.dumps(row)


def _decode(spark, *lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, value string")
    return {r["i"]: r for r in decode_states(df).collect()}


def test_clean_row_types_and_values(spark):
    r = _decode(spark, _line(GOOD))[0]
    assert r["_decode_error"] is None and r["_raw"] is None
    assert r["icao24"] == "abc123"
    assert r["callsign"] == "FL1  "  # not trimmed
    assert r["time_position"] == 1700000000 and r["last_contact"] == 1700000100
    assert r["longitude"] == -180.0 and r["latitude"] == 90.0
    assert r["on_ground"] is True and r["spi"] is False
    assert r["sensors"] is None  # always null
    assert r["squawk"] == "7700"
    assert r["position_source"] == 0


def test_python_like_numeric_casts(spark):
    a, b, c = list(GOOD), list(GOOD), list(GOOD)
    a[4] = 3.7
    b[4] = "1700000005"
    c[4] = "x"
    got = _decode(spark, _line(a), _line(b), _line(c))
    assert got[0]["last_contact"] == 3 and got[0]["_decode_error"] is None
    assert got[1]["last_contact"] == 1700000005
    assert got[2]["_decode_error"] == "bad_value" and got[2]["_raw"] is not None


def test_nan_latitude_is_a_number(spark):
    row = list(GOOD)
    row[6] = float("nan")
    text = json.dumps(row)  # Python writes NaN
    r = _decode(spark, text)[0]
    assert r["_decode_error"] is None
    assert math.isnan(r["latitude"])


def test_row_lengths_and_unparsable(spark):
    long_row = GOOD + ["extra"]
    got = _decode(spark, _line(long_row), _line(GOOD[:2]), "[1, 2", "")
    assert got[0]["_decode_error"] is None and got[0]["position_source"] == 0
    assert got[1]["_decode_error"] == "short_row"
    assert got[2]["_decode_error"] == "unparsable"
    assert got[3]["_decode_error"] == "unparsable"


def test_boolean_truthiness(spark):
    rows = []
    for v in (True, False, 1, 0, "", "yes", None):
        r = list(GOOD)
        r[8] = v
        rows.append(_line(r))
    got = _decode(spark, *rows)
    assert [got[i]["on_ground"] for i in range(7)] == [True, False, True, False, False, True, None]


def test_array_format_files(spark, scratch):
    os.makedirs(scratch.replace("file:", ""), exist_ok=True)
    base = scratch.replace("file:", "")
    with open(f"{base}/aircraft_data_20240101_120000.json", "w") as f:
        json.dump([GOOD, GOOD[:3]], f, indent=4)
    with open(f"{base}/aircraft_data_20240101_123000.json", "w") as f:
        f.write("[[1, 2")
    with open(f"{base}/aircraft_data_20240101_130000.json", "w") as f:
        f.write("[]")
    df = read_states(spark, base, fmt="array")
    rows = df.select("run_ts", "icao24", "_decode_error").collect()
    by_run = {}
    for r in rows:
        by_run.setdefault(r["run_ts"], []).append(r["_decode_error"])
    assert sorted(by_run["20240101_120000"], key=str) == [None, "short_row"]
    assert by_run["20240101_123000"] == ["unparsable"]
    assert "20240101_130000" not in by_run  # empty snapshot: no rows, count gate catches it


def test_envelope_landing_roundtrip(spark, scratch):
    env_ok = json.dumps({"time": 1, "states": [GOOD, GOOD]})
    env_null = json.dumps({"time": 2, "states": None})
    env_missing = json.dumps({"time": 3})
    responses = spark.createDataFrame(
        [("20240101_000000", env_ok), ("20240101_001000", env_null), ("20240101_002000", env_missing)],
        "run_ts string, body string",
    )
    assert envelope_states(responses).count() == 2
    land_snapshots(responses, scratch)
    back = read_states(spark, scratch)
    assert back.count() == 2
    r = back.first()
    assert r["run_ts"] == "20240101_000000" and r["icao24"] == "abc123" and r["_decode_error"] is None
    # re-landing the same run replaces it (idempotent)
    land_snapshots(responses, scratch)
    assert read_states(spark, scratch).count() == 2


def test_decode_is_all_jvm_expressions(spark):
    df = spark.createDataFrame([(_line(GOOD),)], "value string")
    plan = decode_states(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan


def test_schema_matches(spark):
    df = spark.createDataFrame([(_line(GOOD),)], "value string")
    out = decode_states(df).select(*S.STATE_COLUMNS)
    assert out.schema == S.STATE_SCHEMA or [f.dataType for f in out.schema] == [
        f.dataType for f in S.STATE_SCHEMA
    ]
    assert F is not None


def test_java_number_suffix_is_a_bad_value(spark):
    from contrail.sources import decode_states

    def line(v):
        return f'["a","b","X",1,2,3.5,{v},0,false,0,0,0,[1,2],0,"1200",false,0]'

    df = spark.createDataFrame([(line('"12d"'),), (line('"1.5f"'),), (line("4.5"),), (line("NaN"),)], "value string")
    got = [(r.latitude, r._decode_error) for r in decode_states(df).collect()]
    assert got[:3] == [(None, "bad_value"), (None, "bad_value"), (4.5, None)]
    assert got[3][1] is None and got[3][0] != got[3][0]  # NaN is a number


def test_epoch_without_date_text_is_a_bad_value(spark):
    from contrail.sources import decode_states

    df = spark.createDataFrame(
        [('["a","b","X",1,253402300800,3.5,4.5,0,false,0,0,0,null,0,"1200",false,0]',)], "value string")
    assert decode_states(df).first()._decode_error == "bad_value"


def test_unparsable_array_file_keeps_its_text(spark):
    from contrail.sources import decode_states

    df = spark.createDataFrame([("[[1, 2",)], "value string")
    r = decode_states(df, fmt="array").first()
    assert (r._decode_error, r._raw) == ("unparsable", "[[1, 2")


# ---------------------------------------------------------------------------
# Snapshot files read in pieces
# ---------------------------------------------------------------------------

STATES = [[f"{i:06x}", "line\nfeed ], [ \" \\" if i % 7 == 0 else "A", "X", 1, 2, 3.5, -4.5, None, i % 2 == 0, 0, 0, 0, [1, [2, 3]] if i % 5 == 0 else None,
           7.5, "7700", True, 1] for i in range(60)]
ODD = [[], ["short"], [[1], 2], STATES[0][:16] + [[9]], [None] * 17, []]


@pytest.mark.parametrize("states", [STATES, STATES + ODD, ODD + STATES, ODD, [], [[]], [STATES[0]], [["a"]]])
@pytest.mark.parametrize("split", [97, 1000, 1 << 27])
def test_pieces_of_a_snapshot_file_are_its_states(spark, scratch, states, split):
    import json
    import os

    base = scratch.replace("file:", "")
    os.makedirs(base)
    forms = {"20231114_220000": dict(indent=4), "20231114_230000": {}, "20231114_235900": dict(indent=2)}
    for stamp, kw in forms.items():
        with open(f"{base}/aircraft_data_{stamp}.json", "w") as f:
            json.dump(states, f, **kw)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = read_states(spark, base, fmt="array")
        got = sorted((tuple(r) for r in df.collect()), key=repr)
        tasks = read_states(spark, f"{base}/aircraft_data_20231114_220000.json", fmt="array").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    lines = spark.createDataFrame([(json.dumps(s), run) for s in states for run in forms], "value string, run_ts string")
    plain = decode_states(lines).drop("_raw").collect()
    assert sorted((tuple(x[:-1]) for x in got), key=repr) == sorted((tuple(r) for r in plain), key=repr)
    if len(states) > 50 and split < 1000:
        assert tasks > 20  # one file, many tasks


@pytest.mark.parametrize("cut", [25, 200, 900, -3, -9])
def test_a_cut_off_snapshot_file_is_logged(spark, scratch, cut):
    import json
    import os

    base = scratch.replace("file:", "")
    os.makedirs(base)
    whole = json.dumps(STATES[1:5], indent=4)
    assert len(whole) > 930
    with open(f"{base}/aircraft_data_20231114_220000.json", "w") as f:
        f.write(whole[:cut])
    rows = read_states(spark, base, fmt="array").collect()
    assert any((r._raw or "").startswith("!no end of file") and r.run_ts == "20231114_220000" for r in rows)
    good = [r.icao24 for r in rows if r._decode_error is None]
    assert good == [s[0] for s in STATES[1:5]][: len(good)]


def test_decoding_and_counting_compile_to_code_the_jvm_compiles(spark, tmp_path, capsys):
    """A method of more than 8000 bytes stays interpreted; a rule written out for every column made one of a row's work."""
    (tmp_path / "part-0.txt").write_text(_line(GOOD))
    df = decode_states(spark.read.text(str(tmp_path)))
    seen = df.observe("seen", *(F.count_if(c).alias(r) for r, c in log_reasons(df).items()), F.count_if(is_clean(df)).alias("clean"))
    seen.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000, sizes


def test_number_suffixes_and_quotes_read_as_before(spark):
    for text, want in (("12", 12.0), ("1.5e3", 1500.0), ('"12"', 12.0), ('"12d"', None), ('"12f "', None), ('"1d2"', None),
                       ('" 7 "', 7.0), ("NaN", float("nan")), ('""', None), ('"0x1p3"', 8.0), ("true", 1.0)):
        line = _line(GOOD).replace("1000.5", text)
        r = _decode(spark, line)[0]
        got = r["baro_altitude"]
        assert (got == want) or (want is not None and got is not None and math.isnan(want) and math.isnan(got)), text
        assert r["_decode_error"] == (None if want is not None else "bad_value"), text
