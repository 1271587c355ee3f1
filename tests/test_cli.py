"""The stage runners behind the command line, end to end."""

import json
import os

from contrail.cli import main
from test_store_stream import _js

NOW = 1_700_000_000


def test_cli_land_silver_gold_sql(spark, scratch, capsys):
    base = scratch.replace("file:", "")
    os.makedirs(f"{base}/responses", exist_ok=True)
    states = [_js(f"{i:06x}", f"A{i}", NOW - 60) for i in range(6)] + [_js("bad", "B", NOW, lat=100.0)]
    with open(f"{base}/responses/aircraft_data_20231114_220000.json", "w") as f:
        json.dump({"time": NOW, "states": states}, f, indent=4)
    store = f"{scratch}/store"
    assert main(["land", "--responses", f"{base}/responses", "--bronze", f"{scratch}/bronze",
                 "--store", store, "--min-rows", "5"]) == 0
    assert main(["silver", "--store", store, "--min-rows", "5", "--quarantine", f"{scratch}/q"]) == 0
    assert main(["gold", "--store", store]) == 0
    out = [json.loads(ln) for ln in capsys.readouterr().out.splitlines() if ln.startswith("{")]
    assert out[0]["runs"] == [{"run_ts": "20231114_220000", "records": 7}]
    assert out[1]["silver_record_count"] == 6 and out[1]["invalid_geo"] == 1
    assert out[2]["gold_record_count"] == 6
    assert main(["sql", "--store", store, "SELECT status, count(*) AS n FROM flights_gold GROUP BY status",
                 "--output", f"{scratch}/answer"]) == 0
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/answer").collect()] == [("AIRBORNE", 6)]
    capsys.readouterr()
    assert main(["sql", "--store", store, "SELECT icao24 FROM flights_gold ORDER BY icao24"]) == 0
    assert len([ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("00000")]) == 6
    assert main(["sql", "--store", store, "--limit", "2", "SELECT icao24 FROM flights_gold"]) == 0
    assert len([ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("00000")]) == 2
