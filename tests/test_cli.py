"""The command line hands its arguments on and prints what it finds."""

import pytest

from martline.__main__ import main
from martline.plans import rebuild


def test_rebuild_from_raw_csv(spark, tmp_path, monkeypatch, capsys):
    (tmp_path / "airports.csv").write_text("IATA_code,Name,Municipality,iso_region,iso_country\n ATL ,Hartsfield,Atlanta,US-GA,US\n")
    (tmp_path / "known.csv").write_text("iata_code,name,municipality,state,iso_country\nLAX,LA,Los Angeles,CA,US\n")
    seen = []
    monkeypatch.setattr(rebuild, "rebuild_from_csv", lambda spark, folder, airports, *rest: seen.append((folder, [tuple(r) for r in airports.collect()], rest)) or {"t": "p"})
    for name in ("airports", "known"):
        assert main(["rebuild", "--raw", "in", "--airports", str(tmp_path / f"{name}.csv"), "--web-drop", "b.csv", "2024-01-01", "2024-01-05", "--out", "o", "--strict"]) == 0
    assert seen[0] == ("in", [("ATL", "Hartsfield", "Atlanta", "GA", "US")], (("b.csv", "2024-01-01", "2024-01-05"), "o", None, True, None))
    assert seen[1][1] == [("LAX", "LA", "Los Angeles", "CA", "US")] and "t\tp" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["rebuild", "--raw", "in", "--out", "o"])


def test_types(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text("zip,n\n03101,1\n")
    (tmp_path / "b.csv").write_text("n,zip\n2.5,30301\n")
    assert main(["types", str(tmp_path)]) == 0
    assert sorted(capsys.readouterr().out.split()) == ["decimal(2,1)", "n", "string", "zip"]
