"""Command line front end (same session, argv in)."""

import json
import os

from cubelake import schemas as S
from cubelake.__main__ import main

HEADER = ",".join(S.DELTA_NAMES)


def test_cli_db_and_delta(spark, tmp_dir, capsys):
    reg = os.path.join(tmp_dir, "registry")
    assert main(["db", "create", "--registry", reg], spark=spark) == 0
    assert spark.read.parquet(reg).count() == 0
    src = os.path.join(tmp_dir, "20230803.csv")
    with open(src, "w") as f:
        f.write(HEADER + "\n1,a,1,2023-01-01,,0,0,0,1.0,2023-08-03T08:30,0,0,6\n2,b,2,2023-01-01,,0,0,0,2.0,2023-08-03T08:30,0,0,6\n")
    out = os.path.join(tmp_dir, "split")
    assert main(["delta", "split", src, out], spark=spark) == 0
    assert sorted(d for d in os.listdir(out) if d.startswith("productId=")) == ["productId=1", "productId=2"]
    merged = os.path.join(tmp_dir, "merged.parquet")
    assert main(["delta", "merge", out, out, merged], spark=spark) == 0
    assert spark.read.parquet(merged).count() == 2


def test_cli_full_delta_by_diff_and_sql(spark, tmp_dir, capsys):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    for pid in (41, 42):
        with open(os.path.join(landing, f"{pid}.csv"), "w") as f:
            f.write("REF_DATE,GEO,Sex,VALUE,DECIMALS\n1999,A,Males,1,0\n2001,B,Females,2,0\n")
    with open(os.path.join(landing, "43.csv"), "w") as f:
        f.write("REF_DATE,GEO,VALUE,DECIMALS\n1999,A\n")
    catalog = os.path.join(tmp_dir, "catalog.json")
    with open(catalog, "w") as f:
        json.dump([{"productId": p, "releaseTime": "2023-08-01T12:30"} for p in (41, 42, 43)], f)
    args = ["full", "delta-by-diff", "--catalog", catalog, "--landing", landing,
            "--lake", os.path.join(tmp_dir, "lake"), "--registry", os.path.join(tmp_dir, "reg")]
    assert main(args, spark=spark) == 0
    assert "published 2 of 3 planned cubes" in capsys.readouterr().out
    assert main(["sql", os.path.join(tmp_dir, "lake"), "41", "SELECT GEO FROM cube WHERE year > 2000"], spark=spark) == 0
    assert "|B  |" in capsys.readouterr().out


def test_cli_prepares_exactly_the_named_file(spark, tmp_dir, monkeypatch, capsys):
    folder = os.path.join(tmp_dir, "a folder")
    os.makedirs(folder)
    for name, value in (("302.csv", 1), ("302_old.csv", 2), ("303.CSV", 3)):
        with open(os.path.join(folder, name), "w") as f:
            f.write(f"REF_DATE,GEO,VALUE,DECIMALS\n1999,A,{value},0\n")
    for source, value in (("302.csv", 1), ("303.CSV", 3)):
        out = os.path.join(tmp_dir, f"out {value}.parquet")
        assert main(["full", "prepare", os.path.join(folder, source), "-o", out], spark=spark) == 0
        assert [r.VALUE for r in spark.read.parquet(out).collect()] == [value]
    assert main(["full", "prepare", os.path.join(folder, "404.csv")], spark=spark) == 1
    assert main(["full", "prepare", os.path.join(folder, "none.csv")], spark=spark) == 1


def test_cli_pretty_printed_catalog_and_push(spark, tmp_dir, capsys):
    landing, lake = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "lake")
    os.makedirs(landing)
    with open(os.path.join(landing, "51.csv"), "w") as f:
        f.write("REF_DATE,VALUE,DECIMALS\n1999,1,0\n")
    catalog = os.path.join(tmp_dir, "catalog.json")
    with open(catalog, "w") as f:
        json.dump([{"productId": 51, "releaseTime": "2023-08-01T12:30"}], f, indent=2)
    args = ["full", "delta-by-diff", "--catalog", catalog, "--multi-line", "--landing", landing, "--lake", lake,
            "--registry", os.path.join(tmp_dir, "reg")]
    assert main(args, spark=spark) == 0
    other = os.path.join(tmp_dir, "other")
    assert main(["full", "push", f"{lake}/51.parquet", "--lake", other], spark=spark) == 0
    assert spark.read.parquet(f"{other}/51.parquet").count() == spark.read.parquet(f"{lake}/51.parquet").count() == 1
