"""Readers on real files, and writers that refuse."""

import json

import pytest
from pyspark.sql import functions as F

from aeroskein.sources import readers, writers


def test_object_key_overrides_rows(spark, tmp_path):
    folder = tmp_path / "vpts" / "radar-07" / "2025"
    folder.mkdir(parents=True)
    (folder / "20250714_lp_vpts.csv").write_text("radar,datetime,height,dens,ff,dd,DBZH,gap\nUNKNOWN,2025-07-14T22:00:00Z,200,NA,10,90,1,FALSE\nUNKNOWN,2025-07-14T22:00:00Z,400,3,10,90,1,TRUE\n")
    inventory = spark.createDataFrame([("radar-07", "2025-07-14", "lp", "vpts/radar-07/2025/20250714_lp_vpts.csv", "e1")], "radar string, day string, pulse string, key string, etag string")
    rows = readers.read_vpts_archive(spark, f"file://{tmp_path}/vpts", inventory).orderBy("height").collect()
    assert [(r["radar"], r["pulse"], r["dens"], r["gap"], r["source_etag"]) for r in rows] == [("radar-07", "lp", None, False, "e1"), ("radar-07", "lp", 3.0, True, "e1")]


def test_external_rows_keep_their_radar(spark, tmp_path):
    folder = tmp_path / "2025"
    folder.mkdir()
    (folder / "frxxx_vpts_20250714.csv").write_text("radar,datetime,height,dens\nfrabc,2025-07-14T22:00:00Z,200,1\n")
    objects = spark.createDataFrame([("baltrad", "frxxx", "2025-07-14", "baltrad/daily/frxxx/2025/frxxx_vpts_20250714.csv")], "source string, radar string, day string, key string")
    r = readers.read_external_vpts(spark, f"file://{tmp_path}", objects).first()
    assert (r["radar"], r["archive_radar"], r["pulse"]) == ("frabc", "frxxx", "unknown")


INVENTORY = "radar string, day string, pulse string, key string, etag string"


def archive_of(tmp_path, texts):
    folder = tmp_path / "vpts" / "radar-07" / "2025"
    folder.mkdir(parents=True)
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    return f"file://{tmp_path}/vpts"


def listed(spark, *days):
    return spark.createDataFrame([("radar-07", d, "lp", f"vpts/radar-07/2025/2025{d}_lp_vpts.csv", "e" + d) for d in days], INVENTORY)


def test_each_file_is_read_by_its_own_header(spark, tmp_path):
    root = archive_of(tmp_path, {
        "20250701_lp_vpts.csv": "radar,datetime,height,dens,ff,note\nX,2025-07-01 22:00:00,200,5,9,\"a, \"\"b\"\"\"\nX,2025-07-01 22:00:00,400,6\n\n",
        "20250702_lp_vpts.csv": "\ufeffff,dens,height,radar,datetime\r\n9,5,200,X,2025-07-02 22:00:00\r\n",
        "20250703_lp_vpts.csv": 'note,"dens",height,datetime,dens\n"x, y",5,200,2025-07-03 22:00:00,7\n',
        "20250704_lp_vpts.csv": "radar,datetime,height,dens\n",
        "20250705_lp_vpts.csv": "",
    })
    rows = readers.read_vpts_archive(spark, root, listed(spark, "0701", "0702", "0703", "0704", "0705")).orderBy("ts", "height").collect()
    assert [(r["ts"].day, r["height"], r["dens"], r["ff"], r["source_etag"]) for r in rows] == [(1, 200.0, 5.0, 9.0, "e0701"), (1, 400.0, 6.0, None, "e0701"), (2, 200.0, 5.0, 9.0, "e0702"), (3, 200.0, 5.0, None, "e0703")]


def test_only_listed_files_are_opened(spark, tmp_path):
    one = "radar,datetime,height,dens\nX,2025-07-01 22:00:00,200,5\n"
    root = archive_of(tmp_path, {f"2025070{i}_lp_vpts.csv": one for i in range(1, 6)})
    rows = readers.read_vpts_archive(spark, root, listed(spark, "0704", "0702", "0703"), max_files=2)
    assert sorted(f.rsplit("/", 1)[1] for f in rows.inputFiles()) == ["20250702_lp_vpts.csv", "20250703_lp_vpts.csv"]
    assert rows.count() == 2
    assert readers.read_vpts_archive(spark, root, listed(spark, "0701").limit(0)).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_vpts_archive(spark, root, listed(spark, "0709"))


def test_packs_hold_objects(spark, tmp_path, monkeypatch):
    from aeroskein.sources import objects

    root = archive_of(tmp_path, {"20250701_lp_vpts.csv": "radar,datetime,height,dens\nX,2025-07-01 22:00:00,200,1\n"})
    texts = {"0702": "dens,height,radar,datetime\n2,200,X,2025-07-02 22:00:00\n", "0703": "not,to\nbe,read\n", "0704": "radar,datetime,height,dens\r\nX,2025-07-04 22:00:00,200,4\r\nX,2025-07-04 23:00:00,200,5\r\n", "0706": "datetime,dens\n2025-07-06 22:00:00,6\n"}
    for day, text in texts.items():
        spark.createDataFrame([(f"radar-07/2025/2025{day}_lp_vpts.csv", text)], "path string, value string").coalesce(1).write.mode("append").parquet(f"{root}/packs/{int(day) // 3}")
    pack_of = lambda key: F.when(~key.contains("0701"), F.concat(F.lit("packs/"), F.floor(F.regexp_extract(key, "2025(07..)_", 1).cast("int") / 3)))

    def read(*days):
        rows = readers.read_vpts_archive(spark, root, listed(spark, *days), pack_of=pack_of)
        return sorted((r["ts"].day, r["dens"], r["radar"], r["source_etag"]) for r in rows.collect()), rows.inputFiles()

    for at_once in (50_000, 1):
        monkeypatch.setattr(objects, "AT_ONCE", at_once)
        got, opened = read("0706", "0704", "0701", "0702")
        assert got == [(1, 1.0, "radar-07", "e0701"), (2, 2.0, "radar-07", "e0702"), (4, 4.0, "radar-07", "e0704"), (4, 5.0, "radar-07", "e0704"), (6, 6.0, "radar-07", "e0706")]
        assert sum("/packs/" in f for f in opened) == 4
    got, opened = read("0704")  # 0702 to 0704 are in one pack, which alone is opened
    assert [g[0] for g in got] == [4, 4] and sum("/packs/234/" in f for f in opened) == 3 and not any("/packs/235/" in f or f.endswith(".csv") for f in opened)
    with pytest.raises(FileNotFoundError, match="packs/235 has no object radar-07/2025/20250705_lp"):
        read("0702", "0705")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read("0799")


def test_packed_values_are_quoted(spark, tmp_path):
    from aeroskein.sources.objects import read_objects

    rows = spark.createDataFrame([("a", "o1", "X", 'a, "b"'), ("a", "o1", "Y", None), ("b", "o2", "Z", "")], "by string, path string, radar string, day string")
    writers.write_packs(rows, f"file://{tmp_path}/packs", ["by"], "path", ["radar", "day"])
    objects = spark.createDataFrame([("o1", "by=a"), ("o2", "by=b")], "key string, pack string")
    got = read_objects(f"file://{tmp_path}/packs", objects, F.col("key"), ["radar", "day", "dens"], pack=F.col("pack"))
    assert sorted((r["key"], r["_c_radar"], r["_c_day"], r["_c_dens"]) for r in got.collect()) == [("o1", "X", 'a, "b"', None), ("o1", "Y", None, None), ("o2", "Z", None, None)]
    assert all("#" in r["_uri"] for r in got.select("_uri").collect())


def test_json_lists_and_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1}, {"x": 2}]))
    (tmp_path / "b.json").write_text(json.dumps({"items": [{"x": 3}]}))
    assert [r["x"] for r in readers.read_records(spark, f"file://{tmp_path}/a.json", "json").orderBy("x").collect()] == [1, 2]
    assert [r["x"] for r in readers.read_records(spark, f"file://{tmp_path}/b.json", "json").collect()] == [3]


def test_boundary_needs_all_countries(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"c": "A"}, "geometry": {"type": "Polygon", "coordinates": [ring, [[0, 0], [1, 1]]]}}]}
    (tmp_path / "b.json").write_text(json.dumps(doc))
    got = readers.read_boundary(spark, f"file://{tmp_path}/b.json", "c", ["A"]).first()["polygons"]
    assert len(got) == 1 and len(got[0]) == 1 and len(got[0][0]) == 4
    with pytest.raises(ValueError, match="lacks"):
        readers.read_boundary(spark, f"file://{tmp_path}/b.json", "c", ["A", "B"])


def test_predictions_need_support(spark, tmp_path):
    spark.createDataFrame([("2025-07-14", 1.0, 2.0, "lp", "mtr", 3.0)], "hour string, longitude double, latitude double, pulse string, target string, value double").write.option("header", True).csv(f"file://{tmp_path}/p")
    with pytest.raises(ValueError, match="support"):
        readers.read_long_predictions(spark, f"file://{tmp_path}/p")


def test_published_versions_stay(spark, tmp_path):
    rows = spark.range(3)
    root = f"file://{tmp_path}"
    writers.publish_immutable(rows, f"{root}/archive", f"{root}/latest", "v1")
    with pytest.raises(Exception, match="(?i)exist"):
        writers.publish_immutable(rows, f"{root}/archive", f"{root}/latest", "v1")
    writers.publish_immutable(rows, f"{root}/archive", f"{root}/latest", "v2")
    assert [r["version"] for r in spark.read.json(f"{root}/latest").collect()] == ["v2"]


def test_of_two_publishers_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    pointer = f"{root}/latest"
    assert writers.current_version(spark, pointer) is None
    writers.publish_immutable(spark.range(3), f"{root}/archive", pointer, "v1")
    real = writers.commits
    seen = []

    def slow(session, where):
        found = real(session, where)
        if not seen:  # another one publishes after this one has looked
            seen.append(1)
            writers.publish_immutable(spark.range(5), f"{root}/archive", pointer, "v2")
        return found

    monkeypatch.setattr(writers, "commits", slow)
    with pytest.raises(FileExistsError, match="another version"):
        writers.publish_immutable(spark.range(4), f"{root}/archive", pointer, "v3")
    monkeypatch.setattr(writers, "commits", real)
    assert writers.current_version(spark, pointer) == "v2" and real(spark, pointer) == [1, 2]
    row = spark.read.json(pointer).collect()
    assert len(row) == 1 and spark.read.parquet(row[0]["path"]).count() == 5
    assert not [p.name for p in tmp_path.rglob(".*") if "latest" in p.name and not p.name.endswith(".crc")]
    writers.publish_immutable(spark.range(1), f"{root}/archive", pointer, "v4")
    assert writers.current_version(spark, pointer) == "v4"


def test_release(spark):
    assets = spark.createDataFrame([("a",), ("b",), ("https://example.org/x",)], "asset string")
    files = spark.createDataFrame([("a",)], "key string")
    assert [tuple(r) for r in writers.release_problems(assets, files, F.lit(True)).collect()] == [("b", "missing")]
