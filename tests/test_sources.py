import datetime as dt
import json
import os
import sqlite3
import struct
import urllib.error
import zipfile
from pathlib import Path

import numpy as np
import pytest

from cellweave.geo import shapes
from cellweave.sources import fetch, files
from cellweave.sources.features import read_features
from cellweave.steps import datasets as D


def rect(a, b, c, d):
    return shapes.write_wkb(shapes.polygon([(a, b), (c, b), (c, d), (a, d)]))


def geopackage(path: Path, table: str, columns: str, rows: list[tuple]) -> Path:
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geometry')", (table,))
        db.execute(f'CREATE TABLE "{table}" ({columns}, geometry BLOB)')
        head = b"GP\x00\x01" + struct.pack("<i", 27700)
        db.executemany(f'INSERT INTO "{table}" VALUES ({",".join("?" * len(rows[0]))})', [(*r[:-1], head + r[-1]) for r in rows])
    return path


def zipped(path: Path, members: dict[str, bytes]) -> Path:
    with zipfile.ZipFile(path, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return path


def ctx(spark, paths, extracts=None, **options):
    return D.Context(spark, lambda n: f"file://{paths[n]}", (lambda n: extracts[n]) if extracts is not None else None, options)


def shapefile(rows: list[tuple[str, str, list]]) -> dict[str, bytes]:
    records = b""
    for k, (_, _, ring) in enumerate(rows):
        body = struct.pack("<I4dII", 5, 0, 0, 0, 0, 1, len(ring)) + struct.pack("<I", 0) + np.array(ring, "<f8").tobytes()
        records += struct.pack(">II", k + 1, len(body) // 2) + body
    fields = [("id", 10), ("function", 30)]
    head = struct.pack("<4BIHH20x", 3, 1, 1, 1, len(rows), 32 + 32 * len(fields) + 1, 1 + sum(n for _, n in fields))
    head += b"".join(struct.pack("<11sc4xBB14x", n.encode(), b"C", w, 0) for n, w in fields) + b"\r"
    body = b"".join(b" " + a.encode("latin-1").ljust(10) + b.encode("latin-1").ljust(30) for a, b, _ in rows)
    return {".shp": b"\0" * 100 + records, ".dbf": head + body}


def test_crime_archive(spark, tmp_path):
    head = "Crime ID,Month,Falls within,Longitude,Latitude,Crime type\n"
    path = zipped(tmp_path / "crime.zip", {"2024-01/2024-01-x-street.csv": (head + 'a,2024-01,"County, one",-1.5,53.8,Theft\nb,2024-01,,,,Theft\n').encode(), "2024-02/2024-02-x-street.csv": (head + "c,2024-02,British Transport Police,-1.5,53.8,Drugs\n").encode(), "2024-02/2024-02-x-outcomes.csv": b"x\n1\n"})
    rows = {r.crime_id: r for r in D.crime(ctx(spark, {"crime_data": path})).collect()}
    assert rows.keys() == {"a", "b", "c"} and rows["a"].falls_within == "County, one" and rows["a"]._month == "2024-01"
    assert rows["b"].geom is None and rows["b"].falls_within is None
    x, y = shapes.vertices(shapes.read_wkb(bytes(rows["a"].geom)))[0]
    assert 420_000 < x < 440_000 and 430_000 < y < 440_000


def test_greenspace_shapefile(spark, tmp_path):
    clockwise = lambda a, b: [(a, a), (a, b), (b, b), (b, a), (a, a)]
    parts = shapefile([("G1", "Público Park", clockwise(0, 100)), ("G2", "Play Space", clockwise(200, 300))])
    path = zipped(tmp_path / "g.zip", {f"OS/data/GB_GreenspaceSite{k}": v for k, v in parts.items()} | {"OS/data/GB_AccessPoint.shp": b""})
    got = {r.id: r for r in D.greenspace(ctx(spark, {"open_greenspace": path})).collect()}
    assert got["G1"].function == "Público Park" and shapes.area(shapes.read_wkb(bytes(got["G2"].geom))) == 10_000
    with pytest.raises(Exception, match="GB_GreenspaceSite.shp not found"):
        D.greenspace(ctx(spark, {"open_greenspace": zipped(tmp_path / "h.zip", {"x/GB_AccessPoint.shp": b""})})).collect()


def test_land_cover_in_a_zip(spark, tmp_path):
    gpkg = geopackage(tmp_path / "lcm.gpkg", "lcm", "gid INTEGER, _mode INTEGER", [(1, 20, rect(0, 0, 100, 100)), (2, 20, rect(100, 0, 200, 100)), (3, 21, rect(200, 200, 300, 300)), (4, 10, rect(400, 400, 500, 500))])
    path = zipped(tmp_path / "lcm.zip", {"data/lcm.gpkg": gpkg.read_bytes()})
    got = D.land_cover(ctx(spark, {"land_cover": path})).collect()
    assert sorted((r.urban, shapes.area(shapes.read_wkb(bytes(r.geom)))) for r in got) == [(False, 10_000.0), (True, 20_000.0)] and len({r.gid for r in got}) == 2


def test_roads_layer_and_boundaries(spark, tmp_path):
    line = shapes.write_wkb((shapes.LINE, [np.array([(0, 0), (100, 100)], float)]))
    roads = geopackage(tmp_path / "r.gpkg", "road_link", "id TEXT, road_function TEXT", [("R1", "Local Road", line), ("R2", "A Road", line)])
    assert D.open_roads(ctx(spark, {"open_roads": roads})).columns == ["id", "road_function", "geom"]
    areas = geopackage(tmp_path / "b.gpkg", "b", "OA21CD TEXT, FID INTEGER", [("E1", 1, rect(0, 0, 1, 1))])
    got = D.boundaries("output_areas_2021", "OA21CD")(ctx(spark, {"output_areas_2021": areas})).first()
    assert got.spatial_id == "E1" and got.FID == 1


def test_buildings_once_per_premise_with_their_area(spark, tmp_path):
    columns = ", ".join(f"{c} TEXT" for c in ("verisk_premise_id", "premise_use", "premise_type", "uprn", "toid", "map_use", "map_simple_use"))
    row = lambda k, *box: (k, *"abcde", "Residential", rect(*box))
    one = geopackage(tmp_path / "1.gpkg", "b", columns, [row("p1", 430_000, 430_000, 430_010, 430_010), row("p2", 430_095, 430_000, 430_105, 430_010)])
    two = geopackage(tmp_path / "2.gpkg", "b", columns, [row("p1", 430_000, 430_000, 430_010, 430_010), row("p3", 430_200, 430_000, 430_210, 430_010)])
    areas = spark.createDataFrame([("A", bytearray(rect(429_900, 429_900, 430_100, 430_100))), ("B", bytearray(rect(430_100, 429_900, 430_150, 430_100)))], "spatial_id string, geom binary")
    c = D.Context(spark, lambda n: f"file://{one},file://{two}", lambda n: areas)
    assert {r.verisk_premise_id: r.oa21cd for r in D.buildings(c).collect()} == {"p1": "A", "p2": None, "p3": None}
    with pytest.raises(FileNotFoundError):
        files.read_geopackages(spark, [])


def test_retail_centres_are_projected(spark, tmp_path):
    names = "RC_ID TEXT, RC_Name TEXT, Classification TEXT, Country TEXT, Region_NM TEXT, H3_count INTEGER, Retail_N INTEGER, Area_km2 REAL"
    path = geopackage(tmp_path / "rc.gpkg", "rc", names, [("RC1", "n", "c", "E", "R", 1, 2, 0.5, rect(-1.6, 53.7, -1.5, 53.8))])
    got = D.retail_centres(ctx(spark, {"retail_centres": path})).first()
    assert got.rc_id == "RC1" and got.area_km2 == 0.5 and shapes.bounds(shapes.read_wkb(bytes(got.geom)))[0] > 1000


def test_naptan(spark, tmp_path):
    head = "ATCOCode,NaptanCode,CommonName,Street,Indicator,Bearing,LocalityName,Town,StopType,Status,Easting,Northing,Longitude,Latitude\n"
    row = lambda k, kind, status="active", e="430000", n="433000": f"{k},n,c,s,i,N,l,t,{kind},{status},{e},{n},,\n"
    path = tmp_path / "n.csv"
    path.write_text(head + row("0100A", "BCT") + row("0100B", "RLY") + row("0100C", "MET") + row("0100D", "ZZZ") + row("0100E", "BCT", "inactive") + row("0100F", "BCT", e="0", n="0") + row("0100G", "BCT", e="x"))
    got = {r.atco_code: r for r in D.naptan(ctx(spark, {"naptan": path})).collect()}
    assert {k: r.stop_category for k, r in got.items()} == {"0100A": "bus", "0100B": "rail", "0100C": "tram_metro", "0100D": "other"}
    assert shapes.vertices(shapes.read_wkb(bytes(got["0100A"].geom)))[0, 0] == 430_000 and got["0100A"].h3_9_id.startswith("89")


def test_food_outlets(spark, tmp_path):
    head = "BusinessTypeID,BusinessType,FHRSID,BusinessName,Latitude,LocalAuthorityName,Longitude,PostCode,RatingValue,SchemeType\n"
    row = lambda k, kind="1", lat="53.8", lon="-1.5", post="LS1", scheme="FHRS": f'{kind},t,{k},"a, b",{lat},la,{lon},{post},5,{scheme}\n'
    path = tmp_path / "f.csv"
    path.write_text(head + row(1) + row(2, "7843", post="") + row(3, scheme="FHIS") + row(4, post="BT1") + row(5, "7844") + row(6, "4613") + row(7, lat="", lon=""))
    assert sorted(r.fhrsid for r in D.food_outlets(ctx(spark, {"food_outlets": path})).collect()) == [1, 2, 5]


def test_cctv_nodes(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"elements": [{"type": "node", "id": 1, "lon": -1.5, "lat": 53.8}, {"type": "node", "id": 2, "lon": -1.6, "lat": 53.8, "tags": {}}, {"type": "way", "id": 3}]}))
    assert sorted(r.cctv_id for r in D.cctv(ctx(spark, {"cctv": path})).collect()) == ["node/1", "node/2"]
    path.write_text(json.dumps({"elements": []}))
    with pytest.raises(RuntimeError):
        D.cctv(ctx(spark, {"cctv": path}))
    box = (-5.86, 49.75, 1.81, 56.0)
    assert '["man_made"="surveillance"](49.75,-5.86,56.0,1.81);' in fetch.map_query(box, {"man_made": "surveillance"})
    assert fetch.map_query(box, {"a": None}, ("node", "way")).count('["a"](49.75') == 2


def test_places_and_street_lights(spark, tmp_path):
    at = bytearray(shapes.write_wkb((shapes.POINT, np.array([[-1.5, 53.8]]))))
    schema = "id string, geometry binary, names struct<primary: string>, addresses array<struct<postcode: string>>, basic_category string, categories struct<primary: string, alternate: array<string>>, subtype string, class string, bbox struct<xmin: double, xmax: double, ymin: double, ymax: double>"
    box = (-1.5, -1.5, 53.8, 53.8)
    rows = [("a", at, ("Inn",), [("LS1",)], "bar", ("pub", ["bar"]), "transportation", "street_lamp", box), ("b", at, ("Kiosk",), [], "inn", ("kiosk", None), "x", "y", box), ("c", at, ("Far",), None, "bar", ("pub", None), "x", "y", (9.0, 9.0, 9.0, 9.0))]
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/p")
    c = ctx(spark, {"poi": tmp_path / "p", "streetlights": tmp_path / "p"}, box=(-6, 49, 2, 60))
    got = {r.poi_id: r for r in D.poi(c).collect()}
    assert got.keys() == {"a", "b"} and got["a"].postcode == "LS1" and got["b"].postcode is None and got["a"].alternate_category == ["bar"]
    assert [r.streetlight_id for r in D.streetlights(c).collect()] == ["a"]


def ods(rows: list[list]) -> bytes:
    cell = lambda v: "<table:table-cell/>" if v is None else f'<table:table-cell office:value="{v}"><text:p>{v}</text:p></table:table-cell>' if isinstance(v, (int, float)) else f"<table:table-cell><text:p>{v}</text:p></table:table-cell>"
    body = "".join(f"<table:table-row>{''.join(map(cell, r))}</table:table-row>" for r in rows)
    names = " ".join(f'xmlns:{k}="urn:oasis:names:tc:opendocument:xmlns:{k}:1.0"' for k in ("office", "table", "text"))
    return f'<office:document-content {names}><table:table table:name="Data">{body}</table:table></office:document-content>'.encode()


def test_deprivation(spark, tmp_path):
    england = tmp_path / "e.csv"
    england.write_text(",".join(f'"{c}"' for c in D.ENGLAND) + "\n" + "".join(f"E{k},L1,Leeds,{5 + 10 * k},{(100, 50, 10)[k]}" + f",{k}" * 7 + "\n" for k in range(3)))
    names = ["LSOA code", "LSOA name ", "Local Authority name", "WIMD 2025", "Income", "Employment", "Education", "Health", "Community Safety", "Physical Environment", "Access to Services", "Housing"]
    wales = zipped(tmp_path / "w.ods", {"content.xml": ods([["t"], [None], ["x"], names] + [[f"W{k}", "n", "Cardiff" if k < 3 else "Swansea", 10.0 * k] + [float(k)] * 8 for k in (1, 2, 3)])})
    lads = spark.createDataFrame([("W06000015", "Cardiff"), ("W06000011", "Swansea")], "spatial_id string, lad24nm string")
    c = ctx(spark, {"imd_england": england, "imd_wales": wales}, {"local_authority_districts": lads})
    got = {r.spatial_id: r for r in D.imd(c).collect()}
    assert [got[f"E{k}"].imd_score for k in range(3)] == [1 / 3, 2 / 3, 1.0] and [got[f"E{k}"].imd_rank for k in range(3)] == [100, 50, 10]
    assert got["W3"].imd_score == 1.0 and got["W3"].imd_rank == 1 and got["W3"].bhs == 1.0 and got["W1"].lad24cd == "W06000015" and got["W3"].lad24cd == "W06000011"
    assert D.imd(ctx(spark, {"imd_england": england}, None)).count() == 3
    assert D.imd(ctx(spark, {"imd_england": england, "imd_wales": tmp_path / "absent.ods"}, None)).count() == 3
    other = zipped(tmp_path / "o.ods", {"content.xml": ods([["t"]]).replace(b'"Data"', b'"Notes"')})
    with pytest.raises(Exception, match="no sheet Data"):
        D.imd(ctx(spark, {"imd_england": england, "imd_wales": other}, None)).count()


def test_area_classification(spark, tmp_path):
    path, looks = tmp_path / "o.csv", tmp_path / "c.csv"
    path.write_text("oa21cd,subgroup\n E1 ,1a1 \n")
    looks.write_text('"Classification Code","Level Code","Classification Name"\n1,sg,One\n1a,g, G \n1a1,subg,S\n')
    c = ctx(spark, {"oac": path, "oac_classification": looks})
    assert tuple(D.oac(c).first()) == ("E1", "1a1") and tuple(D.oac_classification(c).first()) == ("1a1", "S", "G", "One")


def test_schools_with_their_walks(spark, tmp_path):
    names = "urn,establishmentnumber,establishmentname,typeofestablishment_code,typeofestablishment_name,establishmentstatus_code,phaseofeducation_code,phaseofeducation_name,statutorylowage,statutoryhighage,schoolcapacity,postcode,urbanrural_code,districtadministrative_code,msoa_code,lsoa_code,easting,northing".split(",")
    path = tmp_path / "s.csv"
    path.write_bytes((",".join(n.upper() for n in names) + "\n" + "1,1,École,1,t,1,1,p,3,9,10,LS1,u,d,m,l,10,10\n2,2,Shut,1,t,4,1,p,3,9,10,LS1,u,d,m,l,10,10\n").encode("cp1252"))
    line = lambda *p: bytearray(shapes.write_wkb((shapes.LINE, [np.array(p, float)])))
    roads = spark.createDataFrame([("A", "B", 100.0, line((0, 0), (100, 0))), ("B", "C", 100.0, line((100, 0), (100, 100))), ("C", "D", 100.0, line((100, 100), (0, 100))), ("D", "A", 100.0, line((0, 100), (0, 0)))], "start_node string, end_node string, length double, geom binary")
    got = D.schools(ctx(spark, {"schools": path}, {"open_roads": roads})).collect()
    assert len(got) == 1 and got[0].establishmentname == "École" and abs(got[0].isochrone_area_km2 - 0.01) < 1e-12 and got[0].h3_11_id.startswith("8b")


def test_unpacked_members_and_first_answers(tmp_path):
    archive = zipped(tmp_path / "a.zip", {"in/x.txt": b"one"})
    dest = fetch.unpacked(archive, "in/x.txt", tmp_path)
    assert dest.read_text() == "one"
    dest.write_text("two")  # the same size, another checksum
    assert fetch.unpacked(archive, "in/x.txt", tmp_path).read_text() == "one"
    os.utime(dest, (1, 1))
    assert fetch.unpacked(archive, "in/x.txt", tmp_path).stat().st_mtime == 1
    with pytest.raises(KeyError):
        fetch.unpacked(archive, "absent", tmp_path)
    asked = []

    def get(url, to):
        asked.append(url)
        if "20240301" in url:
            raise urllib.error.URLError("none")
        return fetch._replaced(to, [b"whole"])

    urls = fetch.by_day("http://x/f{day:%Y%m%d}.csv", dt.date(2024, 3, 1))
    got = fetch.first_answer(urls, tmp_path, get)
    assert got.name == "f20240229.csv" and got.read_text() == "whole" and asked == urls
    assert fetch.first_answer(urls[1:], tmp_path, None) == got
    with pytest.raises(FileNotFoundError, match="20240301"):
        fetch.first_answer(urls[:1], tmp_path, get)

    def broken():
        yield b"half"
        raise OSError("cut off")

    with pytest.raises(OSError):
        fetch._replaced(got, broken())
    assert got.read_text() == "whole" and not list(tmp_path.glob(".*"))


def test_obtaining_a_source(tmp_path):
    sent = []

    def get(url, to, post=None):
        sent.append((url, post))
        return zipped(to, {"m.csv": b"a,b"}) if url.endswith("zip") else fetch._replaced(to, [url.encode()])

    folder = tmp_path / "s"
    folder.mkdir()
    entry = {"urls": ["http://x/d{day:%d}.json"], "post": {"data": "q"}}
    path = fetch.obtain(entry, folder, today=dt.date(2024, 3, 1), get=get)
    assert path.name == "d01.json" and sent == [("http://x/d01.json", {"data": "q"})]
    assert fetch.obtain(entry, folder, get=None) == path
    fetch.obtain(entry, folder, force=True, today=dt.date(2024, 3, 1), get=get)
    assert len(sent) == 2
    assert fetch.obtain({"urls": ["http://x/a.zip"], "member": "m.csv"}, tmp_path / "z", get=get).read_text() == "a,b"
    with pytest.raises(FileNotFoundError, match="ask for it"):
        fetch.obtain({"manual": "ask for it"}, tmp_path / "none")
    assert fetch.latest(tmp_path / "none", "*") is None


def test_catalogue_with_override(tmp_path):
    base, over = tmp_path / "a.json", tmp_path / "b.json"
    base.write_text('{"x": {"url": 1}, "y": {"url": 2}}')
    assert fetch.data_source("x", base, over) == {"url": 1}
    over.write_text('{"x": {"url": 3}}')
    assert fetch.data_source("x", base, over) == {"url": 3} and fetch.data_source("y", base, over) == {"url": 2}
    with pytest.raises(ValueError):
        fetch.data_source("z", base, over)


def test_normalised_names():
    assert [files.normalize_name(n) for n in ("Month", "Falls within", " LSOA code ", "2nd")] == ["_month", "falls_within", "lsoa_code", "_2nd"]


def test_parts_of_files_give_all_rows_once(spark, tmp_path):
    """Ranges of rows and records, and members, in as many tasks as planned."""
    rows = [(k, k % 3 == 0, f"n{k}", None if k % 7 == 0 else k / 2, rect(k, 0, k + 1, 1)) for k in range(1000)]
    gpkg = geopackage(tmp_path / "a b%.gpkg", "big", "k INTEGER, flag BOOLEAN, name TEXT, v REAL", rows)
    plain = files.read_geopackage(spark, f"file://{tmp_path}/*.gpkg")
    parts = files.read_geopackage(spark, f"file://{tmp_path}/*.gpkg", part_bytes=20_000)
    assert plain.rdd.getNumPartitions() == 1 and parts.rdd.getNumPartitions() > 3
    key = lambda df: sorted((r.k, r.flag, r.name, r.v, bytes(r.geom)) for r in df.collect())
    assert key(parts) == key(plain) == [tuple(r) for r in rows]
    archive = zipped(tmp_path / "z.zip", {"in/x.gpkg": gpkg.read_bytes()})
    again = files.read_geopackage(spark, f"file://{archive}", part_bytes=5_000)
    assert again.rdd.getNumPartitions() > 1 and key(again) == key(plain)
    assert files.read_geopackage(spark, f"file://{archive}").select("k").agg({"k": "sum"}).first()[0] == sum(range(1000))
    shp = shapefile([(f"G{k}", "f", [(k, 0), (k, 1), (k + 1, 1), (k, 0)]) for k in range(300)])
    path = zipped(tmp_path / "s.zip", {f"d/site{k}": v for k, v in shp.items()})
    found = files.read_shapefile(spark, f"file://{path}", "site.shp", part_bytes=6_000)
    assert found.rdd.getNumPartitions() > 3 and sorted((int(r.id[1:]), shapes.bounds(shapes.read_wkb(bytes(r.geom)))[0]) for r in found.collect()) == [(k, k) for k in range(300)]


def test_small_members_share_a_task_and_large_ones_do_not(spark, tmp_path, monkeypatch):
    members = {f"2024-{m:02}/2024-{m:02}-x-street.csv": ("Month,B\n" + "".join(f"{m},{k}\n" for k in range(50))).encode() for m in range(1, 9)}
    members["2024-09/2024-09-x-street.csv"] = b"B,C\n1,2\n"
    path = zipped(tmp_path / "c.zip", members)
    assert files.read_zipped_csv(spark, f"file://{path}", "*/*-street.csv").rdd.getNumPartitions() == 1
    monkeypatch.setattr(files, "PART_BYTES", 600)
    got = files.read_zipped_csv(spark, f"file://{path}", "*/*-street.csv")
    assert got.columns == ["_month", "b"] and 3 < got.rdd.getNumPartitions() < 9
    assert sorted((r._month or "", int(r.b)) for r in got.collect()) == sorted([(str(m), k) for m in range(1, 9) for k in range(50)] + [("", 1)])
    with pytest.raises(FileNotFoundError, match="no member"):
        files.read_zipped_csv(spark, f"file://{path}", "*.txt")


def test_windows_text_in_split_files(spark, tmp_path):
    text = bytes(b for b in range(0x80, 0x100) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("cp1252")
    path = tmp_path / "w.csv"
    path.write_bytes(("na€me,b\n" + f"{text},1\n" * 3).encode("cp1252"))
    for multiline in (True, False):
        got = files.read_csv_text(spark, f"file://{path}", "windows-1252", multiline=multiline)
        assert got.columns == ["na€me", "b"] and [tuple(r) for r in got.collect()] == [(text, "1")] * 3
    with pytest.raises(ValueError, match="not supported"):
        files.read_csv_text(spark, f"file://{path}", "cp437")


class PagedService:
    """A feature service with 23 features, of which the third page fails at first."""

    def __init__(self):
        import http.server
        import threading
        import urllib.parse

        self.asked, self.failed, self.short, service = [], 0, False, self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                at = urllib.parse.urlparse(self.path)
                q = {k: v[0] for k, v in urllib.parse.parse_qs(at.query).items()}
                service.agents.add(self.headers["User-Agent"])
                if at.path.endswith("/layer"):
                    self.say({"fields": [{"name": "FID", "type": "esriFieldTypeOID"}, {"name": "CODE", "type": "esriFieldTypeString"}, {"name": "Shape__Area", "type": "esriFieldTypeDouble"}], "objectIdField": "FID", "maxRecordCount": 5})
                elif q.get("returnCountOnly") == "true":
                    self.say({"count": 23})
                else:
                    start, n = int(q["resultOffset"]), int(q["resultRecordCount"])
                    assert q["orderByFields"] == "FID" and q["outSR"] == "27700"
                    if start == 10 and service.failed < 2:
                        service.failed += 1
                        if service.failed == 1:
                            self.send_error(503)
                        else:
                            self.say({"error": {"code": 500, "message": "busy"}})
                        return
                    service.asked.append(start)
                    shape = lambda k: [{"type": "Polygon", "coordinates": [[[k, 0], [k + 1, 0], [k + 1, 1], [k, 0]]]}, {"type": "MultiPolygon", "coordinates": [[[[k, 0, 9], [k + 2, 0, 9], [k + 2, 2, 9], [k, 0, 9]]]]}, None][k % 3]
                    self.say({"features": [{"properties": {"FID": k, "CODE": f"E{k}", "Shape__Area": k / 2}, "geometry": shape(k)} for k in range(start, min(23, start + n) - service.short)]})

            def say(self, what):
                body = json.dumps(what).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *a):
                pass

        self.agents = set()
        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/layer/query"


def test_paged_features_are_read_once_each(spark):
    service = PagedService()
    df = read_features(spark, service.url)
    assert df.rdd.getNumPartitions() == 5 and df.dtypes == [("FID", "bigint"), ("CODE", "string"), ("Shape__Area", "double"), ("geom", "binary")]
    service.asked.clear()
    rows = sorted(df.collect())
    assert [r.FID for r in rows] == list(range(23)) and sorted(service.asked) == [0, 5, 10, 15, 20] and service.failed == 2
    assert [shapes.area(shapes.read_wkb(bytes(r.geom))) if r.geom else None for r in rows[:3]] == [0.5, 2.0, None] and all("cellweave" in a for a in service.agents)
    got = D.boundaries("x", "CODE")(D.Context(spark, lambda n: service.url)).where("spatial_id = 'E22'").first()
    assert got.Shape__Area == 11.0
    service.short = True
    with pytest.raises(Exception, match="announced"):
        df.count()
    service.server.shutdown()


def test_every_source_of_every_dataset_is_in_the_catalogue():
    for d in D.DATASETS:
        for name in d.sources or (d.name,):
            entry = fetch.data_source(name)
            assert entry.keys() & {"urls", "features", "manual"}
    entry = fetch.data_source("cctv")
    assert entry["timeout"] == 600 and '["man_made"="surveillance"](49.75,-5.86,56.0,1.81);' in fetch.map_query(tuple(entry["map"]["box"]), entry["map"]["tags"])


def test_map_queries_name_their_agent_and_time(tmp_path):
    import http.server
    import threading

    said = {}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            said.update(agent=self.headers["User-Agent"], body=self.rfile.read(int(self.headers["Content-Length"])).decode())
            self.send_response(406 if "Python" in said["agent"] else 200)
            self.end_headers()
            self.wfile.write(b'{"elements": []}')

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    entry = fetch.data_source("cctv") | {"urls": [f"http://127.0.0.1:{server.server_port}/api/interpreter"]}
    assert fetch.obtain(entry, tmp_path / "cctv").name == "cctv.json" and "surveillance" in said["body"] and "cellweave" in said["agent"]
    server.shutdown()
