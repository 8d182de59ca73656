"""Column functions against stated values."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fieldmosaic.functions import dates, geodesy, sortkeys, text, url, wkt


def column(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_dates(spark):
    first = dt.date(1, 1, 1)
    cases = {
        "111": dt.date(2022, 1, 1), "99/9/9": dt.date(2010, 9, 9), "111.13.40": first, "2024/1/2": dt.date(2024, 1, 2),
        "2024-01-02 03:04:05": dt.date(2024, 1, 2), "20240102": dt.date(2024, 1, 2), "1140318": dt.date(2025, 3, 18),
        "2024-03": dt.date(2024, 3, 1), "2024": dt.date(2024, 1, 1), "2024年": dt.date(2024, 1, 1), "": first, "word": first,
        "202412": first, "2024-02-30": first, "1 1 1": dt.date(2022, 1, 1),
    }
    assert column(spark, list(cases), dates.parse_date) == list(cases.values())
    assert column(spark, [None], dates.parse_date) == [first]


def test_date_time_is_kept(spark):
    got = column(spark, ["2024/1/2 3:04:05", "2024-01-02", None, "2024-01/02 03:04:05"], dates.parse_timestamp)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None]


def test_roc_year(spark):
    assert column(spark, ["111", "x", None], dates.roc_to_ad) == [2022, None, None]


def test_version_digits(spark):
    values = ["TOWN_MOI_1140318", "v11403181", "x12345", "a1140318b1150101", None]
    assert column(spark, values, dates.version_digits) == ["1140318", "1403181", None, "1140318", None]


def test_natural_order(spark):
    names = ["TOWN10", "TOWN2", "TOWN1", "", None, "0", "A01B", "A2", "A", "A10", "9" * 40, "A" + "9" * 41]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in sortkeys.natural_sort(rows, "n").collect()]
    assert got == ["", None, "0", "9" * 40, "A", "A01B", "A2", "A10", "A" + "9" * 41, "TOWN1", "TOWN2", "TOWN10"]


def test_typed_sort(spark):
    data = [(0, "下", "2", "111"), (1, "上", "x", None), (2, "前", "10", "2024"), (3, "水稻", None, "bad"), (4, "中", "9", "99/1/1")]
    rows = spark.createDataFrame(data, "pos int, word string, num string, day string")
    order = lambda keys: [r.pos for r in sortkeys.typed_sort(rows, keys, "pos").collect()]
    assert order([["word", "text_asc"]]) == [1, 2, 4, 0, 3]
    assert order([["num", "number_asc"]]) == [0, 4, 2, 1, 3]
    assert order('[["day", "date_asc"], ["num", "number_asc"]]') == [1, 3, 4, 0, 2]
    assert sorted(order([])) == [0, 1, 2, 3, 4]
    assert order("not json") == []


def test_text(spark):
    assert column(spark, ["This is an example"], text.process_string) == ["this_is_an_example"]
    assert column(spark, [" Ab, 水。c!　", None, "a_b-c"], text.clean_string) == ["ab 水c", "", "a_bc"]
    wide = "𠀀"
    assert column(spark, [wide * 21, wide * 22, "水" * 30, "農地空間圖a - 農業資料開放平臺"], text.clean_table_name) == [
        wide * 21, wide * 15, "水" * 21, "a"]
    assert column(spark, ["x/" + "水" * 25 + ".png", ".bashrc", "a/b.c/d", "a\nb.txt"], text.short_filename) == [
        "水" * 19 + ".png", ".bashrc", "d", "a\nb.txt"]
    assert column(spark, ["TOWN_MOI_1140318.shp", "d/x.y.shp", ".shp"], text.file_stem) == ["TOWN_MOI_1140318", "x.y", ".shp"]
    assert column(spark, ["1,234.5", "x", " 7 ", None], text.parse_thousands) == [1234.5, None, 7.0, None]
    assert column(spark, ["a" * 15, "a" * 16], text.truncate_text) == ["a" * 15, "a" * 15 + "..."]


def test_url(spark):
    set_box = lambda u: url.rewrite_query(u, {"BBOX": F.lit("120,23,121,24"), "WIDTH": F.lit(857)})
    got = column(spark, [
        "https://example.com/wms?BBOX=0,0,1,1&WIDTH=100", "https://e.com/w?bbox=1&STYLES=&a=1&b=2&a=3%204#f", "https://e.com/w",
        "https://e.com/w?n=%E6%B0%B4*~",
    ], set_box)
    tail = "BBOX=120%2C23%2C121%2C24&WIDTH=857"
    assert got == [f"https://example.com/wms?{tail}", f"https://e.com/w?a=1&a=3+4&b=2&{tail}#f", f"https://e.com/w?{tail}",
                   f"https://e.com/w?n=%E6%B0%B4%2A~&{tail}"]


@pytest.mark.parametrize("box, size", [((119.3, 21.9, 122.1, 25.4), (2857, 3876)), ((120.0, 23.0, 120.0, 23.0), (1, 1)), ((120.0, 0.0, 121.0, 0.0), (1113, 1))])
def test_pixel_size(spark, box, size):
    row = spark.createDataFrame([box], "minx double, miny double, maxx double, maxy double")
    assert tuple(row.select(geodesy.pixel_size(F.struct("*")).alias("s")).select("s.*").first()) == size


def meridian_arc(lat: float, steps: int = 20000) -> float:
    """Metres from the equator on GRS80, by numeric integration."""
    a, f = 6378137.0, 1 / 298.257222101
    e2, width = f * (2 - f), math.radians(lat) / steps
    return sum(a * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * width) ** 2) ** 1.5 * width for i in range(steps))


def test_plane_coordinates(spark):
    points = [(121.0, 23.5), (120.0, 23.5), (120.0001, 23.5), (120.0, 23.5001), (122.0, 23.5)]
    rows = spark.createDataFrame(points, "lon double, lat double")
    middle, west, right, above, east = rows.select(geodesy.plane_xy(F.col("lon"), F.col("lat")).alias("p")).select("p.*").collect()
    assert abs(middle.x - 250000) < 1e-6 and abs(middle.y - 0.9999 * meridian_arc(23.5)) < 1e-3
    assert abs((west.x + east.x) / 2 - 250000) < 1e-6 and abs(west.y - east.y) < 1e-6
    # The projection keeps angles: one small step east and one north are scaled alike and stay square.
    sin2 = math.sin(math.radians(23.5)) ** 2
    a, e2 = 6378137.0, (2 - 1 / 298.257222101) / 298.257222101
    ground_east = a / math.sqrt(1 - e2 * sin2) * math.cos(math.radians(23.5)) * math.radians(1e-4)
    ground_north = a * (1 - e2) / (1 - e2 * sin2) ** 1.5 * math.radians(1e-4)
    step = lambda p: (p.x - west.x, p.y - west.y)
    (ex, ey), (nx, ny) = step(right), step(above)
    scale = math.hypot(ex, ey) / ground_east
    assert abs(scale - math.hypot(nx, ny) / ground_north) < 1e-5 and abs(ex * nx + ey * ny) < 1e-2
    assert 0.9999 < scale < 1.0001


def test_wkt(spark):
    value = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0), (0.2 0.1, 0.3 0.1, 0.3 0.2, 0.2 0.1)), ((5 5, 6 5, 6 6, 5 5)))"
    back = column(spark, [value, None], lambda c: wkt.write_multipolygon(wkt.parse_polygon(c)))
    again = column(spark, back, wkt.parse_polygon)
    assert back[1] is None and again == column(spark, [value, None], wkt.parse_polygon)
    assert [len(part) for part in again[0]] == [2, 1]
