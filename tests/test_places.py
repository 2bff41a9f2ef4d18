from altigrid.operators import places
from altigrid.sources import places as files

CITIES = [
    "Country,City,AccentCity,Region,Population,Latitude,Longitude",
    "fr,paris,Paris,A8,2138551,48.8667,2.3333",
    "fr,nowhere,Nowhere,A8,,48.0,2.0",
    "ad,short,Short,06",
    "us,twin,Twin,07,2138551,48.8667,2.3333",
]
REGIONS = ['FR,A8,"Ile-de-France"', 'us,07,"Comma, Land"', "xx,01"]


def test_cities(lines, rows):
    assert rows(files.parse_cities(lines(*CITIES))) == [
        ("FR", "A8", "Paris", 2138551, 48.8667, 2.3333), ("US", "07", "Twin", 2138551, 48.8667, 2.3333)]
    kept = files.parse_cities(lines(*CITIES), keep_missing=True)
    assert kept.count() == 3 and kept.where("population IS NULL").first().city == "Nowhere"


def test_cities_wide(lines):
    wide = {r.city: r for r in files.parse_cities_wide(lines(*CITIES)).collect()}
    assert wide["nowhere"].population == 0 and wide["City"].lat == 0.0
    assert wide["short"].region == "06" and wide["short"].lon == 0.0


def test_regions(lines, rows):
    assert rows(files.parse_regions(lines(*REGIONS))) == [
        ("FR", "A8", "Ile-de-France"), ("US", "07", "Comma, Land")]
    assert rows(files.parse_regions(lines(*REGIONS), "compat")) == [
        ("FR", "A8", "Ile-de-France"), ("US", "07", "Comm")]


def test_region_as_hex(lines, rows):
    regions = files.parse_regions(lines('a,A8,"x"', 'b,07,"x"', 'c,Z1,"x"', 'd,1,"x"'))
    assert rows(files.region_hex_code(regions), "country", "code") == [
        ("A", 168), ("B", 7), ("C", None), ("D", None)]


def test_join_reduce_and_cells(lines, rows):
    joined = places.join_regions(files.parse_cities(lines(*CITIES)), files.parse_regions(lines(*REGIONS)))
    assert joined.count() == 2
    keyed = places.city_by_geohash(joined)
    # Same place, same population: the last by name.
    assert rows(keyed, "city", "population", "country") == [("Twin", 2138551, "Comma, Land")]
    cells = places.city_cells(keyed)
    assert rows(cells, "qualifier", "value") == [
        ("C", "Comma, Land"), ("c", "Twin"), ("p", "2138551")]
    assert rows(places.cells_wide(cells), *keyed.columns) == rows(keyed)


def test_missing_columns_drop_the_row(spark, rows):
    df = spark.createDataFrame([("a", "x1"), ("b", None), ("c", "y")], "k string, v string")
    assert rows(places.scan_not_missing(df, "v"), "k") == [("a",), ("c",)]
    assert rows(places.scan_not_missing(df, "v", "[0-9]"), "k") == [("a",)]
