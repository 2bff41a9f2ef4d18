import numpy as np

from altigrid.__main__ import main
from altigrid.operators import pixels, pyramid, tiles
from altigrid.sources import store


def test_tiles_from_text(spark, rows, tmp_path):
    source, out = tmp_path / "dem.txt", str(tmp_path / "out")
    rng = np.random.default_rng(2)
    data = [(round(float(a), 4), round(float(b), 4), int(h)) for a, b, h in zip(
        rng.uniform(-90, 89, 400), rng.uniform(-180, 179, 400), rng.integers(0, 9000, 400))]
    source.write_text("\n".join(f"{a},{b},{h}" for a, b, h in data) + "\nbroken,line\n")
    main(["tiles", "--source", str(source), "--out", out, "--max-zoom", "2"])
    points = spark.createDataFrame(data, "lat double, lon double, height int")
    levels = pyramid.pyramid_by_level(pixels.pixel_max(points, 2), 2)
    assert rows(store.read_pixels(spark, f"{out}/pixels"), "zoom", "gx", "gy", "alt") == rows(
        levels, "zoom", "gx", "gy", "alt")
    assert rows(store.read_tiles(spark, f"{out}/tiles"), "zoom", "geohash", "tile") == rows(
        tiles.pack_tiles(levels), "zoom", "geohash", "tile")


def test_hgt_to_text_and_stats(spark, tmp_path):
    grid = np.arange(1201 * 1201).reshape(1201, 1201) % 3000
    (tmp_path / "N45E006.hgt").write_bytes(grid.astype(">i2").tobytes())
    text, out = str(tmp_path / "text"), str(tmp_path / "stats")
    main(["hgt-to-text", "--source", str(tmp_path / "N45E006.hgt"), "--out", text])
    assert spark.read.text(text).count() == 1201 * 1201
    main(["elevation-stats", "--source", text, "--out", out])
    summary = spark.read.csv(f"{out}/summary", header=True).first()
    assert int(summary.n) == 1201 * 1201 and int(summary.max) == 2999
    histogram = spark.read.csv(f"{out}/histogram_edges", header=True, inferSchema=True)
    assert histogram.count() == 99 and histogram.agg({"n": "sum"}).first()[0] == 1201 * 1201


def test_gps_and_points(spark, tmp_path):
    source = tmp_path / "gps.txt"
    source.write_text("\n".join(["1.5,2.5"] * 6 + ["1.5,2.50001", "80,-170", "bad"]))
    out = str(tmp_path / "gps")
    main(["gps-visits", "--source", str(source), "--out", out, "--zoom", "9"])
    assert sorted(r.n for r in spark.read.parquet(f"{out}/visits").collect()) == [1, 7]
    assert spark.read.text(f"{out}/text").count() == 2
    main(["gps-stats", "--source", str(source), "--out", f"{out}/stats"])
    points = str(tmp_path / "points")
    main(["points", "--source", str(source), "--out", points])
    assert spark.read.text(f"{points}/failed").count() == 1
    assert sorted(r.value for r in spark.read.parquet(f"{points}/points").collect()) == [-90, 4]
    main(["points", "--source", str(source), "--out", points, "--mode", "compat"])
    assert sorted(r.value for r in spark.read.parquet(f"{points}/points").collect()) == [-90, 0, 4]


def test_serve(spark, tmp_path):
    source, out = tmp_path / "dem.txt", str(tmp_path / "out")
    source.write_text("45.5,3.25,1200\n-10,20,300\n")
    main(["tiles", "--source", str(source), "--out", out, "--max-zoom", "3"])
    asked = {
        "lookup": ("id int, lat double, lon double, zoom int", [(1, 45.5, 3.25, 3), (2, 80.0, 100.0, 3)], 2),
        "box": ("id int, lat_min double, lon_min double, lat_max double, lon_max double, zoom int", [(1, -90.0, -180.0, 90.0, 180.0, 3)], 2),
        "missing": ("zoom int, tile_x int, tile_y int", [(0, 0, 0), (0, 1, 0)], 1),
        "key": ("zoom int, geohash string", [(0, "h0000000"), (0, "00000000")], 2),
    }
    for kind, (schema, values, n) in asked.items():
        requests = str(tmp_path / kind)
        spark.createDataFrame(values, schema).write.parquet(requests)
        main(["serve", "--source", f"{out}/tiles", "--requests", requests, "--out", out, "--kind", kind])
        assert spark.read.parquet(f"{out}/{kind}").count() == n


def test_cities(spark, tmp_path):
    cities, regions, out = tmp_path / "cities.txt", tmp_path / "regions.csv", str(tmp_path / "out")
    cities.write_text("Country,City,AccentCity,Region,Population,Latitude,Longitude\n"
                      "fr,paris,Paris,A8,100,48.8,2.3\nfr,lyon,Lyon,B9,50,45.7,4.8\nfr,x,X,ZZ,1,1,1\n")
    regions.write_text('FR,A8,"Ile-de-France"\nFR,B9,"Rhone-Alpes"\n')
    main(["cities", "--source", str(cities), "--regions", str(regions), "--out", out])
    assert spark.read.parquet(f"{out}/cities").count() == 2
    assert spark.read.parquet(f"{out}/cells").count() == 6
