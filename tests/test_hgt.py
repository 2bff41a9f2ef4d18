import numpy as np
import pytest
from pyspark.sql import functions as F

from altigrid.functions.text import with_significant_text
from altigrid.sources import hgt, points

GRID = [[1, 2, 3], [0, -32768, 6], [7, 8, 9]]


def write_grid(folder, name, grid=GRID):
    (folder / name).write_bytes(np.array(grid, dtype=">i2").tobytes())


def test_small_file(spark, rows, tmp_path):
    write_grid(tmp_path, "N10E020.hgt")
    (tmp_path / "notes.txt").write_text("not a grid")
    found = hgt.read_hgt(spark, str(tmp_path), n=3)
    assert rows(found) == [
        (10.0, 20.0, 7), (10.0, 20.5, 8), (10.0, 21.0, 9), (10.5, 21.0, 6),
        (11.0, 20.0, 1), (11.0, 20.5, 2), (11.0, 21.0, 3)]


def test_heights_kept(spark, tmp_path):
    write_grid(tmp_path, "N10E020.hgt")
    path = str(tmp_path)
    assert hgt.read_hgt(spark, path, n=3, min_height=0).count() == 8
    assert hgt.read_hgt(spark, path, n=3, min_height=None).count() == 8
    files = hgt.read_hgt_files(spark, path)
    assert hgt.decode_hgt(files, 3, min_height=None, drop_shared_edge=True).count() == 3


@pytest.mark.parametrize("name", ["S05W066.hgt", "s05w066.HGT"])
def test_south_west(spark, tmp_path, name):
    write_grid(tmp_path, name)
    low, high = hgt.read_hgt(spark, str(tmp_path), n=3).agg(
        F.struct(F.min("lat"), F.min("lon")), F.struct(F.max("lat"), F.max("lon"))).first()
    assert tuple(low) == (-5.0, -66.0) and tuple(high) == (-4.0, -65.0)


def test_compat_steps(spark, rows, tmp_path):
    write_grid(tmp_path, "N10E020.hgt")
    found = hgt.read_hgt(spark, str(tmp_path), n=3, mode="compat")
    assert rows(found)[0] == (10.0, 20.0, 1)
    assert rows(found)[-1] == (10 + 2 * (1 / 3), 20 + 2 * (0.001 / 3), 9)


def test_truncated_file_fails(spark, tmp_path):
    (tmp_path / "N10E020.hgt").write_bytes(b"\x00" * 10)
    with pytest.raises(Exception, match="truncated elevation file"):
        hgt.read_hgt(spark, str(tmp_path), n=3).count()


def test_full_size_file(spark, tmp_path):
    rng = np.random.default_rng(3)
    grid = rng.integers(-10, 5000, (1201, 1201))
    write_grid(tmp_path, "N45W066.hgt", grid)
    found = hgt.read_hgt(spark, str(tmp_path)).agg(F.count("*"), F.sum("height"), F.max("lat")).first()
    assert tuple(found) == ((grid > 0).sum(), grid[grid > 0].sum(), 46.0)


def test_text_has_ten_significant_digits(spark):
    values = [0.0, 45.5, -179.1234567891, 9.123456789123, 0.1234567890123, 0.00083263946711,
              100.0, -66.0, 8.326394671e-7, -4.5e-5, 1 / 3, 20 + 1 / 1200, 89.99999999999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = [r[0] for r in with_significant_text(df, ["v"]).collect()]
    assert found == [f"{v:.10g}" for v in values]


def test_text_export_is_read_back(spark, rows, tmp_path):
    write_grid(tmp_path, "N10E020.hgt")
    found = hgt.read_hgt(spark, str(tmp_path), n=3)
    assert rows(points.parse_dem(hgt.points_to_text(found))) == rows(found)


@pytest.mark.parametrize("name, side, message", [("N10E020.hgt", 5, "another grid size"), ("somewhere.hgt", 3, "without a corner")])
def test_files_of_another_kind_fail_by_name(spark, tmp_path, name, side, message):
    (tmp_path / name).write_bytes(bytes(2 * side * side))
    with pytest.raises(Exception, match=message):
        hgt.read_hgt(spark, str(tmp_path), n=3).collect()
