import numpy as np
import pytest

from sarweave.__main__ import main
from sarweave.config import Config
from sarweave.plans import build
from sarweave.sources import images


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    r = np.random.default_rng(7)

    def put(rel, data):
        (root / rel).parent.mkdir(parents=True, exist_ok=True)
        (root / rel).write_bytes(data)

    def scene(folder, name, h, w, boxes, pols=("VV", "VH"), real=False):
        mask = np.zeros((h, w), np.uint8)
        for (a, b, c, d), v in boxes:
            mask[a:b, c:d] = v
        vv = r.uniform(0.01, 0.3, (h, w)).astype(np.float32)
        vh = (0.4 * vv).astype(np.float32)
        vv[mask > 0] *= 0.2
        for pol, a in zip(pols, (vv, vh), strict=False):
            put(f"{folder}_images/{name}_{pol}.tif", images.encode_tiff(a, (60.0, 25.0) if real else None, 1e-4))
        put(f"{folder}_mask/{name}_mask.tif", images.encode_tiff(mask))

    scene("01_oil", "scene01", 200, 220, [((20, 50, 20, 60), 1), ((120, 125, 10, 180), 1), ((150, 160, 190, 210), 2)], real=True)
    scene("01_oil", "scene02", 160, 160, [((5, 25, 5, 25), 1)], pols=("VV",))
    mask = np.zeros((90, 90), np.uint8)
    mask[30:60, 30:60] = 1
    put("02_lookalike/imgA.png", images.encode_png((r.random((90, 90)) * 255).astype(np.uint8)))
    put("02_lookalike/imgA_mask.png", images.encode_png(mask))
    put("02_lookalike/broken.tif", b"II*\0")
    return str(root)


C = Config(tile=64, stride=32, jitter=5, neg_buffer=20, min_area=20)


def test_build(spark, tree, tmp_path):
    out = build.build(spark, tree, str(tmp_path), C)
    inst = {(r.scene_id, r.instance_index): r for r in out["instances"].collect()}
    assert len(inst) == 5 and inst["scene01", 0].area_px == 1200 and inst["scene01", 0].perimeter == 2 * 29 + 2 * 39
    assert inst["scene01", 0].damping_ratio_db == pytest.approx(7, abs=1) and inst["scene01", 0].ndpi == pytest.approx((1 * 0.2 - 0.4) / (0.2 + 0.4), abs=0.01)
    assert inst["scene02", 0].ndpi is None and inst["imgA", 0].damping_ratio is None and inst["scene01", 2].mask_value == 2
    rows = out["rows"].collect()
    by = {r.crop_id: r for r in rows}
    assert len(by) == len(rows) and all(r.is_partial_object for r in rows if r.full_extent_area_px == 850) and sum(r.full_extent_area_px == 850 for r in rows) >= 2
    assert {r.label for r in rows} == {"oil", "lookalike", "background"}
    assert all(r.has_real_geo == r.crop_id.startswith("scene01") for r in rows)
    tiles = {r.name: bytes(r.content) for r in out["tiles"].collect()}
    for r in rows:
        m = images.decode(tiles[f"{r.crop_id}_mask.png"])
        assert m.shape == (64, 64) and set(np.unique(m)) <= {0, 255} and ((m == 255).any() == (r.label != "background"))
        vv = images.decode(tiles[f"{r.crop_id}_VV.png"])
        assert vv.dtype == (np.uint16 if r.is_calibrated else np.uint8)
    assert f"{rows[0].crop_id}_VV.png" in tiles
    assert all(r.ok for r in out["findings"].where("severity = 'hard'").collect())
    again = build.build(spark, tree, str(tmp_path), C, fresh=False)
    assert sorted(map(str, again["rows"].collect())) == sorted(map(str, rows))
    findings = out["findings"].count()
    (tmp_path / "state/findings/_SUCCESS").unlink()
    for f in (tmp_path / "state/findings").glob("*.parquet"):
        f.unlink()
    assert build.build(spark, tree, str(tmp_path), C, fresh=False)["findings"].count() == findings > 0


def test_rerun_is_identical(spark, tree, tmp_path):
    a, b = (sorted((r.name, bytes(r.content)) for r in build.build(spark, tree, f"{tmp_path}/{k}", C, upto="tiles")["tiles"].collect()) for k in "ab")
    assert a == b


def test_command_line(tree, tmp_path, spark):
    assert main(["findings", tree, str(tmp_path), "--tile", "64", "--neg-buffer", "20", "--label-override", "oil=oil"]) == 0
    assert main(["query", "label_counts", "/root/testdata/sf0.001"]) == 0
