import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sarweave.operators import kernels, raster
from sarweave.plans import build
from sarweave.sources import corridors, files, images, sinks
from sarweave.streaming import ingest


@pytest.mark.parametrize("dtype", [np.uint8, np.uint16])
def test_png_round_trip(dtype):
    a = np.random.default_rng(1).integers(0, np.iinfo(dtype).max, (37, 53)).astype(dtype)
    data = images.encode_png(a)
    assert (images.decode(data) == a).all()
    assert images.header(data)["width"] == 53 and images.header(data)["dtype"] == f"uint{8 * a.dtype.itemsize}"


def test_png_refuses():
    with pytest.raises(ValueError):
        images.encode_png(np.zeros((2, 2, 3), np.uint8))
    with pytest.raises(ValueError):
        images.encode_png(np.zeros((2, 2), np.float32))


def test_tiff_round_trip():
    a = np.random.default_rng(2).random((20, 31)).astype(np.float32)
    data = images.encode_tiff(a, (60.0, 25.0), 1e-4)
    h = images.header(data)
    assert (images.decode(data) == a).all() and h["crs"] == "EPSG:4326" and h["transform"][2] == 60.0 and h["dtype"] == "float32"


def _tiff(bands, compress=1, predictor=1, tile=None, apart=False, big=False, order="<", extra=()):
    """Bands as a TIFF of strips of 7 lines or of tiles, for reading back."""
    a = np.stack(bands, axis=-1)
    h, w, n = a.shape
    rows, columns = (tile, tile) if tile else (7, w)

    def pack(block):
        if predictor == 2:
            block = np.concatenate((block[:, :1], np.diff(block, axis=1)), axis=1)
        raw = block.astype(block.dtype.newbyteorder(order)).tobytes()
        if predictor == 3:
            r, c, k = block.shape
            high = np.ascontiguousarray(block.astype(block.dtype.newbyteorder(">"))).view(np.uint8).reshape(r, c * k, -1)
            flat = high.transpose(0, 2, 1).reshape(r, -1, k)
            raw = np.concatenate((flat[:, :1], np.diff(flat, axis=1)), axis=1).tobytes()
        return {1: bytes, 8: zlib.compress, 5: lzw}[compress](raw)

    blocks = []
    for part in [a[..., i : i + 1] for i in range(n)] if apart else [a]:
        for y in range(0, h, rows):
            for x in range(0, w, columns):
                block = part[y : y + rows, x : x + columns]
                if tile:
                    block = np.pad(block, ((0, rows - block.shape[0]), (0, columns - block.shape[1]), (0, 0)))
                blocks.append(pack(block))
    head = 16 if big else 8
    starts = [head + sum(map(len, blocks[:i])) for i in range(len(blocks))]
    where = [(322, 4, (tile,)), (323, 4, (tile,)), (324, 4, tuple(starts)), (325, 4, tuple(map(len, blocks)))] if tile else [(273, 4, tuple(starts)), (278, 4, (rows,)), (279, 4, tuple(map(len, blocks)))]
    kind = {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags = sorted([(256, 4, (w,)), (257, 4, (h,)), (258, 3, (8 * a.dtype.itemsize,) * n), (259, 3, (compress,)), (277, 3, (n,)), (284, 3, (2 if apart else 1,)), (317, 3, (predictor,)), (339, 3, (kind,) * n), *where, *extra])
    body = b"".join(blocks)
    at = head + len(body)
    word, wide, few = ("Q", 8, "Q") if big else ("I", 4, "H")
    base = at + struct.calcsize(order + few) + (4 + 2 * wide) * len(tags) + wide
    entries, rest = b"", b""
    for tag, k, values in tags:
        raw = values if k == 2 else struct.pack(order + {3: "H", 4: "I"}[k] * len(values), *values)
        entries += struct.pack(order + "HH" + word, tag, k, len(values))
        entries += raw.ljust(wide, b"\0") if len(raw) <= wide else struct.pack(order + word, base + len(rest))
        rest += b"" if len(raw) <= wide else raw
    mark = {"<": b"II", ">": b"MM"}[order]
    start = mark + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at))
    return start + body + struct.pack(order + few, len(tags)) + entries + bytes(wide) + rest


def lzw(raw):
    """A plain writer of TIFF's LZW: one string of bits, cut into bytes at the end."""
    bits, table, word, width = [], {bytes([i]): i for i in range(256)}, b"", 9
    put = lambda code: bits.append(format(code, f"0{width}b"))
    put(256)
    at = 258
    for i in range(len(raw)):
        c = raw[i : i + 1]
        if word + c in table:
            word += c
            continue
        put(table[word])
        table[word + c] = at
        at += 1
        word = c
        if at == 4095:
            put(256)
            table, at, width = {bytes([i]): i for i in range(256)}, 258, 9
        elif at in (512, 1024, 2048):
            width += 1
    if word:
        put(table[word])
        if at + 1 in (512, 1024, 2048):
            width += 1
    put(257)
    s = "".join(bits)
    return int(s.ljust(-(-len(s) // 8) * 8, "0"), 2).to_bytes(-(-len(s) // 8), "big")


@pytest.mark.parametrize("compress", [1, 5, 8])
@pytest.mark.parametrize("tile", [None, 16])
@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize(("dtype", "predictor"), [(np.uint8, 1), (np.uint16, 2), (np.float32, 3)])
def test_tiff_layouts(compress, tile, apart, dtype, predictor):
    r = np.random.default_rng(4)
    bands = [(np.add.outer(np.arange(40), np.arange(53)) % 250 + r.integers(0, 5, (40, 53))).astype(dtype) for _ in range(3)]
    for big, order in ((False, "<"), (True, ">")):
        data = _tiff(bands, compress, predictor, tile, apart, big, order)
        assert images.header(data)["count"] == 3 and images.header(data)["time"] is None
        assert all((x == b).all() and x.dtype == dtype for x, b in zip(images.decode_bands(data), bands, strict=True))
        assert (images.decode(data, 2) == bands[2]).all()


def test_tiff_refuses_and_times():
    a = np.zeros((4, 4), np.uint8)
    jpeg = _tiff([a]).replace(struct.pack("<HHIHH", 259, 3, 1, 1, 0), struct.pack("<HHIHH", 259, 3, 1, 7, 0))
    with pytest.raises(ValueError, match="compression 7"):
        images.decode(jpeg)
    said = lambda text: images.header(_tiff([a], extra=[(42112, 2, text)]))["time"]
    assert said(b'<GDALMetadata><Item name="ACQUISITION_TIME">2019-03-04T05:06:07Z</Item></GDALMetadata>\0') == "2019-03-04T05:06:07Z"
    assert said(b'<GDALMetadata><Item name="TIME">soon</Item></GDALMetadata>\0') is None and said(b"<GDAL\0") is None


@pytest.fixture
def tree(tmp_path):
    r = np.random.default_rng(3)

    def put(rel, data):
        p = tmp_path / "raw" / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)

    vv = r.uniform(0.01, 0.3, (64, 48)).astype(np.float32)
    mask = np.zeros((64, 48), np.uint8)
    mask[10:30, 5:25] = 1
    for pol in ("VV", "VH"):
        put(f"01_oil_images/scene01_{pol}.tif", images.encode_tiff(vv, (60.0, 25.0), 1e-4))
    put("01_oil_mask/scene01_mask.tif", images.encode_tiff(mask))
    put("02_lookalike/a+b c.png", images.encode_png(mask))
    put("02_lookalike/a+b c_mask.png", images.encode_png(mask))
    put("02_lookalike/broken.tif", b"II*\0nothing")
    put("02_lookalike/notes.txt", b"x")
    return str(tmp_path / "raw")


def test_catalogue(spark, tree):
    listed = {r.rel: r for r in files.list_files(spark, tree).collect()}
    assert len(listed) == 7 and listed["01_oil_mask/scene01_mask.tif"].is_mask and not listed["01_oil_images/scene01_VV.tif"].is_mask
    probed = files.probe(spark, tree)
    assert probed.where("error IS NOT NULL").select("rel").collect()[0].rel.endswith("broken.tif")
    s = {r.scene_id: r for r in files.scenes(probed).collect()}
    assert s["scene01"].pol_tags == ["VV", "VH"] and s["scene01"].mask_path == "01_oil_mask/scene01_mask.tif" and s["scene01"].is_calibrated
    assert s["a+b c"].mask_path == "02_lookalike/a+b c_mask.png" and s["a+b c"].default_label == "lookalike" and not s["a+b c"].is_calibrated


def test_lines_to_instances(spark, tree):
    lines = files.read_lines(spark, tree, spark.createDataFrame([("01_oil_mask/scene01_mask.tif",)], "rel string"))
    classes = lines.select(F.lit(1).alias("scene"), "y", F.transform("v", lambda v: v.cast("int")).alias("v"))
    (i,) = raster.instances(classes).collect()
    assert (i.x, i.y, i.w, i.h, i.area) == (5, 10, 20, 20, 400) and i.perimeter == 2 * 19 + 2 * 19 and (i.cx, i.cy) == (14, 19) and not i.truncated


def test_bands(spark, tmp_path):
    """Contents are read once for all bands and don't pass through a shuffle; a broken file ends only what wants it."""
    root = tmp_path / "raw (1)+x"
    root.mkdir()
    r = np.random.default_rng(6)
    bands = [r.random((20, 30)).astype(np.float32) for _ in range(3)]
    (root / "s.tif").write_bytes(_tiff(bands, 8, 3, 16))
    (root / "broken.tif").write_bytes(b"II*\0nothing")
    every = files.read_bands(spark, str(root))
    got = {(x.rel, x.band, x.y): x.v for x in every.where("error IS NULL").collect()}
    assert len(got) == 60 and all(np.allclose(v, bands[b][y]) for (_, b, y), v in got.items())
    assert [x.rel for x in every.where("error IS NOT NULL").collect()] == ["broken.tif"]
    (scene,) = files.scenes(files.probe(spark, str(root))).collect()
    assert scene.pol_tags == ["VV", "VH", "B3"]
    scenes = files.scenes(files.probe(spark, str(root)))
    lines = build.band_lines(spark, str(root), scenes)
    assert {(x.kind, x.n) for x in lines.groupBy("kind").agg(F.count("v").alias("n")).collect()} == {("VV", 20), ("VH", 20), ("B3", 20)}
    one = files.read_lines(spark, str(root), spark.createDataFrame([("s.tif",)], "rel string"), 1)
    assert np.allclose(sorted(map(tuple, (x.v for x in one.collect()))), sorted(map(tuple, bands[1])))
    with pytest.raises(Exception, match="broken.tif"):
        files.read_lines(spark, str(root)).collect()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "content" not in "".join(x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("c2", "f1", True, None), ("c1", "f2", False, "Y")], "crop_id string, rel_folder string, is_synthetic_location boolean, is_calibrated string")
    sinks.write_master(rows, f"{tmp_path}/m")
    back = spark.read.option("header", True).csv(f"{tmp_path}/m").na.fill("").collect()
    assert {(r.crop_id, r.is_synthetic_location, r.is_calibrated, r.label) for r in back} == {("c2", "true", "N", ""), ("c1", "false", "Y", "")}
    sinks.write_by_folder(rows, f"{tmp_path}/g")
    sinks.write_by_folder(rows.where("rel_folder = 'f1'").withColumn("crop_id", F.lit("new")), f"{tmp_path}/g", mode="dynamic")
    assert {r.crop_id for r in spark.read.option("header", True).csv(f"{tmp_path}/g").collect()} == {"new", "c1"}
    tiles = spark.createDataFrame([("t", [[1, 2], [65535, 4]], 16)], "name string, lines array<array<int>>, bits int")
    (t,) = sinks.png_tiles(tiles).collect()
    assert images.decode(bytes(t.content)).tolist() == [[1, 2], [65535, 4]]
    sinks.write_splits(spark.createDataFrame([(1, "train", "a", "oil")], "image_id int, split string, scene string, label string"), f"{tmp_path}/s")
    assert spark.read.option("header", True).csv(f"{tmp_path}/s/manifest").count() == 1


def test_streams(spark, tree, tmp_path):
    q = ingest.into_folder(ingest.new_rasters(spark, tree), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 6 and out.where("error IS NOT NULL").count() == 1
    src = f"{tmp_path}/ev"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(src)
    s = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = ingest.track_windows(s).writeStream.outputMode("append").format("memory").queryName("tracks").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("SELECT * FROM tracks").count() > 0


def test_corridors(spark, tmp_path):
    p = tmp_path / "c.geojson"
    p.write_text(corridors.as_geojson())
    assert corridors.segments(corridors.corridors(spark, str(p))).count() == corridors.segments(corridors.corridors(spark)).count() == sum(len(x[2]) - 1 for x in corridors.CORRIDORS)


def test_kernels():
    yy, xx = np.mgrid[:300, :300]
    disk = (yy - 150) ** 2 + (xx - 150) ** 2 <= 40**2
    c = kernels.contour(disk)
    assert abs(kernels.perimeter(c) - 2 * np.pi * 40) / (2 * np.pi * 40) < 0.1
    major, minor = kernels.ellipse_axes(c)
    assert abs(major / minor - 1) < 0.05 and abs(major - 80) < 2
    assert kernels.polygon_centroid(c) == pytest.approx((150, 150))
    r = np.random.default_rng(5)
    for _ in range(5):
        m = r.random((40, 40)) < 0.45
        label, n = kernels.components(m)
        seen = np.zeros_like(label)
        k = 0
        for y, x in np.argwhere(m):
            if seen[y, x]:
                continue
            k += 1
            todo = [(y, x)]
            seen[y, x] = k
            while todo:
                a, b = todo.pop()
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        u, v = a + dy, b + dx
                        if 0 <= u < 40 and 0 <= v < 40 and m[u, v] and not seen[u, v]:
                            seen[u, v] = k
                            todo.append((u, v))
        assert k == n and (seen == label).all()
    one = np.zeros((50, 50), bool)
    one[25, 25] = True
    d = kernels.chamfer(one)
    assert d[25, 35] == pytest.approx(9.55) and d[35, 35] == pytest.approx(13.693)
    assert kernels.hull(np.array([[0, 0], [0, 4], [4, 4], [4, 0], [2, 2], [1, 3]])).shape == (4, 2)
    assert kernels.box_axes(np.array([[0, 0], [0, 9], [3, 9], [3, 0]])) == pytest.approx((9, 3))
