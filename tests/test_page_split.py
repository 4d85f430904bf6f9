"""The query page_split against whole pages, and the steps that take many bands together against bands alone."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import raster_reference as ref
from folioflow.functions import raster
from folioflow.operators import rasters
from folioflow.plans import QUERIES


def texts():
    rng = np.random.default_rng(11)
    prose = lambda rows: rng.choice(np.frombuffer(b"etaoinshrdlu  ,.ETA", np.uint8), (rows, 30, 3))
    marked = prose(300)
    for y, x, h, w in ((20, 3, 8, 9), (118, 4, 14, 8), (246, 10, 12, 7), (251, 22, 4, 6), (280, 1, 3, 28), (290, 2, 4, 4)):
        marked[y : y + h, x : x + w] = np.frombuffer(b"  z", np.uint8)
    pages = {1: prose(1), 2: prose(7), 3: prose(90), 4: prose(560), 5: marked, 6: np.full((12, 30, 3), ord("a"), np.uint8)}
    out = {k: x.tobytes().decode() + "tail" * (k % 3) for k, x in pages.items()}
    return out | {7: None, 8: "", 9: "x" * 89, 10: "ሀለ ሐመ" * 120, 11: out[5]}


def test_texts_as_pages(spark, tmp_path):
    docs = texts()
    rows = [*docs.items(), (5, docs[5])]  # a row given twice comes twice
    pq.write_table(pa.table({"doc_id": pa.array([k for k, _ in rows]), "text": pa.array([t for _, t in rows])}), tmp_path / "documents.parquet")
    got = QUERIES["page_split"](spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted(k for k, _ in rows)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        high = len(data) // 90
        if not high:
            assert r.width is None and r.black_ink_pixels is None
            continue
        want = ref.split_page(np.frombuffer(data[: high * 90], np.uint8).reshape(high, 30, 3), 9)[0]
        assert {c: r[c] for c in want} == want, r.doc_id
    assert all(r.black_ink_pixels > 0 and r.red_ink_pixels > 0 and r.red_components_dropped_ornament > 0 for r in got if r.doc_id in (5, 11))


def test_median_of_wide_neighbourhoods():
    rng = np.random.default_rng(12)
    for k, low, high in ((9, 0, 256), (17, 90, 100), (51, 0, 256), (51, 7, 8), (9, 0, 2)):
        x = rng.integers(low, high, (23, 31), dtype=np.uint8)
        p = np.pad(x, k // 2, mode="edge")
        want = np.median(np.lib.stride_tricks.sliding_window_view(p, (k, k)), axis=(2, 3))
        assert (raster.median_blur(x, k) == want).all(), k


def bands(rng, shapes):
    """Bands as rasters.bands cuts them: (width, channels, height of the page, first row, count)."""
    rows = []
    for i, (w, c, h, y, n) in enumerate(shapes):
        low, end = max(0, y - 4), min(h, y + n + 4)
        rows.append({"origin": str(i), "band": y // 252, "height": h, "width": w, "nChannels": c, "y": y, "above": y - low, "count": n, "data": rng.integers(0, 256, (end - low) * w * c, dtype=np.uint8).tobytes()})
    return pa.RecordBatch.from_pylist(rows)


def test_stacked_bands_are_bands_alone(monkeypatch):
    shapes = [(30, 3, 29, 0, 29), (30, 3, 600, 252, 252), (30, 3, 255, 252, 3), (30, 3, 4, 0, 4), (3, 3, 50, 0, 50), (30, 1, 40, 0, 40), (17, 4, 260, 252, 8), (30, 3, 1, 0, 1), (30, 3, 504, 252, 252)]
    batch = bands(np.random.default_rng(13), shapes)
    alone = {i: rasters._masked(batch.slice(i, 1), "origin", 9).to_pylist()[0] for i in range(len(shapes))}
    for stack in (1, 5000, 1 << 17):
        monkeypatch.setattr(rasters, "STACK", stack)
        got = [r for b in rasters._stacks(batch, "width", "nChannels") for r in rasters._masked(b, "origin", 9).to_pylist()]
        assert {int(r["origin"]): r for r in got} == alone and len(got) == len(shapes)


def test_thresholds_over_batches():
    rng = np.random.default_rng(14)
    pages = ["a", "a", "a", "b", "c", "c", "d", None]
    levels = [rng.integers(0, 9, 256) * (rng.random(256) < 0.2) for _ in pages]
    levels[3] = np.eye(256, dtype=int)[77] * 5
    rows = pa.RecordBatch.from_pylist([{"page": p, "levels": [{"v": int(v), "n": int(n[v])} for v in np.flatnonzero(n)]} for p, n in zip(pages, levels, strict=True)], schema=pa.schema([("page", pa.string()), ("levels", pa.list_(pa.struct([("v", pa.int32()), ("n", pa.int64())])))]))
    want = {}
    for p in dict.fromkeys(pages):
        whole = sum(n for q, n in zip(pages, levels, strict=True) if q == p)
        want[p] = None if (whole > 0).sum() < 2 else ref.otsu(np.repeat(np.arange(256), whole).astype(np.uint8))
    for size in (1, 2, 3, 8):
        got = [r for b in rasters._thresholds(rows.slice(i, size) for i in range(0, len(pages), size)) for r in b.to_pylist()]
        assert [r["page"] for r in got] == list(want) and {r["page"]: r["threshold"] for r in got} == want


def test_ink_makes_no_rows(spark, monkeypatch):
    """What is kept between steps grows with pages, bands and red runs, not with runs of ink or levels."""
    made, keep = {}, rasters.stored

    def stored(df, name):
        out = keep(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(rasters, "stored", stored)
    page = np.random.default_rng(15).choice(np.frombuffer(b"etaoin ,.", np.uint8), (560, 30, 3))
    images = spark.createDataFrame([("a", 560, 30, 3, page.tobytes())], "origin string, height int, width int, nChannels int, data binary")
    got = rasters.split_pages(images, k=9)[0].collect()[0]
    assert got.black_ink_pixels == ref.split_page(page, 9)[0]["black_ink_pixels"] > 1000
    assert made["masks"] == 3 and sum(made.values()) < 100, made
