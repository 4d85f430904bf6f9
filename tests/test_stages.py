"""A book on disk through its stages: adopted, verified, built, approved, imported."""

import hashlib
import json
import struct
import zlib

import pytest

from folioflow import stages
from folioflow.sources import books


def png(path, rows):
    """A grey image."""
    h, w = len(rows), len(rows[0])
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + bytes(r) for r in rows)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b""))


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    home = tmp_path_factory.mktemp("books") / "one"
    work = home / "work"
    for f in ("transcripts", "page_images", "red_layer", "black_layer", "red_mask", "layout", "candidates/dots", "candidates/dots-red"):
        (work / f).mkdir(parents=True)
    (home / "source").mkdir()
    (home / "source" / "a.pdf").write_bytes(b"pdf")
    (home / "book.json").write_text(json.dumps({"book_id": "one", "title_am": "መጽሐፍ", "sections": [{"section_id": "s", "order": 1, "required_any": [["ርእስ"]]}]}))
    rendered = {}
    for n in (1, 2, 3):
        png(work / f"page_images/page_00{n}.png", [[255] * 4] * 4)
        png(work / f"red_layer/page_00{n}.png", [[0, 0 if n == 1 else 255, 255, 255]] + [[255] * 4] * 3)
        png(work / f"black_layer/page_00{n}.png", [[0] * 4, [0, 0, 255, 255]] + [[255] * 4] * 2)
        rendered[str(n)] = hashlib.sha256((work / f"page_images/page_00{n}.png").read_bytes()).hexdigest()
    (work / "page_stats.json").write_text(json.dumps({str(n): {"is_blank": n == 3, "red_ink_ratio": 0.25} for n in (1, 2, 3)}))
    (work / "source_manifest.json").write_text(json.dumps({"source_sha256": hashlib.sha256(b"pdf").hexdigest(), "pages": 3, "dpi": 300, "rendered": rendered}))
    cells = [{"order": 0, "category": "Title", "text": "# ርእስ ቀይ", "bbox": [0, 0, 100, 40]}, {"order": 1, "category": "Text", "text": "ቃል ብዙ ነገር ያለው ጽሑፍ", "bbox": [0, 60, 100, 100]}]
    for n in (1, 2):
        (work / f"candidates/dots/page_00{n}.{'0' * 16}.json").write_text(json.dumps({"status": "draft", "layout": cells if n == 1 else cells[1:]}, ensure_ascii=False))
        (work / f"candidates/dots-red/page_00{n}.json").write_text(json.dumps({"regions": [{"bbox": [50, 5, 90, 35], "text": "ቀይ"}] if n == 1 else []}, ensure_ascii=False))
    (work / "transcripts/page_001.json").write_text('{"page": 1}')
    (work / "transcripts/page_001.original.json").write_text('{"page": 1, "first": true}')
    return home


def test_stages(spark, root):
    work = root / "work"
    assert stages.adopt(spark, str(root)) == {"adopted": [1, 2], "missing_candidate": [], "missing_red": [], "uncertain": 0}
    one = json.loads((work / "transcripts/page_001.json").read_text())
    assert [s["t"] + s["c"] for s in one["blocks"][0]["spans"]] == ["ርእስ black", "ቀይred"] and one["_legacy"] == "transcripts-legacy/page_001.json"
    assert sorted(p.name for p in (work / "transcripts-legacy").iterdir() if not p.name.startswith(".")) == ["page_001.json", "page_001.original.json"]
    assert not (work / "transcripts/page_001.original.json").exists()

    assert stages.verify(spark, str(root)) == {"pages_checked": 2, "pages_flagged": 0, "flagged_pages": []}
    report = json.loads((work / "verification.json").read_text())["reports"]
    assert report[0]["checks"]["mask_red_ratio"] == 0.25 and report[0]["checks"]["draft_transcript"] and report[0]["checks"]["model_red_ratio"] == 0.111

    q = stages.build(spark, str(root))
    assert (q["status"], q["unapproved_content_pages"], q["unverified_transcript_pages"]) == ("awaiting_approval", [1, 2], [])
    with pytest.raises(ValueError, match="awaiting_approval"):
        stages.build(spark, str(root), require_ready=True)
    made = json.loads((root / "out/one.json").read_text())
    assert made == json.loads((root / "out/one.min.json").read_text()) and made["sections"][0]["end_page"] == 2 and made["front_matter"] == []
    now = {r["page"]: {k: r[k] for k in ("transcript_sha256", "evidence_sha256")} for r in report}
    (work / "review.json").write_text(json.dumps({"entries": {str(p): {"status": "approved", "note": "", **h} for p, h in now.items()}}))
    assert stages.build(spark, str(root), require_ready=True)["production_ready"]

    edited = json.loads((work / "transcripts/page_002.json").read_text())
    edited["blocks"][0]["spans"] = [{"t": "ሌላ", "c": "red"}]
    export = root / "export.json"
    export.write_text(json.dumps({"book_id": "one", "exported_at": "2020-01-02T03:04:05Z", "transcripts": {"page_002": edited}, "edit_history": {"page_002": {"saved_by": "a"}}, "review": {"entries": {"1": {"status": "approved", "note": "x"}, "2": {"status": "approved", "note": ""}}}}, ensure_ascii=False))
    s = stages.import_export(spark, str(root), str(export))
    assert (s["transcripts_imported"], s["approvals_kept"], s["approvals_withdrawn"], s["review_entries"]) == ([2], [2], [1], 2)
    saved = json.loads((work / "transcripts/page_002.json").read_text())
    assert saved["blocks"][0]["spans"][0]["t"] == "ሌላ" and saved["_review_edit"] == {"saved_by": "a"}
    assert (work / "transcripts/page_002.original.json").exists() and len(list((work / "history/2").glob("*.json"))) == 1
    review = json.loads((work / "review.json").read_text())["entries"]
    assert review["1"]["status"] is None and review["2"]["status"] == "approved" and review["2"]["reviewed_by"] == "hosted reviewer"
    assert (work / "review-exports/one_review_export_2020-01-02T030405.json").exists()
    # The new text is unverified until it is checked again; its approval holds.
    q = stages.build(spark, str(root))
    assert (q["status"], q["unverified_transcript_pages"], q["unapproved_content_pages"]) == ("needs_review", [2], [1])
    with pytest.raises(ValueError, match="not 'one'"):
        export.write_text(json.dumps({"book_id": "two"}))
        stages.import_export(spark, str(root), str(export))

    assert "- Content pages: 2" in stages.audit(spark, str(root)) and (work / "red_audit.md").exists()
    lib = stages.library(spark, str(root.parent))
    assert [(b["book_id"], b["sections"], b["rendered"], b["transcribed"]) for b in lib] == [("one", 1, 3, 2)]
    d = stages.doctor(spark, str(root))
    assert (d["analysed_pages"], d["content_pages"], d["transcripts"], d["source_available"], d["draft_pages"]) == (3, 2, 2, True, [1, 2])


def test_tsv(spark, tmp_path):
    from folioflow.sources.pages import read_words_tsv

    head = "level\tpage_num\tconf\ttext\n"
    (tmp_path / "w.tsv").write_text(head + '5\t1\t96.5\t"ሰላም\n4\t1\t-1\t\n5\t1\t19.9\tx\n5\t1\t20\ty\n5\t1\tbad\tz\n5\t1\t90\t \n')
    assert [r.text for r in read_words_tsv(spark, str(tmp_path / "w.tsv")).collect()] == ['"ሰላም', "y"]


def test_listing_of_nothing(spark, tmp_path):
    assert books.discover(spark, str(tmp_path)) == [] and books.file_table(spark, f"{tmp_path}/*.png").count() == 0
